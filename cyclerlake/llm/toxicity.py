"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, word pairs, pairs with one word between, and beginnings of words (languages
that inflect give one stem many endings), hashed into ``2 ** BITS`` places; each counts once per
document. Words are runs of letters and digits in lower case. Learning rates are per coordinate and
L1 keeps most weights at zero. What remains is a small table: it is broadcast, at most
``2 ** BITS`` entries whatever the data.

The model is fitted on a bounded sample: of the labelled documents outside the held-out fold those
whose hash is smallest, so that about ``SAMPLE_ROWS`` are taken; fewer labels are all taken. Scoring
reads every document whole.

Defined results: null and empty texts score what the bias says. A label that is neither 0 nor 1 is
not used; equal labels of a document are one example, different ones are one each. Of rows with one id a single text
is learned from, the one whose hash is smallest. Without any toxic example every score is 0. Labels of ids that no document has, and documents with null id, are not learned from;
a null id is not in the held-out fold. Equal texts have equal scores. An empty table gives no rows.
Other columns are not read, or passed through by ``accepted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed, whole_text

BITS = 20
SAMPLE_ROWS = 16_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
# rate alpha / (beta + sqrt of squared gradients), L1 and L2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 3.0, 1.0
PASSES = 3
# beginnings of words of so many letters are features
STEMS = (4, 5, 6)
REMEMBERED = 300_000
PIECE = 1 << 20
_WORD = re.compile(r"\w+")


def fold_of(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


# -- features -----------------------------------------------------------------------------------


class Features:
    """Hashes texts to places. Hashes of words are remembered, up to ``REMEMBERED`` of them."""

    mix = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

    def __init__(self, bits: int = BITS) -> None:
        self.shift = np.uint64(64 - bits)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        # a row per word: its hash and those of its beginnings
        self.table = np.zeros((4096, 1 + len(STEMS)), np.uint64)

    def meet(self, word: str) -> int:
        n = len(self.number)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n] = [xxhash.xxh64_intdigest(p) for p in (word, *(word[:k] + "*" if len(word) > k else word for k in STEMS))]
        self.number[word] = n
        return n

    def of_words(self, words: list[str]) -> np.ndarray:
        """Places of all features of a list of words, repeats included."""
        if len(self.number) > REMEMBERED:
            self.forget()
        known, meet = self.number.get, self.meet
        numbers = [n if (n := known(w)) is not None else meet(w) for w in words]
        rows = self.table[np.array(numbers, dtype=np.int64)]
        word = rows[:, 0]
        pairs, skips = word[:-1] * self.mix[0] + word[1:], word[:-2] * self.mix[1] + word[2:]
        return (np.concatenate([rows.ravel(), pairs, skips]) >> self.shift).astype(np.int64)

    def of_text(self, text: str) -> np.ndarray:
        """Places of a whole text, each once."""
        return np.unique(np.concatenate([np.unique(self.of_words(w)) for w in word_lists(text)]))


def word_lists(text: str) -> Iterator[list[str]]:
    """Words of a text, in lists of bounded size that overlap by two words."""
    lowered, tail, at = text.lower(), [], 0
    while at < len(lowered) or not at:
        end = at + PIECE
        while end < len(lowered) and (lowered[end].isalnum() or lowered[end] == "_"):
            end += 1
        words = tail + _WORD.findall(lowered, at, end)
        yield words
        tail, at = words[-2:], end


# -- learning -----------------------------------------------------------------------------------


class Ftrl:
    """FTRL-proximal; place ``size`` is the bias, which L1 leaves alone."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, free = self.z[at], at == len(self.z) - 1
        pull = np.where(free, z, np.sign(z) * np.maximum(np.abs(z) - self.l1, 0))
        return -pull / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, places: np.ndarray, toxic: int) -> None:
        at = np.append(places, len(self.z) - 1)
        w = self.weights(at)
        g = sigmoid(w.sum()) - toxic
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(places: np.ndarray, begins: np.ndarray, sizes: np.ndarray, labels: np.ndarray, bits: int = BITS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero; place ``2 ** bits`` is the bias.

    ``places`` holds those of all examples; an example has ``size`` of them from ``begin`` on.
    """
    model = Ftrl(1 << bits)
    examples = list(zip(begins.tolist(), (begins + sizes).tolist(), labels.tolist()))
    for _ in range(passes):
        for begin, end, toxic in examples:
            model.learn(places[begin:end], toxic)
    every = np.arange(len(model.z))
    weights = model.weights(every)
    at = np.nonzero(weights)[0]
    return at, weights[at]


def sample(docs: DataFrame, labels: DataFrame, rows: int, key: str, text: str, label: str) -> DataFrame:
    """``place, text, label`` of about ``rows`` labelled documents at most, none of them held out."""
    told = labels.where((fold_of(key) != HELD_OUT) & F.col(label).isin(0, 1)).select(F.col(key).alias("id"), F.col(label).alias("label"))
    told = told.distinct().withColumn("place", F.xxhash64(F.col("id").cast("string")))
    share = min(1.0, rows / max(1, told.count()))
    # hashes are spread evenly: the smallest ones are this share of all
    told = told.where(F.col("place") <= int(share * 2**64) - 2**63 - (share == 1.0))
    texts = docs.select(F.col(key).alias("id"), whole_text(text).alias("text"))
    found = texts.join(F.broadcast(told), "id")
    # one text per id and at most two labels: as many rows as asked for, however often an id is repeated
    one = found.groupBy("place", "id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    return one.select("place", "id", "label", F.col("least.text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Weights that are not zero, and their places."""

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of_text(t).astype(np.int32) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("label").cast(pa.int32()), lists], ["place", "label", "found"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # few large arrays, which go back to the system when the task ends
        read = [(b.column("place").to_numpy(), b.column("label").to_numpy(), b.column("found").value_lengths().to_numpy(), b.column("found").flatten().to_numpy()) for b in batches]
        place, label, size, found = (np.concatenate(x) for x in zip(*read)) if read else [np.zeros(0, np.int64)] * 4
        del read
        if label.any():
            begin = np.cumsum(size) - size
            digest = [xxhash.xxh64_intdigest(found[a : a + n]) for a, n in zip(begin.tolist(), size.tolist())]
            # one order, whatever the partitions were; equal examples are interchangeable
            order = np.lexsort((np.array(digest, np.uint64), size, label, place))
            at, weights = fit(found, begin[order], size[order], label[order])
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(weights)], ["at", "weight"])

    hashed = sample(docs, labels, rows, key, text, label).mapInArrow(hash_texts, "place long, label int, found array<int>")
    # a bounded sample of bounded rows: one task learns from it
    weights = landed(hashed.repartition(1).mapInArrow(learn, "at long, weight double"), "toxicity-weights")
    told = weights.orderBy("at").toPandas()
    return told["at"].to_numpy(np.int64), told["weight"].to_numpy(float)


def score_texts(texts: list[str], weight: np.ndarray, features: Features) -> list[float]:
    bias, out = weight[-1], []
    for text in texts:
        hits = [found[weight[found] != 0] for found in map(features.of_words, word_lists(text))]
        at = np.unique(np.concatenate(hits))
        out.append(float(sigmoid(weight[at].sum() + bias)))
    return out


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``doc, held_out, score, predicted`` for every row of ``docs``; ``doc`` is a struct of the row."""
    at, weights = train(docs, labels, rows, key, text, label)
    model = docs.sparkSession.sparkContext.broadcast((at, weights))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, weights = model.value
        weight, features = np.zeros((1 << BITS) + 1), Features()
        weight[at] = weights
        for batch in batches:
            yield pd.Series(score_texts(batch.tolist(), weight, features) if len(at) else [0.0] * len(batch), dtype=float)

    held_out = F.coalesce(fold_of(key) == HELD_OUT, F.lit(False))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    told = docs.select(row.alias("doc"), held_out.alias("held_out"), scored(whole_text(text)).alias("score"))
    return told.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    return score(docs, labels, **options).where("predicted = 0").select("doc.*")

"""Token counts by a table of frequent pre-token lengths and a cache per worker.

The tokenizer drops white space and never joins what it separates, so a text has as many tokens as
its pre-tokens, the stretches between ASCII white space, have together. Other white space stays within a
pre-token, and the library handles it there.

1. Each task counts its pre-tokens in a Misra-Gries summary of ``SUMMARY`` entries and passes on the
   ``SENT`` most frequent ones. These few are added up, and the ``TABLE`` most frequent ones of the corpus
   are taken: a pre-token that makes up a hundredth of a percent of every task's words is among those sent.
   No pre-token of a text is shuffled.
2. Their lengths, by the library, are broadcast as a compact table: the pre-tokens in one string
   and a byte each for lengths, at most ``TABLE * (LONGEST + 2)`` bytes whatever the data.
3. Every text is then counted where it lies. What the table lacks, also without a mark at its end, is looked up in
   the worker's cache, and what that lacks is encoded by the library, all misses of a batch together.

What the table holds decides how fast texts are counted, never a count.

Defined results: a null text is empty and has 0 bytes and 0 tokens. Strings of special tokens within a text count
as the library counts them. Rows are counted one by one, also equal ones; an empty table gives no rows. Texts of
any length are read whole, in stretches of ``PIECE`` bytes. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.llm.common import whole_text

LIMIT = 2048
TABLE = 32_768
SUMMARY = 65_536
SENT = 8_192
LONGEST = 64
MARKS = b".,;:!?"
CACHED = 400_000
PIECE = 1 << 22


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def lengths(path: str, pre_tokens: list[bytes]) -> list[int]:
    """Tokens of each pre-token, by the library."""
    out = []
    for at in range(0, len(pre_tokens), 10_000):
        part = [p.decode() for p in pre_tokens[at : at + 10_000]]
        out += [len(e.ids) for e in tokenizer(path).encode_batch_fast(part, add_special_tokens=False)]
    return out


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Pre-tokens of a text, in lists of bounded size. Bytes are white space to ``split`` if they are in ASCII.

    The tokenizer folds case, but the strings of special tokens it finds before that.
    """
    if b"<|" not in text:
        text = text.lower()
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            end = text.find(b" ", at + PIECE)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def bare(word: bytes) -> bytes:
    """Without one mark at the end that stands behind a letter or digit: it is always a pre-token of its own."""
    return word[:-1] if word[-1] in MARKS and len(word) > 1 and word[-2:-1].isalnum() else word


def reduce_summary(summary: Counter, size: int = SUMMARY) -> Counter:
    """Misra-Gries: subtract the count of the first entry beyond ``size``; what is left is in the summary."""
    if len(summary) <= size:
        return summary
    less = summary.most_common(size + 1)[-1][1]
    return Counter({w: n - less for w, n in summary.items() if n > less})


def frequent(texts: DataFrame) -> list[bytes]:
    """The most frequent pre-tokens of the column ``_text``; at most ``TABLE``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: Counter = Counter()
        for batch in batches:
            for text in batch.column("_text"):
                for found in pieces(text.as_buffer().to_pybytes()):
                    summary.update(found)
                    if len(summary) > 4 * SUMMARY:
                        summary = reduce_summary(summary)
        best = [(w, n) for w, n in reduce_summary(summary).most_common(SENT) if len(w) <= LONGEST]
        columns = [pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    sent = texts.mapInArrow(summarise, "word binary, n long")
    rows = sent.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TABLE).collect()
    return [bytes(row["word"]) for row in rows]


def count(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row. ``path`` is the tokenizer's file, in the same place on all machines."""
    texts = docs.select(F.col(key), whole_text(text).alias("_text"))
    words = frequent(texts.select("_text"))
    known = [min(n, 255) for n in lengths(path, words)]
    # a length of 255 or more is left to the library
    table = docs.sparkSession.sparkContext.broadcast((b" ".join(words), bytes(known)))
    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens")]
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *longs, T.StructField("over_limit", T.BooleanType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, sizes = table.value
        first = {w: n for w, n in zip(listed.split(b" "), sizes) if n < 255}
        second: dict[bytes, int] = {}
        marks = dict(zip(MARKS, lengths(path, [bytes([m]) for m in MARKS])))

        for batch in batches:
            n_bytes, n_tokens, missed = [], [], []
            for row, whole in enumerate(batch.column("_text")):
                data = whole.as_buffer().to_pybytes()
                n_bytes.append(len(data))
                n_tokens.append(0)
                for found in pieces(data):
                    got = [first.get(w) for w in found]
                    lacking = []
                    for w in [w for w, n in zip(found, got) if n is None]:
                        if (b := bare(w)) is not w:
                            n_tokens[row] += marks[w[-1]]
                            w = b
                        if (n := first.get(w)) is None:
                            lacking.append(w)
                        else:
                            n_tokens[row] += n
                    if lacking:
                        missed.append((row, lacking))
                    n_tokens[row] += sum(n for n in got if n is not None)
            if len(second) > CACHED:
                second.clear()
            unknown = list({w for _, lacking in missed for w in lacking if w not in second})
            told = dict(zip(unknown, lengths(path, unknown)))
            for row, lacking in missed:
                n_tokens[row] += sum(n if (n := second.get(w)) is not None else told[w] for w in lacking)
            second.update((w, n) for w, n in told.items() if len(w) <= LONGEST)
            over = [n > limit for n in n_tokens]
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(over, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return texts.mapInArrow(look, schema)

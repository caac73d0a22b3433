"""Phrase collocations by a distributed multikey quicksort of suffix pointers.

A suffix is the words from one position to the end of its piece, up to the longest phrase asked
for. All phrases that begin with the same words lie side by side among sorted suffixes, so:

1. Every task turns its texts into suffixes of word numbers, and makes equal ones a single one
   with a weight.
2. Suffixes are routed by their leading words to ranges of their order. Ranges are drawn at a
   random sample of positions, one per ``RANGE_WORDS`` words or so; where they are drawn decides how work
   is spread, never a count. A phrase that a third of all positions begin with spans many ranges.
   What travels are blocks: the suffixes of one task for one range, with the words they use.
3. In its range a task sorts pointers to suffixes by multikey three-way quicksort down to the
   longest phrase. The weight of a partition of equal words is the count of a phrase; partitions
   below the threshold, equal or not, are abandoned at once. Only the few phrases that the end
   of a range cuts in two, beginnings of the suffixes it was drawn at, are counted apart
   and added up over ranges.
4. Scores need counts of the first and the rest of a phrase. Both are frequent too, so they are
   found by joins of the table of frequent phrases with itself.

A range is held in memory by one task: 24 bytes a distinct suffix, ``RANGE_WORDS`` on average, up
to ``MAX_RANGES`` ranges; beyond that many, ranges grow.

Defined results: a null text is empty, a null language ``und``. Rows are counted one by one, also equal
ones. Only A-Z become lower case. Empty pieces and empty texts have no words; a text of any length
is read whole. Ties of scores between cuts go to the shorter first part, between phrases to the
larger count and then to the smaller phrase in bytes. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed, whole_text

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
RANGE_WORDS = 500_000
MAX_RANGES = 1 << 20
POINTS = 8
MAX_TASKS = 10_000
BATCH_WORDS = 1_000_000
PIECE = 1 << 22
SALTS = 16
LEAF = 4096
BROADCAST_LANGS = 100_000
UNKNOWN = "und"

# A-Z become a-z, what ends a piece becomes a full stop
_ENDS = b",;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + b"." * len(_ENDS))
_END = b"."

Words = tuple[bytes, ...]
Splitters = list[tuple[str, Words]]


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with a full stop at each end of a piece, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            end = text.find(b" ", at + PIECE)
            end = len(text) if end < 0 else end
        yield text[at:end].translate(_FOLD).replace(_END, b" . ").split()
        at = end


# -- suffixes of a task -------------------------------------------------------------------------


class Suffixes:
    """Suffixes of the texts of one language, until they are sent off."""

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.restart([])

    def restart(self, tail: list[bytes]) -> None:
        self.number: dict[bytes, int] = {_END: 0}
        self.stream: list[np.ndarray] = []
        self.tail: list[bytes] = []
        self.words = 0
        self.add(tail)

    def add(self, found: list[bytes]) -> None:
        number = self.number
        self.stream.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
        self.words += len(found)
        self.tail = (self.tail + found[-self.depth :])[-(self.depth - 1) :] if self.depth > 1 else []

    def blocks(self, cuts: list[tuple[int, Words]], last: int, ended: bool) -> Iterator[tuple[int, bytes]]:
        """Sorted suffixes by range. ``cuts`` are the ranges that end within this language, ``last`` is the next one.

        Within a text, the last positions wait for the words that follow.
        """
        depth = self.depth
        tail = [] if ended else self.tail
        ids = np.concatenate([*self.stream, np.zeros(depth, np.int32)])
        words = sorted(w for w in self.number if w != _END)
        rank = np.zeros(len(self.number), np.int64)
        rank[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
        ids = rank[ids]
        count = len(ids) - depth - (0 if ended else len(tail))
        self.restart(tail)
        columns = [ids[:count]]
        for k in range(1, depth):
            columns.append(np.where(columns[-1] > 0, ids[k : k + count], 0))
        taken = columns[0] > 0
        bits = (len(words) + 1).bit_length()
        # some words to a number, so that few keys are compared
        width = 63 // bits
        keys = []
        for k in range(0, depth, width):
            key = np.zeros(int(taken.sum()), np.int64)
            for j in range(k, k + width):
                key = (key << bits) | (columns[j][taken] if j < depth else 0)
            keys.append(key)
        if not len(keys[0]):
            return
        order = np.lexsort(keys[::-1])
        keys = [key[order] for key in keys]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
        first = np.flatnonzero(fresh)
        weights = np.diff(np.append(first, len(order)))
        keys = [key[first] for key in keys]

        at = 0
        for route, cut in [*cuts, (last, None)]:
            end = len(first) if cut is None else _place(words, keys, cut, depth, bits, width)
            if end > at:
                yield route, _pack([key[at:end] for key in keys], weights[at:end], words, depth, bits, width)
            at = max(at, end)


def _place(words: list[bytes], keys: list[np.ndarray], cut: Words, depth: int, bits: int, width: int) -> int:
    """How many sorted suffixes do not come after ``cut``."""
    ranks, side = [], "right"
    for word in cut[:depth]:
        at = bisect_left(words, word)
        ranks.append(at + 1)
        if at == len(words) or words[at] != word:
            side = "left"  # this place belongs to a later word
            break
    ranks += [0] * (width * len(keys) - len(ranks))
    lo, hi = 0, len(keys[0])
    for k, key in enumerate(keys):
        value = 0
        for rank in ranks[k * width : (k + 1) * width]:
            value = (value << bits) | rank
        begin = lo + int(np.searchsorted(key[lo:hi], value, "left"))
        end = lo + int(np.searchsorted(key[lo:hi], value, "right"))
        lo, hi = begin, end
    return hi if side == "right" else lo


def _pack(keys: list[np.ndarray], weights: np.ndarray, words: list[bytes], depth: int, bits: int, width: int) -> bytes:
    """A block: the words it uses, its suffixes as numbers of words, and their weights."""
    mask = (1 << bits) - 1
    columns = [(keys[j // width] >> (bits * (width - 1 - j % width))) & mask for j in range(depth)]
    used, where = np.unique(np.concatenate([[0], *columns]), return_inverse=True)
    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
    listed = b"\t".join(words[i - 1] for i in used[1:].tolist())
    sizes = np.array([len(listed), len(weights), np.dtype(kind).itemsize], np.int64)
    parts = [sizes.tobytes(), listed, where[1:].astype(kind).tobytes(), weights.astype(np.uint32).tobytes()]
    return zstandard.compress(b"".join(parts), 3)


def _unpack(block: bytes, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    data = zstandard.decompress(block)
    length, count, size = np.frombuffer(data, np.int64, 3).tolist()
    words = data[24 : 24 + length].split(b"\t")
    numbers = np.frombuffer(data, f"u{size}", depth * count, 24 + length).reshape(depth, count)
    return words, numbers, np.frombuffer(data, np.uint32, count, 24 + length + depth * count * size)


# -- phrases of a range -------------------------------------------------------------------------


def frequent(columns: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[list[int], int]]:
    """Phrases, as numbers of words, that begin suffixes of at least this weight.

    ``columns`` holds the words of all suffixes by depth, 0 beyond a suffix's end.
    """
    todo = [(np.arange(columns.shape[1]), 0, [])]
    while todo:
        pointers, depth, begun = todo.pop()
        word = columns[depth, pointers]
        if len(pointers) <= LEAF:
            # few pointers are sorted at once
            values, where = np.unique(word, return_inverse=True)
            total = np.bincount(where, weights[pointers], len(values)).astype(np.int64)
            groups = [(int(values[g]), pointers[where == g], int(total[g])) for g in np.flatnonzero(total >= least).tolist()]
        else:
            pivot = int(np.median(word[:: max(1, len(word) // 64)]).astype(np.int64))
            below, above = pointers[word < pivot], pointers[word > pivot]
            for part in (below, above):
                if len(part) and weights[part].sum() >= least:
                    todo.append((part, depth, begun))
            same = pointers[word == pivot]
            total = int(weights[same].sum())
            groups = [(pivot, same, total)] if len(same) and total >= least else []
        for value, same, total in groups:
            if value:
                phrase = [*begun, value]
                yield phrase, total
                if depth + 1 < len(columns):
                    todo.append((same, depth + 1, phrase))


def _phrases_of(blocks: list[bytes], edges: list[Words], depth: int, least: int) -> Iterator[tuple[str, int]]:
    """Phrases of one language in one range with their counts; "" counts all words."""
    number: dict[bytes, int] = {}
    columns, weights = [], []
    for block in blocks:
        words, local, weight = _unpack(block, depth)
        meaning = np.array([0, *(number.setdefault(w, len(number) + 1) for w in words)], np.int32)
        columns.append(meaning[local])
        weights.append(weight.astype(np.int64))
    every, weight = np.concatenate(columns, axis=1), np.concatenate(weights)
    del columns, weights
    yield "", int(weight.sum())
    cut = {edge[:k] for edge in edges for k in range(1, len(edge) + 1)}
    for phrase in sorted(cut):
        within = np.arange(every.shape[1])
        for k, word in enumerate(phrase):
            within = within[every[k, within] == number.get(word, -1)]
        if len(within):
            yield b" ".join(phrase).decode(), int(weight[within].sum())
    name = [b"", *number]
    for numbers, total in frequent(every, weight, least):
        phrase = tuple(name[i] for i in numbers)
        if phrase not in cut:
            yield b" ".join(phrase).decode(), total


# -- over all texts -----------------------------------------------------------------------------


def draw_ranges(texts: DataFrame, depth: int) -> Splitters:
    """Leading words at random positions, in order: of about ``MAX_RANGES`` points at most, each so many-th."""
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(least, size // 6 // RANGE_WORDS))
    # some points to a range make ranges more even
    points = max(1, min(POINTS, MAX_RANGES // ranges))
    rate = ranges * points / max(1, size)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                # the same positions in each run; gaps between them as in a Poisson process
                chance = random.Random(zlib.crc32(text[:200].encode("utf-8", "replace")) ^ len(text))
                at = int(chance.expovariate(rate))
                while at < len(text):
                    near = text[at : at + 512].encode("utf-8", "replace").translate(_FOLD)
                    words = near[near.find(b" ") + 1 :].replace(_END, b" . ").split()[:depth]
                    words = words[: words.index(_END)] if _END in words else words
                    if words:
                        found.append((lang, b"\t".join(words)))
                    at += 1 + int(chance.expovariate(rate))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.binary())], ["lang", "words"])

    drawn = texts.mapInArrow(draw, "lang string, words binary").collect()
    told = sorted((row["lang"], tuple(bytes(row["words"]).split(b"\t"))) for row in drawn)
    return sorted(set(told[points - 1 :: points]))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """``lang, phrase, f`` of all phrases of up to ``max_words`` words that occur ``min_count`` times or more.

    The phrase "" stands for the number of all words.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), whole_text(text).alias("text"))
    context = docs.sparkSession.sparkContext
    drawn = context.broadcast(draw_ranges(texts, max_words))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = drawn.value
        held: dict[str, Suffixes] = {}
        waiting = 0

        def ship(name: str, ended: bool) -> pa.RecordBatch:
            lo = bisect_left(splitters, (name, ()))
            hi = bisect_left(splitters, (name + "\0", ()))
            cuts = [(i, splitters[i][1]) for i in range(lo, hi)]
            sent = list(held[name].blocks(cuts, hi, ended))
            if ended:
                del held[name]
            columns = [pa.array([r for r, _ in sent], pa.int64()), pa.array([name] * len(sent), pa.string()), pa.array([b for _, b in sent], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["route", "lang", "block"])

        for batch in batches:
            for name, whole in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                mine = held.get(name) or held.setdefault(name, Suffixes(max_words))
                waiting -= mine.words
                for found in tokens(whole.encode("utf-8", "replace")):
                    mine.add(found)
                    if mine.words > 2 * BATCH_WORDS:
                        yield ship(name, False)
                mine.add([_END])
                waiting += mine.words
                while waiting > BATCH_WORDS:
                    largest = max(held, key=lambda x: held[x].words)
                    waiting -= held[largest].words
                    yield ship(largest, True)
        for name in list(held):
            yield ship(name, True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = drawn.value
        held: dict[tuple[int, str], list[bytes]] = defaultdict(list)
        for batch in batches:
            for route, name, block in zip(batch["route"].to_pylist(), batch["lang"].to_pylist(), batch["block"].to_pylist()):
                held[route, name].append(block)
        while held:
            (route, name), blocks = held.popitem()
            ends = [splitters[i] for i in (route - 1, route) if 0 <= i < len(splitters)]
            edges = [words for where, words in ends if where == name]
            found = list(_phrases_of(blocks, edges, max_words, min_count))
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                columns = [pa.array([name] * len(part), pa.string()), pa.array([p for p, _ in part], pa.string()), pa.array([f for _, f in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    tasks = min(MAX_TASKS, len(drawn.value) + 1)
    blocks = texts.mapInArrow(send, "route long, lang string, block binary")
    laid = blocks.repartitionById(tasks, F.expr(f"CAST(route % {tasks} AS int)"))
    found = laid.mapInArrow(count, "lang string, phrase string, f long")
    totals = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return totals.where((F.col("f") >= min_count) | (F.col("phrase") == ""))


def score(counts: DataFrame, top: int = TOP) -> DataFrame:
    """Ranks the phrases of two words and more in the result of ``phrase_counts``."""
    size = F.expr("length(phrase) - length(replace(phrase, ' ', '')) + 1")
    n = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    if n.count() <= BROADCAST_LANGS:
        n = F.broadcast(n)
    sized = counts.where("phrase <> ''").withColumn("size", size)
    # a word begins or ends very many phrases: single words are looked up in salted copies
    copies = F.expr(f"explode(sequence(0, CASE WHEN size = 1 THEN {SALTS - 1} ELSE 0 END))")
    known = sized.select(F.col("lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f"), copies.alias("salt"))
    cuts = sized.where("size > 1").selectExpr("lang", "phrase", "f AS a", "size", "explode(sequence(1, size - 1)) AS k")
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))

    def looked_up(df: DataFrame, part: str, single: str, name: str) -> DataFrame:
        salt = F.expr(f"CASE WHEN {single} THEN CAST(pmod(xxhash64(phrase), {SALTS}) AS int) ELSE 0 END")
        df = df.withColumn("salt", salt).withColumnRenamed(part, "part")
        return df.join(known, ["lang", "part", "salt"]).drop("part", "salt").withColumnRenamed("part_f", name)

    cuts = looked_up(looked_up(cuts, "first", "k = 1", "l"), "rest", "k = size - 1", "r")
    cuts = cuts.join(n, "lang")
    wide = "CAST({} AS decimal(19, 0))".format
    # 1000 * a * n and l * r need up to 38 digits; the quotient is at most 1000 * n / a
    value = f"(CAST(1000 AS decimal(4, 0)) * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"
    lowest = cuts.groupBy("lang", "phrase", "a", "size", "n").agg(F.min(F.expr(f"struct({value} AS score, k, l, r)")).alias("cut"))
    # a longer phrase that holds this one as often holds it in a phrase of one word more
    longer = sized.where("size > 2").select("lang", F.col("f").alias("longer"), F.explode(F.expr("array(substring_index(phrase, ' ', size - 1), substring_index(phrase, ' ', 1 - size))")).alias("phrase"))
    longest = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longest, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    told = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = told.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language whose words are bound most closely."""
    return score(landed(phrase_counts(docs, text, lang, min_count, max_words), "phrases"), top)

"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period ``q`` and length of at least ``max(6, 4 * q)`` that
no neighbouring word extends. The texts of a batch are one sequence of word numbers, with an end mark
of its own after each text.

* Repeated doubling ranks the factors of every length ``2 ** k``. The last ranks are the suffix
  array; those of level ``k`` say where in it the suffixes that begin with a dyadic block lie, and
  whether two factors of that length are equal.
* Let ``b = 2 ** k <= q < 2 * b``. The first dyadic block ``B`` of length ``b`` at or after the start
  of a run lies in it, and so do the two after it, and ``B`` occurs again ``q`` words on. So each block asks
  for its occurrences from ``b`` to ``2 * b - 1`` words on: range successors in the interval of ``B``, by a
  wavelet tree over the suffix array.
* One or two occurrences give their distances as candidate periods. Three or more form a
  progression whose difference is the period of ``B``. Such a stretch is shorter than ``1.5 * q``, for
  else the run would have a smaller period, so its right end lies in the run and again ``q`` words on: the distance of
  these two ends is the one candidate.
* A candidate is extended to both sides by comparing ranks, longest factors first. Of candidates
  with the same stretch the smallest period is that of the run.

Period 1 needs no pattern: neighbours are compared. Whatever the text, a batch of ``n`` words takes
about ``8 * n * log2(n)`` bytes; a batch has ``BATCH_WORDS`` or one longer text.

Defined results: a null or empty text has no words and no runs. Equal rows are told one by one. A null id
is a key like any other, an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.llm.common import whole_text

LEAST = 6
REPEATS = 4
BATCH_WORDS = 250_000
Run = tuple[int, int, int]
#: From a key and a number of words to the numbers of the words to look at, ``None`` for all as they are.
Rewrite = Callable[[int | None, int], np.ndarray | None]


class Factors:
    """Ranks of all factors of a sequence whose length is a power of two.

    ``rank[k][i]`` is the number of suffixes that are smaller than the one at ``i`` within their first
    ``2 ** k`` numbers; ``spans[k]`` says how often a factor occurs there if more than once, else 0.
    """

    def __init__(self, numbers: np.ndarray) -> None:
        order = np.argsort(numbers, kind="stable")
        rank = np.empty(len(numbers), np.int32)
        ordered = numbers[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        sizes = np.diff(np.append(first, len(order)))
        rank[order] = np.repeat(first, sizes)
        size = np.repeat(sizes, sizes)
        self.rank, self.spans = [rank], []
        width = 1
        while True:
            # all members of an interval of several are active
            active, size = order[size > 1], size[size > 1]
            span = np.zeros(len(numbers), np.int32)
            span[active] = size
            self.spans.append(span)
            if not len(active):
                break
            # a repeated factor holds no end mark, so something follows it
            key = rank[active].astype(np.int64) * (len(numbers) + 1) + rank[active + width]
            by = np.argsort(key, kind="stable")
            order, key = active[by], key[by]
            old, at = rank[order], np.arange(len(order))
            group = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
            interval = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
            rank = rank.copy()
            rank[order] = old + (group - interval)
            self.rank.append(rank)
            size = np.bincount(group, minlength=len(order))[group]
            width *= 2

    def suffix_array(self) -> np.ndarray:
        out = np.empty(len(self.rank[-1]), np.int32)
        out[self.rank[-1]] = np.arange(len(out), dtype=np.int32)
        return out

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers from ``i`` and ``j`` on are equal."""
        at, to = i.copy(), j.copy()
        for k in range(len(self.rank) - 1, -1, -1):
            step = (self.rank[k][at] == self.rank[k][to]).astype(np.int64) << k
            at += step
            to += step
        return at - i

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers right before ``i`` and ``j`` are equal; ``i`` is the smaller place."""
        at, to = i.copy(), j.copy()
        for k in range(len(self.rank) - 1, -1, -1):
            width = 1 << k
            inside = at >= width
            low = np.where(inside, at - width, 0)
            step = np.where(inside & (self.rank[k][low] == self.rank[k][np.where(inside, to - width, 0)]), width, 0)
            at -= step
            to -= step
        return i - at


class WaveletTree:
    """Levels of bits of a sequence of numbers below ``2 ** bits``, each sorted stably by the bits above."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.bits = max(1, len(numbers).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (numbers >> bit) & 1 == 0
            self.zeros.append(np.append(0, np.cumsum(low)).astype(np.int32))
            numbers = np.concatenate([numbers[low], numbers[~low]])

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers at ``lo`` to ``hi - 1`` are below ``limit``."""
        found = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            low_lo, low_hi, total = zeros[lo], zeros[hi], zeros[-1]
            up = (limit >> bit) & 1 == 1
            found += np.where(up, low_hi - low_lo, 0)
            lo = np.where(up, total + lo - low_lo, low_lo)
            hi = np.where(up, total + hi - low_hi, low_hi)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number at this place (from 0) of the sorted numbers at ``lo`` to ``hi - 1``."""
        found = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            low_lo, low_hi, total = zeros[lo], zeros[hi], zeros[-1]
            up = place >= low_hi - low_lo
            place = np.where(up, place - (low_hi - low_lo), place)
            found |= up.astype(np.int64) << bit
            lo = np.where(up, total + lo - low_lo, low_lo)
            hi = np.where(up, total + hi - low_hi, low_hi)
        return found


def candidates(factors: Factors, tree: WaveletTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks of a level and periods that they may have."""
    block, span = 1 << level, factors.spans[level]
    repeats = span[::block] > 0
    # the two blocks after it lie in the run as well
    asks = np.flatnonzero(repeats[:-2] & repeats[1:-1] & repeats[2:]).astype(np.int64) * block
    lo = factors.rank[level][asks].astype(np.int64)
    hi, top = lo + span[asks], len(span)
    before = tree.below(lo, hi, np.minimum(asks + block, top))
    found = tree.below(lo, hi, np.minimum(asks + 2 * block, top)) - before
    met = found > 0
    asks, lo, hi, before, found = asks[met], lo[met], hi[met], before[met], found[met]
    first = tree.smallest(lo, hi, before)
    places, periods = [asks[found <= 2]], [(first - asks)[found <= 2]]
    more = found > 1
    second = tree.smallest(lo[more], hi[more], before[more] + 1)
    at, first, found = asks[more], first[more], found[more]
    places.append(at[found == 2])
    periods.append((second - at)[found == 2])
    at, first, step = at[found > 2], first[found > 2], (second - first)[found > 2]
    # right ends of the stretches with the block's own period
    period = (first + factors.ahead(first, first + step)) - (at + factors.ahead(at, at + step))
    inside = (period >= block) & (period < 2 * block)
    return np.concatenate([*places, at[inside]]), np.concatenate([*periods, period[inside]])


def find_runs(numbers: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows ``start, length, period`` in order of start and period.

    Every text in ``numbers`` ends in a number that occurs nowhere else. ``repeats`` is 4 or more.
    """
    if repeats < 4:
        raise ValueError("blocks are only sure to meet runs of four periods or more")
    factors = Factors(numbers)
    same = np.append(False, numbers[1:] == numbers[:-1])
    places = [np.flatnonzero(same & ~np.append(False, same[:-1])).astype(np.int64) - 1]
    periods = [np.ones(len(places[0]), np.int64)]
    if len(factors.spans) > 1 and factors.spans[1].any():
        tree = WaveletTree(factors.suffix_array())
        for level in range(1, len(factors.spans)):
            if (3 << level) <= len(numbers):
                at, period = candidates(factors, tree, level)
                places.append(at)
                periods.append(period)
    at, period = np.concatenate(places), np.concatenate(periods)
    start = at - factors.behind(at, at + period)
    length = at + period + factors.ahead(at, at + period) - start
    kept = length >= np.maximum(least, repeats * period)
    runs = np.unique(np.stack([start[kept], length[kept], period[kept]], axis=1), axis=0)
    # of one stretch the smallest period
    fresh = np.ones(len(runs), bool)
    fresh[1:] = np.any(runs[1:, :2] != runs[:-1, :2], axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _compare(one: Run, other: Run) -> int:
    """Greatest exact length/period first, then smallest start, then period."""
    more = other[1] * one[2] - one[1] * other[2]
    return more or one[0] - other[0] or one[2] - other[2]


def best_run(runs: list[Run]) -> Run | None:
    return min(runs, key=cmp_to_key(_compare), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change)[:-1] > 0
    return [w for w, drop in zip(words, gone.tolist()) if not drop]


Told = tuple[int | None, list[Run], list[bytes]]


def _batch(held: list[tuple[int | None, list[bytes]]]) -> Iterator[Told]:
    """Runs of the texts of a batch, and the words left."""
    number: dict[bytes, int] = {}
    parts = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for _, words in held]
    ends = np.cumsum([len(p) + 1 for p in parts])
    marked = [x for i, p in enumerate(parts) for x in (p, [len(number) + i])]
    runs = find_runs(np.concatenate(marked).astype(np.int64))
    owner = np.searchsorted(ends, runs[:, 0], "right")
    cuts = np.searchsorted(owner, np.arange(len(held) + 1))
    for i, (key, words) in enumerate(held):
        begin = int(ends[i]) - len(words) - 1
        mine = [(start - begin, length, period) for start, length, period in runs[cuts[i] : cuts[i + 1]].tolist()]
        yield key, mine, collapsed(words, mine)


def _row(key: int | None, runs: list[Run], kept: list[bytes]) -> tuple:
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    start, length, period = best_run(runs) or (None, None, None)
    share = None if start is None else 1000 * length // period
    return (key, len(runs), start, length, period, share, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), runs, b" ".join(kept).decode("utf-8", "replace"))


DIGEST = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None, texts: bool = True) -> DataFrame:
    """Per row its key, the digest columns, and with ``texts`` its ``runs`` and the ``collapsed`` text.

    ``n_runs``; ``start, length, period, exponent_milli`` of the run with most repeats; ``runs_sha256`` of
    ``start,length,period`` lines; ``collapsed_sha256`` of the kept words joined by one space.
    """
    longs = {"n_runs", "start", "length", "period", "exponent_milli"}
    told = [T.StructField(c, T.LongType() if c in longs else T.StringType()) for c in DIGEST]
    more = "array<struct<start: long, length: long, period: long>>"
    fields = [T.StructField(key, docs.schema[key].dataType), *told]
    kinds = [pa.int64() if c in longs else pa.string() for c in DIGEST]
    if texts:
        fields += [T.StructField("runs", T.DataType.fromDDL(more)), T.StructField("collapsed", T.StringType())]
        kinds += [pa.list_(_RUN), pa.string()]
    schema = T.StructType(fields)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, kind = [], 0, None

        def answer() -> pa.RecordBatch:
            rows = [_row(*told) for told in _batch(held)]
            columns = [pa.array([row[0] for row in rows], kind)]
            for i, of in enumerate(kinds, 1):
                values = [row[i] for row in rows]
                if of == pa.list_(_RUN):
                    values = [[dict(zip(("start", "length", "period"), run)) for run in runs] for runs in values]
                columns.append(pa.array(values, of))
            return pa.RecordBatch.from_arrays(columns, schema.fieldNames())

        for batch in batches:
            kind = batch.schema.field(0).type
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = whole.encode("utf-8", "replace").split()
                other = None if rewrite is None else rewrite(name, len(found))
                found = found if other is None else [found[i] for i in other.tolist()]
                if held and words + len(found) > BATCH_WORDS:
                    yield answer()
                    held, words = [], 0
                held.append((name, found))
                words += len(found)
        if held:
            yield answer()

    return docs.select(F.col(key), whole_text(text).alias("_text")).mapInArrow(look, schema)

"""Packing by linear grouping: few sizes, optimised configurations, best fit for the rest.

A document is its token ids and an end mark. One that is longer than a sequence is cut into whole
sequences; what is over goes first. The lengths to pack are whole numbers up to the capacity, so
their histogram has at most that many rows, whatever the number of documents. Only the histogram
reaches the driver, where the packing is planned:

1. Lengths over ``capacity / SMALL`` are large. Sorted, they are split into ``GROUPS`` groups of
   equal cardinality, and each is rounded up to the largest of its group.
2. Configurations, ways of filling a sequence with rounded sizes, are optimised as a linear
   program by column generation; the whole parts of the solution are taken.
3. Actual lengths take the places of rounded ones, the largest first. What the whole parts leave
   over and the small lengths go by best fit, longest first, into the room that is left.

The plan says for each length which sequences take it, in runs of equal sequences; it has at most
some runs per length and configuration. It is broadcast, and every piece finds its place by its
number among the pieces of its length. These numbers are counted per bucket of pieces and added up
over buckets, so no length, however common, is numbered in one task.

Defined results: a null text is empty, its document is the end mark alone. Rows are packed one by
one, also equal ones. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed, whole_text

CAPACITY = 1024
END = 2
GROUPS = 48
SMALL = 8
BUCKET_ROWS = 20_000
ROW = "_row"


# -- token ids ------------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts for a byte-level tokenizer file, as little-endian bytes.

    The file's vocabulary, whose ids are merge ranks, runs on tiktoken, which needs a fifth of the
    time. Special tokens in a text are what they are for the file's own library. Texts with
    stretches over ``LONG`` characters without white space, or of it, go to that library, whose time does not
    grow with the square of a stretch.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split, model = told["pre_tokenizer"], told["model"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        plain = split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and told["normalizer"] is None
        plain = plain and model["type"] == "BPE" and not model["ignore_merges"]
        ranks = {bytes(map(BYTE_OF.__getitem__, t)): i for t, i in model["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special) if plain else None

    @cached_property
    def slow(self):
        """The file's own library, loaded when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> bytes:
        if self.fast is None or stretched(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        elif any(s in text for s in self.special):
            ids = self.fast.encode(text, allowed_special="all")
        else:
            ids = self.fast.encode_ordinary(text)
        return array("I", ids).tobytes()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


BYTE_OF = _byte_letters()
# fixed value: the pattern by which byte-level tokenizers split texts
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 2000


def stretched(text: str) -> bool:
    """Whether a stretch without white space, or of white space alone, may be over ``LONG`` characters."""
    if len(text) <= LONG:
        return False
    lengths = [*map(len, text.split())]
    return max(lengths, default=0) > LONG or len(text) - sum(lengths) - len(lengths) > LONG


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids`` of every piece."""
    last = np.array([end], dtype="<u4").tobytes()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for at, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + last
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                for piece, to in enumerate(range(first, n + 1, capacity)):
                    start = max(0, to - capacity) if piece else 0
                    part = ids[4 * start : 4 * to]
                    for column, value in zip(rows, (at, piece, start, to - start, zlib.crc32(part), part)):
                        column.append(value)
                if len(rows[0]) >= 4096:
                    yield made(batch, rows)
                    rows = [[], [], [], [], [], []]
            if rows[0]:
                yield made(batch, rows)

    def made(batch: pa.RecordBatch, rows: list[list]) -> pa.RecordBatch:
        arrays = [batch.column(0).take(pa.array(rows[0])), pa.array(rows[1], pa.int32()), *(pa.array(x, pa.int64()) for x in rows[2:5])]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(x, "<i4") for x in rows[5]], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[key].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")).mapInArrow(of_batches, fields)


# -- the plan ---------------------------------------------------------------------------------


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Rounded size and ``(length, number)`` runs of each group, longest first; groups have equally many members."""
    total = sum(counts.values())
    share, out, room = -(-total // groups), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, []))
                room = share
            taken = min(left, room)
            out[-1][1].append((length, taken))
            left, room = left - taken, room - taken
    merged: list[tuple[int, list[tuple[int, int]]]] = []
    for size, runs in out:
        # groups that begin with the same length are one size
        if merged and merged[-1][0] == size:
            merged[-1][1].extend(runs)
        else:
            merged.append((size, runs))
    return merged


def best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The filling of one sequence that is worth most (unbounded knapsack)."""
    worth, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.nonzero(sizes <= room)[0]
        values = worth[room - sizes[fits]] + prices[fits]
        worth[room], choice[room] = worth[room - 1], -1
        if len(fits) and values.max() > worth[room] + 1e-12:
            worth[room], choice[room] = values.max(), fits[values.argmax()]
    used, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            used[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(worth[capacity]), used


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: whole parts of the optimum over fractions.

    Revised simplex with column generation, begun at one size per sequence.
    """
    s, d = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag((capacity // s).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        prices = inverse.T @ np.ones(len(s))
        value, column = best_configuration(s, prices, capacity)
        if value <= 1 + 1e-9:
            break
        x, step = inverse @ d, inverse @ column
        ratios = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratios.argmin())] = column
    amounts = np.floor(np.linalg.solve(basis, d) + 1e-9).astype(np.int64)
    return [(basis[:, i].round().astype(np.int64), int(n)) for i, n in enumerate(amounts) if n > 0]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, from_number, sequence, offset, how_many)``.

    The pieces of a length numbered from ``from_number`` on go to so many sequences one after the
    other, from ``sequence`` on, all at the same offset. Sequences that rounding leaves too empty are
    opened again and their pieces join the rest; of several limits the one is taken that needs
    fewest sequences.
    """
    counts = {int(k): int(v) for k, v in counts.items() if v}
    runs = configured(linear_groups({k: v for k, v in counts.items() if k > capacity // small}, groups), capacity)
    plans = []
    for empty in (0, capacity // 256, capacity // 64, capacity // 16, capacity):
        kept = [run for run in runs if capacity - sum(run[0]) <= empty]
        used: dict[int, int] = defaultdict(int)
        for filled, n in kept:
            for length in filled:
                used[length] += n
        plans.append(best_fit(kept, {k: v - used[k] for k, v in sorted(counts.items(), reverse=True) if v > used[k]}, capacity))
    return numbered(min(plans, key=lambda plan: sum(n for _, n in plan)))


def configured(large: list[tuple[int, list[tuple[int, int]]]], capacity: int) -> list[tuple[list[int], int]]:
    """Runs of equal sequences, as lengths and how many, from the whole parts of the optimum over rounded sizes."""
    if not large:
        return []
    runs: list[tuple[list[int], int]] = []
    stock = [list(reversed(lengths)) for _, lengths in large]
    demand = [sum(n for _, n in lengths) for _, lengths in large]
    for config, amount in configurations([size for size, _ in large], demand, capacity):
        while amount:
            # so many sequences have the same lengths in the same places
            need = {i: int(n) for i, n in enumerate(config) if n}
            times = min(amount, *(stock[i][-1][1] // n if stock[i] else amount for i, n in need.items()))
            filled = [x for i, n in need.items() for x in take(stock[i], n, max(1, times))]
            if not filled:
                break
            runs.append((filled, max(1, times)))
            amount -= max(1, times)
    return runs


def take(stock: list[tuple[int, int]], places: int, times: int) -> list[int]:
    """Lengths for places of a size in ``times`` equal sequences, the longest first. Empty places are left out."""
    out = []
    for _ in range(places):
        if stock and stock[-1][1] >= times:
            length, n = stock.pop()
            out.append(length)
            if n > times:
                stock.append((length, n - times))
    return out


def best_fit(runs: list[tuple[list[int], int]], rest: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Puts the rest, longest first, where the least room is left; runs of equal sequences are filled together."""
    rooms: list[int] = []
    by_room: dict[int, list[tuple[list[int], int]]] = defaultdict(list)

    def put(filled: list[int], n: int) -> None:
        room = capacity - sum(filled)
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append((filled, n))

    for filled, n in runs:
        put(filled, n)
    for length, left in rest.items():
        while left:
            at = bisect_left(rooms, length)
            filled, n = by_room[rooms[at]].pop() if at < len(rooms) else ([], left)
            if at < len(rooms) and not by_room[rooms[at]]:
                del rooms[at]
            each = (capacity - sum(filled)) // length
            full = min(n, left // each)
            if full:
                put(filled + [length] * each, full)
            if n > full and left > full * each:
                put(filled + [length] * (left - full * each), 1)
                left, n = full * each, n - 1
            if n > full and filled:
                put(filled, n - full)
            left -= full * each
    return [run for room in rooms for run in by_room[room]]


def numbered(runs: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    out, sequence, number = [], 0, defaultdict(int)
    for filled, n in runs:
        offset = 0
        for length in filled:
            out.append((length, number[length], sequence, offset, n))
            number[length] += n
            offset += length
        sequence += n
    return out


# -- places -----------------------------------------------------------------------------------


def count_within(pieces: DataFrame, bucket_rows: int) -> DataFrame:
    """Adds ``number``, from 0 among the pieces of equal length, by buckets of about ``bucket_rows`` pieces.

    ``_row`` numbers the pieces, equal ones too, so no row repeated without end fills a bucket.
    """
    buckets = max(1, -(-pieces.count() // bucket_rows))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(ROW), F.lit(buckets)))
    inside = Window.partitionBy("bucket", "length").orderBy(ROW)
    ahead = Window.partitionBy("l").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(F.col("bucket").alias("b"), F.col("length").alias("l")).agg(F.count("*").alias("n"))
    before = counts.select("b", "l", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    placed = dealt.withColumn("place", F.row_number().over(inside) - 1)
    joined = placed.join(before, (F.col("bucket") == F.col("b")) & (F.col("length") == F.col("l")))
    return joined.withColumn("number", F.col("place") + F.col("before")).drop("bucket", "place", "b", "l", "before")


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces, which are landed with numbers."""
    columns, schema = pieces.columns, pieces.schema
    pieces = landed(pieces.withColumn(ROW, F.monotonically_increasing_id()), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = sorted(plan(counts, capacity, groups))
    plan_arrays = pieces.sparkSession.sparkContext.broadcast(np.array(runs, dtype=np.int64).reshape(-1, 5))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, begin, sequence, offset, _ = plan_arrays.value.T
        # one sorted key for length and number
        span = int((begin + plan_arrays.value[:, 4]).max(initial=0)) + 1
        keys = length * span + begin
        for batch in batches:
            n = batch.column("number").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * span + n, side="right") - 1
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence[at] + n - begin[at]), pa.array(offset[at])], [*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return count_within(pieces, bucket_rows).mapInArrow(of_batches, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(token_pieces(docs, tokenizer, capacity, key=key, text=text, with_ids=with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of whole sequences, from pieces packed with their ids. A group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))

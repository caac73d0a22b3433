"""Nearest neighbours by a block matrix join, exact.

Vectors are packed into blocks with an 8-bit code and one scale each. Query blocks meet candidate
blocks in the cells of a grid: a query block is sent to every column, a candidate block to every
row, so each pair of blocks meets once and no cell holds more than its share of blocks. A pair of
blocks is one matrix product of codes, whose results are whole numbers and exact. With q = s c + e
for every vector, the inner product differs from the product of the coded vectors by at most
``|q| |e'| + |e| |s' c'|``. Candidates whose upper bound lies below the k-th best found so far, or
the k-th best lower bound of the tile, cannot be among the k nearest. The others are computed again
in double precision on the original vectors and merged into the best lists of the cell. The lists
of all cells are merged by query: a window with a limit, which Spark applies before and after its
shuffle. Nothing is lost: recall is 1.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite components take
no part, nor do rows with null id. A query finds candidates of as many components as it has, and
every row but those with its own id. Equal query rows count once; queries with equal id and
different vectors are answered each. Equal candidates each have a place. Ties go to the smaller id. Products of
finite vectors may be infinite; one whose terms overflow to both sides counts as the largest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclerlake.operators.places import with_places

BEST = 20
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
# what a column of the grid holds, in blocks
CELL_BLOCKS = 8
BLOCK_FIELDS = "dim int, n int, ids binary, codes binary, vectors binary"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(values, lambda x: x != 0)
    return vectors.where(F.col(key).isNotNull() & finite & some).select(F.col(key).cast("long").alias("id"), values.alias("v"))


def halved(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors by powers of two such that their largest component is between 0.5 and 1, and the powers.

    Norms and errors are taken of these, so that no finite vector is too large or too small for them.
    """
    power = np.frexp(np.abs(v).max(axis=1))[1]
    # in two steps: a power of two of its own may be out of range
    half = -power // 2
    return np.ldexp(np.ldexp(v, half[:, None]), (-power - half)[:, None]), power


def pack(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of equal length: ids, 8-bit codes and the vectors themselves."""

    def block(dim: int, ids: list[np.ndarray], rows: list[np.ndarray]) -> dict:
        v = np.concatenate(rows)
        scaled, _ = halved(v)
        codes = np.rint(scaled / (np.abs(scaled).max(axis=1, keepdims=True) / 127)).astype(np.int8)
        return {"dim": dim, "n": len(v), "ids": np.concatenate(ids).tobytes(), "codes": codes.tobytes(), "vectors": v.tobytes()}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("codes", pa.binary()), ("vectors", pa.binary())])
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            all_ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = lists.value_lengths().to_numpy()
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
            for dim in np.unique(lengths).tolist():
                at = np.nonzero(lengths == dim)[0]
                rows = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                for i in range(0, len(at), size):
                    ids, kept = waiting.setdefault(dim, ([], []))
                    ids.append(all_ids[at[i : i + size]])
                    kept.append(rows[i : i + size])
                    while sum(map(len, ids)) >= size:
                        ready, v = np.concatenate(ids), np.concatenate(kept)
                        yield pa.RecordBatch.from_pylist([block(dim, [ready[:size]], [v[:size]])], schema)
                        ids, kept = waiting[dim] = ([ready[size:]], [v[size:]]) if len(ready) > size else ([], [])
        for dim, (ids, kept) in waiting.items():
            if ids:
                yield pa.RecordBatch.from_pylist([block(dim, ids, kept)], schema)

    return vectors.select("id", "v").mapInArrow(packed, BLOCK_FIELDS)


class Coded:
    """A block with what the bounds need: coded vectors, their norms, and the norms of what the code leaves out."""

    def __init__(self, dim: int, ids: bytes, codes: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.v = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        whole = np.frombuffer(codes, np.int8).reshape(-1, dim)
        # sums of whole numbers: exact in single precision up to 1040 components
        self.codes = whole.astype(np.float32 if dim <= 1040 else np.float64)
        scaled, self.power = halved(self.v)
        scale = np.abs(scaled).max(axis=1) / 127
        coded = whole * scale[:, None]
        parts = [scale, *(np.sqrt((x**2).sum(axis=1)) for x in (scaled, coded, scaled - coded))]
        # of the vectors by powers of two
        self.scaled = parts
        with np.errstate(over="ignore", under="ignore"):
            self.scale, self.norm, self.coded_norm, self.error = (np.ldexp(x, self.power) for x in parts)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Added up component by component, so that a pair's result depends on nothing else."""
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        total += x * y
    return total


class BestLists:
    """The best so far of each query of a block."""

    def __init__(self, queries: Coded, best: int):
        self.queries, self.best = queries, best
        self.lists: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.floor = np.full(len(queries.ids), -np.inf)

    def add(self, c: Coded) -> None:
        q = self.queries
        (q_scale, q_norm, _, q_error), (c_scale, c_norm, c_coded, c_error) = q.scaled, c.scaled
        near = (q.codes @ c.codes.T).astype(np.float64) * q_scale[:, None] * c_scale
        room = q_norm[:, None] * c_error + q_error[:, None] * c_coded
        # double precision rounds too
        room += 1e-12 * q_norm[:, None] * c_norm
        with np.errstate(over="ignore", invalid="ignore", under="ignore"):
            if max(np.abs(q.power).max(), np.abs(c.power).max()) < 400:
                back = np.ldexp(1.0, q.power)[:, None] * np.ldexp(1.0, c.power)
                near, room = near * back, room * back
            else:
                back = q.power[:, None] + c.power
                near, room = np.ldexp(near, back), np.ldexp(room, back)
            # products that are too small for double precision are off by one of its smallest numbers each
            room += 1e-318 * q.v.shape[1]
            own = q.ids[:, None] == c.ids
            low, high = near - room, near + room
            low = np.where(own | ~np.isfinite(low), -np.inf, low)
            floor = self.floor
            if low.shape[1] >= self.best:
                floor = np.maximum(floor, np.partition(low, -self.best, axis=1)[:, -self.best])
            # a bound that is not finite says nothing
            at, which = np.nonzero(~(high < floor[:, None]) & ~own)
            scores = inner_products(q.v[at], c.v[which])
        scores = np.where(np.isnan(scores), np.inf, scores)
        cuts = np.searchsorted(at, np.arange(len(q.ids) + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                found = zip(scores[a:b].tolist(), (-c.ids[which[a:b]]).tolist())
                kept = self.lists[i] = heapq.nlargest(self.best, [*self.lists[i], *found])
                if len(kept) == self.best:
                    self.floor[i] = kept[-1][0]

    def rows(self, name: int) -> pa.RecordBatch:
        counts = [len(x) for x in self.lists]
        ids = np.repeat(self.queries.ids, counts)
        line = np.repeat(np.arange(len(counts)), counts)
        flat = [x for kept in self.lists for x in kept]
        arrays = [np.full(len(flat), name, np.int64), line.astype(np.int32), ids, np.array([-x[1] for x in flat], np.int64), np.array([x[0] for x in flat], np.float64)]
        return pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["block", "line", "query_id", "vec_id", "score"])


def search_cells(best: int):
    def of_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, lists = None, None
        for batch in batches:
            for tile in batch.to_pylist():
                if tile["block"] != name:
                    if lists is not None:
                        yield lists.rows(name)
                    name, lists = tile["block"], BestLists(Coded(tile["dim"], tile["q_ids"], tile["q_codes"], tile["q_vectors"]), best)
                lists.add(Coded(tile["dim"], tile["ids"], tile["codes"], tile["vectors"]))
        if lists is not None:
            yield lists.rows(name)

    return of_tiles


def nearest(
    vectors: DataFrame,
    is_query: Column,
    best: int = BEST,
    key: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
    cell_blocks: int = CELL_BLOCKS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``best`` largest inner products of every query row."""
    spark = vectors.sparkSession
    queries = usable(vectors.where(is_query), key, vector).dropDuplicates(["id", "v"])
    # numbered one by one, so that cells are equally large
    blocks = with_places(pack(usable(vectors, key, vector), candidate_block), name="block")
    asked = with_places(pack(queries, query_block), name="block")
    columns = max(1, -(-blocks.count() // cell_blocks), spark.sparkContext.defaultParallelism)
    lines = max(1, -(-asked.count() // cell_blocks))
    left = asked.select("dim", "block", *(F.col(c).alias(f"q_{c}") for c in ("ids", "codes", "vectors")), (F.col("block") % lines).cast("int").alias("line"))
    left = left.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = blocks.withColumn("column", (F.col("block") % columns).cast("int")).drop("n", "block")
    right = right.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1))))
    cells = left.join(right, ["line", "column", "dim"]).sortWithinPartitions("line", "column", "block")
    tiles = cells.select("dim", "block", "q_ids", "q_codes", "q_vectors", "ids", "codes", "vectors")
    found = tiles.mapInArrow(search_cells(best), "block long, line int, query_id long, vec_id long, score double")
    order = Window.partitionBy("block", "line").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("query_id", "rank", "vec_id", "score")

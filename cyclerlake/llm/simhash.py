"""SimHash near-dedup by anchor-point covering.

A document's fingerprint has 64 bits: bit b is set when it is set in over half of the hashes
(XXH64, seed 42) of the document's word shingles. Fingerprints that differ in at most two bits
are linked, and documents of a connected component belong together.

Anchors are the words of the binary Hamming code of length 63, a perfect covering code: every
63-bit word is within radius 1 of exactly one of them. Two fingerprints within two bits have a
word halfway, at most one bit from both, whose anchor is at most one bit further. So both lie
within two bits of a common anchor, that is the covering radius plus half the threshold, and it is
enough to replicate a fingerprint to the anchors that near: one if it is an anchor itself, else 32.
The 64th bit takes no part in the choice of anchors; comparing is on all 64.

At most 2 * (1 + 63 + 1953) different fingerprints can be that near to one anchor, and at most 2080
can be linked to one. So neither a task nor the number of links grows with the square of a group of
copies, whatever the size of the group. Documents with equal fingerprints are one before that.

Defined results: null and empty texts, and texts without words, have fingerprint 0 and are linked
like others. Ids may be null or repeat; a component's id is the smallest id that is not null. An
empty table gives no rows. Other columns are not read, or passed through by ``near_deduplicate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
# a very long text is taken in pieces of about so many bytes
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + piece)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def shingle_hashes(data: bytes, words: int, piece: int = PIECE) -> Iterator[np.ndarray]:
    """Hashes of all word shingles of a text, repeats included; of the whole sequence if it is shorter."""
    tail: list[bytes] = []
    some = False
    for found in word_pieces(data, piece):
        tail += found
        if len(tail) < words:
            continue
        some = True
        line = b" ".join(tail)
        ends = np.cumsum([len(w) + 1 for w in tail])
        starts = np.concatenate(([0], ends[:-words])).tolist()
        digest = xxhash.xxh64_intdigest
        yield np.array([digest(line[a:b], HASH_SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], dtype=np.uint64)
        tail = tail[len(tail) - words + 1 :]
    if tail and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), HASH_SEED)], dtype=np.uint64)


def simhash(data: bytes, words: int = SHINGLE_WORDS, piece: int = PIECE) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8."""
    set_bits, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(data.lower(), words, piece):
        for some in np.array_split(hashes, len(hashes) // 65536 + 1):
            set_bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``id, mark, print`` for every row; ``mark`` tells different texts under one id apart."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(x.as_buffer().to_pybytes() if x.is_valid else b"", words) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["id", "mark", "print"])

    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("id"), mark_of(text), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(of_batches, f"id {kind}, mark long, print long")


def mark_of(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string")).alias("mark")


def anchors_near(fingerprint: Column) -> Column:
    """The anchors within two bits of a fingerprint, as an array.

    Bit p - 1 stands for position p of the code. The syndrome is the exclusive-or of the set
    positions. Flipping one position that equals it, or two whose exclusive-or equals it, gives an
    anchor; the pair (0, syndrome) stands for the first case.
    """
    body = fingerprint.bitwiseAND(F.lit((1 << 63) - 1))
    syndrome = F.lit(0)
    for k in range(6):
        mask = sum(1 << (p - 1) for p in range(1, 64) if p >> k & 1)
        syndrome = syndrome + (F.bit_count(body.bitwiseAND(F.lit(mask))) % 2) * (1 << k)
    flip = lambda p: F.when(p == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), p - 1))
    pairs = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda p: p < p.bitwiseXOR(syndrome))
    near = F.transform(pairs, lambda p: body.bitwiseXOR(flip(p)).bitwiseXOR(flip(p.bitwiseXOR(syndrome))))
    return F.when(syndrome == 0, F.array(body)).otherwise(near)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints in column ``print`` that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("these anchors serve thresholds up to two bits")
    near = prints.select("print", F.explode(anchors_near(F.col("print"))).alias("anchor"))
    left, right = near.select("anchor", F.col("print").alias("a")), near.select("anchor", F.col("print").alias("b"))
    linked = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return left.hint("merge").join(right, "anchor").where(linked).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``print, root`` for every fingerprint with links; root is the smallest one that can be reached.

    Each round takes the smallest root among neighbours, then the root's root, so that paths shorten
    by more than half. Rounds are landed in the shared folder.
    """
    both = landed(edges.union(edges.select("b", "a")).toDF("print", "other"), "simhash-edges")
    state = landed(both.groupBy("print").agg(F.least(F.min("other"), F.col("print")).alias("root")), "simhash-roots")
    while True:
        heard = both.join(state.select(F.col("print").alias("other"), F.col("root").alias("heard")), "other")
        heard = heard.groupBy("print").agg(F.min("heard").alias("heard"))
        told = state.join(heard, "print").select("print", F.col("root").alias("before"), F.least("root", "heard").alias("next"))
        up = state.select(F.col("print").alias("next"), F.col("root").alias("above"))
        after = told.join(up, "next").select("print", "before", F.least("next", "above").alias("root"))
        after = landed(after, "simhash-roots")
        state = after.select("print", "root")
        if after.where("root < before").isEmpty():
            return state


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; the fingerprint as 16 hex digits."""
    prints, groups = grouped(docs, key, text, words, max_bits)
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(groups, "print").select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("best.id").alias("component_id"))


def grouped(docs: DataFrame, key: str, text: str, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``id, mark, print`` of every row, and ``print, best``: the row of the print's component with the smallest id."""
    prints = landed(fingerprints(docs, key, text, words), "simhash-prints")
    rank = F.struct(F.col("id").isNull().alias("missing"), "id", "mark")
    nodes = landed(prints.groupBy("print").agg(F.min(rank).alias("first")), "simhash-nodes")
    roots = components(landed(links(nodes, max_bits), "simhash-links"))
    joined = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = joined.groupBy("root").agg(F.min("first").alias("best"))
    return prints, landed(joined.join(least, "root").select("print", "best"), "simhash-groups")


def near_deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns."""
    prints, groups = grouped(docs, key, text, words, max_bits)
    best = groups.select(F.col("best.id").alias("best_id"), F.col("best.mark").alias("best_mark")).distinct()
    is_best = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("mark") == F.col("best_mark"))
    stay = prints.join(best, is_best).groupBy("best_id", "best_mark").agg(F.count("*").alias("copies"))
    stay = landed(stay, "simhash-kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(key).alias("id"), mark_of(text))
    found = rows.join(stay, is_best)
    if stay.where("copies > 1").isEmpty():
        return found.select("doc.*")
    # rows equal in id and text: any one of them
    repeated = found.where("copies > 1").groupBy("best_id", "best_mark").agg(F.first("doc").alias("doc"))
    return found.where("copies = 1").select("doc.*").unionByName(repeated.select("doc.*"))

"""Exact dedup by a heavy-hitter split.

Texts are equal when they are identical after each run of white space becomes one space. A
Misra-Gries summary of the digests (``freqItems``) finds every digest that more than a share
``support`` of the rows carry, among at most ``1 / support`` candidates. Counting the candidates
exactly verifies them and finds their winners; that table has at most ``1 / support`` rows, so it
is broadcast and copies of frequent texts are settled where they are read. Every other digest goes
through an ordinary shuffle: winners and sizes by partial aggregation, and a join that gives them
to the rows, whose large keys adaptive execution can split.

Defined results: a null text counts as empty. The row with the smallest id stays, null ids come
last; of rows with equal id and text exactly one stays. An empty table gives no rows. Other
columns are passed through (``deduplicate``) or not read (``duplicates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclerlake.llm.common import SPACE, landed, whole_text

SUPPORT = 1 / 1024


def digest_of(text: str) -> Column:
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(F.regexp_replace(whole_text(text), SPACE, " ").cast("binary"), 256)


def _rank(key: str, *more: str) -> Column:
    """Orders rows by id with nulls last."""
    return F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("id"), *more)


def heavy_hitters(digests: DataFrame, rank: Column, support: float = SUPPORT) -> DataFrame:
    """``digest, best, copies`` of the frequent digests, counted exactly. At most ``1 / support`` rows."""
    found = digests.freqItems(["digest"], support)
    candidates = found.select(F.explode(found.columns[0]).alias("digest")).distinct()
    winners = (
        digests.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(rank).alias("best"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    return landed(winners, "dedup-winners")


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = landed(
        docs.select(F.col(key).alias("id"), digest_of(text).alias("digest")).withColumn("row", F.monotonically_increasing_id()),
        "dedup-digests",
    )
    rank = _rank("id", "row")
    winners = heavy_hitters(digests, rank, support)
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = rest.join(rest.groupBy("digest").agg(F.min(rank).alias("best"), F.count("*").alias("copies")), "digest")
    return hot.unionByName(rest).select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns. Full rows are shuffled once."""
    digests = landed(docs.select(F.col(key).alias("id"), digest_of(text).alias("digest")), "dedup-digests")
    winners = heavy_hitters(digests, _rank("id"), support)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(key).alias("id"), digest_of(text).alias("digest"))
    frequent = F.broadcast(winners.select("digest", "best"))
    hot = rows.join(frequent, "digest").where(F.col("id").eqNullSafe(F.col("best.id")))
    rest = digests.join(frequent, "digest", "left_anti").groupBy("digest").agg(F.min(_rank("id")).alias("best"))
    # one key for text and id: rows that still share it are equal in both, and lie together after the join
    kept = rest.select(_place("digest", "best.id").alias("place"))
    cold = rows.join(frequent, "digest", "left_anti").withColumn("place", _place("digest", "id")).join(kept, "place", "left_semi")
    hot = hot.groupBy("digest").agg(F.first("doc").alias("doc"))
    return hot.select("doc.*").unionByName(cold.groupBy("place").agg(F.first("doc").alias("doc")).select("doc.*"))


def _place(digest: str, key: str) -> Column:
    return F.concat_ws(":", F.col(digest), F.col(key).isNull().cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("")))

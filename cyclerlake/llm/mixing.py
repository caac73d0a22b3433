"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations.

A source's target is its share of all words by weight, but at most ``LIMIT`` times what it has;
the excess is shared again among the others. Targets are counted in equal blocks of words, which
go to the sources by highest quotients ``target / (2k + 1)``, then in the same way to districts of
a source and to the shards of a district. A shard is about ``shard_words`` words of one source in
a seeded order. Its quota is met by whole passes over the shard and, for the rest, a run of blocks
that begins at a seeded block. As the order is seeded already, the run is a random choice of
documents and cuts at most two of them.

No window holds more than a shard, the shards of a district, the districts of a source or the
sources, so a source with a third of all words is spread over as many tasks as it has shards.

Defined results: null text and texts without words have size 0 and take no part. A null source is
a source, the last one. An empty table gives no rows. Rows with equal id and text are told apart
by nothing, so any of them may be the one that is taken. Rows of an id that more than half a shard's rows carry are
spread over shards one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed, word_count

WEIGHTS = (1, 2, 3)
LIMIT = 3
BLOCK_WORDS = 8
SHARD_WORDS = 250_000
SHARD_ROWS = 50_000
DISTRICT = 1024
SEED = 7
SUPPORT = 1 / 1024


def seeded(seed: int, *parts: Column) -> Column:
    """A number below 2^32 that depends on the seed and the parts alone."""
    text = F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds weight and target to ``source, source_size``. One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    step = sources.select("*", weight.cast("long").alias("weight"), F.sum("source_size").over(everything).alias("total"))
    step = step.withColumn("cap", F.col("source_size") * limit).withColumn("room", F.col("cap") / F.col("weight"))
    step = step.select(
        "*",
        F.row_number().over(by_room).alias("place"),
        (F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")).alias("filled"),
        (F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))).alias("open"),
    )
    # the level at which the sources from here on share what the earlier, full ones leave
    step = step.withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
    fits = F.when(F.col("level") <= F.col("room"), F.struct("place", "level"))
    step = step.withColumn("level", F.min(fits).over(everything)["level"])
    return step.withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")))


def sainte_lague(units: DataFrame, group: list[str], unit: str, weight: str, seats: str) -> DataFrame:
    """Shares each group's ``seats`` among its units by highest quotients; adds column ``quota``.

    Rounding every unit's exact share misses the number of seats by at most half a seat per unit,
    which moves a unit by at most its share of that and one seat. So only the quotients near the
    exact share are listed, a fixed number per unit on average; those below are won for certain.
    """
    whole = Window.partitionBy(*group)
    of = units.withColumn("all_weight", F.sum(weight).over(whole)).withColumn("n_units", F.count("*").over(whole))
    share = F.when(F.col("all_weight") > 0, F.col(weight) / F.col("all_weight")).otherwise(F.lit(0.0))
    of = of.withColumn("exact", F.floor(F.col(seats) * share)).withColumn("slack", F.ceil(F.col("n_units") * share * 1.5) + 2)
    of = of.withColumn("sure", F.greatest(F.lit(0).cast("long"), F.col("exact") - F.col("slack")))
    of = of.withColumn("left", F.col(seats) - F.sum("sure").over(whole))
    listed = of.select("*", F.explode(F.sequence("sure", F.col("exact") + F.col("slack"))).alias("seat"))
    order = Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("seat") + 1)).desc(), F.col(unit).asc_nulls_last(), "seat")
    won = (F.row_number().over(order) <= F.col("left")) & (F.col(weight) > 0)
    kept = listed.withColumn("won", won.cast("long"))
    return kept.groupBy(*units.columns).agg((F.first("sure") + F.sum("won")).alias("quota"))


def plan_sources(sized: DataFrame, block_words: int, shard_words: int, shard_rows: int, weights: tuple[int, ...], limit: int) -> DataFrame:
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / shard_rows)).cast("long")
    planned = targets(sources, weights, limit).select(
        "source", "source_size", "target", shards.alias("shards"), F.round(F.col("total") / block_words).cast("long").alias("seats")
    )
    return landed(sainte_lague(planned, [], "source", "target", "seats"), "mix-sources")


def plan_shards(placed: DataFrame) -> DataFrame:
    """Quota and words of each shard. ``placed`` has source, quota of the source, shard, size."""
    shards = placed.groupBy("source", "quota", "shard").agg(F.sum("size").alias("words"))
    shards = landed(shards.withColumn("district", F.floor(F.col("shard") / DISTRICT)), "mix-shards")
    districts = shards.groupBy("source", "quota", "district").agg(F.sum("words").alias("words"))
    districts = sainte_lague(districts.withColumnRenamed("quota", "seats"), ["source"], "district", "words", "seats")
    districts = landed(districts.select(F.col("source").alias("s"), F.col("district").alias("d"), F.col("quota").alias("seats")), "mix-districts")
    joined = shards.drop("quota").join(districts, F.col("source").eqNullSafe(F.col("s")) & (F.col("district") == F.col("d")))
    shared = sainte_lague(joined.drop("s", "d"), ["source", "district"], "shard", "words", "seats")
    return landed(shared.select("source", "shard", "words", "quota"), "mix-quotas")


def hot_ids(rows: DataFrame, most: int, support: float = SUPPORT) -> list[str]:
    """Ids on more than ``most`` rows, as far as they have a share of ``support`` of all; at most ``1 / support`` of them."""
    found = rows.select(F.coalesce("id", F.lit("")).alias("id")).freqItems(["id"], support)
    candidates = found.select(F.explode(found.columns[0]).alias("id")).distinct()
    counts = rows.select(F.coalesce("id", F.lit("")).alias("id")).join(F.broadcast(candidates), "id").groupBy("id").count()
    return [r["id"] for r in counts.where(F.col("count") > most).collect()]


def with_spin(rows: DataFrame, seed: int, shard_rows: int) -> DataFrame:
    """Adds the place in the seeded order. Rows of one id follow each other, unless there are too many for a shard."""
    spin = seeded(seed, F.col("id"))
    if hot := hot_ids(rows, shard_rows // 2):
        # landed, for the number of a row must not change
        rows = landed(rows.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
        spin = F.when(F.coalesce("id", F.lit("")).isin(hot), seeded(seed, F.col("id"), F.col("row"))).otherwise(spin)
    return rows.withColumn("spin", spin)


def mix(
    docs: DataFrame,
    size: Column | None = None,
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Columns doc (a struct of the row), size, source_size, target, taken, one row per row of ``docs``."""
    size = word_count("text") if size is None else size
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col(key).cast("string").alias("id"),
        F.col(source).alias("source"),
        size.cast("long").alias("size"),
    )
    rows = with_spin(rows, seed, shard_rows)
    sources = plan_sources(rows.select("source", "size"), block_words, shard_words, shard_rows, weights, limit)
    sources = sources.withColumnRenamed("source", "s")
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).withColumn("shard", F.col("spin") % F.col("shards"))
    quotas = plan_shards(placed.select("source", "quota", "shard", "size")).select(
        F.col("source").alias("q"), F.col("shard").alias("h"), "words", F.col("quota").alias("blocks")
    )
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("q")) & (F.col("shard") == F.col("h")))
    order = Window.partitionBy("source", "shard").orderBy("spin", F.col("id").asc_nulls_last(), "size")
    return select_blocks(placed.withColumn("to", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))), block_words, limit, seed)


def select_blocks(placed: DataFrame, block_words: int, limit: int, seed: int) -> DataFrame:
    """Words taken of each document that ends at word ``to`` of its shard."""
    words = F.greatest(F.lit(1).cast("long"), F.col("words"))
    step = placed.withColumn("won", F.least(F.col("blocks") * block_words, F.col("words") * limit))
    step = step.withColumn("passes", F.floor(F.col("won") / words)).withColumn("run", F.col("won") % words)
    step = step.withColumn("first", seeded(seed, F.lit("first"), F.col("source"), F.col("shard")) % F.ceil(words / block_words) * block_words)
    begin, zero, end = F.col("to") - F.col("size"), F.lit(0).cast("long"), F.col("first") + F.col("run")
    # blocks run on from the end of a shard to its beginning, so all are of equal size
    ahead = F.least("to", end) - F.greatest(begin, F.col("first"))
    around = F.least(F.col("to"), end - F.col("words")) - begin
    taken = F.col("passes") * F.col("size") + F.greatest(zero, ahead) + F.greatest(zero, around)
    return step.select("doc", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: each as often as it is taken, to the nearest whole number."""
    taken = mix(docs, **options).where("size > 0")
    copies = F.round(F.col("taken") / F.col("size")).cast("int")
    return taken.select(F.explode(F.array_repeat("doc", copies)).alias("doc")).select("doc.*")

"""Main records with their auxiliary channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclerlake.functions.predicates import quoted
from cyclerlake.operators.chunks import (
    CHUNK,
    COPIES,
    Layout,
    Measured,
    SIDE,
    both_sides,
    chunk_counts,
    collapse_copies,
    cut_side,
    expand_copies,
    joined_counts,
    measure,
    sign_sums,
    split_hot,
    with_chunk,
)
from cyclerlake.operators.features import IS_START, Parts, number_steps, summarise
from cyclerlake.operators.snapshot import frozen, frozen_hot, last_place
from cyclerlake.session import landed

# so many step starts (their keys are below 10 MB) are broadcast to find the channels they meet
BROADCAST_STARTS = 100_000


def _right_names(main: DataFrame, aux: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Auxiliary columns that main has too get the suffix ``_right``."""
    return aux.withColumnsRenamed({c: f"{c}_right" for c in aux.columns if c in main.columns and c not in keys})


def _hot_join(main: DataFrame, aux: DataFrame, keys: Sequence[str], hot: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of hot chunks on collapsed copies.

    Both sides of a chunk are cut by content into as many parts as its join needs tasks for, so
    that also the pairs of one id are spread. Matches and misses are computed apart: adaptive
    execution can split an inner join on whichever side is skewed, a left join only on its left.
    """
    few_main, few_aux = collapse_copies(main), collapse_copies(aux)
    left = cut_side(few_main, hot, by, "_main_part", "_aux_part")
    right = cut_side(few_aux.withColumnRenamed(COPIES, "_aux_copies"), hot, by, "_aux_part", "_main_part")
    pairs = left.join(right, [*keys, "_main_part", "_aux_part"], "inner")
    pairs = pairs.withColumn(COPIES, F.expr(f"{COPIES} * _aux_copies")).drop("_aux_copies", "_main_part", "_aux_part")
    misses = few_main.join(few_aux.select(*keys).distinct(), keys, "left_anti")
    return pairs.unionByName(misses, allowMissingColumns=True)


def _frozen_sides(sides: DataFrame, cold: Sequence[DataFrame], hot: Sequence[DataFrame | None], by: Sequence[str], measured: Measured):
    """Both sides of a join as the narrow pass saw them: cold ones, laid out, and hot ones."""
    done_cold, done_hot = [], []
    for side, cold_rows, hot_rows in zip(("main", "aux"), cold, hot):
        marks = sides.where(F.col(SIDE) == side)
        few, _ = split_hot(marks, measured.hot, by)
        done_cold.append(frozen(cold_rows, few, by, measured))
        done_hot.append(frozen_hot(hot_rows, marks, measured.hot, by))
    return done_cold, done_hot


def join_aux(main: DataFrame, aux: DataFrame, by: Sequence[str] = (), layout: Layout = Layout(), snapshot: bool = False) -> DataFrame:
    """Left join on test and ``seq_id``; a record with several channels yields several rows.

    With ``snapshot`` both sides are as the pass that counts them saw them, or the result fails.
    """
    keys = ["seq_id", CHUNK, *reversed(by)]
    columns = main.columns
    main, aux = with_chunk(main, layout), with_chunk(_right_names(main, aux, keys), layout)
    more = [[last_place(side)] if snapshot else [] for side in (main, aux)]
    sides = both_sides(chunk_counts(main, by, more[0]), chunk_counts(aux, by, more[1]))
    sides = landed(sides, "chunk-sides") if snapshot else sides
    measured = measure(landed(joined_counts(sides, by), "chunk-counts"), by, layout)
    hot = measured.hot
    (cold_main, hot_main), (cold_aux, hot_aux) = split_hot(main, hot, by), split_hot(aux, hot, by)
    place = [CHUNK, *reversed(by)]
    if snapshot:
        (cold_main, cold_aux), (hot_main, hot_aux) = _frozen_sides(sides, (cold_main, cold_aux), (hot_main, hot_aux), by, measured)
    elif measured.partitions is not None:
        cold_main, cold_aux = measured.lay_out(cold_main, place), measured.lay_out(cold_aux, place)
    hot_joined = None
    if hot is not None:
        hot_joined = expand_copies(_hot_join(hot_main, hot_aux, keys, hot, by), partitions=measured.partitions)
    joined = Parts(cold_main.join(cold_aux, keys, "left"), hot_joined).whole()
    extra = [c for c in joined.columns if c not in columns]
    return joined.select(*map(quoted, [*columns, *extra]))


def join_aux_with_steps(
    main: DataFrame,
    aux: DataFrame,
    by: Sequence[str],
    layout: Layout = Layout(),
    scope: str = "row",
    total_time: bool = True,
    snapshot: bool = False,
) -> DataFrame:
    """Join the channels and number the steps.

    With scope ``row`` the joined rows are numbered, with ``record`` the records before the join.
    Both sides are laid out by test and chunk once; join and step window share that layout, so
    the full rows of either side are shuffled a single time (see ``session.tune``). With ``snapshot``
    every pass reads the records that the first one saw, or the result fails.
    """
    # the most selective key first: sorts then rarely compare further ones
    keys = ["seq_id", CHUNK, *reversed(by)]
    place = [CHUNK, *reversed(by)]
    main, aux = with_chunk(main, layout), with_chunk(_right_names(main, aux, keys), layout)

    # one narrow pass over each side: what chunks contribute, and which are too large
    more = [[last_place(side)] if snapshot else [] for side in (main, aux)]
    sides = both_sides(summarise(main, place, total_time, [*sign_sums(), *more[0]]), chunk_counts(aux, by, more[1]))
    sides = landed(sides, "chunk-summary")
    measured = measure(landed(joined_counts(sides, by), "chunk-counts"), by, layout)
    hot = measured.hot
    (cold_main, hot_main), (cold_aux, hot_aux) = split_hot(main, hot, by), split_hot(aux, hot, by)
    summary, _ = split_hot(sides.where("_side = 'main'"), hot, by)
    if snapshot:
        (laid_main, laid_aux), (hot_main, hot_aux) = _frozen_sides(sides, (cold_main, cold_aux), (hot_main, hot_aux), by, measured)
        cold_main, cold_aux = laid_main, laid_aux
    else:
        laid_main, laid_aux = measured.lay_out(cold_main, place), measured.lay_out(cold_aux, place)
    options = {"layout": layout, "measured": measured, "laid_out": True, "total_time": total_time}

    if scope == "record":
        steps = number_steps(laid_main, summary, hot_main, by, **options)
        joined, hot_joined = steps.cold.join(laid_aux, keys, "left"), None
        if hot is not None:
            hot_joined = expand_copies(_hot_join(steps.hot, hot_aux, keys, hot, by), partitions=measured.partitions)
        return Parts(joined, hot_joined).whole()

    # Joining repeats a record per channel and counts its step start as often. Only step starts
    # need joining to know how often, so this pass over narrow columns does not join everything.
    starts = cold_main.where(IS_START).select(*keys)
    met = cold_aux.select(*keys)
    if summary.agg(F.expr("coalesce(sum(_zeros), 0L)")).first()[0] <= BROADCAST_STARTS:
        # few starts: channels of other records are not shuffled
        starts = landed(starts, "step-starts")
        met = met.join(F.broadcast(starts.distinct()), keys, "left_semi")
    started = measured.lay_out(starts, place).join(measured.lay_out(met, place), keys, "left")
    zeros = started.groupBy(*place).agg(F.expr("count(*) AS _zeros"))
    summary = (
        summary.drop("_zeros")
        .unionByName(zeros, allowMissingColumns=True)
        .groupBy(*place)
        .agg(
            F.expr("coalesce(sum(_zeros), 0L) AS _zeros"),
            *(F.expr(f"max({c}) AS {c}") for c in ("_start", "_first", "_t0")),
        )
    )
    if measured.chunks > layout.block_chunks:
        # blocks of chunks and chunks read it: landed, so that the sides are joined for it once
        summary = landed(summary, "chunk-zeros")
    joined = laid_main.join(laid_aux, keys, "left")
    hot_joined = None if hot is None else _hot_join(hot_main, hot_aux, keys, hot, by)
    return number_steps(joined, summary, hot_joined, by, **options).whole()

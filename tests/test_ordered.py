"""Streams whose records arrive out of order, against the batch operators."""

import random

import pytest
from pyspark.errors import StreamingQueryException

import cyclerlake as cl
from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import add_step_features
from cyclerlake.operators.joins import join_aux, join_aux_with_steps
from cyclerlake.streaming.ordered import finish, ordered_batch, read_ordered, stream_ordered
from cyclerlake.streaming.steps import LateRecordsError

MAIN = "test long, seq_id long, test_time long, unix_time long"
AUX = "test long, seq_id long, auxchl_id long, test_tmp long"
FINE = Layout(chunk_records=7)


def rows(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


def main_rows(seed, n=60):
    chance = random.Random(seed)
    out = [(t, s, chance.choice([0, 0, 1, 5]), 1000 + s * 7) for t in (1, 2, None) for s in range(1, n) if chance.random() < 0.9]
    return out + [(1, 9, 0, 1063), (1, 9, 0, 1063), (2, None, 0, 9)]


def aux_rows(seed, n=60):
    chance = random.Random(seed + 1)
    return [(t, s, c, chance.randrange(99)) for t in (1, 2, None) for s in range(1, n) for c in (1, 2) if chance.random() < 0.6] + [(1, None, 1, 5)]


def arrivals(rows, bound, parts, seed=0):
    """Parts in which no record comes more than ``bound`` numbers after a later one."""
    chance = random.Random(seed)
    placed = sorted(((r[1] or -99) + chance.random() * bound, r) for r in sorted(rows, key=str))
    size = -(-len(placed) // parts)
    out = [[r for _, r in placed[i * size : (i + 1) * size]] for i in range(parts)]
    for part in out:
        chance.shuffle(part)
    return out


def landed_parts(spark, folder, parts, schema):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return cl.FileTables(spark, {"in": folder}, files_per_batch=1).stream("in")


@pytest.mark.parametrize(("scope", "layout"), [("row", Layout()), ("row", FINE), ("record", FINE)])
def test_streams_out_of_order_equal_batch(spark, tmp_path, scope, layout):
    main, aux = main_rows(1), aux_rows(1)
    streams = [landed_parts(spark, f"{tmp_path}/{name}", arrivals(r, 12, 4), s) for name, r, s in (("main", main, MAIN), ("aux", aux, AUX))]
    out = f"{tmp_path}/out"
    stream_ordered(*streams, ["test"], out, 12, layout, scope).awaitTermination()
    want = join_aux_with_steps(spark.createDataFrame(main, MAIN), spark.createDataFrame(aux, AUX), ["test"], scope=scope)
    early = rows(read_ordered(spark, out), want.columns)
    assert 0 < len(early) < want.count() and set(early) <= set(rows(want))
    finish(spark, ["test"], out, layout, scope)
    assert rows(read_ordered(spark, out), want.columns) == rows(want)
    finish(spark, ["test"], out, layout, scope)
    assert rows(read_ordered(spark, out), want.columns) == rows(want)


def test_a_stream_may_go_on_after_it_was_finished(spark, tmp_path):
    main = main_rows(2)
    parts = arrivals(main, 9, 4)
    out, folder = f"{tmp_path}/out", f"{tmp_path}/in"
    stream = landed_parts(spark, folder, parts[:2], MAIN)
    stream_ordered(stream, None, ["test"], out, 9, FINE).awaitTermination()
    finish(spark, ["test"], out, FINE)
    half = add_step_features(spark.createDataFrame(parts[0] + parts[1], MAIN), ["test"])
    assert rows(read_ordered(spark, out), half.columns) == rows(half)
    stream = landed_parts(spark, folder, parts[2:], MAIN)
    stream_ordered(stream, None, ["test"], out, 9, FINE).awaitTermination()
    finish(spark, ["test"], out, FINE)
    want = add_step_features(spark.createDataFrame(main, MAIN), ["test"])
    assert rows(read_ordered(spark, out), want.columns) == rows(want)


def test_later_than_the_bound_is_an_error(spark, tmp_path):
    stream = landed_parts(spark, f"{tmp_path}/in", [[(1, 30, 0, 5), (1, 20, 0, 4)], [(1, 25, 0, 3), (2, 1, 0, 3)], [(1, 24, 0, 5)]], MAIN)
    with pytest.raises(StreamingQueryException, match="out of order by more than 5"):
        stream_ordered(stream, None, ["test"], f"{tmp_path}/out", 5).awaitTermination()
    with pytest.raises(ValueError):
        ordered_batch([], "", -1)


def test_null_numbers_after_a_release_are_late(spark, tmp_path):
    schema = "seq_id long, test_time long, _side string"
    run = ordered_batch([], str(tmp_path), 2)
    run(spark.createDataFrame([(1, 0, "main"), (5, 0, "main")], schema), 0)
    with pytest.raises(LateRecordsError):
        run(spark.createDataFrame([(None, 0, "main")], schema), 1)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = "test long, seq_id long, test_time long, unix_time long, _side string"
    parts = [[(*r, "main") for r in part] for part in arrivals(main_rows(3), 6, 3)]
    run, out = ordered_batch(["test"], str(tmp_path), 6, FINE), str(tmp_path)
    for number, part in enumerate(parts):
        for _ in range(2):
            run(spark.createDataFrame(part, schema), number)
    finish(spark, ["test"], out, FINE)
    want = add_step_features(spark.createDataFrame(main_rows(3), MAIN), ["test"])
    assert rows(read_ordered(spark, out), want.columns) == rows(want)


def test_channels_wait_for_their_records(spark, tmp_path):
    """Nothing is released while one side is still missing; a record without channels is released once both sides are past it."""
    schema = "seq_id long, test_time long, _side string, _aux_auxchl_id long, _aux_test_tmp long"
    run, out = ordered_batch([], str(tmp_path), 0), str(tmp_path)
    run(spark.createDataFrame([(s, s % 3, "main", None, None) for s in range(1, 9)], schema), 0)
    assert read_ordered(spark, out).count() == 0
    run(spark.createDataFrame([(s, None, "aux", 1, s) for s in (1, 2, 5)], schema), 1)
    got = read_ordered(spark, out).collect()
    assert sorted((r.seq_id, r.auxchl_id) for r in got) == [(1, 1), (2, 1), (3, None), (4, None)]
    finish(spark, [], out)
    main = spark.createDataFrame([(s, s % 3) for s in range(1, 9)], "seq_id long, test_time long")
    aux = spark.createDataFrame([(s, 1, s) for s in (1, 2, 5)], "seq_id long, auxchl_id long, test_tmp long")
    want = add_step_features(join_aux(main, aux))
    assert rows(read_ordered(spark, out), want.columns) == rows(want)

"""Reads of tables that grow between the passes of one call."""

import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException

import cyclerlake as cl
from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import add_step_features
from cyclerlake.operators.joins import join_aux, join_aux_with_steps
from cyclerlake.operators.snapshot import ChangedRecordsError

MAIN = "test long, seq_id long, test_time long, unix_time long"
AUX = "test long, seq_id long, auxchl_id long, test_tmp long"
LAYOUTS = [Layout(), Layout(chunk_records=5), Layout(chunk_records=5, hot_rows=3), Layout(chunk_records=4, hot_rows=0)]


class Live:
    """A table whose rows are read anew by every job."""

    def __init__(self, spark, path, schema):
        self.path, self.names = str(path), [c.split()[0] for c in schema.split(", ")]

        def read(batches, path=self.path):
            for _ in batches:
                yield pd.read_pickle(path)

        self.frame = spark.range(1).repartition(1).mapInPandas(read, schema)

    def set(self, rows):
        pd.DataFrame(rows, columns=self.names).astype("Int64").to_pickle(self.path)


def main_rows(low, high, tests=(1, 2)):
    return [(t, s, s % 7, 100 + s) for t in tests for s in range(low, high)]


def aux_rows(low, high, tests=(1, 2)):
    return [(t, s, c, s * 10 + c) for t in tests for s in range(low, high) for c in (1, 2) if (s + c) % 3]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def live(spark, tmp_path):
    main, aux = Live(spark, tmp_path / "main", MAIN), Live(spark, tmp_path / "aux", AUX)
    main.set(main_rows(1, 40))
    aux.set(aux_rows(1, 40))
    return main, aux


@pytest.mark.parametrize("layout", LAYOUTS)
def test_steps_of_a_growing_table(spark, live, layout):
    main, _ = live
    want = rows(add_step_features(spark.createDataFrame(main_rows(1, 40), MAIN), ["test"]))
    got = add_step_features(main.frame, ["test"], layout, snapshot=True)
    # more records, a new test, and new chunks
    main.set(main_rows(1, 70) + main_rows(1, 9, (3,)))
    assert rows(got) == want


@pytest.mark.parametrize(("layout", "scope"), [(LAYOUTS[1], "row"), (LAYOUTS[2], "row"), (LAYOUTS[2], "record")])
def test_channels_of_a_growing_table(spark, live, layout, scope):
    main, aux = live
    fixed = spark.createDataFrame(main_rows(1, 40), MAIN), spark.createDataFrame(aux_rows(1, 40), AUX)
    want = rows(join_aux_with_steps(*fixed, ["test"], scope=scope))
    got = join_aux_with_steps(main.frame, aux.frame, ["test"], layout, scope, snapshot=True)
    main.set(main_rows(1, 70) + main_rows(1, 9, (3,)))
    aux.set(aux_rows(1, 70) + aux_rows(1, 9, (3,)))
    assert rows(got) == want
    plain = rows(join_aux(*fixed, ["test"]))
    main.set(main_rows(1, 40))
    aux.set(aux_rows(1, 40))
    joined = join_aux(main.frame, aux.frame, ["test"], layout, snapshot=True)
    # a channel of the last record comes after its first one was read
    aux.set(aux_rows(1, 40) + [(1, 39, 9, 0), (2, 44, 1, 0)])
    main.set(main_rows(1, 41))
    assert rows(joined) == plain


@pytest.mark.parametrize(("layout", "change"), [(LAYOUTS[1], c) for c in ("late", "gone", "copy", "chunk gone")] + [(LAYOUTS[2], "late"), (LAYOUTS[3], "gone")])
def test_other_changes_are_errors(spark, live, layout, change):
    main, aux = live
    before = [r for r in main_rows(1, 40) if r[1] != 17]
    main.set(before)
    if layout.hot_rows < 10:
        aux.set([])  # hot chunks are cut and counted when called, so they cannot change afterwards
    steps = join_aux_with_steps(main.frame, aux.frame, ["test"], layout, snapshot=True)
    alone = add_step_features(main.frame, ["test"], layout, snapshot=True)
    after = {
        "late": before + [(1, 17, 3, 117)],
        "gone": [r for r in before if r[:2] != (2, 20)],
        "copy": before + [(2, 39, 39 % 7, 139)],
        "chunk gone": [r for r in before if not (r[0] == 1 and 5 <= r[1] < 10)],
    }[change]
    want = rows(add_step_features(spark.createDataFrame(before, MAIN), ["test"]))
    main.set(after)
    for result in (steps, alone):
        try:
            got = rows(result)
        except (PySparkException, ChangedRecordsError) as error:
            assert "changed while they were read" in str(error)
        else:
            # only where all chunks were landed before the change
            assert layout.hot_rows == 0 or layout.hot_rows == 3
            assert result is steps or got == want


def test_change_during_the_narrow_passes_is_an_error(spark, live, monkeypatch):
    from cyclerlake.operators import features

    main, _ = live
    before = features.landed

    def landed(df, purpose):
        out = before(df, purpose)
        if purpose == "chunk-summary":
            main.set([r for r in main_rows(1, 40) if r[1] != 3])
        return out

    monkeypatch.setattr(features, "landed", landed)
    with pytest.raises(ChangedRecordsError):
        add_step_features(main.frame, ["test"], Layout(chunk_records=5, hot_rows=3), snapshot=True)


def test_snapshot_of_still_tables_changes_nothing(spark):
    chance = random.Random(3)
    main = [(t, chance.choice([None, *range(20)]), chance.randrange(3), chance.randrange(50)) for t in (1, None) for _ in range(60)]
    aux = [(t, chance.choice([None, *range(20)]), chance.choice([None, 1, 2]), chance.randrange(9)) for t in (1, None) for _ in range(40)]
    frames = spark.createDataFrame(main, MAIN), spark.createDataFrame(aux, AUX)
    for layout in LAYOUTS[1:3]:
        assert rows(join_aux_with_steps(*frames, ["test"], layout, snapshot=True)) == rows(join_aux_with_steps(*frames, ["test"], layout))
        assert rows(join_aux(*frames, ["test"], layout, snapshot=True)) == rows(join_aux(*frames, ["test"], layout))


def test_get_data_of_a_live_server(spark, tmp_path):
    live = Live(spark, tmp_path / "rec", "unit_id long, chl_id long, test_id long, seq_id long, cycle long, step_id long, step_type long, test_time long, "
                "test_vol long, test_cur long, test_capchg long, test_engchg long, test_capdchg long, test_engdchg long")  # fmt: skip

    def made(n):
        return [(1, 1, t, s, 1, 1, 4, s % 5, 30000 + s, 5, 1, 1, 1, 1) for t in (1, 2) for s in range(1, n)]

    live.set(made(50))
    records = live.frame.selectExpr("*", "CAST('2024-01-01' AS timestamp_ntz) + make_dt_interval(0, 0, 0, seq_id) AS test_atime")
    tests = spark.sql("SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, id AS test_id, 'rec' AS main_first_table FROM range(1, 3)")
    db = cl.Cycler(cl.FrameTables(spark, {"rec": records, "test": tests}), "0800")
    columns = [c for c in db.main_columns(260001) if c in records.columns]
    one, fleet = (f for f in (db.get_data(tests.first().asDict(), main_columns=columns, snapshot=True), db.get_fleet(tests, main_columns={"26": columns}, snapshot=True)))
    live.set(made(90))
    assert one.count() == 49 and fleet.count() == 98
    assert db.get_data(tests.first().asDict(), main_columns=columns).count() == 89

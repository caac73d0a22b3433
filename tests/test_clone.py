"""Copies that are brought up to date, sketches, and summaries from footers."""

import random

import pytest
from pyspark.sql import functions as F

import cyclerlake as cl
from cyclerlake.operators.reports import merge_sketches, quantiles, rank_error, sketch_steps, summarise_export, summarise_tests
from cyclerlake.plans import clone
from cyclerlake.plans.export import export_tests
from cyclerlake.sources import folders
from cyclerlake.sources.catalogue import IDENTITY


def fleet_of(spark, changed=(), tests=8, n=40):
    made = spark.range(tests * n).selectExpr(
        "1L AS unit_id", "1L AS chl_id", f"id % {tests} AS test_id", f"id div {tests} AS seq_id", "1L AS cycle", "id % 3 AS step_id", "4L AS step_type",
        "id % 9 AS test_time", f"CAST(id + CASE WHEN id % {tests} IN ({', '.join(map(str, [-1, *changed]))}) THEN 1 ELSE 0 END AS double) AS test_vol", "1D AS test_cur",
        "CAST('2024-01-01' AS timestamp_ntz) + make_dt_interval(0, 0, 0, id) AS test_atime", "1D AS test_capchg", "1D AS test_capdchg", "1D AS test_engchg", "1D AS test_engdchg",
    )
    listed = spark.sql(f"SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, id AS test_id, 'rec' AS main_first_table FROM range({tests})")
    cycler = cl.Cycler(cl.FrameTables(spark, {"rec": made, "test": listed}), "0800")
    return cycler, {"main_columns": {"26": [c for c in cycler.main_columns(260001) if c in made.columns]}}


def rows(df):
    return sorted(map(str, df.collect()))


def held(spark, path, cycler, options):
    fleet = cycler.get_fleet(**options)
    return rows(clone.read_clone(spark, path, fleet.schema)), rows(fleet)


def test_a_second_clone_writes_nothing(spark, tmp_path):
    path = str(tmp_path)
    cycler, options = fleet_of(spark)
    assert clone.clone_fleet(cycler, path, **options) == 8
    got, want = held(spark, path, cycler, options)
    assert got == want and len(got) == 320
    runs = sorted(p.name for p in (tmp_path / "data").iterdir())
    assert clone.clone_fleet(cycler, path, **options) == 0
    assert sorted(p.name for p in (tmp_path / "data").iterdir()) == runs
    # two tests change, one is new
    cycler, options = fleet_of(spark, changed=(2, 5), tests=8)
    assert clone.clone_fleet(cycler, path, **options) == 2
    got, want = held(spark, path, cycler, options)
    assert got == want
    # readers see whole tests: the old ones stay until their version is gone
    assert clone.vacuum_clone(spark, path) == []
    cycler, options = fleet_of(spark, changed=range(8))
    assert clone.clone_fleet(cycler, path, **options) == 6
    assert len(clone.vacuum_clone(spark, path)) == 1
    got, want = held(spark, path, cycler, options)
    assert got == want


def test_a_broken_clone_goes_on(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    cycler, options = fleet_of(spark)
    written, real = [], clone.export_tests

    def failing(df, *args):
        if len(written) == 2:
            df.limit(5).write.parquet(f"{args[0]}/dev_uid=260001/unit_id=1/chl_id=1/test_id=99")  # rests of a broken write
            raise KeyboardInterrupt
        written.append(args[0])
        real(df, *args)

    monkeypatch.setattr(clone, "export_tests", failing)
    with pytest.raises(KeyboardInterrupt):
        clone.clone_fleet(cycler, path, batch_rows=80, **options)
    monkeypatch.setattr(clone, "export_tests", real)
    done = clone.manifest(spark, path).count()
    assert 0 < done < 8
    got, want = held(spark, path, cycler, options)
    assert set(got) < set(want) and len(got) == 40 * done
    # a manifest that was not finished does not count
    (tmp_path / "manifest" / "version=9").mkdir()
    assert clone.clone_fleet(cycler, path, batch_rows=80, **options) == 8 - done
    got, want = held(spark, path, cycler, options)
    assert got == want


def test_files_of_a_clone_grow_with_rows_not_with_tests(spark, tmp_path):
    path = str(tmp_path)
    cycler, options = fleet_of(spark, tests=60, n=5)
    assert clone.clone_fleet(cycler, path, **options) == 60
    assert len(list(tmp_path.rglob("data/**/*.parquet"))) < 10
    got, want = held(spark, path, cycler, options)
    assert got == want and len(got) == 300
    # of the first run all tests count but one: it is read by its tests, the second as it is
    cycler, options = fleet_of(spark, changed=(7,), tests=60, n=5)
    assert clone.clone_fleet(cycler, path, rows_per_file=2, **options) == 1
    assert len(list(tmp_path.rglob("data/**/*.parquet"))) < 16
    got, want = held(spark, path, cycler, options)
    assert got == want and len(got) == 300


@pytest.mark.parametrize("fmt", ["csv", "ndjson"])
def test_a_clone_in_text(spark, tmp_path, fmt):
    path = str(tmp_path)
    cycler, options = fleet_of(spark)
    assert clone.clone_fleet(cycler, path, fmt=fmt, **options) == 8
    fleet = cycler.get_fleet(**options)
    assert rows(clone.read_clone(spark, path, fleet.schema, fmt)) == rows(fleet)


def test_a_clone_with_a_folder_per_test_is_read_on(spark, tmp_path):
    path = str(tmp_path)
    cycler, options = fleet_of(spark)
    assert clone.clone_fleet(cycler, path, **options) == 8
    # as copies were laid out once: a folder per test, a manifest without the number of tests
    export_tests(cycler.get_fleet(**options), f"{path}/data/run=before")
    clone.manifest(spark, path).drop("tests").withColumn("run", F.lit("before")).write.parquet(f"{path}/manifest/version=2")
    got, want = held(spark, path, cycler, options)
    assert got == want and len(got) == 320
    cycler, options = fleet_of(spark, changed=(2, 5))
    assert clone.clone_fleet(cycler, path, **options) == 2
    got, want = held(spark, path, cycler, options)
    assert got == want and len(got) == 320


def test_digests_tell_copies_and_sides_apart(spark):
    def told(main, aux):
        frames = spark.createDataFrame(main, "test long, a long, b string"), spark.createDataFrame(aux, "test long, a long, b string")
        return {r.test: r.digest for r in clone.digests(*frames, by=["test"]).collect()}

    main, aux = [(1, 1, "x"), (1, 2, None), (2, 1, "x")], [(1, 1, "x")]
    base = told(main, aux)
    assert told(main[::-1], aux) == base
    for other in (told([*main, main[0], main[0]], aux), told(main[1:], [*aux, main[0]]), told([(1, 1, "y"), *main[1:]], aux), told([(1, 1, "x"), (1, None, "2"), (2, 1, "x")], aux)):
        assert other[1] != base[1] and other.get(2, base[2]) == base[2]


def test_quantiles_are_within_their_error(spark):
    chance = random.Random(1)
    values = [(i % 3 and 1, float(chance.choice([chance.gauss(0, 1), chance.randrange(5)])) if i % 11 else None) for i in range(30_000)]
    frame = spark.createDataFrame([(k, 7, v) for k, v in values], "test_id long, step_count long, test_vol double").repartition(7)
    parts = sketch_steps(frame.withColumn("part", F.expr("abs(hash(test_vol)) % 5")), ["test_id", "part"], 400)
    for df in (sketch_steps(frame, ["test_id"], 400), merge_sketches(parts, ["test_id", "step_count"], 400)):
        for row in quantiles(df, (0.05, 0.5, 0.95)).collect():
            mine = sorted(v for k, v in values if k == row.test_id and v is not None)
            assert row.records == sum(k == row.test_id for k, _ in values)
            for rank, got in ((0.05, row.test_vol_q05), (0.5, row.test_vol_q50), (0.95, row.test_vol_q95)):
                low, high = sum(v < got for v in mine) / len(mine), sum(v <= got for v in mine) / len(mine)
                assert low - 2 * rank_error(400) <= rank <= high + 2 * rank_error(400)
    empty = spark.createDataFrame([(1, 1, None)], "test_id long, step_count long, test_vol double")
    assert quantiles(sketch_steps(empty, ["test_id"])).first().test_vol_q50 is None
    with pytest.raises(ValueError):
        sketch_steps(empty.drop("test_vol"), [])


def test_summary_of_an_export_reads_no_rows(spark, tmp_path):
    cycler, options = fleet_of(spark)
    fleet = cycler.get_fleet(**options)
    export_tests(fleet, str(tmp_path / "out"))
    got = summarise_export(spark, str(tmp_path / "out"), IDENTITY)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(`Record Count / 1`)" in plan and "PushedGroupBy: [dev_uid, unit_id, chl_id, test_id]" in plan
    names = {"Record Count / 1": "seq_id", "Cycle Count / 1": "cycle", "Step ID / 1": "step_id", "Unix Time / s": "unix_time"}
    want = summarise_tests(fleet.select(*IDENTITY, *(F.col(f"`{k}`").alias(v) for k, v in names.items())), IDENTITY)
    assert rows(got.select(*want.columns)) == rows(want)


def test_many_folders_are_summarised_in_batches(spark, tmp_path, monkeypatch):
    cycler, options = fleet_of(spark)
    export_tests(cycler.get_fleet(**options), str(tmp_path / "out"), rows_per_file=15)
    by = [IDENTITY, ["unit_id"]]
    want = [rows(summarise_export(spark, str(tmp_path / "out"), some)) for some in by]
    monkeypatch.setattr(folders, "FOLDERS", 3)
    got = [summarise_export(spark, str(tmp_path / "out"), some) for some in by]
    assert list(map(rows, got)) == want and [len(some) for some in want] == [8, 1]
    assert not any(str(tmp_path / "out") in name for some in got for name in some.inputFiles())

import random

import pytest
from pyspark.sql import functions as F

import cyclerlake as cl
from checks.queries import FINE, TEST_24, TEST_26, TEST_26_NO_AUX, tables
from cyclerlake.functions.vocabulary import LABELS
from cyclerlake.plans import cover, export, records
from cyclerlake.plans.export import export_tests
from cyclerlake.sources import folders

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db(spark):
    return tables(spark, SF)


@pytest.fixture(scope="module")
def cycler(db):
    return cl.connect(db)


def rows(df):
    return sorted(map(str, df.collect()))


def test_identity_replaces_callers_filter(db):
    got = records.main_records(db.frame, "0800", TEST_26, {"test_id": 1, "unit_id": [4]}, ["test_id", "unit_id"])
    assert {tuple(r) for r in got.collect()} == {(2, 3)}


def test_second_table_keeps_callers_filter_only(db):
    nowhere = {**TEST_24, "unit_id": 77}
    got = records.main_records(db.frame, "0800", nowhere, {"seq_id": (None, 50)}, ["seq_id", "test_id"])
    early = db.get_table("rec_hist_0", ["seq_id", "test_id"], {"seq_id": (None, 50)})
    assert rows(got) == rows(early)
    assert early.count() > 0


def test_lone_second_aux_table_is_filtered(db):
    lone = {**TEST_24, "aux_first_table": None, "aux_second_table": "aux_live"}
    got = records.aux_records(db.frame, "0800", lone, columns=["test_id"])
    assert {r.test_id for r in got.collect()} == {0}
    assert records.aux_records(db.frame, "0800", TEST_26_NO_AUX) is None


def test_main_table_is_mandatory(db):
    with pytest.raises(ValueError, match="main_first_table"):
        records.main_records(db.frame, "0800", {**TEST_26, "main_first_table": None})


def test_every_test_alone_equals_the_fleet(cycler):
    fleet = cycler.get_fleet(layout=FINE).cache()
    tests = [t for t in cycler.list_tests() if t["test_id"] in (0, 1, 2, 5, 7, 8)]
    assert {t["dev_uid"] for t in tests} == {240001, 260001}
    for test in tests:
        mine = fleet.where(
            (F.col("dev_uid") == test["dev_uid"]) & (F.col("test_id") == test["test_id"])
        ).select(*(f"`{label}`" for label in LABELS))
        assert rows(cycler.get_data(test)) == rows(mine), test
    fleet.unpersist()


def test_long_list_of_tests_is_joined_without_broadcast(cycler, monkeypatch):
    expected = rows(cycler.get_fleet())
    monkeypatch.setattr(records, "BROADCAST_TESTS", 0)
    monkeypatch.setattr(records, "SALTS", 3)
    assert rows(cycler.get_fleet()) == expected


def test_shared_second_table_goes_to_each_owner(spark, db, cycler):
    tests = cycler.tests().where("test_id IN (0, 7)").withColumn("main_second_table", F.lit("rec_hist_0"))
    fleet = cycler.get_fleet(tests)
    for test in (r.asDict() for r in tests.collect()):
        mine = fleet.where(f"test_id = {test['test_id']}").select(*(f"`{label}`" for label in LABELS))
        assert rows(cycler.get_data(test)) == rows(mine)


def test_repeated_test_is_an_error(cycler):
    tests = cycler.tests()
    again = tests.unionByName(tests.withColumn("main_first_table", F.lit("rec_hist_0")))
    with pytest.raises(ValueError, match="unique"):
        cycler.get_fleet(again)
    with pytest.raises(ValueError, match="no tests"):
        cycler.get_fleet(tests.where("false"))


def test_main_temperature_wins_over_channel(cycler):
    columns = [*cycler.main_columns(260001), "test_tmp"]
    got = cycler.get_data(TEST_26, main_columns=columns).select("`Record Count / 1`", "`Temperature / degC`")
    seen = {r[0]: r[1] for r in got.collect()}
    assert all(value == (200 + (seq - 1) % 150) / 10 for seq, value in seen.items())
    none = cycler.get_data(TEST_26_NO_AUX, main_columns=columns).select("`Temperature / degC`")
    assert {r[0] for r in none.collect()} == {None}


def test_fleet_with_main_temperature(cycler):
    columns = {"26": [*cycler.main_columns(260001), "test_tmp"]}
    fleet = cycler.get_fleet(main_columns=columns)
    temperature = F.col("`Temperature / degC`")
    assert fleet.where("unit_id = 4").where(temperature.isNotNull()).count() == 0
    three = fleet.where("unit_id = 3")
    seq = F.col("`Record Count / 1`")
    assert three.where(temperature != (200 + (seq - 1) % 150) / 10).count() == 0
    assert three.where(temperature.isNull()).count() == 0


def test_too_few_columns_fail(cycler):
    with pytest.raises(Exception, match="Voltage"):
        cycler.get_data(TEST_26, main_columns=["seq_id", "test_time"])


def test_partial_columns_leave_raw_current_unless_completed(cycler):
    some = [c for c in cycler.main_columns(240001) if c != "cur_step_range"]
    with pytest.warns(UserWarning, match="raw counts"):
        raw = cycler.get_data(TEST_24, main_columns=some)
    whole = cycler.get_data(TEST_24, main_columns=some, complete=True)
    assert rows(whole) == rows(cycler.get_data(TEST_24))
    assert rows(raw) != rows(whole)


def test_partial_fetch_renumbers_steps(cycler):
    part = cycler.get_data(TEST_24, where={"seq_id": (400, None)})
    assert part.agg(F.min("`Step Count / 1`")).first()[0] <= 1


def test_bad_step_scope(cycler):
    with pytest.raises(ValueError, match="step_scope"):
        cycler.get_data(TEST_24, step_scope="no")


def test_filter_reaches_the_scan(spark, db, tmp_path):
    db.frame("rec_live").write.parquet(str(tmp_path / "rec_live"))
    files = cl.FileTables(spark, {"rec_live": str(tmp_path / "rec_live")})
    got = cl.Cycler(files, "0800").get_main_data(TEST_26, {"seq_id": (None, 100)}, ["seq_id", "test_vol"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("LessThanOrEqual(seq_id,100)", "EqualTo(test_id,2)", "EqualTo(unit_id,3)", "EqualTo(chl_id,3)"):
        assert pushed in plan
    assert "test_cur" not in plan


def test_export_splits_long_tests(cycler, tmp_path):
    export_tests(cycler.get_fleet(), str(tmp_path / "out"), rows_per_file=100)
    folder = tmp_path / "out" / "dev_uid=240001" / "unit_id=1" / "chl_id=1" / "test_id=0"
    assert len(list(folder.glob("*.parquet"))) >= 4
    with pytest.raises(ValueError, match="export"):
        export_tests(cycler.get_fleet(), str(tmp_path / "other"), "feather")


def test_export_of_records_far_apart_is_a_file_per_test(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.sql("SELECT id % 20 AS test, 1000 * id AS number FROM range(400) UNION ALL SELECT 20, 1000 * id FROM range(90) UNION ALL SELECT null, null FROM range(3)")
        export_tests(rows, str(tmp_path / "out"), by=["test"], order="number", rows_per_file=30)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = spark.read.parquet(str(tmp_path / "out")).selectExpr("test", "number", "_metadata.file_path AS file")
    assert [tuple(r) for r in per_file.orderBy("test", "number").select("test", "number").collect()] == [tuple(r) for r in rows.orderBy("test", "number").collect()]
    files = {r.test: (r.files, r.most) for r in per_file.groupBy("test", "file").count().groupBy("test").agg({"file": "count", "count": "max"}).toDF("test", "files", "most").collect()}
    assert all(files[t] == (1, 20) for t in range(20)) and files[None] == (1, 3)
    # three files' rows are three stretches, which tasks may hold together
    assert 3 <= files[20][0] <= 4 and files[20][1] <= 30


MANY = """SELECT id % 2 AS side, CASE id % 4 WHEN 0 THEN 'x/y=1' WHEN 1 THEN 'a}, b' WHEN 2 THEN '50% *' END AS name, id % 20 AS test, id AS number, id / 7 AS value,
  CAST('2024-01-01' AS timestamp_ntz) + make_dt_interval(0, 0, 0, id) AS time FROM range(200) UNION ALL SELECT 0, 'z', null, 1, null, null FROM range(3)"""


@pytest.mark.parametrize("fmt", ["parquet", "csv", "ndjson"])
def test_many_folders_are_read_in_batches(spark, tmp_path, monkeypatch, fmt):
    rows, out = spark.sql(MANY), str(tmp_path / "out")
    export_tests(rows, out, fmt, by=["side", "name", "test"], order="number", rows_per_file=4)
    asked = []
    real = export.landed_by_folders

    def told(spark, roots, read, purpose):
        return real(spark, roots, lambda session, some: asked.append(some) or read(session, some), purpose)

    monkeypatch.setattr(export, "landed_by_folders", told)
    lazy = export.read_export(spark, out, rows.schema, fmt)
    monkeypatch.setattr(folders, "FOLDERS", 6)
    got = export.read_export(spark, out, rows.schema, fmt)
    assert sorted(map(str, got.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert got.dtypes == lazy.dtypes and any(out in name for name in lazy.inputFiles()) and not any(out in name for name in got.inputFiles())
    # each folder once, no batch larger than it may be
    assert [len(some) for some in asked] == [6, 6, 6, 3] and len({name for some in asked for name in some}) == 21
    # of two exports side by side, those that are asked for
    export_tests(rows, f"{out}2/run=a", fmt, by=["side", "name", "test"], order="number")
    export_tests(rows, f"{out}2/run=b", fmt, by=["side", "name", "test"], order="number")
    one = export.read_export(spark, f"{out}2", rows.schema.add("run", "string"), fmt, ["run=b"])
    assert one.count() == 203 and one.select("run").distinct().collect() == [("b",)]


def test_narrow_gaps_are_not_compared():
    assert cover.without_narrow_gaps([(0, 0), (2, 4), (6, 1000), (1300, 1400)]) == [(0, 1000), (1300, 1400)]
    assert cover.without_narrow_gaps([(0, 0), (2, 4)]) == [(0, 0), (2, 4)]
    assert cover.without_narrow_gaps([(5, 5)]) == [(5, 5)]


def test_a_chosen_test_prunes_the_scan(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "id % 3 AS unit_id", "id % 3 AS chl_id", "id % 30 AS test_id", "id AS seq_id", "id % 9 AS test_time", "CAST(id AS double) AS test_vol"
    )
    rows.write.parquet(f"{tmp_path}/rec")
    spark.sql("SELECT '0800' AS version").write.parquet(f"{tmp_path}/db_ver")
    test = "SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, 4L AS test_id, 'rec' AS main_first_table"
    spark.sql(test).write.parquet(f"{tmp_path}/test")
    db = cl.connect(cl.FileTables(spark, {n: f"{tmp_path}/{n}" for n in ("rec", "db_ver", "test")}))
    main, _ = db.fleet_parts(db.tests(), main_columns={"26": ["seq_id", "test_time", "test_vol"]})
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = main._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.split("\n") if "FileScan" in line and "seq_id" in line)
    assert "EqualTo(test_id,4)" in pushed
    assert main.count() == 100


def scanned_rows(df):
    """Rows that the scans of records give, after the query has run."""
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet") and "seq_id" in node.output().mkString():
            total += node.metrics().get("numOutputRows").get().value()
        inner = [node.plan()] if "QueryStage" in node.getClass().getName() else [node.children().apply(i) for i in range(node.children().size())]
        todo += inner
    return got, total


def test_scattered_tests_read_few_row_groups(spark, tmp_path, monkeypatch):
    made = spark.range(40_000).selectExpr(
        "1L AS unit_id", "1L AS chl_id", "id div 100 AS test_id", "id AS seq_id", "id % 9 AS test_time", "CAST(id AS double) AS test_vol",
    )
    made.coalesce(1).sortWithinPartitions("seq_id").write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/rec")
    spark.sql("SELECT '0800' AS version").write.parquet(f"{tmp_path}/db_ver")
    test = "SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, t AS test_id, 'rec' AS main_first_table FROM VALUES (0L), (1L), (200L), (398L), (399L) AS v(t)"
    spark.sql(test).write.parquet(f"{tmp_path}/test")
    db = cl.connect(cl.FileTables(spark, {n: f"{tmp_path}/{n}" for n in ("rec", "db_ver", "test")}))
    found = {}
    for ranges in (1, 3, 16):
        monkeypatch.setattr(records, "covers", lambda values, ranges=ranges: cover.covers(values, ranges))
        main, _ = db.fleet_parts(db.tests(), main_columns={"26": ["seq_id", "test_time", "test_vol"]})
        found[ranges] = scanned_rows(main)
        assert sorted({r.test_id for r in found[ranges][0]}) == [0, 1, 200, 398, 399]
    assert len({tuple(sorted(map(str, got))) for got, _ in found.values()}) == 1
    assert found[1][1] == 40_000
    assert found[3][1] < 4_000 and found[16][1] <= found[3][1]


@pytest.mark.parametrize("ranges", [1, 2, 5, 16])
@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_covers_keep_the_widest_gaps(spark, ranges, buckets):
    chance = random.Random(ranges)
    rows, want = [], {}
    for table in ("a", "b", "c", "d"):
        values = sorted({"a": {5}, "b": {chance.randrange(100) for _ in range(30)}, "c": {-(2**63), 0, 2**63 - 1, 7},
                         "d": {chance.randrange(10**9) for _ in range(80)} | set(range(50))}[table])
        rows += [("24", "main", table, "test_id", v) for v in [*values, values[0], None]]
        gaps = sorted((-(b - a), a, b) for a, b in zip(values, values[1:]) if b - a > 1)[: ranges - 1]
        cuts = sorted((a, b) for _, a, b in gaps)
        want["24", "main", table, "test_id"] = list(zip([values[0], *(b for _, b in cuts)], [*(a for a, _ in cuts), values[-1]]))
    frame = spark.createDataFrame(rows, "device string, kind string, record_table string, key string, value long")
    assert cover.covers(frame.repartition(3), ranges, buckets) == want


def test_fleet_completes_columns_and_can_be_strict(spark, tmp_path):
    rows = spark.range(100).selectExpr(
        "1L AS unit_id", "1L AS chl_id", "1L AS test_id", "id AS seq_id", "id % 9 AS test_time", "id AS test_vol", "id AS test_cur",
        "100D AS cur_step_range",
    )
    test = spark.sql("SELECT 240001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, 1L AS test_id, 'rec' AS main_first_table")
    db = cl.Cycler(cl.FrameTables(spark, {"rec": rows, "test": test}), "0800")
    asked = {"24": ["seq_id", "test_time", "test_cur"]}
    with pytest.raises(ValueError, match="raw counts"):
        db.fleet_parts(test, main_columns=asked, strict=True)
    assert db._main_columns("240001", ["test_cur"], True).count("cur_step_range") == 1


def test_sql_text_leaves_views_alone(spark):
    spark.range(3).createOrReplaceTempView("rec")
    t = cl.FrameTables(spark, {"rec": spark.range(5), "re": spark.range(7)})
    assert t.query("SELECT count(*) AS n FROM rec").first().n == 5
    assert spark.table("rec").count() == 3
    assert not spark.catalog.tableExists("re")
    spark.catalog.dropTempView("rec")


@pytest.mark.parametrize("limit", [100, 0])
def test_owned_tables_are_one_source(spark, tmp_path, monkeypatch, limit):
    """Many tables of single tests are one scan and give what a branch per table gives."""
    monkeypatch.setattr(records, "BROADCAST_TESTS", limit)
    monkeypatch.setattr(records, "SALTS", 3)
    tests = spark.sql(
        """SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, id AS test_id, 'rec' AS main_first_table,
        concat('old_', id % 12) AS main_second_table FROM range(15)"""
    )
    made = spark.sql("SELECT 1L AS unit_id, 1L AS chl_id, id % 15 AS test_id, id AS seq_id, id % 9 AS test_time FROM range(300)")
    made.write.parquet(f"{tmp_path}/rec")
    for i in range(12):
        made.where(f"seq_id % 12 = {i}").write.parquet(f"{tmp_path}/old_{i}")
    names = ["rec", *(f"old_{i}" for i in range(12))]
    paths = {name: f"{tmp_path}/{name}" for name in names}
    plain = cl.FileTables(spark, paths)
    joint = cl.FileTables(spark, paths, schemas={name: made.schema for name in names})
    found = {}
    for kind, source in (("plain", plain), ("joint", joint)):
        main, _ = cl.Cycler(source, "0800").fleet_parts(tests, {"seq_id": (20, None)}, {"26": ["seq_id", "test_time"]})
        found[kind] = rows(main)
        if kind == "joint":
            assert main._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 4  # rec, old tables, tests twice
    assert found["plain"] == found["joint"] and len(found["joint"]) > 300


def test_tables_that_cannot_be_read_together(spark, tmp_path):
    one, two = spark.range(1).schema, spark.sql("SELECT 'x' AS id").schema
    paths = {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b", "c": f"{tmp_path}/else/c", "d": f"{tmp_path}/other"}
    source = cl.FileTables(spark, paths, schemas={"a": one, "b": two, "c": one, "d": one})
    for names in (["a", "b"], ["a", "c"], ["a", "d"]):
        assert source.together(names) is None
    assert cl.FileTables(spark, paths).together(["a", "b"]) is None


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_owned_catalog_tables_are_one_source(spark, fmt):
    """The plan has as many leaves for twelve tables as for six, and gives what a branch per table gives."""
    database = f"owned_{fmt}"
    spark.sql(f"CREATE DATABASE {database}")
    made = spark.sql("SELECT 1L AS unit_id, 1L AS chl_id, id % 15 AS test_id, id AS seq_id, id % 9 AS test_time FROM range(300)")
    made.write.format(fmt).saveAsTable(f"{database}.rec")
    for i in range(12):
        made.where(f"seq_id % 12 = {i}").write.format(fmt).saveAsTable(f"{database}.old_{i}")
    source = cl.CatalogTables(spark, database)
    plain = cl.FrameTables(spark, {name: source.frame(name) for name in source.names()})
    leaves = {}
    for n in (6, 12):
        tests = spark.sql(
            f"""SELECT 260001L AS dev_uid, 1L AS unit_id, 1L AS chl_id, id AS test_id, 'rec' AS main_first_table,
            concat('old_', id % {n}) AS main_second_table FROM range(15)"""
        )
        found = []
        for tables in (source, plain):
            main, _ = cl.Cycler(tables, "0800").fleet_parts(tests, {"seq_id": (20, None)}, {"26": ["seq_id", "test_time"]})
            found.append(rows(main))
            leaves.setdefault(tables, []).append(main._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        assert found[0] == found[1] and len(found[0]) > 300
    assert leaves[source] == [4, 4] and leaves[plain][1] > leaves[plain][0]
    # another format, partitions, a view and another schema are read apart
    made.write.format("json").saveAsTable(f"{database}.other")
    made.write.format(fmt).partitionBy("chl_id").saveAsTable(f"{database}.parted")
    made.selectExpr("unit_id").write.format(fmt).saveAsTable(f"{database}.narrow")
    spark.sql(f"CREATE VIEW {database}.shown AS SELECT * FROM {database}.old_1")
    for name in ("other", "parted", "narrow", "shown", "absent"):
        assert source.together(["old_1", name]) is None
    assert source.together(["old_1", "old_2"]).groupBy("_table").count().count() == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")

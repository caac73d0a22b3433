from datetime import date, datetime

import pytest
from pyspark.sql import types as T

import cyclerlake as cl
from cyclerlake.sources import schemas
from cyclerlake.sources.catalogue import server_version
from cyclerlake.sources.tables import JdbcTables


def frames(spark, **named):
    return cl.FrameTables(spark, named)


def test_declared_schemas():
    sizes = {(k, kind): len(s) for k, both in schemas.SCHEMAS.items() for kind, s in both.items()}
    assert sizes == {
        ("0760-24", "main"): 25,
        ("0760-24", "aux"): 27,
        ("0800-24", "main"): 25,
        ("0800-24", "aux"): 23,
        ("0800-26", "main"): 25,
        ("0800-26", "aux"): 22,
    }
    main = schemas.record_schema("0760", 240007, "main")
    assert main["cur_step_range"].dataType == T.LongType()
    assert schemas.record_schema("0800", "2499", "main")["cur_step_range"].dataType == T.DoubleType()
    assert "unit_id" not in schemas.record_schema("0800", 260001, "main").fieldNames()
    with pytest.raises(ValueError, match="unsupported"):
        schemas.record_schema("0760", 260001, "main")


def test_impose_only_declared_and_asked(spark):
    df = spark.createDataFrame([(1, "2", 3)], "test_vol int, seq_id string, other int")
    schema = schemas.record_schema("0800", 260001, "main")
    assert dict(schemas.impose(df, schema).dtypes) == {"test_vol": "double", "seq_id": "bigint", "other": "int"}
    assert dict(schemas.impose(df, schema, ["seq_id"]).dtypes) == {"test_vol": "int", "seq_id": "bigint", "other": "int"}


def test_python_types(spark):
    df = spark.sql(
        "SELECT 1 AS i, 2L AS l, 1.5D AS d, 1.5 AS m, 'x' AS s, TIMESTAMP_NTZ'2024-01-01' AS n,"
        " TIMESTAMP'2024-01-01' AS t, DATE'2024-01-01' AS a, true AS b, array(1) AS o"
    )
    assert frames(spark, x=df).table_schema("x") == {
        "i": int, "l": int, "d": float, "m": float, "s": str, "n": datetime, "t": datetime, "a": date, "b": bool,
        "o": object,
    }


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats(spark, tmp_path, fmt):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    path = str(tmp_path / "t")
    df.write.format(fmt).save(path)
    tables = cl.FileTables(spark, {"t": path}, fmt, schemas={"t": df.schema})
    assert tables.names() == ["t"]
    got = tables.get_table("t", ["twice"], {"id": (8, None)})
    assert sorted(r.twice for r in got.collect()) == [16, 18]
    assert tables.query("SELECT sum(id) AS s FROM t").first().s == 45
    typed = tables.query("SELECT id FROM t", T.StructType([T.StructField("id", T.StringType())]))
    assert typed.dtypes == [("id", "string")]


def test_catalog_tables(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("kept_table")
    spark.range(5).createOrReplaceTempView("temporary_view")
    try:
        tables = cl.CatalogTables(spark)
        assert {"kept_table", "temporary_view"} <= set(tables.names())
        assert tables.get_table("kept_table").count() == 3
        assert tables.get_table("temporary_view").count() == 5
        assert tables.query("SELECT count(*) AS n FROM kept_table").first().n == 3
    finally:
        spark.sql("DROP TABLE kept_table")
        spark.catalog.dropTempView("temporary_view")


def test_jdbc_options(spark):
    tables = JdbcTables(
        spark, {"url": "jdbc:mysql://host/db", "user": "u"}, names=["b", "a"], split={"a": ("seq_id", 1, 10**9, 400)}
    )
    assert tables.names() == ["a", "b"]
    options = tables.read_options("a")
    assert options["partitionColumn"] == "seq_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "1000000000", "400")
    assert options["fetchsize"] == "100000"
    assert options["preferTimestampNTZ"] == "true"
    assert "partitionColumn" not in tables.read_options("b")


def test_frames_do_not_stream(spark):
    with pytest.raises(NotImplementedError):
        frames(spark, x=spark.range(1)).stream_table("x")


def versions(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "version string")


def test_version_must_be_single(spark):
    assert server_version(frames(spark, db_ver=versions(spark, "0800", "0800"))) == "0800"
    for values in [(), ("0760", "0800")]:
        with pytest.raises(ValueError, match="exactly one"):
            server_version(frames(spark, db_ver=versions(spark, *values)))
    with pytest.raises(ValueError, match="unsupported"):
        cl.connect(frames(spark, db_ver=versions(spark, "0999")))


IDS = "dev_uid long, unit_id long, chl_id long, test_id long"


def test_catalogue_0760(spark):
    tables = frames(
        spark,
        db_ver=versions(spark, "0760"),
        test=spark.createDataFrame([(240001, 1, 1, 9, 5), (240001, 1, 1, 7, 6)], IDS + ", n int"),
        h_test=spark.createDataFrame([(240000, 1, 1, 3, "x", "old")], IDS + ", n string, extra string"),
        test_note=spark.createDataFrame([(240001, 1, 1, 7, "hello", "nn")], IDS + ", note string, n string"),
    )
    got = cl.connect(tables).tests()
    assert got.columns == ["dev_uid", "unit_id", "chl_id", "test_id", "n", "extra", "note", "n_right"]
    assert [tuple(r)[3:] for r in got.collect()] == [
        (3, "x", "old", None, None),
        (7, "6", None, "hello", "nn"),
        (9, "5", None, None, None),
    ]


def test_catalogue_0800_takes_every_history_table(spark):
    tables = frames(
        spark,
        db_ver=versions(spark, "0800"),
        test=spark.createDataFrame([(240001, 1, 1, 9)], IDS),
        h_test_2=spark.createDataFrame([(240001, 1, 1, 2)], IDS),
        h_test_1=spark.createDataFrame([(240001, 1, 1, 1, 0.5)], IDS + ", v double"),
        other=spark.createDataFrame([(1, 1, 1, 1)], IDS),
    )
    listed = list(cl.list_tests(tables))
    assert [t["test_id"] for t in listed] == [1, 2, 9]
    assert listed[0] == {"dev_uid": 240001, "unit_id": 1, "chl_id": 1, "test_id": 1, "v": 0.5}


def test_jdbc_split_between_ends(spark):
    tables = JdbcTables(spark, {"url": "jdbc:mysql://host/db"}, names=["big", "small", "empty"], parts=8)
    tables.ends = {"big": (5, 10**9), "small": (1, 90), "empty": (None, None)}.get
    for name in tables.names():
        tables.split_evenly(name)
    assert tables.split == {"big": ("seq_id", 5, 10**9 + 1, 8)}
    assert tables.read_options("big")["numPartitions"] == "8"

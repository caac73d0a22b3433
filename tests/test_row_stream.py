import json
import os

import pytest
from pyspark.errors import StreamingQueryException

import cyclerlake as cl
from cyclerlake.operators.features import add_step_features
from cyclerlake.sources.row_stream import WHOLE, FileLog, RowReader, file_system, stream_rows
from cyclerlake.streaming.sinks import GO_ON, read_up, write_stream
from cyclerlake.streaming.steps import read_steps, stream_steps

SCHEMA = "id long, name string, at timestamp, clock timestamp_ntz, price decimal(10,2), parts array<int>"
SELECT = [
    "id",
    "concat('n', id) AS name",
    "timestamp_seconds(id) AS at",
    "CAST(timestamp_seconds(id) AS timestamp_ntz) AS clock",
    "CAST(id / 100 AS decimal(10,2)) AS price",
    "IF(id % 3 = 0, NULL, array(CAST(id AS int), NULL)) AS parts",
]


def some(spark, low, high):
    return spark.range(low, high, 1, 1).selectExpr(*SELECT)


def add(df, folder, **options):
    df.write.mode("append").options(**options).parquet(folder)


def take(spark, stream, tmp_path):
    """Read up into one folder per batch; the sizes of the batches so far."""

    def run(batch, number):
        batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={number}"))

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", str(tmp_path / "checkpoint"))
    read_up(writer.trigger(**GO_ON).start())
    return [r[1] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("batch").count().orderBy("batch").collect()]


def source(spark, tmp_path, rows, schema=SCHEMA):
    from pyspark.sql.types import StructType

    return stream_rows(spark, str(tmp_path / "in"), StructType.fromDDL(schema), rows, str(tmp_path / "log"))


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_batches_hold_at_most_so_many_rows_whatever_the_files(spark, tmp_path):
    # one file of several row groups, small files, an empty one
    add(some(spark, 0, 500), str(tmp_path / "in"), **{"parquet.block.row.count.limit": "70"})
    add(some(spark, 500, 510), str(tmp_path / "in"))
    add(some(spark, 0, 0), str(tmp_path / "in"))
    add(some(spark, 510, 523), str(tmp_path / "in"))
    assert take(spark, source(spark, tmp_path, 90), tmp_path) == [90] * 5 + [73]
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop("batch")) == rows(some(spark, 0, 523))


def test_goes_on_after_a_restart_with_files_that_came_since(spark, tmp_path):
    add(some(spark, 0, 100), str(tmp_path / "in"))
    assert take(spark, source(spark, tmp_path, 60), tmp_path) == [60, 40]
    # nothing new
    assert take(spark, source(spark, tmp_path, 60), tmp_path) == [60, 40]
    add(some(spark, 100, 230), str(tmp_path / "in"))
    # a file that was finished earlier than those read, but appeared later
    add(some(spark, 230, 260), str(tmp_path / "in"))
    for name in os.listdir(tmp_path / "in"):
        if name.endswith(".parquet") and not name.startswith("."):
            os.utime(tmp_path / "in" / name, (1, 1))
    assert take(spark, source(spark, tmp_path, 75), tmp_path) == [60, 40, 75, 75, 10]
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop("batch")) == rows(some(spark, 0, 260))


def test_a_batch_that_failed_is_read_again(spark, tmp_path):
    add(some(spark, 0, 100), str(tmp_path / "in"))
    seen = []

    def fail(batch, number):
        seen.append((number, batch.agg({"id": "sum"}).first()[0]))
        if len(seen) == 2:
            raise RuntimeError("lost")

    def start():
        stream = source(spark, tmp_path, 40).writeStream.foreachBatch(fail)
        return stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(**GO_ON).start()

    with pytest.raises(StreamingQueryException, match="lost"):
        read_up(start())
    # another file does not change what the second batch is
    add(some(spark, 100, 120), str(tmp_path / "in"))
    read_up(start())
    assert seen == [(0, sum(range(40))), (1, sum(range(40, 80))), (1, sum(range(40, 80))), (2, sum(range(80, 120)))]


def test_columns_that_files_lack_are_null_and_others_are_not_read(spark, tmp_path):
    add(some(spark, 0, 5).select("id"), str(tmp_path / "in"))
    add(some(spark, 5, 9), str(tmp_path / "in"))
    assert take(spark, source(spark, tmp_path, 100, "name string, id int"), tmp_path) == [9]
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert rows(got) == sorted([("None", str(i)) for i in range(5)] + [(f"n{i}", str(i)) for i in range(5, 9)])


def test_an_empty_folder_waits(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    stream = source(spark, tmp_path, 10, "id long")
    query = write_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), trigger=GO_ON)
    query.processAllAvailable()
    add(spark.range(25), str(tmp_path / "in"))
    read_up(query)
    assert spark.read.schema("id long").parquet(str(tmp_path / "out")).count() == 25
    assert max(p["numInputRows"] for p in query.recentProgress) == 10


def test_a_lost_log_is_an_error(spark, tmp_path):
    add(some(spark, 0, 30), str(tmp_path / "in"))
    take(spark, source(spark, tmp_path, 20), tmp_path)
    other = stream_rows(spark, str(tmp_path / "in"), some(spark, 0, 1).schema, 20, str(tmp_path / "other"))
    with pytest.raises(StreamingQueryException, match="belong together"):
        take(spark, other, tmp_path)


def test_folders_that_are_not_plain_are_errors(spark, tmp_path):
    some(spark, 0, 5).write.partitionBy("name").parquet(str(tmp_path / "in"))
    with pytest.raises(StreamingQueryException, match="partitioned"):
        take(spark, source(spark, tmp_path, 20), tmp_path)
    with pytest.raises(ValueError, match="positive"):
        source(spark, tmp_path, 0)
    with pytest.raises(ValueError, match="stream_log"):
        cl.FileTables(spark, {"in": "x"}, rows_per_batch=5)
    os.makedirs(tmp_path / "sink" / "_spark_metadata")
    (tmp_path / "sink" / "_spark_metadata" / "0").write_text("v1")
    with pytest.raises(ValueError, match="written by a stream"):
        RowReader(str(tmp_path / "sink"), str(tmp_path / "log2"), 5, None).latestOffset()


def test_log_reads_back_and_whole_entries_bound_a_restart(tmp_path):
    log = FileLog(str(tmp_path / "log"))
    for i in range(2 * WHOLE + 3):
        log.add([(f"f{i}", [i % 4, 1])])
    again = FileLog(str(tmp_path / "log"))
    assert (again.known, again.entries, again.paths) == (log.known, log.entries, log.paths)
    # the last whole entry tells all before it
    assert len(json.loads((tmp_path / "log" / f"{2 * WHOLE:012d}.json").read_text())) == 2 * WHOLE + 1
    assert FileLog(str(tmp_path / "new")).rows == 0


def test_names_of_file_systems():
    assert file_system("/a/b/")[1] == file_system("file:/a/b")[1] == file_system("file:///a/b")[1] == "/a/b"


def test_projection_reaches_the_source(spark, tmp_path):
    add(some(spark, 0, 50), str(tmp_path / "in"))
    tables = cl.FileTables(spark, {"in": str(tmp_path / "in")}, rows_per_batch=20, stream_log=str(tmp_path / "log"))
    stream = tables.stream_table("in", "name", {"id": (30, None)})
    read_up(write_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), trigger=GO_ON))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted((f"n{i}",) for i in range(30, 50))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "price" not in plan and "parts" not in plan


def test_steps_over_batches_cut_within_a_file(spark, tmp_path):
    records = [(t, s, s % 7 if t else 3, 100 + s) for s in range(1, 60) for t in (0, 1, 2)]
    schema = "test long, seq_id long, test_time long, unix_time long"
    add(spark.createDataFrame(records, schema).coalesce(1), str(tmp_path / "in"))
    tables = cl.FileTables(spark, {"in": str(tmp_path / "in")}, rows_per_batch=37, stream_log=str(tmp_path / "log"))
    read_up(stream_steps(tables.stream("in"), ["test"], str(tmp_path / "out"), trigger=GO_ON))
    want = add_step_features(spark.createDataFrame(records, schema), ["test"])
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert [r[1] for r in got.groupBy("batch").count().orderBy("batch").collect()] == [37] * 4 + [29]
    assert rows(read_steps(spark, str(tmp_path / "out")).select(*want.columns)) == rows(want)

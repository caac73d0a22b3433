"""A copy of the fleet that is brought up to date: only tests that changed are written again.

The copy has a folder per run with the tests it wrote, many to a file, and a manifest: per test the run that holds it, its
number of rows, a digest of the records it was made from and the number of tests that run wrote. Digests are sums and exclusive
ors of row hashes, so they combine before the shuffle and one scan of the records tells which tests changed; these alone are
joined and numbered. Runs of which every test still counts are read as they are, others by their tests.

Changed tests are written in batches of about ``batch_rows`` records. A batch is in the copy once its
manifest is, which Spark commits in one step, so readers see whole tests only, old or new, and a run that was broken off goes on
with the tests it had not finished. A test that left the catalogue stays in the copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.operators.chunks import content
from cyclerlake.plans.export import RECORD_LABEL, export_tests, read_export
from cyclerlake.plans.measurements import Cycler
from cyclerlake.session import landed
from cyclerlake.sources.catalogue import IDENTITY, unordered_tests

BATCH_ROWS = 2_000_000_000
MANIFEST = T.StructType(
    [
        *(T.StructField(k, T.LongType()) for k in IDENTITY),
        T.StructField("run", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("tests", T.LongType()),
    ]
)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(folder)) if system.exists(folder) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of the manifest."""
    found = [n for n in _names(spark, f"{path}/manifest") if n.startswith("version=")]
    return [int(n.split("=")[1]) for n in found if "_SUCCESS" in _names(spark, f"{path}/manifest/{n}")]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the copy holds: identity, run, records, digest, and the number of tests of the run (null: it has a folder per test)."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={max(versions)}")


def digests(main: DataFrame, aux: DataFrame | None, by: Sequence[str] = IDENTITY) -> DataFrame:
    """Records and digest per test, whatever the order of its records. Equal rows count as often as they are there."""

    def hashed(side: DataFrame, name: str) -> DataFrame:
        cells = ", ".join(c for c in sorted(content(side)) if c.strip("`") not in by)
        return side.selectExpr(*by, f"xxhash64('{name}', {cells}) AS one", f"xxhash64({cells}, '{name}') AS two")

    rows = hashed(main, "main")
    rows = rows if aux is None else rows.unionByName(hashed(aux, "aux"))
    total = "sum(CAST(one AS decimal(20, 0)))"
    return rows.groupBy(*by).agg(F.expr("count(*) AS records"), F.expr(f"concat_ws('/', count(*), {total}, bit_xor(two), bit_xor(one)) AS digest"))


# of the options of ``get_fleet``, those that choose records; the layout changes no result
PARTS = ("where", "main_columns", "aux_columns", "complete", "strict")


def _digests_of(cycler: Cycler, tests: DataFrame, options: dict) -> DataFrame:
    found = digests(*cycler.fleet_parts(tests, **{k: v for k, v in options.items() if k in PARTS}))
    how = repr(sorted((k, v) for k, v in options.items() if k not in ("layout", "snapshot")))
    return landed(found.withColumn("digest", F.concat_ws("/", "digest", F.crc32(F.lit(how)))), "clone-digests")


def clone_fleet(cycler: Cycler, path: str, chosen: DataFrame | None = None, fmt: str = "parquet", batch_rows: int = BATCH_ROWS, rows_per_file: int = 5_000_000, **options) -> int:
    """Bring the copy up to date with the chosen tests (all by default); gives the number of tests written.

    ``options`` are those of ``get_fleet``; a test that was written with other options is written anew.
    """
    spark = cycler.tables.spark
    tests = unordered_tests(cycler.tables, cycler.version) if chosen is None else chosen
    now = _digests_of(cycler, tests, options)
    known = manifest(spark, path).select(*IDENTITY, "digest")
    changed = now.join(known, [*IDENTITY, "digest"], "left_anti")
    size, rows = changed.agg(F.count("*"), F.sum("records")).first()
    if not size:
        return 0
    batches = -(-rows // batch_rows)
    # landed: the manifest that it is found by changes with every batch
    changed = landed(changed.withColumn("batch", F.pmod(F.xxhash64(*IDENTITY), F.lit(batches))), "clone-changed")
    for batch in range(batches):
        part = changed.where(F.col("batch") == batch).drop("batch")
        part_size = part.count()
        if part_size:
            _write_batch(cycler, path, tests, part.withColumn("tests", F.lit(part_size)), fmt, rows_per_file, options)
    return size


def _write_batch(cycler: Cycler, path: str, tests: DataFrame, part: DataFrame, fmt: str, rows_per_file: int, options: dict) -> None:
    spark, run = cycler.tables.spark, uuid.uuid4().hex
    fleet = cycler.get_fleet(tests.join(part.select(*IDENTITY), IDENTITY, "left_semi"), **options)
    export_tests(fleet, f"{path}/data/run={run}", fmt, IDENTITY, RECORD_LABEL, rows_per_file, False)
    versions = _versions(spark, path)
    kept = manifest(spark, path).join(part, IDENTITY, "left_anti")
    written = part.select(*IDENTITY, F.lit(run).alias("run"), "records", "digest", F.col("tests").cast("bigint"))
    # overwritten: a version without its mark of success is left over from a run that was broken off
    kept.unionByName(written).write.mode("overwrite").parquet(f"{path}/manifest/version={max(versions, default=0) + 1}")


def read_clone(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Measurements in the copy; ``schema`` is that of ``get_fleet``. Runs that no test is read from are not looked at."""
    whole = T.StructType([*schema, T.StructField("run", T.StringType())])
    known = manifest(spark, path)
    kinds: dict[str, list[str]] = {}
    for row in known.groupBy("run").agg(F.max("tests").alias("tests"), F.count("*").alias("held")).collect():
        kind = "folders" if row["tests"] is None else "whole" if row["tests"] == row["held"] else "parts"
        kinds.setdefault(kind, []).append(f"run={row['run']}")
    found = []
    for kind, runs in sorted(kinds.items()) or [("parts", [])]:
        rows = read_export(spark, f"{path}/data", whole, fmt, sorted(runs))
        if kind != "whole":
            rows = rows.join(known.select(*IDENTITY, "run"), [*IDENTITY, "run"], "left_semi")
        found.append(rows.select(*(f"`{c}`" for c in schema.fieldNames())))
    return reduce(DataFrame.unionByName, found)


def vacuum_clone(spark: SparkSession, path: str) -> list[str]:
    """Delete runs that no test is read from, and earlier manifests; not while a run or a reader is at work."""
    used = {row["run"] for row in manifest(spark, path).select("run").distinct().collect()}
    old = [n for n in _names(spark, f"{path}/data") if n.startswith("run=") and n[4:] not in used]
    latest = max(_versions(spark, path), default=0)
    stale = [n for n in _names(spark, f"{path}/manifest") if n != f"version={latest}"]
    for kind, names in (("data", old), ("manifest", stale)):
        for name in names:
            system, folder = _files(spark, f"{path}/{kind}/{name}")
            system.delete(folder, True)
    return old

"""Queries over the driver's tables and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cyclerlake as cl
from checks.views import load_views, with_views
from cyclerlake.functions.conversions import required_columns, transform_aux, transform_main
from cyclerlake.functions.vocabulary import convert
from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import add_step_features
from cyclerlake.operators.joins import join_aux, join_aux_with_steps
from cyclerlake.operators.reports import merge_sketches, quantiles, sketch_steps, summarise_export, summarise_steps, summarise_tests
from cyclerlake.operators.unions import select_union, union_all_columns
from cyclerlake.plans.clone import clone_fleet, read_clone
from cyclerlake.plans.export import export_tests, read_export
from cyclerlake.plans.records import RECORD_KEYS, aux_records, main_records
from cyclerlake.session import tune, work_folder
from cyclerlake.sources.catalogue import IDENTITY
from cyclerlake.sources.schemas import impose, record_schema
from cyclerlake.streaming.chunked import iter_chunks, map_chunks, map_exact_chunks, query_chunks, table_chunks
from cyclerlake.streaming.ordered import finish, read_ordered, stream_ordered
from cyclerlake.streaming.sinks import GO_ON, read_up, write_stream
from cyclerlake.streaming.steps import read_steps, stream_steps

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# small enough that the long tests of the small data span many chunks
FINE = Layout(chunk_records=1000)
# so small that the long tests' chunks count as hot
HOT = Layout(chunk_records=1000, hot_rows=300)


def check(name: str, sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        ORACLES[name] = with_views(sql)
        return query

    return register


def tables(spark: SparkSession, sf_dir: str) -> cl.FrameTables:
    tune(spark)
    return cl.FrameTables(spark, load_views(spark, sf_dir))


def files(spark: SparkSession, sf_dir: str, *names: str) -> cl.FileTables:
    return cl.FileTables(spark, {name: f"{sf_dir}/{name}.parquet" for name in names})


# -- SQL pieces ---------------------------------------------------------------------------------

# values of their own: what the package has under test is not asked
STEP_SQL = """CASE step_type WHEN 1 THEN 'CC Charge' WHEN 2 THEN 'CC Discharge' WHEN 4 THEN 'Rest' WHEN 5 THEN 'Cycle'
  WHEN 6 THEN 'End' WHEN 7 THEN 'CC-CV Charge' WHEN 8 THEN 'CP Discharge' WHEN 9 THEN 'CP Charge'
  WHEN 10 THEN 'CR Discharge' WHEN 20 THEN 'CC-CV Discharge' ELSE 'Unknown' END"""
# database name, label, code
NAMES = [
    ("step_id", "Step ID / 1", "step_id"),
    ("step_type", "Step Type / 1", "step_type"),
    ("step_index", "Step Index / 1", "step_index"),
    ("seq_id", "Record Count / 1", "record_count"),
    ("step_count", "Step Count / 1", "step_count"),
    ("cycle", "Cycle Count / 1", "cycle_count"),
    ("unix_time", "Unix Time / s", "unix_time"),
    ("test_atime", "Time / datetime", "time_datetime"),
    ("test_time", "Step Time / s", "step_time"),
    ("test_vol", "Voltage / V", "voltage_volt"),
    ("test_cur", "Current / A", "current_ampere"),
    ("test_tmp", "Temperature / degC", "temperature_celsius"),
    ("test_pow", "Power / W", "power_watt"),
    ("test_capchg", "Step Charging Capacity / Ah", "step_charging_capacity_ah"),
    ("test_capdchg", "Step Discharging Capacity / Ah", "step_discharging_capacity_ah"),
    ("test_engchg", "Step Charging Energy / Wh", "step_charging_energy_wh"),
    ("test_engdchg", "Step Discharging Energy / Wh", "step_discharging_energy_wh"),
    ("test_cap", "Step Capacity / Ah", "step_capacity_ah"),
    ("test_eng", "Step Energy / Wh", "step_energy_wh"),
]
NAMINGS = ("bts", "label", "code")
EPOCH_SQL = "CAST(floor(epoch_us(test_atime) / 1000000) AS BIGINT)"
MAGNITUDE_SQL = """CASE WHEN abs(cur_step_range) > 0 AND abs(cur_step_range) <= 999999 THEN abs(cur_step_range)
  WHEN abs(cur_step_range) BETWEEN 1000000 AND 999999999 THEN floor(cur_step_range / 1e9::DOUBLE)
  ELSE 0::DOUBLE END"""
SCALE_SQL = """CASE WHEN cur_step_range > 0 THEN
    CASE WHEN cur_step_range < 10 THEN 1e4::DOUBLE WHEN cur_step_range < 100 THEN 1e3::DOUBLE
      WHEN cur_step_range < 1000 THEN 1e2::DOUBLE ELSE 1e1::DOUBLE END
  ELSE CASE WHEN d_cur_step_range < 0.01::DOUBLE THEN 1e8::DOUBLE WHEN d_cur_step_range < 0.1::DOUBLE THEN 1e7::DOUBLE
      WHEN d_cur_step_range < 1 THEN 1e6::DOUBLE WHEN d_cur_step_range < 10 THEN 1e5::DOUBLE
      WHEN d_cur_step_range < 100 THEN 1e4::DOUBLE WHEN d_cur_step_range < 1000 THEN 1e3::DOUBLE
      ELSE 1e2::DOUBLE END END"""
IDS = "dev_uid, unit_id, chl_id, test_id"


def factor_sql(name: str) -> str:
    return f"""CASE factor_{name} WHEN 0 THEN scale_cur * 1e3::DOUBLE * 3600 WHEN 1 THEN scale_cur
  WHEN 2 THEN scale_cur * 1e3::DOUBLE END AS scale_{name}"""


def select_24(source: str, extra: str = "") -> str:
    """Converted type 24 records; ``extra`` columns are passed through, with a leading comma."""
    scales = ", ".join(factor_sql(n) for n in ("capchg", "capdchg", "engchg", "engdchg"))
    return f"""
SELECT seq_id, cycle, step_id, step_type, unix_time, test_atime, test_time, test_vol, test_cur,
  test_cur * test_vol AS test_pow, test_capchg, test_capdchg, test_engchg, test_engdchg,
  test_capchg - test_capdchg AS test_cap, test_engchg - test_engdchg AS test_eng{extra}
FROM (SELECT seq_id, cycle, step_id, {STEP_SQL} AS step_type, {EPOCH_SQL} AS unix_time, test_atime,
  test_time / 1e3::DOUBLE AS test_time, test_vol / 1e4::DOUBLE AS test_vol,
  test_cur / (scale_cur * 1e3::DOUBLE) AS test_cur,
  test_capchg / scale_capchg AS test_capchg, test_capdchg / scale_capdchg AS test_capdchg,
  test_engchg / scale_engchg AS test_engchg, test_engdchg / scale_engdchg AS test_engdchg{extra}
  FROM (SELECT *, {scales} FROM (SELECT *, {SCALE_SQL} AS scale_cur
    FROM (SELECT *, {MAGNITUDE_SQL} AS d_cur_step_range FROM {source}) a) b) c) d"""


def select_26(source: str, extra: str = "") -> str:
    def amount(n: str) -> str:
        return f"CAST({n} AS DOUBLE) / 3600 / 1e3::DOUBLE AS {n}"

    return f"""
SELECT seq_id, cycle, step_id, step_type, unix_time, test_atime, test_time, test_vol, test_cur,
  test_vol * test_cur AS test_pow, test_capchg, test_capdchg, test_engchg, test_engdchg,
  test_capchg - test_capdchg AS test_cap, test_engchg - test_engdchg AS test_eng{extra}
FROM (SELECT seq_id, cycle, step_id, {STEP_SQL} AS step_type, {EPOCH_SQL} AS unix_time, test_atime,
  test_time / 1e3::DOUBLE AS test_time, CAST(test_vol AS DOUBLE) / 1e4::DOUBLE AS test_vol,
  CAST(test_cur AS DOUBLE) / 1e3::DOUBLE AS test_cur,
  {amount('test_capchg')}, {amount('test_capdchg')}, {amount('test_engchg')}, {amount('test_engdchg')}{extra}
  FROM {source}) c"""


def steps_sql(source: str, by: str, order: str = "seq_id", total: bool = True) -> str:
    elapsed = f", unix_time - min(unix_time) OVER (PARTITION BY {by}) AS test_totaltime" if total else ""
    return f"""
SELECT *, seq_id - min(seq_id) OVER (PARTITION BY {by}, step_count) + 1 AS step_index
FROM (SELECT *, CAST(sum(CASE WHEN test_time = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {by} ORDER BY {order}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS step_count{elapsed} FROM ({source}) conv) counted"""


def published_sql(source: str, leading: str = "", naming: str = "label") -> str:
    names = ", ".join(f'{name[0]} AS "{name[NAMINGS.index(naming)]}"' for name in NAMES)
    return f"SELECT {leading}{names} FROM ({source}) s"


# records and auxiliary records per test, routed as the catalogue says
FLEET_MAIN_SQL = f"""
SELECT * FROM ({select_24("(SELECT r.*, t.dev_uid FROM rec_all r JOIN test t USING (unit_id, chl_id, test_id)) m24",
  ", " + IDS)}) p24
UNION ALL
SELECT * FROM ({select_26("(SELECT r.*, t.dev_uid FROM rec_all r JOIN h_test t USING (unit_id, chl_id, test_id)) m26",
  ", " + IDS)}) p26"""
FLEET_AUX_SQL = """
SELECT unit_id, chl_id, test_id, seq_id, auxchl_id, test_tmp / 10::DOUBLE AS test_tmp
FROM (SELECT * FROM aux_live UNION ALL SELECT * FROM aux_hist_0) x WHERE unit_id < 4"""


def joined_sql(main: str, aux: str) -> str:
    return f"""
SELECT m.*, x.auxchl_id, x.test_tmp FROM ({main}) m
LEFT JOIN ({aux}) x ON m.seq_id = x.seq_id AND m.unit_id = x.unit_id AND m.chl_id = x.chl_id AND m.test_id = x.test_id"""


# -- scans, projections, predicates ---------------------------------------------------------------

LINE = "l_orderkey, l_linenumber, l_quantity, l_extendedprice"
LINE_COLUMNS = LINE.split(", ")


@check("scan_project", f"SELECT {LINE} FROM lineitem")
def scan_project(spark, sf_dir):
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS)


@check("scan_one_column", "SELECT o_orderkey FROM orders")
def scan_one_column(spark, sf_dir):
    return files(spark, sf_dir, "orders").get_table("orders", "o_orderkey")


@check("pred_between", f"SELECT {LINE} FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def pred_between(spark, sf_dir):
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS, {"l_quantity": (10, 20)})


@check("pred_ge", f"SELECT {LINE} FROM lineitem WHERE l_quantity >= 45")
def pred_ge(spark, sf_dir):
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS, {"l_quantity": (45, None)})


@check("pred_le", f"SELECT {LINE} FROM lineitem WHERE l_discount <= 0.02")
def pred_le(spark, sf_dir):
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS, {"l_discount": (None, 0.02)})


@check("pred_in", f"SELECT {LINE} FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def pred_in(spark, sf_dir):
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS, {"l_returnflag": ["A", "R"]})


@check("pred_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def pred_eq(spark, sf_dir):
    return files(spark, sf_dir, "events").get_table(
        "events", ["event_id", "user_id", "value"], {"event_type": "purchase"}
    )


@check("pred_is_null", "SELECT test_id, seq_id, test_cur FROM rec_all WHERE cur_step_range IS NULL")
def pred_is_null(spark, sf_dir):
    return tables(spark, sf_dir).get_table("rec_all", ["test_id", "seq_id", "test_cur"], {"cur_step_range": None})


@check(
    "pred_and",
    f"SELECT {LINE} FROM lineitem WHERE l_quantity >= 10 AND l_discount <= 0.05 AND l_linestatus = 'O'"
    " AND l_returnflag IN ('N', 'A') AND l_tax BETWEEN 0.01 AND 0.06",
)
def pred_and(spark, sf_dir):
    where = {
        "l_quantity": (10, None),
        "l_discount": (None, 0.05),
        "l_linestatus": "O",
        "l_returnflag": ["N", "A"],
        "l_tax": (0.01, 0.06),
    }
    return files(spark, sf_dir, "lineitem").get_table("lineitem", LINE_COLUMNS, where)


@check(
    "sql_text",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(user_id) AS low FROM events GROUP BY event_type",
)
def sql_text(spark, sf_dir):
    return files(spark, sf_dir, "events").query(
        "SELECT event_type, count(*) AS n, min(user_id) AS low FROM events GROUP BY event_type"
    )


# -- unions and routing ---------------------------------------------------------------------------

COMMON = "seq_id, test_id, test_tmp, test_vol"


@check(
    "union_common_columns",
    "SELECT auxchl_id, chl_id, seq_id, test_id, test_tmp, test_vol, unit_id FROM aux_live"
    " UNION ALL SELECT auxchl_id, chl_id, seq_id, test_id, test_tmp, test_vol, unit_id FROM aux_hist_0",
)
def union_common_columns(spark, sf_dir):
    t = tables(spark, sf_dir)
    return select_union(t.frame("aux_live"), t.frame("aux_hist_0"))


@check(
    "union_different_columns",
    "SELECT chl_id, seq_id, test_id, test_tmp, test_vol, unit_id FROM rec_live"
    " UNION ALL SELECT chl_id, seq_id, test_id, test_tmp, test_vol, unit_id FROM aux_live",
)
def union_different_columns(spark, sf_dir):
    t = tables(spark, sf_dir)
    return select_union(t.frame("rec_live"), t.frame("aux_live"))


@check(
    "union_per_table_where",
    f"SELECT {COMMON} FROM rec_live WHERE test_vol >= 35000 UNION ALL SELECT {COMMON} FROM rec_hist_0",
)
def union_per_table_where(spark, sf_dir):
    t = tables(spark, sf_dir)
    return select_union(
        t.frame("rec_live"),
        t.frame("rec_hist_0"),
        columns=COMMON.split(", "),
        wheres=[{"test_vol": (35000, None)}, None],
    )


@check(
    "union_shared_where",
    f"SELECT {COMMON} FROM rec_live WHERE test_vol <= 35000 AND step_type IN (1, 4)"
    f" UNION ALL SELECT {COMMON} FROM rec_hist_0 WHERE test_vol <= 35000 AND step_type IN (1, 4)",
)
def union_shared_where(spark, sf_dir):
    t = tables(spark, sf_dir)
    return select_union(
        t.frame("rec_live"),
        t.frame("rec_hist_0"),
        columns=COMMON.split(", "),
        wheres={"test_vol": (None, 35000), "step_type": [1, 4]},
    )


DIAGONAL_SQL = """SELECT dev_uid, unit_id, chl_id, test_id, main_first_table, main_second_table, aux_first_table,
  aux_second_table, CAST(NULL AS BIGINT) AS last_seq FROM test
UNION ALL SELECT dev_uid, unit_id, chl_id, test_id, main_first_table, NULL, aux_first_table, NULL, last_seq FROM h_test"""


@check("union_diagonal", DIAGONAL_SQL)
def union_diagonal(spark, sf_dir):
    t = tables(spark, sf_dir)
    return union_all_columns([t.frame("test"), t.frame("h_test")])


@check(
    "union_number_and_text",
    "SELECT CAST(test_vol AS VARCHAR) AS v, seq_id FROM rec_all UNION ALL SELECT event_type AS v, NULL FROM events",
)
def union_number_and_text(spark, sf_dir):
    t = tables(spark, sf_dir)
    words = files(spark, sf_dir, "events").get_table("events", "event_type")
    return union_all_columns([t.get_table("rec_all", ["test_vol", "seq_id"]).withColumnRenamed("test_vol", "v"), words.withColumnRenamed("event_type", "v")])


# the two long tests, one per device type, and others for the remaining routes
TEST_24 = {
    "dev_uid": 240001,
    "unit_id": 1,
    "chl_id": 1,
    "test_id": 0,
    "main_first_table": "rec_live",
    "main_second_table": "rec_hist_0",
    "aux_first_table": "aux_live",
    "aux_second_table": "aux_hist_0",
}
TEST_26 = {
    "dev_uid": 260001,
    "unit_id": 3,
    "chl_id": 3,
    "test_id": 2,
    "main_first_table": "rec_live",
    "aux_first_table": "aux_live",
}
TEST_26_SECOND = {**TEST_26, "aux_first_table": None, "aux_second_table": "aux_live"}
TEST_26_NO_AUX = {**TEST_26, "aux_first_table": None}
MAIN_PART = ["seq_id", "test_vol", "test_cur", "cur_step_range"]
AUX_PART = ["auxchl_id", "seq_id", "test_tmp"]
IS_26 = "unit_id = 3 AND chl_id = 3 AND test_id = 2"
AUX_SQL = "SELECT auxchl_id, seq_id, test_tmp FROM "


@check(
    "main_route_one_table",
    f"SELECT seq_id, CAST(test_vol AS DOUBLE) AS test_vol, CAST(test_cur AS DOUBLE) AS test_cur, cur_step_range"
    f" FROM rec_live WHERE {IS_26}",
)
def main_route_one_table(spark, sf_dir):
    return main_records(tables(spark, sf_dir).frame, "0800", TEST_26, columns=MAIN_PART)


@check(
    "main_route_two_tables",
    "SELECT seq_id, test_vol, test_cur, cur_step_range FROM rec_all"
    " WHERE test_id = 0 AND (test_vol >= 33000)",
)
def main_route_two_tables(spark, sf_dir):
    return main_records(
        tables(spark, sf_dir).frame, "0800", TEST_24, where={"test_vol": (33000, None)}, columns=MAIN_PART
    )


@check("aux_route_first", f"{AUX_SQL} aux_live WHERE {IS_26}")
def aux_route_first(spark, sf_dir):
    return aux_records(tables(spark, sf_dir).frame, "0800", TEST_26, columns=AUX_PART)


@check("aux_route_second", f"{AUX_SQL} aux_live WHERE {IS_26} AND test_vol <= 38000")
def aux_route_second(spark, sf_dir):
    where = {"test_vol": (None, 38000)}
    return aux_records(tables(spark, sf_dir).frame, "0800", TEST_26_SECOND, where, AUX_PART)


@check("aux_route_both", f"{AUX_SQL} aux_live WHERE test_id = 0 UNION ALL {AUX_SQL} aux_hist_0")
def aux_route_both(spark, sf_dir):
    return aux_records(tables(spark, sf_dir).frame, "0800", TEST_24, columns=AUX_PART)


# -- catalogue ------------------------------------------------------------------------------------


@check("version_distinct", "SELECT DISTINCT version FROM db_ver")
def version_distinct(spark, sf_dir):
    return tables(spark, sf_dir).query("SELECT DISTINCT version FROM db_ver")


@check("catalogue_0800", DIAGONAL_SQL)
def catalogue_0800(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).tests()


@check(
    "catalogue_0760",
    f"SELECT d.*, n.note FROM ({DIAGONAL_SQL}) d LEFT JOIN test_note n USING (dev_uid, unit_id, chl_id, test_id)",
)
def catalogue_0760(spark, sf_dir):
    t = tables(spark, sf_dir)
    old = t.frame("db_ver").withColumn("version", F.lit("0760"))
    return cl.connect(cl.FrameTables(spark, {**t.frames, "db_ver": old})).tests()


PLACED_SQL = f"SELECT *, row_number() OVER (ORDER BY {IDS}) - 1 AS place FROM ({DIAGONAL_SQL}) d"


def split_catalogue(spark: SparkSession, sf_dir: str) -> cl.FrameTables:
    """Two history tables, named against the order of their tests."""
    t = tables(spark, sf_dir)
    history = t.frame("h_test")
    parts = {"h_test_b": history.where("unit_id = 3"), "h_test_a": history.where("unit_id <> 3")}
    return cl.FrameTables(spark, {**{n: f for n, f in t.frames.items() if n != "h_test"}, **parts})


@check("catalogue_ordered", PLACED_SQL)
def catalogue_ordered(spark, sf_dir):
    """The order of the catalogue as a column."""
    return cl.connect(split_catalogue(spark, sf_dir)).placed_tests()


@check("tests_listed", PLACED_SQL)
def tests_listed(spark, sf_dir):
    """The list of tests as the caller gets it."""
    t = split_catalogue(spark, sf_dir)
    schema = cl.connect(t).tests().schema.add("place", "long")
    return spark.createDataFrame([(*test.values(), place) for place, test in enumerate(cl.list_tests(t))], schema)


LISTED = sorted(["events", "orders", "customer", "region", "lineitem"])


@check("tables_listed", " UNION ALL ".join(f"SELECT {i} AS place, '{name}' AS name, count(*) AS n_rows FROM {name}" for i, name in enumerate(LISTED)))
def tables_listed(spark, sf_dir):
    """Names in order, each with the rows behind it."""
    source = files(spark, sf_dir, "region", "orders", "events", "lineitem", "customer")
    counts = [source.frame(name).agg(F.lit(i).alias("place"), F.lit(name).alias("name"), F.count("*").alias("n_rows")) for i, name in enumerate(source.names())]
    return reduce(DataFrame.unionByName, counts)


# the Python type of each column's values
EVENT_TYPES = {"event_id": "int", "ts": "datetime", "user_id": "int", "event_type": "str", "value": "float", "props": "str"}


@check(
    "table_schema_report",
    " UNION ALL ".join(f"SELECT '{name}' AS name, '{kind}' AS kind, count({name}) AS present FROM events" for name, kind in EVENT_TYPES.items()),
)
def table_schema_report(spark, sf_dir):
    """Columns and types of a table, each with the number of values that are present."""
    source = files(spark, sf_dir, "events")
    told = source.table_schema("events")
    present = source.frame("events").agg(*(F.count(name).alias(name) for name in told))
    rows = [F.struct(F.lit(name).alias("name"), F.lit(kind.__name__).alias("kind"), F.col(name).alias("present")) for name, kind in told.items()]
    return present.select(F.inline(F.array(*rows)))


# -- conversions ----------------------------------------------------------------------------------

CONVERTED = [name for name, *_ in NAMES if name not in ("step_index", "step_count", "test_tmp")]


def main_frame(spark: SparkSession, sf_dir: str, dev_uid: int, name: str = "rec_all") -> DataFrame:
    schema = record_schema("0800", dev_uid, "main")
    return impose(tables(spark, sf_dir).get_table(name, [*RECORD_KEYS, *(c for c in schema.fieldNames() if c not in RECORD_KEYS)]), schema)


@check("convert_24", select_24("rec_all", ", test_id"))
def convert_24(spark, sf_dir):
    return transform_main(main_frame(spark, sf_dir, 240001), "0800", 240001).select(*CONVERTED, "test_id")


@check("convert_24_temperature", "SELECT seq_id, test_id, test_tmp / 1e1::DOUBLE AS test_tmp FROM rec_all")
def convert_24_temperature(spark, sf_dir):
    return transform_main(main_frame(spark, sf_dir, 240001), "0800", 240001).select("seq_id", "test_id", "test_tmp")


@check(
    "convert_24_scales",
    f"""SELECT seq_id, d_cur_step_range, scale_cur, {", ".join(factor_sql(n) for n in ("capchg", "capdchg", "engchg", "engdchg"))}
FROM (SELECT *, {SCALE_SQL} AS scale_cur FROM (SELECT *, {MAGNITUDE_SQL} AS d_cur_step_range FROM rec_all) a) b""",
)
def convert_24_scales(spark, sf_dir):
    done = transform_main(main_frame(spark, sf_dir, 240001), "0800", 240001)
    scales = ["scale_capchg", "scale_capdchg", "scale_engchg", "scale_engdchg"]
    return done.select("seq_id", "d_cur_step_range", "scale_cur", *scales)


@check(
    "convert_0760_24",
    select_24("(SELECT * REPLACE (CAST(trunc(cur_step_range) AS BIGINT) AS cur_step_range) FROM rec_all) whole", ", test_id"),
)
def convert_0760_24(spark, sf_dir):
    raw = impose(main_frame(spark, sf_dir, 240001), record_schema("0760", 240001, "main"))
    return transform_main(raw, "0760", 240001).select(*CONVERTED, "test_id")


@check(
    "convert_24_missing_range",
    f"""SELECT seq_id, test_time / 1e3::DOUBLE AS test_time, test_vol, test_cur, test_cur * test_vol AS test_pow, test_capchg
FROM (SELECT seq_id, test_time, test_vol / 1e4::DOUBLE AS test_vol, test_cur, test_capchg FROM rec_all) r""",
)
def convert_24_missing_range(spark, sf_dir):
    raw = main_frame(spark, sf_dir, 240001).drop("cur_step_range")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        done = transform_main(raw, "0800", 240001)
    return done.select("seq_id", "test_time", "test_vol", "test_cur", "test_pow", "test_capchg")


@check(
    "convert_26",
    f"""SELECT c.*, CAST(r.total_cap AS DOUBLE) / 3600 / 1e3::DOUBLE AS total_cap,
  CAST(r.total_eng AS DOUBLE) / 3600 / 1e3::DOUBLE AS total_eng, r.test_tmp / 1e1::DOUBLE AS test_tmp
FROM ({select_26("rec_all")}) c JOIN rec_all r USING (seq_id)""",
)
def convert_26(spark, sf_dir):
    done = transform_main(main_frame(spark, sf_dir, 260001), "0800", 260001)
    return done.select(*CONVERTED, "total_cap", "total_eng", "test_tmp")


@check(
    "convert_aux",
    "SELECT unit_id, chl_id, test_id, seq_id, auxchl_id, test_tmp / 10::DOUBLE AS test_tmp, test_vol FROM aux_live",
)
def convert_aux(spark, sf_dir):
    return transform_aux(tables(spark, sf_dir).frame("aux_live"), "0800", 240001)


@check(
    "required_columns",
    "SELECT cur_step_range, factor_capchg, factor_capdchg, test_capchg, test_capdchg, test_cur, test_vol FROM rec_all",
)
def needed_columns(spark, sf_dir):
    needed = required_columns(["test_cap", "test_pow"], "0800", 240001)
    return tables(spark, sf_dir).get_table("rec_all", needed)


# -- step features --------------------------------------------------------------------------------

TIMED = ["test_id", "seq_id", "test_time", "test_atime", "test_vol"]
TIMED_SQL = f"SELECT test_id, seq_id, test_time / 1e3::DOUBLE AS test_time, {EPOCH_SQL} AS unix_time FROM rec_all"


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables(spark, sf_dir).get_table("rec_all", TIMED)
    return transform_main(raw, "0800", 260001).select("test_id", "seq_id", "test_time", "unix_time")


@check("step_features", steps_sql(TIMED_SQL, "test_id"))
def step_features(spark, sf_dir):
    return add_step_features(timed(spark, sf_dir), ["test_id"])


@check("step_features_chunked", steps_sql(TIMED_SQL, "test_id"))
def step_features_chunked(spark, sf_dir):
    return add_step_features(timed(spark, sf_dir), ["test_id"], FINE)


@check("step_features_hot_chunks", steps_sql(TIMED_SQL, "test_id"))
def step_features_hot_chunks(spark, sf_dir):
    return add_step_features(timed(spark, sf_dir), ["test_id"], HOT)


@check("step_features_one_frame", steps_sql(TIMED_SQL.replace("SELECT test_id", "SELECT 1 AS one, test_id"), "one"))
def step_features_one_frame(spark, sf_dir):
    # the whole database as a single series, as the per-test call sees a test
    return add_step_features(timed(spark, sf_dir), [], FINE).withColumn("one", F.lit(1))


@check(
    "step_index_of_given_steps",
    """SELECT test_id, cycle AS step_count, seq_id,
  seq_id - min(seq_id) OVER (PARTITION BY test_id, cycle) + 1 AS step_index FROM rec_all""",
)
def step_index_of_given_steps(spark, sf_dir):
    raw = tables(spark, sf_dir).get_table("rec_all", ["test_id", "cycle", "seq_id"])
    return add_step_features(raw.withColumnRenamed("cycle", "step_count"), ["test_id"])


FANOUT_SQL = f"""SELECT m.test_id, m.seq_id, m.test_time, m.unix_time, x.auxchl_id, x.test_tmp FROM ({TIMED_SQL}) m
LEFT JOIN (SELECT * FROM aux_live UNION ALL SELECT * FROM aux_hist_0) x ON x.test_id = m.test_id AND x.seq_id = m.seq_id"""


def fanout_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = tables(spark, sf_dir)
    aux = select_union(t.frame("aux_live"), t.frame("aux_hist_0"), columns=["test_id", *AUX_PART])
    return timed(spark, sf_dir), aux


@check("aux_join", FANOUT_SQL)
def aux_join(spark, sf_dir):
    return join_aux(*fanout_sides(spark, sf_dir), ["test_id"], FINE)


# an id with up to twenty main rows and as many channels
COPIES_MAIN_SQL = "SELECT user_id % 3 AS test_id, CAST(floor(event_id / 20) AS BIGINT) AS seq_id, event_id AS test_vol FROM events"
COPIES_AUX_SQL = "SELECT user_id % 3 AS test_id, CAST(floor(event_id / 20) AS BIGINT) AS seq_id, event_id % 20 AS auxchl_id FROM events"


@check("aux_join_copies", f"SELECT test_id, seq_id, test_vol, auxchl_id FROM ({COPIES_MAIN_SQL}) m LEFT JOIN ({COPIES_AUX_SQL}) a USING (test_id, seq_id)")
def aux_join_copies(spark, sf_dir):
    """Chunks whose sides are below the limit, but not their join."""
    source = files(spark, sf_dir, "events")
    layout = Layout(chunk_records=10, hot_rows=60, task_rows=50)
    return join_aux(source.query(COPIES_MAIN_SQL), source.query(COPIES_AUX_SQL), ["test_id"], layout)


@check("step_features_fanout", steps_sql(FANOUT_SQL, "test_id", "seq_id, auxchl_id"))
def step_features_fanout(spark, sf_dir):
    return join_aux_with_steps(*fanout_sides(spark, sf_dir), ["test_id"])


@check("step_features_fanout_hot", steps_sql(FANOUT_SQL, "test_id", "seq_id, auxchl_id"))
def step_features_fanout_hot(spark, sf_dir):
    return join_aux_with_steps(*fanout_sides(spark, sf_dir), ["test_id"], HOT)


@check("step_features_fanout_chunked", steps_sql(FANOUT_SQL, "test_id", "seq_id, auxchl_id"))
def step_features_fanout_chunked(spark, sf_dir):
    return join_aux_with_steps(*fanout_sides(spark, sf_dir), ["test_id"], FINE)


# forty different rows to an id, with and without channels, starts among them
TIED_SQL = """SELECT user_id % 3 AS test_id, CAST(floor(event_id / 40) AS BIGINT) AS seq_id,
  CASE WHEN event_id % 5 > 0 THEN event_id % 3 END AS auxchl_id, event_id % 4 AS test_time, event_id AS test_vol FROM events"""
TIED_ORDER = "seq_id, auxchl_id NULLS FIRST, test_time, test_vol"


def tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir, "events").query(TIED_SQL)


@check("step_features_ties", steps_sql(TIED_SQL, "test_id", TIED_ORDER, total=False))
def step_features_ties(spark, sf_dir):
    return add_step_features(tied(spark, sf_dir), ["test_id"])


@check("step_features_ties_chunked", steps_sql(TIED_SQL, "test_id", TIED_ORDER, total=False))
def step_features_ties_chunked(spark, sf_dir):
    return add_step_features(tied(spark, sf_dir), ["test_id"], Layout(chunk_records=20, block_chunks=3))


@check("step_features_ties_hot", steps_sql(TIED_SQL, "test_id", TIED_ORDER, total=False))
def step_features_ties_hot(spark, sf_dir):
    return add_step_features(tied(spark, sf_dir), ["test_id"], Layout(chunk_records=20, hot_rows=5))


# -- names ----------------------------------------------------------------------------------------

def renamed_sql(naming: str) -> str:
    known = [name for name in NAMES if name[0] in RAW_TERMS]
    return f"""SELECT test_id, {", ".join(f'{name[0]} AS "{name[NAMINGS.index(naming)]}"' for name in known)} FROM rec_all"""


RAW_TERMS = ["step_id", "step_type", "seq_id", "cycle", "test_atime", "test_time", "test_vol", "test_cur", "test_capchg"]


def raw_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).get_table("rec_all", ["test_id", *RAW_TERMS])


@check("rename_label", renamed_sql("label"))
def rename_label(spark, sf_dir):
    return convert(raw_terms(spark, sf_dir))


@check("rename_code", renamed_sql("code"))
def rename_code(spark, sf_dir):
    return convert(raw_terms(spark, sf_dir), "bts", "code")


@check("rename_back", renamed_sql("bts"))
def rename_back(spark, sf_dir):
    there = convert(convert(raw_terms(spark, sf_dir), "bts", "label"), "label", "code")
    return convert(there, "code", "bts")


# -- measurements of a test and of the fleet ------------------------------------------------------

KEYED = ", unit_id, chl_id, test_id"


def data_sql(main: str, aux: str, order: str = "seq_id, auxchl_id") -> str:
    return published_sql(steps_sql(joined_sql(main, aux), "unit_id, chl_id, test_id", order, total=False))


def aux_sql(condition: str = "TRUE") -> str:
    return f"""SELECT unit_id, chl_id, test_id, seq_id, auxchl_id, test_tmp / 10::DOUBLE AS test_tmp
FROM (SELECT * FROM aux_live UNION ALL SELECT * FROM aux_hist_0) u WHERE {condition}"""


MAIN_26_SQL = select_26(f"(SELECT * FROM rec_all WHERE {IS_26}) t26", KEYED)
MAIN_24_SQL = select_24("(SELECT * FROM rec_all WHERE test_id = 0) t24", KEYED)


@check("get_data_26", data_sql(MAIN_26_SQL, aux_sql()))
def get_data_26(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_26)


@check("get_data_24", data_sql(MAIN_24_SQL, aux_sql()))
def get_data_24(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_24)


@check("get_data_no_aux", data_sql(MAIN_26_SQL, aux_sql("FALSE")))
def get_data_no_aux(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_26_NO_AUX)


@check(
    "get_data_where",
    data_sql(select_24("(SELECT * FROM rec_all WHERE test_id = 0 AND test_vol BETWEEN 31000 AND 39000) t24", KEYED),
             aux_sql("test_vol BETWEEN 31000 AND 39000")),
)
def get_data_where(spark, sf_dir):
    where = {"test_vol": (31000, 39000)}
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_24, where=where, layout=FINE)


RECORD_SCOPE_SQL = f"""
SELECT m.*, x.auxchl_id, x.test_tmp FROM ({steps_sql(MAIN_24_SQL, "test_id", total=False)}) m
LEFT JOIN ({aux_sql()}) x ON m.seq_id = x.seq_id AND m.unit_id = x.unit_id AND m.chl_id = x.chl_id AND m.test_id = x.test_id"""


@check("get_data_record_scope", published_sql(RECORD_SCOPE_SQL))
def get_data_record_scope(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_24, step_scope="record", layout=FINE)


@check("get_data_complete", data_sql(MAIN_24_SQL, aux_sql()))
def get_data_complete(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_data(TEST_24, main_columns=["test_cap"], complete=True, layout=FINE)


def fleet_sql(steps: str, naming: str = "label") -> str:
    return published_sql(steps, IDS + ", ", naming)


FLEET_JOINED_SQL = joined_sql(FLEET_MAIN_SQL, FLEET_AUX_SQL)
FLEET_SQL = steps_sql(FLEET_JOINED_SQL, IDS, "seq_id, auxchl_id", total=False)


@check("get_data_fleet", fleet_sql(FLEET_SQL))
def get_data_fleet(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_fleet()


@check("get_data_fleet_hot", fleet_sql(FLEET_SQL))
def get_data_fleet_hot(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_fleet(layout=HOT)


FLEET_RECORD_SQL = f"""
SELECT m.*, x.auxchl_id, x.test_tmp FROM ({steps_sql(FLEET_MAIN_SQL, IDS, total=False)}) m
LEFT JOIN ({FLEET_AUX_SQL}) x ON m.seq_id = x.seq_id AND m.unit_id = x.unit_id AND m.chl_id = x.chl_id AND m.test_id = x.test_id"""


@check("get_data_fleet_record_scope", fleet_sql(FLEET_RECORD_SQL))
def get_data_fleet_record_scope(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_fleet(step_scope="record", layout=FINE)


WHOLE_RANGE_SQL = "(SELECT * REPLACE (CAST(trunc(cur_step_range) AS BIGINT) AS cur_step_range) FROM rec_all WHERE test_id = 0)"


@check("get_data_0760", data_sql(select_24(f"{WHOLE_RANGE_SQL} w24", KEYED), aux_sql()))
def get_data_0760(spark, sf_dir):
    t = tables(spark, sf_dir)
    old = t.frame("db_ver").withColumn("version", F.lit("0760"))
    return cl.connect(cl.FrameTables(spark, {**t.frames, "db_ver": old})).get_data(TEST_24, layout=FINE)


FLEET_WHERE_SQL = steps_sql(
    joined_sql(FLEET_MAIN_SQL.replace("FROM rec_all r", "FROM (SELECT * FROM rec_all WHERE seq_id >= 500) r"),
               FLEET_AUX_SQL + " AND seq_id >= 500"),
    IDS, "seq_id, auxchl_id", total=False)


@check("get_data_fleet_where", fleet_sql(FLEET_WHERE_SQL))
def get_data_fleet_where(spark, sf_dir):
    return cl.connect(tables(spark, sf_dir)).get_fleet(where={"seq_id": (500, None)}, layout=FINE)


HALF = "(SELECT max(event_id) // 2 FROM events)"
LIVE_SQL = steps_sql(
    joined_sql(FLEET_MAIN_SQL.replace("FROM rec_all r", f"FROM (SELECT * FROM rec_all WHERE seq_id <= {HALF}) r"),
               FLEET_AUX_SQL + f" AND seq_id <= {HALF}"),
    IDS, "seq_id, auxchl_id", total=False)


class Clock:
    """A number that every job reads anew: how far a tester has come."""

    def __init__(self, spark: SparkSession) -> None:
        self.folder = Path(work_folder(spark, "clock").removeprefix("file:"))
        self.folder.mkdir(parents=True)

        def now(batches, path=str(self.folder / "now")):
            for batch in batches:
                yield batch.assign(now=int(Path(path).read_text()))[["now"]]

        self.frame = spark.range(1).mapInPandas(now, "now bigint")

    def set(self, now: int) -> None:
        (self.folder / "now").write_text(str(now))


@check("get_data_fleet_live", fleet_sql(LIVE_SQL))
def get_data_fleet_live(spark, sf_dir):
    """The fleet while all tables grow: half of all records are there at the call, all when the result is used."""
    t, clock = tables(spark, sf_dir), Clock(spark)
    last = spark.table("events").agg(F.max("event_id")).first()[0]
    growing = {n: t.frame(n).where(F.col("seq_id") <= clock.frame.scalar()) for n in ("rec_live", "rec_hist_0", "aux_live", "aux_hist_0")}
    clock.set(last // 2)
    fleet = cl.connect(cl.FrameTables(spark, {**t.frames, **growing})).get_fleet(layout=FINE, snapshot=True)
    clock.set(last + 1)
    return fleet


# -- streams --------------------------------------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str, *names: str) -> cl.FileTables:
    """The views landed as files, which is what a stream reads."""
    t = tables(spark, sf_dir)
    folder = work_folder(spark, "staged")
    for name in names:
        t.frame(name).write.parquet(f"{folder}/{name}")
    return cl.FileTables(spark, {name: f"{folder}/{name}" for name in names})


def streamed(spark: SparkSession, df: DataFrame) -> DataFrame:
    folder = work_folder(spark, "stream")
    write_stream(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@check("stream_table", "SELECT event_id, user_id, value FROM events WHERE value >= 20")
def stream_table(spark, sf_dir):
    # a pattern names a single file and a folder of files alike
    source = cl.FileTables(spark, {"events": f"{sf_dir}/events.parque[t]"})
    return streamed(spark, source.stream_table("events", ["event_id", "user_id", "value"], {"value": (20, None)}))


def by_rows(spark: SparkSession, paths: dict[str, str], rows: int, folder: str) -> cl.FileTables:
    """The same files, at most so many rows of each table at a time."""
    return cl.FileTables(spark, paths, rows_per_batch=rows, stream_log=f"{folder}/log")


def event_files(spark: SparkSession, sf_dir: str) -> tuple[int, dict[str, str]]:
    """The events landed as files, in a folder that not only Spark reads, and their number."""
    folder, events = work_folder(spark, "staged"), files(spark, sf_dir, "events").frame("events")
    events.write.parquet(f"{folder}/events")
    return events.count(), {"events": f"{folder}/events"}


@check("stream_table_rows", "SELECT event_id, user_id, value FROM events WHERE value >= 20")
def stream_table_rows(spark, sf_dir):
    folder, rows, landed_events = work_folder(spark, "rows"), *event_files(spark, sf_dir)
    stream = by_rows(spark, landed_events, rows // 4 + 1, folder).stream_table("events", ["event_id", "user_id", "value"], {"value": (20, None)})
    read_up(write_stream(stream, f"{folder}/out", f"{folder}/checkpoint", trigger=GO_ON))
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@check(
    "stream_batch_rows",
    """SELECT CAST(i AS BIGINT) AS batch, CAST(least(size, n - size * i) AS BIGINT) AS n_rows
FROM (SELECT n, size, unnest(range(0, CAST(ceil(n / CAST(size AS DOUBLE)) AS BIGINT))) AS i FROM (SELECT count(*) AS n, count(*) // 6 + 1 AS size FROM events) c) d""",
)
def stream_batch_rows(spark, sf_dir):
    """Rows per micro-batch, whatever the files; a second query goes on where the first one ended."""
    folder, rows, landed_events = work_folder(spark, "rows"), *event_files(spark, sf_dir)

    def land(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    stream = by_rows(spark, landed_events, rows // 6 + 1, folder).stream_table("events", "event_id")
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", f"{folder}/checkpoint")
    # a query of this kind of source takes one batch where it takes what is there
    writer.trigger(availableNow=True).start().awaitTermination()
    read_up(writer.trigger(**GO_ON).start())
    landed_rows = spark.read.schema("event_id bigint, batch bigint").parquet(f"{folder}/out")
    return landed_rows.groupBy("batch").agg(F.count("*").alias("n_rows"))


@check("stream_main_data", MAIN_24_SQL)
def stream_main_data(spark, sf_dir):
    cycler = cl.Cycler(staged(spark, sf_dir, "rec_live", "rec_hist_0"), "0800")
    raw = cycler.stream_main_data(TEST_24, columns=cycler.main_columns(240001))
    return streamed(spark, transform_main(raw, "0800", 240001).select(*CONVERTED, *RECORD_KEYS))


@check("stream_aux_data", "SELECT auxchl_id, seq_id, test_tmp / 10::DOUBLE AS test_tmp FROM "
       "(SELECT * FROM aux_live UNION ALL SELECT * FROM aux_hist_0) u WHERE test_id = 0")
def stream_aux_data(spark, sf_dir):
    cycler = cl.Cycler(staged(spark, sf_dir, "aux_live", "aux_hist_0"), "0800")
    return streamed(spark, transform_aux(cycler.stream_aux_data(TEST_24, columns=AUX_PART), "0800", 240001))


@check("stream_convert", select_24("rec_all", ", test_id"))
def stream_convert(spark, sf_dir):
    raw = staged(spark, sf_dir, "rec_all").stream("rec_all")
    raw = impose(raw, record_schema("0800", 240001, "main"))
    return streamed(spark, transform_main(raw, "0800", 240001).select(*CONVERTED, "test_id"))


BATCHES, FILES = 4, 4


def in_batches(spark: SparkSession, records: DataFrame, at: Column, folder: str) -> cl.FileTables:
    """Files in the order of ``at``, a number from 0 to 1; as many tasks write a batch as it has files.

    The records are computed once and landed by batch, of which each is then written.
    """
    parts = f"{folder}-parts"
    # null where there is no number: such a record is in no batch
    number = F.when(at * BATCHES >= BATCHES - 1, F.lit(BATCHES - 1)).otherwise(F.floor(at * BATCHES))
    whole = records.withColumn("_part", number.cast("int"))
    whole.where(F.col("_part") >= 0).write.partitionBy("_part").parquet(parts)
    landed = spark.read.schema(whole.schema).parquet(parts)
    for part in range(BATCHES):
        here = landed.where(F.col("_part") == part).drop("_part")
        here.repartition(FILES).write.mode("append").parquet(folder)
    return cl.FileTables(spark, {"in": folder}, files_per_batch=FILES)


@check("stream_steps", steps_sql(TIMED_SQL, "test_id"))
def stream_step_features(spark, sf_dir):
    # batches of files, in the order of their records
    records = timed(spark, sf_dir)
    folder = work_folder(spark, "steps")
    last = records.agg(F.max("seq_id")).first()[0]
    source = in_batches(spark, records, F.col("seq_id") / (last + 1), f"{folder}/in")
    stream_steps(source.stream("in"), ["test_id"], f"{folder}/out", FINE).awaitTermination()
    return read_steps(spark, f"{folder}/out")


@check("stream_steps_fanout", steps_sql(FANOUT_SQL, "test_id", "seq_id, auxchl_id"))
def stream_step_features_fanout(spark, sf_dir):
    # batches end between the channels of a record: one channel at the end of a batch, the other in the next
    records = join_aux(*fanout_sides(spark, sf_dir), ["test_id"])
    folder = work_folder(spark, "steps")
    last = records.agg(F.max("seq_id")).first()[0]
    second = F.coalesce((F.col("auxchl_id") > 1).cast("int"), F.lit(0))
    source = in_batches(spark, records, (2 * F.col("seq_id") + second) / (2 * last + 2), f"{folder}/in")
    stream_steps(source.stream("in"), ["test_id"], f"{folder}/out", FINE).awaitTermination()
    return read_steps(spark, f"{folder}/out")


def out_of_order(records: DataFrame, last: int, bound: int) -> Column:
    """When a record arrives: up to ``bound`` records late."""
    return (F.col("seq_id") + F.pmod(F.xxhash64(*records.columns), F.lit(bound))) / (last + bound + 1)


@check("stream_steps_late", steps_sql(TIMED_SQL, "test_id"))
def stream_steps_late(spark, sf_dir):
    """Records out of order within a bound, also between batches."""
    records = timed(spark, sf_dir)
    folder = work_folder(spark, "late")
    last = records.agg(F.max("seq_id")).first()[0]
    bound = last // 6
    source = in_batches(spark, records, out_of_order(records, last, bound), f"{folder}/in")
    stream_ordered(source.stream("in"), None, ["test_id"], f"{folder}/out", bound, FINE).awaitTermination()
    finish(spark, ["test_id"], f"{folder}/out", FINE)
    return read_ordered(spark, f"{folder}/out")


@check("stream_steps_channels", steps_sql(FANOUT_SQL, "test_id", "seq_id, auxchl_id"))
def stream_steps_channels(spark, sf_dir):
    """Two streams of many tests, both out of order, joined and numbered."""
    folder = work_folder(spark, "channels")
    sides = fanout_sides(spark, sf_dir)
    last = sides[0].agg(F.max("seq_id")).first()[0]
    bound = last // 6
    streams = [in_batches(spark, side, out_of_order(side, last, bound), f"{folder}/{i}").stream("in") for i, side in enumerate(sides)]
    stream_ordered(*streams, ["test_id"], f"{folder}/out", bound, FINE).awaitTermination()
    finish(spark, ["test_id"], f"{folder}/out", FINE)
    return read_ordered(spark, f"{folder}/out")


@check("stream_get_data", data_sql(MAIN_24_SQL, aux_sql()))
def stream_get_data(spark, sf_dir):
    """A running test as streams of its four tables; what the batch read gives."""
    t, folder = tables(spark, sf_dir), work_folder(spark, "running")
    last = t.frame("rec_all").agg(F.max("seq_id")).first()[0]
    bound = last // 6
    names = ("rec_live", "rec_hist_0", "aux_live", "aux_hist_0")
    for name in names:
        in_batches(spark, t.frame(name), out_of_order(t.frame(name), last, bound), f"{folder}/{name}")
    source = cl.FileTables(spark, {name: f"{folder}/{name}" for name in names}, files_per_batch=FILES)
    cycler = cl.Cycler(source, "0800")
    cycler.stream_data(TEST_24, f"{folder}/out", bound, layout=FINE).awaitTermination()
    return cycler.read_data(f"{folder}/out", ended=True, layout=FINE)


@check("stream_get_data_rows", data_sql(MAIN_24_SQL, aux_sql()))
def stream_get_data_rows(spark, sf_dir):
    """The same in micro-batches of rows, which end anywhere within files; a file's rows are up to a quarter of the test late."""
    t, folder = tables(spark, sf_dir), work_folder(spark, "running")
    last = t.frame("rec_all").agg(F.max("seq_id")).first()[0]
    names = ("rec_live", "rec_hist_0", "aux_live", "aux_hist_0")
    for name in names:
        in_batches(spark, t.frame(name), out_of_order(t.frame(name), last, last // 6), f"{folder}/{name}")
    rows = t.frame("rec_live").count() // 3 + 1
    cycler = cl.Cycler(by_rows(spark, {name: f"{folder}/{name}" for name in names}, rows, folder), "0800")
    read_up(cycler.stream_data(TEST_24, f"{folder}/out", last // 2, layout=FINE, trigger=GO_ON))
    return cycler.read_data(f"{folder}/out", ended=True, layout=FINE)


@check("chunked_work", "SELECT test_id, seq_id, test_vol / 1e4::DOUBLE AS volt FROM rec_all")
def chunked_work(spark, sf_dir):
    def volts(frame):
        return frame.assign(volt=frame["test_vol"] / 1e4)[["test_id", "seq_id", "volt"]]

    raw = tables(spark, sf_dir).get_table("rec_all", ["test_id", "seq_id", "test_vol"])
    return map_chunks(raw, volts, "test_id bigint, seq_id bigint, volt double", chunksize=3000)


@check(
    "chunk_sizes",
    """SELECT CAST(least(1700, n - 1700 * i) AS BIGINT) AS n_rows
FROM (SELECT n, unnest(range(0, CAST(ceil(n / 1700.0) AS BIGINT))) AS i FROM (SELECT count(*) AS n FROM events) c) d""",
)
def chunk_sizes(spark, sf_dir):
    def size(frame):
        return frame.head(1).assign(n_rows=len(frame))[["n_rows"]]

    whole = files(spark, sf_dir, "events").get_table("events", "event_id")
    return map_exact_chunks(whole, size, "n_rows bigint", chunksize=1700)


@check(
    "chunk_contents",
    """SELECT CAST((event_place - 1) // 1700 AS BIGINT) AS chunk, min(event_id) AS first_id, max(event_id) AS last_id, CAST(sum(user_id) AS BIGINT) AS users
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS event_place FROM events) e GROUP BY 1""",
)
def chunk_contents(spark, sf_dir):
    """Chunks of consecutive rows in an order, handed to the caller one after the other."""
    whole = files(spark, sf_dir, "events").get_table("events", ["event_id", "user_id"])
    found = [
        (number, int(frame["event_id"].iloc[0]), int(frame["event_id"].iloc[-1]), int(frame["user_id"].sum()))
        for number, frame in enumerate(iter_chunks(whole, 1700, ["event_id"]))
    ]
    return spark.createDataFrame(found, "chunk bigint, first_id bigint, last_id bigint, users bigint")


@check("query_chunked", "SELECT user_id, round(sum(value), 4) AS total, count(*) AS n_events FROM events GROUP BY user_id")
def query_chunked(spark, sf_dir):
    """A text, a chunk size and work in one call; totals of the chunks are added up."""

    def totals(frame):
        return frame.groupby("user_id", as_index=False).agg(total=("value", "sum"), n_events=("value", "size"))

    text = "SELECT user_id, value FROM events"
    parts = query_chunks(files(spark, sf_dir, "events"), text, totals, "user_id bigint, total double, n_events bigint", 1700)
    return parts.groupBy("user_id").agg(F.round(F.sum("total"), 4).alias("total"), F.sum("n_events").alias("n_events"))


@check("table_chunked", "SELECT event_id, user_id + 1 AS next_user FROM events WHERE value >= 20")
def table_chunked(spark, sf_dir):
    def following(frame):
        return frame.assign(next_user=frame["user_id"] + 1)[["event_id", "next_user"]]

    source, where = files(spark, sf_dir, "events"), {"value": (20, None)}
    return table_chunks(source, "events", following, "event_id bigint, next_user bigint", ["event_id", "user_id"], where, 1700)


# -- reports and exports --------------------------------------------------------------------------


@check(
    "test_summary",
    f"""SELECT {IDS}, CAST(count(*) AS BIGINT) AS records, min(seq_id) AS min_seq_id, max(seq_id) AS max_seq_id,
  min(cycle) AS min_cycle, max(cycle) AS max_cycle, min(step_id) AS min_step_id, max(step_id) AS max_step_id,
  min(unix_time) AS min_unix_time, max(unix_time) AS max_unix_time,
  min(test_atime) AS min_test_atime, max(test_atime) AS max_test_atime
FROM ({FLEET_MAIN_SQL}) f GROUP BY {IDS}""",
)
def test_summary(spark, sf_dir):
    main, _ = cl.connect(tables(spark, sf_dir)).fleet_parts()
    return summarise_tests(main, IDENTITY)


@check(
    "step_summary",
    f"""SELECT test_id, step_count, CAST(count(*) AS BIGINT) AS records, min(seq_id) AS first_seq_id,
  max(seq_id) AS last_seq_id, arg_min(unix_time, seq_id) AS unix_time_first, arg_max(unix_time, seq_id) AS unix_time_last,
  arg_min(test_time, seq_id) AS test_time_first, arg_max(test_time, seq_id) AS test_time_last
FROM ({steps_sql(TIMED_SQL, "test_id")}) s GROUP BY test_id, step_count""",
)
def step_summary(spark, sf_dir):
    return summarise_steps(add_step_features(timed(spark, sf_dir), ["test_id"]), ["test_id"])


AT = "{{'s': seq_id, 'c': auxchl_id, 'v': {0}}}"


@check(
    "step_summary_fanout",
    f"""SELECT test_id, step_count, CAST(count(*) AS BIGINT) AS records, min(seq_id) AS first_seq_id, max(seq_id) AS last_seq_id,
  arg_min(step_type, {AT.format("step_type")}) AS step_type, arg_min(test_time, {AT.format("test_time")}) AS test_time_first,
  arg_max(test_time, {AT.format("test_time")}) AS test_time_last, arg_max(test_capchg, {AT.format("test_capchg")}) AS test_capchg,
  arg_max(test_engdchg, {AT.format("test_engdchg")}) AS test_engdchg, min(test_tmp) AS test_tmp_min, max(test_tmp) AS test_tmp_max
FROM ({steps_sql("SELECT m.*, x.auxchl_id, x.test_tmp FROM (" + select_24("rec_all", ", test_id") + ") m LEFT JOIN "
                 "(SELECT * FROM aux_live UNION ALL SELECT * FROM aux_hist_0) x ON x.test_id = m.test_id AND x.seq_id = m.seq_id",
                 "test_id", "seq_id, auxchl_id", total=False)}) s GROUP BY test_id, step_count""",
)
def step_summary_fanout(spark, sf_dir):
    _, aux = fanout_sides(spark, sf_dir)
    main = transform_main(main_frame(spark, sf_dir, 240001), "0800", 240001)
    main = main.select("test_id", "seq_id", "step_type", "test_time", "test_capchg", "test_engdchg")
    steps = join_aux_with_steps(main, aux, ["test_id"], FINE, total_time=False)
    return summarise_steps(steps, ["test_id"]).drop("test_tmp_avg")


@check(
    "step_summary_signals",
    """SELECT test_id, cycle AS step_count, CAST(count(*) AS BIGINT) AS records, min(seq_id) AS first_seq_id,
  max(seq_id) AS last_seq_id, arg_min(step_type, seq_id) AS step_type, min(test_vol) AS test_vol_min,
  max(test_vol) AS test_vol_max, avg(test_vol) AS test_vol_avg, arg_max(test_capchg, seq_id) AS test_capchg
FROM rec_all GROUP BY test_id, cycle""",
)
def step_summary_signals(spark, sf_dir):
    columns = ["test_id", "cycle", "seq_id", "step_type", "test_vol", "test_capchg"]
    raw = tables(spark, sf_dir).get_table("rec_all", columns)
    return summarise_steps(raw.withColumnRenamed("cycle", "step_count"), ["test_id"])


@check(
    "step_distribution",
    """SELECT test_id, cycle AS step_count, CAST(count(*) AS BIGINT) AS records, CAST(quantile_disc(test_vol, 0.25) AS DOUBLE) AS test_vol_q25,
  CAST(quantile_disc(test_vol, 0.5) AS DOUBLE) AS test_vol_q50, CAST(quantile_disc(test_vol, 0.75) AS DOUBLE) AS test_vol_q75,
  CAST(quantile_disc(test_cur, 0.25) AS DOUBLE) AS test_cur_q25, CAST(quantile_disc(test_cur, 0.5) AS DOUBLE) AS test_cur_q50,
  CAST(quantile_disc(test_cur, 0.75) AS DOUBLE) AS test_cur_q75 FROM rec_all GROUP BY test_id, cycle""",
)
def step_distribution(spark, sf_dir):
    """Quartiles of the signals per step, from sketches of parts of the steps; steps of at most 500 records are exact."""
    raw = tables(spark, sf_dir).get_table("rec_all", ["test_id", "cycle", "chl_id", "step_id", "test_vol", "test_cur"])
    parts = sketch_steps(raw.withColumnRenamed("cycle", "step_count"), ["test_id", "step_id"])
    return quantiles(merge_sketches(parts, ["test_id", "step_count"]))


def exported(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    fleet = cl.connect(tables(spark, sf_dir)).get_fleet(layout=FINE)
    folder = work_folder(spark, "export")
    export_tests(fleet, folder, fmt, rows_per_file=2000)
    return read_export(spark, folder, fleet.schema, fmt)


@check("export_parquet", fleet_sql(FLEET_SQL))
def export_parquet(spark, sf_dir):
    return exported(spark, sf_dir, "parquet")


@check("export_csv", fleet_sql(FLEET_SQL))
def export_csv(spark, sf_dir):
    return exported(spark, sf_dir, "csv")


@check("export_ndjson", fleet_sql(FLEET_SQL))
def export_ndjson(spark, sf_dir):
    return exported(spark, sf_dir, "ndjson")


@check("export_clone", fleet_sql(FLEET_SQL))
def export_clone(spark, sf_dir):
    """A copy made in two runs, the second of which writes only what the first had not."""
    cycler, folder = cl.connect(tables(spark, sf_dir)), work_folder(spark, "clone")
    clone_fleet(cycler, folder, cycler.tests().where("unit_id <> 3"), layout=FINE)
    clone_fleet(cycler, folder, layout=FINE)
    return read_clone(spark, folder, cycler.get_fleet(layout=FINE).schema)


@check(
    "export_summary",
    f"""SELECT {IDS}, CAST(count(*) AS BIGINT) AS records, min(seq_id) AS min_seq_id, max(seq_id) AS max_seq_id, min(cycle) AS min_cycle,
  max(cycle) AS max_cycle, min(step_id) AS min_step_id, max(step_id) AS max_step_id, min(unix_time) AS min_unix_time,
  max(unix_time) AS max_unix_time FROM ({FLEET_JOINED_SQL}) f GROUP BY {IDS}""",
)
def export_summary(spark, sf_dir):
    """Spans of the tests of an export, from the footers of its files."""
    folder = work_folder(spark, "export")
    export_tests(cl.connect(tables(spark, sf_dir)).get_fleet(layout=FINE), folder, rows_per_file=2000)
    return summarise_export(spark, folder, IDENTITY)

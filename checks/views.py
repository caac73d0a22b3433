"""Record tables of a small cycler database, derived from the driver's ``events`` table.

The texts run unchanged on Spark SQL (session zone UTC) and on DuckDB, so that queries and
their SQL counterparts read the same rows. Test 0 holds a third of all records, test 2 a sixth.
Units 1 and 2 belong to a type 24 device, units 3 and 4 to a type 26 one. Test 0 has its early
records in tables of its own. Unit 2 names its auxiliary table second, unit 4 has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RANGE = """CAST(CASE event_id % 9 WHEN 0 THEN 5 WHEN 1 THEN 50 WHEN 2 THEN 500 WHEN 3 THEN 5000 WHEN 4 THEN 0
    WHEN 5 THEN -0.5 WHEN 6 THEN -50 WHEN 7 THEN -2000000 ELSE NULL END AS DOUBLE)"""

VIEWS = {
    "rec_all": f"""
SELECT test_id % 4 + 1 AS unit_id, test_id % 8 + 1 AS chl_id, test_id, event_id + 1 AS seq_id,
  CAST(floor(event_id / 500) AS BIGINT) + 1 AS cycle, event_id % 10 + 1 AS step_id,
  CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 4 WHEN 'click' THEN 7
    ELSE CASE event_id % 9 WHEN 0 THEN 5 WHEN 1 THEN 6 WHEN 2 THEN 8 WHEN 3 THEN 9 WHEN 4 THEN 10 WHEN 5 THEN 20
    WHEN 6 THEN NULL ELSE 99 END END AS BIGINT) AS step_type,
  CAST(0 AS BIGINT) AS step_changecount, CAST(1 AS BIGINT) AS work_type,
  CASE WHEN event_type = 'signup' THEN CAST(0 AS BIGINT) ELSE event_id % 1000 + 1 END AS test_time,
  30000 + event_id % 12000 AS test_vol, (event_id % 2001 - 1000) * 10 AS test_cur, event_id % 77 AS test_ir,
  200 + event_id % 150 AS test_tmp,
  event_id % 4 AS factor_capchg, (event_id + 1) % 4 AS factor_capdchg,
  (event_id + 2) % 4 AS factor_engchg, (event_id + 3) % 4 AS factor_engdchg,
  CAST(round(value * 100) AS BIGINT) AS test_capchg, CAST(round(value * 50) AS BIGINT) AS test_capdchg,
  CAST(round(value * 400) AS BIGINT) AS test_engchg, CAST(round(value * 200) AS BIGINT) AS test_engdchg,
  CAST(round(value * 150) AS BIGINT) AS total_cap, CAST(round(value * 600) AS BIGINT) AS total_eng,
  {RANGE} AS cur_step_range, ts AS test_atime, ts AS dataupdate,
  CAST(0 AS BIGINT) AS step_index, CAST(0 AS BIGINT) AS run_index, CAST(1000 AS BIGINT) AS time_interval,
  event_id * 1000 AS total_time, event_id % 1000 AS atime_ms
FROM (SELECT *, CASE WHEN user_id % 3 = 0 THEN CAST(0 AS BIGINT) WHEN user_id % 6 = 1 THEN CAST(2 AS BIGINT)
  ELSE user_id END AS test_id FROM events) e""",
    "rec_live": """
SELECT * FROM rec_all WHERE test_id <> 0 OR CAST(test_atime AS DATE) >= DATE '2024-01-16'""",
    "rec_hist_0": """
SELECT * FROM rec_all WHERE test_id = 0 AND CAST(test_atime AS DATE) < DATE '2024-01-16'""",
    "aux_live": """
SELECT unit_id, chl_id, test_id, seq_id, CAST(1 AS BIGINT) AS auxchl_id, 190 + seq_id % 200 AS test_tmp, test_vol
FROM rec_live WHERE step_type <> 99
UNION ALL
SELECT unit_id, chl_id, test_id, seq_id, CAST(2 AS BIGINT) AS auxchl_id, 200 + seq_id % 200 AS test_tmp, test_vol
FROM rec_live WHERE step_type IN (1, 4)""",
    "aux_hist_0": """
SELECT unit_id, chl_id, test_id, seq_id, CAST(1 AS BIGINT) AS auxchl_id, 190 + seq_id % 200 AS test_tmp, test_vol
FROM rec_hist_0 WHERE step_type <> 99
UNION ALL
SELECT unit_id, chl_id, test_id, seq_id, CAST(2 AS BIGINT) AS auxchl_id, 200 + seq_id % 200 AS test_tmp, test_vol
FROM rec_hist_0 WHERE step_type IN (1, 4)""",
    "test": """
SELECT CAST(240001 AS BIGINT) AS dev_uid, unit_id, chl_id, test_id, 'rec_live' AS main_first_table,
  CASE WHEN test_id = 0 THEN 'rec_hist_0' END AS main_second_table,
  CASE WHEN unit_id = 1 THEN 'aux_live' END AS aux_first_table,
  CASE WHEN test_id = 0 THEN 'aux_hist_0' WHEN unit_id = 2 THEN 'aux_live' END AS aux_second_table
FROM rec_all WHERE unit_id <= 2 GROUP BY unit_id, chl_id, test_id""",
    "h_test": """
SELECT CAST(260001 AS BIGINT) AS dev_uid, unit_id, chl_id, test_id, 'rec_live' AS main_first_table,
  CASE WHEN unit_id = 3 THEN 'aux_live' END AS aux_first_table, max(seq_id) AS last_seq
FROM rec_all WHERE unit_id > 2 GROUP BY unit_id, chl_id, test_id""",
    "test_note": """
SELECT dev_uid, unit_id, chl_id, test_id, concat('channel ', CAST(chl_id AS VARCHAR(20))) AS note
FROM test WHERE chl_id > 1""",
    "db_ver": """
SELECT CASE WHEN event_id >= 0 THEN '0800' END AS version FROM events""",
}


def load_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Frames by view name over the tables of a scale factor folder."""
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
    frames = {}
    for name, text in VIEWS.items():
        frames[name] = spark.sql(text)
        frames[name].createOrReplaceTempView(name)
    return frames


def with_views(select: str) -> str:
    """The same views as common table expressions ahead of a SELECT."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in used and name in text.replace("(", " ").replace(")", " ").replace("\n", " ").split():
                visit(body)
                used.append(name)

    visit(select)
    if not used:
        return select
    return "WITH " + ", ".join(f"{name} AS ({VIEWS[name]})" for name in used) + "\n" + select

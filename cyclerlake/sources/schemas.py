"""Declared column types of the record tables, by server version and device type."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cyclerlake.functions.conversions import combination
from cyclerlake.functions.predicates import quoted

# Columns of the tester's record tables, in their order.
MAIN_0760_24 = """
unit_id BIGINT, chl_id BIGINT, test_id BIGINT, seq_id BIGINT, cycle BIGINT, step_id BIGINT, step_type BIGINT,
step_changecount BIGINT, work_type BIGINT, test_time BIGINT, test_vol BIGINT, test_cur BIGINT,
test_ir BIGINT, test_tmp BIGINT, factor_capchg BIGINT, test_capchg BIGINT, factor_engchg BIGINT,
test_engchg BIGINT, factor_capdchg BIGINT, test_capdchg BIGINT, factor_engdchg BIGINT, test_engdchg BIGINT,
cur_step_range BIGINT, test_atime TIMESTAMP_NTZ, dataupdate TIMESTAMP_NTZ
"""
AUX_0760_24 = """
unit_id BIGINT, chl_id BIGINT, auxchl_id BIGINT, data_flag BIGINT, test_id BIGINT, seq_id BIGINT,
cycle BIGINT, step_id BIGINT, step_type BIGINT, step_changecount BIGINT, work_type BIGINT, test_time BIGINT,
test_vol BIGINT, test_cur BIGINT, test_ir BIGINT, test_tmp BIGINT, factor_capchg BIGINT, test_capchg BIGINT,
factor_engchg BIGINT, test_engchg BIGINT, factor_capdchg BIGINT, test_capdchg BIGINT, factor_engdchg BIGINT,
test_engdchg BIGINT, cur_step_range BIGINT, test_atime TIMESTAMP_NTZ, dataupdate TIMESTAMP_NTZ
"""
MAIN_0800_24 = """
unit_id BIGINT, chl_id BIGINT, test_id BIGINT, seq_id BIGINT, cycle BIGINT, step_id BIGINT, step_type BIGINT,
step_changecount BIGINT, work_type BIGINT, test_time BIGINT, test_vol BIGINT, test_cur BIGINT,
test_ir BIGINT, test_tmp BIGINT, factor_capchg BIGINT, test_capchg BIGINT, factor_engchg BIGINT,
test_engchg BIGINT, factor_capdchg BIGINT, test_capdchg BIGINT, factor_engdchg BIGINT, test_engdchg BIGINT,
cur_step_range DOUBLE, test_atime TIMESTAMP_NTZ, dataupdate TIMESTAMP_NTZ
"""
AUX_0800_24 = """
unit_id BIGINT, chl_id BIGINT, auxchl_id BIGINT, data_flag BIGINT, test_id BIGINT, seq_id BIGINT,
cycle BIGINT, step_id BIGINT, step_type BIGINT, step_changecount BIGINT, work_type BIGINT, test_time BIGINT,
test_vol BIGINT, test_cur BIGINT, test_ir BIGINT, test_tmp BIGINT, test_capchg BIGINT, test_engchg BIGINT,
test_capdchg BIGINT, test_engdchg BIGINT, cur_step_range DOUBLE, test_atime TIMESTAMP_NTZ,
dataupdate TIMESTAMP_NTZ
"""
MAIN_0800_26 = """
seq_id BIGINT, cycle BIGINT, step_id BIGINT, step_type BIGINT, step_changecount BIGINT, work_type BIGINT,
test_time BIGINT, test_vol DOUBLE, test_cur DOUBLE, test_ir BIGINT, test_tmp BIGINT, test_capchg DOUBLE,
test_engchg DOUBLE, test_capdchg DOUBLE, test_engdchg DOUBLE, total_cap DOUBLE, total_eng DOUBLE,
cur_step_range DOUBLE, test_atime TIMESTAMP_NTZ, dataupdate TIMESTAMP_NTZ, step_index BIGINT,
run_index BIGINT, time_interval BIGINT, total_time BIGINT, atime_ms BIGINT
"""
AUX_0800_26 = """
auxchl_id BIGINT, data_flag BIGINT, seq_id BIGINT, cycle BIGINT, step_id BIGINT, step_type BIGINT,
step_changecount BIGINT, work_type BIGINT, test_time BIGINT, test_vol DOUBLE, test_cur DOUBLE,
test_ir BIGINT, test_tmp BIGINT, test_capchg BIGINT, test_engchg BIGINT, test_capdchg BIGINT,
test_engdchg BIGINT, total_cap BIGINT, total_eng BIGINT, cur_step_range DOUBLE, test_atime TIMESTAMP_NTZ,
dataupdate TIMESTAMP_NTZ
"""

TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "TIMESTAMP_NTZ": T.TimestampNTZType()}


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in map(str.split, text.split(","))])


SCHEMAS = {
    "0760-24": {"main": _struct(MAIN_0760_24), "aux": _struct(AUX_0760_24)},
    "0800-24": {"main": _struct(MAIN_0800_24), "aux": _struct(AUX_0800_24)},
    "0800-26": {"main": _struct(MAIN_0800_26), "aux": _struct(AUX_0800_26)},
}


def record_schema(version: str, dev_uid: int | str, kind: str) -> T.StructType:
    """Declared schema of ``main`` or ``aux`` records."""
    return SCHEMAS[combination(version, dev_uid)][kind]


def impose(df: DataFrame, schema: T.StructType, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast the declared columns that are present; leave the others as they are.

    An instant becomes its clock time in UTC, whatever the session zone.
    """
    only = None if columns is None else set(columns)
    declared = {f.name: f.dataType for f in schema if only is None or f.name in only}

    def typed(field: T.StructField) -> str:
        name = quoted(field.name)
        if declared.get(field.name, field.dataType) == field.dataType:
            return name
        if isinstance(field.dataType, T.TimestampType) and isinstance(declared[field.name], T.TimestampNTZType):
            seconds = f"CAST(CAST(unix_micros({name}) AS decimal(20, 0)) / 1000000 AS decimal(18, 6))"
            return f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}) AS {name}"
        return f"CAST({name} AS {declared[field.name].simpleString()}) AS {name}"

    return df.selectExpr(*map(typed, df.schema))


def python_type(data_type: T.DataType) -> type:
    families: list[tuple[type, type]] = [
        (T.IntegralType, int),
        (T.FractionalType, float),
        (T.StringType, str),
        (T.TimestampType, datetime),
        (T.TimestampNTZType, datetime),
        (T.DateType, date),
        (T.BooleanType, bool),
    ]
    for family, python in families:
        if isinstance(data_type, family):
            return python
    return object


def python_schema(schema: T.StructType) -> dict[str, type]:
    return {f.name: python_type(f.dataType) for f in schema}

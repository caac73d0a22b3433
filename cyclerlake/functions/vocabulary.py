"""Three names for every published column: database (``bts``), ``label`` and ``code``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Term(NamedTuple):
    bts: str
    label: str
    code: str
    kind: str  # how the column is condensed per step: counter, time, signal or integral


# The published battery-data vocabulary, in output order.
TERMS = [
    Term("step_id", "Step ID / 1", "step_id", "counter"),
    Term("step_type", "Step Type / 1", "step_type", "counter"),
    Term("step_index", "Step Index / 1", "step_index", "counter"),
    Term("seq_id", "Record Count / 1", "record_count", "counter"),
    Term("step_count", "Step Count / 1", "step_count", "counter"),
    Term("cycle", "Cycle Count / 1", "cycle_count", "counter"),
    Term("unix_time", "Unix Time / s", "unix_time", "time"),
    Term("test_atime", "Time / datetime", "time_datetime", "time"),
    Term("test_time", "Step Time / s", "step_time", "time"),
    Term("test_vol", "Voltage / V", "voltage_volt", "signal"),
    Term("test_cur", "Current / A", "current_ampere", "signal"),
    Term("test_tmp", "Temperature / degC", "temperature_celsius", "signal"),
    Term("test_pow", "Power / W", "power_watt", "signal"),
    Term("test_capchg", "Step Charging Capacity / Ah", "step_charging_capacity_ah", "integral"),
    Term("test_capdchg", "Step Discharging Capacity / Ah", "step_discharging_capacity_ah", "integral"),
    Term("test_engchg", "Step Charging Energy / Wh", "step_charging_energy_wh", "integral"),
    Term("test_engdchg", "Step Discharging Energy / Wh", "step_discharging_energy_wh", "integral"),
    Term("test_cap", "Step Capacity / Ah", "step_capacity_ah", "integral"),
    Term("test_eng", "Step Energy / Wh", "step_energy_wh", "integral"),
]

NAMINGS = ("bts", "label", "code")
LABELS = [term.label for term in TERMS]


def mapping(src: str, dst: str) -> dict[str, str]:
    for naming in (src, dst):
        if naming not in NAMINGS:
            raise ValueError(f"unknown naming {naming!r}, expected one of {NAMINGS}")
    return {getattr(term, src): getattr(term, dst) for term in TERMS}


def convert(df: DataFrame, src: str = "bts", dst: str = "label") -> DataFrame:
    """Rename known columns from one naming to another; others pass through."""
    renames = mapping(src, dst)
    if src == dst:
        return df
    names = [renames.get(name, name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"renaming {src} to {dst} would duplicate {clashes}")
    return df.withColumnsRenamed(renames)

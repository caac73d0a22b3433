"""Raw tester counts to physical units.

A conversion is an ordered list of rules. Each rule sees what earlier rules produced, and is
left out when a column it reads does not exist. Rules that do not depend on one another share
one projection, so a whole conversion is a handful of codegen'd projections and never shuffles.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame

from cyclerlake.functions.predicates import quoted


class Rule(NamedTuple):
    output: str
    inputs: tuple[str, ...]
    text: Callable[..., str]  # SQL over the inputs


# Step type codes of the tester.
STEP_TYPES = {
    1: "CC Charge",
    2: "CC Discharge",
    4: "Rest",
    5: "Cycle",
    6: "End",
    7: "CC-CV Charge",
    8: "CP Discharge",
    9: "CP Charge",
    10: "CR Discharge",
    20: "CC-CV Discharge",
}
OTHER_STEP = "Unknown"

# Fixed values: (range below this, counts per milliampere); the last entry is the rest.
POSITIVE_RANGES = [(10, 1e4), (100, 1e3), (1000, 1e2), (None, 1e1)]
SIGNED_RANGES = [(0.01, 1e8), (0.1, 1e7), (1, 1e6), (10, 1e5), (100, 1e4), (1000, 1e3), (None, 1e2)]


# seconds from 0001-01-01 to 1970-01-01
FAR_TO_EPOCH = 62135596800


def epoch_seconds(ts: str) -> str:
    """Whole seconds since 1970, floored, the same in any session zone.

    An instant (zoned timestamp) has its own; a clock time is read as UTC. The type is known when
    the plan is made, so only one branch remains in it. Counting from a far past date keeps the interval positive, where truncation is floor.
    """
    since = f"CAST({ts} AS timestamp_ntz) - TIMESTAMP_NTZ'0001-01-01 00:00:00'"
    clock = f"CAST(CAST({since} AS INTERVAL SECOND) AS bigint) - {FAR_TO_EPOCH}L"
    return f"CASE WHEN typeof({ts}) = 'timestamp' THEN unix_seconds(CAST({ts} AS timestamp)) ELSE {clock} END"


def step_name(code: str) -> str:
    known = " ".join(f"WHEN {number} THEN '{name}'" for number, name in STEP_TYPES.items())
    return f"CASE {code} {known} ELSE '{OTHER_STEP}' END"


def _ladder(value: str, steps: list[tuple[float | None, float]]) -> str:
    rungs = " ".join(f"WHEN {value} < {below}D THEN {scale}D" for below, scale in steps[:-1])
    return f"CASE {rungs} ELSE {steps[-1][1]}D END"


def _range_magnitude(raw: str) -> str:
    signed = f"CAST({raw} AS double)"
    return (
        f"CASE WHEN abs({signed}) > 0 AND abs({signed}) <= 999999 THEN abs({signed})"
        f" WHEN abs({signed}) BETWEEN 1000000 AND 999999999 THEN CAST(floor({signed} / 1e9D) AS double)"
        " ELSE 0D END"
    )


def _counts_per_milliampere(raw: str, magnitude: str) -> str:
    return f"CASE WHEN {raw} > 0 THEN {_ladder(raw, POSITIVE_RANGES)} ELSE {_ladder(magnitude, SIGNED_RANGES)} END"


def _integral_scale(factor: str, scale: str) -> str:
    return f"CASE {factor} WHEN 0 THEN {scale} * 1e3D * 3600 WHEN 1 THEN {scale} WHEN 2 THEN {scale} * 1e3D END"


def _scaled(name: str, *divisors: str) -> Rule:
    return Rule(name, (name,), lambda column: " / ".join([column, *divisors]))


INTEGRALS = ("capchg", "capdchg", "engchg", "engdchg")

_BALANCES = [
    Rule("test_cap", ("test_capchg", "test_capdchg"), lambda gain, loss: f"{gain} - {loss}"),
    Rule("test_eng", ("test_engchg", "test_engdchg"), lambda gain, loss: f"{gain} - {loss}"),
]
_CLOCK_AND_STEP = [
    Rule("unix_time", ("test_atime",), epoch_seconds),
    Rule("step_type", ("step_type",), step_name),
]
_POWER = Rule("test_pow", ("test_cur", "test_vol"), lambda current, voltage: f"{current} * {voltage}")

TYPE_24: list[Rule] = [
    Rule("d_cur_step_range", ("cur_step_range",), _range_magnitude),
    Rule("scale_cur", ("cur_step_range", "d_cur_step_range"), _counts_per_milliampere),
    *(Rule(f"scale_{name}", (f"factor_{name}", "scale_cur"), _integral_scale) for name in INTEGRALS),
    _scaled("test_time", "1e3D"),
    _scaled("test_vol", "1e4D"),
    Rule("test_cur", ("test_cur", "scale_cur"), lambda counts, scale: f"{counts} / ({scale} * 1e3D)"),
    _scaled("test_tmp", "1e1D"),
    *(Rule(f"test_{n}", (f"test_{n}", f"scale_{n}"), lambda counts, scale: f"{counts} / {scale}") for n in INTEGRALS),
    _POWER,
    *_BALANCES,
    *_CLOCK_AND_STEP,
]

TYPE_26: list[Rule] = [
    _scaled("test_time", "1e3D"),
    _scaled("test_vol", "1e4D"),
    _scaled("test_cur", "1e3D"),
    _scaled("test_tmp", "1e1D"),
    _POWER,
    # two divisions, not one: the rounding of each is part of the result
    *(_scaled(f"test_{name}", "3600D", "1e3D") for name in INTEGRALS),
    _scaled("total_cap", "3600D", "1e3D"),
    _scaled("total_eng", "3600D", "1e3D"),
    *_BALANCES,
    *_CLOCK_AND_STEP,
]

AUX: list[Rule] = [_scaled("test_tmp", "10D")]

# what the step features read
FEATURE_INPUTS = {
    "step_count": ("seq_id", "test_time"),
    "step_index": ("seq_id", "test_time"),
    "test_totaltime": ("seq_id", "unix_time"),
}

MAIN_RULES = {"0760-24": TYPE_24, "0800-24": TYPE_24, "0800-26": TYPE_26}
AUX_RULES = {"0760-24": AUX, "0800-24": AUX, "0800-26": AUX}


def device_type(dev_uid: int | str) -> str:
    return str(dev_uid)[:2]


def combination(version: str, dev_uid: int | str) -> str:
    key = f"{version}-{device_type(dev_uid)}"
    if key not in MAIN_RULES:
        raise ValueError(f"unsupported version and device type {key!r}, known: {sorted(MAIN_RULES)}")
    return key


def _project(df: DataFrame, computed: dict[str, str]) -> DataFrame:
    names = [*df.columns, *(name for name in computed if name not in df.columns)]
    return df.selectExpr(*(f"{computed[n]} AS {quoted(n)}" if n in computed else quoted(n) for n in names))


def apply_rules(df: DataFrame, rules: Iterable[Rule], strict: bool = False) -> DataFrame:
    """Apply rules in order; skip those whose inputs are missing (or raise with ``strict``)."""
    existing = set(df.columns)
    together: dict[str, str] = {}
    for rule in rules:
        missing = [name for name in rule.inputs if name not in existing]
        if missing:
            if rule.output in existing and rule.output in rule.inputs:
                message = f"{rule.output} stays in raw counts: {missing} not available"
                if strict:
                    raise ValueError(message)
                warnings.warn(message, stacklevel=3)
            continue
        if any(name in together for name in rule.inputs):
            df, together = _project(df, together), {}
        together[rule.output] = rule.text(*rule.inputs)
        existing.add(rule.output)
    return _project(df, together) if together else df


def transform_main(df: DataFrame, version: str, dev_uid: int | str, strict: bool = False) -> DataFrame:
    return apply_rules(df, MAIN_RULES[combination(version, dev_uid)], strict)


def transform_aux(df: DataFrame, version: str, dev_uid: int | str) -> DataFrame:
    if "test_tmp" not in df.columns:
        raise ValueError("auxiliary records need test_tmp")
    return apply_rules(df, AUX_RULES[combination(version, dev_uid)])


def required_columns(wanted: Iterable[str], version: str, dev_uid: int | str) -> list[str]:
    """Raw main columns to read so that every wanted column is fully converted."""
    needed: set[str] = set()
    for name in wanted:
        needed.update(FEATURE_INPUTS.get(name, (name,)))
    # walk backwards: a rule that writes a needed column pulls in what it reads
    for rule in reversed(MAIN_RULES[combination(version, dev_uid)]):
        if rule.output in needed:
            if rule.output not in rule.inputs:
                needed.discard(rule.output)
            needed.update(rule.inputs)
    return sorted(needed)

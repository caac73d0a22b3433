"""Measurements in physical units: the records of a test, or of all tests, ready to use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cyclerlake.functions.conversions import required_columns, transform_aux, transform_main
from cyclerlake.functions.predicates import column_list, quoted
from cyclerlake.functions.vocabulary import LABELS, TERMS, convert
from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import add_step_features
from cyclerlake.operators.joins import join_aux, join_aux_with_steps
from cyclerlake.operators.unions import with_typed_nulls
from cyclerlake.plans.records import (
    RECORD_KEYS,
    Test,
    Where,
    aux_records,
    fleet_records,
    main_records,
    plan_routes,
)
from cyclerlake.session import tune
from cyclerlake.sources.catalogue import IDENTITY, placed_tests, supported_version, tests, unordered_tests
from cyclerlake.sources.schemas import record_schema
from cyclerlake.sources.tables import Tables
from cyclerlake.streaming.ordered import finish, read_ordered, stream_ordered
from cyclerlake.streaming.sinks import READ_UP

AUX_COLUMNS = ["auxchl_id", "seq_id", "test_tmp"]
NO_AUX = {"auxchl_id": "bigint", "test_tmp": "double"}
PUBLISHED = [term.bts for term in TERMS]
STEP_SCOPES = ("row", "record")


class Cycler:
    """A tester's database. Opened by ``connect``, which reads the version once."""

    def __init__(self, tables: Tables, version: str) -> None:
        self.tables = tables
        self.version = version

    # -- catalogue ----------------------------------------------------------------------------

    def tests(self) -> DataFrame:
        return tests(self.tables, self.version)

    def placed_tests(self) -> DataFrame:
        return placed_tests(self.tables, self.version)

    def list_tests(self) -> Iterator[dict[str, Any]]:
        """Tests as dicts, one partition at a time on the driver."""
        for row in self.tests().toLocalIterator():
            yield row.asDict()

    # -- raw records --------------------------------------------------------------------------

    def get_main_data(self, test: Test, where: Where = None, columns: str | Sequence[str] | None = None) -> DataFrame:
        return main_records(self.tables.frame, self.version, test, where, columns)

    def get_aux_data(
        self, test: Test, where: Where = None, columns: str | Sequence[str] | None = None
    ) -> DataFrame | None:
        return aux_records(self.tables.frame, self.version, test, where, columns)

    def stream_main_data(
        self, test: Test, where: Where = None, columns: str | Sequence[str] | None = None
    ) -> DataFrame:
        """The same as an unbounded frame. Raw: ``transform_main`` may be applied to it."""
        return main_records(self._stream(where, columns), self.version, test, where, columns)

    def stream_aux_data(
        self, test: Test, where: Where = None, columns: str | Sequence[str] | None = None
    ) -> DataFrame | None:
        return aux_records(self._stream(where, columns), self.version, test, where, columns)

    def _stream(self, where: Where, columns: str | Sequence[str] | None) -> Callable[[str], DataFrame]:
        names = column_list(columns)
        used = None if names is None else list(dict.fromkeys([*names, *RECORD_KEYS, *(where or {})]))
        return lambda table: self.tables.stream_table(table, used)

    # -- measurements -------------------------------------------------------------------------

    def main_columns(self, dev_uid: int | str) -> list[str]:
        names = record_schema(self.version, dev_uid, "main").fieldNames()
        return [name for name in names if name != "test_tmp"]

    def _main_columns(self, dev_uid: int | str, asked: Sequence[str] | None, complete: bool) -> list[str]:
        if asked is None:
            return self.main_columns(dev_uid)
        if not complete:
            return list(asked)
        # everything published except what the auxiliary channel or the features provide
        wanted = [c for c in PUBLISHED if c != "test_tmp"]
        needed = required_columns([*wanted, *asked], self.version, dev_uid)
        return [c for c in record_schema(self.version, dev_uid, "main").fieldNames() if c in needed]

    def get_data(
        self,
        test: Test,
        where: Where = None,
        main_columns: Sequence[str] | None = None,
        aux_columns: Sequence[str] | None = None,
        step_scope: str = "row",
        complete: bool = False,
        strict: bool = False,
        layout: Layout = Layout(),
        snapshot: bool = False,
    ) -> DataFrame:
        """All published columns of one test, under their labels.

        ``where`` filters raw counts of main and auxiliary records before anything is computed,
        so steps are numbered within what it keeps. ``step_scope="row"`` numbers the joined rows,
        where a step start counts once per channel; ``"record"`` numbers records before the join.
        ``complete`` adds to ``main_columns`` whatever the conversions need; with ``strict``, a
        conversion whose inputs are missing is an error. ``snapshot`` is for tables that are still written to:
        the result is their state at the call, or using it fails.
        """
        tune(self.tables.spark)
        dev_uid = test["dev_uid"]
        main = self.get_main_data(test, where, self._main_columns(dev_uid, main_columns, complete))
        aux = self.get_aux_data(test, where, AUX_COLUMNS if aux_columns is None else list(aux_columns))
        main = transform_main(main, self.version, dev_uid, strict=strict)
        main = _slim(main, [])
        if aux is not None:
            aux = _slim(transform_aux(aux, self.version, dev_uid), [])
        return _published(_with_steps(main, aux, [], step_scope, layout, snapshot), [])

    def stream_data(
        self,
        test: Test,
        folder: str,
        bound: int,
        where: Where = None,
        main_columns: Sequence[str] | None = None,
        step_scope: str = "row",
        layout: Layout = Layout(),
        trigger: Mapping[str, Any] = READ_UP,
    ) -> StreamingQuery:
        """``get_data`` of a test that is still running, from streams of its tables into ``folder``.

        Records and channels may arrive out of order by ``bound`` record numbers. ``read_data`` gives what is numbered so far.
        """
        tune(self.tables.spark)
        dev_uid = test["dev_uid"]
        main = self.stream_main_data(test, where, self._main_columns(dev_uid, main_columns, False))
        main = _slim(transform_main(main, self.version, dev_uid), []).drop("step_count", "step_index")
        aux = self.stream_aux_data(test, where, AUX_COLUMNS)
        if aux is None:
            main = with_typed_nulls(main, NO_AUX)
        else:
            aux = _slim(transform_aux(aux, self.version, dev_uid), [])
        return stream_ordered(main, aux, [], folder, bound, layout, step_scope, trigger)

    def read_data(self, folder: str, ended: bool = False, step_scope: str = "row", layout: Layout = Layout()) -> DataFrame:
        """What ``stream_data`` has numbered; with ``ended`` also what it holds back for late records."""
        if ended:
            finish(self.tables.spark, [], folder, layout, step_scope)
        return _published(read_ordered(self.tables.spark, folder), [])

    def get_fleet(
        self,
        chosen: DataFrame | None = None,
        where: Where = None,
        main_columns: Mapping[str, Sequence[str]] | None = None,
        aux_columns: Sequence[str] | None = None,
        step_scope: str = "row",
        complete: bool = False,
        strict: bool = False,
        layout: Layout = Layout(),
        snapshot: bool = False,
    ) -> DataFrame:
        """``get_data`` of many tests (rows of the catalogue; all by default) in one plan.

        The result starts with the identity of the test. ``main_columns`` is by device type.
        """
        tune(self.tables.spark)
        main, aux = self.fleet_parts(chosen, where, main_columns, aux_columns, complete, strict)
        return _published(_with_steps(main, aux, IDENTITY, step_scope, layout, snapshot), IDENTITY)

    def fleet_parts(
        self,
        chosen: DataFrame | None = None,
        where: Where = None,
        main_columns: Mapping[str, Sequence[str]] | None = None,
        aux_columns: Sequence[str] | None = None,
        complete: bool = False,
        strict: bool = False,
    ) -> tuple[DataFrame, DataFrame | None]:
        """Converted main and auxiliary records of many tests, with the tests' identity."""
        routes = plan_routes(unordered_tests(self.tables, self.version) if chosen is None else chosen)
        devices = sorted({device for device, _, _ in [*routes.shared, *routes.owned]})
        if not devices:
            raise ValueError("no tests to read")
        asked_aux = AUX_COLUMNS if aux_columns is None else list(aux_columns)
        mains, auxes = [], []
        for device in devices:
            columns = self._main_columns(device, (main_columns or {}).get(device), complete)
            main = fleet_records(self.tables, self.version, routes, device, "main", columns, where)
            main = transform_main(main, self.version, device, strict=strict)
            if "test_tmp" in columns:
                # as for a single test: without an auxiliary table there is no temperature
                main = main.withColumn("test_tmp", F.when(F.col("has_aux"), F.col("test_tmp")))
            mains.append(_slim(main, IDENTITY))
            aux = fleet_records(self.tables, self.version, routes, device, "aux", asked_aux, where)
            if aux is not None:
                auxes.append(_slim(transform_aux(aux, self.version, device), IDENTITY))
        main = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), mains)
        aux = reduce(DataFrame.unionByName, auxes) if auxes else None
        return main, aux


def _slim(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Nothing but published columns and keys is shuffled."""
    return df.select(*(c for c in df.columns if c in PUBLISHED or c in by or c == "auxchl_id"))


def _with_steps(
    main: DataFrame, aux: DataFrame | None, by: Sequence[str], step_scope: str, layout: Layout, snapshot: bool = False
) -> DataFrame:
    if step_scope not in STEP_SCOPES:
        raise ValueError(f"step_scope must be one of {STEP_SCOPES}, got {step_scope!r}")
    options = {"total_time": False, "snapshot": snapshot}
    if aux is None:
        return add_step_features(with_typed_nulls(main, NO_AUX), by, layout, **options)
    if "test_time" in main.columns:
        main = main.drop("step_count", "step_index")  # computed anew below
    else:
        return join_aux(add_step_features(main, by, layout, **options), aux, by, layout, snapshot)
    return join_aux_with_steps(main, aux, by, layout, step_scope, **options)


def _published(df: DataFrame, leading: Sequence[str]) -> DataFrame:
    renamed = convert(df, "bts", "label")
    return renamed.select(*map(quoted, [*leading, *LABELS]))


def connect(tables: Tables) -> Cycler:
    """Open a database: reads its version and picks the matching rules."""
    return Cycler(tables, supported_version(tables))


def list_tests(tables: Tables) -> Iterator[dict[str, Any]]:
    return connect(tables).list_tests()


def get_data(tables: Tables, test: Test, **options: Any) -> DataFrame:
    return connect(tables).get_data(test, **options)

"""Battery-cycler measurements on Spark."""

from cyclerlake.functions.vocabulary import convert
from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import add_step_features
from cyclerlake.plans.measurements import Cycler, connect, get_data, list_tests
from cyclerlake.session import tune
from cyclerlake.sources.tables import CatalogTables, FileTables, FrameTables, JdbcTables

__all__ = [
    "CatalogTables",
    "Cycler",
    "FileTables",
    "FrameTables",
    "JdbcTables",
    "Layout",
    "add_step_features",
    "connect",
    "convert",
    "get_data",
    "list_tests",
    "tune",
]

"""enrichkit: enrich, classify and aggregate nested documents on Spark.

Main entry points (all DataFrame -> DataFrame unless noted)::

    from enrichkit import (
        get_session, read_documents, read_key_list, flatten, flatten_countries,
        keyed_indicators, left_enrich, classify, development_status,
        group_stats, regional_stats, save_table, publish, run_all,
    )
"""

from .operators import (
    classify,
    development_status,
    distribution,
    flatten,
    flatten_countries,
    group_stats,
    keyed_indicators,
    left_enrich,
    regional_stats,
    row_count,
)
from .plans.jobs import run_all
from .session import get_session
from .sources import append_table, publish, read_documents, read_key_list, read_table, save_table, write_documents

__version__ = "0.1.0"

__all__ = [
    "append_table",
    "classify",
    "development_status",
    "distribution",
    "flatten",
    "flatten_countries",
    "get_session",
    "group_stats",
    "keyed_indicators",
    "left_enrich",
    "publish",
    "read_documents",
    "read_key_list",
    "read_table",
    "regional_stats",
    "row_count",
    "run_all",
    "save_table",
    "write_documents",
]

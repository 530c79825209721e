"""DataFrame -> DataFrame operators."""

from .aggregate import distribution, group_stats, regional_stats, row_count
from .classify import classify, development_status
from .generate import key_occurrences, keyed_indicators
from .join import DuplicateKeyError, left_enrich
from .nested import drop, flatten, flatten_countries, narrow, rename, with_columns
from .partials import Statistics, merge_batches

__all__ = [
    "DuplicateKeyError",
    "Statistics",
    "classify",
    "development_status",
    "distribution",
    "drop",
    "flatten",
    "flatten_countries",
    "group_stats",
    "key_occurrences",
    "keyed_indicators",
    "left_enrich",
    "merge_batches",
    "narrow",
    "regional_stats",
    "rename",
    "row_count",
    "with_columns",
]

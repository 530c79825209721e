"""Key-list text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_not_blank, strip_text


def read_key_list(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One key per line: blanks stripped at both ends, blank lines dropped.

    Duplicates are kept. A missing path raises Spark's ``AnalysisException``
    at planning time. The scan is split like any text file.
    """
    keys = spark.read.text(path).select(strip_text("value").alias(column))
    return keys.filter(is_not_blank(F.col(column)))

"""Rows that cannot go into a table, kept apart with their reasons.

``with_reasons`` marks each row once; ``good_rows`` and ``bad_rows`` are the two
halves of the same mark, so together they are the input, row for row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNPARSABLE = "unparsable"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_reasons(df: DataFrame, corrupt_column: str | None = None, required: Sequence[str] = ()) -> DataFrame:
    """``df`` plus ``reasons`` (array of strings, empty for good rows) and ``record``.

    ``corrupt_column`` holds the text of a record that could not be parsed, else
    NULL; it becomes ``record``. Such a row has the one reason ``unparsable``;
    any other has ``<column> is NULL`` for each ``required`` column that is.
    """
    if taken := {"reasons", "record"} & ({*df.columns} - {corrupt_column}):
        raise ValueError(f"columns {sorted(taken)} are in the way of the quarantine's own")
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"required columns {missing} are not in {df.columns}")
    nothing = F.array().cast("array<string>")
    nulls = [F.when(_col(c).isNull(), F.array(F.lit(f"{c} is NULL"))).otherwise(nothing) for c in required]
    reasons = F.concat(*nulls) if nulls else nothing
    record = _col(corrupt_column) if corrupt_column else F.lit(None).cast("string")
    if corrupt_column:
        reasons = F.when(record.isNotNull(), F.array(F.lit(UNPARSABLE))).otherwise(reasons)
    kept = [_col(c) for c in df.columns if c != corrupt_column]
    return df.select(*kept, record.alias("record"), reasons.alias("reasons"))


def good_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size("reasons") == 0).drop("record", "reasons")


def bad_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size("reasons") > 0)

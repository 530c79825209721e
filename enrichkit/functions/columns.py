"""Column-level building blocks (pure expressions, no UDFs).

Every function returns a ``Column`` so that Catalyst can fold it into one
projection inside whole-stage codegen. All of them are NULL-safe under ANSI
mode: none raises on a NULL, empty or short array / map.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters Python's ``str.strip()`` removes are the Unicode
# White_Space characters plus the four information separators U+001C..U+001F.
# ``(?U)\s`` is Java's Unicode White_Space class.
_BLANK = r"[\s\x{1c}-\x{1f}]"
STRIP_PATTERN = rf"(?U)^{_BLANK}+|{_BLANK}+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- nested access (P5-P8) -------------------------------------------------

def first_item(arr: ColumnOrName) -> Column:
    """``arr[0]``, or NULL when the array is NULL or empty (P5)."""
    return F.get(_col(arr), 0)


def fixed_size_item(arr: ColumnOrName, index: int, size: int) -> Column:
    """``arr[index]`` only when the array has exactly ``size`` elements."""
    a = _col(arr)
    return F.when(F.size(a) == size, F.get(a, index))


def first_map_key(m: ColumnOrName) -> Column:
    """Key of the first entry in document order, NULL for NULL / empty."""
    return F.get(F.map_keys(_col(m)), 0)


def first_map_value(m: ColumnOrName, field: str | None = None) -> Column:
    """Value (or one field of it) of the first map entry."""
    value = F.get(F.map_values(_col(m)), 0)
    return value.getField(field) if field else value


# --- scalar math (M1, M2) --------------------------------------------------

def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``n / d`` when ``d > 0``; NULL when d is NULL, zero or negative (M1).

    ``try_divide`` alone is not enough: it would return a value for d < 0.
    """
    d = _col(denominator)
    return F.when(d > 0, _col(numerator) / d)


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round each named column HALF_UP to its number of digits (M2)."""
    return df.withColumns({name: F.round(F.col(name), n) for name, n in digits.items()})


# --- predicates and conditionals (C1-C6) ----------------------------------

def case_when(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered CASE: the first rule whose predicate is TRUE wins.

    A predicate that evaluates to NULL is not TRUE, so it falls through to the
    next rule and finally to ``default`` (SQL three-valued logic).
    """
    if not rules:
        return F.lit(default)
    cond, value = rules[0]
    expr = F.when(cond, value)
    for cond, value in rules[1:]:
        expr = expr.when(cond, value)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def strip_text(c: ColumnOrName) -> Column:
    """Remove leading and trailing blanks the way Python's ``str.strip`` does."""
    return F.regexp_replace(_col(c), STRIP_PATTERN, "")


def is_not_blank(c: ColumnOrName) -> Column:
    """TRUE for a non-NULL value with at least one character."""
    return F.length(_col(c)) > 0


# --- aggregation helpers (A2-A5) ------------------------------------------

def count_when(cond: Column) -> Column:
    """Conditional counter as ``sum(CASE WHEN cond THEN 1 ELSE 0 END)`` (A4).

    Per group this equals ``count_if``; it stays a plain sum so that partial
    aggregation works unchanged and an empty ungrouped input gives NULL like
    the reference.
    """
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def value_counts(c: ColumnOrName, labels: Mapping[str, str]) -> list[Column]:
    """One conditional counter per value: ``{value: output_name}`` (A4)."""
    col = _col(c)
    return [count_when(col == F.lit(value)).alias(name) for value, name in labels.items()]


# --- synthetic values (D1) ------------------------------------------------

TWO_POW_32 = 4294967296.0


def keyed_uniform(
    parts: Iterable[ColumnOrName], low: float, high: float, seed: int, name: str
) -> Column:
    """A repeatable uniform draw in ``[low, high)`` from a keyed hash.

    ``u = first 32 bits of md5("seed:name:part1:part2...") / 2^32`` and the
    value is ``low + (high - low) * u``. The same inputs always give the same
    number, on any executor and after any recomputation, so a lost task
    reproduces its rows exactly.
    """
    text = F.concat_ws(
        ":", F.lit(str(seed)), F.lit(name), *[_col(p).cast("string") for p in parts]
    )
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.lit(float(low)) + F.lit(float(high - low)) * (bits.cast("double") / F.lit(TWO_POW_32))

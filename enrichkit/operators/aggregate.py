"""Grouped statistics.

All aggregates are algebraic (sum, avg, count), so Spark runs them as a
partial HashAggregate before the shuffle and a final one after it: a key that
holds a third of all rows is reduced to one partial row per input partition
before anything moves, so hot groups cannot overload a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_columns, value_counts
from .exact import exact_sums
from .partials import Statistics


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    *,
    sums: Mapping[str, str] | None = None,
    avgs: Mapping[str, str] | None = None,
    counts_by_value: tuple[str, Mapping[str, str]] | None = None,
    count_alias: str | None = "total",
    rounding: Mapping[str, int] | None = None,
    extra: Sequence[Column] = (),
    exact: bool = False,
) -> DataFrame:
    """One row per group of ``keys`` (A1).

    ``sums`` / ``avgs`` map output name -> input column (A2, A3; NULLs are
    skipped, an all-NULL group gives NULL); ``counts_by_value`` is
    ``(column, {value: output name})`` (A4); ``count_alias`` names the
    ``count(*)`` column (A5). Rounding is applied after aggregation (M2).
    NULL keys form their own group, separate from ``""``.

    With ``exact`` the sums and averages of float and double columns are
    rounded once from the exact sum (``operators.exact``), so they and their
    rounding are the same bit for bit however the rows are dealt to tasks.
    """
    floating = {c for c in [*(sums or {}).values(), *(avgs or {}).values()] if df.schema[c].dataType.typeName() in ("double", "float")}
    if exact and floating:
        apart = [{n: c for n, c in (m or {}).items() if c in floating} for m in (sums, avgs)]
        rest = [{n: c for n, c in (m or {}).items() if c not in floating} for m in (sums, avgs)]
        plain = group_stats(df, keys, sums=rest[0], avgs=rest[1], counts_by_value=counts_by_value, count_alias="n" if count_alias is None else count_alias, extra=extra)
        other = exact_sums(df, keys, *apart)
        same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
        both = plain.alias("a").join(other.alias("b"), reduce(and_, same, F.lit(True)))
        names = [*keys, *(sums or {}), *(avgs or {}), *(counts_by_value[1].values() if counts_by_value else ())]
        names += [c for c in plain.columns if c not in names and not (count_alias is None and c == "n")]
        side = {n: "b" for m in apart for n in m}
        out = both.select(*[F.col(f"{side.get(n, 'a')}.`{n}`") for n in names])
        return round_columns(out, rounding or {})
    aggs: list[Column] = []
    aggs += [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    aggs += [F.avg(c).alias(n) for n, c in (avgs or {}).items()]
    if counts_by_value:
        column, labels = counts_by_value
        aggs += value_counts(column, labels)
    aggs += list(extra)
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    out = df.groupBy(*keys).agg(*aggs)
    return round_columns(out, rounding or {})


def distribution(df: DataFrame, column: str, count_alias: str = "count") -> DataFrame:
    """Rows per distinct value of ``column``."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count_alias))


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Global row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


# The regional-statistics preset (output names and rounding).
REGIONAL_KEYS = ("region", "subregion")
REGIONAL_SUMS = {"total_population": "population"}
REGIONAL_AVGS = {
    "avg_population_density": "population_density",
    "avg_gdp_per_capita": "gdp_per_capita",
    "avg_hdi": "hdi",
}
REGIONAL_STATUS_COUNTS = {
    "Developed": "developed_countries",
    "Emerging": "emerging_countries",
    "Developing": "developing_countries",
}
REGIONAL_ROUNDING = {"avg_population_density": 2, "avg_gdp_per_capita": 2, "avg_hdi": 3}
REGIONAL_STATISTICS = Statistics(
    keys=REGIONAL_KEYS,
    sums=REGIONAL_SUMS,
    avgs=REGIONAL_AVGS,
    counts_by_value=("development_status", REGIONAL_STATUS_COUNTS),
    count_alias="total_countries",
    rounding=REGIONAL_ROUNDING,
)


def regional_stats(enriched: DataFrame, *, exact: bool = False) -> DataFrame:
    """Country preset of ``group_stats`` (per region and subregion)."""
    return group_stats(
        enriched,
        REGIONAL_KEYS,
        sums=REGIONAL_SUMS,
        avgs=REGIONAL_AVGS,
        counts_by_value=("development_status", REGIONAL_STATUS_COUNTS),
        count_alias="total_countries",
        rounding=REGIONAL_ROUNDING,
        exact=exact,
    )

"""Grouped statistics kept up batch by batch (A1-A5, E4 without reading old input again).

Each batch of input is reduced once to integers per group: row counts, counts
by value, sums of whole numbers, and the digits of double sums
(``operators.exact``). Integers may be added up in any order, so statistics
over any set of batches are the same bit for bit as over their rows at once.

The partials are a plain parquet table partitioned by ``batch``; a batch is
written by dynamic partition overwrite, so writing it again replaces it, and
the work of a run is that of its new batches plus the stored groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..functions.columns import round_columns
from ..sources.tables import path_exists
from .exact import PARTIAL_FIELDS, exact_partials, merged_partials, sums_of_partials

_ROWS, _MARK = "rows", "batch"  # values of ``of`` beside "sum:<column>", "value:<value>" and "digits:<column>"


def _col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Statistics:
    """What to keep per group of ``keys``; the parameters mean what they mean in ``group_stats``."""

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    avgs: Mapping[str, str] = field(default_factory=dict)
    counts_by_value: tuple[str, Mapping[str, str]] | None = None
    count_alias: str | None = "total"
    rounding: Mapping[str, int] = field(default_factory=dict)

    def _floating(self, schema: StructType) -> list[str]:
        wanted = [c for c in self.sums.values() if schema[c].dataType.typeName() in ("double", "float")]
        return [*dict.fromkeys([*wanted, *self.avgs.values()])]


def _sum_type(kind: DataType) -> str:
    """The type of Spark's own sum of a column (whole numbers only)."""
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return "bigint"
    if kind.typeName() in ("double", "float"):
        return "double"
    raise TypeError(f"statistics of {kind.simpleString()} columns cannot be kept by batch")


def batch_partials(df: DataFrame, stats: Statistics) -> DataFrame:
    """The integers of one batch: keys plus ``of``, ``p``, ``s`` and the counts, map-side combined."""
    keys, floating = list(stats.keys), stats._floating(df.schema)
    for column in floating:
        _sum_type(df.schema[column].dataType)
    whole = [c for c in dict.fromkeys(stats.sums.values()) if _sum_type(df.schema[c].dataType) == "bigint"]
    held = [f"k{i}" for i in range(len(keys))]
    entries = [(_ROWS, F.count(F.lit(1)), F.count(F.lit(1)))]
    entries += [(f"sum:{c}", F.coalesce(F.sum(_col(c).cast("bigint")), F.lit(0)), F.count(_col(c))) for c in whole]
    if stats.counts_by_value:
        column, labels = stats.counts_by_value
        entries += [(f"value:{v}", F.count_if(_col(column) == v), F.count(F.lit(1))) for v in labels]
    counted = df.groupBy(*[_col(k).alias(h) for k, h in zip(keys, held, strict=True)]).agg(
        F.array(*[
            F.struct(F.lit(of).alias("of"), F.lit(None).cast("int").alias("p"), s.cast("decimal(38,0)").alias("s"), n.alias("n"))
            for of, s, n in entries
        ]).alias("parts")
    )
    zero = F.lit(0).cast("bigint")
    out = counted.select(*[F.col(h).alias(k) for h, k in zip(held, keys, strict=True)], F.inline("parts"))
    out = out.select("*", *[zero.alias(c) for c in ("nan", "up", "down")])
    if floating:
        digits = exact_partials(df, keys, floating)
        out = out.unionByName(digits.withColumn("of", F.concat(F.lit("digits:"), F.col("of"))))
    return out


def _partials_schema(df: DataFrame, keys: Sequence[str]) -> StructType:
    fields = StructType([df.schema[k] for k in keys])
    for f in StructType.fromDDL(f"{PARTIAL_FIELDS}, batch string").fields:
        fields = fields.add(f)
    for f in fields.fields:
        f.nullable = True
    return fields


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def merge_batches(
    batches: Mapping[str, DataFrame],
    partials_path: str,
    stats: Statistics,
    *,
    replace: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Statistics over all ``batches``, reading only the ones not stored yet.

    Gives the statistics and the names of the batches read. Batches named in
    ``replace`` are read again and replaced; stored batches that are not in
    ``batches`` do not count, and stay. A batch without rows is remembered as
    such. NULL keys are a group of their own. All batches have the columns of
    the first; keys may not be called ``of``, ``p``, ``s``, ``n``, ``nan``,
    ``up``, ``down`` or ``batch``. One run writes a path at a time.
    """
    if not batches or "" in batches:
        raise ValueError("batches need names")
    keys, first = list(stats.keys), next(iter(batches.values()))
    if clash := {*keys} & {"of", "p", "s", "n", "nan", "up", "down", "batch"}:
        raise ValueError(f"keys cannot be called {sorted(clash)}")
    spark, schema = first.sparkSession, _partials_schema(first, keys)
    done = {r["batch"] for r in _stored(spark, partials_path, schema).filter(F.col("of") == _MARK).select("batch").distinct().collect()}
    new = [b for b in batches if b not in done or b in replace]
    for name in new:
        mark = spark.range(1).select(
            *[F.lit(None).cast(schema[k].dataType).alias(k) for k in keys],
            F.lit(_MARK).alias("of"), F.lit(None).cast("int").alias("p"), F.lit(0).cast("decimal(38,0)").alias("s"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("n", "nan", "up", "down")],
        )
        rows = batch_partials(batches[name], stats).unionByName(mark).withColumn("batch", F.lit(name))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(partials_path)
    stored = _stored(spark, partials_path, schema).filter(F.col("batch").isin(*batches) & (F.col("of") != _MARK))
    return statistics_of(stored, stats, first.schema), new


def statistics_of(partials: DataFrame, stats: Statistics, schema: StructType) -> DataFrame:
    """The columns of ``group_stats`` from partials of any number of batches of rows of ``schema``."""
    keys, floating = list(stats.keys), stats._floating(schema)
    doubles = {n: c for n, c in stats.sums.items() if _sum_type(schema[c].dataType) == "double"}
    merged = merged_partials(partials, keys)
    aggs = []
    for name, column in stats.sums.items():
        if name not in doubles:
            of = F.col("of") == f"sum:{column}"
            value = F.sum(F.when(of, F.col("s"))).cast("bigint")
            aggs.append(F.when(F.sum(F.when(of, F.col("n"))) > 0, value).alias(name))
    if stats.counts_by_value:
        for value, name in stats.counts_by_value[1].items():
            aggs.append(F.sum(F.when(F.col("of") == f"value:{value}", F.col("s"))).cast("bigint").alias(name))
    total = F.sum(F.when(F.col("of") == _ROWS, F.col("s"))).cast("bigint")
    aggs.append(total.alias(stats.count_alias or "__ek_total"))
    out = merged.filter(~F.col("of").startswith("digits:")).groupBy(*[_col(k) for k in keys]).agg(*aggs)
    if floating:
        digits = merged.filter(F.col("of").startswith("digits:")).withColumn("of", F.expr("substring(of, 8)"))
        other = sums_of_partials(digits, keys, doubles, stats.avgs)
        same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
        both = out.alias("a").join(other.alias("b"), reduce(and_, same, F.lit(True)))
        apart = {*doubles, *stats.avgs}
        names = [*keys, *stats.sums, *stats.avgs, *[c for c in out.columns if c not in keys and c not in stats.sums]]
        out = both.select(*[F.col(f"{'b' if n in apart else 'a'}.`{n}`") for n in names])
    return round_columns(out.drop("__ek_total"), stats.rounding)

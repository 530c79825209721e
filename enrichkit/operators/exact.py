"""Sums of doubles that are equal bit for bit under any partitioning (A2, A3).

A double is at most four digits in base 2**32 at fixed positions. Digits are
integers, so their sums do not depend on the order of the rows: they are added
per group and position, map-side combined, in decimals that cannot overflow
below 2**90 rows. Per group the at most 70 positions are carried, and the whole
sum is rounded to a double once (half to even; a sum below 2**-960 twice).

NULLs are skipped; a group of NULLs gives NULL. NaN, or infinities of both
signs, give NaN, one infinity gives itself. A zero sum is 0.0. An average is
the rounded sum divided by the number of values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE = "CAST(4294967296 AS DECIMAL(38,0))"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _digits(value: Column, number: int) -> Column:
    """Array of (number, position, digit) of a finite double; empty for NULL, NaN, infinities and zero."""
    size = F.abs(value)
    usual = (size > 0) & (size < F.lit(float("inf")))
    small = size < F.lit(2.0**-400)
    scaled = F.when(small, value * F.lit(2.0**608)).otherwise(value)  # exact; 19 positions
    top = F.floor(F.log2(F.abs(scaled)) / 32).cast("int")
    one = F.struct(scaled.alias("x"), top.alias("p"), F.when(small, 19).otherwise(0).alias("shift"))

    def digits(s: Column) -> Column:
        found, rest = [], s["x"]
        for i in range(4):
            unit = F.pow(F.lit(2.0), (s["p"] - i) * 32)
            digit = F.when(rest < 0, F.ceil(rest / unit)).otherwise(F.floor(rest / unit)).cast("long")
            found.append(F.struct(F.lit(number).alias("of"), (s["p"] - i - s["shift"]).alias("p"), digit.alias("d")))
            rest = rest - digit.cast("double") * unit
        return F.array(*found)

    none = F.array().cast("array<struct<of:int,p:int,d:bigint>>")
    # the struct sits in an array so that the fold's variable is computed once
    made = F.flatten(F.transform(F.array(one), digits))
    return F.when(usual, F.filter(made, lambda x: x["d"] != 0)).otherwise(none)


def _carried(sign: str) -> str:
    """Base 2**32 digits of the whole sum (or of its negative), lowest position first, and what is left above."""
    here = f"(a.c {sign} coalesce(at[p], CAST(0 AS DECIMAL(38,0))))"
    return f"""
aggregate(sequence(low, high + 4),
  named_struct('c', CAST(0 AS DECIMAL(38,0)), 'd', CAST(array() AS ARRAY<BIGINT>)),
  (a, p) -> named_struct(
    'c', CAST(({here} - pmod({here}, {_BASE})) div {_BASE} AS DECIMAL(38,0)),
    'd', array_append(a.d, CAST(pmod({here}, {_BASE}) AS BIGINT))))"""


_PART = "coalesce(CAST(get(d, top - {i}) AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)))"


def _rounded(df: DataFrame) -> DataFrame:
    """``df`` with ``digits`` (array of position and sum) replaced by ``value``, the double nearest to their sum."""
    keep = [c for c in df.columns if c != "digits"]
    df = df.withColumns({
        "at": F.expr("map_from_entries(digits)"),
        "low": F.expr("array_min(transform(digits, x -> x.p))"),
        "high": F.expr("array_max(transform(digits, x -> x.p))"),
    })
    df = df.withColumns({"plus": F.expr(_carried("+")), "minus": F.expr(_carried("-"))})
    df = df.withColumns({"negative": F.expr("plus.c < 0"), "d": F.expr("if(plus.c < 0, minus.d, plus.d)")})
    df = df.withColumn("top", F.expr("array_max(transform(d, (x, i) -> if(x <> 0, i, -1)))"))
    # three digits hold at least 65 bits; lower ones only decide a tie, by the last bit
    head = f"{_PART.format(i=0)} * {_BASE} * {_BASE} + {_PART.format(i=1)} * {_BASE} + {_PART.format(i=2)}"
    df = df.withColumn("head", F.expr(f"CAST({head} AS DECIMAL(38,0))"))
    below = F.expr("top > 2 AND exists(slice(d, 1, greatest(top - 2, 0)), x -> x <> 0) AND pmod(head, 2) = 0")
    head = F.when(below, F.col("head") + 1).otherwise(F.col("head")).cast("double")
    unit = F.pow(F.lit(2.0), (F.col("low") + F.col("top") - 2) * 16)  # twice: half the exponent
    value = F.when(F.col("negative"), -head).otherwise(head) * unit * unit
    return df.select(*keep, F.when(F.col("top") < 0, F.lit(0.0)).otherwise(value).alias("value"))


PARTIAL_FIELDS = "of string, p int, s decimal(38,0), n bigint, nan bigint, up bigint, down bigint"


def exact_partials(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys plus ``PARTIAL_FIELDS``: sums of integers per group, column (``of``) and position.

    Such rows of several inputs may be put together in any order
    (``merged_partials``); ``sums_of_partials`` rounds them to doubles.
    """
    names = [*dict.fromkeys(columns)]
    values = [_col(c).cast("double") for c in names]
    inf = F.lit(float("inf"))
    flags = [
        F.struct(
            F.lit(i).alias("of"), F.lit(None).cast("int").alias("p"), F.lit(0).cast("bigint").alias("d"),
            v.isNotNull().cast("bigint").alias("n"), F.isnan(v).cast("bigint").alias("nan"),
            (v == inf).cast("bigint").alias("up"), (v == -inf).cast("bigint").alias("down"),
        )
        for i, v in enumerate(values)
    ]
    zero = F.lit(0).cast("bigint")
    parts = F.concat(
        F.array(*flags),
        *[
            F.transform(_digits(v, i), lambda x: F.struct(
                x["of"].alias("of"), x["p"].alias("p"), x["d"].alias("d"),
                zero.alias("n"), zero.alias("nan"), zero.alias("up"), zero.alias("down")))
            for i, v in enumerate(values)
        ],
    )
    held = _held(keys)
    rows = df.select(*[_col(k).alias(h) for k, h in zip(keys, held, strict=True)], F.inline(parts))
    each = rows.groupBy(*held, "of", "p").agg(
        F.sum(F.col("d").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s"), *[F.sum(c).alias(c) for c in _COUNTS]
    )
    of = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("of") + 1)
    return each.select(*[F.col(h).alias(k) for h, k in zip(held, keys, strict=True)], of.alias("of"), "p", "s", *_COUNTS)


_COUNTS = ("n", "nan", "up", "down")


def _held(keys: Sequence[str]) -> list[str]:
    """Names of the keys while columns of this module stand beside them."""
    return [f"k{i}" for i in range(len(keys))]


def _with_held(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.select(*[_col(k).alias(h) for k, h in zip(keys, _held(keys), strict=True)], "of", "p", "s", *_COUNTS)


def merged_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``exact_partials``, of one input or several, with one row per group, column and position."""
    held = _held(keys)
    out = _with_held(partials, keys).groupBy(*held, "of", "p").agg(
        F.sum("s").cast("decimal(38,0)").alias("s"), *[F.sum(c).alias(c) for c in _COUNTS]
    )
    return out.select(*[F.col(h).alias(k) for h, k in zip(held, keys, strict=True)], "of", "p", "s", *_COUNTS)


def sums_of_partials(partials: DataFrame, keys: Sequence[str], sums: Mapping[str, str], avgs: Mapping[str, str]) -> DataFrame:
    """keys plus the sums and averages (output name -> column) of merged partials, each rounded once."""
    held, zero, inf = _held(keys), F.lit(0).cast("bigint"), F.lit(float("inf"))
    digits = F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "s")))
    whole = _with_held(partials, keys).groupBy(*held, "of").agg(digits.alias("digits"), *[F.sum(c).alias(c) for c in _COUNTS])
    total = F.coalesce("n", zero)
    both = (F.coalesce("nan", zero) > 0) | ((F.col("up") > 0) & (F.col("down") > 0))
    value = (
        F.when(total == 0, None).when(both, float("nan")).when(F.col("up") > 0, inf).when(F.col("down") > 0, -inf)
        .otherwise(F.coalesce("value", F.lit(0.0)))
    )
    done = _rounded(whole).select(*held, "of", value.alias("value"), total.alias("n"))
    out = done.groupBy(*held).agg(F.map_from_entries(F.collect_list(F.struct("of", F.struct("value", "n")))).alias("by"))
    found = lambda c: F.col("by")[F.lit(c)]
    columns = [F.col(h).alias(k) for h, k in zip(held, keys, strict=True)]
    columns += [found(c)["value"].alias(n) for n, c in sums.items()]
    columns += [F.when(found(c)["n"] > 0, found(c)["value"] / found(c)["n"]).alias(n) for n, c in avgs.items()]
    return out.select(*columns)


def exact_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], avgs: Mapping[str, str]) -> DataFrame:
    """keys plus the sums and averages (output name -> input column of doubles) of each group; NULL keys are a group."""
    return sums_of_partials(exact_partials(df, keys, [*sums.values(), *avgs.values()]), keys, sums, avgs)

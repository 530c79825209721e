"""Exact sums against fractions, under any partitioning."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from enrichkit.operators.aggregate import group_stats, regional_stats
from enrichkit.operators.exact import exact_sums

NAN, INF = float("nan"), float("inf")


def bits(x):
    return None if x is None else struct.pack("<d", x) if not math.isnan(x) else "nan"


def want(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {INF, -INF} <= set(values):
        return NAN
    if INF in values or -INF in values:
        return INF if INF in values else -INF
    return float(sum(map(Fraction, values), Fraction(0)))


def groups():
    r = random.Random(3)
    wide = lambda: math.ldexp(r.uniform(-1, 1), r.randint(-1060, 1000))
    near = lambda: r.uniform(-1e6, 1e6)
    out = {
        "cancels": [1e16, 1.0, -1e16], "tie to even": [2.0**53, 1.0], "above the tie": [2.0**53, 1.0, 2.0**-900],
        "below the tie": [2.0**53, 1.0, -(2.0**-900)], "nan": [1.0, NAN], "inf": [INF, 1.0], "down": [-INF, 1e300], "both": [INF, -INF],
        "null": [None, None], "some null": [None, 0.1, 0.2], "zero": [0.0, -0.0], "to zero": [1e-300, -1e-300, 3.5, -3.5],
        "powers": [2.0**k for k in range(-40, 70)], "minus powers": [-(2.0**k) for k in range(-40, 70)], "large": [1.7e308, 1.7e308, -1.7e308],
        "tiny": [5e-324, 5e-324, 1e-310], "tenths": [0.1] * 1000, "edges": [4294967296.0, 4294967295.0, -4294967297.0, 2.0**-32],
    }
    for i in range(12):
        out[f"wide {i}"] = [wide() for _ in range(r.randint(1, 40))]
        out[f"near {i}"] = [near() for _ in range(300)] + [1e18, -1e18]
    out[None] = [0.1, 0.2, 0.3]
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_are_the_nearest_double(spark, parts):
    data = groups()
    rows = [(k, v) for k, vs in data.items() for v in vs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(parts)
    got = {r.g: r for r in exact_sums(df, ["g"], {"total": "x"}, {"mean": "x"}).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        n = sum(v is not None for v in vs)
        total = want(vs)
        assert bits(got[k].total) == bits(total), (k, got[k].total, total)
        assert bits(got[k].mean) == bits(None if not n else total / n), k


def test_group_stats_equal_under_any_partitioning(spark):
    r = random.Random(5)
    rows = [(i % 3, r.uniform(-1e9, 1e9) * 10 ** r.randint(-9, 9), i) for i in range(4000)]
    seen = set()
    for parts in (1, 3, 16):
        df = spark.createDataFrame(rows, "k int, x double, i bigint").repartition(parts, F.rand(parts))
        out = group_stats(
            df, ["k"], sums={"s": "x", "n_i": "i"}, avgs={"a": "x"}, counts_by_value=("k", {1: "ones"}), rounding={"a": 3}, exact=True
        )
        assert out.columns == ["k", "s", "n_i", "a", "ones", "total"]
        seen.add(tuple(sorted(map(tuple, out.collect()))))
    assert len(seen) == 1


def test_regional_preset_has_the_same_columns(spark):
    schema = "region string, subregion string, population bigint, population_density double, gdp_per_capita double, hdi double, development_status string"
    df = spark.createDataFrame([(None, "x", 5, 1.005, None, 0.5, "Developed"), (None, "x", 6, 1.0, None, 0.25, "Developing")], schema)
    plain, exact = regional_stats(df), regional_stats(df, exact=True)
    assert exact.dtypes == plain.dtypes and exact.collect() == plain.collect()


def test_no_rows_and_no_keys(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_sums(df, ["g"], {"s": "x"}, {}).collect() == []

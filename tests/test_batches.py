"""Statistics kept by batch equal those over all rows at once, bit for bit."""

import random

import pytest
from pyspark.sql import functions as F

from enrichkit.operators.aggregate import REGIONAL_STATISTICS, group_stats, regional_stats
from enrichkit.operators.partials import Statistics, merge_batches
from enrichkit.plans import jobs
from enrichkit.sources.tables import read_table, save_table

STATS = Statistics(
    keys=["g", "h"], sums={"total": "n", "x_total": "x"}, avgs={"mean": "x", "n_mean": "n"},
    counts_by_value=("status", {"a": "n_a", "b": "n_b"}), count_alias="rows_", rounding={"mean": 2},
)


def rows(count, seed):
    r = random.Random(seed)
    values = [1e16, 1.0, -1e16, 0.1, 0.005, None, float("nan")]
    return [
        (r.choice(["p", "", None]), r.choice([1, None]), r.choice([None, 3, -7, 2**40]), r.choice(values[:5] if i % 50 else values),
         r.choice(["a", "b", "c", None]))
        for i in range(count)
    ]


SCHEMA = "g string, h int, n bigint, x double, status string"


def whole(df):
    return group_stats(
        df, STATS.keys, sums=STATS.sums, avgs=STATS.avgs, counts_by_value=STATS.counts_by_value,
        count_alias=STATS.count_alias, rounding=STATS.rounding, exact=True,
    )


def held(df):
    columns = sorted(df.columns)
    return columns, sorted(repr([r[c] for c in columns]) for r in df.collect())


def test_batches_equal_one_run(spark, tmp_table):
    parts = {f"b/{i}": spark.createDataFrame(rows(n, i), SCHEMA) for i, n in enumerate([200, 1, 0, 300])}
    path, seen = tmp_table("partials"), {}
    for name in parts:
        seen[name] = parts[name]
        got, read = merge_batches(seen, path, STATS)
        assert read == [name]  # old batches, the empty one too, are not read again
    union = parts["b/0"].unionByName(parts["b/1"]).unionByName(parts["b/3"])
    assert held(got) == held(whole(union))
    # one taken out, one replaced
    got, read = merge_batches({"b/0": parts["b/0"], "b/3": parts["b/1"]}, path, STATS, replace=["b/3"])
    assert read == ["b/3"]
    assert held(got) == held(whole(parts["b/0"].unionByName(parts["b/1"])))


def test_group_of_nulls_only_and_no_rows(spark, tmp_table):
    df = spark.createDataFrame([("p", 1, None, None, None)], SCHEMA)
    got, _ = merge_batches({"a": df, "b": df}, tmp_table("partials"), STATS)
    row = got.collect()[0].asDict()
    assert row == {"g": "p", "h": 1, "total": None, "x_total": None, "mean": None, "n_mean": None, "n_a": 0, "n_b": 0, "rows_": 2}
    got, _ = merge_batches({"a": df.limit(0)}, tmp_table("partials"), STATS)
    assert got.collect() == []


def test_old_batches_are_not_scanned(spark, tmp_table):
    path, broken = tmp_table("partials"), spark.createDataFrame(rows(20, 1), SCHEMA)
    merge_batches({"a": broken}, path, STATS)
    fails = broken.withColumn("x", F.raise_error(F.lit("read")).cast("double"))
    got, read = merge_batches({"a": fails}, path, STATS)
    assert read == [] and held(got) == held(whole(broken))


def test_refuses(spark, tmp_table):
    df = spark.createDataFrame([(1, "x")], "of int, t string")
    with pytest.raises(ValueError):
        merge_batches({"a": df}, tmp_table(), Statistics(keys=["of"]))
    with pytest.raises(ValueError):
        merge_batches({}, tmp_table(), Statistics(keys=["t"]))
    with pytest.raises(TypeError):
        merge_batches({"a": df}, tmp_table(), Statistics(keys=["t"], sums={"s": "t"}))


def test_job(spark, tmp_table):
    schema = "region string, subregion string, population bigint, population_density double, gdp_per_capita double, hdi double, development_status string"
    one = spark.createDataFrame([("r", None, 5, 0.1, 1.0, 0.5, "Emerging"), ("r", "", None, None, None, None, None)], schema)
    two = spark.createDataFrame([("r", None, 7, 0.2, 3.0, 0.7, "Developed")], schema)
    first, second, out = tmp_table("first"), tmp_table("second"), tmp_table("stats")
    save_table(one, first)
    save_table(two, second)
    partials = tmp_table("partials")
    assert jobs.aggregate_batches(spark, {"1": first}, partials, out).metrics == {"rows": 2, "read": ["1"]}
    done = jobs.aggregate_batches(spark, {"1": first, "2": second}, partials, out)
    assert done.metrics["read"] == ["2"]
    want = regional_stats(one.unionByName(two), exact=True)
    assert held(read_table(spark, out)) == held(want)
    assert [*REGIONAL_STATISTICS.keys] == want.columns[:2]

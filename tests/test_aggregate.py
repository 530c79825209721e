from enrichkit.operators.aggregate import distribution, group_stats, regional_stats, row_count

SCHEMA = (
    "region string, subregion string, population bigint, population_density double, "
    "gdp_per_capita double, hdi double, development_status string"
)


def test_regional_stats_groups_nulls_and_rounding(spark):
    rows = [
        ("Europe", "North", 10, 1.005, 1000.0, 0.8, "Developed"),
        ("Europe", "North", 20, 1.005, 2000.0, 0.9, "Emerging"),
        ("Europe", None, 5, None, None, None, "Developing"),
        ("Europe", "", 7, 2.0, 10.0, 0.5, "Developing"),
        ("Asia", "East", None, None, None, None, "Developing"),
        (None, None, 1, 3.0, 3.0, 0.4, "Developing"),
    ]
    out = {(r.region, r.subregion): r for r in regional_stats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(out) == {("Europe", "North"), ("Europe", None), ("Europe", ""), ("Asia", "East"), (None, None)}
    n = out[("Europe", "North")]
    assert n.total_population == 30 and n.avg_population_density == 1.01  # HALF_UP on 1.005
    assert n.avg_gdp_per_capita == 1500.0 and n.avg_hdi == 0.85
    assert (n.developed_countries, n.emerging_countries, n.developing_countries) == (1, 1, 0)
    assert n.total_countries == 2
    a = out[("Asia", "East")]
    assert a.total_population is None and a.avg_hdi is None and a.developing_countries == 1
    assert a.developed_countries == 0


def test_group_stats_output_order_and_types(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x")], "k string, v int, s string")
    out = group_stats(
        df, ["k"], sums={"sv": "v"}, avgs={"av": "v"},
        counts_by_value=("s", {"x": "n_x", "y": "n_y"}), count_alias="n",
        rounding={"av": 1},
    )
    assert out.columns == ["k", "sv", "av", "n_x", "n_y", "n"]
    got = {r.k: tuple(r) for r in out.collect()}
    assert got["a"] == ("a", 3, 1.5, 1, 1, 2)
    assert dict(out.dtypes)["n_x"] == "bigint"


def test_distribution_and_row_count(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "s string")
    assert {tuple(r) for r in distribution(df, "s").collect()} == {("x", 2), ("y", 1), (None, 1)}
    assert row_count(df).first()["n_rows"] == 4


def test_sum_overflow_raises_under_ansi(spark):
    import pytest

    df = spark.createDataFrame(
        [("R", "S", 2**62, None, None, None, "Developing")] * 3, SCHEMA
    )
    with pytest.raises(Exception, match="(?i)overflow"):
        regional_stats(df).collect()


def test_conditional_counter_on_empty_input(spark):
    from pyspark.sql import functions as F

    from enrichkit.functions.columns import count_when

    empty = spark.createDataFrame([], "s string")
    row = empty.agg(count_when(F.col("s") == "x").alias("n"), F.count_if(F.col("s") == "x").alias("c")).first()
    assert row.n is None and row.c == 0  # the reference's sum-of-CASE gives NULL here
    one = spark.createDataFrame([("y",)], "s string")
    assert one.groupBy("s").agg(count_when(F.col("s") == "x").alias("n")).first().n == 0

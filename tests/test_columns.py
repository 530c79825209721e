import pytest
from pyspark.sql import functions as F

from enrichkit.functions.columns import (
    case_when,
    first_item,
    first_map_key,
    first_map_value,
    fixed_size_item,
    keyed_uniform,
    safe_ratio,
    strip_text,
)


def test_first_item_null_empty_and_values(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), (["a", "b"],)], "a array<string>")
    assert [r[0] for r in df.select(first_item("a")).collect()] == [None, None, "a", "a"]


def test_fixed_size_item_only_exact_size(spark):
    df = spark.createDataFrame([(None,), ([1.0],), ([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "a array<double>")
    got = df.select(fixed_size_item("a", 0, 2), fixed_size_item("a", 1, 2)).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (1.0, 2.0), (None, None)]


def test_first_map_entry_keeps_document_order(spark):
    schema = "m map<string, struct<name:string, symbol:string>>"
    df = spark.createDataFrame(
        [(None,), ({},), ({"ZZZ": ("z", "Z"), "AAA": ("a", "A")},), ({"K": None},)], schema
    )
    # build the unordered map with an explicit order (a Python dict may reorder)
    df = df.union(
        spark.range(1).select(
            F.create_map(
                F.lit("ZZZ"), F.struct(F.lit("z").alias("name"), F.lit("Z").alias("symbol")),
                F.lit("AAA"), F.struct(F.lit("a").alias("name"), F.lit("A").alias("symbol")),
            ).alias("m")
        )
    )
    got = [tuple(r) for r in df.select(first_map_key("m"), first_map_value("m", "name")).collect()]
    assert got[0] == (None, None) and got[1] == (None, None)
    assert got[3] == ("K", None)
    assert got[4] == ("ZZZ", "z")


@pytest.mark.parametrize(
    "num,den,expected",
    [(10, 2.0, 5.0), (10, 0.0, None), (7, -1.0, None), (7, None, None), (None, 2.0, None)],
)
def test_safe_ratio(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "n bigint, d double")
    assert df.select(safe_ratio("n", "d")).first()[0] == expected


def test_strip_text_matches_python_strip(spark):
    samples = [
        " ABC ", "\tABC\t", " ABC　", "\x1cABC\x1f", "\x0bA B\x0c", "  ", "", "A​B",
        " X ", "\x85Y ",
    ]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r[0] for r in df.select(strip_text("v")).collect()]
    assert got == [s.strip() for s in samples]


def test_case_when_three_valued_logic(spark):
    rows = [
        (0.8, 20000.0, "Developed"),
        (0.8, 19999.99, "Emerging"),
        (0.7, 1.0, "Emerging"),
        (0.69, 12000.0, "Emerging"),
        (0.69, 11999.0, "Developing"),
        (None, None, "Developing"),
        (None, 12000.0, "Emerging"),
        (0.9, None, "Emerging"),
        (0.5, None, "Developing"),
        (float("nan"), 20000.0, "Developed"),
    ]
    df = spark.createDataFrame(rows, "hdi double, gdp double, want string")
    h, g = F.col("hdi"), F.col("gdp")
    expr = case_when(
        [((h >= 0.8) & (g >= 20000), "Developed"), ((h >= 0.7) | (g >= 12000), "Emerging")],
        "Developing",
    )
    for got, want in df.select(expr, "want").collect():
        assert got == want


def test_case_when_without_default_is_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    got = [r[0] for r in df.select(case_when([(F.col("x") > 1, "big")])).collect()]
    assert got == [None, "big"]


def test_keyed_uniform_range_and_repeatable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    u = keyed_uniform(["k"], 0.4, 0.99, 42, "hdi")
    a = [r[0] for r in df.select(u).collect()]
    b = [r[0] for r in df.repartition(7).orderBy("k").select(u).collect()]
    assert all(0.4 <= x < 0.99 for x in a)
    assert sorted(a) == sorted(b)
    assert len(set(a)) > 1990


from hypothesis import given, settings
from hypothesis import strategies as st

# blanks of several kinds mixed with ordinary letters
_ALPHABET = st.sampled_from(list("ab Z\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       　​﻿"))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(_ALPHABET, max_size=8), min_size=1, max_size=60))
def test_strip_text_property(spark, samples):
    # one DataFrame per example keeps the number of Spark jobs small
    samples = [s.replace("\n", "").replace("\r", "") for s in samples]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r[0] for r in df.select(strip_text("v")).collect()]
    assert got == [s.strip() for s in samples]

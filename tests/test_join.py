import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from enrichkit.operators.join import DuplicateKeyError, left_enrich

LEFT_SCHEMA = "code string, pop bigint"
RIGHT_SCHEMA = "code_econ string, gdp double"


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_left_join_keeps_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], LEFT_SCHEMA)
    right = spark.createDataFrame([("A", 10.0), (None, 99.0)], RIGHT_SCHEMA)
    out = left_enrich(left, right, "code", "code_econ")
    assert out.columns == ["code", "pop", "gdp"]
    assert _rows(out) == Counter({("A", 1, 10.0): 1, ("B", 2, None): 1, (None, 3, None): 1})


def test_duplicate_right_keys_fan_out(spark):
    left = spark.createDataFrame([("A", 1), ("B", 2)], LEFT_SCHEMA)
    right = spark.createDataFrame([("A", 10.0), ("A", 11.0), ("A", 10.0)], RIGHT_SCHEMA)
    out = left_enrich(left, right, "code", "code_econ")
    assert _rows(out) == Counter({("A", 1, 10.0): 2, ("A", 1, 11.0): 1, ("B", 2, None): 1})


def test_on_duplicate_error(spark):
    left = spark.createDataFrame([("A", 1)], LEFT_SCHEMA)
    right = spark.createDataFrame([("A", 10.0), ("A", 11.0)], RIGHT_SCHEMA)
    with pytest.raises(DuplicateKeyError):
        left_enrich(left, right, "code", "code_econ", on_duplicate="error")
    unique = spark.createDataFrame([("A", 10.0)], RIGHT_SCHEMA)
    assert left_enrich(left, unique, "code", "code_econ", on_duplicate="error").count() == 1


def test_keep_right_key(spark):
    left = spark.createDataFrame([("A", 1)], LEFT_SCHEMA)
    right = spark.createDataFrame([("A", 10.0)], RIGHT_SCHEMA)
    out = left_enrich(left, right, "code", "code_econ", drop_right_key=False)
    assert out.columns == ["code", "pop", "code_econ", "gdp"]


@pytest.mark.parametrize("threshold", [1, 3, 7, 50])
def test_salted_join_equals_plain_join(spark, threshold):
    rnd = random.Random(threshold)
    # one very hot key (a third of the right rows, many exact copies), some
    # warm keys, unmatched and NULL keys on both sides
    right = [("HOT", float(rnd.randint(0, 3))) for _ in range(300)]
    right += [(f"K{rnd.randint(0, 40)}", float(rnd.randint(0, 5))) for _ in range(600)]
    right += [(None, 1.0), ("ONLY_RIGHT", 2.0)]
    left = [("HOT", i) for i in range(5)] + [(f"K{i}", i) for i in range(60)]
    left += [(None, 100), ("ONLY_LEFT", 101), ("K1", 102)]
    l = spark.createDataFrame(left, LEFT_SCHEMA)
    r = spark.createDataFrame(right, RIGHT_SCHEMA)
    plain = left_enrich(l, r, "code", "code_econ")
    salted = left_enrich(l, r, "code", "code_econ", skew_threshold=threshold)
    assert salted.columns == plain.columns
    assert _rows(salted) == _rows(plain)


def test_salted_join_splits_hot_key_over_tasks(spark):
    r = spark.range(4000).selectExpr("'HOT' AS code_econ", "CAST(id % 3 AS DOUBLE) AS gdp")
    l = spark.createDataFrame([("HOT", 1)], LEFT_SCHEMA)
    out = left_enrich(l, r, "code", "code_econ", skew_threshold=100)
    per_task = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 4000
    assert max(per_task) < 4000  # not all pairs from one task


def _bits(df):
    """Rows with every value spelled out: 0.0 and -0.0 differ, NaN equals NaN, maps keep their order."""
    return Counter(tuple(repr(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("threshold", [1, 4, 20])
def test_salted_join_is_exact_bit_for_bit(spark, threshold):
    nan = float("nan")
    values = [0.0, -0.0, nan, 1.5, None]
    right = [("HOT", values[i % 5], {"b": -0.0 if i % 2 else 0.0, "a": 1.0}, [0.0, -0.0][i % 2]) for i in range(60)]
    right += [(None, 1.0, None, 0.0)] * 30 + [("K1", -0.0, {}, nan)] * 3
    left = [("HOT", -0.0 if i % 2 else 0.0) for i in range(40)] + [(None, -0.0)] * 40 + [("K1", nan), ("K2", 0.0)]
    l = spark.createDataFrame(left, "code string, x double")
    r = spark.createDataFrame(right, "code_econ string, v double, m map<string,double>, w double")
    plain = left_enrich(l, r, "code", "code_econ")
    salted = left_enrich(l, r, "code", "code_econ", skew_threshold=threshold)
    assert _bits(salted) == _bits(plain)


HELPERS = ("__ek_a", "__ek_cells_l", "__ek_cells_r", "__ek_chunk_l", "__ek_l", "cells_l", "cells_r", "chunk_l", "chunk_r", "ek_l", "ek_r", "n_l", "n_r")


@pytest.mark.parametrize("threshold", [None, 2])
@pytest.mark.parametrize("upper", [False, True])
def test_helper_names_as_columns(spark, threshold, upper):
    left = spark.createDataFrame([("A", 1)] * 3 + [("B", 2), (None, 3)], "code string, id int")
    right = spark.createDataFrame([("A", 1.0)] * 3 + [("C", 2.0), (None, 3.0)], "code_econ string, v double")
    for i, name in enumerate(HELPERS):
        name = name.upper() if upper else name
        left, right = left.withColumn(name, F.lit(i)), right.withColumn(name, F.lit(-i))
    out = left_enrich(left, right, "code", "code_econ", skew_threshold=threshold)
    assert out.columns == [*left.columns, "v", *right.columns[2:]]
    want = [("A", 1, *range(13), 1.0, *(-i for i in range(13)))] * 9
    want += [("B", 2, *range(13), *[None] * 14), (None, 3, *range(13), *[None] * 14)]
    assert _rows(out) == Counter(want)


def test_sketch_leaves_only_candidates_to_count(spark, monkeypatch):
    """Also with so few counters that most keys share one; types that hash apart are counted exactly."""
    from enrichkit.operators import join

    l = spark.range(300).selectExpr("id % 50 AS code", "id AS pop")
    r = spark.range(200).selectExpr("CASE WHEN id < 60 THEN 7 ELSE id END AS code_econ", "CAST(id AS DOUBLE) AS gdp")
    plain = _rows(left_enrich(l, r, "code", "code_econ"))
    for counters in (2, 7, 1 << 16):
        monkeypatch.setattr(join, "SKETCH", counters)
        assert _rows(left_enrich(l, r, "code", "code_econ", skew_threshold=20)) == plain
        assert join._hot_keys(l, r, "code", "code_econ", 20, ("left", "right"), join._Names(l, r)).count() == 1
        assert join._hot_keys(l, r, "code", "code_econ", 20, ("left",), join._Names(l, r)) is None or counters < 50
        narrow = l.withColumn("code", F.col("code").cast("int"))
        assert _rows(left_enrich(narrow, r, "code", "code_econ", skew_threshold=20)) == plain
    assert join._hot_keys(l, r, "code", "code_econ", 500, ("left", "right"), join._Names(l, r)) is None


@pytest.mark.parametrize("threshold", [None, 2])
def test_equal_key_names_keep_one_key(spark, threshold, tmp_table):
    left = spark.createDataFrame([("A", 1), ("A", 2), (None, 3), ("B", 4)], "k string, id int")
    right = spark.createDataFrame([("A", 10.0), ("A", 11.0), (None, 1.0)], "k string, v double")
    out = left_enrich(left, right, "k", "k", skew_threshold=threshold)
    assert out.columns == ["k", "id", "v"]
    out.write.parquet(tmp_table("equal_names"))
    assert _rows(out) == Counter(
        {("A", 1, 10.0): 1, ("A", 1, 11.0): 1, ("A", 2, 10.0): 1, ("A", 2, 11.0): 1, (None, 3, None): 1, ("B", 4, None): 1}
    )
    both = left_enrich(left, right, "k", "k", skew_threshold=threshold, drop_right_key=False)
    assert both.columns == ["k", "id", "k", "v"]


def test_null_right_keys_are_no_duplicates(spark):
    left = spark.createDataFrame([("A", 1)], LEFT_SCHEMA)
    right = spark.createDataFrame([("A", 1.0), (None, 2.0), (None, 3.0)], RIGHT_SCHEMA)
    assert left_enrich(left, right, "code", "code_econ", on_duplicate="error").count() == 1


def test_no_task_is_much_larger_with_null_and_hot_left_keys(spark):
    n = 30_000  # a third NULL, a third one key, both with many equal rows
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "HOT").otherwise(F.col("id").cast("string"))
    left = spark.range(n).repartition(6).select(key.alias("code"), (F.col("id") % 7).alias("pop"))
    right = spark.createDataFrame([("HOT", float(i)) for i in range(3)] + [("5", 1.0)], RIGHT_SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = left_enrich(left, right, "code", "code_econ", skew_threshold=200)
        per_task = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(per_task) == n + n // 3 * 2
    assert max(per_task) < 4 * sum(per_task) / len(per_task)


from hypothesis import given, settings
from hypothesis import strategies as st

_KEYS = st.sampled_from(["A", "B", "C", "D", None])


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(_KEYS, st.integers(0, 3)), min_size=0, max_size=30),
    st.lists(st.tuples(_KEYS, st.integers(0, 2)), min_size=0, max_size=80),
    st.integers(1, 10),
)
def test_salted_join_property(spark, left_rows, right_rows, threshold):
    l = spark.createDataFrame(left_rows, "code string, pop bigint")
    r = spark.createDataFrame([(k, float(v)) for k, v in right_rows], RIGHT_SCHEMA)
    plain = left_enrich(l, r, "code", "code_econ")
    salted = left_enrich(l, r, "code", "code_econ", skew_threshold=threshold)
    assert _rows(salted) == _rows(plain)

import os
import time
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from enrichkit import session
from enrichkit.schemas import economic_schema
from enrichkit.session import clear_scratch, scratch_path
from enrichkit.sources.key_list import read_key_list
from enrichkit.sources.tables import (
    SchemaMismatchError,
    conform,
    path_exists,
    StrayFilesError,
    append_table,
    current_path,
    publish,
    read_table,
    save_table,
    table_name,
    typed_rows,
)


def test_key_list_strips_and_keeps_duplicates(spark, tmp_table):
    path = tmp_table("codes").replace("file:", "")
    os.makedirs(path)
    lines = ["AFG", "COK", "COK ", "\tNIU\t", "", "   ", " WSM　", "NIU", "\x1cKIR\x1f"]
    with open(os.path.join(path, "codes.txt"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = Counter(r.code for r in read_key_list(spark, path, "code").collect())
    want = Counter(s.strip() for s in lines if s.strip())
    assert got == want and got["COK"] == 2 and got["NIU"] == 2


def test_key_list_missing_path_raises(spark, tmp_table):
    with pytest.raises(AnalysisException):
        read_key_list(spark, tmp_table("missing")).collect()


def test_save_read_roundtrip_and_schema_guard(spark, tmp_table):
    path = tmp_table("tbl")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, s string")
    save_table(df, path)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b")]
    save_table(df.limit(1), path)  # same schema: whole table replaced
    assert read_table(spark, path).count() == 1
    other = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(SchemaMismatchError):
        save_table(other, path)
    save_table(other, path, overwrite_schema=True)
    assert read_table(spark, path).columns == ["x"]


def test_overwrite_of_own_input(spark, tmp_table):
    path = tmp_table("self")
    save_table(spark.createDataFrame([(1,)], "x int"), path)
    for n in (2, 3, 4):
        save_table(read_table(spark, path).withColumn("x", F.col("x") + 1), path)
        assert [r.x for r in read_table(spark, path).collect()] == [n]


def test_publish_copies_unchanged(spark, tmp_table):
    src, dst = tmp_table("src"), tmp_table("dst")
    df = spark.createDataFrame([(1, "a")], "id bigint, s string")
    save_table(df, src)
    out = publish(spark, src, dst)
    assert out.schema == read_table(spark, src).schema and out.collect() == df.collect()


def test_typed_rows_and_conform_not_null(spark):
    schema = economic_schema()
    df = typed_rows(spark, [("ABC", 1.0, 0.5)], schema)
    assert df.schema == schema
    src = spark.createDataFrame([("ABC", 1.0, 0.5, "x")], "country_code_3_econ string, gdp_per_capita double, hdi double, y string")
    out = conform(src, schema)
    assert out.schema == schema and out.count() == 1
    bad = spark.createDataFrame([(None, 1.0, 0.5)], "country_code_3_econ string, gdp_per_capita double, hdi double")
    with pytest.raises(Exception, match="NOT NULL"):
        conform(bad, schema).collect()


def test_conform_casts(spark):
    schema = StructType.fromDDL("k BIGINT NOT NULL, v DOUBLE")
    out = conform(spark.createDataFrame([(1, 2)], "k int, v int"), schema)
    assert out.schema == schema and tuple(out.first()) == (1, 2.0)


def test_failed_overwrite_keeps_the_table(spark, tmp_table):
    path = tmp_table("failing")
    save_table(spark.createDataFrame([(1,), (2,)], "x int"), path)
    bad = spark.createDataFrame([(0,)], "x int").select(
        F.when(F.col("x") == 0, F.raise_error(F.lit("boom"))).otherwise(F.col("x")).cast("int").alias("x")
    )
    with pytest.raises(Exception, match="boom"):
        save_table(bad, path)

    def refuse():
        raise ValueError("not these rows")

    with pytest.raises(ValueError, match="not these rows"):
        save_table(spark.createDataFrame([(9,)], "x int"), path, check=refuse)
    assert sorted(r.x for r in read_table(spark, path).collect()) == [1, 2]
    local = path.replace("file:", "")
    versions = lambda: [d for d in os.listdir(local) if d.startswith("v0")]
    assert len(versions()) == 1  # nothing is left of the failed writes
    reader = read_table(spark, path)
    save_table(spark.createDataFrame([(3,)], "x int"), path)
    assert [r.x for r in read_table(spark, path).collect()] == [3]
    assert sorted(r.x for r in reader.collect()) == [1, 2]  # the version before stays for its readers
    save_table(spark.createDataFrame([(4,)], "x int"), path)
    assert len(versions()) == 2


def test_plain_files_become_a_versioned_table(spark, tmp_table):
    path = tmp_table("plain")
    spark.createDataFrame([(1,)], "x int").write.parquet(path)
    assert [r.x for r in read_table(spark, path).collect()] == [1]
    save_table(read_table(spark, path).withColumn("x", F.col("x") + 1), path)
    assert [r.x for r in read_table(spark, path).collect()] == [2]
    save_table(read_table(spark, path).withColumn("x", F.col("x") + 1), path)
    left = [n for n in os.listdir(path.replace("file:", "")) if n[0] not in "._"]
    assert sorted(n[:7] for n in left) == ["v000001", "v000002"]  # the plain files are older than the one before


def test_readers_of_a_plain_folder_outlive_the_first_overwrite(spark, tmp_table):
    path = tmp_table("plain_reader")
    spark.createDataFrame([(1,)], "x int").write.parquet(path)
    reader = read_table(spark, path)
    save_table(spark.createDataFrame([(2,)], "x int"), path)
    assert [r.x for r in reader.collect()] == [1]


def test_stored_tables_are_open_to_other_readers(spark, tmp_table):
    """By name in the catalog, and by the current folder for plain Spark and for other engines."""
    import duckdb

    path = tmp_table("open")
    for rows in ([(1, "a")], [(2, "b"), (3, "c")], [(4, "d"), (5, "e")]):
        save_table(spark.createDataFrame(rows, "x int, s string"), path)
    assert sorted(tuple(r) for r in spark.table(table_name(path)).collect()) == [(4, "d"), (5, "e")]
    folder = current_path(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(folder).collect()) == [(4, "d"), (5, "e")]
    local = folder.replace("file:", "")
    assert duckdb.sql(f"SELECT x, s FROM read_parquet('{local}/*.parquet') ORDER BY x").fetchall() == [(4, "d"), (5, "e")]
    # a catalog that does not know the table (another program) finds the same version
    spark.sql(f"DROP TABLE {table_name(path)}")
    assert current_path(spark, path).rstrip("/").rsplit("/", 1)[-1] == local.rstrip("/").rsplit("/", 1)[-1]
    assert read_table(spark, path).count() == 2


def test_appended_rows_are_read_and_stray_files_are_no_silent_loss(spark, tmp_table):
    path = tmp_table("append")
    append_table(spark.createDataFrame([(1, "a")], "x int, s string"), path)
    append_table(spark.createDataFrame([("b", 2)], "s string, x int"), path)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(3, "c")], "x int, s string").write.mode("append").parquet(current_path(spark, path))
    assert read_table(spark, path).count() == 3
    with pytest.raises(SchemaMismatchError):
        append_table(spark.createDataFrame([(1,)], "x int"), path)
    time.sleep(1.1)
    spark.createDataFrame([(4, "d")], "x int, s string").write.mode("append").parquet(path)
    with pytest.raises(StrayFilesError):
        read_table(spark, path)


@pytest.mark.parametrize(
    "kind",
    "STRING BOOLEAN TINYINT SMALLINT INT BIGINT FLOAT DOUBLE DECIMAL(10,2) DECIMAL(38,18) DECIMAL(5,5) DATE TIMESTAMP "
    "TIMESTAMP_NTZ BINARY ARRAY<INT> MAP<STRING,DOUBLE> STRUCT<a:INT,b:ARRAY<DATE>>".split()
    + ["INTERVAL DAY TO SECOND", "INTERVAL YEAR TO MONTH"],
)
def test_conform_not_null_of_every_type(spark, kind):
    schema = StructType.fromDDL(f"k INT, v {kind} NOT NULL")
    value = {"STRUCT<a:INT,b:ARRAY<DATE>>": "named_struct('a', 1, 'b', array(DATE '2020-01-02'))", "ARRAY<INT>": "array(1)",
             "MAP<STRING,DOUBLE>": "map('a', 1.5D)", "DATE": "DATE '2020-01-02'", "BINARY": "X'01'", "BOOLEAN": "true",
             "TIMESTAMP": "TIMESTAMP '2020-01-02 03:04:05'", "TIMESTAMP_NTZ": "TIMESTAMP_NTZ '2020-01-02 03:04:05'",
             "INTERVAL DAY TO SECOND": "INTERVAL '1 02:03:04' DAY TO SECOND",
             "INTERVAL YEAR TO MONTH": "INTERVAL '1-2' YEAR TO MONTH"}.get(kind, "0.5" if "5,5" in kind else "7")
    good = spark.range(1).selectExpr("CAST(id AS INT) AS k", f"CAST({value} AS {kind}) AS v")
    out = conform(good, schema)
    assert out.schema["v"] == schema["v"] and out.count() == 1
    assert out.select(F.to_json(F.struct("v"))).first() == good.select(F.to_json(F.struct("v"))).first()
    with pytest.raises(Exception, match="NOT NULL"):
        conform(good.withColumn("v", F.lit(None).cast(kind)), schema).collect()


def test_clear_scratch_removes_the_tables_of_this_program(spark):
    path = scratch_path(spark, "short_lived")
    made, session._made[:] = list(session._made), [path]
    try:
        spark.range(3).write.parquet(path)
        assert path_exists(spark, path) and clear_scratch(spark) == 1
        assert not path_exists(spark, path) and session._made == []
    finally:
        session._made[:] = made

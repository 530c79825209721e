import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from enrichkit.llm import exact_dedup

TEXTS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "ü\n"), (None, "b"), (3, "a"), (7, "x" * 300_000), (8, "x" * 300_000)]


def save(spark, path, rows, kind="doc_id long, text string", parts=3):
    spark.createDataFrame(rows, kind).repartition(parts).write.parquet(path)
    return path


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted(
        (str(i), str(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""]), t or "") for i, t in rows
    )


@pytest.mark.parametrize("weak", [False, True])
def test_groups_and_colliding_digests(spark, tmp_table, weak):
    path = save(spark, tmp_table("docs"), TEXTS)
    # a digest that puts many different texts together must be caught by the byte check
    digest = (lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 0)) if weak else exact_dedup.sha256_digest
    got = exact_dedup.exact_groups(spark, path, digest=digest).collect()
    source = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    text_at = {(r["file"], r["at"]): r["text"] or "" for r in source.collect()}
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], text_at[r["file"], r["at"]]) for r in got) == expected(TEXTS)
    kept = [text_at[r["file"], r["at"]] for r in got if r["kept"]]
    assert sorted(kept) == sorted({t or "" for _, t in TEXTS})  # one row of each group, also with equal ids
    if not weak:
        assert all(r["digest"] == hashlib.sha256(text_at[r["file"], r["at"]].encode()).hexdigest() for r in got)


def test_empty_table_and_clashing_columns(spark, tmp_table):
    kind = "doc_id long, text string, digest string, who int, n int, `keep_id` string, `a.b` int"
    path = save(spark, tmp_table("none"), [], kind, 1)
    assert exact_dedup.exact_groups(spark, path).count() == 0
    path = save(spark, tmp_table("clash"), [(1, "t", "d", 1, 2, "k", 0), (2, "t", "e", 1, 2, "k", 0)], kind, 1)
    rows = exact_dedup.exact_groups(spark, path).collect()
    assert [(r["id"], r["keep_id"], r["kept"]) for r in sorted(rows, key=lambda r: r["id"])] == [(1, 2, False), (2, 2, True)]


def test_a_column_named_like_sparks_metadata(spark, tmp_table):
    path = save(spark, tmp_table("meta"), [(1, "t", "x"), (2, "t", "y")], "doc_id long, text string, _metadata string", 1)
    assert sorted((r["id"], r["keep_id"]) for r in exact_dedup.exact_groups(spark, path).collect()) == [(1, 2), (2, 2)]


@pytest.mark.parametrize("name", ["a,b", "end^", "a b", "é", "-"])
def test_paths_with_characters_of_patterns(spark, tmp_table, name):
    folder = Path(tmp_table("odd").removeprefix("file:"))
    made = Path(save(spark, tmp_table("even"), TEXTS, parts=2).removeprefix("file:"))
    folder.mkdir()
    made.rename(folder / name)
    got = exact_dedup.exact_groups(spark, f"{folder}/{name}").collect()
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in got) == sorted(x[:3] for x in expected(TEXTS))


@pytest.mark.parametrize("name", ["x{1}", "q?*", "[z]"])
def test_paths_that_look_like_patterns_are_refused(spark, name):
    with pytest.raises(ValueError, match="pattern"):
        exact_dedup.exact_groups(spark, f"/nowhere/{name}")


@pytest.mark.parametrize("bits", [1 << 29, 16])
def test_hits_beyond_the_bitmap_meet_in_a_join(spark, tmp_table, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", bits)
    path = save(spark, tmp_table("hits"), TEXTS)
    rows = exact_dedup._rows(spark.read.parquet(path), "doc_id", "text", exact_dedup.sha256_digest)
    hits = rows.groupBy("digest").count().filter("count > 1")
    assert exact_dedup._maybe_hits(rows, hits).count() >= 9
    assert exact_dedup.exact_groups(spark, path).count() == len(TEXTS)


def test_state_goes_on_over_new_files_and_batches(spark, tmp_table):
    path, checkpoint = tmp_table("grow"), tmp_table("state")
    save(spark, path, TEXTS[:5])
    exact_dedup.keyed_state(spark, path, checkpoint, max_files_per_batch=1)
    spark.createDataFrame(TEXTS[5:], "doc_id long, text string").write.mode("append").parquet(path)
    got = exact_dedup.exact_groups(spark, path, checkpoint=checkpoint, max_files_per_batch=1).collect()
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in got) == [x[:3] for x in sorted((a, b, c) for a, b, c, _ in expected(TEXTS))]


def test_new_files_with_old_times_enter_the_state(spark, tmp_table):
    path, checkpoint = tmp_table("late"), tmp_table("late-state")
    save(spark, path, TEXTS[:5])
    exact_dedup.keyed_state(spark, path, checkpoint)
    folder = Path(path.removeprefix("file:"))
    first = set(folder.glob("*.parquet"))
    spark.createDataFrame(TEXTS[5:], "doc_id long, text string").write.mode("append").parquet(path)
    for file in set(folder.glob("*.parquet")) - first:
        os.utime(file, (1e9, 1e9))  # 2001, as after a copy that keeps times
    got = exact_dedup.exact_groups(spark, path, checkpoint=checkpoint).collect()
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in got) == sorted(x[:3] for x in expected(TEXTS))


def test_state_that_misses_rows_is_refused(spark, tmp_table):
    path, checkpoint = tmp_table("gone"), tmp_table("gone-state")
    save(spark, path, TEXTS, parts=1)
    exact_dedup.keyed_state(spark, path, checkpoint)
    spark.createDataFrame(TEXTS[:3], "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="counts"):
        exact_dedup.exact_groups(spark, path, checkpoint=checkpoint)


def test_no_python_on_the_main_path(spark, tmp_table):
    path = save(spark, tmp_table("plan"), TEXTS)
    plan = exact_dedup.exact_groups(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

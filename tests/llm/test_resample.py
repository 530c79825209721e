"""Weights and draws against plain Python; the sort by regular sampling against a sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from enrichkit.llm import resample as op
from enrichkit.llm._common import written

from .edge import frame

SF = "/root/testdata/sf0.001"


def buckets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in features]


def brute(rows, target, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) by the contract, in one process."""
    made = [(i, *buckets(t)) for i, t in rows]
    s = Counter(b for _, _, f in made for b in f)
    t = Counter(b for x in target for b in buckets(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000.0) / ((s[b] + 1.0) * (big_t + 10000.0)))) for b in range(10000)]
    out = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = order[: percent * len(order) // 100]
    left = Counter(x for x in out) - Counter(drawn)
    return sorted([(x[0], *x[2:], k + 1) for k, x in enumerate(drawn)] + [(x[0], *x[2:], None) for x in left.elements()], key=repr)


def found(docs, target, **options):
    out = op.resample(docs, target, keep=["doc_id"], **options).select("row.doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_given_documents(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, target) == brute(rows, [r.text for r in target.collect()])


@pytest.mark.parametrize("least", [0, 2])
def test_awkward_rows(spark, monkeypatch, least):
    monkeypatch.setattr(op, "PIECE", 1000)
    df = frame(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    target = spark.createDataFrame([("one word here",), (None,), ("",), ("alpha beta",)], "text string")
    words = [r.text for r in target.collect()]
    # rows of one id may be drawn in any order: the drawn columns are the same
    assert found(df, target, percent=60, least_words=least) == brute(rows, words, 60, least)
    assert found(df, target.limit(0)) == brute(rows, [])
    assert found(df.limit(0), target) == []
    drawn = op.drawn(df, target, percent=50, least_words=0)
    assert drawn.columns == df.columns and drawn.count() == len(rows) // 2


@pytest.mark.parametrize("on_driver", [100_000, 50])
def test_ranks_are_those_of_a_sort(spark, monkeypatch, on_driver):
    """Also with most rows alike, and with samples that are ranked as a table."""
    monkeypatch.setattr(op, "ON_DRIVER", on_driver)
    df = spark.range(20_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.crc32(F.col("id").cast("string").cast("binary")) % 1000).alias("score"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 100).alias("id"),
        F.col("id").alias("place"),
    )
    df = written(df, "keys")
    if on_driver == 50:  # one level down the driver takes them
        monkeypatch.setattr(op, "ON_DRIVER", 300)
    got = op.ranks(df, 20_000, 16).collect()
    want = sorted(got, key=lambda r: op._key((r.score, r.id, r.place)))
    assert [r.rank for r in want] == list(range(1, 20_001))


def test_segments_are_even(spark):
    df = written(spark.range(30_000, numPartitions=6).select(F.lit(1).alias("score"), F.lit(1).alias("id"), F.col("id").alias("place")), "keys")
    cuts = op._splitters(df, 30_000, 20)
    edges = [0, *(c[3] for c in cuts), 30_000]
    assert max(b - a for a, b in zip(edges, edges[1:], strict=False)) <= 2 * 30_000 / 20

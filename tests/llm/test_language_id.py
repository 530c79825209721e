import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from enrichkit.llm import language_id as li

from .edge import ROWS, frame

SF = "/root/testdata/sf0.01"


def brute_bits(counts, kept, lang, data):
    bits = 0.0
    for i in range(len(data)):
        for order in range(min(li.ORDER, i), -1, -1):
            key = (order, data[i - order : i])
            seen = counts[lang].get(key) if key in kept else None
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_exact_code_lengths(spark, monkeypatch):
    train = [("en", "the cat sat on the mat and the hat"), ("de", "die Katze saß auf der Matte und dem Hut"), ("en", ""), ("de", "äöü")]
    sample = spark.createDataFrame(train, "lang string, text string").repartition(2)
    model = li.train(sample)
    counts = {}
    for lang, text in train:
        data = text.encode()
        for i in range(len(data)):
            for order in range(min(li.ORDER, i) + 1):
                key = (order, data[i - order : i])
                row = counts.setdefault(lang, {}).setdefault(key, {})
                row[data[i]] = row.get(data[i], 0) + 1
    kept = {key for tree in counts.values() for key in tree}
    texts = ["the mat", "Matte und Hut", "xyz", "ß", "cat" * 200, "\x00\xff"]
    want = np.array([[brute_bits(counts, kept, lang, t.encode()) for lang in model["langs"]] for t in texts])
    for block in (li.BLOCK, 10):  # long texts go on over blocks
        monkeypatch.setattr(li, "BLOCK", block)
        assert np.allclose(li.score_texts([t.encode() for t in texts], model), want, rtol=1e-5)


def test_learning_keeps_every_context(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "".join(map(chr, rng.integers(0x4E00, 0x9FA6, 1500))), "zh") for i in range(20)]
    rows += [(100 + i, "the cat sat on the mat " * (i % 2) + "once", "en") for i in range(9)]
    model = li.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 5 == 0:
            continue
        data = text.encode()
        for k in range(len(data)):
            for order in range(min(li.ORDER, k) + 1):
                row = counts.setdefault(lang, {}).setdefault((order, data[k - order : k]), {})
                row[data[k]] = row.get(data[k], 0) + 1
    kept = {key for tree in counts.values() for key in tree}
    assert sum(len(codes) for codes, _ in model["orders"]) == len([key for key in kept if key[0]]) > 30_000
    texts = [rows[1][1][:50], "漢字かな the mat", "once upon the cat", "\xff"]
    want = np.array([[brute_bits(counts, kept, lang, t.encode()) for lang in model["langs"]] for t in texts])
    assert np.allclose(li.score_texts([t.encode() for t in texts], model), want, rtol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = li.predict(docs, li.learn(docs), keep=["doc_id", "lang"]).filter(li.held_out(F.col("row.doc_id"))).collect()
    assert len(rows) > 100 and all(zlib.crc32(str(r["row"]["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["row"]["lang"] == r["out"]["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_edge_cases(spark):
    got = li.predict(frame(spark), li.learn(frame(spark))).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = r["row"]["text"]
        lettered = bool(text) and any(c.isalpha() for c in text)
        assert (r["out"]["lang_pred"] == "und") == (not lettered)
        assert 0 <= r["out"]["score"] <= 1
    empty = frame(spark, [])
    assert li.predict(empty, li.learn(empty)).count() == 0
    assert {r["out"]["lang_pred"] for r in li.predict(frame(spark), li.learn(empty)).collect()} == {"und"}


def test_sample_is_bounded_per_language_and_repeatable(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"))
    picks = [li.bounded_sample(df.repartition(n), F.col("lang"), F.col("id"), 500) for n in (2, 7)]
    sizes = dict(picks[0].groupBy("lang").count().collect())
    assert all(400 < n < 600 for n in sizes.values())
    assert picks[0].select("id").exceptAll(picks[1].select("id")).isEmpty()

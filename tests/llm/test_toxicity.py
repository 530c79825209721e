import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from enrichkit.llm import toxicity as tx
from enrichkit.llm.language_id import held_out

from .edge import ROWS, frame

SF = "/root/testdata/sf0.01"


def test_shouting_counts_every_text():
    voters = tx.Voters([])
    at = tx.PATTERNS.index("shouting")
    loud = ["THIS IS MOSTLY CAPITALS but not whole", "ÄÖÜ ÉÈ ÑÇ ÄÖÜ ÉÈ ÑÇ STRASSE LAUT aber", "ALL OF THIS IS LOUD AND LONG"]
    calm = ["This Is Not Loud At All But Has Capitals", "SHORT and low", "", "漢字" * 30 + "ABC", "X" * 12 + "y" * 12 + "!!!"]
    for text in loud + calm:
        letters, capitals = sum(map(str.isalpha, text)), sum(map(str.isupper, text))
        assert tx.features(text, voters)[at] == (letters > 20 and capitals > 0.6 * letters) == (text in loud)
        assert tx.cases(text) == (letters, capitals)


def brute_mining(rows, max_voters, min_support):
    """Voters of (text, toxic) rows: near copies counted once, odds and strength by the counts."""
    words = lambda t: tx.WORD.findall(t.lower())
    shingles = lambda t: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)} or {tuple(words(t))}
    groups = {}
    for text, toxic in rows:
        groups.setdefault((toxic, tx.shingle_hashes(text)[0]), []).append(text)
    kept = {True: [], False: []}
    for (toxic, _), texts in groups.items():
        taken = []
        for t in sorted(texts, key=lambda t: (tx.shingle_hashes(t), tx.voter_units(t))):
            if all(len(shingles(t) & shingles(x)) < 0.8 * len(shingles(t) | shingles(x)) for x in taken):
                taken.append(t)
        kept[toxic] += taken
    n = {k: Counter(u for t in v for u in {*words(t), *(w[:k] + "*" for w in words(t) for k in tx.STEMS if len(w) >= k)}) for k, v in kept.items()}
    found = []
    for unit, k in n[True].items():
        odds = math.log((k + 0.5) / (len(kept[True]) + 1) / ((n[False][unit] + 0.5) / (len(kept[False]) + 1)))
        if k >= min_support and odds >= math.log(8) and k * odds >= 10:
            found.append((-round(k * odds, 9), unit))
    return [u for _, u in sorted(found)][:max_voters], sum(map(len, kept.values()))


def test_mining_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = docs.join(labels, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).alias("toxic"))
    rows = [(r.text, r.toxic) for r in sample.collect()]
    for max_voters, support in ((300, 5), (10, 4)):
        want, n = brute_mining(rows, max_voters, support)
        assert n < len(rows)  # the table holds near copies
        got = tx.mined_voters(sample, max_voters=max_voters, min_support=support)
        assert len(want) > 3 and sorted(got) == sorted(want)


def test_only_verified_near_copies_collapse():
    a = set(range(100))
    assert tx.apart([a, a | {200}, set(range(50)), set(range(79)), set(range(81))]) == [0, 2, 3]


def test_scores_are_the_classifier_on_the_features(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.learn(docs, labels)
    voters = tx.Voters(model["voters"])
    for r in tx.score(docs, model).collect():
        z = float(np.dot(tx.features(r["row"]["text"] or "", voters), model["weights"]))
        assert abs(r["out"]["score"] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.2
    good = rng.random(6000) < np.where(y, 0.8, 0.02)
    copy = good ^ (rng.random(6000) < 0.01)
    weak = rng.random(6000) < np.where(y, 0.5, 0.1)
    noise = rng.random(6000) < 0.3
    gold = y ^ (rng.random(6000) < 0.03)
    post, fit = tx.label_model(np.stack([good, copy, weak, noise], axis=1).astype(float), gold.astype(float))
    assert fit["rate1"][0] > 0.75 and fit["rate0"][0] < 0.05
    assert 0.4 < fit["rate1"][2] < 0.6 and abs(fit["rate1"][3] - fit["rate0"][3]) < 0.05
    assert fit["correlation"][0, 1] > 0.7 and abs(fit["correlation"][0, 3]) < 0.1
    assert ((post > 0.5) == y).mean() > 0.95


def test_linear_classifier_separates():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(2000, 3)), np.ones((2000, 1))], axis=1)
    target = (x[:, 0] > 0.3).astype(float)
    w = tx.fit_linear(x, target)
    assert (((x @ w) > 0) == (target > 0)).mean() > 0.97


def test_toxic_words_are_caught_and_clean_rows_left_alone(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.learn(docs, labels)
    insults = ("idiot", "loser", "pathetic", "scum", "worthless", "moron", "trash", "clown", "disgusting", "stupid")
    rude = F.lower("row.text").rlike(r"\b(" + "|".join(insults) + r")\b")
    rows = tx.score(docs, model).select("row.doc_id", rude.alias("rude"), "out.score").join(labels, "doc_id").collect()
    rude_rows = [r for r in rows if r["rude"]]
    assert sum(r["score"] >= 0.5 for r in rude_rows) >= 0.97 * len(rude_rows)
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["score"] >= 0.5 for r in clean) <= 0.01 * len(clean)
    assert docs.filter(held_out(F.col("doc_id"))).count() > 100


def test_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    df = frame(spark)
    for lab in (none, labels):
        model = tx.learn(df, lab.withColumn("g", F.lit(0)))
        got = tx.score(df, model).collect()
        assert len(got) == len(ROWS) and all(0 <= r["out"]["score"] <= 1 for r in got)
        empties = {r["out"]["score"] for r in got if not r["row"]["text"]}
        assert len(empties) == 1
        assert tx.drop_toxic(df, model).columns == df.columns
    assert tx.score(frame(spark, []), tx.learn(frame(spark, []), none)).count() == 0
    alone = tx.learn(df, none)
    toxic = spark.createDataFrame([(1, "you idiot, you moron"), (2, "good day")], "doc_id long, text string")
    assert [r["out"]["score"] >= 0.5 for r in tx.score(toxic, alone).orderBy("row.doc_id").collect()] == [True, False]

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from enrichkit.llm import simhash
from enrichkit.llm.components import components

from .edge import frame, tuples


def fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, budget):
    """Index of the smallest reachable fingerprint's position for each one."""
    x = np.array(fps, np.uint64)
    link = np.bitwise_count(x[:, None] ^ x[None, :]) <= budget
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in link])
        if (new == label).all():
            return label
        label = new


def test_edge_cases(spark):
    df = frame(spark)
    found = simhash.clusters(df).select(F.col("row.doc_id").alias("i"), F.col("row.text").alias("t"), "fp", "component_id").collect()
    fps = [r["fp"] % (1 << 64) for r in found]
    assert fps == [fingerprint(r["t"]) for r in found]
    label = brute_components(fps, 3)
    for r, own in zip(found, label, strict=True):
        ids = [x["i"] for x, y in zip(found, label, strict=True) if y == own and x["i"] is not None]
        assert r["component_id"] == min(ids, default=None)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and kept.count() == len(set(label))


def test_empty_table(spark):
    assert simhash.clusters(frame(spark, [])).count() == 0
    assert simhash.one_of_each(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("leaf_rows", "budget"), [(2, 3), (16, 2), (100_000, 3)])
def test_trie_join_against_all_pairs(spark, leaf_rows, budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 1 << 64, 25, dtype=np.uint64)
    near = np.repeat(base, 6) ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (150, 3), dtype=np.uint64), axis=1)
    dense = base[0] ^ rng.integers(0, 64, 40, dtype=np.uint64)  # a hot prefix
    fps = np.unique(np.concatenate([base, near, dense]))
    rows = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64).tolist())], "id long, fp long")
    got = {r["id"]: r["component_id"] for r in simhash._with_components(rows, budget, leaf_rows).collect()}
    assert [got[i] for i in range(len(fps))] == brute_components(fps, budget).tolist()


def test_local_walk_merges_a_dense_group():
    fps = np.unique(np.arange(3000, dtype=np.uint64))
    nodes, roots = simhash.local_edges(fps, None, simhash._budgets(3))
    assert len(nodes) == 2999 and set(roots.tolist()) == {0}  # one edge each, not all pairs


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, x) for x in range(501, 700)]
    got = dict(tuples(components(spark.createDataFrame(path + star + [(7, 7)], "u long, v long")), "node", "component"))
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(500, 700), 500), 7: 7}

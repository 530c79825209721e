from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from enrichkit.llm import packing

from .edge import frame, tuples


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= x) - x for x in lengths)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=25), st.integers(1, 4))
def test_boundaries_are_optimal(lengths, k):
    x, n = np.unique(lengths, return_counts=True)
    bounds = packing.best_boundaries(x, n, k)
    best = min(padding(lengths, (*c, max(x))) for c in combinations(x.tolist(), min(k, len(x)) - 1))
    assert len(bounds) <= k and padding(lengths, bounds) == best


def check(rows, got, max_tokens):
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=repr) == sorted(((i, n or 0) for i, n in rows), key=repr)
    seen = {}
    for r in got:
        if r["bucket"] >= 0:
            assert r["n_tokens"] <= r["padded_to"] == r["bucket"]
        else:
            assert r["n_tokens"] + 7 >= max_tokens and r["slot"] == 0
        seen.setdefault((r["bucket"], r["batch"]), []).append(r["slot"])
    for bucket in {b for b, _ in seen}:
        batches = sorted(k for b, k in seen if b == bucket)
        assert batches == list(range(len(batches)))
        room = max_tokens // bucket if bucket > 0 else max_tokens if bucket == 0 else 1
        sizes = [len(seen[bucket, k]) for k in batches]
        assert all(sorted(seen[bucket, k]) == list(range(len(seen[bucket, k]))) for k in batches)
        assert all(s == room for s in sizes[:-1]) and 1 <= sizes[-1] <= room


@pytest.mark.parametrize("hot", [False, True])
def test_batches(spark, hot):
    rng = np.random.default_rng(3)
    rows = [(int(i), 100 if hot else int(n)) for i, n in enumerate(rng.integers(0, 900, 700))]
    rows += [(None, 5), (None, None), (3, 4), (3, 4), (4, 100_000), (5, 513)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    check(rows, packing.pack(df, max_tokens=512).collect(), 512)


def test_boundaries_sit_on_real_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, 1001 if i % 3 == 0 else int(n)) for i, n in enumerate(rng.integers(0, 3000, 600))]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), max_tokens=4096).collect()
    check(rows, got, 4096)
    x, n = np.unique([n for _, n in rows], return_counts=True)
    bounds = packing.best_boundaries(x, n, 16)
    assert sum(r["padded_to"] - r["n_tokens"] for r in got) == padding([n for _, n in rows], bounds)
    assert {r["padded_to"] for r in got if r["n_tokens"] == 1001} == {1001}


def test_divided_search_is_as_good_as_the_whole_one():
    rng = np.random.default_rng(6)
    x = np.sort(rng.choice(4000, 500, replace=False)).astype(float)
    n = rng.integers(1, 1000, 500).astype(float)
    docs, tokens = np.r_[0, n.cumsum()], np.r_[0, (n * x).cumsum()]
    cost = np.r_[0, np.full(500, np.inf)]
    for _ in range(16):  # every start of every bucket
        cost = np.r_[0, [min(cost[:j] + x[j - 1] * (docs[j] - docs[:j]) - (tokens[j] - tokens[:j])) for j in range(1, 501)]]
    bounds = packing.best_boundaries(x, n, 16)
    assert sum(k * (min(b for b in bounds if b >= v) - v) for v, k in zip(x, n, strict=True)) == cost[-1]


def test_empty_table_and_empty_texts(spark):
    none = spark.createDataFrame([], "doc_id long, n_tokens long, bucket string, place int")
    assert packing.pack(none).count() == 0
    rows = [(i, 0) for i in range(20)]
    check(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), max_tokens=8).collect(), 8)


def test_token_lengths_are_the_librarys(spark):
    import public_tokenizers as tokenizers
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    df = frame(spark)
    got = tuples(packing.token_lengths(df, path, tokenizers.PATTERN), "doc_id", "n_tokens")
    lib = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    assert got == sorted(((r["doc_id"], len(lib.encode(r["text"] or "").ids)) for r in df.collect()), key=repr)
    assert packing.token_lengths(frame(spark, []), path, tokenizers.PATTERN).count() == 0

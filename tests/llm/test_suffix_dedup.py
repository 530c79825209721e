"""Repeated byte strings against a brute force over all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from enrichkit.llm import suffix_dedup as op

from .edge import frame

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(id, text) -> id, bytes, removed, spans, hash of the rest, by a table of all windows."""
    first = {}
    texts = [(op.LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for x in range(len(t) - op.WINDOW + 1):
            w = t[x : x + op.WINDOW]
            first[w] = min(first.get(w, (i, x)), (i, x))
    out = []
    for (i, t), (raw, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(t))
        for x in range(len(t) - op.WINDOW + 1):
            if first[t[x : x + op.WINDOW]] < (i, x):
                gone[x : x + op.WINDOW] = b"\1" * op.WINDOW
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((raw, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    out = op.without_repeated_strings(df, keep=["doc_id"])
    out = out.select("row.doc_id", "out.n_bytes", "out.n_removed", "out.n_spans", F.sha2("out.kept", 256))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_awkward_rows(spark):
    df = frame(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []
    whole = op.without_repeated_strings(df)
    assert set(whole.select("row.*").columns) == set(df.columns)


def passages(seed, n=60):
    """Texts that share passages of many lengths, some edited, with runs of one character."""
    r = random.Random(seed)
    letters = "abcdefgh é漢 \n"
    make = lambda k: "".join(r.choice(letters) for _ in range(k))
    shared = [make(r.randint(80, 400)) for _ in range(6)] + ["ab" * 120, " " * 300]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(r.randint(0, 5)):
            part = r.choice(shared)
            a = r.randint(0, 40)
            part = part[a : len(part) - r.randint(0, 40)]
            if r.random() < 0.3:
                k = r.randrange(len(part))
                part = part[:k] + "#" + part[k + 1 :]
            text += make(r.randint(0, 150)) + part
        rows.append((i % (n - 5), text))  # a few ids twice
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    rows = passages(seed)
    assert found(table(spark, rows)) == brute(rows)


def test_crowded_roots_go_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(op, "MANY", 2)
    monkeypatch.setattr(op, "HOT", 3)
    rows = passages(3)
    assert found(table(spark, rows)) == brute(rows)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 256)
    monkeypatch.setattr(op, "AT_ONCE", 50)
    rows = passages(4, 40)
    assert found(table(spark, rows)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_the_spans_are_what_is_missing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in op.without_repeated_strings(docs, keep=["text"]).collect():
        text, rest, at = (r.row.text or "").encode(), b"", 0
        for s in r.out.spans:
            assert s.start > at or at == 0
            rest, at = rest + text[at : s.start], s.start + s.size
        assert rest + text[at:] == r.out.kept

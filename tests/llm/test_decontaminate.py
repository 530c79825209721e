import re

import pytest
from pyspark.sql import functions as F

from enrichkit.llm import decontaminate

from .edge import LONG, ROWS, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
ITEMS = [
    (10, "This line of MORE than forty characters"),  # shorter than a window
    (9, " ".join(f"Word{i}" for i in range(100, 120))),
    (9, "other words here"),
    (2, "one"),
    (None, "alpha beta"),
    (3, None),
    (4, "!?"),
    (5, "straße 漢字 ünïcödé"),
    (6, "ünïcödé straße"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(text, items, n):
    w = words(text)
    hit, ids = set(), set()
    for item, item_text in items:
        for win in windows(item_text, n):
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    ids.add(item)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None), bool(hit) and 20 * len(hit) >= len(w)


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("w", F.lit(1)).withColumn("item", F.lit(2))


@pytest.mark.parametrize("block_bytes", [32 << 20, 200])
def test_edge_cases_with_one_and_many_automata(spark, block_bytes):
    df = frame(spark)
    got = decontaminate.contamination(df, items(spark), max_block_bytes=block_bytes, window=13).collect()
    for r in got:
        text, o = r["row"]["text"], r["out"]
        assert (o["n_words"], o["n_hit"], o["item_ids"], o["contaminated"]) == brute(text, ITEMS, 13)
        passages = [(text or "")[a:b] for a, b in zip(o["hit_starts"], o["hit_ends"], strict=True)]
        assert sum(len(words(p)) for p in passages) == o["n_hit"]
        assert all(p.strip() == p and words(p) for p in passages)
    assert len(got) == len(ROWS)


def test_drop_keeps_clean_rows_and_all_columns(spark):
    df = frame(spark)
    kept = decontaminate.drop_contaminated(df, items(spark))
    clean = [r for r in ROWS if not brute(r[1], ITEMS, 13)[3]]
    assert kept.columns == df.columns and kept.count() == len(clean)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert decontaminate.contamination(none, items(spark)).count() == 0
    rows = decontaminate.contamination(frame(spark), items(spark, [])).collect()
    assert len(rows) == len(ROWS) and not any(r["out"]["n_hit"] for r in rows)


def test_overlapping_windows_and_a_long_text():
    data = ("a b " * 30 + LONG).encode()
    blocks = [{"patterns": {w: ["1"] for w in decontaminate.item_windows(b"a b a b a", 3)}}]
    runs, items = decontaminate._runs(data, decontaminate.automaton_of(blocks[0]))
    n, hit, ids, starts, ends, _ = decontaminate._judged(data, runs, items)
    assert (n, hit, ids, starts, ends) == (60 + 40_000, 60, ["1"], [0], [119])


def test_blocks_come_one_at_a_time(spark):
    """A benchmark of several blocks: each within its size, no two held at once."""
    blocks = decontaminate.benchmark_blocks(items(spark), max_block_bytes=300)
    sizes = [sum(len(w) + 40 for w in b["patterns"]) for b in blocks]
    assert len(sizes) > 2 and max(sizes) < 900

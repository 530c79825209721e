from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from enrichkit.llm import line_dedup

from .edge import LINE, frame, tuples

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(list)
    for i, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    top = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in top or top[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), text if len(left) == len(lines) else "\n".join(left)))
    return sorted(out, key=repr)


def run(df, **options):
    found = line_dedup.without_repeats(df, **options)
    return tuples(found.select(found["row"]["doc_id"].alias("i"), "n_lines", "n_dropped", "text"), "i", "n_lines", "n_dropped", "text")


def test_edge_cases(spark):
    df = frame(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert run(df) == brute(rows)
    assert line_dedup.without_repeats(df).select("row.*").columns == df.columns


def test_empty_table(spark):
    assert run(frame(spark, [])) == []


def test_null_ids_alone_keep_their_lines(spark):
    assert all(n == 0 for _, _, n, _ in run(frame(spark, [(None, LINE, "en")] * 6)))


def test_filters_follow_the_number_of_lines(spark):
    rows = [(i, "\n".join(f"line {i} {j} with some forty characters and a few more" for j in range(20)) + "\nshort", "en") for i in range(40)]
    df = frame(spark, rows, clash=False)
    assert line_dedup.count_long_lines(df) == 800
    assert line_dedup.filter_bits(800) == line_dedup.BLOCK_BITS == line_dedup.filter_bits(0)
    assert line_dedup.filter_bits(80_000_000) == 1 << 30 and line_dedup.filter_bits(200_000_000) > line_dedup.MAX_BITS


@pytest.mark.parametrize("largest", [1 << 30, 1])
def test_all_ways_to_suspect_give_the_same(spark, monkeypatch, largest):
    """The filter, and beyond its largest size the grouped hashes."""
    monkeypatch.setattr(line_dedup, "MAX_BITS", largest)
    df = frame(spark)
    assert run(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert run(frame(spark, [])) == []
    rows = [(i, "\n".join(f"line {(i * j) % 50} with some forty characters and a few more" for j in range(20)), "en") for i in range(40)]
    assert run(frame(spark, rows, clash=False)) == brute(rows)


def test_full_filter_only_suspects_more(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "filter_bits", lambda n: 1 << 16)
    monkeypatch.setattr(line_dedup, "FLUSH_KEYS", 2)
    rows = [(i, "\n".join(f"line {(i * j) % 50} with some forty characters and a few more" for j in range(20)), "en") for i in range(40)]
    assert run(frame(spark, rows, clash=False)) == brute(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6) | st.none(), st.lists(st.sampled_from(["ab", " AB\t", "abé", "x", "", "\x0bab"]), max_size=5)), max_size=15))
def test_against_brute_force(spark, rows):
    rows = [(i, "\n".join(x), "en") for i, x in rows]
    assert run(frame(spark, rows, clash=False), min_chars=2, min_docs=2) == brute(rows, 2, 2)

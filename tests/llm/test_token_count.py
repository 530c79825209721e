import tracemalloc

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from enrichkit.llm import token_count

from .edge import ROWS, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
TABLES = token_count.ready(token_count.load_tokenizer(PATH))


def lib(texts):
    return [len(e.ids) for e in LIB.encode_batch(texts, add_special_tokens=False)]


def test_edge_cases(spark):
    got = token_count.token_counts(frame(spark), PATH).collect()
    texts = [r["row"]["text"] or "" for r in got]
    assert [r["out"]["n_tokens"] for r in got] == lib(texts)
    assert [r["out"]["n_bytes"] for r in got] == [len(t.encode()) for t in texts]
    assert len(got) == len(ROWS)
    assert token_count.token_counts(frame(spark, []), PATH).count() == 0


PIECES = st.sampled_from(["the", "ing", "'s", "'re", "'", " ", "  ", "\n", "\t", "é", "漢", "1", "99", "!", "<|endoftext|>", "A", "́", "Ᲊ", "\x85", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=30).map("".join))
def test_against_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert token_count.count_batch([text, "", text + " x"], TABLES) == lib([text, "", text + " x"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=40).map("".join), st.sampled_from([1, 2, 3, 7]))
def test_cuts_anywhere(text, window):
    text = text.encode("utf-8", "ignore").decode()
    before = token_count.WINDOW, token_count.CHUNK
    token_count.WINDOW, token_count.CHUNK = window, 3
    try:
        assert token_count.count_batch([text, "", text + "'re"], TABLES) == lib([text, "", text + "'re"])
    finally:
        token_count.WINDOW, token_count.CHUNK = before


@pytest.mark.parametrize("make", [
    lambda n: "word and more " * (n // 14) + "<|endoftext|>",
    lambda n: "<|endoftext|>".join(["no,more" * 10_000] * (n // 70_000)),
    lambda n: "漢字" * (n // 2),
], ids=["special at the end", "specials between", "no space"])
def test_memory_of_a_long_text_is_the_windows(make):
    """The peak beside the text does not grow with it."""
    peaks = []
    for n in (1 << 18, 1 << 20):
        text = make(n)
        token_count.WINDOW, before = 1 << 16, token_count.WINDOW
        tracemalloc.start()
        try:
            got = token_count.count_batch([text], TABLES)
            peaks.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
            token_count.WINDOW = before
        if n == 1 << 18:
            assert got == lib([text])
    assert peaks[1] < peaks[0] * 1.3 + (1 << 19), peaks


@pytest.mark.parametrize("limit", [1, 50])
def test_small_caches_chunks_and_windows(monkeypatch, limit):
    monkeypatch.setattr(token_count, "MAX_STATES", limit)
    monkeypatch.setattr(token_count, "MAX_WORDS", limit)
    monkeypatch.setattr(token_count, "CHUNK", 7)
    monkeypatch.setattr(token_count, "WINDOW", 40)
    texts = ["They're   here, aren't they?  " * 20, "x" * 300, "a'll 's\n\n 's " * 30, "", "ab" * 200 + " c" * 50]
    assert token_count.count_batch(texts, TABLES) == lib(texts)


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = token_count.token_counts(rows, PATH, keep=["text"]).collect()
    assert [r["out"]["n_tokens"] for r in got] == lib([r["row"]["text"] for r in got])

"""Operator 1, benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised to lower-case words (A-Z lowered; a word is a run of
digits, a-z and non-ASCII characters). Every window of ``window`` consecutive
words of a benchmark item (the whole item when it is shorter) becomes one
pattern of the automaton. A document is normalised and scanned once; a match
end gives the word range, and the word ranges are mapped back to character
offsets of the original text.

Scale: the documents are never shuffled, the scan is one map pass. The
patterns are the only broadcast data. Their bytes are summed first; beyond
``max_block_bytes`` (an automaton takes about 32 times its patterns in a worker)
they are dealt into blocks of that size. The documents are then written once
with a row number, and one pass after the other scans them with one block; a
pass returns the word ranges of the rows that it hits, which are joined by row
number. No worker, broadcast or driver ever holds two blocks.

Defined cases: a null or empty text has no words, is never hit and never
contaminated; a null item text has no windows; windows of a null item id
count as hits but the id is not listed. Rows are judged one by one, so
repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_pass, col, struct_pass, utf8, written

#: Bytes 0-9, a-z and 0x80-0xFF stay, A-Z become a-z, all others a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
RESULT = (
    "n_words long, n_hit long, item_ids array<string>, "
    "hit_starts array<long>, hit_ends array<long>, contaminated boolean"
)


def item_windows(data: bytes, window: int) -> set[bytes]:
    """The windows of one benchmark item: normalised words between single spaces."""
    words = data.translate(WORD_BYTES).split()
    if not words:
        return set()
    n = max(1, len(words) - window + 1)
    return {b" " + b" ".join(words[i : i + window]) + b" " for i in range(n)}


def automaton_of(block: dict):
    """The automaton of a broadcast block; each Python worker builds it once."""
    if "built" not in block:
        import ahocorasick

        built = ahocorasick.Automaton()
        for pattern, items in block["patterns"].items():
            built.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, items))
        built.make_automaton()
        block["built"] = built
    return block["built"]


def _runs(data: bytes, automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """The word ranges that windows of one automaton cover, and their items."""
    if not len(automaton):
        return [], set()
    words = data.translate(WORD_BYTES).split()
    line = f" {b' '.join(words).decode('latin-1')} "  # one character a byte: only positions count
    items: set[str] = set()
    covered = None
    done = at = 0
    for end, (length, ids) in automaton.iter(line):
        at += line.count(" ", done, end + 1)
        done = end + 1
        if covered is None:
            covered = bytearray(len(words))
        covered[at - 1 - length : at - 1] = b"\1" * length
        items.update(ids)
    return ([m.span() for m in re.finditer(b"\1+", bytes(covered))] if covered else []), items


def _judged(data: bytes, runs: list[tuple[int, int]], items: set[str]) -> tuple:
    flat = data.translate(WORD_BYTES)
    n = len(flat.split())
    if not runs:
        return n, 0, [], [], [], False
    covered = bytearray(n)
    for a, b in runs:
        covered[a:b] = b"\1" * (b - a)
    n_hit = covered.count(1)
    runs = [m.span() for m in re.finditer(b"\1+", bytes(covered))]
    spans = [m.span() for m in re.finditer(rb"[^ ]+", flat)]
    starts, ends = _char_offsets(data, [spans[a][0] for a, _ in runs]), _char_offsets(data, [spans[b - 1][1] for _, b in runs])
    return n, n_hit, sorted(items), starts, ends, 20 * n_hit >= n


def _char_offsets(data: bytes, at: list[int]) -> list[int]:
    """Character offsets of ascending byte offsets (one pass over the text)."""
    if data.isascii():
        return at
    out, done, chars = [], 0, 0
    for x in at:
        chars += len(data[done:x].decode("utf-8", "replace"))
        done = x
        out.append(chars)
    return out


def benchmark_blocks(
    benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text", window: int = 13, max_block_bytes: int = 8 << 20
) -> Iterator[dict]:
    """The distinct windows of all items, one block of at most about ``max_block_bytes`` at a time."""

    def make():
        def windows(texts: pa.Array) -> list:
            return [[[w.decode("latin-1") for w in sorted(item_windows(t, window))] for t in utf8(texts)]]

        return windows

    rows = written(
        arrow_pass(benchmark, [item_col], text_col, make, "w array<string>")
        .select(F.col(f"row.`{item_col}`").cast("string").alias("item"), F.explode("out.w").alias("w"))
        .distinct(),
        "benchmark-windows",
    )
    total = rows.agg(F.sum(F.length("w") + 40)).first()[0] or 0
    n_blocks = 1 + int(total) // max_block_bytes
    for b in range(n_blocks):
        part = rows if n_blocks == 1 else rows.filter(F.pmod(F.xxhash64("w"), F.lit(n_blocks)) == b)
        patterns: dict[bytes, list[str]] = {}
        for item, w in part.toLocalIterator():  # one block, of a checked size
            ids = patterns.setdefault(w.encode("latin-1"), [])
            if item is not None:
                ids.append(item)
        if patterns:
            yield {"patterns": patterns}


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    keep: list[str] | None = None,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    max_block_bytes: int = 8 << 20,
) -> DataFrame:
    """``row`` (struct of the columns ``keep``, default all) and ``out`` per document.

    ``out`` holds n_words, n_hit (words inside any occurrence of a window),
    item_ids (items with occurring windows, sorted as strings), the hit
    passages as character offsets of the original text, and ``contaminated``
    (n_hit > 0 and 20 * n_hit >= n_words).
    """
    sc = docs.sparkSession.sparkContext
    blocks = benchmark_blocks(
        benchmark, item_col=item_col, text_col=item_text_col, window=window, max_block_bytes=max_block_bytes
    )
    first, second = next(blocks, {"patterns": {}}), next(blocks, None)
    keep = list(keep or docs.columns)
    if second is None:
        held = sc.broadcast(first)

        def make():
            automaton = automaton_of(held.value)
            return lambda texts: list(zip(*(_judged(t, *_runs(t, automaton)) for t in utf8(texts)), strict=True))

        return arrow_pass(docs, keep, text_col, make, RESULT)
    row = F.struct(*[col(c) for c in keep]).alias("row")
    base = written(docs.select(row, col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("at")), "documents")
    found = [_hits_of(base, block) for block in chain((first, second), blocks)]
    hits = reduce(DataFrame.unionByName, found).groupBy("of").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    joined = base.join(hits, F.col("at") == F.col("of"), "left")

    def judge():
        def fn(texts: pa.Array) -> list:
            rows = zip(utf8(texts.field("text")), texts.field("runs").to_pylist(), texts.field("items").to_pylist(), strict=True)
            return list(zip(*(_judged(t, [(r["a"], r["b"]) for r in runs or ()], items or ()) for t, runs, items in rows), strict=True))

        return fn

    return struct_pass(joined.select("row", F.struct("text", "runs", "items").alias("given")), judge, RESULT)


def _hits_of(base: DataFrame, block: dict) -> DataFrame:
    """(of, runs, items) of the rows that one block hits; the block is gone when it returns."""
    held = base.sparkSession.sparkContext.broadcast(block)

    def make():
        automaton = automaton_of(held.value)

        def scan(texts: pa.Array) -> list:
            made = [_runs(t, automaton) for t in utf8(texts)]
            return [[[{"a": a, "b": b} for a, b in runs] for runs, _ in made], [sorted(items) for _, items in made]]

        return scan

    found = arrow_pass(base, ["at"], "text", make, "runs array<struct<a:int,b:int>>, items array<string>")
    hit = found.filter(F.size("out.runs") > 0).select(F.col("row.at").alias("of"), "out.runs", "out.items")
    kept = written(hit, "hits")
    held.destroy()
    return kept


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = contamination(docs, benchmark, **options)
    return found.filter(~F.col("out.contaminated")).select("row.*")

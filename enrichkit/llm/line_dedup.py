"""Operator 4, line dedup with two Bloom filters.

A line's key is the line without ASCII white space at both ends, A-Z lowered.
Keys of at least ``min_chars`` code points that occur in at least
``min_docs`` documents lose all their lines except in the largest id holding
the key.

0. The long lines are counted; the filters get ``BITS_PER_KEY`` bits for each, so
   about 2 % of the lines seen once are suspected at any size of the input.
1. Every map task notes which hashed keys its documents hold once and which
   twice. It emits the set bits of both filters, block by block, as sorted
   positions, so the traffic follows the number of lines and not the number
   of tasks times the filter size. Merging adds to the twice-seen filter each
   bit that two tasks have in the once-seen filter: no key of two documents
   is missed.
2. The merged twice-seen filter is broadcast. Documents without a suspected line
   pass in the scan, unmoved. Filters of more than ``MAX_BITS`` are not built:
   there the line hashes themselves are grouped over the cluster (map-side
   combined), and the hashes of two documents are the suspects.
3. Only documents with suspected lines are written to the scratch folder and
   only their suspected keys shuffle: an exact, map-side combined count
   confirms the repeats, a join finds the lines to drop, and the lines come
   back to their document by row number.

Defined cases: a null or empty text is one empty line; a null text stays
null. A document that holds a key in several lines counts once. Each row is a
document of its own; rows that share the largest id all keep their lines.
Null ids rank lowest; keys held by null ids alone are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_width
from ._common import arrow_pass, col, let, utf8, written

#: Size of each Bloom filter: bits for each long line, at least a block, at most 128 MB.
BITS_PER_KEY, MAX_BITS = 8, 1 << 30
HASHES = 4
BLOCK_BITS = 1 << 16
#: Keys held by a task before it emits their bits.
FLUSH_KEYS = 4_000_000

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(SPACES)), UPPER, LOWER)


def long_lines(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough."""
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            yield i, key


def count_long_lines(docs: DataFrame, *, text_col: str = "text", min_chars: int = 40) -> int:
    lines = F.split(col(text_col).cast("string"), "\n", -1)
    long = F.filter(lines, lambda x: F.length(F.trim(x, F.lit(SPACES))) >= min_chars)
    return int(docs.agg(F.sum(F.coalesce(F.size(long), F.lit(0)).cast("long"))).first()[0] or 0)


def filter_bits(n_lines: int) -> int:
    """Bits of a filter for so many long lines, a power of two."""
    return 1 << max(BLOCK_BITS.bit_length() - 1, (n_lines * BITS_PER_KEY - 1).bit_length())


def bit_positions(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """The filter positions of each hash, one row per hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) & np.uint64(n_bits - 1)).astype(np.int64)


def _filter_rows(hashes: np.ndarray, n_bits: int) -> Iterator[pa.RecordBatch]:
    """The set bits of both filters of some keys, as 16-bit positions by block."""
    keys, n = np.unique(hashes, return_counts=True)
    once, twice = np.unique(bit_positions(keys, n_bits)), np.unique(bit_positions(keys[n > 1], n_bits))
    blocks = np.unique(once // BLOCK_BITS)
    rows = []
    for bits in (once, twice):
        low = (bits % BLOCK_BITS).astype(np.uint16)
        a, b = np.searchsorted(bits, blocks * BLOCK_BITS), np.searchsorted(bits, (blocks + 1) * BLOCK_BITS)
        rows.append(pa.array([low[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)], pa.binary()))
    yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), *rows], names=["block", "once", "twice"])


def suspects_filter(docs: DataFrame, n_bits: int, *, text_col: str = "text", min_chars: int = 40) -> bytes:
    """The merged twice-seen filter."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        held: list[int] = []
        for batch in batches:
            for text in utf8(batch.column(0)):
                held.extend({xxh3_64_intdigest(key) for _, key in long_lines(text, min_chars)})
                if len(held) >= FLUSH_KEYS:
                    yield from _filter_rows(np.array(held, np.uint64), n_bits)
                    held = []
        if held:
            yield from _filter_rows(np.array(held, np.uint64), n_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if block not in filters:
                    filters[block] = (np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool))
                seen, repeated = filters[block]
                bits = np.frombuffer(once, np.uint16)
                repeated[bits[seen[bits]]] = True
                repeated[np.frombuffer(twice, np.uint16)] = True
                seen[bits] = True
        found = {b: repeated for b, (_, repeated) in filters.items() if repeated.any()}
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(found), pa.int32()),
                pa.array([np.packbits(x, bitorder="little").tobytes() for x in found.values()], pa.binary()),
            ],
            names=["block", "bits"],
        )

    rows = docs.select(col(text_col).cast("string")).mapInArrow(build, "block int, once binary, twice binary")
    parts = max(16, shuffle_width(docs.sparkSession))
    merged = rows.repartition(parts, "block").mapInArrow(merge, "block int, bits binary")
    out = bytearray(n_bits // 8)
    size = BLOCK_BITS // 8
    for block, bits in merged.toLocalIterator():  # together at most the filter
        out[block * size : (block + 1) * size] = bits
    return bytes(out)


def _suspects_by_filter(docs: DataFrame, keep: list[str], text_col: str, min_chars: int, n_bits: int) -> DataFrame:
    """row and out (suspects: numbers of suspected lines, n_lines) of every document, by the broadcast filter."""
    shared = docs.sparkSession.sparkContext.broadcast(
        suspects_filter(docs, n_bits, text_col=text_col, min_chars=min_chars)
    )

    def make():
        bits = np.frombuffer(shared.value, np.uint8)

        def run(texts: pa.Array) -> list:
            lines, hashes, n_lines = _hashed_lines(texts, min_chars)
            flat = np.array([h for x in hashes for h in x], np.uint64)
            at = bit_positions(flat, n_bits)
            hit = iter((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1).tolist())
            return [[[i for i in x if next(hit)] for x in lines], n_lines]

        return run

    return arrow_pass(docs, keep, text_col, make, "suspects array<int>, n_lines long")


def _suspects_by_hash(docs: DataFrame, keep: list[str], text_col: str, min_chars: int) -> DataFrame:
    """The same by grouping the hashes; only they move."""

    def make():
        def run(texts: pa.Array) -> list:
            lines, hashes, n_lines = _hashed_lines(texts, min_chars)
            signed = [np.array(x, np.uint64).astype(np.int64).tolist() for x in hashes]
            return [[[{"i": i, "h": h} for i, h in zip(a, b, strict=True)] for a, b in zip(lines, signed, strict=True)], n_lines]

        return run

    made = arrow_pass(docs, keep, text_col, make, "lines array<struct<i:int,h:bigint>>, n_lines long")
    held = written(made.select(F.monotonically_increasing_id().alias("at"), "row", "out"), "line-hashes")
    each = held.select("at", F.explode("out.lines").alias("line"))
    once = held.select(F.explode(F.array_distinct(F.transform("out.lines", lambda x: x["h"]))).alias("h"))
    twice = written(once.groupBy("h").count().filter("count > 1").select("h"), "line-hashes-twice")
    found = each.join(twice, F.col("line.h") == F.col("h"), "left_semi").groupBy(F.col("at").alias("of"))
    found = found.agg(F.sort_array(F.collect_list("line.i")).alias("suspects"))
    none = F.array().cast("array<int>")
    return held.join(found, F.col("at") == F.col("of"), "left").select(
        "row", F.struct(F.coalesce("suspects", none).alias("suspects"), F.col("out.n_lines").alias("n_lines")).alias("out")
    )


def _hashed_lines(texts: pa.Array, min_chars: int) -> tuple[list[list[int]], list[list[int]], list[int]]:
    """Numbers and key hashes of the long lines of each text, and its lines."""
    from xxhash import xxh3_64_intdigest

    lines, hashes, n_lines = [], [], []
    for text in utf8(texts):
        found = list(long_lines(text, min_chars))
        lines.append([i for i, _ in found])
        hashes.append([xxh3_64_intdigest(key) for _, key in found])
        n_lines.append(text.count(b"\n") + 1)
    return lines, hashes, n_lines


def without_repeats(
    docs: DataFrame,
    *,
    keep: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """``row`` (struct of the columns ``keep``, default all), the new ``text``, n_lines and n_dropped."""
    keep = list(dict.fromkeys([*(keep or docs.columns), id_col, text_col]))
    n_bits = filter_bits(count_long_lines(docs, text_col=text_col, min_chars=min_chars))
    if n_bits <= MAX_BITS:
        marked = _suspects_by_filter(docs, keep, text_col, min_chars, n_bits)
    else:
        marked = _suspects_by_hash(docs, keep, text_col, min_chars)
    clear = marked.filter(F.size("out.suspects") == 0).select(
        "row", F.col("row")[text_col].cast("string").alias("text"), "out.n_lines", F.lit(0).cast("long").alias("n_dropped")
    )
    held = written(
        marked.filter(F.size("out.suspects") > 0).select(
            F.monotonically_increasing_id().alias("n"), "row", "out.suspects", "out.n_lines"
        ),
        "line-suspects",
    )
    lines = F.split(F.col("row")[text_col].cast("string"), "\n", -1)
    cut = let(held, lines=lines).select("n", F.col("row")[id_col].alias("id"), "suspects", "lines")
    key_at = lambda i: line_key(F.get("lines", i))
    repeats = written(
        cut.select("id", F.explode(F.array_distinct(F.transform("suspects", key_at))).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keep_id"))
        .filter(F.col("n_docs") >= min_docs)
        .select(F.col("key").alias("repeat"), "keep_id"),
        "line-repeats",
    )
    one = cut.select("n", "id", F.explode(F.transform("suspects", lambda i: F.struct(i.alias("i"), key_at(i).alias("key")))).alias("s"))
    drops = (
        one.join(repeats, F.col("s.key") == F.col("repeat"))
        .filter(~F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("n").alias("of"))
        .agg(F.collect_list("s.i").alias("drop"))  # at most the lines of one document
    )
    joined = let(held.join(drops, F.col("n") == F.col("of"), "left"), lines=lines)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    left = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    mended = joined.select(
        "row",
        F.when(F.col("drop").isNull(), F.col("row")[text_col].cast("string")).otherwise(left).alias("text"),
        "n_lines",
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
    )
    return clear.unionByName(mended)

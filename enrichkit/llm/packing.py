"""Operator 6, packing into optimal length buckets.

1. Lengths, rounded up to a multiple of ``multiple`` (1: as they are), are
   counted in a global histogram (a map-side combined count). Lengths over the
   token budget form a class of their own, so the histogram has at most
   ``max_tokens / multiple + 1`` rows at any input size.
2. Dynamic programming over the whole histogram chooses the at most
   ``n_buckets`` boundaries with the least total padding. The best start of a
   bucket never moves back when its end moves on, so each round divides and
   conquers.
3. Inside a bucket with boundary ``b`` each batch takes ``max_tokens // b``
   documents. Positions in a bucket are global: every bucket is dealt into
   parts by a hash of the id, in proportion to its size, so a bucket that
   holds most rows is spread over most tasks; documents are numbered inside
   their part, and the parts' sizes (a small table) give the offsets. A
   bucket has one incomplete batch at most.

Every document is in exactly one batch. A document longer than the budget is
a batch by itself (bucket -1) without padding.

Defined cases: null and empty texts have zero tokens and go to the smallest
bucket; an input of empty texts alone makes batches of ``max_tokens``
documents. Rows with the same id are numbered by length and then by their
place in the written table; null ids are dealt by that place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_width
from ._common import arrow_pass, written


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Boundaries (ascending) that minimise the sum of boundary minus length over all documents."""
    order = np.argsort(lengths)
    x, c = lengths[order].astype(np.float64), counts[order].astype(np.float64)
    d = len(x)
    if d == 0:
        return []
    docs, tokens = np.concatenate([[0.0], np.cumsum(c)]), np.concatenate([[0.0], np.cumsum(c * x)])
    cost = np.full(d + 1, np.inf)
    cost[0] = 0.0
    choice = []
    for _ in range(min(n_buckets, d)):
        nxt, back = np.full(d + 1, np.inf), np.zeros(d + 1, np.int64)
        nxt[0] = 0.0
        spans = [(1, d, 0, d - 1)]  # ends first .. last, whose best starts lie in low .. high
        while spans:
            first, last, low, high = spans.pop()
            j = (first + last) // 2  # the bucket holds lengths i .. j - 1 and ends at x[j - 1]
            i = slice(low, min(high, j - 1) + 1)
            pad = cost[i] + x[j - 1] * (docs[j] - docs[i]) - (tokens[j] - tokens[i])
            at = int(np.argmin(pad))
            back[j], nxt[j] = low + at, pad[at]
            if first < j:
                spans.append((first, j - 1, low, low + at))
            if j < last:
                spans.append((j + 1, last, low + at, high))
        cost = nxt
        choice.append(back)
    bounds, j = [], d
    for back in reversed(choice):
        if j == 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(back[j])
    return bounds[::-1]


def token_lengths(
    docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens) by the tokenizer's own library, as the batches need no count by transducers.

    ``ranks_path`` is a byte-BPE file of the tiktoken library, ``pattern`` its
    pre-token pattern; both are read on the driver (fixed size) and broadcast.
    """
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast({"lines": f.read(), "pattern": pattern})

    def make():
        tables = shared.value
        if "encoding" not in tables:  # once in each Python worker
            import base64

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, tables["lines"].splitlines())}
            tables["encoding"] = tiktoken.Encoding(
                "packing", pat_str=tables["pattern"], mergeable_ranks=ranks, special_tokens={}
            )
        encode = tables["encoding"].encode_ordinary

        def run(texts: pa.Array) -> list:
            return [[len(encode(t)) if t else 0 for t in texts.to_pylist()]]

        return run

    made = arrow_pass(docs, [id_col], text_col, make, "n long")
    return made.select(F.col("row")[id_col].alias("doc_id"), F.col("out.n").alias("n_tokens"))


def _rounded(n: Column, multiple: int) -> Column:
    return (F.ceil(n / multiple) * multiple).cast("long")


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    length_col: str = "n_tokens",
    n_buckets: int = 16,
    max_tokens: int = 16_384,
    multiple: int = 1,
) -> DataFrame:
    """doc_id, n_tokens, bucket, batch, slot and padded_to per document.

    ``bucket`` is the boundary; (bucket, batch) names a batch, ``slot`` the
    place in it.
    """
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(length_col), F.lit(0)).cast("long").alias("n_tokens"),
            F.monotonically_increasing_id().alias("place"),
        ).withColumn("rounded", _rounded(F.col("n_tokens"), multiple)),
        "packing-lengths",
    )
    over = F.col("rounded") > max_tokens
    histogram = rows.groupBy(F.when(~over, F.col("rounded")).alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    fits = sorted((r["length"], r["n"]) for r in histogram if r["length"] is not None)
    bounds = best_boundaries(np.array([a for a, _ in fits]), np.array([n for _, n in fits]), n_buckets)
    total = sum(r["n"] for r in histogram)
    size = dict.fromkeys(bounds, 0)
    for length, n in fits:
        size[next(b for b in bounds if b >= length)] += n
    size[-1] = total - sum(n for _, n in fits)
    # parts in proportion to the bucket, about four for each shuffle partition in all
    width = 4 * shuffle_width(docs.sparkSession)
    parts = {b: max(1, -(-n * width // max(total, 1))) for b, n in size.items()}

    bucket = F.lit(-1).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("rounded") <= b, F.lit(b).cast("long")).otherwise(bucket)
    n_parts = F.lit(parts[-1])
    for b in bounds:
        n_parts = F.when(F.col("bucket") == b, F.lit(parts[b])).otherwise(n_parts)
    # by id and place: rows that share an id go to different parts
    draw = F.xxhash64(F.col("doc_id"), F.col("place"))
    dealt = rows.withColumn("bucket", bucket).withColumn("draw", draw).withColumn("part", F.pmod("draw", n_parts.cast("long")))
    inside = Window.partitionBy("bucket", "part").orderBy("draw", "doc_id", "n_tokens", "place")
    numbered = dealt.withColumn("at", F.row_number().over(inside) - 1)
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("bucket", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("bucket").alias("of_bucket"),
            F.col("part").alias("of_part"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        )
    )
    placed = numbered.join(offsets, (F.col("bucket") == F.col("of_bucket")) & (F.col("part") == F.col("of_part")))
    per_batch = F.when(F.col("bucket") > 0, F.floor(F.lit(max_tokens) / F.greatest("bucket", F.lit(1)))).when(
        F.col("bucket") == 0, F.lit(max_tokens)
    ).otherwise(F.lit(1)).cast("long")
    at = F.col("at") + F.col("offset")
    return placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        F.floor(at / per_batch).cast("long").alias("batch"),
        (at % per_batch).cast("int").alias("slot"),
        F.when(F.col("bucket") < 0, F.col("n_tokens")).otherwise(F.col("bucket")).alias("padded_to"),
    )

"""Synthetic indicator rows per key.

The reference draws fresh random numbers for every line of its key list,
so a key that occurs twice gets two different rows. Here every line is
identified by ``(key, occurrence)`` with occurrence = 1..n for a key seen n
times, and each value is a keyed hash of that pair: repeatable, and
recomputed identically after a lost executor.

Occurrences are produced without ever collecting a key's lines into one task:
lines are counted per key (partial aggregation), each count is cut into
chunks of ``chunk_rows`` occurrences, the chunk descriptors are spread over
the cluster with a fixed-width hash repartition, and only then expanded.
A key holding a third of all lines is thus generated by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import keyed_uniform
from ..session import shuffle_width

# Indicator ranges of the reference (uniform, inclusive low).
ECONOMIC_MEASURES = {"gdp_per_capita": (1000.0, 100000.0), "hdi": (0.4, 0.99)}
DEFAULT_SEED = 42


def key_occurrences(
    keys: DataFrame,
    key: str,
    chunk_rows: int = 1_000_000,
    partitions: int | None = None,
) -> DataFrame:
    """``(key, occurrence)`` for every row of ``keys``; occurrence is 1..n per key."""
    n, chunk = "__ek_n", "__ek_chunk"
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    last_chunk = F.expr(f"({n} - 1) div {int(chunk_rows)}")  # exact integer division
    chunks = counts.select(key, n, F.explode(F.sequence(F.lit(0), last_chunk)).alias(chunk))
    # an explicit width keeps AQE from coalescing the (tiny) descriptors back
    # into one task before they are expanded
    width = partitions or shuffle_width(keys.sparkSession)
    chunks = chunks.repartition(width, key, chunk)
    start = F.col(chunk) * F.lit(int(chunk_rows)) + 1
    end = F.least((F.col(chunk) + 1) * F.lit(int(chunk_rows)), F.col(n))
    return chunks.select(key, F.explode(F.sequence(start, end)).alias("occurrence"))


def keyed_indicators(
    keys: DataFrame,
    key: str,
    measures: Mapping[str, tuple[float, float]] = ECONOMIC_MEASURES,
    *,
    seed: int = DEFAULT_SEED,
    out_key: str | None = None,
    keep_occurrence: bool = False,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``keys``: the key plus one uniform column per measure."""
    occ = key_occurrences(keys, key, chunk_rows)
    cols = [F.col(key).alias(out_key or key)]
    if keep_occurrence:
        cols.append(F.col("occurrence"))
    cols += [
        keyed_uniform([F.col(key), F.col("occurrence")], lo, hi, seed, name).alias(name)
        for name, (lo, hi) in measures.items()
    ]
    return occ.select(*cols)

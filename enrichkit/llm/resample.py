"""Operator 13: documents drawn by how much they look like a target, exact ranks by regular sampling.

Features of a text are its words and pairs of consecutive words, hashed into
``BUCKETS``. A bucket's gain is its log ratio of smoothed frequencies, target
over corpus; a document's weight is the floored mean gain of its features.
Gumbel noise, a function of seed and id, is added to the weight: the highest
scores are then a draw without replacement in proportion to exp(weight).

Method. Counting and scoring are two passes of array look-ups: every task adds
up its own array of bucket counts and sends that, and the gains return as one
array of ``BUCKETS`` numbers whatever the corpus holds. Ranks come from parallel
sorting by regular sampling: the scored rows are written; each partition sorts
its rows into a run and gives every k-th as a sample, k such that all runs
together give ``segments`` times as many samples as there are runs; regular
places among the sorted samples are the splitters (a sample table too large for
the driver is ranked by the same function first); rows go to the segment
between two splitters and merge there; the counts of the segments before give
the offset that turns a row's place in its segment into its rank.

A run of n/r rows and k <= n / (r * segments) keep every segment below twice the
mean, whatever the scores: equal scores and ids (repeated rows) are told apart by
the row's place in the written table, so a group of them is split as well.

Defined cases. A null or empty text has no features: weight 0, never drawn
unless ``least_words`` is 0. A null id hashes as an empty string and comes last
among equal scores. Rows with equal score and id get consecutive ranks; which of
them is first is arbitrary. Empty tables give an empty result; an empty target
still has its smoothed (equal) frequencies. Long texts are counted a megabyte of
words at a time.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..session import shuffle_width
from ._common import ROWS_AT_ONCE, arrow_pass, col, utf8, written

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
#: Bytes of a text split into words at once.
PIECE = 1 << 20
#: Samples that the driver sorts; more are ranked as a table.
ON_DRIVER = 100_000

#: Lower-case letters, digits and bytes of other characters make words; all else separates.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _features(text: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """Bucket numbers of the features of a text, a piece at a time, and the piece's words."""
    plain = text.translate(_PLAIN)
    at, before = 0, None
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        words = plain[at:end].split()
        at = end
        if not words:
            continue
        single = list(map(crc32, words))
        left = single if before is None else [before, *single]
        pairs = map(crc32, words[1:] if before is None else words, map(crc32, repeat(b" "), left[:-1]))
        before = single[-1]
        n = len(single)
        found = np.empty(n + len(left) - 1, np.int64)
        found[:n] = single
        found[n:] = np.fromiter(pairs, np.int64, len(left) - 1)
        yield found % BUCKETS, n


def bucket_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n) of all features of all texts, one array of counts a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                for value in utf8(whole.column(0).slice(at, ROWS_AT_ONCE)):
                    for found, _ in _features(value):
                        counts += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    counted = docs.select(col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text") -> np.ndarray:
    """The gain of every bucket: at most ``BUCKETS`` rows of either table reach the driver."""

    def array(df: DataFrame) -> list[int]:
        counts = [0] * BUCKETS
        for r in bucket_counts(df, text).collect():
            counts[r.bucket] = r.n
        return counts

    s, t = array(docs), array(target)
    above, below = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    ratios = ((float(b + 1) * above) / (float(a + 1) * below) for a, b in zip(s, t, strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def scores(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", keep: Iterable[str] | None = None
) -> DataFrame:
    """``row`` (the columns ``keep``), id, n_words, n_features, weight and score of every row."""
    table = gains(docs, target, text)

    def make():
        def fn(texts: pa.Array) -> list:
            words, features, weights = [], [], []
            for value in utf8(texts):
                n = size = total = 0
                for found, k in _features(value):
                    n += k
                    size += len(found)
                    total += int(table[found].sum())
                words.append(n)
                features.append(size)
                weights.append(total // size if size else 0)
            return [words, features, weights]

        return fn

    keep = list(docs.columns if keep is None else keep)
    named = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), col(id).alias("id"), col(text).alias("text"))
    out = arrow_pass(named, ["row", "id"], "text", make, "n_words long, n_features long, weight long")
    text_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), text_id).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw.cast("double") + 0.5) / F.lit(4294967296.0))))
    found = out.select("row.row", "row.id", "out.*")
    return found.withColumn("score", F.col("weight") + noise)


def _key(row) -> tuple:
    """Sort key of a row: high scores first, then small ids, null ids last, then the place."""
    return (-row[0], row[1] is None, row[1] if row[1] is not None else 0, row[2])


def _splitters(keys: DataFrame, n: int, segments: int) -> list[tuple]:
    """Keys at regular places of the sorted samples; ``keys`` has score, id, place."""
    runs = keys.select(F.spark_partition_id().alias("run")).distinct().count()
    every = max(1, n // max(1, runs * segments))

    def samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = -(seen + 1) % every
            yield batch.take(pa.array(range(first, batch.num_rows, every), pa.int64()))
            seen += batch.num_rows

    run = keys.sortWithinPartitions(F.desc("score"), F.asc_nulls_last("id"), "place")
    found = written(run.mapInArrow(samples, keys.schema), "samples")
    m = found.count()
    if m <= ON_DRIVER:
        ordered = sorted(_key(r) for r in found.collect())
        return [ordered[i * m // segments] for i in range(1, segments)] if m else []
    wanted = F.explode(F.array(*[F.lit(i * m // segments + 1) for i in range(1, segments)])).alias("rank")
    picked = ranks(found, m, segments).join(F.broadcast(found.sparkSession.range(1).select(wanted)), "rank")
    return sorted(_key((r.score, r.id, r.place)) for r in picked.collect())


def ranks(scored: DataFrame, n: int, segments: int) -> DataFrame:
    """``scored`` (a written table of ``n`` rows with score, id, place) plus ``rank`` from 1."""
    cuts = _splitters(scored.select("score", "id", "place"), n, segments)
    names = scored.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = zip(*(batch.column(names.index(c)).to_pylist() for c in ("score", "id", "place")), strict=True)
            segment = pa.array([bisect_right(cuts, _key(k)) for k in key], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, segment], names=[*names, "segment"])

    schema = StructType([*scored.schema.fields]).add("segment", IntegerType())
    dealt = scored.mapInArrow(deal, schema)
    counts = dict(dealt.groupBy("segment").count().collect())  # one number a segment
    before, offsets = 0, []
    for i in range(len(cuts) + 1):
        offsets.append(before)
        before += counts.get(i, 0)
    place = F.row_number().over(
        Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    )
    offset = F.get(F.lit(offsets).cast("array<long>"), F.col("segment"))
    return dealt.withColumn("rank", place + offset).drop("segment")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    keep: Iterable[str] | None = None,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every row: ``row`` (the columns ``keep``, all by default), n_words, n_features, weight, score, rank.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100)
    highest scores are drawn and ranked from 1; other ranks are null.
    """
    scored = scores(docs, target, id, text, keep).withColumn("place", F.monotonically_increasing_id())
    scored = written(scored, "scored")  # places are fixed from here on
    long_enough = F.col("n_words") >= least_words
    n = scored.filter(long_enough).count()
    ranked = ranks(scored.filter(long_enough), n, 4 * shuffle_width(docs.sparkSession))
    drawn = percent * n // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("row", "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    return resample(docs, target, id, text, docs.columns, **options).filter(F.col("rank").isNotNull()).select("row.*")

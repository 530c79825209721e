"""Operator 2, exact dedup by stateful streaming (DataFrame and SQL functions only).

The table is read as a stream. A streaming aggregation keyed by the SHA-256
digest of the text keeps, without watermark or expiry, one state row per
distinct digest in the disk-backed RocksDB store: the group size and the
largest (identifier, content locator). The locator is the source file and the
row number in it. The state is checkpointed in the shared folder, so a lost
executor or a restarted driver goes on from the last batch, and a later run
over new files only adds to it, whatever their modification times. A state
whose counts do not sum to the rows of the table is refused.

The state is then joined with the documents by digest (ids and digests move,
texts do not). Full bytes are checked on every hit: for each digest with more
than one row, the smallest and the largest text must be the same bytes. Both
come from a map-side combined aggregate, so a group holding a third of all
rows costs one row per task. A broadcast bitmap, sized by the number of hits,
keeps the texts without a copy from moving (a join by digest beyond 64 MB). Digests whose texts differ are grouped by the full
text instead.

Defined cases: null and empty texts are equal. Of equal texts the row with
the largest id stays; null ids rank lowest; of equal ids the row with the
largest locator stays, so exactly one row of each group stays. An empty table
gives an empty result. Columns besides id and text are not read. A path with
one of ``{}[]*?\\`` is refused: Spark's file stream reads such files twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ._common import as_literal_path, col, written

#: Bits of the broadcast filter for each digest with more than one row, and in all (64 MB).
BITS_PER_HIT, MAX_BITS = 16, 1 << 29
#: A stream passes over new files older than this, counted back from the newest file it has seen.
MAX_FILE_AGE = "36500d"
_STATE = "spark.sql.streaming.stateStore."
#: The store of the keyed state; many small partitions must not preallocate log files.
STORE_CONF = {
    _STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    _STATE + "rocksdb.allowFAllocate": "false",
}


def sha256_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(source: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    place = source.metadataColumn("_metadata")  # also beside a column of that name
    return source.select(
        digest(text).alias("digest"),
        F.struct(
            col(id_col).alias("id"),
            place["file_path"].alias("file"),
            place["row_index"].alias("at"),
        ).alias("who"),
        text.alias("text"),
    )


def keyed_state(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256_digest,
    max_files_per_batch: int = 10_000,
) -> DataFrame:
    """Run the stream over all files not yet seen; returns (digest, n, who) per digest.

    Call it again with the same ``checkpoint`` to add new files to the state.
    """
    if set(path) & set("{}[]*?\\"):
        raise ValueError(f"Spark's file stream counts files twice under a path that looks like a pattern: {path}")
    schema = spark.read.parquet(as_literal_path(path)).schema
    plain = path.rstrip("/")
    # a stream takes a single file only as a pattern: one letter of the path stands in brackets
    at = max((i for i, c in enumerate(plain) if c.isalnum()), default=len(plain) - 1)
    as_glob = f"{as_literal_path(plain[:at])}[{as_literal_path(plain[at])}]{as_literal_path(plain[at + 1 :])}"
    options = {"maxFilesPerTrigger": max_files_per_batch, "maxFileAge": MAX_FILE_AGE}
    stream = spark.readStream.schema(schema).options(**options).parquet(as_glob)
    state = (
        _rows(stream, id_col, text_col, digest)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("who").alias("who"))
    )
    before = {k: spark.conf.get(k, None) for k in STORE_CONF}
    for k, v in STORE_CONF.items():
        spark.conf.set(k, v)
    try:
        run = (
            state.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not run.recentProgress and spark.read.schema(schema).parquet(as_literal_path(path)).isEmpty():
        return _no_groups(spark, schema, id_col)
    stored = spark.read.format("statestore").load(checkpoint)
    fields = stored.schema["value"].dataType.fieldNames()
    return stored.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[fields[0]].alias("n"),
        F.col("value")[fields[1]].alias("who"),
    )


def _no_groups(spark: SparkSession, schema, id_col: str) -> DataFrame:
    kind = schema[id_col].dataType.simpleString()
    return spark.createDataFrame([], f"digest string, n long, who struct<id:{kind},file:string,at:bigint>")


def exact_groups(
    spark: SparkSession,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256_digest,
    checkpoint: str | None = None,
    max_files_per_batch: int = 10_000,
) -> DataFrame:
    """Per row of the parquet table at ``path``: id, keep_id, group_size, kept, digest, file, at."""
    checkpoint = checkpoint or scratch_path(spark, "exact-dedup-state")
    state = written(
        keyed_state(
            spark, path, checkpoint, id_col=id_col, text_col=text_col, digest=digest, max_files_per_batch=max_files_per_batch
        ),
        "exact-dedup-groups",
    )
    source = spark.read.parquet(as_literal_path(path))
    n_state, n_rows = state.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], source.count()
    if n_state != n_rows:
        raise ValueError(f"the state at {checkpoint} counts {n_state} rows, the table at {path} has {n_rows}")
    rows = _rows(source, id_col, text_col, digest)

    # full bytes on hits: one digest, one text
    spans = (
        _maybe_hits(rows, state.filter("n > 1"))
        .groupBy("digest")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
    )
    differing = written(spans.filter("low <> high").select(F.col("digest").alias("mixed")), "exact-dedup-mixed")

    slim = rows.select("digest", "who")
    plain = slim.join(state.withColumnRenamed("who", "keeper").withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"))
    if differing.isEmpty():
        return _result(plain)
    plain = plain.join(differing, F.col("digest") == F.col("mixed"), "left_anti")
    mixed = rows.join(differing, F.col("digest") == F.col("mixed"), "left_semi")
    by_text = mixed.groupBy(F.col("text").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.max("who").alias("keeper"))
    mixed = mixed.join(by_text, F.col("text") == F.col("of"))
    return _result(plain).unionByName(_result(mixed))


def _maybe_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows whose digest is among ``hits``, and few others.

    The hits are counted first and set bits in ``BITS_PER_HIT`` times as many
    positions; the bitmaps are broadcast and no row moves. Where they would
    hold more than ``MAX_BITS`` in all, the rows meet the hits in a join by
    digest instead.
    """
    n = hits.count()
    if n * BITS_PER_HIT > MAX_BITS:
        return rows.join(hits.select(F.col("digest").alias("of")), F.col("digest") == F.col("of"), "left_semi")
    width = 1 << max(16, (n * BITS_PER_HIT - 1).bit_length())
    slot = 1 + F.pmod(F.xxhash64("digest"), F.lit(width))
    bitmaps = (
        hits.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    )
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("int") % 2 == 1
    marked = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(slot) == F.col("bucket"))
    return marked.filter(is_set).drop("bucket", "bits")


def _result(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("who.id").alias("id"),
        F.col("keeper.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("who.file") == F.col("keeper.file")) & (F.col("who.at") == F.col("keeper.at"))).alias("kept"),
        "digest",
        F.col("who.file").alias("file"),
        F.col("who.at").alias("at"),
    )

"""Incremental enrichment of arriving documents with Structured Streaming.

The flatten, density, join and classification steps are stateless, so the
batch operators apply unchanged to a streaming DataFrame: new JSON files in a
folder are flattened and left-joined to a static indicator table (a
stream-static join, the stream on the preserved side) and appended to a
table. Progress is kept in a checkpoint folder, so a restarted query resumes
where it stopped and a lost executor only re-runs its micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.classify import development_status
from ..operators.join import left_enrich
from ..operators.nested import flatten_countries
from ..schemas import raw_country_schema


def read_document_stream(
    spark: SparkSession,
    json_dir: str,
    schema: StructType | None = None,
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of JSON Lines files appearing in ``json_dir``."""
    reader = spark.readStream.schema(schema or raw_country_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(json_dir)


#: Indicator rows of one code from which on the code is dealt over several tasks.
SKEW_THRESHOLD = 1_000_000


def enrich_stream(
    raw: DataFrame, indicators: DataFrame, *, skew_threshold: int | None = SKEW_THRESHOLD
) -> DataFrame:
    """Streaming counterpart of E1 + E3 (flatten, density, join, classify).

    The indicator table is static, so hot codes are found once up front and
    dealt over several tasks in every micro-batch, where Spark's adaptive
    execution, and with it its skew join, is off. Documents without a code
    are spread by a hash of the row then.
    """
    joined = left_enrich(
        flatten_countries(raw),
        indicators,
        "country_code_3",
        "country_code_3_econ",
        skew_threshold=skew_threshold,
    )
    return development_status(joined)


def start_enrichment(
    spark: SparkSession,
    json_dir: str,
    indicators: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    skew_threshold: int | None = SKEW_THRESHOLD,
) -> StreamingQuery:
    """Start the enrichment stream into a parquet table at ``out_path``.

    ``available_now`` processes every file present and stops; otherwise the
    query keeps running with ``processing_time`` triggers.
    """
    stream = enrich_stream(
        read_document_stream(spark, json_dir, max_files_per_trigger=max_files_per_trigger),
        indicators,
        skew_threshold=skew_threshold,
    )
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

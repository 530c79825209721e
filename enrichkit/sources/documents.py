"""Nested-document scans (S1, S3) and the raw landing sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import prune_schema
from .arrays import read_array_documents


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    fields: list[str] | tuple[str, ...] | None = None,
    multi_line: bool | str = False,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Scan JSON documents under a declared schema.

    Only declared fields are read; with ``fields`` the schema is narrowed
    first, so the scan never materialises the others (S3). JSON Lines input
    (the default) is split across tasks; ``multi_line=True`` reads documents
    that span lines, including one top-level array per file, at one task per
    file; ``multi_line="array"`` reads files of one top-level array each, its
    records on lines of their own, by many tasks a file (``sources.arrays``;
    modes PERMISSIVE and FAILFAST). ``mode`` is Spark's parse mode: PERMISSIVE turns a wrong-typed field
    into NULL, FAILFAST raises, DROPMALFORMED drops the row.

    ``partitions`` spreads the rows over that many partitions right after the
    scan. Use it with ``multi_line``: a file holding one large array is parsed
    by one task, but everything after the parse then runs in parallel.
    Spark sorts before a round-robin repartition, so a retried task gets the
    same rows.
    """
    if fields:
        schema = prune_schema(schema, fields)
    if multi_line == "array":
        df = read_array_documents(spark, path, schema, mode=mode, corrupt_column=corrupt_column)
        return df.repartition(partitions) if partitions else df
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode)
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, "string")
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.json(path)
    return df.repartition(partitions) if partitions else df


def write_documents(df: DataFrame, path: str, *, keep_null_fields: bool = False) -> None:
    """Land documents as UTF-8 JSON Lines, replacing what is at ``path``.

    Non-ASCII text is written as is. Null fields are left out unless
    ``keep_null_fields``; either way they read back as NULL.
    """
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", not keep_null_fields)
        .option("encoding", "UTF-8")
        .json(path)
    )

"""Helpers shared by the operators: isolated columns, written tables, Arrow passes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructType, _parse_datatype_string

from ..session import scratch_path


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def let(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` plus columns that are computed once for each row.

    A one-element generator keeps Catalyst from inlining an expensive
    expression into every place (and lambda) that uses it.
    """
    one = F.struct(*[v.alias(k) for k, v in values.items()])
    return df.select("*", F.inline(F.array(one)))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor never re-runs the steps before,
    and later readers see one fixed set of rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows handed to a function at once (bounds the Python objects of a task).
ROWS_AT_ONCE = 500


def arrow_pass(
    df: DataFrame,
    keep: Iterable[str],
    text: str,
    make: Callable[[], Callable[[pa.Array], list]],
    result: str,
) -> DataFrame:
    """Run ``make()(texts)`` over Arrow batches and attach what it returns.

    The columns ``keep`` ride along inside one struct ``row`` and the results
    (``result`` is their DDL) come back inside one struct ``out``, so no
    column of the input can clash with a name used here. ``make`` is called
    once per task; its function gets the column ``text`` as strings, a few
    hundred rows at a time, and returns one list or array per field of
    ``result``.
    """
    schema = _parse_datatype_string(result)
    assert isinstance(schema, StructType)
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.fieldNames()
    keep = list(keep)
    row = F.struct(*[col(c) for c in keep]).alias("row")
    # a text that rides along anyway is not sent a second time
    inside = keep.index(text) if text in keep and df.schema[text].dataType == StringType() else None
    source = df.select(row) if inside is not None else df.select(row, col(text).cast("string").alias("text"))
    out_schema = StructType().add("row", source.schema["row"].dataType).add("out", schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                rows = batch.column(0)
                made = fn(batch.column(1) if inside is None else rows.field(inside))
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types, strict=True)]
                out = pa.StructArray.from_arrays(made, names=names)
                yield pa.RecordBatch.from_arrays([rows, out], names=["row", "out"])

    return source.mapInArrow(run, out_schema)


def struct_pass(df: DataFrame, make: Callable[[], Callable[[pa.Array], list]], result: str) -> DataFrame:
    """``arrow_pass`` over a column ``given`` of any type; ``df`` has ``row`` and ``given``."""
    schema = _parse_datatype_string(result)
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                made = [pa.array(x, t) for x, t in zip(fn(batch.column(1)), types, strict=True)]
                out = pa.StructArray.from_arrays(made, names=names)
                yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["row", "out"])

    out_schema = StructType().add("row", df.schema["row"].dataType).add("out", schema)
    return df.select("row", "given").mapInArrow(run, out_schema)


def as_literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves (Spark's readers take paths as patterns)."""
    return re.sub(r"([\\*?\[\]{}^,])", r"\\\1", path)


def utf8(array: pa.Array) -> Iterator[bytes]:
    """The strings of an Arrow array as UTF-8 bytes, null as empty, without decoding."""
    for value in array.cast(pa.binary()):
        yield value.as_py() or b""

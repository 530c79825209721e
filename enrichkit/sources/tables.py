"""Stored tables: scan, typed rows, overwrite, publish."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DataType, StructType


class SchemaMismatchError(ValueError):
    """An overwrite would change the schema of the stored table."""


def default_format(spark: SparkSession) -> str:
    """``delta`` when the Delta extension is configured, else ``parquet``."""
    ext = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "DeltaSparkSessionExtension" in ext else "parquet"


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Load a stored table by path (S7): its current version, or plain files."""
    fmt = fmt or default_format(spark)
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    current = current_path(spark, path)
    if current.rstrip("/") != path.rstrip("/"):
        _refuse_stray_files(spark, path.rstrip("/"), current)
    if spark.catalog.tableExists(table_name(path)):
        spark.catalog.refreshTable(table_name(path))  # others may have appended
        return spark.table(table_name(path))
    return spark.read.format(fmt).load(current)


def typed_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Small literal rows with a declared schema (S6, driver-sized input only)."""
    return spark.createDataFrame(list(rows), schema=schema)


def _zero(kind: DataType) -> Column:
    """A value of the type that Spark knows to be non-null (never seen in results)."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_zero(f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    if isinstance(kind, T.DecimalType):
        return F.lit(Decimal(0).scaleb(-kind.scale)).cast(kind)
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    plain = {
        T.BooleanType: "false",
        T.BinaryType: "X''",
        T.DateType: "DATE '1970-01-01'",
        T.TimestampType: "TIMESTAMP_LTZ '1970-01-01 00:00:00'",
        T.TimestampNTZType: "TIMESTAMP_NTZ '1970-01-01 00:00:00'",
        T.DayTimeIntervalType: "INTERVAL '0' SECOND",
        T.YearMonthIntervalType: "INTERVAL '0' MONTH",
    }
    return F.expr(plain.get(type(kind), "''")).cast(kind)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select, cast and order ``df`` to a declared schema (S6 at scale).

    A field declared NOT NULL is checked row by row: a NULL raises at run time
    (like ``createDataFrame`` with that schema), and the column is typed
    non-nullable. The ``coalesce`` fallback is never reached; it only lets
    Spark prove the column non-nullable.
    """
    cols = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            guard = F.when(
                c.isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}"))
            ).otherwise(c)
            c = F.coalesce(guard, _zero(field.dataType))
        cols.append(c.alias(field.name))
    return df.select(*cols).to(schema)


def _hadoop_path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _has_jvm(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jvm is not None
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) file system."""
    if not _has_jvm(spark):
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except AnalysisException:
            return False
    hpath, fs = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def table_name(path: str) -> str:
    """The catalog name under which the table at ``path`` is registered."""
    root = path.rstrip("/")
    base = re.sub(r"[^0-9a-z]+", "_", root.rsplit("/", 1)[-1].lower()).strip("_") or "table"
    return f"spark_catalog.default.{base}_{hashlib.md5(root.encode()).hexdigest()[:10]}"


class StrayFilesError(RuntimeError):
    """Rows were appended beside a table's current version, where no reader of the table looks."""


def _names(spark: SparkSession, root: str) -> dict[str, tuple[bool, int]]:
    """name -> (is a folder, modification time) of what lies in a folder, without hidden names."""
    folder, fs = _hadoop_path(spark, root)
    if not fs.exists(folder):
        return {}
    found = {s.getPath().getName(): (s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(folder)}
    return {n: x for n, x in found.items() if n[0] not in "._"}


def _versions(spark: SparkSession, root: str) -> list[str]:
    """The version folders of a table, oldest first (a folder gets this name when all is written)."""
    return sorted(n for n, (folder, _) in _names(spark, root).items() if folder and _VERSION.fullmatch(n))


_VERSION = re.compile(r"v\d{6}-[0-9a-f]{8}")


def current_path(spark: SparkSession, path: str) -> str:
    """The plain folder that holds the table's current files, for any reader (and for ``append``).

    The catalog says which; a session whose catalog does not know the table
    (an in-memory one, in another program) takes the newest version folder.
    A folder without versions holds the files itself.
    """
    root, name = path.rstrip("/"), table_name(path)
    if spark.catalog.tableExists(name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"]
    versions = _versions(spark, root) if _has_jvm(spark) else []
    return f"{root}/{versions[-1]}" if versions else path


def _refuse_stray_files(spark: SparkSession, root: str, current: str) -> None:
    if not _has_jvm(spark):
        return
    names = _names(spark, root)
    since = names.get(current.rsplit("/", 1)[-1], (True, 0))[1]
    stray = sorted(n for n, (folder, changed) in names.items() if not folder and changed > since)
    if stray:
        raise StrayFilesError(
            f"{root} holds {len(stray)} newer files beside its current version, e.g. {stray[0]}; "
            "append with append_table or to current_path"
        )


def _register(spark: SparkSession, name: str, folder: str, fmt: str, schema: StructType) -> None:
    """Make ``folder`` the place of the catalog's table: the switch from one version to the next."""
    if spark.catalog.tableExists(name):
        if _strip_nullability(spark.table(name).schema) == _strip_nullability(schema):
            place = folder.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")  # another schema: registered anew (the files are external)
    spark.catalog.createTable(name, path=folder, source=fmt, schema=schema)


def _delete(spark: SparkSession, path: str) -> None:
    found, fs = _hadoop_path(spark, path)
    fs.delete(found, True)


def _stored_schema(spark: SparkSession, path: str, fmt: str) -> StructType | None:
    if not path_exists(spark, path):
        return None
    try:
        return read_table(spark, path, fmt).schema
    except AnalysisException:
        return None


def _strip_nullability(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def save_table(
    df: DataFrame,
    path: str,
    fmt: str | None = None,
    *,
    overwrite_schema: bool = False,
    check: Callable[[], None] | None = None,
) -> None:
    """Replace the whole table at ``path``.

    Spark writes the new rows to a version folder of their own, a plain folder
    for any reader; only when all are written (and ``check`` did not raise)
    the catalog's table ``table_name(path)`` gets that folder as its location.
    A failed or interrupted job leaves the table as it was, no file is copied,
    and a table may be overwritten with rows read from itself. The version
    before stays for running readers, older ones are removed. One job writes a
    table at a time. Delta tables are written by Delta.

    Like an overwrite of a Delta table without ``overwriteSchema``, a write
    that would change column names or types is refused unless
    ``overwrite_schema``.
    """
    spark = df.sparkSession
    fmt = fmt or default_format(spark)
    stored = _stored_schema(spark, path, fmt)
    if stored is not None and not overwrite_schema and _strip_nullability(stored) != _strip_nullability(df.schema):
        raise SchemaMismatchError(
            f"schema of {path} is {stored.simpleString()}, new data has {df.schema.simpleString()}"
        )
    if fmt == "delta":
        writer = df.write.format(fmt).mode("overwrite")
        if overwrite_schema:
            writer = writer.option("overwriteSchema", "true")
        writer.save(path)
        if check:
            check()
        return
    root, files = path.rstrip("/"), _has_jvm(spark)
    before = current_path(spark, root)
    number = int(m[0][1:7]) if (m := _VERSION.search(before)) else 0
    version = f"v{number + 1:06d}-{uuid.uuid4().hex[:8]}"
    # a hidden name until all is written: no other session takes it for a version
    fresh = f"{root}/_{version}" if files else f"{root}/{version}"
    try:
        df.write.format(fmt).save(fresh)
        if check:
            check()
        if files:
            source, fs = _hadoop_path(spark, fresh)
            if not fs.rename(source, _hadoop_path(spark, f"{root}/{version}")[0]):
                raise OSError(f"could not rename {fresh}")
    except Exception:
        if files:
            _delete(spark, fresh)
        raise
    _register(spark, table_name(root), f"{root}/{version}", fmt, df.schema)
    if files:
        kept = {version, before.rsplit("/", 1)[-1]}
        plain = before.rstrip("/") == root  # the version before is the plain files of the folder
        for name, (folder, _) in _names(spark, root).items():
            if name not in kept and not (plain and not folder):
                _delete(spark, f"{root}/{name}")


def append_table(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Add rows to the current version of a table; columns are matched by name."""
    spark = df.sparkSession
    fmt = fmt or default_format(spark)
    stored = _stored_schema(spark, path, fmt)
    if stored is None:
        return save_table(df, path, fmt)
    if sorted(_strip_nullability(stored)) != sorted(_strip_nullability(df.schema)):
        raise SchemaMismatchError(f"schema of {path} is {stored.simpleString()}, new rows have {df.schema.simpleString()}")
    rows = df.select(*["`" + c.replace("`", "``") + "`" for c in stored.names])
    rows.write.format(fmt).mode("append").save(path if fmt == "delta" else current_path(spark, path))
    if fmt != "delta" and spark.catalog.tableExists(table_name(path)):
        spark.catalog.refreshTable(table_name(path))


def publish(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str | None = None,
    *,
    overwrite_schema: bool = False,
) -> DataFrame:
    """Copy a stored table unchanged to a report location (S9); returns the copy."""
    fmt = fmt or default_format(spark)
    save_table(read_table(spark, source, fmt), target, fmt, overwrite_schema=overwrite_schema)
    return read_table(spark, target, fmt)

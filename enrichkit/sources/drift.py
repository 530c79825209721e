"""Where documents depart from their declared schema.

A scan under a declared schema loses undeclared fields and turns wrong-typed
ones into NULL without a word. ``read_with_drift`` reads JSON Lines once and gives
each document both its declared fields, as ``read_documents`` has them, and the
list of its departures, found on the same line as a VARIANT. ``drift_report``
counts them. All of it is JVM expressions: one scan, no shuffle but the report's
partial aggregate, whose groups are distinct departures, not documents.

A departure has a ``path`` (``$.name.common``, ``[]`` for items of an array, ``{}``
for values of a map), a ``problem`` and the JSON type ``found`` there:

* ``undeclared``: a field of an object that its struct does not declare; what lies
  below it is not looked at. Keys of a declared map are data, never undeclared.
* ``wrong type``: any other JSON type than the declared one: a fraction or an
  integer beyond 64 bits in a long, a number in a string (which the scan reads as
  text), an array for an object. JSON null fits every type.
* ``unparsable`` at ``$``: no JSON, or an object that holds a field twice (the scan
  takes the last).

A departure is listed once a document, however often it occurs in it. Blank lines
are no documents. Field names are compared exactly, as VARIANT has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
)

DRIFT_TYPE = "array<struct<path:string,problem:string,found:string>>"

UNDECLARED, WRONG_TYPE, UNPARSABLE = "undeclared", "wrong type", "unparsable"


def _fitting(declared: DataType) -> tuple[str, ...]:
    """JSON types that a declared type, no container, takes."""
    if isinstance(declared, BooleanType):
        return ("BOOLEAN",)
    if isinstance(declared, ByteType | ShortType | IntegerType | LongType):
        return ("BIGINT",)
    if isinstance(declared, FloatType | DoubleType | DecimalType):
        return ("BIGINT", "DECIMAL", "DOUBLE")
    if isinstance(declared, StringType) or declared.typeName() in ("date", "timestamp", "timestamp_ntz", "binary"):
        return ("STRING",)
    raise ValueError(f"drift of a declared {declared.simpleString()} is not known")


def _json_type(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _departure(path: Column, problem: str, found: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(problem).alias("problem"), found.alias("found"))


def _departures(value: Column, declared: DataType, path: str) -> Column:
    """Departures of one value and of what it holds; none for an absent value.

    What is used more than once is bound to a lambda variable: written out in each
    place, it would be computed again there, once more a level. Objects and arrays
    are told by taking them apart; the type of a whole subtree is never spelt out.
    """
    if isinstance(declared, StructType | MapType):
        parts, container = F.try_variant_get(value, "$", "map<string,variant>"), "OBJECT"
    elif isinstance(declared, ArrayType):
        parts, container = F.try_variant_get(value, "$", "array<variant>"), "ARRAY"
    else:
        parts, container = None, None
    if parts is None:
        return _bind(_json_type(value), lambda found: _unless(value, found, found.isin(*_fitting(declared)), path))
    return _bind(
        F.struct(value.alias("value"), parts.alias("parts")),
        lambda b: F.when(b["parts"].isNotNull(), _inside(b["parts"], declared, path)).otherwise(
            _bind(_json_type(b["value"]), lambda found: _unless(b["value"], found, found == container, path))
        ),
    )


def _bind(value: Column, body) -> Column:
    """``body(value)``, an array, with ``value`` computed once."""
    return F.flatten(F.transform(F.array(value), body))


def _unless(value: Column, found: Column, fits: Column, path: str) -> Column:
    none = F.array().cast(DRIFT_TYPE)
    wrong = F.array(_departure(F.lit(path), WRONG_TYPE, found))
    return F.when(value.isNull() | (found == "VOID") | fits, none).otherwise(wrong)


def _inside(parts: Column, declared: DataType, path: str) -> Column:
    """Departures in the parts of an object or array that is declared as one."""
    if isinstance(declared, ArrayType):
        return F.flatten(F.transform(parts, lambda v: _departures(v, declared.elementType, path + "[]")))
    if isinstance(declared, MapType):
        return F.flatten(F.transform(F.map_values(parts), lambda v: _departures(v, declared.valueType, path + "{}")))
    rest = F.map_filter(parts, lambda name, _: ~name.isin(*declared.fieldNames()))
    undeclared = F.transform(
        F.map_entries(rest),
        lambda e: _departure(F.concat(F.lit(path + "."), e["key"]), UNDECLARED, _json_type(e["value"])),
    )
    fields = [_departures(F.try_element_at(parts, F.lit(f.name)), f.dataType, f"{path}.{f.name}") for f in declared.fields]
    return F.concat(undeclared, *fields)


def departures(text: Column, schema: StructType) -> Column:
    """The departures of a JSON text from ``schema``, as an array; NULL text has none."""
    broken = F.array(_departure(F.lit("$"), UNPARSABLE, F.lit(None).cast("string")))

    def of_one(value: Column) -> Column:
        return F.when(value.isNull(), broken).otherwise(F.array_distinct(_departures(value, schema, "$")))

    found = F.flatten(F.transform(F.array(F.try_parse_json(text)), of_one))
    return F.when(text.isNull(), F.array().cast(DRIFT_TYPE)).otherwise(found).cast(DRIFT_TYPE)


def read_with_drift(
    spark: SparkSession, path: str, schema: StructType, *, corrupt_column: str | None = None, drift_column: str = "drift"
) -> DataFrame:
    """JSON Lines as ``read_documents`` reads them (one object a line), plus ``drift_column``."""
    if drift_column in schema.fieldNames() or drift_column == corrupt_column:
        raise ValueError(f"column {drift_column} is a field of the documents; choose another drift_column")
    options = {"mode": "PERMISSIVE"}
    parsed = StructType([*schema.fields])
    if corrupt_column:
        parsed = parsed.add(corrupt_column, "string")
        options["columnNameOfCorruptRecord"] = corrupt_column
    lines = spark.read.text(path).filter(F.trim("value") != "")
    both = lines.select(F.from_json("value", parsed, options).alias("doc"), departures(F.col("value"), schema).alias(drift_column))
    return both.select("doc.*", "`" + drift_column.replace("`", "``") + "`")


def drift_report(docs: DataFrame, drift_column: str = "drift") -> DataFrame:
    """``path``, ``problem``, ``found`` and the number of ``records`` with that departure."""
    each = docs.select(F.inline("`" + drift_column.replace("`", "``") + "`"))
    return each.groupBy("path", "problem", "found").agg(F.count(F.lit(1)).alias("records"))

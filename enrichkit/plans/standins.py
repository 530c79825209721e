"""Inputs of the country jobs derived by Spark from the given tables.

The reference reads live country documents and a hand-written key list;
neither ships with it. These builders derive equivalents from the TPC-H-like
tables, one document per customer, so their size grows with the data. The
``k % m`` branches only choose which fixture case (NULL, empty, wrong size,
unordered map, ...) a document exercises; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table, tables

CURRENCY_TYPE = "struct<name:string,symbol:string>"


def _case(k: Column, m: int, branches: dict[int, Column], default: Column) -> Column:
    expr = None
    for r, v in branches.items():
        expr = F.when(k % m == r, v) if expr is None else expr.when(k % m == r, v)
    return expr.otherwise(default)


def country_documents(spark: SparkSession, sf_dir: str, *, with_key: bool = False) -> DataFrame:
    """Nested documents shaped like the raw country schema, one per customer.

    ``with_key`` adds the customer key as ``doc_key`` (not a document field).

    Written as SQL expressions: one parse in the JVM instead of hundreds of
    Python -> JVM calls for the nested CASE expressions.
    """
    c, n, r = tables(spark, sf_dir, "customer", "nation", "region")
    # nation and region are small dimension tables; Catalyst broadcasts them
    # after checking their size statistics, no hint needed
    base = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(
        r, n.n_regionkey == r.r_regionkey, "left"
    )
    currency = f"CAST(NULL AS {CURRENCY_TYPE})"
    currency_map = f"map<string,{CURRENCY_TYPE}>"
    k = "c_custkey"
    code = f"CASE WHEN {k} % 13 = 0 THEN NULL ELSE concat('C', CAST({k} AS STRING)) END"
    lat, lon = f"CAST({k} AS DOUBLE) * 1.5D", "CAST(c_nationkey AS DOUBLE) - 10.25D"
    return base.selectExpr(
        "named_struct('common', c_name, 'official', concat('Official ', c_name)) AS name",
        "concat('N', CAST(n_nationkey AS STRING)) AS cca2",
        # a lower-case code never matches an indicator key (unmatched rows)
        f"CASE WHEN {k} % 17 = 0 THEN lower({code}) ELSE {code} END AS cca3",
        f"""CASE WHEN {k} % 4 = 0 THEN CAST(array() AS array<string>)
                 WHEN {k} % 4 = 1 THEN CAST(NULL AS array<string>)
                 WHEN {k} % 4 = 2 THEN array(c_name)
                 ELSE array(n_name, c_name) END AS capital""",
        "r_name AS region",
        f"CASE WHEN {k} % 10 = 0 THEN NULL WHEN {k} % 10 = 5 THEN '' ELSE n_name END AS subregion",
        f"CASE WHEN {k} % 6 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal END AS area",
        f"CASE WHEN {k} % 8 = 3 THEN CAST(NULL AS BIGINT) ELSE {k} END AS population",
        f"""CASE WHEN {k} % 3 = 0 THEN array({lat})
                 WHEN {k} % 3 = 1 THEN array({lat}, {lon})
                 ELSE array({lat}, {lon}, 0.0D) END AS latlng""",
        f"""CASE WHEN {k} % 7 = 0 THEN CAST(NULL AS {currency_map})
                 WHEN {k} % 7 = 1 THEN CAST(map() AS {currency_map})
                 ELSE map_from_arrays(
                   array(lower(c_mktsegment), 'aaa'),
                   array(CASE WHEN {k} % 5 = 0 THEN {currency}
                              ELSE named_struct('name', c_mktsegment,
                                                'symbol', substring(c_mktsegment, 1, 1)) END,
                         named_struct('name', 'Alpha', 'symbol', 'A'))) END AS currencies""",
        *([f"{k} AS doc_key"] if with_key else []),
    )


def write_document_arrays(docs: DataFrame, path: str, per_array: int = 1000, *, indented: bool = False) -> None:
    """Land documents as files that each hold ONE top-level JSON array.

    This is the layout of the reference's raw file, in bounded pieces: at
    most ``per_array`` documents (chunks of ``doc_key``) make an array, and
    ``maxRecordsPerFile`` starts a new file for each one, all in one folder.
    ``indented`` spreads each document over many lines.
    """
    fields = [c for c in docs.columns if c != "doc_key"]
    arrays = docs.groupBy(F.expr(f"doc_key div {int(per_array)}").alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*fields)), {"pretty": str(indented).lower()}).alias("value")
    )
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def broken_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines with undeclared extra fields; every ninth line is cut off (column ``value``)."""
    docs = country_documents(spark, sf_dir, with_key=True)
    fields = [c for c in docs.columns if c != "doc_key"]
    line = F.to_json(F.struct(*fields, F.lit("x").alias("undeclared"), F.struct(F.lit(1).alias("deep")).alias("extra")))
    return docs.select(F.when(F.col("doc_key") % 9 == 0, F.substring(line, 1, 25)).otherwise(line).alias("value"))


def drifting_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, each departing from the declared schema in one of five ways (column ``value``)."""
    docs = country_documents(spark, sf_dir, with_key=True)
    fields = [c for c in docs.columns if c != "doc_key"]
    k = F.col("doc_key")

    def line(*more: Column, **instead: Column) -> Column:
        return F.to_json(F.struct(*[instead.get(c, F.col(c)).alias(c) for c in fields], *more))

    cases = {
        0: line(population=F.col("population").cast("string")),
        1: line(name=F.col("name.common")),
        2: line(F.struct(F.lit(1).alias("deep")).alias("extra"), area=F.when(F.col("area").isNotNull(), F.array("area"))),
    }
    whole = _case(k, 4, cases, line(F.lit(".x").alias("tld")))
    return docs.select(F.when(k % 9 == 0, F.substring(line(), 1, 25)).otherwise(whole).alias("value"))


# Blanks used to pad key-list lines (all removed by str.strip).
PAD_LEFT = ["", " ", "\t", "\u00a0", "\u3000 "]
PAD_RIGHT = ["", " \t", "\x1f", "\x0b"]
BLANK_LINE = " \t "


def padded_lines(keys: DataFrame, key: str, order_key: str) -> DataFrame:
    """Text lines ``pad + key + pad`` plus blank lines, column ``value``."""
    k = F.col(order_key)
    left = _case(k, 5, {i: F.lit(p) for i, p in enumerate(PAD_LEFT)}, F.lit(""))
    right = _case(k, 4, {i: F.lit(p) for i, p in enumerate(PAD_RIGHT)}, F.lit(""))
    line = F.concat(left, F.col(key), right)
    lines = F.when(k % 4 == 0, F.array(line, F.lit(BLANK_LINE), F.lit(""))).otherwise(F.array(line))
    return keys.select(F.explode(lines).alias("value"))


def brand_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key list of part brands (many repeats), padded."""
    return padded_lines(table(spark, sf_dir, "part"), "p_brand", "p_partkey")


def order_code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key list with one customer code per order (repeats = orders per customer)."""
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("code"), "o_orderkey"
    )
    return padded_lines(orders, "code", "o_orderkey")

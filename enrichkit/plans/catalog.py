"""Registered queries: each operator of the inventory applied to the given tables.

Every query reads whole tables (no id subsets, no row caps) so that its work
grows with the data; each has an equivalent SQL text in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import is_not_blank, safe_ratio, strip_text
from ..operators.aggregate import distribution, group_stats, row_count
from ..operators.classify import classify, development_status
from ..operators.generate import ECONOMIC_MEASURES, keyed_indicators
from ..operators.join import left_enrich
from ..operators.nested import drop, flatten_countries, narrow, rename, with_columns
from ..schemas import raw_country_schema
from ..session import scratch_path, shuffle_width
from ..sources.documents import read_documents, write_documents
from ..sources.key_list import read_key_list
from ..sources.tables import conform, publish, read_table, save_table
from ..streaming.documents import start_enrichment
from . import jobs
from .metrics import preview, region_report
from .standins import (
    brand_lines,
    broken_document_lines,
    country_documents,
    drifting_document_lines,
    order_code_lines,
    write_document_arrays,
)
from .tables import TABLES, table, tables

Query = Callable[[SparkSession, str], DataFrame]


# --- flagship: J1 + C5 + A1-A5 + M2 ----------------------------------------

def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order indicators from lineitem (one row per order key)."""
    return _order_measures(table(spark, sf_dir, "lineitem"))


def _order_measures(lineitem: DataFrame) -> DataFrame:
    return (
        lineitem
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum("l_quantity").alias("total_qty"),
            F.max("l_discount").alias("max_discount"),
        )
    )


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders LEFT JOIN per-order measures, classified into size tiers."""
    orders, lineitem = tables(spark, sf_dir, "orders", "lineitem")
    orders = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    joined = left_enrich(orders, _order_measures(lineitem), "o_orderkey", "l_orderkey")
    rules = [
        ((F.col("max_discount") >= 0.08) & (F.col("total_qty") >= 150.0), "large"),
        ((F.col("max_discount") >= 0.06) | (F.col("total_qty") >= 100.0), "medium"),
    ]
    return classify(joined, "order_tier", rules, "small")


def flagship_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_stats(
        enriched_orders(spark, sf_dir),
        ["o_orderstatus", "o_orderpriority"],
        sums={"total_items": "n_items"},
        avgs={
            "avg_totalprice": "o_totalprice",
            "avg_qty": "total_qty",
            "avg_max_discount": "max_discount",
        },
        counts_by_value=(
            "order_tier",
            {"large": "large_orders", "medium": "medium_orders", "small": "small_orders"},
        ),
        count_alias="total_orders",
        rounding={"avg_totalprice": 2, "avg_qty": 2, "avg_max_discount": 3},
    )


# --- sources, nested access, derived columns -------------------------------

def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land nested docs as JSON, scan with schema, flatten."""
    path = scratch_path(spark, "raw_documents")
    write_documents(country_documents(spark, sf_dir), path)
    raw = read_documents(spark, path, raw_country_schema())
    return flatten_countries(raw)


def json_array_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 in the reference's layout: files holding one top-level JSON array,
    read with ``multiLine`` (one task per file), spread, then flattened."""
    path = scratch_path(spark, "raw_arrays")
    write_document_arrays(country_documents(spark, sf_dir, with_key=True), path)
    raw = read_documents(
        spark, path, raw_country_schema(), multi_line=True, partitions=shuffle_width(spark)
    )
    return flatten_countries(raw)


def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over indented arrays, cut by structure so that many tasks share a file, then flattened."""
    path = scratch_path(spark, "raw_indented")
    write_document_arrays(country_documents(spark, sf_dir, with_key=True), path, indented=True)
    return flatten_countries(read_documents(spark, path, raw_country_schema(), multi_line="array"))


def json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with undeclared fields, some cut off: two declared fields and whether the line parsed."""
    path = scratch_path(spark, "broken_lines")
    broken_document_lines(spark, sf_dir).write.mode("overwrite").text(path)
    raw = read_documents(spark, path, raw_country_schema(), fields=["cca3", "population"], corrupt_column="_corrupt")
    return raw.select("cca3", "population", F.col("_corrupt").isNull().alias("parsed"))


def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse a JSON text column under a declared schema, read a field."""
    events = table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k BIGINT")
    return events.select("event_id", "event_type", parsed.getField("k").alias("k"))


def select_rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P4, P9, P10, P11 on customer."""
    c = table(spark, sf_dir, "customer")
    c = rename(c, {"c_custkey": "customer_id", "c_name": "customer_name"})
    c = with_columns(c, {"balance_k": F.col("c_acctbal") / 1000.0, "segment": F.lower("c_mktsegment")})
    c = drop(c, "c_mktsegment")
    return narrow(c, "customer_id", "customer_name", "c_nationkey", "balance_k", "segment")


def safe_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, C4: key per unit of balance, NULL for zero or negative balances."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", safe_ratio("c_custkey", "c_acctbal").alias("ratio"))


# --- joins and classification ----------------------------------------------

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    docs = docs.select("doc_id", "lang", "source", "n_chars")
    labels = labels.withColumnRenamed("doc_id", "label_doc_id")
    return left_enrich(docs, labels, "doc_id", "label_doc_id")


def left_enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents LEFT JOIN labels on differently named keys."""
    return labelled_documents(spark, sf_dir)


def classify_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules under three-valued logic; unlabelled docs get the default."""
    rules = [
        ((F.col("quality") >= 1) & (F.col("toxic") <= 0), "keep"),
        ((F.col("quality") >= 1) | (F.col("toxic") >= 1), "review"),
    ]
    out = classify(labelled_documents(spark, sf_dir), "decision", rules, "unknown")
    return out.select("doc_id", "quality", "toxic", "decision")


def _fanout(spark: SparkSession, sf_dir: str, skew_threshold: int | None) -> DataFrame:
    orders, items = tables(spark, sf_dir, "orders", "lineitem")
    orders = orders.select("o_orderkey", "o_orderstatus")
    items = items.select("l_orderkey", "l_linenumber", "l_quantity")
    return left_enrich(orders, items, "o_orderkey", "l_orderkey", skew_threshold=skew_threshold)


def join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with fan-out: one row per matching line item, unmatched orders kept once."""
    return _fanout(spark, sf_dir, None)


def join_fanout_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 through the hot-key cells (orders with >= 4 items are hot)."""
    return _fanout(spark, sf_dir, 4)


def join_hot_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with a third of the left keys NULL and a third one hot key, both dealt over many tasks."""
    items, nation = tables(spark, sf_dir, "lineitem", "nation")
    part = F.col("l_orderkey") % 3
    key = F.when(part == 0, None).when(part == 1, 7).otherwise(F.col("l_suppkey") % 40)
    left = items.select("l_orderkey", "l_linenumber", key.cast("bigint").alias("k"))
    right = nation.select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")
    return left_enrich(left, right, "k", "k", skew_threshold=1000)


# --- aggregation ------------------------------------------------------------

def round_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A3, M2: rounded averages per brand."""
    return group_stats(
        table(spark, sf_dir, "part"),
        ["p_brand"],
        avgs={"avg_price": "p_retailprice", "avg_size": "p_size"},
        count_alias=None,
        rounding={"avg_price": 2, "avg_size": 3},
    )


def exact_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A3, M2: sums and averages of doubles rounded once from the exact sum, whatever the partitioning."""
    items = table(spark, sf_dir, "lineitem")
    return group_stats(
        items.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        ["l_returnflag", "l_linestatus"],
        sums={"sum_net": "net"},
        avgs={"avg_net": "net", "avg_price": "l_extendedprice"},
        count_alias="n_items",
        rounding={"sum_net": 2, "avg_net": 3, "avg_price": 3},
        exact=True,
    )


def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A5: one counter column per status value, per priority."""
    return group_stats(
        table(spark, sf_dir, "orders"),
        ["o_orderpriority"],
        counts_by_value=("o_orderstatus", {"F": "n_f", "O": "n_o", "P": "n_p"}),
        count_alias="n_orders",
    )


def distribution_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event type."""
    return distribution(table(spark, sf_dir, "events"), "event_type")


def row_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every given table; each scan reads no column and is counted map-side."""
    counts = [row_count(t).select(F.lit(n).alias("table_name"), "n_rows") for n, t in zip(TABLES, tables(spark, sf_dir, *TABLES))]
    return reduce(DataFrame.unionByName, counts)


# --- generation and key lists -----------------------------------------------

def keyed_uniform_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeatable indicators for every part brand occurrence."""
    keys = table(spark, sf_dir, "part").select("p_brand")
    return keyed_indicators(keys, "p_brand", ECONOMIC_MEASURES, out_key="code", keep_occurrence=True)


def key_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded key lines as text -> stripped keys -> counts."""
    path = scratch_path(spark, "key_list")
    brand_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return distribution(read_key_list(spark, path, "value"), "value")


# --- stored tables ----------------------------------------------------------

def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a stored table, then scan it back."""
    path = scratch_path(spark, "orders_copy")
    save_table(table(spark, sf_dir, "orders"), path)
    return read_table(spark, path)


def publish_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the enriched orders, publish an unchanged copy, read it."""
    src, dst = scratch_path(spark, "enriched_orders"), scratch_path(spark, "report")
    save_table(enriched_orders(spark, sf_dir), src)
    return publish(spark, src, dst)


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conform order rows to a declared schema, NOT NULL for a key, a date, a decimal and a timestamp."""
    schema = (
        "o_orderkey BIGINT NOT NULL, o_orderstatus STRING, price DECIMAL(18,2) NOT NULL, "
        "day DATE NOT NULL, at TIMESTAMP_NTZ NOT NULL"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("at"),
    )
    typed = conform(orders, StructType.fromDDL(schema))
    # spelled out, as clients differ in how they show decimals and dates
    return typed.select("o_orderkey", "o_orderstatus", *[F.col(c).cast("string").alias(c) for c in ("price", "day", "at")])


def preview_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: first ten orders by key (a top-n, not a sort of everything)."""
    return preview(table(spark, sf_dir, "orders"), 10, order_by=["o_orderkey"])


# --- the composed country jobs ----------------------------------------------

def _land_inputs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the derived documents (JSON Lines) and key list (text) in parallel."""
    docs_path, codes_path = scratch_path(spark, "docs"), scratch_path(spark, "codes")
    with ThreadPoolExecutor(max_workers=2) as pool:
        docs = pool.submit(write_documents, country_documents(spark, sf_dir), docs_path)
        codes = pool.submit(
            lambda: order_code_lines(spark, sf_dir).write.mode("overwrite").text(codes_path)
        )
        docs.result()
        codes.result()
    return docs_path, codes_path


def _enriched(spark: SparkSession, sf_dir: str) -> jobs.JobResult:
    """E1, E2 and E3 over the landed inputs."""
    docs_path, codes_path = _land_inputs(spark, sf_dir)
    processed, indicators, enriched = (scratch_path(spark, n) for n in ("processed", "indicators", "enriched"))
    with ThreadPoolExecutor(max_workers=2) as pool:
        first = pool.submit(jobs.process_documents, spark, docs_path, processed)
        second = pool.submit(jobs.build_indicators, spark, codes_path, indicators)
        first.result()
        second.result()
    return jobs.enrich(spark, processed, indicators, enriched)


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "regional_stats")
    jobs.aggregate_regions(spark, _enriched(spark, sf_dir).path, out, report_rows=0)
    return read_table(spark, out)


def regional_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents + key list -> processed, indicators, enriched, stats."""
    return _regional(spark, sf_dir)


def region_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: the whole per-group report of the stored statistics, ordered."""
    return region_report(_regional(spark, sf_dir))


def country_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published enriched table, one row per (country, indicator line)."""
    out = scratch_path(spark, "report")
    jobs.publish_report(spark, _enriched(spark, sf_dir).path, out, preview_rows=0)
    return read_table(spark, out)


def batch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 by batch: a third of the enriched rows, then two thirds (the first replaced), then all, each read once."""
    rows = read_table(spark, _enriched(spark, sf_dir).path)
    third = F.pmod(F.crc32(F.coalesce("country_code_3", F.lit(""))), F.lit(3))
    batches = {f"part {i}": rows.filter(third == i) for i in range(3)}
    partials, out = scratch_path(spark, "partials"), scratch_path(spark, "regional_stats")
    jobs.aggregate_batches(spark, {"part 0": batches["part 1"]}, partials, out)
    jobs.aggregate_batches(spark, {n: batches[n] for n in ("part 0", "part 1")}, partials, out, replace=["part 0"])
    jobs.aggregate_batches(spark, batches, partials, out)
    return read_table(spark, out)


def quarantined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of the processed table (no reason) and the quarantined ones, with their reasons."""
    path, out, bad = (scratch_path(spark, n) for n in ("broken_lines", "processed", "quarantine"))
    broken_document_lines(spark, sf_dir).write.mode("overwrite").text(path)
    jobs.process_documents(spark, path, out, quarantine=bad, required=["country_code_3", "area"], max_bad_share=0.5)
    columns = ["common_name", "country_code_3", "population", "area"]
    held = read_table(spark, bad).select(
        *[F.when(F.col("record").isNull(), F.col(c)).alias(c) for c in columns], F.array_join("reasons", "; ").alias("reasons")
    )
    return read_table(spark, out).select(*columns, F.lit(None).cast("string").alias("reasons")).unionByName(held)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared and wrong-typed fields of the documents, counted in the scan that flattens them."""
    path, out, drift = (scratch_path(spark, n) for n in ("drifting_lines", "processed", "drift"))
    drifting_document_lines(spark, sf_dir).write.mode("overwrite").text(path)
    jobs.process_documents(spark, path, out, drift=drift)
    return read_table(spark, drift)


def resumed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 with resume: half of the documents, then all of them; the counts of the second run and what it kept."""
    docs_path, codes_path = scratch_path(spark, "docs"), scratch_path(spark, "codes")
    docs = country_documents(spark, sf_dir, with_key=True)
    order_code_lines(spark, sf_dir).write.mode("overwrite").text(codes_path)
    work = scratch_path(spark, "job")
    for half in (0, 1):
        docs.filter(F.col("doc_key") % 2 == half).drop("doc_key").write.mode("append").json(docs_path)
        done = jobs.run_all(spark, docs_path, codes_path, work, resume=True)
    rows = [(job, name, int(done[job].metrics[name])) for job, name in JOB_COUNTS]
    rows += [(job, "reused", int(result.reused)) for job, result in done.items()]
    return spark.createDataFrame(rows, "job string, metric string, n bigint")


def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the composed jobs observed during their writes, as rows."""
    docs_path, codes_path = _land_inputs(spark, sf_dir)
    done = jobs.run_all(spark, docs_path, codes_path, scratch_path(spark, "job"))
    rows = [(job, name, int(done[job].metrics[name])) for job, name in JOB_COUNTS]
    return spark.createDataFrame(rows, "job string, metric string, n bigint")


JOB_COUNTS = (
    ("processed", "rows"),
    ("processed", "corrupt"),
    ("indicators", "rows"),
    ("indicators", "keys"),
    ("indicators", "max_per_key"),
    ("enriched", "left_rows"),
    ("enriched", "right_rows"),
    ("enriched", "rows"),
    ("enriched", "developed"),
    ("enriched", "emerging"),
    ("enriched", "developing"),
    ("regional_stats", "rows"),
)


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E3 as a Structured Streaming query over landed document files."""
    docs_path, codes_path = _land_inputs(spark, sf_dir)
    indicators_path = scratch_path(spark, "indicators")
    jobs.build_indicators(spark, codes_path, indicators_path)
    out, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    query = start_enrichment(spark, docs_path, read_table(spark, indicators_path), out, ckpt)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.parquet(out)


def key_list_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 alone: padded key list as text -> stripped codes -> indicator table."""
    codes_path, out = scratch_path(spark, "codes"), scratch_path(spark, "indicators")
    order_code_lines(spark, sf_dir).write.mode("overwrite").text(codes_path)
    jobs.build_indicators(spark, codes_path, out)
    return read_table(spark, out)


def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6, Q2 over one lazy plan: documents -> flatten -> LEFT JOIN indicators
    -> development status -> rows per status (no intermediate table)."""
    processed = flatten_countries(country_documents(spark, sf_dir))
    codes = order_code_lines(spark, sf_dir).select(F.col("value").alias("line"))
    codes = codes.select(strip_text("line").alias("code")).filter(is_not_blank(F.col("code")))
    indicators = keyed_indicators(codes, "code", ECONOMIC_MEASURES, out_key="country_code_3_econ")
    enriched = development_status(
        left_enrich(
            processed, indicators, "country_code_3", "country_code_3_econ",
            skew_threshold=jobs.DEFAULT_SKEW_THRESHOLD,
            right_keys=codes.select(F.col("code").alias("country_code_3_econ")),
        )
    )
    return distribution(enriched, "development_status")


def queries() -> dict[str, Query]:
    return {
        "flagship_group_stats": flagship_group_stats,
        "json_flatten": json_flatten,
        "json_array_flatten": json_array_flatten,
        "json_array_split": json_array_split,
        "json_corrupt": json_corrupt,
        "json_column": json_column,
        "select_rename_drop": select_rename_drop,
        "safe_ratio": safe_ratio_query,
        "left_enrich": left_enrich_query,
        "classify_nulls": classify_nulls,
        "join_fanout": join_fanout,
        "join_fanout_salted": join_fanout_salted,
        "join_hot_left": join_hot_left,
        "round_avg": round_avg,
        "exact_stats": exact_stats,
        "pivot_counts": pivot_counts,
        "distribution": distribution_query,
        "row_count": row_count_query,
        "keyed_uniform": keyed_uniform_query,
        "key_list": key_list_query,
        "table_roundtrip": table_roundtrip,
        "publish_copy": publish_copy,
        "typed_rows": typed_rows,
        "preview": preview_query,
        "regional_rollup": regional_rollup,
        "region_report": region_report_query,
        "country_report": country_report,
        "batch_rollup": batch_rollup,
        "quarantined_documents": quarantined_documents,
        "schema_drift": schema_drift,
        "job_counts": job_counts,
        "resumed_counts": resumed_counts,
        "stream_enrich": stream_enrich,
        "key_list_indicators": key_list_indicators,
        "status_distribution": status_distribution,
    }

"""The registered queries: every operator on its whole table, as digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    conversations,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    packing,
    resample,
    simhash,
    suffix_dedup,
    token_count,
    toxicity,
    warc,
)
from ._common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "row.doc_id",
        F.col("out.n_words").alias("n_words"),
        F.col("out.n_hit").alias("n_hit"),
        F.size("out.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("out.item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        F.col("out.contaminated").alias("contaminated"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.clusters(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    kept = F.coalesce("text", F.lit("")).cast("binary")
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])
    n = F.col("out.n_tokens")
    return found.select("row.doc_id", "out.n_bytes", "out.n_tokens", (n > 1024).alias("over_limit"))


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(packing.token_lengths(docs, path, public_tokenizers.PATTERN))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: license_scan.licence_of(m["template"]))))
    return found.select(
        "row.doc_id",
        "n_words",
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: m["template"]), ",").alias("templates"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("containment"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.learn(docs), keep=["doc_id"])
    return found.select(
        "row.doc_id", language_id.held_out(F.col("row.doc_id")).alias("held_out"), "out.lang_pred", "out.score"
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    warc.write_archives(spark, f"{sf_dir.rstrip('/')}/pages.parquet", out)
    found = warc.captures(warc.read_records(spark, out))
    kind = F.col("capture.type")
    return found.select(
        F.get("metadata", F.lit(0))["page_id"].cast("long").alias("page_id"),
        F.col("original.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        kind.alias("record_type"),
        F.when(kind == "revisit", F.col("original.page_id").cast("long")).alias("refers_to"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        language_id.held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("out.score").alias("score"),
        F.when(F.col("out.score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeated_strings(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "out.n_bytes", "out.n_removed", "out.n_spans", F.sha2("out.kept", 256).alias("kept_sha256")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.report(rows.select(F.col("conv_id").alias("conv")), conversations.damaged(rows))
    return found.withColumnsRenamed({"conv": "conv_id", "digest": "repaired_sha256"})


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = resample.resample(docs, target, keep=["doc_id"])
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Query]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))

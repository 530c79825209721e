"""The training-data pipeline: ``documents`` through five stages, each a written table.

A stage is ``(name, function)``; the function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
Texts changed by a stage keep their row; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.llm import decontaminate, line_dedup, queries, simhash, toxicity
from enrichkit.llm._common import table, written


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents scored 0.5 or more go; trained on the labels as in its query."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: repeated lines go, their documents stay, if only with what is left."""
    found = line_dedup.without_repeats(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of linked fingerprints the smallest id stays."""
    return simhash.one_of_each(docs)


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the contamination rule marks go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every remaining document gets its bucket, batch and slot."""
    return queries.packed(docs)


STAGES = [
    ("toxicity", toxic_documents_out),
    ("line dedup", repeated_lines_out),
    ("SimHash near-dedup", near_duplicates_out),
    ("benchmark decontamination", contaminated_out),
    ("packing", packed),
]

#: The toxicity model, the SimHash groups and the bucket search are not SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

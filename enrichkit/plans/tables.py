"""Access to the given tables by name."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a scale-factor folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Several tables at once: their schema discovery (driver-side footer
    reads) runs concurrently instead of one after another."""
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(names)))) as pool:
        return list(pool.map(lambda n: table(spark, sf_dir, n), names))

"""A third of all key-list lines carry one code: results stay exact and the
hot code's rows are produced by many tasks (E2 + E3 on the given tables)."""

from collections import Counter

from pyspark.sql import functions as F

from enrichkit.operators.classify import development_status
from enrichkit.operators.generate import keyed_indicators
from enrichkit.operators.join import left_enrich
from enrichkit.operators.nested import flatten_countries
from enrichkit.plans.standins import country_documents
from enrichkit.plans.tables import table

from .conftest import SF_ORACLE

HOT = "C1"


def _inputs(spark):
    orders = table(spark, SF_ORACLE, "orders")
    codes = orders.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(HOT))
        .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        .alias("code")
    )
    indicators = keyed_indicators(codes, "code", out_key="country_code_3_econ")
    processed = flatten_countries(country_documents(spark, SF_ORACLE))
    return processed, indicators


def test_hot_code_is_exact_and_spread(spark):
    processed, indicators = _inputs(spark)
    n_hot = indicators.filter(F.col("country_code_3_econ") == HOT).count()
    assert n_hot * 3 >= indicators.count() - 3  # a third of all lines

    def enriched(threshold):
        return development_status(
            left_enrich(processed, indicators, "country_code_3", "country_code_3_econ",
                        skew_threshold=threshold)
        ).select("country_code_3", "gdp_per_capita", "hdi", "development_status")

    salted, plain = enriched(500), enriched(None)
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    assert rows(salted) == rows(plain)

    hot_out = salted.filter(F.col("country_code_3") == HOT)
    per_task = [r[1] for r in hot_out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == n_hot
    assert len(per_task) > 1 and max(per_task) < n_hot

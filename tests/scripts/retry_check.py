"""Run in its own process: a task that fails on its first attempt is retried
and the results equal a run without failures (deterministic operators)."""

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from enrichkit.operators.generate import keyed_indicators  # noqa: E402
from enrichkit.operators.join import left_enrich  # noqa: E402
from enrichkit.session import get_session  # noqa: E402


@F.udf(StringType())
def fail_first_attempt(v):
    # test-only fault injection: the first attempt of partition 0 dies
    tc = TaskContext.get()
    if tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return v


def result(spark, inject):
    keys = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 50).cast("string"))).alias("code")
    ).repartition(4)
    if inject:
        keys = keys.select(fail_first_attempt("code").alias("code"))
    ind = keyed_indicators(keys, "code", out_key="code_econ")
    left = spark.range(60).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("code"))
    left = left.union(spark.createDataFrame([("HOT",)], "code string"))
    out = left_enrich(left, ind, "code", "code_econ", skew_threshold=100)
    return Counter(tuple(r) for r in out.collect())


def main():
    spark = get_session("local[4,3]", shuffle_partitions=4)  # up to 3 attempts per task
    clean, retried = result(spark, False), result(spark, True)
    assert clean == retried, "retried run differs"
    assert sum(clean.values()) == 3000 + 10  # 1000 HOT + 2000 K-rows matched, 10 unmatched lefts
    print("RETRY_OK")
    spark.stop()


if __name__ == "__main__":
    main()

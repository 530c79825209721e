"""Run in its own process: map outputs vanish while the enrich job's last stage runs, its map stage runs
again, and all counts stay those of the tables."""

import glob
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from enrichkit.plans import jobs  # noqa: E402
from enrichkit.session import get_session  # noqa: E402
from enrichkit.sources.tables import save_table  # noqa: E402


def main():
    base = tempfile.mkdtemp(prefix="lost-map-")
    local = os.path.join(base, "local")
    spark = get_session("local[1]", shuffle_partitions=6, extra={
        "spark.local.dir": local, "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.driver.memory": "2g",
    })
    countries = spark.range(600).selectExpr("cast(id as string) common_name", "concat('K', id % 90) country_code_3", "id population")
    save_table(countries.repartition(3), f"{base}/countries")
    econ = spark.range(180).selectExpr("concat('K', id % 60) country_code_3_econ", "cast(id as double) gdp_per_capita", "0.5D hdi")
    save_table(econ.repartition(3), f"{base}/indicators")

    marker = os.path.join(base, "lost")

    @F.udf(BooleanType())
    def lose_map_outputs(v):
        # test-only fault injection: the first task to get here removes all shuffle files
        if not os.path.exists(marker):
            open(marker, "w").close()
            found = glob.glob(f"{local}/**/shuffle_*", recursive=True)
            for f in found:
                os.remove(f)
        return True

    plain = jobs.development_status
    jobs.development_status = lambda df: plain(df).filter(lose_map_outputs("development_status"))
    res = jobs.enrich(spark, f"{base}/countries", f"{base}/indicators", f"{base}/enriched", skew_threshold=None)
    assert os.path.exists(marker), "nothing was lost"
    m = res.metrics
    out = spark.read.parquet(glob.glob(f"{base}/enriched/v*")[0])
    assert m["left_rows"] == 600 and m["right_rows"] == 180, m
    assert m["rows"] == out.count() == 600 + 2 * sum(1 for i in range(600) if i % 90 < 60), m
    assert m["developed"] + m["emerging"] + m["developing"] == m["rows"], m
    print("LOST_MAP_OK")
    spark.stop()


if __name__ == "__main__":
    main()

import json
import os

import pytest
from pyspark.sql import functions as F

from enrichkit.plans import jobs
from enrichkit.plans.metrics import (
    StageError,
    observe,
    preview,
    region_report,
    schema_rows,
    stage,
    status_metrics,
)
from enrichkit.sources.tables import current_path, read_table


def test_observe_counts_in_same_pass(spark, tmp_table):
    df, obs = observe(spark.range(10), "r")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10


def test_status_metrics(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "s string")
    out, obs = observe(df, "s", status_metrics("s", {"a": "n_a", "b": "n_b", "c": "n_c"}))
    out.collect()
    assert obs.get == {"rows": 3, "n_a": 2, "n_b": 1, "n_c": 0}


def test_stage_error_keeps_name_and_cause():
    with pytest.raises(StageError) as info:
        with stage("enrich"):
            raise KeyError("x")
    assert info.value.stage == "enrich" and isinstance(info.value.__cause__, KeyError)


def test_reports(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    assert [r.id for r in preview(df, 3, order_by=["id"]).collect()] == [0, 1, 2]
    assert preview(df, 10).count() == 10
    assert schema_rows(df) == [("id", "bigint", False), ("v", "bigint", False)]


DOCS = [
    {"name": {"common": "A", "official": "A"}, "cca3": "AAA", "region": "R1", "subregion": "S1",
     "area": 10.0, "population": 100, "capital": ["a"], "latlng": [1.0, 2.0]},
    {"name": {"common": "B", "official": "B"}, "cca3": "BBB", "region": "R1", "subregion": "S1",
     "area": 0.0, "population": 50},
    {"name": {"common": "C", "official": "C"}, "cca3": "CCC", "region": "R2", "subregion": None,
     "area": 5.0, "population": 10},
    {"name": {"common": "D", "official": "D"}, "cca3": None, "region": "R2", "subregion": None,
     "population": 1},
]
CODES = ["AAA", "BBB", "BBB ", "ZZZ", "", "\t"]


def test_run_all_end_to_end(spark, tmp_table):
    base = tmp_table("job_inputs").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    os.makedirs(os.path.join(base, "codes"))
    with open(os.path.join(base, "docs", "d.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in DOCS))
    with open(os.path.join(base, "codes", "c.txt"), "w") as f:
        f.write("\n".join(CODES))
    res = jobs.run_all(
        spark, os.path.join(base, "docs"), os.path.join(base, "codes"), os.path.join(base, "out"),
    )
    assert res["processed"].metrics["rows"] == 4
    assert res["indicators"].metrics["rows"] == 4  # duplicates kept, blanks dropped
    assert res["indicators"].metrics["keys"] == 3 and res["indicators"].metrics["max_per_key"] == 2
    assert res["indicators"].metrics["hot_keys"] == 0
    enriched = read_table(spark, res["enriched"].path)
    # BBB occurs twice in the key list -> two enriched rows (fan-out)
    assert enriched.count() == 5 and res["enriched"].metrics["rows"] == 5
    assert res["enriched"].metrics["left_rows"] == 4
    assert res["enriched"].metrics["right_rows"] == 4
    m = res["enriched"].metrics
    assert m["developed"] + m["emerging"] + m["developing"] == 5
    unmatched = enriched.filter(F.col("gdp_per_capita").isNull()).select("development_status").collect()
    assert {r[0] for r in unmatched} == {"Developing"} and len(unmatched) == 2
    stats = {(r.region, r.subregion): r for r in read_table(spark, res["regional_stats"].path).collect()}
    assert stats[("R1", "S1")].total_countries == 3 and stats[("R1", "S1")].total_population == 200
    assert stats[("R2", None)].total_countries == 2
    report = read_table(spark, res["report"].path)
    assert report.schema == enriched.schema and report.count() == 5


def test_process_documents_multiline_array(spark, tmp_table):
    base = tmp_table("ml").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    with open(os.path.join(base, "docs", "all.json"), "w") as f:
        json.dump(DOCS, f, indent=2)
    res = jobs.process_documents(spark, os.path.join(base, "docs"), os.path.join(base, "p"), multi_line=True)
    assert res.metrics["rows"] == 4
    out = read_table(spark, res.path)
    assert out.columns[-1] == "population_density"
    assert {r.country_code_3: r.population_density for r in out.collect()}["AAA"] == 10.0


def test_enrich_refuses_duplicate_codes_on_request(spark, tmp_table):
    from enrichkit.operators.join import DuplicateKeyError
    from enrichkit.schemas import economic_schema
    from enrichkit.sources.tables import save_table, typed_rows

    base = tmp_table("dup")
    countries = spark.createDataFrame([("AAA", 1)], "country_code_3 string, population bigint")
    save_table(countries, base + "/c")
    save_table(typed_rows(spark, [("AAA", 1.0, 0.5), ("AAA", 2.0, 0.6)], economic_schema()), base + "/i")
    with pytest.raises(Exception) as info:
        jobs.enrich(spark, base + "/c", base + "/i", base + "/e", on_duplicate="error")
    assert isinstance(info.value.__cause__, DuplicateKeyError)


def test_aggregate_job_logs_null_totals(spark, tmp_table, caplog):
    import logging

    from enrichkit.sources.tables import save_table

    base = tmp_table("agg")
    rows = [("R", "S", None, None, None, None, "Developing")]
    schema = (
        "region string, subregion string, population bigint, population_density double, "
        "gdp_per_capita double, hdi double, development_status string"
    )
    save_table(spark.createDataFrame(rows, schema), base + "/e")
    with caplog.at_level(logging.INFO, logger="enrichkit"):
        res = jobs.aggregate_regions(spark, base + "/e", base + "/s")
    assert res.metrics["rows"] == 1
    assert any("total population NULL" in m for m in caplog.messages)


def test_job_rerun_keeps_schema_guard(spark, tmp_table):
    from enrichkit.sources.tables import SchemaMismatchError, save_table

    base = tmp_table("rerun")
    rows = [("R", "S", 1, 1.0, 1.0, 0.5, "Developing")]
    schema = (
        "region string, subregion string, population bigint, population_density double, "
        "gdp_per_capita double, hdi double, development_status string"
    )
    save_table(spark.createDataFrame(rows, schema), base + "/e")
    jobs.aggregate_regions(spark, base + "/e", base + "/s", report_rows=0)
    jobs.aggregate_regions(spark, base + "/e", base + "/s", report_rows=0)  # same schema: fine
    save_table(spark.createDataFrame([(1,)], "x int"), base + "/other")
    with pytest.raises(StageError) as info:
        jobs.publish_report(spark, base + "/other", base + "/s", preview_rows=0)
    assert isinstance(info.value.__cause__, SchemaMismatchError)
    jobs.publish_report(spark, base + "/other", base + "/s", preview_rows=0, overwrite_schema=True)


def test_run_all_with_hot_codes_equals_plain(spark, tmp_table):
    from collections import Counter

    base = tmp_table("job_hot").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    os.makedirs(os.path.join(base, "codes"))
    with open(os.path.join(base, "docs", "d.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in DOCS))
    with open(os.path.join(base, "codes", "c.txt"), "w") as f:
        f.write("\n".join(["BBB"] * 9 + ["AAA", "ZZZ"]))
    out = {}
    for threshold in (None, 3):
        res = jobs.run_all(
            spark, os.path.join(base, "docs"), os.path.join(base, "codes"),
            os.path.join(base, f"out{threshold}"), skew_threshold=threshold,
        )
        if threshold:
            assert res["indicators"].metrics["hot_keys"] == 1
        assert res["enriched"].metrics["right_rows"] == 11
        assert res["enriched"].metrics["left_rows"] == 4
        out[threshold] = Counter(tuple(r) for r in read_table(spark, res["enriched"].path).collect())
    assert out[3] == out[None] and sum(out[3].values()) == 12


def test_standalone_enrich_finds_hot_codes_itself(spark, tmp_table):
    base = tmp_table("alone_job").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    os.makedirs(os.path.join(base, "codes"))
    with open(os.path.join(base, "docs", "d.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in DOCS))
    with open(os.path.join(base, "codes", "c.txt"), "w") as f:
        f.write("\n".join(CODES))
    jobs.process_documents(spark, os.path.join(base, "docs"), os.path.join(base, "p"))
    ind = jobs.build_indicators(spark, os.path.join(base, "codes"), os.path.join(base, "i"), hot_threshold=2)
    assert ind.metrics["hot_keys"] == 1
    # rows appended behind the indicator job's back are counted, too
    extra = read_table(spark, ind.path).filter("country_code_3_econ = 'AAA'")
    extra.write.mode("append").parquet(current_path(spark, ind.path))
    res = jobs.enrich(spark, os.path.join(base, "p"), ind.path, os.path.join(base, "e"), skew_threshold=2)
    assert res.metrics["rows"] == 6


INDENTED = json.dumps(DOCS, indent=4)


def test_indented_array_without_multi_line_fails_and_keeps_the_table(spark, tmp_table):
    base = tmp_table("indented").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    with open(os.path.join(base, "docs", "d.json"), "w") as f:
        f.write(INDENTED)
    docs, out = os.path.join(base, "docs"), os.path.join(base, "p")
    res = jobs.process_documents(spark, docs, out, multi_line=True)
    assert res.metrics == {"rows": 4, "corrupt": 0}
    with pytest.raises(StageError, match="multi_line=True"):
        jobs.process_documents(spark, docs, out)
    assert read_table(spark, out).count() == 4


def test_broken_lines_are_counted(spark, tmp_table):
    base = tmp_table("broken").replace("file:", "")
    os.makedirs(os.path.join(base, "docs"))
    with open(os.path.join(base, "docs", "d.json"), "w") as f:
        f.write("\n".join([json.dumps(DOCS[0]), "{broken", json.dumps(DOCS[1])]))
    docs, out = os.path.join(base, "docs"), os.path.join(base, "p")
    assert jobs.process_documents(spark, docs, out).metrics == {"rows": 3, "corrupt": 1}
    assert jobs.process_documents(spark, docs, out, mode="DROPMALFORMED").metrics["rows"] == 2
    with pytest.raises(StageError):
        jobs.process_documents(spark, docs, out, mode="FAILFAST")
    assert read_table(spark, out).count() == 2


def test_region_report_is_whole_and_ordered(spark):
    rows = [("b", "x", 1, 2), (None, "y", 3, None), ("a", None, 5, 6), ("a", "z", 7, 8)]
    df = spark.createDataFrame(rows, "region string, subregion string, total_countries int, total_population int")
    got = [tuple(r) for r in region_report(df.withColumn("more", F.lit(1))).collect()]
    assert got == [(None, "y", 3, None), ("a", None, 5, 6), ("a", "z", 7, 8), ("b", "x", 1, 2)]


def test_concurrent_jobs_keep_their_own_metrics(spark, tmp_table):
    from concurrent.futures import ThreadPoolExecutor

    base = tmp_table("conc").replace("file:", "")
    paths = []
    for i, n in enumerate((3, 7)):
        d = os.path.join(base, f"docs{i}")
        os.makedirs(d)
        with open(os.path.join(d, "d.json"), "w") as f:
            f.write("\n".join(json.dumps(DOCS[0]) for _ in range(n)))
        paths.append((d, os.path.join(base, f"out{i}")))
    with ThreadPoolExecutor(max_workers=2) as pool:
        results = list(pool.map(lambda p: jobs.process_documents(spark, p[0], p[1]), paths))
    assert [r.metrics["rows"] for r in results] == [3, 7]

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from enrichkit.operators.nested import flatten_countries
from enrichkit.plans import jobs
from enrichkit.schemas import raw_country_schema
from enrichkit.sources.documents import read_documents
from enrichkit.sources.drift import departures, drift_report, read_with_drift
from enrichkit.sources.tables import read_table

LINES = [
    json.dumps({"name": {"common": "a", "native": {"x": 1}}, "cca3": "A", "tld": [".a"], "area": 3}),
    json.dumps({"name": {"common": "b", "native": None}, "cca3": "B", "population": 1.5, "area": "big"}),
    json.dumps({"name": "c", "cca3": 3, "latlng": [1, "x", None, "y", 2.5], "population": 2**70}),
    json.dumps({"cca3": "D", "currencies": {"eur": {"name": "E", "iso": 9}, "usd": {"name": "U", "iso": 8}, "x": 5}}),
    json.dumps({"cca3": "E", "name": None, "capital": {"0": "x"}, "latlng": [], "currencies": {}}),
    '{"cca3": "F", "cca3": "G"}',
    '{"cca3": "cut',
    "[1]",
    "",
    "   ",
    json.dumps({"cca3": "H", "a.b": True, "": 1.5}),
    json.dumps({"name": {"common": "fine", "official": "f"}, "cca3": "I", "latlng": [1, 2], "area": 1e3}),
]

DEPARTURES = {
    ("$.name.native", "undeclared", "OBJECT"): 1,
    ("$.name.native", "undeclared", "VOID"): 1,
    ("$.tld", "undeclared", "ARRAY"): 1,
    ("$.population", "wrong type", "DECIMAL"): 2,
    ("$.area", "wrong type", "STRING"): 1,
    ("$.name", "wrong type", "STRING"): 1,
    ("$.cca3", "wrong type", "BIGINT"): 1,
    ("$.latlng[]", "wrong type", "STRING"): 1,
    ("$.currencies{}.iso", "undeclared", "BIGINT"): 1,
    ("$.currencies{}", "wrong type", "BIGINT"): 1,
    ("$.capital", "wrong type", "OBJECT"): 1,
    ("$", "unparsable", None): 2,
    ("$", "wrong type", "ARRAY"): 1,
    ("$.a.b", "undeclared", "BOOLEAN"): 1,
    ("$.", "undeclared", "DECIMAL"): 1,
}


def land(tmp_table, lines):
    path = tmp_table("docs").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "d.json"), "w") as f:
        f.write("\n".join(lines))
    return path


def found(report):
    return {(r.path, r.problem, r.found): r.records for r in report.collect()}


def test_every_departure_is_counted(spark, tmp_table):
    docs = read_with_drift(spark, land(tmp_table, LINES), raw_country_schema())
    assert found(drift_report(docs)) == DEPARTURES
    assert found(drift_report(docs.limit(0))) == {}


def test_documents_are_those_of_the_plain_scan(spark, tmp_table):
    lines = [line for line in LINES if line != "[1]"]  # the scan takes an array as its items
    path, schema = land(tmp_table, lines), raw_country_schema()
    want = flatten_countries(read_documents(spark, path, schema, corrupt_column="_c"), keep=("_c",))
    got = flatten_countries(read_with_drift(spark, path, schema, corrupt_column="_c"), keep=("_c",))
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert schema == raw_country_schema()  # the caller's schema stays as it was


def test_no_departures_where_nothing_is_declared_wrong(spark):
    schema = StructType([StructField("a", LongType()), StructField('q"q', LongType())])
    texts = [(None,), ("null",), ("{}",), ('{"a": null}',), ('{"a": -7, "q\\"q": 1}',)]
    rows = spark.createDataFrame(texts, "t string").select(departures(F.col("t"), schema).alias("d")).collect()
    assert [r.d for r in rows] == [[]] * len(texts)


def test_drift_column_in_the_way(spark):
    with pytest.raises(ValueError, match="drift_column"):
        read_with_drift(spark, "/nowhere", StructType([StructField("drift", LongType())]))


def test_job_keeps_its_table_and_reports(spark, tmp_table):
    path = land(tmp_table, LINES[:7] + LINES[8:])
    plain, out, drift, bad = (tmp_table(n) for n in ("plain", "out", "drift", "bad"))
    jobs.process_documents(spark, path, plain, quarantine=bad)
    done = jobs.process_documents(spark, path, out, quarantine=bad, drift=drift)
    assert sorted(map(str, read_table(spark, out).collect())) == sorted(map(str, read_table(spark, plain).collect()))
    want = {k: n for k, n in DEPARTURES.items() if k != ("$", "wrong type", "ARRAY")}
    assert found(read_table(spark, drift)) == want
    assert done.metrics["drifted"] == 8 and done.metrics["rows"] == 9
    # a later run without departures empties the report; other layouts are refused
    assert jobs.process_documents(spark, land(tmp_table, LINES[-1:]), out, drift=drift).metrics["drifted"] == 0
    assert found(read_table(spark, drift)) == {}
    with pytest.raises(ValueError, match="JSON Lines"):
        jobs.process_documents(spark, path, out, drift=drift, multi_line=True)


def test_plan_is_one_scan_without_python(spark, tmp_table):
    docs = read_with_drift(spark, land(tmp_table, LINES), raw_country_schema())
    plan = drift_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == plan.count("FileScan text") == 1
    assert "Python" not in plan and "partial_count" in plan

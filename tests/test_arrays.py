"""The split read of JSON arrays equals Spark's multi-line reader."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql.types import _parse_datatype_string

from enrichkit.plans import jobs
from enrichkit.sources.arrays import array_records
from enrichkit.sources.documents import read_documents

SCHEMA = "id bigint, s string, a array<string>, m map<string, struct<x:double>>, n struct<t:string>"
NASTY = ["}, {", '],\n[', 'q"uote', "back\\slash", '\\"', "a, b", "[{", "", "é漢🙂,}", "tab\t,", '"', "\\", "\\\\", ",", "/"]


def docs(n):
    for i in range(n):
        t = NASTY[i % len(NASTY)]
        yield {"id": i, "s": t, "a": [t, "}", NASTY[(i + 3) % 15]][: i % 4], "m": {t + "k": {"x": 1.5}} if i % 3 else {}, "n": {"t": t}, "other": [[1, [2]], {}]}


def land(base, texts):
    os.makedirs(base)
    for i, text in enumerate(texts):
        with open(os.path.join(base, f"d{i}.json"), "w") as f:
            f.write(text)


def rows(df):
    return Counter(repr(r) for r in df.collect())


LAYOUTS = {
    "indent 4": lambda d: json.dumps(d, indent=4),
    "indent 1, not ASCII": lambda d: json.dumps(d, indent=1, ensure_ascii=False),
    "a record a line": lambda d: "[" + ",\n".join(map(json.dumps, d)) + "]",
    "comma first": lambda d: "[\n " + "\n, ".join(map(json.dumps, d)) + "\n]\n",
    "several a line": lambda d: "[" + ",".join(json.dumps(x) + "\n" * (i % 3 == 2) for i, x in enumerate(d)) + "]",
    "blank lines": lambda d: "\n\n" + json.dumps(d, indent=2).replace("\n", "\r\n\r\n") + "\n \n",
}


@pytest.mark.parametrize("split", [100, 1000, None])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_equals_the_multi_line_reader(spark, tmp_table, layout, split):
    base = tmp_table("arrays").replace("file:", "")
    land(base, [LAYOUTS[layout](list(docs(n))) for n in (40, 1, 0, 17)])
    want = rows(read_documents(spark, base, _parse_datatype_string(SCHEMA), multi_line=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_documents(spark, base, _parse_datatype_string(SCHEMA), multi_line="array")
        assert rows(got) == want and sum(want.values()) == 58
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_file_is_read_by_many_tasks_without_python(spark, tmp_table):
    base = tmp_table("one_array").replace("file:", "")
    land(base, [json.dumps(list(docs(3000)), indent=4)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        found = array_records(spark, base)
        assert spark.read.text(base).rdd.getNumPartitions() > 8
        assert found.count() == 3000
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "Python" not in plan and "Arrow" not in plan
    # lines and their windows move once, by split; then only the edges of splits
    assert plan.count("hashpartitioning(file") >= 1


def test_damaged_arrays_keep_their_good_records(spark, tmp_table):
    base = tmp_table("damaged").replace("file:", "")
    text = json.dumps(list(docs(9)), indent=4)
    land(base, [text[: len(text) - 60], '[{"id": 1},\n {"id": oops},\n {"id": 3}]', "[]", "", "[\n]"])
    got = read_documents(spark, base, _parse_datatype_string(SCHEMA), multi_line="array", corrupt_column="_corrupt").collect()
    good = sorted(r.id for r in got if r._corrupt is None)
    assert good == sorted([*range(8), 1, 3]) and len(got) == 12


def test_job_reads_an_indented_array(spark, tmp_table):
    base = tmp_table("job_array").replace("file:", "")
    raw = [{"name": {"common": "A", "official": "AA"}, "cca3": "AAA", "population": 5, "area": 2.0}, {"cca3": "BBB"}]
    land(os.path.join(base, "docs"), [json.dumps(raw, indent=4)])
    res = jobs.process_documents(spark, os.path.join(base, "docs"), os.path.join(base, "out"), multi_line="array")
    assert res.metrics == {"rows": 2, "corrupt": 0}

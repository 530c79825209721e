import json
import os

import pytest
from pyspark.sql import functions as F

from enrichkit.plans import jobs
from enrichkit.plans.metrics import StageError
from enrichkit.sources.quarantine import bad_rows, good_rows, with_reasons
from enrichkit.sources.tables import current_path, read_table

GOOD = [{"name": {"common": f"n{i}"}, "cca3": f"C{i}", "area": 2.0, "population": i} for i in range(6)]
LINES = [
    *[json.dumps(d) for d in GOOD],
    '{"name": {"common": "cut',
    json.dumps({"name": {"common": "no code"}, "area": 1.0}),
    json.dumps({"name": {"common": "neither"}}),
    json.dumps({"cca3": "BAD", "area": 1.0, "population": "many"}),  # a wrong type
]


def land(tmp_table, lines):
    path = tmp_table("docs").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "d.json"), "w") as f:
        f.write("\n".join(lines))
    return path


def test_good_and_bad_are_the_input(spark, tmp_table):
    docs, out, bad = land(tmp_table, LINES), tmp_table("out"), tmp_table("bad")
    done = jobs.process_documents(spark, docs, out, quarantine=bad, required=["country_code_3", "area"])
    assert done.metrics == {"rows": 10, "corrupt": 2, "bad": 4}
    good = read_table(spark, out)
    assert sorted(r.common_name for r in good.collect()) == [f"n{i}" for i in range(6)]
    assert "reasons" not in good.columns and "_corrupt_record" not in good.columns
    held = {r.record or r.common_name: r.reasons for r in read_table(spark, bad).collect()}
    assert held == {
        LINES[6]: ["unparsable"], LINES[9]: ["unparsable"],
        "no code": ["country_code_3 is NULL"], "neither": ["country_code_3 is NULL", "area is NULL"],
    }
    assert good.count() + len(held) == len(LINES)


def test_too_many_bad_keep_both_tables(spark, tmp_table):
    out, bad = tmp_table("out"), tmp_table("bad")
    few = land(tmp_table, LINES[:7])
    jobs.process_documents(spark, few, out, quarantine=bad, max_bad_share=0.2)
    before = current_path(spark, out), current_path(spark, bad)
    with pytest.raises(StageError, match="2 of 10 records"):
        jobs.process_documents(spark, land(tmp_table, LINES), out, quarantine=bad, max_bad_share=0.19)
    assert (current_path(spark, out), current_path(spark, bad)) == before
    assert read_table(spark, out).count() == 6 and read_table(spark, bad).count() == 1
    # exactly the share is tolerated, and a run without bad records empties the quarantine
    jobs.process_documents(spark, land(tmp_table, LINES), out, quarantine=bad, max_bad_share=0.2)
    assert read_table(spark, bad).count() == 2
    jobs.process_documents(spark, land(tmp_table, LINES[:6]), out, quarantine=bad)
    assert read_table(spark, bad).count() == 0 and read_table(spark, out).count() == 6


def test_without_bad_records_no_table(spark, tmp_table):
    bad = tmp_table("bad")
    done = jobs.process_documents(spark, land(tmp_table, LINES[:6]), tmp_table("out"), quarantine=bad)
    assert done.metrics["bad"] == 0 and not os.path.exists(bad.replace("file:", ""))


def test_marks(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None), (2, "y")], "a int, `b.c` string")
    marked = with_reasons(df, None, ["a", "b.c"])
    assert sorted(map(str, [r.reasons for r in bad_rows(marked).collect()])) == [
        "['a is NULL', 'b.c is NULL']", "['a is NULL']", "['b.c is NULL']",
    ]
    assert good_rows(marked).collect() == [(2, "y")]
    assert good_rows(with_reasons(df)).count() == 4
    with pytest.raises(ValueError):
        with_reasons(df, None, ["z"])
    with pytest.raises(ValueError):
        with_reasons(df.withColumn("reasons", F.lit(1)))


def test_refuses_modes_that_drop(spark, tmp_table):
    with pytest.raises(ValueError):
        jobs.process_documents(spark, "x", "y", quarantine="z", mode="DROPMALFORMED")
    with pytest.raises(ValueError):
        jobs.process_documents(spark, "x", "y", required=["area"])

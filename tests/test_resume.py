import json
import os
import uuid

import pytest

from enrichkit.plans import jobs, manifest
from enrichkit.plans.metrics import StageError
from enrichkit.sources.tables import append_table, current_path, read_table, table_name

STAGES = ["processed", "indicators", "enriched", "regional_stats", "report"]


def add(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines))


@pytest.fixture
def given(tmp_table):
    base = tmp_table("resume").replace("file:", "")
    docs, codes = os.path.join(base, "docs"), os.path.join(base, "codes")
    add(docs, "1.json", [json.dumps({"cca3": c, "region": "R", "population": 1}) for c in ("AAA", "BBB")])
    add(codes, "1.txt", ["AAA", "AAA", "CCC"])
    return docs, codes, os.path.join(base, "work")


def kept(results):
    return [n for n in STAGES if results[n].reused]


def test_only_what_changed_runs_again(spark, given):
    docs, codes, work = given
    first = jobs.run_all(spark, docs, codes, work, resume=True)
    assert kept(first) == []
    again = jobs.run_all(spark, docs, codes, work, resume=True)
    assert kept(again) == STAGES
    assert {n: r.metrics for n, r in again.items()} == {n: r.metrics for n, r in first.items()}
    add(docs, "2.json", [json.dumps({"cca3": "CCC"})])
    changed = jobs.run_all(spark, docs, codes, work, resume=True)
    assert kept(changed) == ["indicators"] and changed["enriched"].metrics["rows"] == 4
    # other parameters of E2 and E3
    assert kept(jobs.run_all(spark, docs, codes, work, resume=True, skew_threshold=2)) == ["processed"]
    # a table that is no longer as its stage left it
    report = current_path(spark, changed["report"].path)
    append_table(read_table(spark, changed["report"].path).limit(1), changed["report"].path)
    last = jobs.run_all(spark, docs, codes, work, resume=True, skew_threshold=2)
    assert kept(last) == STAGES[:4] and current_path(spark, last["report"].path) != report
    assert read_table(spark, last["report"].path).count() == 4


def test_goes_on_behind_a_failed_stage(spark, given, monkeypatch):
    docs, codes, work = given

    def fails(*args, **kwargs):
        raise StageError("aggregate_regions", RuntimeError("driver lost"))

    with monkeypatch.context() as m:
        m.setattr(jobs, "aggregate_regions", fails)
        m.setattr(jobs, "publish_report", fails)
        with pytest.raises(StageError):
            jobs.run_all(spark, docs, codes, work, resume=True)
    # another program, whose catalog knows no tables
    for name in STAGES[:3]:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(os.path.join(work, name))}")
    results = jobs.run_all(spark, docs, codes, work, resume=True)
    assert kept(results) == STAGES[:3]
    assert read_table(spark, results["regional_stats"].path).collect()[0].total_countries == 3


def test_without_resume_all_runs_and_notes_are_void(spark, given):
    docs, codes, work = given
    jobs.run_all(spark, docs, codes, work, resume=True)
    assert kept(jobs.run_all(spark, docs, codes, work)) == []
    assert kept(jobs.run_all(spark, docs, codes, work, resume=True)) == []  # its tables are others


def test_retries(spark, given, monkeypatch):
    docs, codes, work = given
    calls, real = [], jobs.process_documents

    def flaky(*args, **kwargs):
        calls.append(uuid.uuid4())
        if len(calls) < 3:
            raise StageError("process_documents", OSError("lost"))
        return real(*args, **kwargs)

    monkeypatch.setattr(jobs, "process_documents", flaky)
    with pytest.raises(StageError):
        jobs.run_all(spark, docs, codes, work, retries=1)
    calls.clear()
    assert jobs.run_all(spark, docs, codes, work, retries=2)["processed"].metrics["rows"] == 2
    assert len(calls) == 3


def test_marks(spark, given):
    docs, _, work = given
    first = manifest.files_mark(spark, docs)
    assert first == manifest.files_mark(spark, docs)
    add(docs, "2.json", ["{}"])
    assert manifest.files_mark(spark, docs) != first
    assert manifest.files_mark(spark, work) is None and manifest.table_mark(spark, work) is None

"""Plan-shape tests: no Python UDFs, pruned scans, one scan per input."""

import re

import pytest

import __spark_entry__ as ent
from enrichkit.plans import catalog, jobs, oracle

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_or_cross_join_in_plans(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_reads_only_needed_columns(spark):
    plan = _plan(catalog.flagship_group_stats(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == [
        "l_orderkey:bigint,l_quantity:double,l_discount:double",
        "o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string",
    ]
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_preview_is_top_n_not_full_sort(spark):
    plan = _plan(catalog.preview_query(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_entry_contract(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(ent.queries()) and set(ent.oracle_sql()) <= set(ent.queries())


def test_flagship_at_scale_reuses_the_aggregate_partitioning(spark):
    # at 100 TB the per-order lineitem aggregate is far above the broadcast
    # threshold: simulate that and check the sort-merge plan shuffles only
    # three times (lineitem partials by key, orders by key, final groups)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(catalog.flagship_group_stats(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 3


def test_occurrence_spreading_uses_a_fixed_width(spark):
    plan = _plan(catalog.keyed_uniform_query(spark, SF_SMALL))
    # the chunk descriptors move through an explicit-width repartition,
    # which AQE never coalesces back into one task
    assert "REPARTITION_BY_NUM" in plan
    assert re.search(r"hashpartitioning\(p_brand#\d+, __ek_chunk#\d+L?, \d+\), REPARTITION_BY_NUM", plan)


def _executed(spark, action) -> list[str]:
    """The plans of all queries that an action runs, as they were executed."""
    plans = []
    store = spark._jsparkSession.sharedState().statusStore()
    before = {e.executionId() for e in _seq(spark, store.executionsList())}
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    for e in _seq(spark, store.executionsList()):
        if e.executionId() not in before:
            plans.append(e.physicalPlanDescription())
    return plans


def _seq(spark, seq):
    return list(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(seq))


def test_written_jobs_keep_the_plans_wanted_at_scale(spark, tmp_table):
    """E1-E5 with broadcasts off: the plans of their writes, not of the final read."""
    docs, codes = catalog._land_inputs(spark, SF_SMALL)
    out = {k: tmp_table(k) for k in ("p", "i", "e", "s", "r")}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = {
            "E1": _executed(spark, lambda: jobs.process_documents(spark, docs, out["p"])),
            "E2": _executed(spark, lambda: jobs.build_indicators(spark, codes, out["i"])),
            "E3": _executed(spark, lambda: jobs.enrich(spark, out["p"], out["i"], out["e"])),
            "E4": _executed(spark, lambda: jobs.aggregate_regions(spark, out["e"], out["s"], report_rows=0)),
            "E5": _executed(spark, lambda: jobs.publish_report(spark, out["e"], out["r"], preview_rows=0)),
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    writes = {k: [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p] for k, plans in run.items()}
    everything = "".join(p for plans in run.values() for p in plans)
    assert not any(node in everything for node in (*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin"))
    assert len(writes["E1"]) == 1 and "Exchange" not in writes["E1"][0]
    assert writes["E3"] and "SortMergeJoin" in writes["E3"][-1] and "BroadcastHashJoin" not in writes["E3"][-1]
    assert len(writes["E4"]) == 1 and "partial_sum" in writes["E4"][0]
    read = re.findall(r"ReadSchema: struct<([^>]*)>", writes["E4"][0])
    assert read and all("common_name" not in r and "latitude" not in r for r in read)  # pruned
    assert len(writes["E5"]) == 1 and "Exchange" not in writes["E5"][0]

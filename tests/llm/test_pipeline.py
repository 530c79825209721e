"""The pipeline against brute-force versions of its stages, each judged on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from enrichkit.llm import toxicity
from enrichkit.llm._common import table, written

from .edge import ROWS
from .test_decontaminate import brute as brute_contamination
from .test_line_dedup import brute as brute_lines
from .test_packing import check as check_packing
from .test_simhash import brute_components, fingerprint

SF = "/root/testdata/sf0.001"


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def edge_documents(spark, columns):
    rows = [(i, t, g, "s", len(t or "")) for i, t, g in ROWS] + [(50, "you idiot, you moron, you worthless scum", "en", "s", 40)]
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("edge", [False, True])
def test_every_stage(spark, edge):
    docs = table(spark, SF, "documents")
    if edge:
        docs = written(edge_documents(spark, docs.schema).withColumn("row", F.lit(1)).withColumn("out", F.lit("x")), "edge-docs")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = pairs(docs)
        after = written(stage(spark, docs, SF), "stage")
        if name == "packing":
            lengths = [(r["doc_id"], r["n_tokens"]) for r in after.collect()]
            assert sorted((i for i, _ in lengths), key=repr) == sorted((i for i, _ in before), key=repr)
            check_packing(lengths, after.collect(), 16_384)
            break
        assert after.columns == columns
        got = pairs(after)
        if name == "toxicity":
            model = toxicity.learn(docs, table(spark, SF, "labels"))
            judged = toxicity.score(docs, model).filter("out.score < 0.5").select("row.*")
            assert got == pairs(judged)
            if edge:
                assert not any(i == 50 for i, _ in got) and len(got) == len(before) - 1
        elif name == "line dedup":
            want = [(i, t) for i, _, _, t in brute_lines(before)]
            assert got == sorted(want, key=repr)
            assert after.filter(F.col("n_chars") != F.length("text")).isEmpty()
        elif name == "SimHash near-dedup":
            label = brute_components([fingerprint(t) for _, t in before], 3)
            groups = {}
            for pair, own in zip(before, label, strict=True):
                groups.setdefault(own, []).append(pair)
            assert len(got) == len(groups)
            ids = sorted((min((i for i, _ in g if i is not None), default=None) for g in groups.values()), key=repr)
            assert sorted((i for i, _ in got), key=repr) == ids
            assert set(got) <= set(before)
        else:
            assert name == "benchmark decontamination"
            assert got == [(i, t) for i, t in before if not brute_contamination(t, items, 13)[3]]
        docs = after


def test_run_is_the_stages_one_after_the_other(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
    assert sorted(map(tuple, got)) == sorted(map(tuple, docs.collect()))


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.count() == 0

import json
import os

from enrichkit.schemas import economic_schema
from enrichkit.sources.tables import typed_rows
from enrichkit.streaming import start_enrichment

DOCS = [
    {"name": {"common": "A", "official": "A"}, "cca3": "AAA", "region": "R", "area": 2.0, "population": 10},
    {"name": {"common": "B", "official": "B"}, "cca3": "BBB", "region": "R", "area": 0.0, "population": 5},
]


def test_stream_enrichment_appends_and_resumes(spark, tmp_table):
    base = tmp_table("stream").replace("file:", "")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    indicators = typed_rows(
        spark, [("AAA", 30000.0, 0.9), ("AAA", 500.0, 0.5)], economic_schema()
    )
    with open(os.path.join(src, "1.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in DOCS))
    q = start_enrichment(spark, src, indicators, out, ckpt)
    q.awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.country_code_3, r.development_status) for r in rows) == [
        ("AAA", "Developed"), ("AAA", "Developing"), ("BBB", "Developing"),
    ]
    assert [r.population_density for r in rows if r.country_code_3 == "BBB"] == [None]
    # a second run only picks up the new file
    with open(os.path.join(src, "2.json"), "w") as f:
        f.write(json.dumps({"cca3": "CCC", "population": 1}))
    q = start_enrichment(spark, src, indicators, out, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_stream_with_salted_join_matches_batch(spark, tmp_table):
    from collections import Counter

    base = tmp_table("stream_salted").replace("file:", "")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "1.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in DOCS))
    indicators = typed_rows(
        spark, [("AAA", float(i), 0.5) for i in range(30)] + [("BBB", 1.0, 0.9)], economic_schema()
    )
    outs = {}
    for threshold in (None, 4):
        out = os.path.join(base, f"out{threshold}")
        q = start_enrichment(
            spark, src, indicators, out, os.path.join(base, f"ck{threshold}"), skew_threshold=threshold
        )
        q.awaitTermination()
        outs[threshold] = Counter(
            (r.country_code_3, r.gdp_per_capita, r.development_status)
            for r in spark.read.parquet(out).collect()
        )
    assert outs[4] == outs[None] and sum(outs[4].values()) == 31

"""The registered queries equal their DuckDB SQL, and their schemas are those of the contract."""

import duckdb
import pytest

from enrichkit.llm import oracle, queries
from enrichkit.plans.tables import TABLES

SF = "/root/testdata/sf0.001"


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(v[i] for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(oracle.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


CONTRACT = {
    1: "doc_id bigint n_words bigint n_hit bigint n_items bigint items_sha256 string contaminated boolean",
    2: "doc_id bigint keep_id bigint group_size bigint kept boolean text_sha256 string",
    3: "doc_id bigint fingerprint string component_id bigint",
    4: "doc_id bigint n_lines bigint n_dropped bigint kept_sha256 string",
    5: "doc_id bigint n_bytes bigint n_tokens bigint over_limit boolean",
    8: "doc_id bigint held_out boolean lang_pred string score double",
    9: "page_id bigint payload_bytes bigint payload_digest string record_type string refers_to bigint",
    10: "doc_id bigint held_out boolean score double predicted int",
    11: "doc_id bigint n_bytes bigint n_removed bigint n_spans bigint kept_sha256 string",
    12: "conv_id bigint gaps bigint blank bigint duplicate bigint truncated bigint illegal bigint cost bigint audit string "
    "repaired_sha256 string",
    13: "doc_id bigint n_features bigint weight bigint score bigint rank bigint",
}


@pytest.mark.parametrize("n", sorted(CONTRACT))
def test_columns_of_the_contract(spark, n):
    name = next(q for q in queries.queries() if q.startswith(f"op{n}_"))
    df = queries.queries()[name](spark, SF)
    assert " ".join(f"{a} {b}" for a, b in df.dtypes) == CONTRACT[n]
    table = {9: "pages", 12: "conversations"}.get(n, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    assert df.count() == (rows.select("conv_id").distinct() if n == 12 else rows).count()

"""DuckDB SQL equivalents of the registered queries (same column names).

Spark rounds a double HALF_UP on its decimal text (1.005 -> 1.01) while a
binary round in DuckDB gives 1.0, so every rounded value goes through
``DECIMAL(38,12)`` first (``_r``).
"""

from __future__ import annotations


def _r(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


ENRICHED_ORDERS = """
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
         i.n_items, i.total_qty, i.max_discount,
         CASE WHEN i.max_discount >= 0.08::DOUBLE AND i.total_qty >= 150.0::DOUBLE THEN 'large'
              WHEN i.max_discount >= 0.06::DOUBLE OR i.total_qty >= 100.0::DOUBLE THEN 'medium'
              ELSE 'small' END AS order_tier
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS total_qty,
                    max(l_discount) AS max_discount
             FROM lineitem GROUP BY l_orderkey) i
    ON o.o_orderkey = i.l_orderkey
"""

FLAGSHIP = f"""
WITH e AS ({ENRICHED_ORDERS})
SELECT o_orderstatus, o_orderpriority,
       CAST(sum(n_items) AS BIGINT) AS total_items,
       {_r('avg(o_totalprice)', 2)} AS avg_totalprice,
       {_r('avg(total_qty)', 2)} AS avg_qty,
       {_r('avg(max_discount)', 3)} AS avg_max_discount,
       CAST(sum(CASE WHEN order_tier = 'large' THEN 1 ELSE 0 END) AS BIGINT) AS large_orders,
       CAST(sum(CASE WHEN order_tier = 'medium' THEN 1 ELSE 0 END) AS BIGINT) AS medium_orders,
       CAST(sum(CASE WHEN order_tier = 'small' THEN 1 ELSE 0 END) AS BIGINT) AS small_orders,
       count(*) AS total_orders
FROM e GROUP BY o_orderstatus, o_orderpriority
"""


def _uniform(key: str, occ: str, low: float, high: float, seed: int, name: str) -> str:
    text = f"concat_ws(':', '{seed}', '{name}', {key}, CAST({occ} AS VARCHAR))"
    bits = f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"
    return (
        f"({low!r}::DOUBLE + ({high!r}::DOUBLE - {low!r}::DOUBLE) "
        f"* (CAST({bits} AS DOUBLE) / 4294967296.0::DOUBLE))"
    )


def _indicators(key: str, occ: str) -> str:
    return (
        f"{_uniform(key, occ, 1000.0, 100000.0, 42, 'gdp_per_capita')} AS gdp_per_capita, "
        f"{_uniform(key, occ, 0.4, 0.99, 42, 'hdi')} AS hdi"
    )


PROCESSED_DOCS = """
  WITH b AS (
    SELECT c.c_custkey AS k, c.c_name, c.c_acctbal, c.c_mktsegment, c.c_nationkey,
           n.n_nationkey, n.n_name, r.r_name
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
  f AS (
    SELECT c_name AS common_name,
           'Official ' || c_name AS official_name,
           'N' || CAST(n_nationkey AS VARCHAR) AS country_code_2,
           CASE WHEN k % 13 = 0 THEN NULL
                WHEN k % 17 = 0 THEN 'c' || CAST(k AS VARCHAR)
                ELSE 'C' || CAST(k AS VARCHAR) END AS country_code_3,
           r_name AS region,
           CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 5 THEN '' ELSE n_name END AS subregion,
           CASE WHEN k % 4 IN (0, 1) THEN NULL WHEN k % 4 = 2 THEN c_name ELSE n_name END
             AS capital_city,
           CASE WHEN k % 8 = 3 THEN NULL ELSE k END AS population,
           CASE WHEN k % 6 = 0 THEN NULL ELSE c_acctbal END AS area,
           CASE WHEN k % 3 = 1 THEN CAST(k AS DOUBLE) * 1.5::DOUBLE END AS latitude,
           CASE WHEN k % 3 = 1 THEN CAST(c_nationkey AS DOUBLE) - 10.25::DOUBLE END AS longitude,
           CASE WHEN k % 7 IN (0, 1) THEN NULL ELSE lower(c_mktsegment) END AS currency_code,
           CASE WHEN k % 7 IN (0, 1) OR k % 5 = 0 THEN NULL ELSE c_mktsegment END AS currency_name
    FROM b)
  SELECT *, CASE WHEN area > 0 THEN population / area END AS population_density FROM f
"""

ORDER_INDICATORS = f"""
  SELECT code AS country_code_3_econ, {_indicators('code', 'occ')}
  FROM (SELECT code, row_number() OVER (PARTITION BY code) AS occ
        FROM (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS code FROM orders))
"""

ENRICHED_COUNTRIES = f"""
  SELECT d.*, e.gdp_per_capita, e.hdi,
         CASE WHEN e.hdi >= 0.8::DOUBLE AND e.gdp_per_capita >= 20000::DOUBLE THEN 'Developed'
              WHEN e.hdi >= 0.7::DOUBLE OR e.gdp_per_capita >= 12000::DOUBLE THEN 'Emerging'
              ELSE 'Developing' END AS development_status
  FROM ({PROCESSED_DOCS}) d
  LEFT JOIN ({ORDER_INDICATORS}) e ON d.country_code_3 = e.country_code_3_econ
"""

REGIONAL_ROLLUP = f"""
SELECT region, subregion,
       CAST(sum(population) AS BIGINT) AS total_population,
       {_r('avg(population_density)', 2)} AS avg_population_density,
       {_r('avg(gdp_per_capita)', 2)} AS avg_gdp_per_capita,
       {_r('avg(hdi)', 3)} AS avg_hdi,
       CAST(sum(CASE WHEN development_status = 'Developed' THEN 1 ELSE 0 END) AS BIGINT)
         AS developed_countries,
       CAST(sum(CASE WHEN development_status = 'Emerging' THEN 1 ELSE 0 END) AS BIGINT)
         AS emerging_countries,
       CAST(sum(CASE WHEN development_status = 'Developing' THEN 1 ELSE 0 END) AS BIGINT)
         AS developing_countries,
       count(*) AS total_countries
FROM ({ENRICHED_COUNTRIES}) GROUP BY region, subregion
"""

LABELLED_DOCS = """
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


JOB_COUNTS = f"""
    WITH p AS ({PROCESSED_DOCS}), i AS ({ORDER_INDICATORS}), e AS ({ENRICHED_COUNTRIES})
    SELECT 'processed' AS job, 'rows' AS metric, count(*) AS n FROM p
    UNION ALL SELECT 'processed', 'corrupt', 0
    UNION ALL SELECT 'indicators', 'rows', count(*) FROM i
    UNION ALL SELECT 'indicators', 'keys', count(DISTINCT country_code_3_econ) FROM i
    UNION ALL SELECT 'indicators', 'max_per_key', max(n) FROM (SELECT count(*) AS n FROM i GROUP BY country_code_3_econ)
    UNION ALL SELECT 'enriched', 'left_rows', count(*) FROM p
    UNION ALL SELECT 'enriched', 'right_rows', count(*) FROM i
    UNION ALL SELECT 'enriched', 'rows', count(*) FROM e
    UNION ALL SELECT 'enriched', 'developed', count(*) FROM e WHERE development_status = 'Developed'
    UNION ALL SELECT 'enriched', 'emerging', count(*) FROM e WHERE development_status = 'Emerging'
    UNION ALL SELECT 'enriched', 'developing', count(*) FROM e WHERE development_status = 'Developing'
    UNION ALL SELECT 'regional_stats', 'rows', count(*) FROM (SELECT DISTINCT region, subregion FROM e)"""


def oracle_sql() -> dict[str, str]:
    return {
        "flagship_group_stats": FLAGSHIP,
        "json_flatten": PROCESSED_DOCS,
        "json_array_flatten": PROCESSED_DOCS,
        "json_array_split": PROCESSED_DOCS,
        "json_corrupt": f"""
            SELECT CASE WHEN k % 9 <> 0 THEN country_code_3 END AS cca3,
                   CASE WHEN k % 9 <> 0 THEN population END AS population, k % 9 <> 0 AS parsed
            FROM (SELECT CAST(substr(common_name, 10) AS BIGINT) AS k, * FROM ({PROCESSED_DOCS}))""",
        "json_column": (
            "SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k FROM events"
        ),
        "select_rename_drop": (
            "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, "
            "c_acctbal / 1000.0::DOUBLE AS balance_k, lower(c_mktsegment) AS segment FROM customer"
        ),
        "safe_ratio": (
            "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_custkey / c_acctbal END AS ratio "
            "FROM customer"
        ),
        "left_enrich": LABELLED_DOCS,
        "classify_nulls": f"""
            SELECT doc_id, quality, toxic,
                   CASE WHEN quality >= 1 AND toxic <= 0 THEN 'keep'
                        WHEN quality >= 1 OR toxic >= 1 THEN 'review'
                        ELSE 'unknown' END AS decision
            FROM ({LABELLED_DOCS})""",
        "join_fanout": """
            SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity
            FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
        "join_fanout_salted": """
            SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity
            FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
        "join_hot_left": """
            SELECT l_orderkey, l_linenumber, k, n_name
            FROM (SELECT l_orderkey, l_linenumber,
                         CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN 7
                              ELSE l_suppkey % 40 END AS k FROM lineitem)
            LEFT JOIN nation ON k = n_nationkey""",
        "round_avg": f"""
            SELECT p_brand, {_r('avg(p_retailprice)', 2)} AS avg_price,
                   {_r('avg(p_size)', 3)} AS avg_size
            FROM part GROUP BY p_brand""",
        "exact_stats": """
            SELECT l_returnflag, l_linestatus, CAST(round(sum(net), 2) AS DOUBLE) AS sum_net,
                   CAST(round(sum(net) / CAST(count(*) AS DECIMAL(18,0)), 3) AS DOUBLE) AS avg_net,
                   CAST(round(sum(price) / CAST(count(*) AS DECIMAL(18,0)), 3) AS DOUBLE) AS avg_price, count(*) AS n_items
            FROM (SELECT *, CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,10)) AS net,
                         CAST(l_extendedprice AS DECIMAL(38,10)) AS price FROM lineitem)
            GROUP BY l_returnflag, l_linestatus""",
        "pivot_counts": """
            SELECT o_orderpriority,
                   CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_f,
                   CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_o,
                   CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_p,
                   count(*) AS n_orders
            FROM orders GROUP BY o_orderpriority""",
        "distribution": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
        "row_count": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
            for t in (
                "region nation customer supplier part orders lineitem events documents "
                "embeddings pages benchmark labels conversations"
            ).split()
        ),
        "keyed_uniform": f"""
            SELECT p_brand AS code, occ AS occurrence, {_indicators('p_brand', 'occ')}
            FROM (SELECT p_brand, row_number() OVER (PARTITION BY p_brand) AS occ FROM part)""",
        "key_list": "SELECT p_brand AS value, count(*) AS count FROM part GROUP BY p_brand",
        "table_roundtrip": "SELECT * FROM orders",
        "publish_copy": ENRICHED_ORDERS,
        "typed_rows": """
            SELECT o_orderkey, o_orderstatus,
                   CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
                   CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
                   CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS VARCHAR) AS at
            FROM orders""",
        "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
        "regional_rollup": REGIONAL_ROLLUP,
        "region_report": f"""
            SELECT region, subregion, total_countries, total_population FROM ({REGIONAL_ROLLUP})""",
        "country_report": ENRICHED_COUNTRIES,
        "job_counts": JOB_COUNTS,
        "resumed_counts": f"""{JOB_COUNTS}
            UNION ALL SELECT 'processed', 'reused', 0
            UNION ALL SELECT 'indicators', 'reused', 1
            UNION ALL SELECT 'enriched', 'reused', 0
            UNION ALL SELECT 'regional_stats', 'reused', 0
            UNION ALL SELECT 'report', 'reused', 0""",
        "batch_rollup": REGIONAL_ROLLUP,
        "quarantined_documents": f"""
            SELECT CASE WHEN k % 9 <> 0 THEN common_name END AS common_name,
                   CASE WHEN k % 9 <> 0 THEN country_code_3 END AS country_code_3,
                   CASE WHEN k % 9 <> 0 THEN population END AS population,
                   CASE WHEN k % 9 <> 0 THEN area END AS area,
                   CASE WHEN k % 9 = 0 THEN 'unparsable'
                        WHEN country_code_3 IS NULL OR area IS NULL THEN
                          concat_ws('; ', CASE WHEN country_code_3 IS NULL THEN 'country_code_3 is NULL' END,
                                    CASE WHEN area IS NULL THEN 'area is NULL' END) END AS reasons
            FROM (SELECT CAST(substr(common_name, 10) AS BIGINT) AS k, * FROM ({PROCESSED_DOCS}))""",
        "schema_drift": f"""
            WITH docs AS (SELECT CAST(substr(common_name, 10) AS BIGINT) AS k, * FROM ({PROCESSED_DOCS})),
            whole AS (SELECT * FROM docs WHERE k % 9 <> 0),
            departures AS (
              SELECT '$' AS path, 'unparsable' AS problem, CAST(NULL AS VARCHAR) AS found FROM docs WHERE k % 9 = 0
              UNION ALL SELECT '$.population', 'wrong type', 'STRING' FROM whole WHERE k % 4 = 0 AND population IS NOT NULL
              UNION ALL SELECT '$.name', 'wrong type', 'STRING' FROM whole WHERE k % 4 = 1
              UNION ALL SELECT '$.area', 'wrong type', 'ARRAY' FROM whole WHERE k % 4 = 2 AND area IS NOT NULL
              UNION ALL SELECT '$.extra', 'undeclared', 'OBJECT' FROM whole WHERE k % 4 = 2
              UNION ALL SELECT '$.tld', 'undeclared', 'STRING' FROM whole WHERE k % 4 = 3)
            SELECT path, problem, found, count(*) AS records FROM departures GROUP BY path, problem, found""",
        "stream_enrich": ENRICHED_COUNTRIES,
        "key_list_indicators": ORDER_INDICATORS,
        "status_distribution": f"""
            SELECT development_status, count(*) AS count
            FROM ({ENRICHED_COUNTRIES}) GROUP BY development_status""",
    }

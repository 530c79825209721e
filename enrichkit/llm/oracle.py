"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_scan import KINDS, SHINGLE, SIMILARITY, TEMPLATES

#: A document word list; the class is that of the contract.
_WORDS = (
    "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP1 = f"""
WITH item AS (
  SELECT item_id, {_WORDS.format(t="text")} AS w FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, coalesce({_WORDS.format(t="text")}, []) AS w FROM documents
), size AS (
  SELECT DISTINCT n FROM item_window
), doc_window AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n)
), found AS (
  SELECT d.doc_id, d.n, d.i, k.item_id FROM doc_window d JOIN item_window k USING (n, win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL)
  GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP2 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP4 = f"""
WITH doc AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], {_SPACES}), {_LOWER}) AS key
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM doc)
), repeat AS (
  SELECT key, max(doc_id) AS keep_id FROM line WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT line.*, repeat.key IS NOT NULL AND doc_id <> keep_id AS dropped FROM line LEFT JOIN repeat USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _op7() -> str:
    names = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in sorted(TEMPLATES.items()))
    words = "regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    shingles = "unnest(generate_series(1, greatest(1, len(w) - {k} + 1))) AS i".format(k=SHINGLE)
    shingle = f"array_to_string(w[i : i + {SHINGLE} - 1], ' ')"
    licence = f"regexp_replace(id, '-({'|'.join(KINDS)})$', '')"
    return f"""
WITH word AS (
  SELECT id, {words} AS w FROM (VALUES {names}) t(id, text)
), template AS (
  SELECT DISTINCT id, {shingle} AS s FROM (SELECT id, w, {shingles} FROM word WHERE len(w) >= {SHINGLE})
), size AS (
  SELECT id, count(*) AS n FROM template GROUP BY id
), rival AS (
  SELECT a.id, b.id AS other FROM template a JOIN template b ON a.s = b.s AND a.id <> b.id JOIN size ON size.id = a.id
  GROUP BY a.id, b.id HAVING 2 * count(*) >= any_value(n)
), apart AS (
  SELECT rival.id, other, s FROM rival JOIN template USING (id)
  WHERE NOT EXISTS (SELECT 1 FROM template x WHERE x.id = rival.other AND x.s = template.s)
), apart_size AS (
  SELECT id, other, count(*) AS n FROM apart GROUP BY id, other
), doc AS (
  SELECT doc_id, {words} AS w FROM documents
), held AS (
  SELECT DISTINCT doc_id, s FROM (SELECT doc_id, {shingle} AS s FROM (SELECT doc_id, w, {shingles} FROM doc WHERE len(w) > 0))
  WHERE s IN (SELECT s FROM template)
), found AS (
  SELECT doc_id, id, count(*) / any_value(n)::DOUBLE AS c
  FROM held JOIN template USING (s) JOIN size USING (id) GROUP BY doc_id, id HAVING count(*) >= {SIMILARITY} * any_value(n)
), told AS (
  SELECT doc_id, id, other, count(*) AS k FROM held JOIN apart USING (s) GROUP BY doc_id, id, other
), whole AS (
  SELECT doc_id, id, c FROM found WHERE NOT EXISTS (
    SELECT 1 FROM apart_size a LEFT JOIN told t ON t.doc_id = found.doc_id AND t.id = a.id AND t.other = a.other
    WHERE a.id = found.id AND 2 * coalesce(t.k, 0) < a.n)
  UNION ALL
  SELECT doc_id, word.id, 1.0::DOUBLE FROM doc JOIN word
    ON len(word.w) BETWEEN 1 AND {SHINGLE - 1} AND contains(' ' || array_to_string(doc.w, ' ') || ' ', ' ' || array_to_string(word.w, ' ') || ' ')
), each AS (
  SELECT doc_id, count(DISTINCT {licence}) AS n, string_agg(DISTINCT {licence}, ',' ORDER BY {licence}) AS ids,
    string_agg(id, ',' ORDER BY id) AS templates, max(c) AS c FROM whole GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses,
  coalesce(ids, '') AS licenses, coalesce(templates, '') AS templates, coalesce(c, 0.0)::DOUBLE AS containment
FROM doc LEFT JOIN each USING (doc_id)
"""


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST(('0x' || substr(h, {5 * g + 1}, 5)) AS BIGINT) // {32**p}) % 32 AS INTEGER), 1)"
    for g in range(8)
    for p in (3, 2, 1, 0)
)

OP9 = f"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), judged AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS first_id FROM page
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM judged
"""


#: Every 100-byte string of every text; texts are taken apart in pieces of 512 starts.
OP11 = """
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), piece AS (
  SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 611) AS h, least(512, n - 99 - b) AS k
  FROM (SELECT doc_id, h, n, unnest(range(0, greatest(0, n - 99), 512)) AS b FROM doc)
), win AS (
  SELECT doc_id, b + i AS x, md5_number(substr(h, 2 * i + 1, 200)) AS w
  FROM (SELECT doc_id, b, h, unnest(range(0, k)) AS i FROM piece)
), early AS (
  SELECT w, min(struct_pack(d := doc_id, x := x)) AS f FROM win GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, x FROM win JOIN early USING (w) WHERE doc_id > f.d OR (doc_id = f.d AND win.x > f.x)
), run AS (
  SELECT doc_id, x, x - lag(x, 1, -1000) OVER (PARTITION BY doc_id ORDER BY x) > 100 AS new FROM gone
), span AS (
  SELECT doc_id, min(x) AS a, max(x) + 100 AS e
  FROM (SELECT doc_id, x, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY x) AS g FROM run) GROUP BY doc_id, g
), cut AS (
  SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span
), rest AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - a) AS n_removed, max(e) AS tail,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM cut JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN rest USING (doc_id)
"""


def _crc_table() -> list[int]:
    """CRC-32 of every byte."""
    table = list(range(256))
    for _ in range(8):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


OP13 = f"""
WITH doc AS (
  SELECT doc_id, coalesce({_WORDS.format(t="text")}, []) AS w FROM documents
), item AS (
  SELECT coalesce({_WORDS.format(t="text")}, []) AS w FROM benchmark
), feature AS (
  SELECT doc_id, f, count(*) AS k FROM (
    SELECT doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM doc
  ) GROUP BY doc_id, f
), item_feature AS (
  SELECT f, count(*) AS k FROM (
    SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM item
  ) GROUP BY f
), name AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM feature UNION SELECT f FROM item_feature)
), bucket AS (
  SELECT f, xor(4294967295, list_reduce(
      list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
      lambda c, b: xor(c // 256, ({_crc_table()})[1 + (xor(c, b) & 255)]), 4294967295)) % 10000 AS b
  FROM name
), corpus AS (
  SELECT b, sum(k) AS s FROM feature JOIN bucket USING (f) GROUP BY b
), target AS (
  SELECT b, sum(k) AS t FROM item_feature JOIN bucket USING (f) GROUP BY b
), total AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE AS s, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS t
), gain AS (
  SELECT b, floor(1000 * ln(((coalesce(c.t, 0) + 1)::DOUBLE * (total.s + 10000)) / ((corpus.s + 1)::DOUBLE * (total.t + 10000))))::BIGINT AS g
  FROM corpus LEFT JOIN target c USING (b), total
), weighed AS (
  SELECT doc_id, sum(k) AS n, sum(k * g) AS total FROM feature JOIN bucket USING (f) JOIN gain USING (b) GROUP BY doc_id
), scored AS (
  SELECT doc.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM doc LEFT JOIN weighed USING (doc_id)
), noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER () AS n FROM noisy WHERE n_words >= 20
)
SELECT noisy.doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank
FROM noisy LEFT JOIN ordered USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1,
        "op2_exact_dedup": OP2,
        "op4_line_dedup": OP4,
        "op7_license_scan": _op7(),
        "op9_warc": OP9,
        "op11_suffix_dedup": OP11,
        "op13_importance_resampling": OP13,
    }

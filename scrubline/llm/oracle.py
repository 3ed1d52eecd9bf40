"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from .licences import LEAST, TEMPLATES

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*(/[^?#]*)"

ORACLE: dict[str, str] = {
    "op8_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
""",
    "op5_licence_scan": rf"""
WITH template(licence, text) AS (VALUES {_TEMPLATES}),
tw AS (SELECT licence, string_split(lower(trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM template),
tb AS (SELECT licence, len(w) - 1 AS m, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM tw),
known AS (SELECT licence, m, bigram, count(*) AS k FROM tb GROUP BY ALL),
doc AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
unit AS (
  SELECT doc_id, rid, 0 AS line, text AS unit FROM doc
  UNION ALL
  SELECT doc_id, rid, generate_subscripts(string_split(text, chr(10)), 1), unnest(string_split(text, chr(10))) FROM doc
),
word AS (SELECT doc_id, rid, line, string_split(lower(trim(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM unit),
gram AS (
  SELECT doc_id, rid, line, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
  FROM word WHERE len(w) - 1 <= (SELECT max(m) FROM known) * 3
),
counted AS (SELECT doc_id, rid, line, n, bigram, count(*) AS c FROM gram GROUP BY ALL),
found AS (
  SELECT doc_id, rid, line, licence, 2.0::DOUBLE * sum(least(c, k)) / (n + m) AS dice
  FROM counted JOIN known USING (bigram) GROUP BY doc_id, rid, line, n, licence, m
)
SELECT doc_id, line, licence, round(dice, 6) AS dice FROM found WHERE dice >= {LEAST}
""",
    "op9_dated_url_lists": rf"""
WITH capture AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS DATE) AS fetched_on,
    rtrim(lower(regexp_extract(url, '{_HOST}', 1)), '.') AS host,
    list_filter(string_split(regexp_extract(url, '{_PATH}', 1), '/'), lambda x: x != '') AS parts,
    row_number() OVER () AS rid
  FROM pages
),
host AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) AS n FROM capture WHERE host != ''),
entry AS (
  SELECT host AS key, n % 300 AS d, 'block' AS action FROM host WHERE n % 3 = 0
  UNION ALL SELECT host, n % 300 + 60, 'allow' FROM host WHERE n % 3 = 0
  UNION ALL SELECT host, n % 300 + 200, 'block' FROM host WHERE n % 3 = 0
  UNION ALL SELECT host || '/en', n % 300, 'block' FROM host WHERE n % 3 = 1
  UNION ALL SELECT array_to_string(string_split(host, '.')[-2:], '.'), n % 300 + 300, 'block' FROM host WHERE n % 3 = 2 AND n % 11 = 2
),
day AS (SELECT key, CAST(DATE '2024-01-01' + CAST(d AS INTEGER) AS DATE) AS since, min(action) AS action FROM entry GROUP BY ALL),
held AS (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM day),
asked AS (
  SELECT rid, fetched_on, i AS rank, array_to_string(string_split(host, '.')[-i:], '.') AS key
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM capture WHERE host != '')
  UNION ALL
  SELECT rid, fetched_on, i + 1000, host || '/' || array_to_string(parts[1:i], '/')
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM capture WHERE host != '')
),
best AS (
  SELECT rid, arg_max(key, rank) AS matched_key, arg_max(action, rank) AS action, arg_max(since, rank) AS listed_on
  FROM asked JOIN held USING (key) WHERE since <= fetched_on AND (until IS NULL OR fetched_on < until) GROUP BY rid
)
SELECT page_id, fetched_on, coalesce(action = 'block', false) AS blocked, matched_key, listed_on
FROM capture LEFT JOIN best USING (rid)
""",
    "op11_benchmark_decontamination": r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS rid, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w
  FROM documents
),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w
  FROM benchmark
),
part AS (
  SELECT item, w[i : i + 9] AS p FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
held AS (SELECT DISTINCT item, len(p) AS n, array_to_string(p, ' ') AS part FROM part),
place AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS part
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM held) WHERE len(w) >= n)
),
found AS (SELECT rid, i, n, item FROM place JOIN held USING (n, part)),
hit AS (SELECT rid, count(DISTINCT spot) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS spot FROM found) GROUP BY rid),
listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (rid) LEFT JOIN listed USING (rid)
""",
}

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import licenses, quality

_Q = lambda s: "'" + s.replace("'", "''") + "'"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STOP = "[" + ", ".join(_Q(w) for w in quality.STOP_WORDS) + "]"


def _verdict() -> str:
    parts = []
    for r in quality.RULES:
        num, den = f"CAST({r.numerator} AS DOUBLE)", f"CAST({r.denominator} AS DOUBLE)"
        bad = [f"{num} < {r.low} * {den}"] if r.low is not None else []
        bad += [f"{num} > {r.high} * {den}"] if r.high is not None else []
        asked = f"n_words >= {r.min_words}" + (" AND 2 * n_bytes <= 3 * n_chars" if r.latin else "")
        parts.append(f"((({') OR ('.join(bad)})) AND {asked})")
    return " OR ".join(parts)


SQL = {}

SQL["op1_quality_rules"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
r AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM rep GROUP BY rid),
f AS (
  SELECT doc_id, len(w) AS n_words, length(translate(text, {_SPACES}, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(replace(text, '!', '')) AS n_exclamations, len(l) AS n_lines,
         strlen(text) AS n_bytes, length(text) AS n_chars,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
         len(list_filter(w, lambda x: list_contains({_STOP}, lower(x)))) AS n_stop_words
  FROM d LEFT JOIN r USING (rid)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_verdict()}) AS kept
FROM b
"""

# Repeated starts -> maximal runs -> kept pieces. Each text is looked at on its own; equal windows
# anywhere (same document included) count.
SQL["op2_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (SELECT rid, i, md5(b[i:i + 399]) AS h
        FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d WHERE octet_length(b) >= 400)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
cut AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM rep),
run AS (SELECT rid, min(i) AS a, max(i) + 399 AS z
        FROM (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS k FROM cut) GROUP BY rid, k),
agg AS (SELECT rid, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last FROM run GROUP BY rid),
piece AS (
  SELECT rid, a, lower(hex(b[coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) + 1:a - 1])) AS p,
         a > coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) + 1 AS full_ FROM run JOIN d USING (rid)),
pieces AS (SELECT rid, string_agg(CASE WHEN full_ THEN p ELSE '' END, '' ORDER BY a) AS p FROM piece GROUP BY rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN b
                   WHEN last >= octet_length(b) THEN unhex(p)
                   ELSE unhex(p || hex(b[last + 1:])) END) AS kept_sha256
FROM d LEFT JOIN agg USING (rid) LEFT JOIN pieces USING (rid)
"""

SQL["op5_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
m AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest,
             CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY sha256(b)) ELSE page_id END AS first
      FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM m
"""

SQL["op7_substring_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
        FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM rep),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS k FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op8_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS w FROM documents),
it AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM it WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
win AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, i, n, item FROM win JOIN g USING (n, g)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN items USING (rid)
"""


def _canonical(x: str) -> str:
    t = f"regexp_replace(lower(coalesce({x}, '')), {_Q(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    for pattern, to in licenses.EQUIVALENT:
        t = f"regexp_replace({t}, {_Q(pattern)}, {_Q(to)}, 'g')"
    return f"trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


_KNOWN = ", ".join(f"({_Q(i)}, {_Q(t)})" for i, t in licenses.KNOWN_TEXTS)

SQL["op9_license_scan"] = f"""
WITH known AS (SELECT sha256({_canonical('body')}) AS digest, min(id) AS license_id FROM (VALUES {_KNOWN}) AS t(id, body) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, sha256({_canonical('text')}) AS digest FROM documents),
lines AS (SELECT DISTINCT rid, sha256({_canonical('line')}) AS digest
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
n AS (SELECT rid, string_agg(license_id, ',' ORDER BY license_id) AS notices
      FROM (SELECT DISTINCT rid, license_id FROM lines JOIN known USING (digest)) GROUP BY rid)
SELECT doc_id, d.digest, license_id, coalesce(notices, '') AS notices
FROM d LEFT JOIN known USING (digest) LEFT JOIN n USING (rid)
"""

SQL["op10_mix"] = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR))) AS key
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS DOUBLE) AS w
      FROM d GROUP BY source),
o AS (SELECT *, 2.0 * source_size AS cap,
             coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
             sum(w) OVER (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
             1.5 * sum(source_size) OVER () AS total FROM s),
level AS (SELECT coalesce(arg_min((total - used) / rest, cap / w), 0) AS lv FROM o WHERE (total - used) / rest <= cap / w),
t AS (SELECT source, source_size, least(cap, w * lv) AS target FROM o, level),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
b AS (SELECT *, round(target - epochs * source_size) AS budget FROM r),
x AS (SELECT d.doc_id, d.size, b.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(epochs * size + least(size, greatest(0, budget - before)) AS BIGINT) AS taken
FROM x
"""

SQL["op12_hard_negatives"] = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (SELECT anchor, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT anchor AS anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op13_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
l AS (SELECT rid, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
k AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM l),
tf AS (SELECT rid, x, count(*) AS tf FROM (SELECT rid, unnest(t) AS x FROM l) GROUP BY rid, x),
df AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, k GROUP BY x, nn),
it AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark),
qt AS (SELECT q, item_id, x, count(*) AS c FROM (SELECT q, item_id, unnest(t) AS x FROM it) GROUP BY q, item_id, x),
s AS (SELECT q, item_id, rid, doc_id,
             CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
      FROM qt JOIN df USING (x) JOIN tf USING (x) JOIN l USING (rid), k GROUP BY q, item_id, rid, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

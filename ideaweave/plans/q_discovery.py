"""Queries: set hash, prompt rendering, responder, reply parsing and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG
from ..functions.text import set_hash as set_hash_col
from ..operators import discovery as disc
from ..operators import neighborhoods as nbh
from ..sources import testdata as td
from . import oracle_views as ov
from .q_neighbor import _sql as nb_sql
from .registry import query


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# fixed line format of an idea in a prompt
LINE = ("'[ID:' || i.idea_id || '] \"' || coalesce(i.title, '') || '\" (' || coalesce(i.source, '') || ', ' "
        "|| coalesce(nullif(i.category, ''), 'uncategorized') || '): ' || coalesce(i.description, '')")
_HEAD = disc.DISCOVERY_HEAD.split("{n}")


@query("set_hash", """
SELECT l_orderkey, count(*)::BIGINT AS n_lines,
       sha256(array_to_string(list_sort(list(l_partkey)), ',')) AS set_hash
FROM lineitem GROUP BY l_orderkey""")
def set_hash(spark, d):
    li = td.table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"),
                                        set_hash_col(F.collect_list("l_partkey")).alias("set_hash"))


@query("neighborhood_prompt", nb_sql("idea_id % 25", DEFAULT_CONFIG) + f""", {ov.IDEAS}
SELECT m.nb AS neighborhood_id, sha256(array_to_string(list_sort(list(m.idea_id)), ',')) AS group_hash,
       count(*)::BIGINT AS n_items,
       {_lit(_HEAD[0])} || count(*) || {_lit(_HEAD[1])}
         || coalesce(string_agg({LINE}, chr(10) ORDER BY m.ordinal), '') AS prompt
FROM intra_all m LEFT JOIN ideas_v i USING (idea_id) GROUP BY m.nb""")
def neighborhood_prompt(spark, d):
    a = td.small_assignments(spark, d)
    plan = nbh.plan_intra(nbh.cluster_sizes(a), DEFAULT_CONFIG)
    members = nbh.intra_members(a, plan, None).select(F.col("nb").alias("neighborhood_id"), "ordinal", "idea_id")
    return disc.neighborhood_prompts(members, td.ideas(spark, d))


@query("cluster_prompt", f"""WITH {ov.VECTORS}, {ov.IDEAS},
asg AS (SELECT idea_id, label AS cluster_id FROM vec_v),
big AS (SELECT cluster_id, count(*) AS n_members, sha256(array_to_string(list_sort(list(idea_id)), ',')) AS group_hash
        FROM asg GROUP BY cluster_id HAVING count(*) >= 3),
lines AS (SELECT a.cluster_id, a.idea_id, {LINE} AS line,
                 (row_number() OVER (PARTITION BY a.cluster_id ORDER BY a.idea_id) - 1) // {DEFAULT_CONFIG.max_prompt_ideas} AS part
          FROM asg a JOIN ideas_v i USING (idea_id))
SELECT l.cluster_id, l.part::INT AS part, b.group_hash, b.n_members::BIGINT AS n_members,
       {_lit(disc.PATTERNS_HEAD)} || string_agg(l.line, chr(10) ORDER BY l.idea_id) AS prompt
FROM lines l JOIN big b USING (cluster_id) GROUP BY l.cluster_id, l.part, b.group_hash, b.n_members""")
def cluster_prompt(spark, d):
    a = td.fixed_assignments(spark, d).select("idea_id", "cluster_id")
    return disc.cluster_prompts(a, td.ideas(spark, d), DEFAULT_CONFIG)


_PARSE_SQL = f"""WITH rep AS (SELECT {td.REPLY_HASH_DUCK} AS group_hash, {td.REPLY_TEXT_SQL} AS text, p_size FROM part),
j AS (SELECT group_hash, p_size, regexp_extract(text, '(?s)\\{{.*\\}}', 0) AS jt FROM rep),
ok AS (SELECT group_hash, p_size, jt FROM j WHERE jt <> '' AND CASE WHEN json_valid(jt) THEN json_type(jt) = 'OBJECT' ELSE false END),
items AS (SELECT group_hash, p_size, unnest(json_extract(jt, '$.constellations[*]')) AS e,
                 unnest(range(len(json_extract(jt, '$.constellations[*]'))))::INT AS item_ord FROM ok),
typed AS (SELECT group_hash AS neighborhood_hash, p_size, item_ord, json_extract_string(e, '$.type') AS constellation_type,
                 array_to_string(CAST(json_extract(e, '$.idea_ids') AS BIGINT[]), ',') AS idea_ids,
                 CAST(json_extract(e, '$.idea_ids') AS BIGINT[]) AS ids_arr,
                 json_extract_string(e, '$.title') AS title, json_extract_string(e, '$.explanation') AS explanation,
                 CASE WHEN json_type(e, '$.score') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
                      THEN CAST(json_extract(e, '$.score') AS DOUBLE) END AS score,
                 CASE WHEN json_extract_string(e, '$.type') = 'absence'
                       AND json_type(e, '$.actionability') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
                      THEN greatest(1, least(10, floor(CAST(json_extract(e, '$.actionability') AS DOUBLE) + 0.5)))::INT
                 END AS actionability
          FROM items)"""


def _parse_out(df):
    return df.select("neighborhood_hash", F.col("item_ord").cast("int"), "constellation_type",
                     F.array_join(F.transform("idea_ids", lambda x: x.cast("string")), ",").alias("idea_ids"),
                     "title", "explanation", "score", "actionability")


@query("parse_constellations", _PARSE_SQL + f"""
SELECT neighborhood_hash, item_ord, constellation_type, idea_ids, title, explanation, score, actionability
FROM typed WHERE score >= {float(DEFAULT_CONFIG.min_constellation_score)}""")
def parse_constellations(spark, d):
    p = disc.parse_constellations(td.replies(spark, d), DEFAULT_CONFIG.min_constellation_score)
    return _parse_out(p.rows)


@query("validate_reply", _PARSE_SQL + f"""
SELECT neighborhood_hash, item_ord, constellation_type, idea_ids, title, explanation, score, actionability
FROM typed WHERE score >= {float(DEFAULT_CONFIG.min_constellation_score)}
  AND constellation_type IN ('triangulation', 'spectrum', 'chain', 'convergence', 'absence')
  AND len(string_split(idea_ids, ',')) BETWEEN 3 AND 6""")
def validate_reply(spark, d):
    p = disc.parse_constellations(td.replies(spark, d), DEFAULT_CONFIG.min_constellation_score, validate=True)
    return _parse_out(p.rows)


@query("parse_errors", _PARSE_SQL + """
SELECT reason, count(*)::BIGINT AS n FROM (
  SELECT 'no json' AS reason FROM j WHERE jt = ''
  UNION ALL SELECT 'malformed json' FROM j WHERE jt <> '' AND NOT CASE WHEN json_valid(jt) THEN json_type(jt) = 'OBJECT' ELSE false END
  UNION ALL SELECT 'missing score' FROM typed WHERE score IS NULL) GROUP BY reason""")
def parse_errors(spark, d):
    p = disc.parse_constellations(td.replies(spark, d), DEFAULT_CONFIG.min_constellation_score)
    return p.errors.groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("parse_patterns", f"""WITH rep AS (SELECT {td.REPLY_HASH_DUCK} AS group_hash, {td.PATTERN_TEXT_SQL} AS text FROM part),
j AS (SELECT group_hash, regexp_extract(text, '(?s)\\{{.*\\}}', 0) AS jt FROM rep),
ok AS (SELECT group_hash, jt FROM j WHERE jt <> '' AND CASE WHEN json_valid(jt) THEN json_type(jt) = 'OBJECT' ELSE false END),
items AS (SELECT group_hash, unnest(json_extract(jt, '$.patterns[*]')) AS e,
                 unnest(range(len(json_extract(jt, '$.patterns[*]'))))::INT AS item_ord FROM ok)
SELECT group_hash AS cluster_hash, item_ord, json_extract_string(e, '$.name') AS pattern_title,
       json_extract_string(e, '$.explanation') AS pattern_description,
       coalesce(array_to_string(CAST(json_extract(e, '$.idea_ids') AS BIGINT[]), ','), '') AS idea_ids
FROM items""")
def parse_patterns(spark, d):
    p = disc.parse_patterns(td.replies(spark, d, "patterns")).rows
    return p.select("cluster_hash", F.col("item_ord").cast("int"), "pattern_title", "pattern_description",
                    F.array_join(F.transform("idea_ids", lambda x: x.cast("string")), ",").alias("idea_ids"))


def _respond_sql() -> str:
    from .registry import ORACLE
    return f"""WITH np AS ({ORACLE["neighborhood_prompt"]}),
f AS (SELECT group_hash, prompt, sha256(prompt) AS h,
             list_slice(regexp_extract_all(prompt, '\\[ID:(\\d+)\\]', 1), 1, 3) AS ids FROM np),
g AS (SELECT *, array_to_string(ids, ', ') AS idstr,
             ['triangulation', 'spectrum', 'chain', 'convergence', 'absence'][(('0x' || substr(h, 1, 1))::INT % 5) + 1]
               AS kind,
             (('0x' || substr(h, 2, 2))::INT % 10) + 1 AS score,
             (('0x' || substr(h, 4, 2))::INT % 14) + 0.5 AS act FROM f),
t AS (SELECT *, 'Here is what I found:' || chr(10) || '{{"constellations": [{{"type": "' || kind
                || '", "idea_ids": [' || idstr || '], "title": "group ' || substr(h, 1, 6)
                || '", "explanation": "items [' || idstr || ']", "score": ' || score
                || CASE WHEN kind = 'absence' THEN ', "actionability": ' || act ELSE '' END || '}}]}}' AS text FROM g)
SELECT group_hash, 'ok' AS status, (length(prompt) // 4)::BIGINT AS input_tokens,
       (length(text) // 4)::BIGINT AS output_tokens, text FROM t"""


@query("respond_fake", _respond_sql())
def respond_fake(spark, d):
    """Replies to every neighbourhood prompt, from a table of stored replies."""
    prompts = neighborhood_prompt(spark, d)
    r = disc.respond(prompts, disc.StoredReplies(td.stored_replies), DEFAULT_CONFIG.discovery_model, "constellations",
                     "iw_discovery_v1", disc.DISCOVERY_SYSTEM, DEFAULT_CONFIG.discovery_concurrency)
    return r.select("group_hash", "status", "input_tokens", "output_tokens", "text")


@query("validate_members", _PARSE_SQL + f""",
grp AS (SELECT {td.REPLY_HASH_DUCK} AS neighborhood_hash,
               list_filter([p_partkey, p_partkey + 1, p_partkey + 2], lambda x: x % 3 <> 0 OR p_partkey % 5 = 0) AS m FROM part)
SELECT neighborhood_hash, item_ord, constellation_type, idea_ids, title, explanation, score, actionability
FROM typed JOIN grp USING (neighborhood_hash)
WHERE score >= {{MIN}} AND constellation_type IN ('triangulation', 'spectrum', 'chain', 'convergence', 'absence')
  AND len(ids_arr) BETWEEN 3 AND 6 AND len(list_filter(ids_arr, lambda x: NOT list_contains(m, x))) = 0""".replace(
    "{MIN}", str(float(DEFAULT_CONFIG.min_constellation_score))))
def validate_members(spark, d):
    """Replies whose ids must be members of the group that was asked about."""
    ids = F.explode(F.sequence(F.col("p_partkey"), F.col("p_partkey") + 2)).alias("idea_id")
    members = (td.table(spark, d, "part").select("p_partkey", F.expr(td.REPLY_HASH_SQL).alias("group_hash"), ids)
               .where((F.col("idea_id") % 3 != 0) | (F.col("p_partkey") % 5 == 0)).select("group_hash", "idea_id"))
    p = disc.parse_constellations(td.replies(spark, d), DEFAULT_CONFIG.min_constellation_score, True, members)
    return _parse_out(p.rows)


@query("call_counters", f"""
SELECT (SELECT count(DISTINCT {td.REPLY_HASH_DUCK}) FROM part WHERE p_size <= 25)::BIGINT AS cache_hits,
       count(*) FILTER (p_partkey % 9 <> 0)::BIGINT AS api_calls, sum(length(p_name) * 40)::BIGINT AS input_tokens,
       sum(p_size * 10)::BIGINT AS output_tokens FROM part""")
def call_counters(spark, d):
    """Cache hits, calls answered and tokens of a stage, from its stored replies."""
    r = td.replies(spark, d, extra=True)
    part = td.table(spark, d, "part").select(F.expr(td.REPLY_HASH_SQL).alias("h"), (F.col("p_partkey") % 9 == 0).alias("bad"))
    r = r.join(part, r["group_hash"] == part["h"]).withColumn("status", F.when(F.col("bad"), "error").otherwise(F.col("status")))
    return disc.call_counters(r, r.where("p_size <= 25"))

"""Queries: caches and upserts, cost ledger, summaries and export tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, EXPORT_PROMPT_VERSION, ERROR_TITLE, MODEL_PRICING
from ..operators import discovery as disc
from ..operators import ledger as led
from ..operators import report as rep
from ..operators import store
from ..sources import testdata as td
from . import oracle_views as ov
from .q_discovery import _PARSE_SQL
from .registry import query

MIN = float(DEFAULT_CONFIG.min_constellation_score)
KEPT = f",\nkept AS (SELECT * FROM typed WHERE score >= {MIN})"
CURRENT_MODEL = MODEL_PRICING[0][0]
EXPORT_DAY = "2026-01-01"


def _kept(spark, d, extra=False):
    return disc.parse_constellations(td.replies(spark, d, extra=extra), MIN).rows


def _ids_str(c="idea_ids"):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# ------------------------------------------------------------------ ledger
@query("cost_total", f"""WITH {ov.LEDGER}
SELECT round(coalesce(sum(l.input_tokens / 1000000.0::DOUBLE * p.input_per_million
                          + l.output_tokens / 1000000.0::DOUBLE * p.output_per_million), 0.0), 6) AS total_cost
FROM ledger_v l JOIN pricing_v p USING (model)""")
def cost_total(spark, d):
    return led.cost_total(td.ledger(spark, d)).select(F.round("total_cost", 6).alias("total_cost"))


@query("cost_by_stage", f"""WITH {ov.LEDGER}
SELECT stage, round(sum(l.input_tokens / 1000000.0::DOUBLE * p.input_per_million
                        + l.output_tokens / 1000000.0::DOUBLE * p.output_per_million), 6) AS cost
FROM ledger_v l JOIN pricing_v p USING (model) GROUP BY stage""")
def cost_by_stage(spark, d):
    return led.cost_by_stage(td.ledger(spark, d)).select("stage", F.round("cost", 6).alias("cost"))


@query("cost_labels", f"""WITH {ov.LEDGER},
c AS (SELECT l.stage, l.input_tokens / 1000000.0::DOUBLE * p.input_per_million
             + l.output_tokens / 1000000.0::DOUBLE * p.output_per_million AS cost FROM ledger_v l JOIN pricing_v p USING (model)),
s AS (SELECT stage, sum(cost) AS cost FROM c GROUP BY stage UNION ALL SELECT 'TOTAL', coalesce(sum(cost), 0.0) FROM c)
SELECT stage, '$' || round(round(cost, 9)::DECIMAL(38, 9), 4)::DECIMAL(38, 4)::VARCHAR AS label FROM s""")
def cost_labels(spark, d):
    return led.cost_labels(td.ledger(spark, d))


@query("tokens_by_stage", f"""WITH {ov.LEDGER}
SELECT stage, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens
FROM ledger_v GROUP BY stage""")
def tokens_by_stage(spark, d):
    return led.tokens_by_stage(td.ledger(spark, d))


@query("over_budget", f"""WITH {ov.LEDGER},
t AS (SELECT coalesce(sum(l.input_tokens / 1000000.0::DOUBLE * p.input_per_million
                          + l.output_tokens / 1000000.0::DOUBLE * p.output_per_million), 0.0) AS c
      FROM ledger_v l JOIN pricing_v p USING (model))
SELECT round(c, 6) AS total_cost, {DEFAULT_CONFIG.cost_budget_usd}::DOUBLE AS budget,
       c > {DEFAULT_CONFIG.cost_budget_usd}::DOUBLE AS over_budget FROM t""")
def over_budget(spark, d):
    o = led.over_budget(td.ledger(spark, d), DEFAULT_CONFIG.cost_budget_usd)
    return o.select(F.round("total_cost", 6).alias("total_cost"), "budget", "over_budget")


# ------------------------------------------------------------------ summaries
@query("by_type", _PARSE_SQL + KEPT + """
SELECT constellation_type, count(*)::BIGINT AS n FROM kept GROUP BY constellation_type""")
def by_type(spark, d):
    return rep.by_type(_kept(spark, d))


@query("top_constellations", _PARSE_SQL + KEPT + """
SELECT neighborhood_hash, item_ord, score, upper(constellation_type) AS label, title,
       coalesce(explanation, '') AS explanation
FROM kept ORDER BY score DESC, neighborhood_hash, item_ord LIMIT 5""")
def top_constellations(spark, d):
    return rep.top_constellations(_kept(spark, d), 5).select(
        "neighborhood_hash", F.col("item_ord").cast("int"), "score", "label", "title", "explanation")


@query("member_titles", _PARSE_SQL + KEPT + f""", {ov.IDEAS},
ex AS (SELECT neighborhood_hash, item_ord, unnest(ids_arr) AS idea_id, unnest(range(len(ids_arr))) AS pos FROM kept)
SELECT ex.neighborhood_hash, ex.item_ord,
       string_agg(coalesce(i.title, ex.idea_id::VARCHAR), ' | ' ORDER BY ex.pos) AS titles
FROM ex LEFT JOIN ideas_v i USING (idea_id) GROUP BY ex.neighborhood_hash, ex.item_ord""")
def member_titles(spark, d):
    return rep.member_titles(_kept(spark, d), td.ideas(spark, d)).select(
        "neighborhood_hash", F.col("item_ord").cast("int"), "titles")


@query("cluster_listing", f"""WITH {ov.VECTORS}, {ov.IDEAS}
SELECT v.label AS cluster_id, v.idea_id, i.title FROM vec_v v LEFT JOIN ideas_v i USING (idea_id)""")
def cluster_listing(spark, d):
    a = td.fixed_assignments(spark, d)
    return rep.cluster_listing(a, td.ideas(spark, d)).select("cluster_id", "idea_id", "title")


@query("ideas_lookup", f"""WITH {ov.IDEAS}
SELECT idea_id, title, url, source, category, description FROM ideas_v""")
def ideas_lookup(spark, d):
    return rep.ideas_lookup(td.ideas(spark, d))


# ------------------------------------------------------------------ export
@query("export_ideas", f"""WITH {ov.IDEAS}
SELECT arg_min(idea_id, idea_id) AS id, arg_min(title, idea_id) AS nombre, url,
       arg_min(description, idea_id) AS descripcion, arg_min(source, idea_id) AS fuente,
       arg_min(category, idea_id) AS categoria, arg_min(stack, idea_id) AS stack, '{EXPORT_DAY}' AS fecha,
       '' AS problema_que_resuelve, '' AS potencial_negocio, '' AS dificultad_implementacion,
       'pendiente' AS apto_inversores, '' AS razon_inversores, 'pendiente' AS revisado, '' AS notas,
       '' AS combina_con, '' AS frontier
FROM ideas_v GROUP BY url""")
def export_ideas(spark, d):
    return rep.export_ideas(td.ideas(spark, d), EXPORT_DAY)


@query("export_constellations", _PARSE_SQL + KEPT + f"""
SELECT neighborhood_hash, item_ord, constellation_type, idea_ids, title, explanation, score,
       '{DEFAULT_CONFIG.discovery_model}' AS model, '{EXPORT_PROMPT_VERSION}' AS prompt_version FROM kept""")
def export_constellations(spark, d):
    e = rep.export_constellations(_kept(spark, d))
    return e.select("neighborhood_hash", F.col("item_ord").cast("int"), "constellation_type",
                    _ids_str().alias("idea_ids"), "title", "explanation", "score", "model", "prompt_version")


_PATTERNS_SQL = f"""WITH rep AS (SELECT {td.REPLY_HASH_DUCK} AS group_hash, {td.PATTERN_TEXT_SQL} AS text FROM part),
j AS (SELECT group_hash, regexp_extract(text, '(?s)\\{{.*\\}}', 0) AS jt FROM rep),
ok AS (SELECT group_hash, jt FROM j WHERE jt <> '' AND CASE WHEN json_valid(jt) THEN json_type(jt) = 'OBJECT' ELSE false END),
items AS (SELECT group_hash, unnest(json_extract(jt, '$.patterns[*]')) AS e FROM ok),
pat AS (SELECT group_hash AS cluster_hash, json_extract_string(e, '$.name') AS pattern_title,
               json_extract_string(e, '$.explanation') AS pattern_description, '{disc.PATTERNS_PROMPT_VERSION}' AS prompt_version
        FROM items),
writes AS (SELECT *, 1 AS write_seq FROM pat UNION ALL
           SELECT cluster_hash, pattern_title, upper(pattern_description), prompt_version, 2 FROM pat)"""


def _pattern_writes(spark, d):
    p = disc.parse_patterns(td.replies(spark, d, "patterns")).rows.select(
        "cluster_hash", "pattern_title", "pattern_description", "prompt_version")
    return (p.withColumn("write_seq", F.lit(1))
            .unionByName(p.withColumn("pattern_description", F.upper("pattern_description")).withColumn("write_seq", F.lit(2))))


@query("pattern_upsert", _PATTERNS_SQL + """
SELECT cluster_hash, pattern_title, prompt_version, arg_max(pattern_description, write_seq) AS pattern_description,
       max(write_seq) AS write_seq FROM writes GROUP BY cluster_hash, pattern_title, prompt_version""")
def pattern_upsert(spark, d):
    u = store.upsert_latest(_pattern_writes(spark, d), ["cluster_hash", "pattern_title", "prompt_version"])
    return u.select("cluster_hash", "pattern_title", "prompt_version", "pattern_description",
                    F.col("write_seq").cast("int"))


@query("export_patterns", _PATTERNS_SQL + """
SELECT cluster_hash, pattern_title, prompt_version, arg_min(pattern_description, write_seq) AS pattern_description
FROM writes GROUP BY cluster_hash, pattern_title, prompt_version""")
def export_patterns(spark, d):
    e = rep.export_patterns(_pattern_writes(spark, d))
    return e.select("cluster_hash", "pattern_title", "prompt_version", "pattern_description")


# ------------------------------------------------------------------ caches
@query("embedding_upsert", f"""WITH {ov.VECTORS}
SELECT idea_id, CASE WHEN label < 3 THEN 'model_b' ELSE 'model_a' END AS model,
       round(CASE WHEN label < 3 THEN vec[len(vec)] ELSE vec[1] END, 6) AS v0 FROM vec_v""")
def embedding_upsert(spark, d):
    v = td.vectors(spark, d)
    old = v.select("idea_id", F.lit("model_a").alias("model"), "vec")
    new = v.where(F.col("label") < 3).select("idea_id", F.lit("model_b").alias("model"), F.reverse("vec").alias("vec"))
    u = store.upsert(old, new, ["idea_id"])
    return u.select("idea_id", "model", F.round(F.element_at("vec", 1), 6).alias("v0"))


_CACHE = ",\ncache AS (SELECT * FROM kept WHERE p_size <= 25)"


def _cache(spark, d):
    r = td.replies(spark, d, extra=True)
    cached = disc.parse_constellations(r.where(F.col("p_size") <= 25), MIN).rows
    return r, cached


@query("cache_split", _PARSE_SQL + KEPT + _CACHE + """
SELECT group_hash, group_hash IN (SELECT neighborhood_hash FROM cache) AS hit FROM rep""")
def cache_split(spark, d):
    r, cached = _cache(spark, d)
    keys = cached.select(F.col("neighborhood_hash").alias("group_hash"), "prompt_version")
    hits, misses = store.cache_split(r.select("group_hash", "prompt_version"), keys, ["group_hash", "prompt_version"])
    return hits.select("group_hash", F.lit(True).alias("hit")).unionByName(
        misses.select("group_hash", F.lit(False).alias("hit")))


@query("cache_merge", _PARSE_SQL + KEPT + _CACHE + f"""
SELECT neighborhood_hash, item_ord, title, score, '{CURRENT_MODEL}' AS model, 'cache' AS origin
FROM cache WHERE NOT title LIKE 'red%'
UNION ALL
SELECT neighborhood_hash, item_ord, title, score, '{DEFAULT_CONFIG.discovery_model}' AS model, 'fresh' AS origin
FROM kept WHERE neighborhood_hash NOT IN (SELECT neighborhood_hash FROM cache)""")
def cache_merge(spark, d):
    r, cached = _cache(spark, d)
    cached = cached.withColumn("title", F.when(F.col("title").startswith("red"), F.lit(ERROR_TITLE))
                               .otherwise(F.col("title")))
    keys = cached.select(F.col("neighborhood_hash").alias("group_hash"), "prompt_version")
    _, misses = store.cache_split(r, keys, ["group_hash", "prompt_version"])
    fresh = disc.parse_constellations(misses, MIN).rows.withColumn("origin", F.lit("fresh"))
    merged = disc.merge_cached_constellations(cached.withColumn("origin", F.lit("cache")), fresh, CURRENT_MODEL,
                                              extra=["item_ord", "origin"])
    return merged.select("neighborhood_hash", F.col("item_ord").cast("int"), "title", "score", "model", "origin")


@query("table_counts", _PARSE_SQL + KEPT + """
SELECT 'ideas' AS table_name, (SELECT count(*) FROM documents)::BIGINT AS n
UNION ALL SELECT 'embeddings', (SELECT count(*) FROM embeddings)::BIGINT
UNION ALL SELECT 'constellations', (SELECT count(*) FROM kept)::BIGINT""")
def table_counts(spark, d):
    return store.table_counts({"ideas": td.table(spark, d, "documents"), "embeddings": td.table(spark, d, "embeddings"),
                               "constellations": _kept(spark, d)})


@query("clear_derived", """
SELECT 'ideas' AS table_name, (SELECT count(*) FROM documents)::BIGINT AS n
UNION ALL SELECT 'embeddings', 0::BIGINT UNION ALL SELECT 'constellations', 0::BIGINT
UNION ALL SELECT 'patterns', 0::BIGINT""")
def clear_derived(spark, d):
    """Clearing derived tables keeps the ideas: counts after publishing empty versions."""
    from ..streaming.jobs import scratch
    st = store.SnapshotStore(spark, scratch(spark, "store"))
    st.write("embeddings", td.vectors(spark, d).select("idea_id", "vec"))
    st.write("constellations", _kept(spark, d).select("neighborhood_hash", "title"))
    st.write("patterns", disc.parse_patterns(td.replies(spark, d, "patterns")).rows.select("cluster_hash", "pattern_title"))
    st.clear("embeddings", "idea_id long, vec array<double>")
    st.clear("constellations", "neighborhood_hash string, title string")
    st.clear("patterns", "cluster_hash string, pattern_title string")
    return store.table_counts({"ideas": td.table(spark, d, "documents"), "embeddings": st.read("embeddings"),
                               "constellations": st.read("constellations"), "patterns": st.read("patterns")})

"""Domain views over the driver tables (``/root/testdata/sf*/<table>.parquet``).

Every view is a lazy projection of a given table, so its size grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as pre-ingest items: url is the text's SHA-256, so copies collide."""
    return raw_from_documents(table(spark, sf_dir, "documents"))


def raw_from_documents(d: DataFrame) -> DataFrame:
    """The raw-item projection of documents (also applied to each streamed micro-batch)."""
    return d.select(
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("doc:"), F.sha2("text", 256)).alias("url"),
        F.col("source"),
        F.col("lang").alias("category"),
        F.lit("").alias("stack"),
        F.col("doc_id").alias("ingest_ord"),
    )


def ideas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the ideas table (one idea per document, ids = doc_id)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("idea_id"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.col("source"),
        F.concat(F.lit("doc:"), F.sha2("text", 256)).alias("url"),
        F.col("lang").alias("category"),
        F.lit("").alias("stack"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as dense vectors ``(idea_id, vec array<double>, label)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("idea_id"), F.col("embedding").cast("array<double>").alias("vec"),
                    F.col("label"))


def fixed_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings.label as a given clustering (10 clusters, all larger than 30)."""
    return vectors(spark, sf_dir).select("idea_id", F.col("label").alias("cluster_id"), "vec")


def small_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clustering with small clusters: cluster = vec_id % 25 (about 20 members each)."""
    return vectors(spark, sf_dir).select("idea_id", (F.col("idea_id") % 25).cast("int").alias("cluster_id"), "vec")


# model per event_type; two event types use models absent from the price list
LEDGER_MODEL_BY_EVENT = (
    ("view", "claude-haiku-4-5-20251001"),
    ("signup", "claude-sonnet-4-5-20250929"),
    ("click", "claude-opus-4-5-20251101"),
    ("error", "unpriced-model-a"),
    ("purchase", "unpriced-model-b"),
)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a token ledger ``(ts, model, stage, input_tokens, output_tokens)``."""
    return ledger_from_events(table(spark, sf_dir, "events"))


def ledger_from_events(ev: DataFrame) -> DataFrame:
    """The ledger projection (also applied to a stream of events)."""
    model = F.lit(None).cast("string")
    for et, m in reversed(LEDGER_MODEL_BY_EVENT):
        model = F.when(F.col("event_type") == et, F.lit(m)).otherwise(model)
    return ev.select(
        F.col("event_id"),
        F.col("ts"),
        model.alias("model"),
        F.when(F.col("user_id") % 2 == 0, F.lit("constellations")).otherwise(F.lit("patterns")).alias("stage"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("input_tokens"),
        F.floor(F.col("value") * 100).cast("bigint").alias("output_tokens"),
    )


# ---------------------------------------------------------------------------
# Reply texts derived from `part` (one reply per part row). The same SQL text runs in
# Spark (selectExpr) and in the DuckDB oracle, so both engines read identical replies.
# Variants: no JSON, malformed JSON, empty list, missing key, two constellations with
# scores below/at/above the minimum and actionability as number, string, 0, 14, x.5.
# ---------------------------------------------------------------------------
_C1 = ("'{\"type\": \"' || CASE p_partkey % 5 WHEN 0 THEN 'triangulation' WHEN 1 THEN 'spectrum' "
       "WHEN 2 THEN 'chain' WHEN 3 THEN 'convergence' ELSE 'absence' END || '\", \"idea_ids\": [' "
       "|| CAST(p_partkey AS STRING) || ', ' || CAST(p_partkey + 1 AS STRING) || ', ' || CAST(p_partkey + 2 AS STRING) "
       "|| '], \"title\": \"' || p_name || '\", \"explanation\": \"' || p_brand || ' ' || p_type || '\", \"score\": ' "
       "|| CAST(p_size % 10 + 1 AS STRING) || CASE p_partkey % 4 "
       "WHEN 0 THEN ', \"actionability\": ' || CAST(p_size % 16 - 1 AS STRING) "
       "WHEN 1 THEN ', \"actionability\": \"' || CAST(p_size % 10 AS STRING) || '\"' "
       "WHEN 2 THEN ', \"actionability\": ' || CAST(p_size % 5 AS STRING) || '.5' ELSE '' END || '}'")
_C2 = ("'{\"type\": \"absence\", \"idea_ids\": [' || CAST(p_partkey AS STRING) || '], \"title\": \"gap ' "
       "|| CAST(p_partkey AS STRING) || '\", \"explanation\": \"none\", \"score\": ' || CAST(p_size % 7 + 4 AS STRING) "
       "|| ', \"actionability\": ' || CAST(p_size % 16 - 1 AS STRING) || '}'")
REPLY_TEXT_SQL = (
    "CASE p_partkey % 8 WHEN 0 THEN 'Nothing stands out in this group.' "
    "WHEN 1 THEN 'Result:' || chr(10) || '{\"constellations\": [{\"type\": \"chain\" \"score\": 7}]}' "
    "WHEN 2 THEN '{\"constellations\": []}' "
    "WHEN 3 THEN 'Sure.' || chr(10) || '{\"summary\": \"none\"}' "
    f"ELSE 'Here is what I found:' || chr(10) || '{{\"constellations\": [' || {_C1} || ', ' || {_C2} "
    "|| ']}' || chr(10) || 'Hope this helps.' END")
_P1 = ("'{\"name\": \"' || p_type || ' ' || p_brand || '\", \"idea_ids\": [' || CAST(p_partkey AS STRING) || ', ' "
       "|| CAST(p_partkey + 7 AS STRING) || '], \"explanation\": \"' || p_name || '\"}'")
_P2 = "'{\"name\": \"theme ' || CAST(p_partkey % 13 AS STRING) || '\", \"explanation\": \"no ids\"}'"
PATTERN_TEXT_SQL = (
    "CASE p_partkey % 6 WHEN 0 THEN 'no json here' "
    f"WHEN 1 THEN '{{\"patterns\": [' || {_P1} || ' \"oops\"]}}' "
    "WHEN 2 THEN '{\"patterns\": []}' "
    f"ELSE 'Patterns:' || chr(10) || '{{\"patterns\": [' || {_P1} || ', ' || {_P2} || ']}}' END")
REPLY_HASH_SQL = "sha2('part:' || CAST(p_partkey AS STRING), 256)"
REPLY_HASH_DUCK = "sha256('part:' || CAST(p_partkey AS STRING))"


def replies(spark: SparkSession, sf_dir: str, kind: str = "constellations", extra: bool = False) -> DataFrame:
    """part rows as stored responder replies (RESPONSE_SCHEMA)."""
    from ..config import DEFAULT_CONFIG, DISCOVERY_PROMPT_VERSION, PATTERNS_PROMPT_VERSION
    text = REPLY_TEXT_SQL if kind == "constellations" else PATTERN_TEXT_SQL
    model = DEFAULT_CONFIG.discovery_model if kind == "constellations" else DEFAULT_CONFIG.patterns_model
    version = DISCOVERY_PROMPT_VERSION if kind == "constellations" else PATTERNS_PROMPT_VERSION
    p = table(spark, sf_dir, "part")
    return p.selectExpr(f"{REPLY_HASH_SQL} AS group_hash", f"'{version}' AS prompt_version", f"'{model}' AS model",
                        f"'{kind}' AS stage", f"{text} AS text", "CAST(length(p_name) * 40 AS BIGINT) AS input_tokens",
                        "CAST(p_size * 10 AS BIGINT) AS output_tokens", "'ok' AS status",
                        "CAST(NULL AS STRING) AS error", *(["p_size"] if extra else []))


def stored_replies(prompts: DataFrame) -> DataFrame:
    """Stored replies ``(group_hash, prompt, text, input_tokens, output_tokens)`` for prompts ``(group_hash, prompt)``.

    One JSON reply per prompt that names its first three items; kind and score come from its SHA-256.
    """
    byte = lambda at, n: F.conv(F.substring("h", at, n), 16, 10).cast("int")
    ids = F.array_join(F.slice(F.regexp_extract_all("prompt", F.lit(r"\[ID:(\d+)\]"), 1), 1, 3), ", ")
    kinds = F.array(*[F.lit(x) for x in ("triangulation", "spectrum", "chain", "convergence", "absence")])
    kind, name = F.get(kinds, byte(1, 1) % 5), F.substring("h", 1, 6)
    actionability = F.when(kind == "absence", F.concat(F.lit(', "actionability": '), byte(4, 2) % 14, F.lit(".5"))).otherwise(F.lit(""))
    found = F.concat(F.lit('{"constellations": [{"type": "'), kind, F.lit('", "idea_ids": ['), F.col("ids"), F.lit('], "title": "group '), name,
                     F.lit('", "explanation": "items ['), F.col("ids"), F.lit(']", "score": '), byte(2, 2) % 10 + 1, actionability, F.lit("}]}"))
    themes = F.concat(F.lit('{"patterns": [{"name": "theme '), name, F.lit('", "idea_ids": ['), F.col("ids"),
                      F.lit('], "explanation": "shared by '), F.when(F.col("ids") == "", 0).otherwise(F.size(F.split("ids", ", "))), F.lit('"}]}'))
    p = prompts.select("group_hash", "prompt", F.sha2("prompt", 256).alias("h"), ids.alias("ids"))
    text = F.concat(F.lit("Here is what I found:\n"), F.when(F.col("prompt").contains('"patterns"'), themes).otherwise(found))
    return p.select("group_hash", "prompt", text.alias("text")).select(
        "*", F.floor(F.length("prompt") / 4).alias("input_tokens"), F.floor(F.length("text") / 4).alias("output_tokens"))

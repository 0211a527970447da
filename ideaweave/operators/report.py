"""Result shaping, summaries and export tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EXPORT_PROMPT_VERSION, LANDING_DEFAULTS, TOP_EXPLANATION_CHARS
from ..functions.text import cut


def by_type(constellations: DataFrame) -> DataFrame:
    return constellations.groupBy("constellation_type").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def top_constellations(constellations: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` by score (descending), ties by hash and item order -- a TakeOrdered, not a full sort."""
    top = constellations.orderBy(F.desc("score"), "neighborhood_hash", "item_ord").limit(n)
    return top.select("neighborhood_hash", "item_ord", "score", F.upper("constellation_type").alias("label"), "title",
                      cut(F.coalesce("explanation", F.lit("")), TOP_EXPLANATION_CHARS).alias("explanation"))


def member_titles(constellations: DataFrame, ideas: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Titles of each constellation's ids, in order; an unknown id is shown as the id.

    The exploded ids are the small side: below the checked bound they are broadcast against
    the ideas table (scanned, not shuffled); the title lookup is then merged back in order.
    """
    ex = constellations.select("neighborhood_hash", "item_ord", F.posexplode("idea_ids").alias("pos", "idea_id"))
    ids = ex.select("idea_id").distinct()
    small = F.broadcast(ids) if ids.count() <= broadcast_max_rows else ids
    titles = ideas.select("idea_id", "title").join(small, "idea_id")
    j = ex.join(titles, "idea_id", "left")
    return (j.groupBy("neighborhood_hash", "item_ord")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                F.struct("pos", F.coalesce("title", F.col("idea_id").cast("string")).alias("t")))), lambda x: x["t"]),
                " | ").alias("titles")))


def cluster_listing(assign: DataFrame, ideas: DataFrame) -> DataFrame:
    """Members with titles per cluster in long form (cluster_id, idea_id, title); no group is collected."""
    return assign.select("idea_id", "cluster_id").join(ideas.select("idea_id", "title"), "idea_id", "left")


def ideas_lookup(ideas: DataFrame) -> DataFrame:
    return ideas.select("idea_id", "title", "url", "source", "category", "description")


def export_ideas(ideas: DataFrame, fecha: str | None = None) -> DataFrame:
    """Landing export: renamed columns and constant defaults, url unique *including* empty -- the lowest
    id wins per url. ``fecha`` is the day of the export (``yyyy-mm-dd``; None: today in the session's zone)."""
    day = F.date_format(F.current_date(), "yyyy-MM-dd") if fecha is None else F.lit(fecha)
    # ids alone meet in the aggregate; texts are read where they are
    first = ideas.groupBy("url").agg(F.min("idea_id").alias("idea_id")).select("idea_id")
    return ideas.join(first, "idea_id", "left_semi").select(
        F.col("idea_id").alias("id"), F.col("title").alias("nombre"), "url", F.col("description").alias("descripcion"),
        F.col("source").alias("fuente"), F.col("category").alias("categoria"), "stack", day.alias("fecha"),
        *[F.lit(value).alias(name) for name, value in LANDING_DEFAULTS],
        *[F.col(c) for c in ("created_at",) if c in ideas.columns])


def export_constellations(cached: DataFrame, prompt_version: str = EXPORT_PROMPT_VERSION) -> DataFrame:
    """Every stored constellation with its ``created_at``, prompt version rewritten, actionability dropped."""
    out = cached.withColumn("prompt_version", F.lit(prompt_version))
    return out.drop("actionability") if "actionability" in out.columns else out


def export_patterns(patterns: DataFrame, order_col: str = "write_seq") -> DataFrame:
    """Patterns unique on (cluster_hash, pattern_title, prompt_version); the first written wins."""
    key = ["cluster_hash", "pattern_title", "prompt_version"]
    others = [c for c in patterns.columns if c not in key]
    return (patterns.groupBy(*key).agg(F.min_by(F.struct(*others), F.col(order_col)).alias("_r"))
            .select(*key, "_r.*"))


def require_min_ideas(ideas: DataFrame, n: int = 3) -> int:
    """At least ``n`` loadable ideas are needed (reads at most n rows)."""
    got = ideas.limit(n).count()
    if got < n:
        raise ValueError(f"a run takes {n} loadable ideas or more, got {got}")
    return got


def export_counts(source: dict, exported: dict) -> DataFrame:
    """Per exported table: rows read from the source and rows actually written (both reported).

    ``source`` / ``exported`` map a table name to a DataFrame; each count is one aggregate.
    """
    spark = next(iter(source.values())).sparkSession
    rows = [(name, int(source[name].count()), int(exported[name].count())) for name in source]
    return spark.createDataFrame(rows, "table_name string, source_rows long, exported_rows long")

"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, langid, lexical, licenses, mixing, negatives, quality, secrets, simhash, substring, suffix_dedup,
               tokens, warc)
from .common import materialise, read_table, shared_path
from .sql import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    if fn.__name__ in SQL:
        ORACLE[fn.__name__] = SQL[fn.__name__].strip()
    return fn


def _length(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs, out="q").select("doc_id", *[f"q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", _length(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score",
        "language.ambiguous")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in secrets.BASE_RULES]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    found = secrets.scan(docs, out="s").select("doc_id", F.col("s.spans").alias("found"))
    of = lambda kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(joined(of(base)), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = shared_path(spark, "warc")
    materialise(warc.write(warc.plan_records(pages), path), "warc-files")
    got = warc.records(warc.read(spark, path))
    full = F.col("payload")
    return got.select("page_id", F.coalesce(F.octet_length(full).cast("long"), F.col("payload_length")).alias("payload_bytes"),
                      F.coalesce(F.sha1(full), F.col("stored_digest")).alias("payload_digest"), "record_type", "refers_to")


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select(F.col("id").alias("doc_id"), "n_words", _length(F.col("spans")).alias("n_removed"),
                                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), out="k").select("doc_id", "k.*")
    hit = _length(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, out="k").select("doc_id", "k.digest", "k.license_id",
                                               F.array_join("k.notices", ",").alias("notices"))


@query
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    name, path = public_tokenizers.path("word_bpe_49k.json"), shared_path(spark, "tokens")
    base = tokens.offsets(materialise(tokens.write(docs, path, name, end_id=2), "token-files"))
    got = tokens.read(spark, path).select("file", F.col("id").alias("doc_id"), "first", F.col("n").alias("n_tokens"),
                                          F.crc32("ids").alias("ids_crc32"))
    return got.join(base, "file").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialise(negatives.integer_rows(e, "vec_id", label, "embedding"), "vectors")
    return negatives.mine(rows, negatives.build(rows), rows.where(F.col("id") % 50 == 0))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(lexical.stored(docs), read_table(spark, sf_dir, "benchmark"))

"""The training-text pipeline: five stages over ``documents``.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ideaweave.llm import decontam, langid, mixing, secrets, simhash
from ideaweave.llm.common import free_name, materialise, read_table
from ideaweave.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (``und``). Where the two best languages are close the operator
    sets a flag (``ambiguous``); such documents have a language and stay."""
    ship_package(spark)
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    name = free_name(docs, "language")
    found = langid.predict(docs, model, out=name)
    return found.where(F.col(f"{name}.lang_pred") != langid.UND).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of every group of near copies."""
    ship_package(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    ship_package(spark)
    name = free_name(docs, "leak")
    found = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), out=name)
    return found.where(F.size(f"{name}.spans") == 0).select(*docs.columns)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; ``n_chars`` follows the new text."""
    ship_package(spark)
    name = free_name(docs, "secrets")
    clean = F.col(f"{name}.redacted")
    new = {"text": F.coalesce(clean, F.col("text")),
           "n_chars": F.when(clean.isNotNull(), F.length(clean).cast("long")).otherwise(F.col("n_chars"))}
    return secrets.scan(docs, out=name).select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document that is left."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "taken")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", remove_secrets),
    ("mix", mix),
]

ORACLE_SQL = None  # fingerprints, classifiers and automata are beyond SQL; tests/llm has a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

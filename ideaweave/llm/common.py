"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpointing, ship_package

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run without ASCII white space
WORD_BYTES = rb"[^\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` once (a lambda variable is not evaluated again)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # Python workers import this package
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpointing(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, computes it once.

    ``rows_per_file`` (0: no bound) is for rows of megabytes: Parquet's writer measures its buffer every 100 rows
    at the earliest and its reader takes up to 4,096 rows of a file at a time.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

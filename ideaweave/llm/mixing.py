"""Mixing sources to target weights.

Each document gets a hash-random key; the rows are range-sorted by (source, key), so one source
is spread over as many partitions as its size asks for. Prefix sums of the sizes come from two
levels: sums per (partition, source) and running sums inside each slice. A source whose target is
``e`` times its size plus a rest takes every document ``e`` times, then documents in key order up to
the rest; the document at the cut gives only the words still missing.

Defined results: a null text has size 0; null is a source of its own, after all others; repeated
rows are rows of their own (equal rows share their key, so which of them is cut does not show);
an empty table gives an empty result. Reruns give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_within
from .common import WORD, materialise

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5  # words of the mix as a share of all words
MAX_EPOCHS = 2.0  # no source gives more than this many times its size


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Water-filling: the level rises over the sources that are not full until no target is above its
    limit. Only sums reach the driver; the number of rounds is that of the steps by which sources fill.
    """
    ranked = rank_within(
        sources.withColumn("_g", F.lit(0)).withColumn("_n", F.col("source").isNull().cast("int"))
        .withColumn("_s", F.coalesce(F.col("source"), F.lit(""))), "_g", ["_n", "_s"])
    weight = F.array(*[F.lit(float(w)) for w in weights])
    t = materialise(ranked.select(
        "source", "source_size",
        F.get(weight, ((F.col("rank") - 1) % len(weights)).cast("int")).alias("w"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("limit")), "mix-targets")
    total = (t.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        at = F.col("w") * F.lit(level) >= F.col("limit") if full >= 0 else F.lit(False)
        r = t.agg(F.sum(F.when(at, 1).otherwise(0)).alias("n"),
                  F.sum(F.when(at, F.col("limit")).otherwise(0.0)).alias("used"),
                  F.sum(F.when(at, 0.0).otherwise(F.col("w"))).alias("w")).first()
        if not r["w"] or r["n"] == full:
            break
        full, level = r["n"], max((total - r["used"]) / r["w"], 0.0)
    return t.select("source", "source_size", F.least(F.col("w") * F.lit(level), F.col("limit")).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
        weights=WEIGHTS, share: float = TOTAL_SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(id_col, source, size, source_size, target, taken)`` for every row of ``df``."""
    spark = df.sparkSession
    rows = df.select(df[id_col].alias("id"), df[source].cast("string").alias("source"),
                     size_of(df[text]).alias("size"),
                     F.md5(F.concat_ws(":", F.lit(str(seed)), df[id_col].cast("string"))).alias("key"))
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "key", "id", "size"]
    ranged = materialise(rows.repartitionByRange(p, *order).withColumn("pid", F.spark_partition_id()), "mix-rows")
    # sums per (slice, source): at most slices + sources rows
    sums = ranged.groupBy("pid", "source").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("pid", F.col("source").alias("src"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    goal = targets(ranged.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    plan = (offsets.join(goal.withColumnRenamed("source", "src2"), F.col("src").eqNullSafe(F.col("src2")))
            .select(F.col("pid").alias("pid2"), "src", "offset", "source_size", "target"))
    inside = (Window.partitionBy("pid", "source").orderBy("key", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    run = ranged.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    j = run.join(plan, (F.col("pid") == F.col("pid2")) & F.col("source").eqNullSafe(F.col("src")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    rest = F.least(F.col("size"), F.greatest(F.lit(0), F.col("budget") - F.col("offset") - F.col("before")))
    return (j.withColumn("epochs", epochs.cast("long")).withColumn("budget", budget)
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + rest).cast("long").alias("taken")))

"""Token-cost ledger.

The price list is a fixed five-row table, so broadcasting it is bounded by construction.
Unknown models contribute nothing to cost (inner join) but their tokens still count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MODEL_PRICING


def pricing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MODEL_PRICING), "model string, input_per_million double, output_per_million double")


def cost_col() -> F.Column:
    return (F.col("input_tokens") / F.lit(1_000_000.0) * F.col("input_per_million")
            + F.col("output_tokens") / F.lit(1_000_000.0) * F.col("output_per_million"))


def priced(ledger: DataFrame) -> DataFrame:
    return ledger.join(F.broadcast(pricing(ledger.sparkSession)), "model").withColumn("cost", cost_col())


def cost_total(ledger: DataFrame) -> DataFrame:
    return priced(ledger).agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"))


def cost_by_stage(ledger: DataFrame) -> DataFrame:
    return priced(ledger).groupBy("stage").agg(F.sum("cost").alias("cost"))


def tokens_by_stage(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("stage").agg(F.sum("input_tokens").cast("bigint").alias("input_tokens"),
                                       F.sum("output_tokens").cast("bigint").alias("output_tokens"))


def cost_labels(ledger: DataFrame, digits: int = 4) -> DataFrame:
    """Cost per stage and in total (stage ``TOTAL``) as text with ``digits`` decimals, for summaries.

    Costs are rounded as decimals, half up, so a label does not depend on a binary rest.
    """
    total = cost_total(ledger).select(F.lit("TOTAL").alias("stage"), F.col("total_cost").alias("cost"))
    exact = F.round(F.round("cost", 9).cast("decimal(38,9)"), digits)
    return cost_by_stage(ledger).unionByName(total).select("stage", F.concat(F.lit("$"), exact.cast("string")).alias("label"))


def over_budget(ledger: DataFrame, budget: float) -> DataFrame:
    return cost_total(ledger).select("total_cost", F.lit(float(budget)).alias("budget"),
                                     (F.col("total_cost") > F.lit(float(budget))).alias("over_budget"))


def ledger_from_responses(responses: DataFrame) -> DataFrame:
    """Ledger rows of successful calls (stage, model, tokens) from a response table."""
    return responses.where(F.col("status") == "ok").select("model", "stage", "input_tokens", "output_tokens")

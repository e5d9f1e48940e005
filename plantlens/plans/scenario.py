"""Ranking jobs over the scenario table (D5, D7).  Definitions are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_actions(recommendations: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` highest-savings actions per plant (the top-k is the feature).

    ``row_number`` over (plant) ordered by savings, ties broken by id so the
    cut is repeatable.  Spark plans this as a per-plant top-k window.
    """
    w = Window.partitionBy("plant_name").orderBy(F.col("expected_savings_usd").desc(), "recommendation_id")
    return (recommendations.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("plant_name", "rank", "recommendation_id", "type", "plant_line", "expected_savings_usd"))


def upgrade_ranking(equipment: DataFrame, value_per_tph: float = 10000.0,
                    upgrade_cost_usd: float = 100000.0) -> DataFrame:
    """Machines of every line ranked by the value of their lost
    throughput, with a simple payback (cost / yearly value) in years."""
    lost = F.greatest(F.coalesce(F.col("equipment_rated_throughput_tph")
                                 - F.col("effective_rated_throughput_tph"), F.lit(0.0)), F.lit(0.0))
    value = lost * F.lit(value_per_tph)
    w = Window.partitionBy("plant_name", "plant_line").orderBy(F.col("lost_value_usd").desc(), "equipment_id",
                                                               "commission_date")
    return (equipment.select("plant_name", "plant_line", "equipment_id", "equipment_type", "commission_date",
                             lost.alias("lost_tph"), value.alias("lost_value_usd"))
            .withColumn("rank", F.rank().over(w))
            .withColumn("payback_years", F.when(F.col("lost_value_usd") > 0,
                                                 F.lit(upgrade_cost_usd) / F.col("lost_value_usd"))))

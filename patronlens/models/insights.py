"""One JSON record of key figures per run date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_insight(customer_360: DataFrame, mart_orders: DataFrame, run_date: date) -> DataFrame:
    """run_date and insight_json: customers, active customers, spend, orders."""
    people = customer_360.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if("is_active").alias("active_customers"),
        F.count_if(F.col("rfm_score") == "R5F5M5").alias("top_customers"),
        F.sum("total_spend_365d_usd").cast("decimal(20,2)").alias("spend_365d_usd"),
        F.sum("open_ticket_count").alias("open_tickets"),
    )
    orders = mart_orders.agg(
        F.struct(
            F.count(F.lit(1)).alias("orders"),
            F.sum("total_amount_usd").cast("decimal(20,2)").alias("order_value_usd"),
        ).alias("o")
    )
    figures = people.withColumn("o", orders.scalar()).select(*people.columns, "o.*")
    return figures.select(
        F.lit(run_date).alias("run_date"),
        F.to_json(F.struct(*figures.columns)).alias("insight_json"),
    )

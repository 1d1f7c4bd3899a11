"""Stored results of the daily side jobs: anomalies, insights, ticket topics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from patronlens.models.topics import with_topics
from patronlens.sources.tables import TableStore

ANOMALY_TABLE = "daily_anomalies"
INSIGHT_TABLE = "daily_insights"
INSIGHT_DDL = "insight_json string, run_date date"
TICKET_TABLE = "mart_support_tickets"


def store_outputs(store: TableStore, anomalies: DataFrame, insight: DataFrame) -> None:
    """Replace the run dates that the two frames hold; one insight row per run date."""
    store.write_partition(ANOMALY_TABLE, anomalies, "run_date")
    store.write_partition(INSIGHT_TABLE, insight.select("insight_json", "run_date"), "run_date")


def store_topics(store: TableStore, topics: DataFrame) -> DataFrame:
    """Publish the ticket mart with its cluster columns filled in; returns a scan of it."""
    filled = with_topics(store.read(TICKET_TABLE), topics)
    written = store.write(TICKET_TABLE, filled)
    store.publish({TICKET_TABLE: written})
    return written[1]

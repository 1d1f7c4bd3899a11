"""The daily job: load, build the layers, score, store topics, anomalies and insight, tidy up."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.models.features import load_features
from patronlens.models.insights import daily_insight
from patronlens.models.outputs import store_outputs, store_topics
from patronlens.models.scoring import run_scoring
from patronlens.models.topics import ticket_topics
from patronlens.operators.anomaly import daily_anomalies, daily_metrics
from patronlens.plans import staging
from patronlens.plans.ingest import load_all
from patronlens.plans.pipeline import CUSTOMER_360, build_layers
from patronlens.quality.gate import FAILURE_TABLE
from patronlens.quality.stored import compact_counts
from patronlens.runlog import EVENT_TABLE, RunResult, logged_run
from patronlens.schema import DQ_FAILURE_DDL, RAW_KEYS, RUN_EVENT_DDL
from patronlens.sources.raw import RawTables
from patronlens.sources.tables import TableStore
from patronlens.workspace import in_parallel, stage

KEPT_PUBLICATIONS = 30


def stored_raw(store: TableStore) -> RawTables:
    return RawTables(**{table: store.read(table) for table in RAW_KEYS})


def transform(store: TableStore, run_date: date) -> dict[str, DataFrame]:
    """Build and store all layers from the loaded tables, in a logged run."""
    tables: dict[str, DataFrame] = {}

    def build() -> RunResult:
        tables.update(build_layers(store, stored_raw(store), run_date))
        counts = in_parallel(store.spark, {t: df.where(F.col("_run_date") == F.lit(run_date)).count for t, df in tables.items()})
        return RunResult(rows_transformed=sum(counts.values()))

    logged_run(store, run_date, "transform", build)
    return tables


def score(store: TableStore, tables: dict[str, DataFrame], run_date: date, scored_at: datetime) -> None:
    """Train the models and store the scores of every customer, in a logged run."""

    def run() -> RunResult:
        features = load_features(tables[CUSTOMER_360], run_date)
        return RunResult(rows_transformed=run_scoring(store, features, run_date, scored_at).count())

    logged_run(store, run_date, "scoring", run)


def find_topics(raw: RawTables) -> DataFrame:
    """The topics of all tickets, written to the scratch folder."""
    return stage(ticket_topics(staging.stg_tickets(raw.tickets)), "ticket-topics")


def side_outputs(
    store: TableStore, tables: dict[str, DataFrame], run_date: date, found: Callable[[], DataFrame] | None = None
) -> None:
    """Ticket topics in the ticket mart, the day's anomalies and its insight, in a logged run. ``found``
    returns the topics where they are being looked for already, or raises what stopped that."""

    def run() -> RunResult:
        raw = stored_raw(store)
        topics = found() if found else find_topics(raw)
        store_topics(store, topics)
        daily = daily_metrics(
            tables["mart_orders"], staging.stg_events(raw.events, wide=False), tables["mart_support_tickets"]
        )
        today = F.col("run_date") == F.lit(run_date)
        anomalies = daily_anomalies(daily).where(today)
        features = tables[CUSTOMER_360].where(F.col("_run_date") == F.lit(run_date))
        store_outputs(store, anomalies, daily_insight(features, tables["mart_orders"], run_date))
        return RunResult(rows_transformed=topics.count())

    logged_run(store, run_date, "side_outputs", run)


def tidy(store: TableStore, keep: int = KEPT_PUBLICATIONS) -> int:
    """Put small files of the raw tables and logs together and delete what the last ``keep``
    publications do not show; the number of files and folders that went."""
    for table, keys in RAW_KEYS.items():
        store.publish(store.compact(table, keys))
    store.publish(compact_counts(store))
    for table, ddl in ((EVENT_TABLE, RUN_EVENT_DDL), (FAILURE_TABLE, DQ_FAILURE_DDL)):
        store.compact_log(table, ddl)
    return store.drop_old(keep)


def run_day(store: TableStore, batch: RawTables, run_date: date, scored_at: datetime) -> dict[str, DataFrame]:
    """All steps of a day. A step that fails ends the job; what earlier steps published stays, and the
    day may be run again.

    Topics need the loaded tickets alone. They are looked for beside the many small jobs of the layers and
    the scores, and only stored, by ``side_outputs``, after them: one step publishes at a time.
    """
    load_all(store, batch, run_date)
    raw = stored_raw(store)
    with ThreadPoolExecutor(1) as beside:
        topics = beside.submit(inheritable_thread_target(store.spark)(find_topics), raw)
        tables = transform(store, run_date)
        score(store, tables, run_date, scored_at)
        side_outputs(store, tables, run_date, topics.result)
    tidy(store)
    return tables

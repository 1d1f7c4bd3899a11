"""Customer metrics that are carried from one run date to the next.

Orders are kept as partial aggregates per customer and day, in partitions by day. The metrics
of a customer are a row of a keyed table. A new run date adds the orders that have come or changed, and
moves the days whose place in a trailing window differs between the two dates: those leave one
window and may enter another. So it reads the partitions of these days and the files of the
customers in them, not the history. Counts and sums are added and subtracted; the
last day with an order is kept as such, and looked up again only for customers who lost an order. The result equals ``intermediate.int_customer_orders`` on all orders.

The same holds for the latest event of a customer and the bounds of a session, which only grow, and for
the open tickets of a customer, where the old versions of changed tickets are taken away.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import whole_days_until
from patronlens.plans.intermediate import MONEY
from patronlens.schema import OPEN_TICKET_STATUSES
from patronlens.sources.tables import Entry, TableStore, Written
from patronlens.workspace import stage

STATE = "state_customer_orders"
DAYS = "mart_daily_customer_orders"
PROGRESS = "state_customer_orders_date"
DAYS_DDL = "customer_id string, n long, spend decimal(38,2), day date"

#: Days before the run date at which a window begins and the day before which it ends.
WINDOWS = {"365d": (365, None), "30d": (30, None), "prior": (60, 30)}
_SUMS = ("n", "spend", "n_365d", "spend_365d", "n_30d", "n_prior")


def _inside(day: Column, window: str, run_date: date) -> Column:
    first, end = WINDOWS[window]
    found = day >= F.lit(run_date - timedelta(days=first))
    return found if end is None else found & (day < F.lit(run_date - timedelta(days=end)))


def moving_days(before: date, after: date) -> list[date]:
    """The days whose place in a window differs between two run dates."""
    edges = {edge for window in WINDOWS.values() for edge in window if edge is not None}
    passed = range((after - before).days)
    return sorted({before - timedelta(days=edge - n) for edge in edges for n in passed})


def by_day(orders: DataFrame) -> DataFrame:
    """Partial aggregates per customer and day."""
    return orders.groupBy("customer_id", F.to_date("ordered_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_amount_usd").cast("decimal(38,2)").alias("spend"),
    )


def _changes(days: DataFrame, whole: int, inside: dict[str, Column]) -> DataFrame:
    """What rows per customer and day add to each sum; ``inside`` says how often a day counts in a window,
    ``whole`` how often at all."""

    def counted(value: str, times: Column | int) -> Column:
        return F.sum(F.col(value) * times)

    return days.groupBy("customer_id").agg(
        counted("n", F.lit(whole)).alias("n"),
        counted("spend", F.lit(whole)).cast("decimal(38,2)").alias("spend"),
        counted("n", inside["365d"]).alias("n_365d"),
        counted("spend", inside["365d"]).cast("decimal(38,2)").alias("spend_365d"),
        counted("n", inside["30d"]).alias("n_30d"),
        counted("n", inside["prior"]).alias("n_prior"),
    )


def _added(days: DataFrame, run_date: date, sign: int = 1) -> DataFrame:
    inside = {w: sign * _inside(F.col("day"), w, run_date).cast("int") for w in WINDOWS}
    return _changes(days, sign, inside)


def _moved(days: DataFrame, before: date, after: date) -> DataFrame:
    place = {w: _inside(F.col("day"), w, after).cast("int") - _inside(F.col("day"), w, before).cast("int") for w in WINDOWS}
    return _changes(days, 0, place)


def _read_days(store: TableStore, days: Iterable[date]) -> DataFrame:
    """The stored partitions of some days; no other is listed or read."""
    return store.read_dates(DAYS, DAYS_DDL, "day", sorted(set(days)))


def _last_days(days: DataFrame) -> DataFrame:
    return days.groupBy("customer_id").agg(F.max("day").alias("last_day"))


def _merge_state(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """State rows with their changes added; ``known`` says that the last day was looked up."""
    old = stored.select("customer_id", F.struct(*_SUMS, "last_day").alias("old"))
    both = old.join(changes.withColumn("new", F.struct(*_SUMS, "last_day", "known")).select("customer_id", "new"), "customer_id", "full_outer")

    def total(name: str) -> Column:
        zero = F.lit(0)
        value = F.coalesce(F.col(f"old.{name}"), zero) + F.coalesce(F.col(f"new.{name}"), zero)
        return value.cast("decimal(38,2)" if name.startswith("spend") else "long").alias(name)

    last = F.when(F.col("new.known"), F.col("new.last_day")).otherwise(
        F.greatest("old.last_day", "new.last_day")
    )
    merged = both.select("customer_id", *[total(c) for c in _SUMS], last.alias("last_day"))
    return merged.where("n > 0")


def _days_of(orders: DataFrame) -> list[date]:
    """The days of a batch: one row per day reaches the driver."""
    return sorted(r.day for r in orders.select(F.to_date("ordered_at").alias("day")).distinct().collect())


def state_date(store: TableStore) -> date | None:
    """The run date that the stored metrics belong to."""
    found = store._entries(PROGRESS).get("")
    return date.fromisoformat(found.path) if found else None


def advance_orders(
    store: TableStore, run_date: date, fresh: DataFrame, replaced: DataFrame | None = None
) -> DataFrame:
    """Bring the order metrics of all customers to ``run_date`` and return them.

    ``fresh`` holds the orders with items that are new or changed since the last date, ``replaced`` the
    old versions of those that changed or went. The days, the metrics and the date become
    visible one after the other; where a run stops between them, ``rebuild`` from all orders.
    """
    before = state_date(store)
    if before is not None and run_date < before:
        raise ValueError(f"the metrics are those of {before} already")
    fresh = stage(fresh.select("customer_id", "total_amount_usd", "ordered_at"), "fresh-orders")
    came = by_day(fresh)
    changes = [_added(came, run_date)]
    gone = None
    if replaced is not None:
        replaced = stage(replaced.select("customer_id", "total_amount_usd", "ordered_at"), "replaced-orders")
        gone = by_day(replaced)
        changes.append(_added(gone, run_date, -1))
    if before is not None and before < run_date:
        changes.append(_moved(_read_days(store, moving_days(before, run_date)), before, run_date))
    total = changes[0]
    for more in changes[1:]:
        total = total.unionByName(more)
    sums = total.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    sums = stage(sums.join(_last_days(came), "customer_id", "left").withColumn("known", F.lit(False)), "order-changes")
    _store_days(store, fresh, came, replaced, gone)
    if gone is not None:
        lost = replaced.select("customer_id").distinct()
        latest = _last_days(store.read_partitioned(DAYS, DAYS_DDL).join(lost, "customer_id", "left_semi"))
        marked = lost.withColumn("lost", F.lit(True)).join(latest.withColumnRenamed("last_day", "latest"), "customer_id", "left")
        sums = sums.drop("known").join(marked, "customer_id", "left").withColumn("known", F.coalesce("lost", F.lit(False)))
        last = F.when(F.col("known"), F.col("latest")).otherwise(F.col("last_day"))
        sums = sums.withColumn("last_day", last).drop("lost", "latest")
    parts, whole = store.merge_keyed(STATE, sums, ["customer_id"], _first_or_merged)
    parts[PROGRESS] = Entry(run_date.isoformat(), "date string")
    store.publish(parts)
    return customer_orders(whole, run_date)


def _first_or_merged(stored: DataFrame, changes: DataFrame) -> DataFrame:
    return _merge_state(stored.select("customer_id", *_SUMS, "last_day"), changes)


def _store_days(
    store: TableStore, fresh: DataFrame, came: DataFrame, replaced: DataFrame | None, gone: DataFrame | None
) -> None:
    """Rewrite the partitions of the days that the batch touches, with what it adds and takes away."""
    touched = _days_of(fresh if replaced is None else fresh.unionByName(replaced))
    if not touched:
        return
    parts = came.select("customer_id", "day", "n", "spend")
    if state_date(store) is not None:
        parts = parts.unionByName(_read_days(store, touched).select(*parts.columns))
    if gone is not None:
        parts = parts.union(gone.select("customer_id", "day", -F.col("n"), -F.col("spend")))
    merged = parts.groupBy("customer_id", "day").agg(
        F.sum("n").alias("n"), F.sum("spend").cast("decimal(38,2)").alias("spend")
    )
    days = stage(merged.where("n > 0").select("customer_id", "n", "spend", "day"), "order-days")
    emptied = set(touched) - {r.day for r in days.select("day").distinct().collect()}
    store.write_partition(DAYS, days.repartition("day"), "day")
    for day in emptied:
        store.drop_partition(DAYS, "day", day)


def customer_orders(state: DataFrame, run_date: date) -> DataFrame:
    """The metrics in the layout of ``int_customer_orders``."""
    money = lambda c: F.col(c).cast(MONEY)
    return state.select(
        "customer_id",
        F.col("n").alias("total_order_count"),
        money("spend").alias("total_spend_usd"),
        F.col("n_365d").alias("order_frequency_365d"),
        money("spend_365d").alias("total_spend_365d_usd"),
        F.col("n_30d").alias("order_count_last_30d"),
        F.col("n_prior").alias("order_count_prior_30d"),
        whole_days_until(run_date, F.col("last_day")).alias("days_since_last_order"),
        F.lit(run_date).alias("_run_date"),
    )


# --- events, sessions, tickets ---


def _keep_greatest(key: str, least: str | None, greatest: str):
    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        found = [F.max(greatest).alias(greatest)]
        found += [F.min(least).alias(least)] if least else []
        return stored.unionByName(batch).groupBy(key).agg(*found).select(*batch.columns)

    return merge


def advance_events(store: TableStore, events: DataFrame) -> Written:
    """Merge new staged events into the latest event per customer and the bounds per session; the files
    that change, unpublished. An event that comes again changes nothing."""
    events = stage(events.select("customer_id", "session_id", "occurred_at"), "fresh-events")
    by_customer = events.groupBy("customer_id").agg(F.max("occurred_at").alias("last_event_at"))
    by_session = events.groupBy("session_id").agg(
        F.min("occurred_at").alias("session_start"), F.max("occurred_at").alias("session_end")
    )
    latest = store.merge_keyed(
        "state_customer_events", by_customer, ["customer_id"], _keep_greatest("customer_id", None, "last_event_at")
    )[0]
    bounds = store.merge_keyed(
        "state_sessions", by_session, ["session_id"], _keep_greatest("session_id", "session_start", "session_end")
    )[0]
    return latest | bounds


def advance_tickets(store: TableStore, fresh: DataFrame, replaced: DataFrame | None = None) -> Written:
    """Merge changed tickets, less their old versions, into the open tickets per customer; the
    files that change, unpublished. A customer stays, with none, once a ticket was seen."""

    def counted(tickets: DataFrame, sign: int) -> DataFrame:
        is_open = F.col("status").isin(*OPEN_TICKET_STATUSES).cast("int")
        return tickets.groupBy("customer_id").agg((F.sum(is_open) * sign).alias("open_ticket_count"))

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        both = stored.unionByName(batch)
        return both.groupBy("customer_id").agg(F.sum("open_ticket_count").alias("open_ticket_count"))

    changes = counted(fresh, 1)
    if replaced is not None:
        changes = merge(changes, counted(replaced, -1))
    return store.merge_keyed("state_customer_tickets", changes, ["customer_id"], merge)[0]

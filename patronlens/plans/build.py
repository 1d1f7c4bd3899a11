"""The layers as one lazily evaluated set of tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from patronlens.plans import intermediate, marts, staging
from patronlens.sources.raw import RawTables


@dataclass(frozen=True)
class Layers:
    """Every staging, intermediate and mart table of one run date.

    Each property is a DataFrame over the raw scans: using one table plans only
    what that table needs.
    """

    raw: RawTables
    run_date: date

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw.events)

    @cached_property
    def stg_tickets(self) -> DataFrame:
        return staging.stg_tickets(self.raw.tickets)

    @cached_property
    def stg_campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.raw.campaigns)

    @cached_property
    def int_customers(self) -> DataFrame:
        return intermediate.int_customers(self.stg_customers, self.run_date)

    @cached_property
    def int_orders_with_items(self) -> DataFrame:
        return intermediate.int_orders_with_items(
            self.stg_orders, self.stg_order_items, self.run_date
        )

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return intermediate.int_customer_orders(self.int_orders_with_items, self.run_date)

    @cached_property
    def int_customer_events(self) -> DataFrame:
        narrow = staging.stg_events(self.raw.events, wide=False)
        return intermediate.int_customer_events(narrow, self.run_date)

    @cached_property
    def int_sessions(self) -> DataFrame:
        narrow = staging.stg_events(self.raw.events, wide=False)
        return intermediate.int_sessions(narrow, self.run_date)

    @cached_property
    def int_customer_tickets(self) -> DataFrame:
        narrow = staging.stg_tickets(self.raw.tickets, wide=False)
        return intermediate.int_customer_tickets(narrow, self.run_date)

    @cached_property
    def mart_customers(self) -> DataFrame:
        return marts.mart_customers(
            self.int_customers, self.int_customer_orders, self.int_customer_events, self.run_date
        )

    @cached_property
    def mart_orders(self) -> DataFrame:
        return marts.mart_orders(self.int_orders_with_items, self.run_date)

    @cached_property
    def mart_campaigns(self) -> DataFrame:
        return marts.mart_campaigns(self.stg_campaigns, self.run_date)

    @cached_property
    def mart_support_tickets(self) -> DataFrame:
        return marts.mart_support_tickets(self.stg_tickets, self.run_date)

    @cached_property
    def active_campaign_count(self) -> DataFrame:
        narrow = staging.stg_campaigns(self.raw.campaigns, wide=False)
        return marts.active_campaign_count(narrow, self.run_date)

    @cached_property
    def mart_customer_360(self) -> DataFrame:
        return marts.mart_customer_360(
            self.customer_metrics, self.active_campaign_count, self.run_date
        )

    @cached_property
    def customer_metrics(self) -> DataFrame:
        narrow = staging.stg_customers(self.raw.customers, wide=False)
        return marts.customer_metrics(
            intermediate.int_customers(narrow, self.run_date),
            self.int_customer_orders,
            self.int_customer_events,
            self.int_customer_tickets,
        )

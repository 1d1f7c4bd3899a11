"""DuckDB building blocks for the oracle queries: raw, staging, intermediate and mart CTEs.

Written from the table definitions, independently of the Spark code.
"""

from __future__ import annotations

import re

RUN = "DATE '2024-01-31'"
T1 = "TIMESTAMP '2024-01-31 02:00:00'"
T0 = "TIMESTAMP '2024-01-30 02:00:00'"
T2 = "TIMESTAMP '2024-01-31 03:00:00'"


def half_up(numerator: str, denominator: str, kind: str, scale: int = 2) -> str:
    """numerator/denominator, both non-negative integers, rounded half up at the unit of
    ``scale`` decimals (DuckDB's own decimal division goes through DOUBLE)."""
    unit = "0." + "0" * (scale - 1) + "1"
    return (
        f"cast(cast((2*({numerator})+({denominator}))//(2*({denominator})) as decimal(18,0))"
        f" * {unit}::decimal({scale + 1},{scale}) as {kind})"
    )


def raw_ctes(faults: bool) -> dict[str, str]:
    """The six raw tables, with or without the injected bad rows."""
    f = "f" if faults else ""
    country = "list_extract(['US','CA','BR','MX','GB','DE','FR','ES','IT','NL','SE','PL','IN','CN','JP','SG','AE','ZA','NG','AU'], c_nationkey % 20 + 1)"
    email = "lower(c_name) || '@example.com'"
    total = "cast(o_totalprice as decimal(12,2))"
    status = "case when o_orderstatus='F' then 'completed' when o_orderstatus='O' then 'pending' when o_custkey % 2 = 0 then 'cancelled' else 'refunded' end"
    customer = "cast(o_custkey as varchar)"
    item_order = "cast(l_orderkey as varchar)"
    event_user = "cast(user_id as varchar)"
    event_type = "event_type"
    clicked = "l_linestatus='O' and l_returnflag='R'"
    ticket_status = "case when o_orderstatus='F' then 'closed' when o_orderstatus='P' then 'in_progress' else 'open' end"
    old_ticket_status = "'open'"
    ticket_customer = "cast(o_custkey as varchar)"
    if faults:
        country = f"case when c_acctbal < 0 then {country} || 'X' else {country} end"
        email = f"case when c_acctbal > 9000 then 'shared@example.com' else {email} end"
        total = f"case when o_orderstatus='P' and o_orderpriority='5-LOW' then -{total} else {total} end"
        status = f"case when o_orderstatus='O' and o_orderpriority='5-LOW' then 'lost' else {status} end"
        customer = f"case when o_orderstatus='P' and o_orderpriority='2-HIGH' then 'gone-' || {customer} else {customer} end"
        item_order = f"case when l_quantity >= 50 then 'gone-' || {item_order} else {item_order} end"
        event_user = f"case when value > 50 then 'gone-' || {event_user} else {event_user} end"
        event_type = "case when value >= 2 then event_type end"
        clicked = "l_returnflag='R'"
        ticket_status = f"case when o_orderpriority='4-NOT SPECIFIED' then 'on_hold' else {ticket_status} end"
        old_ticket_status = "case when o_orderpriority='4-NOT SPECIFIED' then 'on_hold' else 'open' end"
        ticket_customer = f"case when o_orderstatus='P' and o_orderpriority='3-MEDIUM' then 'gone-' || {ticket_customer} else {ticket_customer} end"
    old_event_type = "case when value >= 2 then 'click' end" if faults else "'click'"
    segment = "case c_mktsegment when 'AUTOMOBILE' then 'organic' when 'BUILDING' then 'paid_search' when 'FURNITURE' then 'social' when 'HOUSEHOLD' then 'referral' when 'MACHINERY' then 'direct' end"
    customer_row = "cast(c_custkey as varchar) customer_id, {name} as name, " + (
        f"{email} email, {segment} acquisition_channel, {country} country_code, "
        f"{RUN} - cast(1 + (c_custkey*7919) % 1825 as integer) account_created_at, "
        "{at} _ingested_at, " + f"{RUN} _run_date"
    )
    order_row = (
        "cast(o_orderkey as varchar) order_id, {customer} customer_id, "
        f"{status} order_status, cast({total} as decimal(12,2)) total_amount_usd, "
        "o_orderdate + interval 8218 day ordered_at, {at} _ingested_at, " + f"{RUN} _run_date"
    )
    event_row = (
        "cast(event_id as varchar) event_id, cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) session_id, "
        f"{event_user} customer_id, " + "{kind} event_type, '/' || event_type page_url, "
        "list_extract(['desktop','mobile','tablet'], cast(event_id % 3 + 1 as integer)) device_type, "
        "ts occurred_at, {at} _ingested_at, " + f"{RUN} _run_date"
    )
    ticket_row = (
        f"cast(o_orderkey as varchar) ticket_id, {ticket_customer} customer_id, "
        "'Order ' || cast(o_orderkey as varchar) || ': ' || o_orderpriority subject, "
        "coalesce(d.text, 'Order ' || cast(o_orderkey as varchar) || ': ' || o_orderpriority) description, "
        "{status} status, case when o_orderpriority in ('1-URGENT','2-HIGH') then 'high' when o_orderpriority='3-MEDIUM' then 'medium' else 'low' end priority, "
        "o_orderdate + interval 8218 day created_at, {resolved} resolved_at, {at} _ingested_at, "
        f"{RUN} _run_date"
    )
    campaign_row = (
        "cast(l_suppkey as varchar) campaign_id, case when l_suppkey % 2 = 0 then 'google_ads' else 'meta_ads' end platform, "
        "'Campaign ' || cast(l_suppkey as varchar) campaign_name, daily_spend_usd, impressions, {clicks} clicks, "
        "ship_day + 8218 campaign_date, {at} _ingested_at, " + f"{RUN} _run_date"
    )
    resolved = "case when o_orderstatus='F' then o_orderdate + interval 8218 day + to_hours(cast(1 + o_orderkey % 240 as integer)) end"
    tickets_from = "from orders left join documents d on o_orderkey = d.doc_id"
    return {
        f"{f}raw_customers": f"""
select {customer_row.format(name='c_name', at=T1)} from customer
union all select {customer_row.format(name="c_name || '-old'", at=T0)} from customer where c_mktsegment='BUILDING'""",
        f"{f}raw_orders": f"""
select {order_row.format(customer=customer, at=T1)} from orders
union all select {order_row.format(customer='cast(null as varchar)', at=T2)} from orders where o_orderstatus='P' and o_orderpriority='1-URGENT'""",
        f"{f}raw_order_items": f"""
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) order_item_id,
 {item_order} order_id, cast(l_partkey as varchar) product_id, cast(l_quantity as integer) quantity,
 {half_up('cast(cast(l_extendedprice as decimal(12,2))*100 as bigint)', 'cast(l_quantity as bigint)', 'decimal(10,2)')} unit_price_usd,
 {T1} _ingested_at, {RUN} _run_date from lineitem""",
        f"{f}raw_events": f"""
select {event_row.format(kind=event_type, at=T1)} from events
union all select {event_row.format(kind=old_event_type, at=T0)} from events where events.event_type='error'""",
        f"{f}campaign_days": f"""
select l_suppkey, cast(l_shipdate as date) ship_day,
 cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))) as decimal(12,2)) daily_spend_usd,
 cast(coalesce(sum(cast(l_quantity as integer)) filter (where l_linestatus='O'), 0) as integer) impressions,
 cast(coalesce(sum(cast(l_quantity as integer)) filter (where {clicked}), 0) as integer) clicks
from lineitem group by 1, 2""",
        f"{f}raw_campaigns": f"""
select {campaign_row.format(clicks='clicks', at=T1)} from {f}campaign_days
union all select {campaign_row.format(clicks='0', at=T0)} from {f}campaign_days where {f}campaign_days.clicks > 0""",
        f"{f}raw_tickets": f"""
select {ticket_row.format(status=ticket_status, resolved=resolved, at=T1)} {tickets_from}
union all select {ticket_row.format(status=old_ticket_status, resolved='cast(null as timestamp)', at=T0)} {tickets_from} where o_orderstatus='F'""",
    }


def layer_ctes(f: str) -> dict[str, str]:
    def latest(table: str, keys: str) -> str:
        return f"(select * from {f}raw_{table} qualify row_number() over (partition by {keys} order by _ingested_at desc) = 1)"

    hours = half_up(
        "(epoch_us(resolved_at)-epoch_us(created_at))*250", "9", "decimal(20,11)", 11
    )
    score = "cast(case when is_active then {} else 0 end as smallint)"
    return {
        f"{f}stg_customers": f"select customer_id, name, email, acquisition_channel, country_code, account_created_at, _ingested_at ingested_at, _run_date from {latest('customers', 'customer_id')}",
        f"{f}stg_orders": f"select order_id, customer_id, order_status, total_amount_usd, ordered_at, _ingested_at ingested_at, _run_date from {latest('orders', 'order_id')} where customer_id is not null",
        f"{f}stg_order_items": f"select order_item_id, order_id, product_id, quantity, unit_price_usd, _ingested_at ingested_at, _run_date from {f}raw_order_items",
        f"{f}stg_events": f"select event_id, session_id, customer_id, event_type, page_url, device_type, occurred_at, _ingested_at ingested_at, _run_date from {latest('events', 'event_id')}",
        f"{f}stg_tickets": f"select ticket_id, customer_id, subject, description, status, priority, created_at, resolved_at, {hours} resolution_hours, _ingested_at ingested_at, _run_date from {latest('tickets', 'ticket_id')}",
        f"{f}stg_campaigns": f"select campaign_id, campaign_date, platform, campaign_name, daily_spend_usd, impressions, clicks, cast(clicks as double) / nullif(impressions, 0) click_through_rate, _ingested_at ingested_at, _run_date from {latest('campaigns', 'campaign_id, campaign_date')}",
        f"{f}item_counts": f"select order_id, count(order_item_id) item_count from {f}stg_order_items group by 1",
        f"{f}int_orders_with_items": f"""
select o.order_id, customer_id, order_status, total_amount_usd, item_count,
 case when total_amount_usd >= 0 then {half_up('cast(total_amount_usd*100 as bigint)', 'item_count', 'decimal(10,2)')}
  else -{half_up('cast(-total_amount_usd*100 as bigint)', 'item_count', 'decimal(10,2)')} end avg_item_value_usd,
 ordered_at, {RUN} _run_date
from {f}stg_orders o join {f}item_counts i on o.order_id = i.order_id""",
        f"{f}int_customer_orders": f"""
select customer_id, count(*) total_order_count, cast(sum(total_amount_usd) as decimal(14,2)) total_spend_usd,
 count(*) filter (where cast(ordered_at as date) >= {RUN} - 365) order_frequency_365d,
 cast(coalesce(sum(total_amount_usd) filter (where cast(ordered_at as date) >= {RUN} - 365), 0) as decimal(14,2)) total_spend_365d_usd,
 count(*) filter (where cast(ordered_at as date) >= {RUN} - 30) order_count_last_30d,
 count(*) filter (where cast(ordered_at as date) >= {RUN} - 60 and cast(ordered_at as date) < {RUN} - 30) order_count_prior_30d,
 cast({RUN} - cast(max(ordered_at) as date) as integer) days_since_last_order, {RUN} _run_date
from {f}int_orders_with_items group by customer_id""",
        f"{f}int_customer_events": f"""
select customer_id, cast(max(occurred_at) as date) most_recent_event_date,
 cast({RUN} - cast(max(occurred_at) as date) as integer) days_since_last_event, {RUN} _run_date
from {f}stg_events group by customer_id""",
        f"{f}int_customer_tickets": f"select customer_id, count(*) filter (where status in ('open','in_progress')) open_ticket_count, {RUN} _run_date from {f}stg_tickets group by customer_id",
        f"{f}int_customers": f"select customer_id, name, email, acquisition_channel, country_code, account_created_at, cast({RUN} - account_created_at as integer) customer_tenure_days, {RUN} _run_date from {f}stg_customers",
        f"{f}int_sessions": f"""
select session_id, min(occurred_at) session_start, max(occurred_at) session_end,
 cast(cast(epoch_us(max(occurred_at)) - epoch_us(min(occurred_at)) as decimal(18,0)) * 0.000001::decimal(7,6) as decimal(18,6)) session_duration_seconds,
 {RUN} _run_date from {f}stg_events group by session_id""",
        f"{f}mart_customers": f"""
select c.customer_id, name, email, acquisition_channel, country_code, account_created_at, customer_tenure_days,
 (coalesce(order_frequency_365d, 0) >= 1 or (days_since_last_event is not null and days_since_last_event <= 365)) is_active, {RUN} _run_date
from {f}int_customers c left join {f}int_customer_orders o on c.customer_id = o.customer_id
left join {f}int_customer_events e on c.customer_id = e.customer_id""",
        f"{f}mart_orders": f"select order_id, customer_id, order_status, total_amount_usd, item_count, avg_item_value_usd, ordered_at, {RUN} _run_date from {f}int_orders_with_items",
        f"{f}mart_campaigns": f"select campaign_id, campaign_date, platform, campaign_name, daily_spend_usd, impressions, clicks, cast(coalesce(click_through_rate, 0) as decimal(8,6)) click_through_rate, false anomaly_flag, {RUN} _run_date from {f}stg_campaigns",
        f"{f}mart_support_tickets": f"select ticket_id, customer_id, subject, status, priority, created_at, resolved_at, cast(resolution_hours as decimal(8,2)) resolution_hours, cast(null as integer) cluster_id, cast(null as varchar) cluster_label, cast(null as decimal(5,4)) cluster_confidence, {RUN} _run_date from {f}stg_tickets",
        f"{f}campaign_count": f"select count(*) active_campaign_count from {f}stg_campaigns where daily_spend_usd > 0 and campaign_date >= {RUN} - 30",
        f"{f}metrics": f"""
select c.customer_id, acquisition_channel, customer_tenure_days, coalesce(total_order_count, 0) total_order_count,
 cast(coalesce(total_spend_usd, 0) as decimal(14,2)) total_spend_usd, coalesce(order_frequency_365d, 0) order_frequency_365d,
 cast(coalesce(total_spend_365d_usd, 0) as decimal(14,2)) total_spend_365d_usd, coalesce(order_count_last_30d, 0) order_count_last_30d,
 coalesce(order_count_prior_30d, 0) order_count_prior_30d, days_since_last_order, most_recent_event_date, days_since_last_event,
 coalesce(open_ticket_count, 0) open_ticket_count, coalesce(order_frequency_365d, 0) >= 1 is_active
from {f}int_customers c left join {f}int_customer_orders o on c.customer_id = o.customer_id
left join {f}int_customer_events e on c.customer_id = e.customer_id
left join {f}int_customer_tickets t on c.customer_id = t.customer_id""",
        f"{f}scored": f"""
select *, ntile(5) over (partition by is_active order by days_since_last_order desc nulls first, customer_id) rt,
 ntile(5) over (partition by is_active order by order_frequency_365d asc nulls last, customer_id) ft,
 ntile(5) over (partition by is_active order by total_spend_365d_usd asc nulls last, customer_id) mt from {f}metrics""",
        f"{f}customer_360": f"""
select customer_id, {score.format('rt')} recency_score, {score.format('ft')} frequency_score, {score.format('mt')} monetary_score,
 case when is_active then 'R' || cast(rt as varchar) || 'F' || cast(ft as varchar) || 'M' || cast(mt as varchar) else 'R0F0M0' end rfm_score,
 least(coalesce(days_since_last_order, 999), 999) recency_days, order_frequency_365d, total_spend_365d_usd, total_order_count, total_spend_usd,
 most_recent_event_date, days_since_last_event, days_since_last_order, order_count_last_30d, order_count_prior_30d,
 order_count_last_30d - order_count_prior_30d order_frequency_trend, active_campaign_count, open_ticket_count, acquisition_channel,
 customer_tenure_days, is_active, {RUN} _run_date
from {f}scored cross join {f}campaign_count""",
    }


CTES: dict[str, str] = {}
for _faults, _prefix in ((False, ""), (True, "f")):
    CTES.update(raw_ctes(_faults))
    CTES.update(layer_ctes(_prefix))


def sql(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` with the CTEs it needs, directly or through others, in front."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    body = ",\n".join(f"{name} as ({known[name].strip()})" for name in needed)
    return f"with {body}\n{final.strip()}"


def table(name: str) -> str:
    return sql(f"select * from {name}")

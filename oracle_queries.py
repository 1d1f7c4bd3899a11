"""DuckDB SQL for the registered queries, by query name."""

from __future__ import annotations

from oracle_cte import CTES, RUN, T1, half_up, sql, table
from patronlens.quality.suites import model_suites, raw_suites
from patronlens.schema import RAW_DDL, RAW_KEYS

# Query name -> CTE that is the whole answer.
_TABLES = {
    "stg_customers_dedup": "stg_customers",
    "stg_orders_dedup": "stg_orders",
    "stg_order_items": "stg_order_items",
    "stg_events_dedup": "stg_events",
    "stg_tickets_dedup": "stg_tickets",
    "stg_campaigns_dedup": "stg_campaigns",
    "orders_with_items": "int_orders_with_items",
    "customer_orders_agg": "int_customer_orders",
    "customer_events_agg": "int_customer_events",
    "customer_tickets_agg": "int_customer_tickets",
    "customer_tenure": "int_customers",
    "sessions_duration": "int_sessions",
    "mart_customers": "mart_customers",
    "mart_orders": "mart_orders",
    "mart_campaigns": "mart_campaigns",
    "mart_support_tickets": "mart_support_tickets",
    "active_campaign_count": "campaign_count",
    "customer_360": "customer_360",
}


PRIOR = "DATE '2024-01-30'"
SCORED = "TIMESTAMP '2024-01-31 06:00:00'"


def _scores(source: str, date: str, keep: str = "", ltv: str = "{x}", tier: str = "{x}") -> str:
    """Sample score rows over a feature CTE."""
    spend = ltv.format(x="cast(total_spend_365d_usd as decimal(12,2))")
    churn = half_up("recency_days*10000", "999", "decimal(5,4)", 4)
    label = tier.format(x="case when c < 0.33 then 'Low' when c < 0.67 then 'Medium' else 'High' end")
    return f"""
select customer_id, {date} score_date, 'sample' model_run_id, cast({spend} as decimal(12,2)) ltv_score, c churn_score,
 {label} churn_risk_tier, case when is_active then rfm_score else 'Inactive' end segment_label,
 cast(null as boolean) anomaly_flag, cast(null as varchar) anomaly_detail, {SCORED} scored_at{keep}
from (select *, {churn} c from {source})"""


def _faulty_scores(source: str) -> str:
    return _scores(
        source,
        RUN,
        ltv="case when acquisition_channel='social' then -{x} else {x} end",
        tier="case when acquisition_channel='direct' then 'High' else {x} end",
    )


def _mart_scores(source: str) -> str:
    return f"""
select customer_id, score_date, model_run_id, ltv_score, churn_score, churn_risk_tier, segment_label,
 coalesce(anomaly_flag, false) anomaly_flag, anomaly_detail, scored_at, {RUN} _run_date from {source} where score_date = {RUN}"""


def _accepted_raw(table: str) -> str:
    """Raw rows that the loader takes: orders without a customer break a not-null rule."""
    return f"raw_{table}" + (" where customer_id is not null" if table == "orders" else "")


def _checksum_sql(table: str, keys: tuple[str, ...]) -> str:
    """Row count and order-free checksum of each column of the newest versions of a raw table."""
    columns = [c.split()[0] for c in RAW_DDL[table].split(", ")]
    sums = ", ".join(
        f"struct_pack(c := '{c}', s := sum(cast('0x' || substr(md5(coalesce(cast({c} as varchar), '')), 1, 8) as bigint)))"
        for c in columns
    )
    newest = (
        f"select * from {_accepted_raw(table)} qualify row_number() over "
        f"(partition by {', '.join(keys)} order by _ingested_at desc) = 1"
    )
    return (
        f"select '{table}' table_name, u.c column_name, n row_count, cast(u.s as decimal(38,0)) checksum "
        f"from (select n, unnest(l) u from (select count(*) n, [{sums}] l from ({newest})))"
    )


def _newest_faulty(table: str, keys: tuple[str, ...]) -> str:
    """Newest version per key of a faulty raw table; ties go to the greatest values."""
    columns = [c.split()[0] for c in RAW_DDL[table].split(", ")]
    order = ["_ingested_at", *(c for c in columns if c not in {*keys, "_ingested_at"})]
    return (
        f"(select * from fraw_{table} qualify row_number() over (partition by {', '.join(keys)} "
        f"order by {', '.join(f'{c} desc nulls last' for c in order)}) = 1)"
    )


def _rejects_sql() -> str:
    """Rows of the faulty raw tables that break a declared not-null or range rule, or a shared email. In
    the second batch: rows whose email is stored under another customer."""
    optional = {"tickets": {"resolved_at"}}
    ranges = {
        "order_items": [("quantity", "positive", "quantity > 0"), ("unit_price_usd", "not_negative", "unit_price_usd >= 0")],
        "campaigns": [
            ("daily_spend_usd", "not_negative", "daily_spend_usd >= 0"),
            ("impressions", "not_negative", "impressions >= 0"),
            ("clicks", "between_0_and_impressions", "clicks between 0 and impressions"),
        ],
    }
    selects = []
    for table, keys in RAW_KEYS.items():
        key = "concat_ws(':', " + ", ".join(f"cast({k} as varchar)" for k in keys) + ")"
        names = [c.split()[0] for c in RAW_DDL[table].split(", ") if c.split()[0] not in optional.get(table, ())]
        found = [(c, "not_null", f"{c} is null") for c in names]
        found += [(c, rule, f"not ({text})") for c, rule, text in ranges.get(table, ())]
        if table == "customers":
            owner = "(select min(o.customer_id) from fraw_customers o where o.email = fraw_customers.email)"
            found.append(("email", "unique", f"customer_id <> {owner}"))
        for column, rule, broken in found:
            selects.append(
                f"select 1 batch, '{table}' table_name, '{column}' failing_column, '{rule}' failing_expectation, "
                f"cast(to_json(list(k order by k)) as varchar) sample_failing_rows from (select distinct {key} k "
                f"from fraw_{table} where {broken} order by 1 limit 20) having count(*) > 0"
            )
    owners = "select email, min(customer_id) owner from fraw_customers where email is not null group by 1"
    again = "select customer_id, email from fraw_customers where acquisition_channel = 'direct'"
    selects.append(
        "select 2 batch, 'customers' table_name, 'email' failing_column, 'unique' failing_expectation, "
        "cast(to_json(list(k order by k)) as varchar) sample_failing_rows from (select distinct k from ("
        f"select customer_id k, email from ({again}) union all select customer_id || '-twin', email from ({again})) "
        f"join ({owners}) using (email) where k <> owner order by 1 limit 20) having count(*) > 0"
    )
    return "\nunion all ".join(selects)


def _maintained_sql() -> str:
    """The order metrics of ten run dates, each computed from all its orders."""
    withdrawn = f"{RUN} - 4"
    selects = []
    for age in range(9, -1, -1):
        day = f"({RUN} - {age})"
        gone = f"order_status = 'cancelled' and cast(ordered_at as date) between {withdrawn} - 40 and {withdrawn} - 1"
        kept = f"cast(ordered_at as date) <= {day}" + (f" and not ({gone})" if age <= 4 else "")
        text = CTES["int_customer_orders"].replace(RUN, day).strip()
        selects.append(text.replace("from int_orders_with_items", f"from (select * from int_orders_with_items where {kept})"))
    return " union all ".join(f"select * replace (cast(_run_date as date) as _run_date) from ({text})" for text in selects)


def _split_sql(rows: str, row_id: str, stratum: str) -> str:
    """A fifth (rounded up) held out, shared among the strata by largest remainder; as one
    table if a stratum has one row or there are fewer held-out rows than strata."""
    return f"""
select * from (with split_rows as ({rows}),
split_sizes as (select stratum, count(*) n from split_rows group by 1),
split_total as (select sum(n)::bigint total, ((sum(n) + 4) // 5)::bigint held, count(*) strata, min(n) least from split_sizes),
split_mode as (select *, least < 2 or held < strata or total - held < strata as whole from split_total),
split_quota as (
    select stratum, n // 5 + case when row_number() over (order by n % 5 desc, cast(stratum as varchar))
        <= (select held from split_total) - (select sum(n // 5) from split_sizes) then 1 else 0 end quota
    from split_sizes),
split_ranked as (
    select *, row_number() over (partition by stratum order by md5_order, id) own, row_number() over (order by md5_order, id) overall
    from (select *, cast('0x' || substr(md5(id), 1, 15) as bigint) md5_order from split_rows))
select id {row_id}, stratum {stratum}, case when whole then overall <= held else own <= quota end is_validation
from split_ranked join split_quota using (stratum) cross join split_mode)"""


_TARGET = "greatest(cast(total_spend_365d_usd as double), 0.0)"

EXTRA = {
    "seed_channels": """
select * from (values ('organic','Organic Search'),('paid_search','Paid Search'),('social','Social Media'),
 ('referral','Referral'),('direct','Direct')) t(channel_code, label)""",
    "seed_countries": """
select * from (values ('US','United States','Americas'),('CA','Canada','Americas'),('BR','Brazil','Americas'),
 ('MX','Mexico','Americas'),('GB','United Kingdom','Europe'),('DE','Germany','Europe'),('FR','France','Europe'),
 ('ES','Spain','Europe'),('IT','Italy','Europe'),('NL','Netherlands','Europe'),('SE','Sweden','Europe'),
 ('PL','Poland','Europe'),('IN','India','Asia'),('CN','China','Asia'),('JP','Japan','Asia'),('SG','Singapore','Asia'),
 ('AE','United Arab Emirates','Asia'),('ZA','South Africa','Africa'),('NG','Nigeria','Africa'),
 ('AU','Australia','Oceania')) t(alpha_2, country_name, region)""",
    "prior_customer_orders": CTES["int_customer_orders"].replace(RUN, PRIOR),
    "score_rows": _scores("customer_360", RUN),
    "prior_score_rows": _scores("customer_360", PRIOR),
    "bad_score_rows": _faulty_scores("customer_360"),
    "fbad_score_rows": _faulty_scores("fcustomer_360"),
    "history": f"select customer_id, acquisition_channel channel, {_TARGET} target from customer_360 where total_order_count > 0",
    "means": f"select channel, {half_up('cast(sum(cast(target as decimal(14,2)))*100 as bigint)*10000', 'count(*)', 'decimal(18,6)', 6)} cohort_mean from history group by 1",
    "labels_churn": """
select customer_id, is_active, cast((days_since_last_order is null or days_since_last_order >= 90)
 and (days_since_last_event is null or days_since_last_event >= 90) as integer) churn_label from customer_360""",
    "class_counts": """
select churn_score s, count(*) filter (where churn_label = 1) p, count(*) filter (where churn_label = 0) q
from score_rows join labels_churn using (customer_id) group by 1""",
    "class_ranked": "select *, coalesce(sum(q) over (order by s rows between unbounded preceding and 1 preceding), 0) below from class_counts",
    "grid": """
select cast(recency_score as integer) recency_score, cast(frequency_score as integer) frequency_score,
 cast(monetary_score as integer) monetary_score, count(*) customers from customer_360
where order_frequency_365d > 0 group by 1, 2, 3""",
    "daily": """
select cast(ordered_at as date) run_date, 'order_count' metric_name, cast(count(*) as decimal(18,4)) v from mart_orders group by 1
union all select cast(ordered_at as date), 'order_value_usd', cast(sum(total_amount_usd) as decimal(18,4)) from mart_orders group by 1
union all select cast(occurred_at as date), 'event_count', cast(count(*) as decimal(18,4)) from stg_events group by 1
union all select cast(created_at as date), 'ticket_count', cast(count(*) as decimal(18,4)) from stg_tickets group by 1""",
    "daily_sums": """
select *, count(*) over w n, cast(sum(v) over w as decimal(18,4)) total,
 cast(sum(cast(cast(v as decimal(20,4)) * v as decimal(34,8))) over w as decimal(34,8)) squares
from daily window w as (partition by metric_name order by run_date - DATE '1970-01-01' range between 30 preceding and 1 preceding)""",
    "daily_stats": """
select run_date, metric_name, v, n,
 case when n >= 30 then cast(cast(total as double) / n as decimal(18,4)) end m,
 case when n >= 30 then cast(sqrt(cast(squares * cast(n as decimal(3,0)) - cast(total as decimal(20,4)) * total as double)) / n as decimal(18,4)) end s
from daily_sums""",
    "daily_scored": """
select *, cast((cast(v as double) - cast(m as double)) / nullif(cast(s as double), 0) as decimal(18,4)) z,
 cast(m - 2*s as decimal(18,4)) lo, cast(m + 2*s as decimal(18,4)) hi from daily_stats""",
    "daily_severity": """
select *, case when n < 30 then 'baseline_pending' when abs(z) > 3 then 'Critical' when abs(z) > 2 then 'Warning' end severity
from daily_scored""",
    "months": """
select cast(year(ordered_at) * 12 + month(ordered_at) as bigint) version, cast(min(ordered_at) as date) run_date,
 count(*) filter (where order_status = 'pending') / count(*) silhouette_score,
 cast(cast(sum(cast(total_amount_usd * 100 as bigint)) as bigint) // count(*) as double) rmse,
 count(*) filter (where order_status = 'completed') / count(*) * 2 auc_roc
from stg_orders group by 1""",
    "ltv_runs": "select *, rmse < coalesce(min(rmse) over (order by version rows between unbounded preceding and 1 preceding), 1e300) ok from months",
}


def _sample(rows: str) -> str:
    """JSON array of up to 20 keys ``k`` of ``rows``: the smallest digests of 256 classes of keys."""
    return (
        "(select cast(to_json(list(k order by k)) as varchar) from (select min_by(k, (d, k)) k, min((d, k)) least from ("
        f"select k, cast('0x' || substr(md5(k), 1, 8) as bigint) d from ({rows})) group by d % 256 order by least limit 20) "
        "having count(*) > 0)"
    )


def _check_select(table: str, cte: str, checks, parents: dict[str, str], row_keys=None) -> list[str]:
    """Report rows of one table, one SELECT per check; with the key columns, a sample too."""
    rows = []

    def quoted(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value).lower()

    for check in checks:
        column = check.columns[0]
        elements, mostly = "(select count(*) from {c})", str(check.mostly)
        where = None
        match check.name:
            case "column_exists":
                elements, bad = "1", "0"
            case "not_null":
                where = f"{column} is null"
            case "in_set":
                where = f"{column} not in ({', '.join(quoted(v) for v in check.bounds)})"
            case "length_equals":
                where = f"length({column}) <> {check.bounds[0]}"
            case "between":
                low, high = check.bounds
                sides = [f"{column} < {low}"] if low is not None else []
                sides += [f"{column} > {high}"] if high is not None else []
                where = " or ".join(sides)
            case "pair_at_least":
                where = f"{column} < {check.columns[1]}"
            case "expression_is_true":
                where = f"not ({check.detail})"
            case "unique":
                keys = ", ".join(check.columns)
                present = " and ".join(f"{c} is not null" for c in check.columns)
                elements = f"(select count(*) from {cte} where {present})"
                bad = f"(select coalesce(sum(n), 0) from (select count(*) n from {cte} where {present} group by {keys}) where n > 1)"
            case "relationship":
                parent, key = check.parent
                elements = f"(select count(*) from {cte} where {column} is not null)"
                bad = f"(select count(*) from {cte} where {column} is not null and {column} not in (select {key} from {parents[parent]}))"
            case "recency":
                elements, bad = "1", f"(select cast(coalesce(max({column}) < {RUN} - 1, false) as integer) from {cte})"
        sample = ""
        if row_keys:
            parts = ", ".join(f"cast({k} as varchar)" for k in (check.columns if check.name == "unique" else row_keys))
            key, shown = f"concat_ws(':', {parts})", "cast(null as varchar)"
            if where:
                shown = _sample(f"select {key} k from {cte} where {where}")
            elif check.name == "unique":
                shown = _sample(f"select {key} k from {cte} where {present} group by {keys} having count(*) > 1")
            sample = f", {shown} sample_failing_rows"
        if where:
            bad = f"(select count(*) from {cte} where {where})"
        rows.append(
            f"select '{table}' table_name, '{check.name}' check_name, '{check.label}' column_name, '{check.severity}' severity, "
            f"cast({elements.format(c=cte)} as bigint) element_count, cast({bad} as bigint) unexpected_count, {mostly} mostly{sample}"
        )
    return rows


def _report(suites: dict, ctes: dict[str, str], row_keys: dict | None = None) -> str:
    rows = [
        row
        for table, checks in suites.items()
        for row in _check_select(table, ctes[table], checks, ctes, row_keys and row_keys[table])
    ]
    sample = ", sample_failing_rows" if row_keys else ""
    return (
        "select table_name, check_name, column_name, severity, element_count, unexpected_count, "
        f"element_count - unexpected_count >= element_count * mostly success{sample} from ("
        + " union all ".join(rows)
        + ")"
    )


def _orphans(table: str, key: str, column: str = "customer_id", parent: str = "fstg_customers") -> str:
    return f"select {key}, t.{column} from {table} t left join {parent} c on t.{column} = c.{column} where c.{column} is null"


def _statements() -> dict[str, str]:
    raw_ctes = {t: f"fraw_{t}" for t in ("customers", "orders", "order_items", "events", "campaigns", "tickets")}
    model_ctes = {t: f"f{t}" for t in model_suites()}
    model_ctes["mart_customer_360"] = "fcustomer_360"
    model_ctes["mart_ml_scores"] = "fmart_ml_scores"
    report = _report(raw_suites(), raw_ctes)
    orphan_union = " union all ".join(
        f"select '{t}.{k}' relation, (select count(*) from fraw_{t}) child_count, count(*) orphan_count from fraw_{t} c "
        f"left join (select distinct {k} pk from fraw_{p}) p on c.{k} = p.pk where p.pk is null"
        for t, k, p in (
            ("orders", "customer_id", "customers"),
            ("order_items", "order_id", "orders"),
            ("events", "customer_id", "customers"),
            ("tickets", "customer_id", "customers"),
        )
    )
    pipeline = " union all ".join(
        f"select '{t}' table_name, count(*) row_count, max(_run_date) run_date from {c}"
        for t, c in [
            *[(t, t) for t in (
                "int_sessions", "int_customer_events", "int_customers", "int_orders_with_items", "int_customer_orders",
                "mart_support_tickets", "int_customer_tickets", "mart_campaigns", "mart_customers", "mart_orders")],
            ("mart_customer_360", "customer_360"),
        ]
    )
    loaded = "select " + " + ".join(f"(select count(*) from {_accepted_raw(t)})" for t in RAW_KEYS)
    newest_raw = {
        t: f"{_accepted_raw(t)} qualify row_number() over (partition by {', '.join(keys)} order by _ingested_at desc) = 1"
        for t, keys in RAW_KEYS.items()
    }
    stored_raw = {t: _newest_faulty(t, keys) for t, keys in RAW_KEYS.items()}
    stored_orphans = " union all ".join(
        f"select '{t}' table_name, 'reference' check_name, '{k}' column_name, count(*) element_count, "
        f"count(*) filter (where {k} is null or {k} not in (select {k} from {stored_raw[p]} where {k} is not null)) unexpected_count, "
        f"cast(null as varchar) sample_failing_rows from {stored_raw[t]}"
        for t, k, p in (
            ("orders", "customer_id", "customers"),
            ("order_items", "order_id", "orders"),
            ("events", "customer_id", "customers"),
            ("tickets", "customer_id", "customers"),
        )
    )
    load = " union all ".join(_checksum_sql(t, keys) for t, keys in RAW_KEYS.items())
    negatives = " union all ".join(
        f"select '{m}' model_name, '{c}' column_name, {k} record_key, cast({c} as decimal(18,2)) offending_value from {t} where {c} < 0"
        for m, t, c, k in (
            ("mart_orders", "fmart_orders", "total_amount_usd", "order_id"),
            ("mart_orders", "fmart_orders", "avg_item_value_usd", "order_id"),
            ("mart_campaigns", "fmart_campaigns", "daily_spend_usd", "campaign_id || '|' || cast(campaign_date as varchar)"),
            ("mart_customer_360", "fcustomer_360", "total_spend_usd", "customer_id"),
            ("mart_customer_360", "fcustomer_360", "total_spend_365d_usd", "customer_id"),
            ("mart_ml_scores", "fbad_score_rows", "ltv_score", "customer_id"),
        )
    )
    freshness = " union all ".join(
        f"select '{t}' table_name, max(_ingested_at) max_ingested_at from raw_{t}" for t in raw_ctes
    )
    as_of = "TIMESTAMP '2024-02-02 02:30:00'"
    one_hot = ", ".join(
        f"cast(acquisition_channel = '{c}' as tinyint) acquisition_channel_{c}"
        for c in ("direct", "organic", "paid_search", "referral", "social")
    )
    standard = ", ".join(
        f"cast(cast(sum({c} * customers) as double) / cast(sum(customers) as double) as decimal(9,6)) {c}_mean, "
        f"cast(sqrt(cast(sum(customers) as double) * cast(sum({c} * {c} * customers) as double) - cast(sum({c} * customers) as double) * cast(sum({c} * customers) as double)) / cast(sum(customers) as double) as decimal(9,6)) {c}_std"
        for c in ("recency_score", "frequency_score", "monetary_score")
    )
    halved = "cast(((2*cast(churn_score*10000 as bigint)+2)//4) * 0.0001::decimal(5,4) as decimal(5,4))"
    return {
        "rfm_quintiles": "select customer_id, recency_score, frequency_score, monetary_score, rfm_score from customer_360",
        "seed_enrichment": """
select customer_id, acquisition_channel, country_code, coalesce(label, 'unknown') channel_label,
 coalesce(country_name, 'unknown') country_name, coalesce(region, 'unknown') region
from stg_customers left join seed_channels on acquisition_channel = channel_code
left join seed_countries on country_code = alpha_2""",
        "revenue_by_status": """
select order_status, order_status = 'completed' is_revenue_positive, count(*) order_count,
 cast(sum(total_amount_usd) as decimal(18,2)) total_amount_usd from stg_orders group by 1""",
        "upsert_latest": f"""
select customer_id, case when acquisition_channel in ('direct','paid_search') then name || '-new' else name end as name, email,
 acquisition_channel, country_code, account_created_at,
 case when acquisition_channel = 'direct' then _ingested_at + interval 2 day else {T1} end _ingested_at, _run_date
from raw_customers where _ingested_at = {T1}""",
        "incremental_replace_by_key": f"""
select order_id, customer_id, case when cast(ordered_at as date) >= {RUN} - 365 then order_status else 'pending' end order_status,
 total_amount_usd, item_count, avg_item_value_usd, ordered_at,
 case when cast(ordered_at as date) >= {RUN} - 365 then {RUN} else {PRIOR} end _run_date from mart_orders""",
        "incremental_replace_partition": "select * from int_customer_orders union all select * from prior_customer_orders",
        "maintained_orders": _maintained_sql(),
        "maintained_others": """
select 'tickets' as name, customer_id as key, count(*) filter (where status = 'open') as value from stg_tickets group by 2
union all select 'sessions', session_id, epoch_us(max(occurred_at))//1000000 - epoch_us(min(occurred_at))//1000000 from stg_events group by 2
union all select 'events', customer_id, epoch_us(max(occurred_at))//1000000 from stg_events group by 2""",
        "load_summary": load,
        "pipeline_tables": pipeline,
        "known_parent_orders": "select order_id, customer_id, total_amount_usd from fraw_orders where customer_id in (select customer_id from fraw_customers)",
        "run_log_current": """
select session_id run_id, min(cast(occurred_at as date)) run_date, 'session' job_name,
 arg_max(case event_type when 'purchase' then 'success' when 'error' then 'failed' else 'running' end, occurred_at) status,
 min(occurred_at) started_at, max(occurred_at) filter (where event_type in ('purchase','error')) completed_at,
 cast(max(hour(occurred_at)) filter (where event_type in ('purchase','error')) as integer) duration_seconds,
 max(cast(event_id as bigint)) filter (where event_type in ('purchase','error')) rows_ingested, cast(null as varchar) notes,
 cast(max(minute(occurred_at)) filter (where event_type in ('purchase','error')) as bigint) rows_transformed,
 max(30) filter (where event_type in ('purchase','error')) qg_tests_total,
 max(case event_type when 'purchase' then 30 when 'error' then 29 end) qg_tests_passed,
 max(case event_type when 'purchase' then 0 when 'error' then 1 end) qg_tests_failed,
 max(occurred_at) filter (where event_type = 'error') sla_breach_at
from stg_events group by 1""",
        "daily_job": f"""
select * from (with days as (select {RUN} run_date), people as (select count(*) n from customer_360),
failed as (select count(*) n from ({_report(raw_suites(), {t: f"(select * from {c})" for t, c in newest_raw.items()})}) where not success)
select name, run_date, n row_count from days cross join (
 select 'mart_customer_360' as name, n from people union all select 'ml_scores', n from people
 union all select 'daily_insights', 1 union all select 'jobs that wrote', 3
 union all select 'rows loaded', ({loaded}) union all select 'checks failed', n from failed)
union all select 'mart_ml_scores', {RUN}, n from people
union all select 'tickets with a topic', {RUN}, count(*) from stg_tickets)""",
        "expectation_report": report,
        "load_rejects": _rejects_sql(),
        "segment_inactive": "select customer_id from customer_360 where order_frequency_365d = 0",
        "ltv_bounds": "select acquisition_channel channel, count(*) customers, 0 out_of_bounds from customer_360 group by 1",
        "churn_bounds": "select customer_id, true is_consistent from customer_360 where is_active",
        "ml_score_bounds": "select customer_id, is_active has_churn, order_frequency_365d = 0 is_inactive, true has_value from customer_360",
        "topic_bounds": "select ticket_id, true is_consistent from stg_tickets",
        "daily_outputs": f"""
select run_date, count(*) row_count, 'daily_anomalies' table_name from daily_scored where run_date in ({PRIOR}, {RUN}) group by 1
union all select unnest([{PRIOR}, {RUN}]), 1, 'daily_insights'""",
        "dq_failures": f"""
select {RUN} run_date, 'expectation' failure_type, 'raw' source_domain, table_name, 'raw_suites' checkpoint_or_test_name,
 column_name failing_column, check_name failing_expectation, sample_failing_rows, {SCORED} logged_at
from ({_report(raw_suites(), raw_ctes, RAW_KEYS)}) where not success""",
        "maintained_checks": "select table_name, check_name, column_name, element_count, unexpected_count, sample_failing_rows "
        f"from ({_report(raw_suites(), stored_raw, RAW_KEYS)}) union all {stored_orphans}",
        "model_check_report": _report(model_suites(), model_ctes),
        "orphan_fk_report": orphan_union,
        "orphan_orders": _orphans("fstg_orders", "order_id"),
        "orphan_events": _orphans("fstg_events", "event_id"),
        "orphan_tickets": _orphans("fstg_tickets", "ticket_id"),
        "orphan_order_items": _orphans("fstg_order_items", "order_item_id", "order_id", "fstg_orders"),
        "campaign_click_violations": "select campaign_id, campaign_date, impressions, clicks from fmart_campaigns where clicks > impressions",
        "rfm_bounds_violations": """
select * from (select customer_id, cast(recency_score + 1 as smallint) recency_score, frequency_score, monetary_score,
 case when is_active then rfm_score else 'R0F0M1' end rfm_score, days_since_last_order recency_days, order_frequency_365d from customer_360)
where recency_score not between 0 and 5 or frequency_score not between 0 and 5 or monetary_score not between 0 and 5
 or not regexp_full_match(rfm_score, 'R[0-5]F[0-5]M[0-5]') or recency_days > 999 or (order_frequency_365d = 0 and rfm_score <> 'R0F0M0')""",
        "score_bounds_violations": """
select customer_id, score_date, ltv_score, churn_score, churn_risk_tier from bad_score_rows
where ltv_score < 0 or churn_score < 0 or churn_score > 1 or churn_risk_tier not in ('Low','Medium','High')
 or (churn_score < 0.33 and churn_risk_tier <> 'Low') or (churn_score >= 0.33 and churn_score < 0.67 and churn_risk_tier <> 'Medium')
 or (churn_score >= 0.67 and churn_risk_tier <> 'High')""",
        "negative_money_violations": negatives,
        "volume_drift": """
select c current_row_count, p prior_row_count, cast(cast((2*abs(c-p)*1000000+p)//(2*p) as decimal(18,0)) * 0.000001::decimal(7,6) as decimal(18,6)) deviation_pct
from (select count(*) c, count(*) filter (where acquisition_channel <> 'direct') p from customer_360)
where p > 0 and abs(c-p) * 100 > p * 20""",
        "source_freshness": f"""
select table_name, max_ingested_at, case when max_ingested_at < {as_of} - interval 2 day then 'error'
 when max_ingested_at < {as_of} - interval 1 day then 'warn' else 'pass' end status from ({freshness})""",
        "feature_snapshot": "select * exclude (_run_date) from customer_360",
        "features_log1p": "select customer_id, cast(ln(1 + cast(total_spend_365d_usd as double)) as decimal(12,6)) total_spend_365d_usd_log1p, cast(ln(1 + cast(total_spend_usd as double)) as decimal(12,6)) total_spend_usd_log1p from customer_360",
        "features_onehot": f"select customer_id, is_active, {one_hot} from customer_360",
        "features_clip": "select customer_id, case when days_since_last_order is not null then least(greatest(cast(days_since_last_order as double), 30.0), 999.0) end days_since_last_order from customer_360",
        "avg_order_value": "select customer_id, case when total_order_count > 0 then cast(total_spend_usd as double) / total_order_count else 0.0::double end avg_order_value from customer_360",
        "safe_coercion": """
select event_id, try_cast(json_extract_string(props, '$.k') as double) k_number, 0.0::double type_number,
 coalesce(case event_type when 'purchase' then true when 'click' then true when 'view' then false when 'signup' then false end, false) flag_from_text,
 value - 5 > 0 flag_from_number from events""",
        "churn_label": "select customer_id, churn_label from labels_churn where is_active",
        "churn_features": """
select customer_id, cast(coalesce(days_since_last_order, 999) as double) days_since_last_order,
 cast(coalesce(days_since_last_event, 999) as double) days_since_last_event, cast(open_ticket_count as double) open_ticket_count,
 cast(order_frequency_trend as double) order_frequency_trend from customer_360""",
        "risk_tiers": "select customer_id, churn_score, churn_risk_tier from score_rows",
        "stratified_split": _split_sql("select customer_id id, channel stratum from history", "customer_id", "channel"),
        "stratified_split_many": _split_sql(
            "select cast(o_orderkey as varchar) id, o_custkey % 997 stratum from orders", "order_id", "stratum"
        ),
        "cohort_mean_ltv": "select * from means",
        "cold_start_ltv": "select customer_id, cast(coalesce(case when channel <> 'direct' then cohort_mean end, 0) as double) ltv_score from customer_360 left join means on acquisition_channel = channel",
        "regression_metrics": """
select cast(sqrt(avg((cast(cohort_mean as double) - target) * (cast(cohort_mean as double) - target))) as decimal(18,2)) rmse,
 cast(avg(abs(cast(cohort_mean as double) - target)) as decimal(18,2)) mae from history join means using (channel)""",
        "classification_metrics": """
select cast((select cast(sum(p * (2 * below + q)) as double) from class_ranked) / (2.0 * pos * neg) as decimal(9,6)) auc_roc,
 cast(coalesce(tp / nullif(tp + fp, 0), 0) as decimal(9,6)) "precision", cast(coalesce(tp / nullif(pos, 0), 0) as decimal(9,6)) recall
from (select sum(p) pos, sum(q) neg, coalesce(sum(p) filter (where s >= 0.5), 0) tp, coalesce(sum(q) filter (where s >= 0.5), 0) fp from class_counts)""",
        "segmentation_grid": "select * from grid",
        "rfm_standardization": f"select {standard} from grid",
        "model_promotion": """
select 'customer_segmentation' model_name, version, run_date, silhouette_score, rmse, auc_roc, (select count(*) from months) registered_versions
from months qualify row_number() over (order by silhouette_score desc, version) = 1
union all select 'customer_ltv', version, run_date, silhouette_score, rmse, auc_roc, (select count(*) from ltv_runs where ok)
from ltv_runs where ok qualify row_number() over (order by version desc) = 1
union all select 'customer_churn', version, run_date, silhouette_score, rmse, auc_roc, (select count(*) from months where auc_roc > 0.7)
from months where auc_roc > 0.7 qualify row_number() over (order by version desc) = 1""",
        "score_fallback": f"""
select customer_id, {RUN} score_date, 'fallback' model_run_id, ltv_score, case when is_active then churn_score else halved end churn_score,
 case when is_active then churn_risk_tier when halved < 0.33 then 'Low' when halved < 0.67 then 'Medium' else 'High' end churn_risk_tier,
 segment_label, false anomaly_flag, cast(null as varchar) anomaly_detail, {SCORED} scored_at
from (select s.*, is_active, {halved} halved from score_rows s join customer_360 using (customer_id))""",
        "score_job": f"""
select customer_id, {RUN} score_date, 'sample' model_run_id, ltv_score, halved churn_score,
 case when halved < 0.33 then 'Low' when halved < 0.67 then 'Medium' else 'High' end churn_risk_tier,
 segment_label, false anomaly_flag, cast(null as varchar) anomaly_detail, {SCORED} scored_at, {RUN} _run_date
from (select *, {halved} halved from score_rows)""",
        "ml_score_sink": _mart_scores("(select * from score_rows union all select * from prior_score_rows)"),
        "mart_ml_scores": _mart_scores("(select * from score_rows union all select * from prior_score_rows)"),
        "anomaly_zscore": """
select run_date, metric_name, v observed_value, m rolling_mean_30d, s rolling_std_30d, z z_score, coalesce(abs(z) > 2, false) anomaly_flag,
 severity, lo expected_range_low, hi expected_range_high from daily_severity""",
        "anomaly_details": """
select run_date, metric_name, '{"metric":"' || metric_name || '","observed":' || cast(v as varchar) || ',"expected_range":{"low":'
 || cast(lo as varchar) || ',"high":' || cast(hi as varchar) || '},"severity":"' || severity || '"}' anomaly_detail
from daily_severity where abs(z) > 2""",
        "daily_insight": f"""
select {RUN} run_date, '{{"customers":' || cast(count(*) as varchar) || ',"active_customers":' || cast(count(*) filter (where is_active) as varchar)
 || ',"top_customers":' || cast(count(*) filter (where rfm_score = 'R5F5M5') as varchar)
 || ',"spend_365d_usd":' || cast(cast(sum(total_spend_365d_usd) as decimal(20,2)) as varchar)
 || ',"open_tickets":' || cast(sum(open_ticket_count) as varchar)
 || ',"orders":' || cast((select count(*) from mart_orders) as varchar)
 || ',"order_value_usd":' || cast((select cast(sum(total_amount_usd) as decimal(20,2)) from mart_orders) as varchar) || '}}' insight_json
from customer_360""",
    }


def oracle_sql() -> dict[str, str]:
    extra = {**EXTRA, "fmart_ml_scores": _mart_scores("fscore_rows"), "fscore_rows": _scores("fcustomer_360", RUN)}
    answers = {name: table(cte) for name, cte in _TABLES.items()}
    answers.update({name: sql(text, extra) for name, text in _statements().items()})
    return answers

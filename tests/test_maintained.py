"""Metrics carried from date to date against their recomputation from all orders."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from patronlens.plans import intermediate, maintained
from tests.conftest import RUN_DATE

DDL = "order_id string, customer_id string, total_amount_usd decimal(12,2), ordered_at timestamp"


def order(pick, number):
    age = pick.choice([0, 1, 29, 30, 31, 59, 60, 61, 62, 364, 365, 366, 367, 500, -3, pick.randrange(400)])
    at = datetime.combine(RUN_DATE - timedelta(days=age), datetime.min.time()) + timedelta(hours=pick.randrange(24))
    return f"o{number}", f"c{pick.randrange(12)}", Decimal(pick.randrange(1, 99999)) / 100, at


def metrics(df):
    return sorted(tuple(r) for r in df.collect())


def test_dates_in_a_row_equal_the_recomputation(spark, store):
    pick = random.Random(5)
    current: dict[str, tuple] = {}
    for step, gap in enumerate([0, 1, 1, 0, 2, 7, 33, 1]):
        run_date = (RUN_DATE if step == 0 else run_date) + timedelta(days=gap)
        fresh = [order(pick, f"{step}-{i}") for i in range(60 if step == 0 else pick.choice([0, 5, 9]))]
        replaced = None
        if step in (2, 5, 6):
            gone = pick.sample(sorted(current), 12)
            replaced = [current.pop(k) for k in gone]
            fresh += [(k, c, amount + 1, at + timedelta(days=pick.choice([0, 1, 400]))) for k, c, amount, at in replaced[:6]]
        current |= {r[0]: r for r in fresh}
        rows = lambda values: spark.createDataFrame(values, DDL)
        got = maintained.advance_orders(store, run_date, rows(fresh), None if replaced is None else rows(replaced))
        assert metrics(got) == metrics(intermediate.int_customer_orders(rows(list(current.values())), run_date))
        assert maintained.state_date(store) == run_date
    with pytest.raises(ValueError, match="already"):
        maintained.advance_orders(store, RUN_DATE, rows([]))


def test_only_days_that_move_are_read(spark, store):
    rows = [(f"o{i}", f"c{i % 50}", Decimal(5), datetime.combine(RUN_DATE - timedelta(days=i), datetime.min.time())) for i in range(500)]
    maintained.advance_orders(store, RUN_DATE, spark.createDataFrame(rows, DDL))
    after = RUN_DATE + timedelta(days=1)
    days = maintained._read_days(store, maintained.moving_days(RUN_DATE, after))
    ages = {(RUN_DATE - r.day).days for r in days.select("day").distinct().collect()}
    assert ages == {30, 60, 365}
    assert {path.split("day=")[1][:10] for path in days.inputFiles()} == {
        (RUN_DATE - timedelta(days=age)).isoformat() for age in ages
    }

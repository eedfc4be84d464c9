"""Steps that had to grow no faster than their input: against brute force on odd rows, and what their plans may hold."""

import calendar
import datetime as dt
import math
import random

import pytest

from marketlens.plans import inventory, supply
from marketlens.sources.tables import SCHEMAS, Tables


def made(spark, **rows):
    t = Tables(spark, "/nowhere")
    for name in ("nation", "region", *rows):
        t._cache[name] = spark.createDataFrame(rows.get(name, []), SCHEMAS[name])
    return t


def sales(seed):
    rng = random.Random(seed)
    orders, lines = [], []
    for o in range(160):
        day = dt.datetime(1996, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 30, 31, 59, 60, rng.randint(0, 500)]), hours=rng.randint(0, 23))
        orders.append((o, 1, "F", 1.0, None if o % 40 == 7 else day, "1"))
        for n in range(rng.randint(1, 3)):
            lines.append((o, rng.choice([1, 2, 3, 4, None]), 1, n, None if rng.random() < 0.1 else float(rng.randint(1, 50)), 1.0, 0.0, 0.0, "N", "O", day))
    return orders, lines


def plain_ledger(orders, lines, first_day=False):
    when = {o[0]: o[4] for o in orders}
    sold = {}
    for line in lines:
        if when[line[0]] is not None:
            units = sold.setdefault(line[1], {})
            d = when[line[0]].date()
            units[d] = units.get(d, 0.0) + (line[4] or 0.0)
    out = {}
    for product, days in sold.items():
        total = {}
        for d, u in days.items():
            total[d.year, d.month] = total.get((d.year, d.month), 0.0) + u
        for (y, m), units in total.items():
            stock = math.ceil(units * 1.5) + math.ceil(total.get((y, m - 1) if m > 1 else (y - 1, 12), 0.0) * 1.1)
            for k in range(1, calendar.monthrange(y, m)[1] + 1):
                d = dt.date(y, m, k)
                stock -= days.get(d, 0.0) if k > 1 or first_day else 0.0
                out[product, d] = (stock, max(stock, 0.0), days.get(d, 0.0))
    return out


@pytest.mark.parametrize("first_day", [False, True])
def test_ledger_of_odd_rows(spark, first_day):
    orders, lines = sales(3)
    lines = [line if line[4] is not None else (*line[:4], 0.0, *line[5:]) for line in lines]
    got = supply.stock_ledger(made(spark, orders=orders, lineitem=lines), subtract_first_day=first_day).collect()
    want = plain_ledger(orders, lines, first_day)
    assert len(got) == len(want) and {(r[0], r[1]): tuple(r[2:]) for r in got} == want


def test_ledger_days_are_not_sorted_or_dealt(spark):
    orders, lines = sales(4)
    t = made(spark, orders=orders, lineitem=lines, part=[(1, "a", "b", "c", 2, 10.0)])
    for frame in (supply.stock_ledger(t), inventory.holding_cost_actual(t)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("Generate")]
        assert not any(step in above for step in ("Window", "Sort", "Exchange"))


def test_holding_cost_against_the_days_in_order(spark):
    orders, lines = sales(5)
    parts = [(1, "a", "b", "c", 2, 10.0), (2, "a", "b", "c", 7, 30.0), (2, "a", "b", "c", 7, 30.0), (3, "a", "b", "c", 5, None), (None, "a", "b", "c", 1, 1.0)]
    before = dt.date(1996, 12, 20)
    got = sorted(map(tuple, inventory.holding_cost_actual(made(spark, orders=orders, lineitem=lines, part=parts), before.isoformat()).collect()),
                 key=lambda r: (r[0], r[1], r[8]))
    ledger, want = plain_ledger(orders, lines), []
    for product in (1, 2, 3):
        yesterday, made_, held = None, 0.0, 0.0
        rows = [p for p in parts if p[0] == product]
        for (_, day), (_, stock, sold) in sorted((k, v) for k, v in ledger.items() if k[0] == product and k[1] < before):
            for p in rows:
                order = max(stock - ((stock if yesterday is None else yesterday) - sold), 0.0)
                cost = None if p[5] is None else p[5] / 2 * order
                made_, held, yesterday = None if cost is None else made_ + cost, held + stock * p[4] * 0.02, stock
                want.append((product, day, stock, sold, order, cost, stock * p[4] * 0.02, made_, held))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and all((x is None and y is None) or abs(x - y) < 1e-6 for x, y in zip(a[4:], b[4:], strict=True)), (a, b)

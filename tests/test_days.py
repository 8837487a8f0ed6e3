"""A run of days gives the rows of those days and reaches the scan as a filter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.plans import cards, ledger, sales, stock, suppliers
from tidewright.registry.bindings import Tables

FIRST, LAST = dt.date(1998, 3, 1), dt.date(1998, 9, 30)
CARD_FIRST, CARD_LAST = dt.date(2024, 1, 5), dt.date(2024, 1, 9)


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def changes(t, *days):
    return stock.stock_change_erp(t.ledger, t.batches, t.stock, t.papers, *days)


MARTS = {
    "sale_by_category": (lambda t, *d: sales.sale_by_category(t.orders, t.details, t.products, *d), "create_time"),
    "pay_by_category": (
        lambda t, *d: sales.pay_by_category(t.orders, t.details, t.payments, t.pay_methods, t.products, *d),
        "create_time",
    ),
    "money_section": (
        lambda t, *d: sales.money_section(t.orders, t.details, t.payments, t.pay_methods, t.products, t.shops, *d),
        "create_time",
    ),
    "marketing": (
        lambda t, *d: sales.marketing_activities(
            t.orders, t.details, t.payments, t.pay_methods, t.products, t.activities, *d
        ),
        "dates",
    ),
    "category_vs_task": (
        lambda t, *d: sales.category_vs_task(t.orders, t.details, t.products, t.tasks, *d), "create_time",
    ),
    "product_sale": (
        lambda t, *d: sales.product_sale_detailed(t.orders, t.details, t.products, t.shops, t.visitors, *d), "dates",
    ),
    "emphasis_sale": (
        lambda t, *d: sales.emphasis_sale(
            t.orders, t.details, t.wholesale_bills, t.wholesale_lines, t.products, t.monitored, *d
        ),
        "date",
    ),
    "changes": (changes, "date"),
    "book_stock_change": (
        lambda t, *d: stock.book_stock_change(changes(t), t.products, t.storages, *d), "create_time",
    ),
    "fine": (lambda t, *d: sales.fine_by_category(changes(t), t.products, t.depots, t.orders, *d), "create_time"),
    "circulation": (lambda t, *d: suppliers.station_circulation(t.ledger, t.batches, t.products, *d), "create_time"),
    "in_out": (lambda t, *d: suppliers.supplier_in_out(t.ledger, t.batches, t.products, *d), "create_time"),
    "wholesale": (lambda t, *d: suppliers.wholesale(t.ledger, t.batches, t.stock, t.products, *d), "create_time"),
    "give": (lambda t, *d: suppliers.give_aways(changes(t), t.depots, t.products, t.gifts, *d), "create_time"),
    "documents": (lambda t, *d: ledger.movements(t.bills, t.bill_lines, t.shops, t.batches, "B1998", *d), "create_time"),
    "cards": (lambda t, *d: cards.recharge_consume(t.trades, *d), "date"),
    "denomination": (lambda t, *d: cards.denomination(t.trades, t.card_info, *d), "date"),
}


@pytest.mark.parametrize("name", sorted(MARTS))
def test_days_equal_a_filter_on_the_whole(t, name):
    build, column = MARTS[name]
    days = (CARD_FIRST, CARD_LAST) if name in ("cards", "denomination") else (FIRST, LAST)
    part = build(t, *days)
    whole = build(t).where(F.to_date(column).between(*[F.lit(d) for d in days]))
    a, b = [sorted(map(str, df.select(*sorted(part.columns)).collect())) for df in (part, whole)]
    assert a and a == b


def test_day_filter_and_columns_reach_the_scan(t):
    plan = sales.hourly_kpi(t.till_orders, CARD_FIRST, CARD_LAST)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan and "LessThan(ts,2024-01-10T00:00)" in plan
    assert "props" not in plan
    plan = suppliers.wholesale(t.ledger, t.batches, t.stock, t.products, FIRST, LAST)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01T00:00)" in plan

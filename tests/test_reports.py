"""The reports: filters, orders, ties, limits, and their plans."""

import pyarrow as pa
import pytest

from changeloom.operators.calendar import build_dim_dates
from changeloom.plans import reports, star


@pytest.fixture(scope="module")
def fact_path(spark, tmp_path_factory):
    rows = [
        # order, item, customer, product, delivery, status, quantity, natural customer, natural product
        (1, 1, 10, 100, 20260105, "Open", 5, 1, 1),
        (1, 2, 10, 101, 20260105, "Open", 7, 1, 1),
        (2, 3, 11, 100, 20260105, "open", 2, 1, 1),
        (3, 4, 12, 102, None, "OPEN", 9, 2, 2),
        (4, 5, 12, 102, 20260106, "open", 1, 2, 2),
        (5, 6, 12, 100, 20260107, "open", 1, 2, 1),
        (6, 7, 13, 103, 20260108, "PENDING", 50, 3, 3),
    ]
    names = [
        "order_id", "order_item_id", "customer", "product", "delivery_date", "status", "quantity",
        "customer_id", "product_id",
    ]
    frame = spark.createDataFrame(pa.table([list(c) for c in zip(*rows)], names=names))
    frame = frame.selectExpr(
        "*", "lower(status) AS status_lc", "20260101 AS order_date",
        "cast(quantity AS decimal(13,5)) AS total_amount",
    )
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    frame.coalesce(1).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def fact(spark, fact_path):
    return spark.read.parquet(fact_path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_orders_by_date_and_status(fact):
    assert rows(reports.orders_by_delivery_date_and_status(fact, "oPEn")) == [
        (None, "OPEN", 1),
        (20260107, "open", 1),
        (20260106, "open", 1),
        (20260105, "Open", 1),
        (20260105, "open", 1),
    ]


@pytest.mark.parametrize("low, high", [("2026-01-06", 20260107), (20260106, "2026-01-07")])
def test_range_is_inclusive_and_drops_unknown_dates(fact, low, high):
    got = rows(reports.orders_by_delivery_date_and_status(fact, date_from=low, date_to=high))
    assert got == [(20260107, "open", 1), (20260106, "open", 1)]
    assert len(rows(reports.orders_by_delivery_date_and_status(fact, date_to=high))) == 4


def test_top_dates_break_ties_by_date(fact):
    assert rows(reports.top_delivery_dates(fact, limit=2)) == [(20260105, 2), (20260106, 1)]


def test_quantity_by_product(fact):
    assert rows(reports.pending_quantity_by_product(fact)) == [(102, 10), (100, 8), (101, 7)]
    assert rows(reports.pending_quantity_by_product(fact, by="natural")) == [(1, 15), (2, 10)]


def test_top_customers(fact):
    assert rows(reports.top_customers_by_orders(fact, limit=2)) == [(12, 3), (10, 1)]
    assert rows(reports.top_customers_by_orders(fact, by="natural")) == [(2, 3), (1, 2)]
    assert rows(reports.top_customers_by_orders(fact, approximate=True, limit=1)) == [(12, 3)]


@pytest.mark.parametrize("limit", [0, 101, -1, True, "3"])
def test_limit_is_checked(fact, limit):
    with pytest.raises(ValueError):
        reports.top_delivery_dates(fact, limit=limit)
    with pytest.raises(ValueError):
        reports.top_customers_by_orders(fact, limit=limit)


def test_unknown_grouping_is_refused(fact):
    with pytest.raises(ValueError):
        reports.pending_quantity_by_product(fact, by="other")


def test_records_keep_nulls(fact):
    got = rows(reports.records(reports.orders_by_delivery_date_and_status(fact)))
    assert ('{"delivery_date":null,"status":"OPEN","order_count":1}',) in got


def test_star_and_months(spark, fact):
    dates = build_dim_dates(spark)
    customers = spark.createDataFrame(
        pa.table({"customer": [10, 11, 12, 13], "customer_id": [1, 1, 2, 3], "customer_name": list("abcd"), "customer_address": list("ABCD")})
    )
    products = spark.createDataFrame(
        pa.table({"product": [100, 101, 102, 103], "product_id": [1, 1, 2, 3], "product_name": list("wxyz"), "barcode": list("1234")})
    )
    star = {r.order_item_id: r for r in reports.star(fact, customers, products, dates).collect()}
    assert len(star) == 7
    assert star[4].delivery_month is None and star[4].customer_name == "c"
    assert (star[1].order_day_of_week, star[1].delivery_day_of_week) == ("Thursday", "Monday")
    months = {r.status: r for r in reports.amounts_by_month(fact, dates).collect()}
    assert (months["open"].line_count, months["open"].total_quantity) == (3, 4)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_scan(fact):
    text = plan(reports.top_delivery_dates(fact, date_from="2026-01-01"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "EqualTo(status_lc,open)" in text and "GreaterThanOrEqual(delivery_date,20260101)" in text
    assert "ReadSchema: struct<order_id:bigint,delivery_date:bigint,status_lc:string>" in pushed
    assert "TakeOrderedAndProject" in text


def test_written_facts_are_pruned_by_month(spark, fact, tmp_path):
    path = str(tmp_path / "facts")
    star.write_facts(fact, path)
    stored = spark.read.parquet(path)
    report = reports.orders_by_delivery_date_and_status(stored, date_from="2026-01-06")
    assert rows(report) == [(20260107, "open", 1), (20260106, "open", 1)]
    assert "(delivery_month" in plan(report).split("PartitionFilters:")[1][:200]
    assert rows(reports.top_customers_by_orders(stored, limit=1)) == [(12, 3)]


def test_no_python_in_reports(fact):
    for report in (
        reports.orders_by_delivery_date_and_status(fact),
        reports.top_customers_by_orders(fact),
        reports.pending_quantity_by_product(fact),
    ):
        assert "Python" not in plan(report)

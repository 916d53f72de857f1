"""The fact build against an event-by-event account, and its edge cases one by one."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import world
from changeloom.operators import fact as facts, skew, state
from changeloom.operators.calendar import build_dim_dates
from changeloom.plans import star
from changeloom.sources import workspace
from world import customer, item, order, product

JAN = dt.date(2026, 1, 1)


def build(spark, messages, **options):
    log = world.log_frame(spark, messages)
    return star.build_facts(star.from_log(log), build_dim_dates(spark), **options)


def fact(spark, messages, **options):
    return world.fact_dict(build(spark, messages, **options).fact)


def random_worlds(count=100, size=40):
    rng = random.Random(7)
    return [m for n in range(count) for m in world.random_world(rng, 100 * (n + 1), size)]


@pytest.mark.parametrize("price_mode", ["reference", "consistent"])
@pytest.mark.parametrize("rows_per_task", [1_000_000, 12])
def test_equals_event_by_event_account(spark, price_mode, rows_per_task):
    messages = random_worlds()
    known = world.sources(messages)
    customers, products = world.source_frames(spark, *known)
    expected = world.replayed(messages, *known, price_mode)
    random.Random(1).shuffle(messages)
    got = fact(
        spark, messages, customer_source=customers, product_source=products,
        price_mode=price_mode, rows_per_task=rows_per_task,
    )
    assert len(got) > 200
    assert got == expected


def test_late_members_settle_a_line_at_its_next_event(spark):
    customers, products = world.source_frames(spark, [(9, "No", "One")], [(9, "No", "9", Decimal("1.00"))])
    known = {"customer_source": customers, "product_source": products}
    waiting = [order(1, 1), item(2, 5), customer(3, 1), product(4, 1)]
    assert fact(spark, waiting, **known) == {}
    assert [r.order_item_id for r in build(spark, waiting, **known).unresolved.collect()] == [5]
    for event in (order(5, 1, status="DONE"), item(5, 5, quantity=8)):
        got = build(spark, [*waiting, event], **known).fact.collect()
        assert [(r.customer, r.product, r.first_at, r.created_at) for r in got] == [(3, 4, 5, world.stamp(5))]
    # An event of the order between the two members does not settle it.
    early = [order(1, 1), item(2, 5), customer(3, 1), order(4, 1), product(5, 1)]
    assert fact(spark, early, **known) == {}


def test_every_item_is_somewhere_exactly_once(spark):
    messages = random_worlds(40)
    built = build(spark, messages)
    changes = star.from_log(world.log_frame(spark, messages))
    orders, items = state.staging_orders(changes.orders), state.staging_items(changes.order_items)
    parts = [built.fact, built.unresolved, built.quarantine, facts.pending_items(orders, items)]
    found = [r[0] for part in parts for r in part.select("order_item_id").collect()]
    assert sorted(found) == sorted(r[0] for r in items.select("order_item_id").collect())


BASE = [customer(1, 1), product(2, 1)]


def test_either_side_may_come_first(spark):
    one = fact(spark, [*BASE, order(10, 1), item(11, 5)])
    two = fact(spark, [*BASE, item(10, 5), order(11, 1)])
    assert one == two and one[5]["quantity"] == 3


def test_one_sided_lines_wait(spark):
    messages = [*BASE, order(10, 1), item(11, 5, order_id=2)]
    assert fact(spark, messages) == {}
    changes = star.from_log(world.log_frame(spark, messages))
    orders, items = state.staging_orders(changes.orders), state.staging_items(changes.order_items)
    assert [r.order_id for r in facts.pending_orders(orders, items).collect()] == [1]
    assert [r.order_item_id for r in facts.pending_items(orders, items).collect()] == [5]


def test_last_quantity_and_status_win_keys_stay(spark):
    messages = [
        *BASE, customer(3, 9), order(10, 1), item(11, 5), item(12, 6),
        item(13, 5, order_id=8, product_id=9, quantity=7),
        order(14, 1, customer_id=9, status="DONE", day=JAN + dt.timedelta(3), delivery=None),
    ]
    got = fact(spark, messages)
    assert set(got) == {5, 6}
    assert [got[i]["status"] for i in (5, 6)] == ["DONE", "DONE"]
    assert got[5]["quantity"] == 7 and got[5]["order_id"] == 1
    assert got[5]["customer"] == 1 and got[5]["order_date"] == 20260101
    assert got[5]["delivery_date"] is None
    kept = fact(spark, messages, keep_delivery_on_null=True)
    assert kept[5]["delivery_date"] == 20260111


def test_price_change_between_first_and_last_merge(spark):
    messages = [*BASE, order(10, 1), item(11, 5), product(12, 1, price="4.00"), order(13, 1, status="DONE")]
    got = fact(spark, messages)[5]
    assert (got["unity_price"], got["total_amount"]) == (Decimal("2.5"), Decimal("12"))
    got = fact(spark, messages, price_mode="consistent")[5]
    assert (got["unity_price"], got["total_amount"]) == (Decimal("2.5"), Decimal("7.5"))


def test_fact_keeps_the_version_of_its_time(spark):
    messages = [*BASE, order(10, 1), item(11, 5), customer(12, 1, address="Away"), order(13, 1, status="DONE")]
    assert fact(spark, messages)[5]["customer"] == 1


def test_fact_before_any_dimension_event(spark):
    messages = [order(1, 1), item(2, 5), customer(8, 1), product(9, 1)]
    got = fact(spark, messages)[5]
    assert (got["customer"], got["product"]) == (8, 9)
    customers, products = world.source_frames(
        spark, [(1, "Ann", "There")], [(1, "Pen", "1", Decimal("3.00"))]
    )
    got = fact(spark, messages, customer_source=customers, product_source=products)[5]
    assert (got["customer"], got["product"], got["unity_price"]) == (-2, -2, Decimal(3))


def test_inferred_member_is_valid_until_the_first_version(spark):
    messages = [order(1, 1), item(2, 5), customer(8, 1), product(9, 1)]
    customers, products = world.source_frames(
        spark, [(1, "Ann", "There")], [(1, "Pen", "1", Decimal("3.00"))]
    )
    changes = star.from_log(world.log_frame(spark, messages))
    built = build(spark, messages, customer_source=customers, product_source=products)
    dim = star.with_inferred(
        star.dim_customers(changes.customers), built.fact, customers,
        "customer_id", "customer", star.CUSTOMER_ATTRS,
    )
    rows = {r.customer: r for r in dim.collect()}
    assert rows[-2].customer_address == "There" and not rows[-2].is_current
    assert (rows[-2].from_seq, rows[-2].to_seq) == (2, 8)
    assert (rows[-2].valid_from, rows[-2].valid_to) == (world.stamp(2), world.stamp(8))
    assert rows[8].is_current and rows[8].customer_address == "Here"


def test_unknown_member_is_unresolved(spark):
    built = build(spark, [customer(1, 1), order(10, 1), item(11, 5, product_id=77)])
    assert built.fact.count() == 0
    assert [r.order_item_id for r in built.unresolved.collect()] == [5]


def test_missing_price_counts_as_zero(spark):
    got = fact(spark, [customer(1, 1), product(2, 1, price=None), order(10, 1), item(11, 5)])[5]
    assert (got["unity_price"], got["total_amount"]) == (Decimal(0), Decimal(0))


def test_dates_outside_the_calendar_and_large_amounts(spark):
    messages = [
        *BASE, product(3, 2, price="99999999"), order(10, 1, day=dt.date(2025, 12, 31)), item(11, 5),
        order(12, 2, delivery=dt.date(2030, 1, 1)), item(13, 6, order_id=2),
        order(14, 3, delivery=None), item(15, 7, order_id=3), item(16, 8, order_id=3, product_id=2),
    ]
    built = build(spark, messages)
    assert set(world.fact_dict(built.fact)) == {7}
    reasons = {r.order_item_id: r.reasons for r in built.quarantine.collect()}
    assert reasons == {
        5: ["order_date_not_in_calendar"],
        6: ["delivery_date_not_in_calendar"],
        8: ["total_amount_too_large"],
    }
    corrected = build(spark, [*messages, order(20, 2, delivery=JAN)])
    assert set(world.fact_dict(corrected.fact)) == {6, 7}


def test_replay_of_the_whole_log_changes_nothing(spark):
    messages = random_worlds(20)
    assert fact(spark, messages) == fact(spark, messages + messages)


def test_rejects_unknown_price_mode(spark):
    with pytest.raises(ValueError):
        build(spark, BASE, price_mode="other")


def test_what_is_resolved_is_not_stored(spark, monkeypatch):
    messages = random_worlds(10)
    customers, products = world.source_frames(spark, *world.sources(messages, every=3))
    stored = {}

    def written(rows, purpose):
        table = workspace.written(rows, purpose)
        stored[purpose] = table
        return table

    monkeypatch.setattr(facts, "written", written)
    built = build(spark, messages, customer_source=customers, product_source=products)
    assert set(stored) == {"members", "lines", "keys", "waiting", "late", "settled"}
    assert 0 < stored["settled"].count() <= stored["waiting"].count() < stored["lines"].count()
    assert all(name.endswith(".zstd.parquet") for name in stored["lines"].inputFiles())
    assert len(world.fact_dict(built.fact)) + built.unresolved.count() + built.quarantine.count() == stored["lines"].count()


def test_events_are_dealt_before_they_are_reduced_unless_keys_have_many(spark, monkeypatch):
    rows = spark.range(40).select(F.col("id").alias("few"), (F.col("id") % 4).alias("many"))

    def exchanges(key):
        return state.dealt(rows, key)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")

    assert (exchanges("few"), exchanges("many")) == (1, 0)
    monkeypatch.setattr(state, "ROWS_PER_TASK", 0)  # a key may be hot
    assert exchanges("few") == 0


def test_a_fullest_hash_bounds_every_key(spark):
    rows = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("k"))
    assert 200 <= skew.most_of_a_hash(rows, "k") < 300
    assert skew.most_of_a_hash(rows.limit(0), "k") == 0


@pytest.mark.parametrize("rows_per_task", [2, 1000])
def test_keys_are_judged_as_by_one_count_of_all(spark, monkeypatch, rows_per_task):
    """Keys of lines: 1 known, 2 early, 3 without version, 4 later than the first line but not early, 5 without position, 6 both, 7 hot."""
    at = [(1, 10), (1, 50), (2, 5), (2, 90), (3, 30), (4, 60), (5, None), (6, None), (6, 40), (None, 20)] + [(7, 70)] * 4
    lines = spark.createDataFrame(at, "k long, first_at long")
    versions = spark.createDataFrame([(1, 3), (1, 8), (2, 7), (4, 55), (5, 1), (6, 35), (7, 4), (8, 99), (None, 1)], "k long, from_seq long")
    counts = []
    over = facts.over
    monkeypatch.setattr(facts, "over", lambda *a: counts.append(a) or over(*a))
    keys = facts._judged_keys(lines, versions, "k", rows_per_task)
    assert sorted(map(tuple, keys.early.collect())) == [(2, 7), (3, None), (5, 1)]
    # Keys are counted one by one only where a hash of them is too full.
    assert keys.hot == bool(counts) == (rows_per_task == 2)

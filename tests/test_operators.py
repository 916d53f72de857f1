"""As-of resolution, versions, numbering, calendar and upserts."""

import bisect
import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.operators import asof, scd2, skew, upsert
from changeloom.operators.asof import resolve_asof
from changeloom.operators.calendar import build_dim_dates
from changeloom.operators.surrogate import dense_number


def skewed(spark):
    """Facts and versions of which one key has over a third, many of them at one position."""
    rng = random.Random(3)
    keys = [0 if rng.random() < 0.4 else rng.randint(1, 50) for _ in range(3000)]
    at = [5000 if rng.random() < 0.2 else rng.randint(0, 9999) for _ in keys]
    versions = {(0 if rng.random() < 0.4 else rng.randint(1, 50), rng.randint(0, 9999)) for _ in range(2000)}
    facts = pa.table({"id": range(len(keys)), "k": keys, "at": at, "later": [a + 500 for a in at]})
    vk, vs = zip(*sorted(versions))
    changes = pa.table({"k": vk, "from_seq": vs, "name": [f"{k}:{s}" for k, s in zip(vk, vs)]})
    return spark.createDataFrame(facts), spark.createDataFrame(changes)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 300, 20])
def test_asof_equals_a_search_per_fact(spark, rows_per_task):
    facts, versions = skewed(spark)
    hot = skew.hot_keys(versions, "k", "from_seq", facts, rows_per_task)
    assert (hot is None) == (rows_per_task > 300)
    probes = {"at": {"first": "name"}, "later": {"last": "name"}}
    got = resolve_asof(facts, versions, "k", "from_seq", probes, ["id"], rows_per_task).collect()
    starts = {}
    for row in versions.orderBy("from_seq").collect():
        starts.setdefault(row.k, []).append(row.from_seq)

    def valid(k, at):
        passed = bisect.bisect_right(starts.get(k, []), at)
        return f"{k}:{starts[k][passed - 1]}" if passed else None

    assert len(got) == facts.count()
    for row in got:
        assert row.first == valid(row.k, row.at) and row.last == valid(row.k, row.later)


def test_no_group_is_above_the_rows_of_a_task(spark):
    """Key 0 has more than a third of the rows, and many of its facts are at one position."""
    facts, versions = skewed(spark)
    limit = 300
    hot = skew.hot_keys(versions, "k", "from_seq", facts, limit)
    assert [r.k for r in hot.collect()] == [0]
    salts = skew.salts_of(facts, hot, "k", "at", limit)
    split = asof._split_versions(versions, hot, salts, "k", "from_seq")
    placed = (
        facts.join(hot, "k")
        .withColumn("_slice", skew.slice_of(F.col("bounds"), F.col("at")))
        .join(salts, ["k", "_slice"])
        .withColumn("_salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    )
    group = ["k", "_slice", "_salt"]
    sizes = placed.select(*group).unionByName(split.select(*group)).groupBy(*group).count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) <= limit
    assert split.count() < versions.count() + facts.count()


def changes(spark, rows):
    names = ["k", "name", "seq", "ts"]
    data = [(k, n, s, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)) for k, n, s in rows]
    return spark.createDataFrame(pa.table([list(c) for c in zip(*data)], names=names))


@pytest.mark.parametrize("dedup", [False, True])
def test_versions_are_contiguous_and_one_is_current(spark, dedup):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, 2]), rng.choice("AB"), seq) for seq in range(300)]
    frame = changes(spark, rows + rows[:40])
    plain = scd2.versions(frame, "k", ["name"], dedup).collect()
    by_key = {}
    for row in sorted(plain, key=lambda r: (r.k, r.from_seq)):
        by_key.setdefault(row.k, []).append(row)
    for versions in by_key.values():
        assert [v.to_seq for v in versions] == [v.from_seq for v in versions[1:]] + [None]
        assert [v.valid_to for v in versions[:-1]] == [v.valid_from for v in versions[1:]]
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        if dedup:
            assert all(a.name != b.name for a, b in zip(versions, versions[1:]))
    if not dedup:
        assert len(plain) == len(rows)
    assert [r.k for r in skew.hot_keys(frame, "k", "seq", rows_per_task=150).collect()] == [0]
    assert sorted(scd2.versions(frame, "k", ["name"], dedup, 150).collect()) == sorted(plain)


def test_latest_is_the_current_version(spark):
    frame = changes(spark, [(1, "A", 1), (1, None, 3), (2, "B", 2)])
    got = {r.k: (r.name, r.from_seq) for r in scd2.latest(frame, "k", ["name"]).collect()}
    assert got == {1: (None, 3), 2: ("B", 2)}


@pytest.mark.parametrize("buckets", [1, 7])
def test_numbers_are_dense_and_in_order(spark, buckets):
    values = random.Random(2).sample(range(10**17, 10**18), 500)
    frame = spark.createDataFrame(pa.table({"v": values}))
    rows = dense_number(frame, "v", "n", start=5, buckets=buckets).orderBy("v").collect()
    assert [r.n for r in rows] == list(range(5, 505))
    assert [r.v for r in rows] == sorted(values)


def test_numbering_nothing(spark):
    frame = spark.createDataFrame(pa.table({"v": pa.array([], pa.int64())}))
    assert dense_number(frame, "v", "n").collect() == []


def test_default_calendar(spark):
    rows = build_dim_dates(spark).orderBy("dim_date").collect()
    assert len(rows) == 1461
    first = rows[0]
    assert (first.dim_date, first.calendar_date, first.day_of_week) == (20260101, dt.date(2026, 1, 1), "Thursday")
    assert (first.month, first.quarter, first.year) == (1, 1, 2026)
    assert rows[-1].dim_date == 20291231


def test_insert_missing_keeps_what_is_there(spark):
    old = spark.createDataFrame(pa.table({"k": [1, 2], "v": ["a", "b"]}))
    new = spark.createDataFrame(pa.table({"k": [2, 3], "v": ["x", "y"]}))
    assert sorted(upsert.insert_missing(old, new, "k").collect()) == [(1, "a"), (2, "b"), (3, "y")]


def test_upsert_by_name(spark):
    table = spark.createDataFrame(
        pa.table({"id": [1, 2], "name": ["a", "b"], "address": ["A", "B"], "note": ["p", "q"]})
    )
    batch = spark.createDataFrame(
        pa.table({"name": ["b", "b", "d", "c"], "address": ["B1", "B2", "D", "C"], "seq": [1, 2, 3, 4]})
    )
    table = table.unionByName(spark.createDataFrame(pa.table({"id": [5], "name": ["n"], "address": ["N"], "note": ["s"]})))
    batch = batch.unionByName(spark.createDataFrame([("n", None, 5)], "name string, address string, seq long"))
    for keep, address in ((False, None), (True, "N")):
        rows = {r.id: r for r in upsert.upsert_by(table, batch, "name", "id", "seq", keep).collect()}
        assert (rows[5].address, rows[5].note) == (address, "s")
    table, batch = table.filter("id < 5"), batch.filter("name <> 'n'")
    got = sorted(upsert.upsert_by(table, batch, "name", "id", "seq").collect())
    assert got == [(1, "a", "A", "p"), (2, "b", "B2", "q"), (3, "d", "D", None), (4, "c", "C", None)]


def test_open_orders_leave_out_unknown_status(spark):
    orders = spark.createDataFrame(
        pa.table(
            {
                "order_id": [1, 2, 3, 4],
                "customer_id": [7, 7, 7, 8],
                "order_date": [20260101] * 4,
                "status": ["COMPLETED", "PENDING", "Open", None],
            }
        )
    )
    assert [tuple(r) for r in upsert.open_orders(orders).collect()] == [(7, 20260101, 2)]


def test_id_pages_in_order_are_all_ids(spark):
    ids = random.Random(4).sample(range(10_000), 95)
    pages = upsert.id_pages(spark.createDataFrame(pa.table({"id": ids})), "id", 10)
    rows = pages.orderBy("page").collect()
    assert [len(r.ids) for r in rows] == [10] * 9 + [5]
    assert [i for r in rows for i in r.ids] == sorted(ids)

"""Streams lead to the same tables as the batch build, however the log is cut."""

import os
import random
import time
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

import world
from changeloom.operators.calendar import build_dim_dates
from changeloom.plans import reports, star
from changeloom.sources import changelog
from changeloom.streaming import bounded, counts, ingest, stateful, tables
from changeloom.streaming.ingest import StarStream
from world import customer, item, order, product, raw


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def put_log(spark, folder, messages):
    world.log_frame(spark, messages).coalesce(1).write.mode("append").parquet(f"{folder}/log")


def same_reports(spark, root, status="pending", dates=(None, None)):
    """The reports that follow the stream are those over its fact table."""
    fact = tables.read_facts(spark, root)
    fact = spark.createDataFrame(fact.toArrow(), fact.schema)
    return all(
        getattr(counts, name)(spark, root, status, date_from=dates[0], date_to=dates[1], **options).collect()
        == getattr(reports, name)(fact, status, date_from=dates[0], date_to=dates[1], **options).collect()
        for name, options in (
            ("orders_by_delivery_date_and_status", {}),
            ("top_delivery_dates", {"limit": 4}),
            ("pending_quantity_by_product", {}),
            ("top_customers_by_orders", {"limit": 4}),
        )
    )


def run(spark, stream, folder):
    log = changelog.stream_log(spark, f"{folder}/log", files_per_batch=1)
    stream.start(log).awaitTermination()


def expected(spark, messages, **options):
    changes = star.from_log(world.log_frame(spark, messages))
    return world.fact_dict(star.build_facts(changes, build_dim_dates(spark), **options).fact)


def test_random_log_in_random_pieces_with_restart_and_compaction(spark, folder):
    rng = random.Random(11)
    messages = [m for n in range(12) for m in world.random_world(rng, 100 * (n + 1), 40)]
    customers, products = world.source_frames(spark, *world.sources(messages, every=3))
    whole = list(messages)
    rng.shuffle(messages)
    cuts = [0, 60, 200, len(messages)]
    stream = StarStream(f"{folder}/star", build_dim_dates(spark), customers, products, buckets=3, parts=2)
    for low, high in zip(cuts, cuts[1:]):  # each piece is a stream run of its own
        put_log(spark, folder, messages[low:high])
        run(spark, stream, folder)
    put_log(spark, folder, messages[:150])  # and some of it comes again
    run(spark, stream, folder)
    commit = tables.last_commit(spark, stream.root)
    assert (commit.batch, commit.buckets, commit.high) == (3, 3, max(m[3] for m in whole))
    # Buckets were merged, and what was merged is gone.
    assert {one.base for one in tables.committed(spark, stream.root).look("orders").values()} <= {2, 3}
    assert same_reports(spark, stream.root) and same_reports(spark, stream.root, "open", (20260105, 20260107))
    want = expected(spark, whole, customer_source=customers, product_source=products)
    assert len(want) > 30
    assert world.fact_dict(tables.read_facts(spark, stream.root)) == want
    kept = tables.read_changes(spark, stream.root)
    batch = star.from_log(world.log_frame(spark, whole))
    assert sorted(star.dim_customers(kept.customers).collect()) == sorted(
        star.dim_customers(batch.customers).collect()
    )
    lines = star.build_lines(batch)
    got = tables.read_lines(spark, stream.root)
    assert sorted(map(str, got.select(lines.columns).collect())) == sorted(map(str, lines.collect()))


def test_late_members_moved_items_and_rejects(spark, folder):
    pieces = [
        [order(10, 1), item(20, 5), item(21, 6, product_id=2), raw(22, "orders", "broken")],
        [customer(1, 1), product(2, 1)],  # earlier in the order of events, later in arrival
        [product(15, 1, price="9.00")],  # known by the time of the first merge
        [item(5, 5, order_id=3)],  # the first event of item 5 after all: its order is another
    ]
    stream = StarStream(f"{folder}/star", build_dim_dates(spark), buckets=2)
    arrived, sizes, waiting = [], [], []
    for piece in pieces:
        put_log(spark, folder, piece)
        run(spark, stream, folder)
        arrived += piece
        got = world.fact_dict(tables.read_facts(spark, stream.root))
        assert got == expected(spark, arrived)
        assert same_reports(spark, stream.root)
        sizes.append(len(got))
        waiting.append(tables.committed(spark, stream.root).merged("waiting").count())
    assert sizes == [0, 1, 1, 0]
    # Both items miss both members; then customer 1 and product 1 are known, product 2 never is.
    assert waiting == [4, 1, 1, 1]
    (bad,) = tables.read_quarantine(spark, stream.root).collect()
    assert (bad.table, bad.seq, bad.reasons) == ("orders", 22, ["malformed"])


def ordered_world(size):
    """Dimensions, then orders of one item each, in the order of events."""
    messages = [customer(1, 1), product(2, 1)]
    for n in range(size):
        messages += [order(10 + 2 * n, n), item(11 + 2 * n, n, order_id=n)]
    return messages


def test_work_of_a_micro_batch_is_that_of_its_keys(spark, folder):
    def opened(store, table):
        return {name for name in store.read_folders if f"/{table}/" in name}

    seen = []
    for size in (20, 200):
        stream = StarStream(f"{folder}/{size}", build_dim_dates(spark), buckets=64)
        stream.apply(world.log_frame(spark, ordered_world(size)), 0)
        last = 20 + 2 * size
        later = [order(last, 3, status="DONE"), customer(last + 1, 1, address="Away"), item(last + 2, 9999, order_id=7)]
        store = stream.apply(world.log_frame(spark, later), 1)
        # Two orders, two items, one customer and product: so many buckets of each table, however many lines there are.
        for table in ("orders", "order_items", "lines", "order_counts"):
            assert 1 <= len({name.split("/bucket=")[1].split("/")[0] for name in opened(store, table)}) <= 3
        # No line has a stake in a customer's version that comes after all events so far.
        assert not opened(store, "settled")
        fact = {r.order_item_id: r for r in tables.read_facts(spark, stream.root).collect()}
        assert (fact[3].status, fact[3].customer, fact[7].customer, fact[9999].customer) == ("DONE", 1, 1, last + 1)
        assert same_reports(spark, stream.root)
        seen.append(len(store.read_folders))
    assert seen[1] <= seen[0] + 4


def test_merged_buckets_leave_one_generation(spark, folder):
    stream = StarStream(f"{folder}/star", build_dim_dates(spark), buckets=2, parts=2)
    arrived = [customer(1, 1), product(2, 1)]
    stream.apply(world.log_frame(spark, arrived), 0)
    for n in range(1, 5):
        new = [order(10 * n, 1, status=f"S{n}"), item(10 * n + 1, 5, quantity=n), item(10 * n + 2, 50 + n, order_id=1)]
        arrived += new
        stream.apply(world.log_frame(spark, new), n)
        assert world.fact_dict(tables.read_facts(spark, stream.root)) == expected(spark, arrived)
    store = tables.committed(spark, stream.root)
    for table in ("orders", "lines", "totals"):
        for one in store.look(table).values():
            assert len(one.batches) <= 3 and len(one.dead) <= 1


def test_events_without_seq_get_numbers_of_their_own(spark, folder):
    """One log position, two partitions with the same offsets, more rows than the offset's bits can tell apart."""
    size = 50_000
    log = spark.range(2 * size).select(
        F.lit("s.customers").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.expr("id div 2").alias("offset"),
        F.lit(None).cast("long").alias("seq"),
        F.format_string('{"after": {"customer_id": %d, "customer_name": "n"}, "source": {"lsn": 7, "ts_ms": 5}}', "id").alias("value"),
    )
    stream = StarStream(f"{folder}/star", build_dim_dates(spark), buckets=2)
    stream.apply(log.filter("id < 30"), 0)
    stream.apply(log.filter("id >= 30"), 1)
    stream.apply(log.filter("id >= 30"), 1)  # done already
    got = tables.read_changes(spark, stream.root).customers.agg(F.count("*"), F.countDistinct("seq"), F.min("seq"), F.max("seq")).first()
    assert tuple(got) == (2 * size, 2 * size, 1, 2 * size)
    assert tables.last_commit(spark, stream.root).high == 2 * size


def test_a_micro_batch_that_failed_is_done_again(spark, folder, monkeypatch):
    pieces = [[order(10, 1), item(20, 5)], [customer(1, 1), product(2, 1)], [order(30, 1, status="DONE"), item(31, 6)]]
    stream, arrived = StarStream(f"{folder}/star", build_dim_dates(spark), buckets=2, parts=1), []
    for number, piece in enumerate(pieces):
        log = world.log_frame(spark, piece)
        with monkeypatch.context() as patch:
            patch.setattr(tables.Store, "done", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                stream.apply(log, number)
        if arrived:  # what is committed is still there
            assert world.fact_dict(tables.read_facts(spark, stream.root)) == expected(spark, arrived)
        stream.apply(log, number)
        arrived += piece
        assert world.fact_dict(tables.read_facts(spark, stream.root)) == expected(spark, arrived)
        assert same_reports(spark, stream.root)


def test_a_micro_batch_done_again_changes_nothing(spark, folder):
    stream = StarStream(f"{folder}/star", build_dim_dates(spark))
    log = world.log_frame(spark, [customer(1, 1), product(2, 1), order(10, 1), item(11, 5)])
    stream.apply(log, 0)
    before = tables.read_facts(spark, stream.root).collect()
    stream.apply(log, 0)
    assert tables.read_facts(spark, stream.root).collect() == before
    assert before[0].total_amount == Decimal("7.5")


def test_nothing_committed(spark, folder):
    assert tables.last_commit(spark, folder) is None
    with pytest.raises(ValueError):
        tables.read_facts(spark, folder)


def collected(spark, stream, folder, mode, batches=None):
    """All rows of a stream; one whose clock never lets it end is stopped after so many batches with rows."""

    def append(rows, batch):
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    query = stream.writeStream.foreachBatch(append).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
    if batches is None:
        query.trigger(availableNow=True).start().awaitTermination()
    else:
        running = query.trigger(processingTime="1 second").start()
        for _ in range(120):
            if sum(p["numInputRows"] > 0 for p in running.recentProgress) >= batches:
                break
            time.sleep(1)
        running.stop()
    return spark.read.parquet(f"{folder}/rows")


def line_log():
    rng = random.Random(13)
    messages = [m for n in range(3) for m in world.random_world(rng, 100 * (n + 1), 40)]
    return [m for m in messages if "order" in m[0]]


@pytest.mark.parametrize("keep_ms, page", [(None, 2), (3_600_000, 1024)])
def test_lines_from_keyed_state(spark, folder, monkeypatch, keep_ms, page):
    monkeypatch.setattr(stateful, "PAGE", page)
    messages = line_log()
    random.Random(1).shuffle(messages)
    put_log(spark, folder, messages[:40])
    put_log(spark, folder, messages[40:])
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(
        name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        orders, items = [
            changelog.events(changelog.stream_log(spark, f"{folder}/log", files_per_batch=1), t)
            for t in ("orders", "order_items")
        ]
        lines = stateful.changed_lines(orders, items, salts=2, keep_ms=keep_ms)
        rows = collected(spark, lines, folder, "update", batches=None if keep_ms is None else 2)
    finally:
        spark.conf.set(name, before)
    lines = star.build_lines(star.from_log(world.log_frame(spark, messages)))
    got = tables.newest_lines(rows).select(lines.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, lines.collect()))


def test_first_and_last_picks_of_whole_columns():
    rng = random.Random(3)
    rows = [(rng.randint(-5, 5), rng.randint(0, 4), n, rng.randint(0, 4), -n) for n in range(200)]
    columns = dict(zip(("key", "first_seq", "x", "last_seq", "y"), map(np.array, zip(*rows))))
    got = stateful.merged(columns, "key", ((("first_seq", "x"), True), (("last_seq", "y"), False)))
    for key, first_seq, x, last_seq, y in zip(*(got[c].tolist() for c in columns)):
        own = [r for r in rows if r[0] == key]
        assert (first_seq, x) == min(((r[1], r[2]) for r in own), key=lambda r: r[0])  # the first of equal ones
        assert (last_seq, y) == max(((r[3], r[4]) for r in own), key=lambda r: r[0])
    assert got["key"].tolist() == sorted({r[0] for r in rows})


def test_lines_from_a_bounded_join(spark, folder):
    messages = sorted(line_log(), key=lambda m: m[3])
    for low in range(0, len(messages), 40):
        put_log(spark, folder, messages[low : low + 40])
    orders, items = [
        changelog.events(changelog.stream_log(spark, f"{folder}/log", files_per_batch=1), t)
        for t in ("orders", "order_items")
    ]
    rows = collected(spark, bounded.joined_within(orders, items, "30 days"), folder, "append")
    got = bounded.merge_pairs(rows)
    lines = star.build_lines(star.from_log(world.log_frame(spark, messages))).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, lines.collect()))


def test_a_replay_is_left_out_and_micro_batches_leave_no_tables_of_their_own(spark, folder, monkeypatch):
    messages = [customer(1, 1), product(2, 1), order(10, 1), item(11, 5)]
    stream = StarStream(f"{folder}/star", build_dim_dates(spark), buckets=2)
    touched = []
    recompute = ingest._Step._recompute
    monkeypatch.setattr(ingest._Step, "_recompute", lambda step, rows: touched.append(rows.count()) or recompute(step, rows))
    stream.apply(world.log_frame(spark, messages), 0)
    stream.apply(world.log_frame(spark, messages), 1)
    assert touched == [1]  # before, a replay computed its lines again
    stream.apply(world.log_frame(spark, [*messages, item(12, 5, quantity=9), item(13, 6)]), 2)
    assert touched == [1, 2]
    assert world.fact_dict(tables.read_facts(spark, stream.root)) == expected(spark, [*messages, item(12, 5, quantity=9), item(13, 6)])
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    stream.apply(world.log_frame(spark, [order(20, 1, status="DONE")]), 3)
    assert set(os.listdir(shared)) == before and os.listdir(f"{folder}/star/_work") == []
    names = tables.committed(spark, stream.root).read("lines").inputFiles()
    assert names and all(name.endswith(".zstd.parquet") for name in names)


def test_neighbouring_orders_share_a_block_of_state(spark):
    rng = random.Random(5)
    columns = dict(zip(("order_id", "order_item_id", "first_seq", "x"), map(np.array, zip(*[(rng.randint(0, 3), rng.randint(0, 3), n, -n) for n in range(60)]))))
    got = stateful.merged(columns, ("order_id", "order_item_id"), ((("first_seq", "x"), True),))
    pairs = sorted(set(zip(columns["order_id"].tolist(), columns["order_item_id"].tolist())))
    assert list(zip(got["order_id"].tolist(), got["order_item_id"].tolist())) == pairs
    orders = {c: np.zeros(2, object if c == "status" else np.int64) for c in stateful._ORDER_COLUMNS} | {"order_id": np.array([1, 3])}
    items = {c: np.zeros(3, np.int64) for c in stateful._ITEM_COLUMNS} | {"order_id": np.array([1, 2, 3]), "order_item_id": np.array([10, 20, 30])}
    lines = list(stateful.OrderLines._lines(orders, items, np.array([True, True, False])))
    assert [line["order_item_id"].tolist() for line in lines] == [[10]]

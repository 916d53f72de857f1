"""The log in files and micro-batches, for the queries that read it as a stream."""

import glob
import random
import re

import numpy as np

import world
from changeloom.operators.calendar import build_dim_dates
from changeloom.plans import retail, star, stream_queries
from changeloom.sources import changelog
from changeloom.streaming import stateful, tables as kept
from changeloom.streaming.ingest import StarStream
from test_slices import tables  # noqa: F401
from world import customer, item, order, product


def test_a_long_log_is_few_micro_batches(spark, tables, monkeypatch):  # noqa: F811
    """Each rewrites the state that it touches; before, their number grew with the log."""
    monkeypatch.setattr(stream_queries, "FILE_EVENTS", 20)
    assert stream_queries._files(spark, tables) > 8
    got = stream_queries.stream_changed_lines(spark, tables)
    assert {name.split("/batch=")[1].split("/")[0] for name in got.inputFiles()} == {"0", "1"}
    lines = star.build_lines(retail.changes(spark, tables))
    assert sorted(map(str, got.select(lines.columns).collect())) == sorted(map(str, lines.collect()))


def test_packed_rows_of_state_come_back():
    rng = random.Random(2)
    columns = stateful._KEPT + stateful._ORDER_COLUMNS
    for size in (0, 1, 100):
        rows = {c: np.array([rng.randint(-(2**63), 2**63 - 1) for _ in range(size)], np.int64) for c in columns}
        rows["status"] = np.array([rng.choice(["PENDING", "Öffen", "", None]) for _ in range(size)], object)
        values = stateful.packed(rows, columns)
        assert isinstance(values[1], bytes) and len(values[2]) <= 3
        got = stateful.unpacked(values, columns)
        assert list(got) == columns and all(got[c].tolist() == rows[c].tolist() for c in columns)


def test_a_bounded_join_keeps_its_state_on_disk(spark, tables):  # noqa: F811
    """Before, heaps held a slice's rows, twice."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{shared}/pairs-*"))
    settings = {name: spark.conf.get(name, None) for name in stream_queries._ON_DISK}
    assert stream_queries.stream_joined_within(spark, tables).count() > 0
    assert {name: spark.conf.get(name, None) for name in stream_queries._ON_DISK} == settings
    (root,) = set(glob.glob(f"{shared}/pairs-*")) - before
    files = glob.glob(f"{root}/_checkpoint/state/**", recursive=True)
    assert any(name.endswith((".zip", ".changelog")) for name in files) and not any(name.endswith(".delta") for name in files)


def test_decoding_is_compiled(spark, tmp_path):
    """The JVM compiles no method of more than 8,000 bytes."""
    world.log_frame(spark, [order(1, 10), product(2, 30)]).write.parquet(f"{tmp_path}/log")
    compiling = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {name: spark.conf.get(name) for name in compiling}
    for name, value in compiling.items():
        spark.conf.set(name, value)
    try:
        plan = changelog.decoded(changelog.read_log(spark, f"{tmp_path}/log"))._jdf.queryExecution()
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", spark._jvm.PythonSQLUtils.explainString(plan, "codegen"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sizes and max(map(int, sizes)) <= 8000


def test_events_are_kept_once_and_in_one_table(spark, tmp_path):
    stream = StarStream(f"{tmp_path}/star", build_dim_dates(spark), buckets=2, parts=1)
    first = [customer(1, 1), product(2, 1), order(10, 1), item(11, 5)]
    stream.apply(world.log_frame(spark, first), 0)
    stream.apply(world.log_frame(spark, [*first, order(20, 1, status="DONE"), item(21, 5, quantity=9)]), 1)
    stream.apply(world.log_frame(spark, [order(30, 2), item(31, 6, order_id=2)]), 2)
    store = kept.committed(spark, stream.root)
    assert sorted(r.first_seq for r in store.read("orders").collect()) == [10, 20, 30]
    assert sorted(r.first_seq for r in store.read("order_items").collect()) == [11, 21, 31]
    (merged,) = store.merged("orders").filter("order_id = 1").collect()
    assert (merged.first_seq, merged.last_seq, merged.status) == (10, 20, "DONE")
    assert not glob.glob(f"{stream.root}/*_moves")

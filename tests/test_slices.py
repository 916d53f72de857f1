"""The log in slices of event time, for the stream that drops its state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from changeloom.plans import retail, stream_queries


@pytest.fixture
def tables(spark, tmp_path):
    """Forty orders, two a day, with three lines each, shipped up to eighty days later."""
    day = lambda n: dt.datetime(1996, 1, 1) + dt.timedelta(days=n)
    orders = [(k, k % 5, "OFP"[k % 3], day(k // 2), ["1-URGENT", "2-HIGH", "5-LOW"][k % 3]) for k in range(40)]
    lines = [(k, n, (k + n) % 7, float(n + 1), 10.0, "NR"[n % 2], day(k // 2 + 40 * n)) for k in range(40) for n in range(3)]
    for name, rows, columns in (
        ("customer", [(k, f"C{k}", 1.0, "BUILDING") for k in range(5)], "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"),
        ("part", [(k, f"P{k}", "B", "SMALL", 3.0) for k in range(7)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
    ):
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_slices_are_the_whole_log_in_order_and_shuffle_no_message(spark, tables):
    slices = list(stream_queries._log_by_time(spark, tables))
    messages = [sorted((r.seq, r.topic, r.value) for r in rows.collect()) for rows in slices]
    assert len(messages) >= stream_queries.LEAST_SLICES and all(messages)
    assert [m for part in messages for m in part] == sorted((r.seq, r.topic, r.value) for r in retail.log(spark, tables).collect())
    assert all(one[-1][0] < two[0][0] for one, two in zip(messages, messages[1:]))
    for rows in slices:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "RoundRobinPartitioning" not in plan
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert scans and all("/log-" not in line for line in scans)


def test_lines_of_all_slices_are_joined(spark, tables):
    got = stream_queries.stream_joined_within(spark, tables)
    orders = retail.order_events(spark, tables).select("order_id", F.col("ts").alias("at"))
    near = F.abs(F.unix_date(F.col("ts").cast("date")) - F.unix_date(F.col("at").cast("date"))) <= 60
    pairs = retail.item_events(spark, tables).join(orders, "order_id").filter(near)
    assert sorted(r.order_item_id for r in got.collect()) == sorted(r[0] for r in pairs.select("order_item_id").distinct().collect())
    assert 80 <= got.count() < 120

"""Registered streaming queries: the retail change log, written out and read as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import changelog
from ..sources.workspace import COMPRESSION, workspace
from ..streaming import bounded, counts, stateful, tables
from ..streaming.ingest import StarStream
from . import retail, star
from .queries import query, shown_fact

#: Events in a file of the log, and rows of the largest kept table in a bucket, at most about.
FILE_EVENTS = 1_000_000
BUCKET_ROWS = 1_000_000
#: Events in a slice of the log by time, at most about, and its least number of slices.
SLICE_EVENTS = 100_000_000
LEAST_SLICES = 4


def _events(spark: SparkSession, sf_dir: str) -> int:
    """Order and item events, of which there are most; from the tables' footers."""
    return 2 * retail.table(spark, sf_dir, "orders").count() + retail.table(spark, sf_dir, "lineitem").count()


def _files(spark: SparkSession, sf_dir: str) -> int:
    """Files of the log; never fewer than four."""
    return max(4, -(-_events(spark, sf_dir) // FILE_EVENTS))


def _half(spark: SparkSession, sf_dir: str) -> int:
    """Files in a micro-batch: two of them take the log, whatever its size, as one costs what the state that it touches does."""
    return -(-_files(spark, sf_dir) // 2)


def _written_log(spark: SparkSession, sf_dir: str, times: int = 1) -> str:
    """The log in files that each hold events of all times and tables, ``times`` over."""
    path = workspace(spark, "log")
    log = retail.log(spark, sf_dir).repartition(_files(spark, sf_dir), "seq")
    for _ in range(times):
        log.write.mode("append").option("compression", COMPRESSION).parquet(path)
    return path


_roots: dict[tuple[str, str], str] = {}


def _star_root(spark: SparkSession, sf_dir: str) -> str:
    """The tables of one run over the log, which several queries read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        _roots[key] = _star_stream(spark, sf_dir)
    return _roots[key]


def _star_stream(spark: SparkSession, sf_dir: str, times: int = 1, **options) -> str:
    """Run the log through the stream in two micro-batches a pass; the root of the written tables."""
    root = workspace(spark, "star")
    log = changelog.stream_log(spark, _written_log(spark, sf_dir, times), files_per_batch=_half(spark, sf_dir))
    stream = StarStream(
        root,
        retail.dim_dates(spark),
        retail.customer_source(spark, sf_dir),
        retail.product_source(spark, sf_dir),
        buckets=max(2, -(-_events(spark, sf_dir) // BUCKET_ROWS)),
        **options,
    )
    stream.start(log).awaitTermination()
    return root


@query
def stream_fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_fact(tables.read_facts(spark, _star_root(spark, sf_dir)))


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log comes in twice, and the buckets are merged on the way."""
    root = _star_stream(spark, sf_dir, times=2, parts=1)
    return shown_fact(tables.read_facts(spark, root))


@query
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(tables.read_changes(spark, _star_root(spark, sf_dir)).products)


@query
def stream_orders_by_delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as the stream keeps it, without the fact table."""
    return counts.orders_by_delivery_date_and_status(spark, _star_root(spark, sf_dir))


@query
def stream_pending_quantity_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.pending_quantity_by_product(spark, _star_root(spark, sf_dir))


@query
def stream_top_customers_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_customers_by_orders(spark, _star_root(spark, sf_dir), limit=20)


def _event_streams(spark: SparkSession, path: str, files: int | None = None) -> tuple[DataFrame, DataFrame]:
    orders, items = [
        changelog.events(changelog.stream_log(spark, path, files_per_batch=files), table)
        for table in ("orders", "order_items")
    ]
    return orders, items


def _log_by_time(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The log in slices of event time, the earliest first.

    Each slice is filtered out of the tables before its messages are made, so no message is shuffled or written to get the order.
    """
    slices = max(LEAST_SLICES, -(-_events(spark, sf_dir) // SLICE_EVENTS))
    log = retail.log(spark, sf_dir)
    cuts = log.agg(F.percentile_approx("seq", [n / slices for n in range(1, slices)], 100 * slices)).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None]):
        rows = log if low is None else log.filter(F.col("seq") > low)
        yield rows if high is None else rows.filter(F.col("seq") <= high)


def _appended(stream: DataFrame, root: str, mode: str) -> DataFrame:
    """Run a stream to the end of its input, from where the last run into ``root`` ended; each micro-batch into a folder of its own."""

    def append(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root}/rows/batch={batch}")

    running = (
        stream.writeStream.foreachBatch(append)
        .outputMode(mode)
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return stream.sparkSession.read.parquet(f"{root}/rows")


#: State on the executors' disks instead of their heaps, with a bound on what it holds in memory.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # One store for a join's two sides in a partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in _ON_DISK}
    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@query
def stream_changed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _state_on_disk(spark):
        orders, items = _event_streams(spark, _written_log(spark, sf_dir), files=_half(spark, sf_dir))
        rows = _appended(stateful.changed_lines(orders, items, salts=2), workspace(spark, "changed"), "update")
    return tables.newest_lines(rows).drop("batch")


@query
def stream_joined_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice by slice, a run of the stream for each: behind the watermark state is dropped, and no event is late.

    A slice's rows are all state until its run ends, so they are on disk: heaps would have to hold a slice.
    """
    path, root = workspace(spark, "log"), workspace(spark, "pairs")
    with _state_on_disk(spark):
        for rows in _log_by_time(spark, sf_dir):
            rows.write.mode("append").option("compression", COMPRESSION).parquet(path)
            orders, items = _event_streams(spark, path)
            pairs = _appended(bounded.joined_within(orders, items, "60 days"), root, "append")
    return bounded.merge_pairs(pairs)

"""Staging state: one row per order and per order item, reduced from change events.

The columns that the first event sets (``min_by`` the event order) and those that the last one
sets (``max_by``) are kept with the order they were taken at. So a state row merges with any
other state row of its key: in any order, any number of times, in map-side partial aggregates,
across micro-batches and on replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .skew import ROWS_PER_TASK, most_of_a_hash

#: With more events per key than this, partial aggregates are the smaller ones.
EVENTS_PER_KEY = 2

ORDER_STATE = (
    "order_id", "first_seq", "customer_id", "order_date", "created_at",
    "last_seq", "status", "delivery_seq", "delivery_date", "updated_at",
)
ITEM_STATE = (
    "order_item_id", "first_seq", "order_id", "product_id", "created_at",
    "last_seq", "quantity", "updated_at",
)


def order_state(events: DataFrame, keep_delivery_on_null: bool = False) -> DataFrame:
    """Each order event as a state row of its own.

    The delivery date is last-wins, null included; ``keep_delivery_on_null`` lets a null leave
    the date before it in place.
    """
    seq = F.col("seq")
    delivery_seq = F.when(F.col("delivery_date").isNotNull(), seq) if keep_delivery_on_null else seq
    return events.select(
        "order_id",
        seq.alias("first_seq"),
        "customer_id",
        "order_date",
        F.col("ts").alias("created_at"),
        seq.alias("last_seq"),
        "status",
        delivery_seq.alias("delivery_seq"),
        "delivery_date",
        F.col("ts").alias("updated_at"),
    )


def item_state(events: DataFrame) -> DataFrame:
    """Each item event as a state row of its own."""
    return events.select(
        "order_item_id",
        F.col("seq").alias("first_seq"),
        "order_id",
        "product_id",
        F.col("ts").alias("created_at"),
        F.col("seq").alias("last_seq"),
        "quantity",
        F.col("ts").alias("updated_at"),
    )


def _first(column: str) -> Column:
    return F.min_by(column, "first_seq").alias(column)


def _last(column: str, order: str = "last_seq") -> Column:
    return F.max_by(column, order).alias(column)


def merge_orders(rows: DataFrame) -> DataFrame:
    """Reduce order state rows to one per order."""
    return rows.groupBy("order_id").agg(
        F.min("first_seq").alias("first_seq"),
        _first("customer_id"),
        _first("order_date"),
        _first("created_at"),
        F.max("last_seq").alias("last_seq"),
        _last("status"),
        F.max("delivery_seq").alias("delivery_seq"),
        _last("delivery_date", "delivery_seq"),
        _last("updated_at"),
    )


def merge_items(rows: DataFrame) -> DataFrame:
    """Reduce item state rows to one per order item; all buffers are fixed-width."""
    return rows.groupBy("order_item_id").agg(
        F.min("first_seq").alias("first_seq"),
        _first("order_id"),
        _first("product_id"),
        _first("created_at"),
        F.max("last_seq").alias("last_seq"),
        _last("quantity"),
        _last("updated_at"),
    )


def dealt(events: DataFrame, key: str) -> DataFrame:
    """Events by key, before they become state rows, where that moves fewer bytes than partial aggregates do.

    A state row in a partial aggregate is twice as wide as its event, so it pays only where keys have several events, and is
    needed only where one key has more than a task may hold.
    """
    several = events.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(key).alias("keys")).first()
    if several["rows"] > EVENTS_PER_KEY * several["keys"] or most_of_a_hash(events, key) > ROWS_PER_TASK:
        return events
    return events.repartition(key)


def staging_orders(events: DataFrame, keep_delivery_on_null: bool = False) -> DataFrame:
    return merge_orders(order_state(events, keep_delivery_on_null))


def staging_items(events: DataFrame) -> DataFrame:
    return merge_items(item_state(events))

"""Keyed upserts and picks over source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.workspace import written
from .surrogate import dense_number


def insert_missing(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Existing rows as they are, plus new rows whose key is not there yet."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti"))


def upsert_by(
    table: DataFrame, batch: DataFrame, key: str, id_column: str, order: str, keep_on_null: bool = False
) -> DataFrame:
    """Upsert a batch by a natural key that is unique in ``table``.

    Of several batch rows of one key the last by ``order`` counts. A key that is there keeps its
    id and takes the batch's columns, null included unless ``keep_on_null``; a new key gets the
    next free id, by ``order``. The merged rows are stored, as they are read several times.
    """
    columns = [c for c in batch.columns if c not in (key, order)]
    last = batch.groupBy(key).agg(F.max_by(F.struct(*columns, order), order).alias("_b"))
    kept = [c for c in table.columns if c not in (key, id_column)]
    merged = table.withColumn("_old", F.lit(True)).join(last, key, "full_outer").select(
        id_column,
        key,
        *[
            F.when(F.col("_b").isNotNull() & (F.lit(not keep_on_null) | F.col("_b")[c].isNotNull()), F.col("_b")[c])
            .otherwise(F.col(c))
            .alias(c)
            if c in columns
            else F.col(c)
            for c in kept
        ],
        F.col("_old").isNotNull().alias("_old"),
        F.col("_b")[order].alias("_order"),
    )
    merged = written(merged, "merged")
    top = table.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).first()["top"]
    old = merged.filter("_old").drop("_old", "_order")
    new = dense_number(merged.filter("NOT _old").drop(id_column), "_order", id_column, top + 1)
    return old.unionByName(new.drop("_old", "_order"))


def open_orders(orders: DataFrame, done: str = "COMPLETED") -> DataFrame:
    """One order per customer and day that is not done; a null status does not count as open."""
    return (
        orders.filter(F.col("status") != done)
        .groupBy("customer_id", "order_date")
        .agg(F.min("order_id").alias("order_id"))
    )


def id_pages(df: DataFrame, id_column: str, page_size: int = 10_000) -> DataFrame:
    """All ids in ascending order, as arrays of at most ``page_size``: ``page, ids``.

    The pages in order are the array of all ids; no single task or row has to hold all of it.
    """
    numbered = dense_number(df.select(id_column), id_column, "_n", start=0)
    return (
        numbered.groupBy(F.floor(F.col("_n") / page_size).alias("page"))
        .agg(F.sort_array(F.collect_list(id_column)).alias("ids"))
    )

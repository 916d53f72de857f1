"""Source tables, for members and prices that have no change event yet.

Lookups against them are joins over the whole batch, never a query per row. A snapshot whose position in the log is known
can also be taken as one more version of each of its members (``as_changes``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.decimals import MONEY

COLUMNS = {
    "customers": ("customer_id", "customer_name", "customer_address"),
    "products": ("product_id", "product_name", "barcode", "unity_price"),
}


def _shaped(rows: DataFrame, table: str) -> DataFrame:
    columns = [
        F.col(c).try_cast(MONEY).alias(c) if c == "unity_price" else F.col(c)
        for c in COLUMNS[table]
    ]
    return rows.select(*columns)


def from_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return _shaped(spark.read.parquet(path), table)


def as_changes(snapshot: DataFrame, position: int, time: dt.datetime) -> DataFrame:
    """A snapshot's rows as change events at the log position, and the time, that it was taken at.

    Rows that the log has as well open a version at that position; it has the same attributes as the one before.
    """
    return snapshot.select(
        F.lit(position).cast("long").alias("seq"), F.lit(time).cast("timestamp_ntz").alias("ts"), *snapshot.columns
    )


def from_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partitions: int,
    lower: int,
    upper: int,
    schema: str = "operations",
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Source table read by ``partitions`` ranges of its key; needs the driver's jar."""
    key = COLUMNS[table][0]
    rows = spark.read.jdbc(
        url,
        f"{schema}.{table}",
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )
    return _shaped(rows, table)

"""Change events over the retail test tables (customer, part, orders, lineitem).

Event order: ``day * DAY`` plus a place within the day (the key of the row), so events of all
tables compare, and no two versions of one dimension share a place.

* orders: created PENDING on the order date; orders of status O and F change five days later.
  That second event names another customer and order date (to be ignored), has no delivery date
  for priority 4-NOT SPECIFIED and a later one for 2-HIGH. 5-LOW orders never have one.
* order items: every lineitem row is a change of item (order, line number). On one day, the row
  with the greater part key and then quantity is the later one; beyond that rows are alike.
* customers: first loaded at day 0, but for those with a negative balance; an urgent order moves
  the customer.
* products: first loaded at day 0, but for type ECONOMY; a returned line sets a new price.
* source tables: customers of all segments but MACHINERY, parts of all types but PROMO.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import date_key
from ..functions.decimals import MONEY
from ..operators.calendar import build_dim_dates
from .star import ChangeTables

DAY = 10**14
LOADED = dt.datetime(1995, 1, 1)
CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
TOPIC_PREFIX = "shop.operations"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seq(time: Column, place: Column) -> Column:
    return F.unix_date(time.cast("date")).cast("long") * F.lit(DAY) + place


def _days_later(time: str, days: int) -> Column:
    return F.date_add(F.col(time).cast("date"), days)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with plain dates."""
    orders = table(spark, sf_dir, "orders")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    agreed = F.when(priority != "5-LOW", _days_later("o_orderdate", 10))
    created = orders.select(
        _seq(F.col("o_orderdate"), F.col("o_orderkey")).alias("seq"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        agreed.alias("delivery_date"),
        F.lit("PENDING").alias("status"),
    )
    moved = F.when(priority == "2-HIGH", _days_later("o_orderdate", 12)).when(
        priority != "4-NOT SPECIFIED", agreed
    )
    opened = F.when(priority == "1-URGENT", F.lit("OPEN")).otherwise(F.lit("Open"))
    later = F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS")
    changed = orders.filter(status.isin("O", "F")).select(
        _seq(later, F.col("o_orderkey")).alias("seq"),
        later.alias("ts"),
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        later.cast("date").alias("order_date"),
        moved.alias("delivery_date"),
        F.when(status == "F", F.lit("COMPLETED")).otherwise(opened).alias("status"),
    )
    return created.unionByName(changed)


def item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    place = F.col("l_partkey") * 100 + quantity
    return table(spark, sf_dir, "lineitem").select(
        _seq(F.col("l_shipdate"), place).alias("seq"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
    )


def _customer_name(key: str) -> Column:
    return F.concat(F.lit("Customer "), F.col(key).cast("string"))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(
            F.col("c_custkey").alias("seq"),
            F.lit(LOADED).cast("timestamp_ntz").alias("ts"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_address"),
        )
    )
    moved = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(
            _seq(F.col("o_orderdate"), F.col("o_custkey")).alias("seq"),
            F.col("o_orderdate").alias("ts"),
            F.col("o_custkey").alias("customer_id"),
            _customer_name("o_custkey").alias("customer_name"),
            F.concat(F.lit("Street "), date_key(F.col("o_orderdate"))).alias("customer_address"),
        )
        .distinct()
    )
    return loaded.unionByName(moved)


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = (
        table(spark, sf_dir, "part")
        .filter(F.col("p_type") != "ECONOMY")
        .select(
            F.col("p_partkey").alias("seq"),
            F.lit(LOADED).cast("timestamp_ntz").alias("ts"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("barcode"),
            F.col("p_retailprice").cast(MONEY).alias("unity_price"),
        )
    )
    priced = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("ts"))
        .agg(F.max(F.col("l_extendedprice").cast("decimal(13,2)")).alias("unity_price"))
        .select(
            _seq(F.col("ts"), F.col("product_id")).alias("seq"),
            "ts",
            "product_id",
            F.concat(F.lit("Part "), F.col("product_id").cast("string")).alias("product_name"),
            F.lit("returned").alias("barcode"),
            F.col("unity_price").cast(MONEY).alias("unity_price"),
        )
    )
    return loaded.unionByName(priced)


def changes(spark: SparkSession, sf_dir: str) -> ChangeTables:
    """The events as decoded tables: dates are keys."""
    orders = (
        order_events(spark, sf_dir)
        .withColumn("order_date", date_key(F.col("order_date")))
        .withColumn("delivery_date", date_key(F.col("delivery_date")))
    )
    return ChangeTables(
        customer_changes(spark, sf_dir),
        product_changes(spark, sf_dir),
        orders,
        item_events(spark, sf_dir),
    )


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") != "MACHINERY")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_address"),
        )
    )


def product_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_type") != "PROMO")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("barcode"),
            F.col("p_retailprice").cast(MONEY).alias("unity_price"),
        )
    )


def dim_dates(spark: SparkSession) -> DataFrame:
    return build_dim_dates(spark, *CALENDAR)


def _message(rows: DataFrame, table_name: str, after: list[Column]) -> DataFrame:
    millis = (F.unix_date(F.col("ts").cast("date")).cast("long") * 86_400_000).alias("ts_ms")
    source = F.struct(F.col("seq").alias("lsn"), millis, F.lit(table_name).alias("table"))
    body = F.struct(
        F.struct(*after).alias("after"), F.lit("u").alias("op"), source.alias("source"), millis
    )
    return rows.select(
        F.lit(f"{TOPIC_PREFIX}.{table_name}").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        "seq",
        F.to_json(body).alias("value"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as change-log messages with JSON envelopes."""

    def epoch(column: str) -> Column:
        return F.unix_date(F.col(column)).alias(column)

    orders = _message(
        order_events(spark, sf_dir),
        "orders",
        [
            F.col("order_id"),
            F.col("customer_id"),
            epoch("order_date"),
            epoch("delivery_date"),
            F.col("status"),
        ],
    )
    items = _message(
        item_events(spark, sf_dir),
        "order_items",
        [
            F.col("order_item_id"),
            F.col("order_id"),
            F.col("product_id"),
            F.col("quantity").alias("quanity"),
        ],
    )
    customers = _message(
        customer_changes(spark, sf_dir),
        "customers",
        [F.col("customer_id"), F.col("customer_name"), F.col("customer_address")],
    )
    products = _message(
        product_changes(spark, sf_dir),
        "products",
        [
            F.col("product_id"),
            F.col("product_name"),
            F.col("barcode"),
            F.col("unity_price").cast("string").alias("unity_price"),
        ],
    )
    return orders.unionByName(items).unionByName(customers).unionByName(products)

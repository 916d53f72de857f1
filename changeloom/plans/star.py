"""The star schema from change events, as one batch plan."""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..operators import fact as facts, scd2
from ..operators.skew import ROWS_PER_TASK
from ..operators.state import dealt, staging_items, staging_orders
from ..operators.surrogate import inferred_key
from ..sources import changelog
from ..sources.workspace import together, workspace

CUSTOMER_ATTRS = ["customer_name", "customer_address"]
PRODUCT_ATTRS = ["product_name", "barcode"]


class ChangeTables(NamedTuple):
    """Accepted change events, one DataFrame per source table."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame


def from_log(log: DataFrame, strict_zero: bool = False) -> ChangeTables:
    """Events of a batch log, decoded in one pass and stored; those without ``seq`` are numbered over all tables together."""
    rows = changelog.stored(log, workspace(log.sparkSession, "decoded"), strict_zero)
    accepted = rows.filter(F.col("verdict") == changelog.ACCEPTED)
    seqs = accepted.agg(F.count_if(F.col("seq").isNull()).alias("without"), F.max("seq").alias("top")).first()
    if seqs["without"]:
        rows = changelog.numbered(accepted, seqs["top"] or 0)
    return ChangeTables(*[changelog.table_of(rows, table) for table in ChangeTables._fields])


def dimension(
    changes: DataFrame,
    key: str,
    surrogate: str,
    attrs: list[str],
    dedup_unchanged: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Type-2 dimension: surrogate, natural key, attributes and validity."""
    rows = scd2.versions(changes, key, attrs, dedup_unchanged, rows_per_task)
    return rows.select(
        F.col("from_seq").alias(surrogate),
        key,
        *attrs,
        "valid_from",
        "valid_to",
        "is_current",
        "from_seq",
        "to_seq",
    )


def dim_customers(changes: DataFrame, **options) -> DataFrame:
    return dimension(changes, "customer_id", "customer", CUSTOMER_ATTRS, **options)


def dim_products(changes: DataFrame, **options) -> DataFrame:
    return dimension(changes, "product_id", "product", PRODUCT_ATTRS, **options)


def with_inferred(
    dim: DataFrame, lines: DataFrame, source: DataFrame, key: str, surrogate: str, attrs: list[str]
) -> DataFrame:
    """Dimension plus the members that resolved lines took from the source table.

    An inferred member is valid from the first line that needed it up to the first version.
    """
    used = (
        lines.filter(F.col(surrogate) == inferred_key(F.col(key)))
        .groupBy(key)
        .agg(F.min("first_at").alias("from_seq"), F.min_by("created_at", "first_at").alias("valid_from"))
    )
    first = dim.groupBy(key).agg(
        F.min("from_seq").alias("to_seq"), F.min_by("valid_from", "from_seq").alias("valid_to")
    )
    inferred = (
        scd2.inferred_members(used, source, key, attrs)
        .join(first, key, "left")
        .select(
            inferred_key(F.col(key)).alias(surrogate),
            key,
            *attrs,
            "valid_from",
            "valid_to",
            F.col("to_seq").isNull().alias("is_current"),
            "from_seq",
            "to_seq",
        )
    )
    return dim.unionByName(inferred)


def write_facts(fact: DataFrame, path: str) -> None:
    """Fact table by delivery month, for reports.

    Rows are dealt by month; the engine splits large months and puts small ones together by their
    bytes, so files follow the data and the plan is not run twice for a sample of it.
    """
    month = F.floor(F.col("delivery_date") / 100).cast("int")
    (
        fact.withColumn("delivery_month", month)
        .hint("rebalance", "delivery_month")
        .write.mode("overwrite")
        .partitionBy("delivery_month")
        .parquet(path)
    )


def build_lines(changes: ChangeTables, keep_delivery_on_null: bool = False) -> DataFrame:
    orders = staging_orders(changes.orders, keep_delivery_on_null)
    return facts.join_lines(orders, staging_items(changes.order_items))


def _dealt(changes: ChangeTables) -> dict[str, DataFrame]:
    orders = changes.orders.select("order_id", "seq", "customer_id", "order_date", "ts", "status", "delivery_date")
    items = changes.order_items.select("order_item_id", "seq", "order_id", "product_id", "ts", "quantity")
    parts = (("orders", orders, "order_id"), ("order_items", items, "order_item_id"))
    by_key = together(orders.sparkSession, *[partial(dealt, rows, key) for _, rows, key in parts])
    return {name: rows for (name, *_), rows in zip(parts, by_key)}


def build_facts(
    changes: ChangeTables,
    dim_dates: DataFrame,
    customer_source: DataFrame | None = None,
    product_source: DataFrame | None = None,
    price_mode: str = "reference",
    keep_delivery_on_null: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> facts.Facts:
    """Fact, unresolved lines and rejected lines of a whole change log."""
    resolved = facts.resolve_lines(
        build_lines(changes._replace(**_dealt(changes)), keep_delivery_on_null),
        changes.customers,
        changes.products,
        facts.moves(changes.orders, changes.order_items),
        customer_source,
        product_source,
        price_mode,
        rows_per_task,
        facts.Events(changes.orders.count(), changes.order_items.count()),
    )
    return facts.split_facts(resolved, dim_dates)

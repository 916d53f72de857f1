"""Registered queries: every operator over the retail test tables.

Money is shown as double, dates and arrays as text, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import date_key
from ..functions.decimals import line_amount, money
from ..operators import fact as facts, scd2, state, upsert
from ..operators.asof import resolve_asof
from ..operators.calendar import build_dim_dates, flag_dates
from ..operators.constraints import rejected
from ..operators.surrogate import dense_number
from ..sources import changelog, snapshots
from ..sources.workspace import workspace, written
from . import reports, retail, star

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def shown_money(*names: str) -> dict[str, Column]:
    return {name: F.col(name).cast("double") for name in names}


def _build(spark: SparkSession, sf_dir: str, **options) -> facts.Facts:
    return star.build_facts(
        retail.changes(spark, sf_dir),
        retail.dim_dates(spark),
        retail.customer_source(spark, sf_dir),
        retail.product_source(spark, sf_dir),
        **options,
    )


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(spark, sf_dir).fact


def shown_fact(fact: DataFrame) -> DataFrame:
    return fact.select(
        "order_id", "order_item_id", "customer", "product", "order_date", "delivery_date",
        "status", "quantity", "unity_price", "total_amount", "updated_at",
    ).withColumns(shown_money("unity_price", "total_amount"))


# Fact


@query
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_fact(_fact(spark, sf_dir))


@query
def fact_consistent_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_fact(_build(spark, sf_dir, price_mode="consistent").fact)


@query
def fact_without_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = star.build_facts(retail.changes(spark, sf_dir), retail.dim_dates(spark))
    return shown_fact(built.fact)


@query
def fact_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = star.build_facts(
        star.from_log(retail.log(spark, sf_dir)),
        retail.dim_dates(spark),
        retail.customer_source(spark, sf_dir),
        retail.product_source(spark, sf_dir),
    )
    return shown_fact(built.fact)


SNAPSHOT = dt.datetime(1996, 6, 1)


@query
def fact_with_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tables taken in the middle of the log are one more version of each member in them."""
    changes = retail.changes(spark, sf_dir)
    position = (SNAPSHOT - dt.datetime(1970, 1, 1)).days * retail.DAY
    with_rows = {}
    for table, rows in (("customers", retail.customer_source(spark, sf_dir)), ("products", retail.product_source(spark, sf_dir))):
        path = workspace(spark, f"source-{table}")
        rows.write.parquet(path)
        snapshot = snapshots.as_changes(snapshots.from_parquet(spark, path, table), position, SNAPSHOT)
        with_rows[table] = getattr(changes, table).unionByName(snapshot)
    return shown_fact(star.build_facts(changes._replace(**with_rows), retail.dim_dates(spark)).fact)


def _snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as a snapshot: no seq, one log position beyond 32 TiB, three partitions a topic."""

    def topic(name: str, rows: DataFrame, key: str) -> DataFrame:
        source = F.struct(F.lit(1 << 46).alias("lsn"), F.lit(864_000_000_000).alias("ts_ms"))
        return rows.select(
            F.lit(f"{retail.TOPIC_PREFIX}.{name}").alias("topic"),
            (F.col(key) % 3).cast("int").alias("partition"),
            F.expr(f"{key} div 3").alias("offset"),
            F.lit(None).cast("long").alias("seq"),
            F.to_json(F.struct(F.struct(*rows.columns).alias("after"), source.alias("source"))).alias("value"),
        )

    customers = retail.table(spark, sf_dir, "customer").selectExpr("c_custkey customer_id", "c_name customer_name")
    products = retail.table(spark, sf_dir, "part").selectExpr("p_partkey product_id", "p_name product_name")
    orders = retail.table(spark, sf_dir, "orders").selectExpr("o_orderkey order_id", "o_custkey customer_id", "10000 order_date", "'open' status")
    items = retail.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("product_id"), F.max("l_quantity").cast("int").alias("quanity")
    )
    items = items.selectExpr("l_orderkey * 10 + l_linenumber order_item_id", "l_orderkey order_id", "product_id", "quanity")
    topics = [
        topic("customers", customers, "customer_id"), topic("products", products, "product_id"),
        topic("orders", orders, "order_id"), topic("order_items", items, "order_item_id"),
    ]
    return reduce(DataFrame.unionByName, topics)


@query
def pending_quantity_without_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a snapshot whose events have no order of their own."""
    built = star.build_facts(star.from_log(_snapshot_log(spark, sf_dir)), retail.dim_dates(spark))
    return reports.pending_quantity_by_product(built.fact)


@query
def unresolved_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(spark, sf_dir).unresolved.select(
        "order_id", "order_item_id", "customer_id", "product_id", "customer", "product"
    )


@query
def price_asof_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = retail.changes(spark, sf_dir)
    priced = resolve_asof(
        changes.order_items,
        facts.members(changes.products, "product_id", ["unity_price"]),
        "product_id",
        "from_seq",
        {"seq": {"unity_price": "unity_price"}},
        ["order_item_id", "quantity"],
    )
    return priced.select(
        "order_item_id",
        "product_id",
        "seq",
        "quantity",
        F.coalesce("unity_price", F.lit(0)).cast("double").alias("unity_price"),
        line_amount(F.col("quantity"), F.col("unity_price")).cast("double").alias("amount"),
    )


# Staging


@query
def staging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.staging_orders(retail.changes(spark, sf_dir).orders).drop("delivery_seq")


@query
def staging_orders_keep_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.changes(spark, sf_dir).orders
    return state.staging_orders(orders, keep_delivery_on_null=True).select(
        "order_id", "status", "delivery_date"
    )


@query
def staging_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.staging_items(retail.changes(spark, sf_dir).order_items)


@query
def staging_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_lines(retail.changes(spark, sf_dir))


@query
def status_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_lines(retail.changes(spark, sf_dir)).select(
        "order_id", "order_item_id", "status", "delivery_date"
    )


@query
def pending_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = retail.changes(spark, sf_dir)
    orders, items = state.staging_orders(changes.orders), state.staging_items(changes.order_items)
    return facts.pending_orders(orders, items).select("order_id", "customer_id", "status")


@query
def pending_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of orders whose messages are all set aside: those that come in with priority 4-NOT SPECIFIED have no status."""
    orders = state.staging_orders(changelog.events(_damaged_order_log(spark, sf_dir), "orders"))
    items = state.staging_items(retail.changes(spark, sf_dir).order_items)
    return facts.pending_items(orders, items).select("order_item_id", "order_id", "quantity")


# Reports


@query
def orders_by_delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_delivery_date_and_status(_fact(spark, sf_dir))


@query
def orders_by_delivery_status_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_delivery_date_and_status(
        _fact(spark, sf_dir), "Pending", dt.date(1996, 1, 1), dt.date(1997, 6, 30)
    )


@query
def top_delivery_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_delivery_dates(_fact(spark, sf_dir), limit=10)


@query
def pending_quantity_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pending_quantity_by_product(_fact(spark, sf_dir))


@query
def pending_quantity_by_natural_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pending_quantity_by_product(_fact(spark, sf_dir), "pending", by="natural")


@query
def top_customers_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_customers_by_orders(_fact(spark, sf_dir), limit=20)


@query
def top_natural_customers_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_customers_by_orders(_fact(spark, sf_dir), "completed", 20, by="natural")


@query
def report_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.records(reports.top_delivery_dates(_fact(spark, sf_dir), "pending", 100))


@query
def reports_star_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_month = reports.amounts_by_month(_fact(spark, sf_dir), retail.dim_dates(spark))
    return by_month.withColumns(shown_money("total_amount"))


@query
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = retail.changes(spark, sf_dir)
    used = ("order_item_id", "customer", "customer_id", "product", "product_id", "order_date", "delivery_date", "first_at", "created_at")
    fact = written(_fact(spark, sf_dir).select(*used), "fact")
    customers = star.with_inferred(
        star.dim_customers(changes.customers), fact, retail.customer_source(spark, sf_dir),
        "customer_id", "customer", star.CUSTOMER_ATTRS,
    )
    products = star.with_inferred(
        star.dim_products(changes.products), fact, retail.product_source(spark, sf_dir),
        "product_id", "product", star.PRODUCT_ATTRS,
    )
    joined = reports.star(fact, customers, products, retail.dim_dates(spark))
    return joined.select(
        "order_item_id", "customer_name", "customer_address", "product_name", "barcode",
        "order_day_of_week", "order_quarter", "delivery_month", "delivery_year",
    )


# Dimensions


def _user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("event_id").alias("seq"), "ts"
    )


@query
def scd2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.versions(_user_changes(spark, sf_dir), "user_id", ["event_type"])


@query
def scd2_changes_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _user_changes(spark, sf_dir)
    return scd2.versions(changes, "user_id", ["event_type"], dedup_unchanged=True)


@query
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.latest(_user_changes(spark, sf_dir), "user_id", ["event_type"])


@query
def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = retail.changes(spark, sf_dir)
    return star.with_inferred(
        star.dim_customers(changes.customers), _fact(spark, sf_dir),
        retail.customer_source(spark, sf_dir), "customer_id", "customer", star.CUSTOMER_ATTRS,
    )


@query
def scd2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(retail.changes(spark, sf_dir).products)


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = retail.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return dense_number(events, "event_id", "member")


@query
def dim_resolve_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _user_changes(spark, sf_dir)
    versions = events.filter(F.col("event_type").isin("signup", "view"))
    bought = events.filter(F.col("event_type") == "purchase")
    return resolve_asof(
        bought.select("user_id", "seq", "ts"),
        versions.withColumn("from_seq", F.col("seq")),
        "user_id",
        "from_seq",
        {"seq": {"version": "from_seq", "version_type": "event_type"}},
    )


@query
def dim_resolve_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    customers = star.dim_customers(retail.changes(spark, sf_dir).customers)
    return scd2.resolve_current(orders, customers, "customer_id", "customer")


@query
def inferred_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"))
    known = retail.changes(spark, sf_dir).customers.select("customer_id")
    missing = scd2.missing_members(orders, known, "customer_id")
    source = retail.customer_source(spark, sf_dir)
    return scd2.inferred_members(missing, source, "customer_id", star.CUSTOMER_ATTRS)


# Calendar


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        retail.table(spark, sf_dir, "orders")
        .groupBy(date_key(F.col("o_orderdate")).alias("dim_date"))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def _order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    ends = retail.table(spark, sf_dir, "orders").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    first, last = ends.first()
    return build_dim_dates(spark, first, last).withColumn(
        "calendar_date", F.col("calendar_date").cast("string")
    )


@query
def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the range of order dates, with the orders of each day."""
    counted = _order_calendar(spark, sf_dir).join(_order_days(spark, sf_dir), "dim_date", "left")
    return counted.fillna({"order_count": 0})


@query
def dim_dates_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with orders are there already and keep their rows; the rest is filled in."""
    existing = _order_days(spark, sf_dir).select("dim_date", F.lit("has orders").alias("day_of_week"))
    calendar = _order_calendar(spark, sf_dir).select("dim_date", "day_of_week")
    return upsert.insert_missing(existing, calendar, "dim_date")


SHORT_CALENDAR = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))


@query
def date_reference_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.build_lines(retail.changes(spark, sf_dir))
    calendar = build_dim_dates(spark, *SHORT_CALENDAR)
    flagged = flag_dates(lines, calendar, ["order_date"], ["delivery_date"])
    rules = {
        "order_date_not_in_calendar": F.col("order_date_ok"),
        "delivery_date_not_in_calendar": F.col("delivery_date_ok"),
    }
    return _shown_reasons(
        rejected(flagged, rules), "order_item_id", "order_date", "delivery_date"
    )


def _shown_reasons(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.array_join("reasons", ",").alias("reasons"))


@query
def constraint_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("note"),
        money(F.col("o_totalprice").cast("decimal(15,2)") * 1000).alias("amount"),
    )
    rules = {
        "status_missing": F.col("status").isNotNull(),
        "note_too_long": F.char_length("note") <= 8,
        "amount_too_large": F.col("amount").isNotNull(),
    }
    return _shown_reasons(rejected(orders, rules), "order_id")


# Change log


def _damaged_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages, sound or damaged depending on the order's priority and status."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    image = F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("order_date"),
        F.lit(None).cast("int").alias("delivery_date"),
        F.when(priority != "4-NOT SPECIFIED", status).alias("status"),
    )
    stamp = (F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * 86_400_000).alias("ts_ms")
    whole = F.to_json(F.struct(image.alias("after"), F.lit("c").alias("op"), stamp))
    deleted = F.to_json(F.struct(image.alias("before"), F.lit("d").alias("op"), stamp))
    value = (
        F.when(priority == "2-HIGH", deleted)
        .when(priority == "3-MEDIUM", F.substring(whole, 1, 40))
        .when((priority == "5-LOW") & (status == "F"), F.lit(None))
        .when((priority == "5-LOW") & (status == "O"), F.lit('{"after":{}}'))
        .when((priority == "5-LOW") & (status == "P"), F.lit("null"))
        .otherwise(whole)
    )
    return retail.table(spark, sf_dir, "orders").select(
        F.lit(f"{retail.TOPIC_PREFIX}.orders").alias("topic"),
        F.col("o_orderkey").alias("seq"),
        value.alias("value"),
    )


@query
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.events(_damaged_order_log(spark, sf_dir), "orders").drop("ts")


@query
def envelope_default_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without an order date, or with day zero, which read strictly is none: the day of the event stands in."""
    priority = F.col("o_orderpriority")
    day = F.when(priority == "2-HIGH", F.lit(0)).when(priority != "1-URGENT", F.unix_date(F.col("o_orderdate").cast("date")) - 3)
    image = F.struct(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), day.alias("order_date"),
        F.when(priority == "3-MEDIUM", F.lit(0)).otherwise(day).alias("delivery_date"), F.lit("new").alias("status"),
    )
    stamp = (F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * 86_400_000).alias("ts_ms")
    log = retail.table(spark, sf_dir, "orders").select(
        F.lit(f"{retail.TOPIC_PREFIX}.orders").alias("topic"),
        F.col("o_orderkey").alias("seq"),
        F.to_json(F.struct(image.alias("after"), stamp)).alias("value"),
    )
    return changelog.events(log, "orders", strict_zero=True).select("order_id", "order_date", "delivery_date")


@query
def envelope_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changelog.quarantine(_damaged_order_log(spark, sf_dir), "orders")
    return _shown_reasons(rows, "seq")


@query
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per routed table; heartbeat topics go nowhere."""
    beats = retail.table(spark, sf_dir, "events").select(F.lit("shop.heartbeat").alias("topic"))
    topics = retail.log(spark, sf_dir).select("topic").unionByName(beats)
    return topics.groupBy(changelog.routed_table(F.col("topic")).alias("table")).agg(
        F.count(F.lit(1)).alias("messages")
    )


@query
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT")["k"].alias("k")
    )


# Source-table upserts


@query
def natural_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = retail.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_address"),
    )
    user = F.col("user_id").cast("string")
    guest = F.concat(F.lit("Guest "), user)
    known = F.concat(F.lit("Customer#"), F.lpad(user, 9, "0"))
    batch = retail.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "signup", guest).otherwise(known).alias("customer_name"),
        F.col("event_type").alias("customer_address"),
        "event_id",
    )
    return upsert.upsert_by(customers, batch, "customer_name", "customer_id", "event_id")


@query
def open_order_per_customer_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.open_orders(state.staging_orders(retail.changes(spark, sf_dir).orders))


@query
def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = retail.table(spark, sf_dir, "customer").select("c_custkey")
    pages = upsert.id_pages(ids, "c_custkey", page_size=1000)
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return pages.select("page", text.alias("ids"))

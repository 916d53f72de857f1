"""The line-item fact: staging join, point-in-time members, prices and checks."""

from __future__ import annotations

from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.decimals import MONEY, line_amount
from ..sources.workspace import together, written
from .asof import BEGINNING, first_versions, resolve_asof
from .calendar import flag_dates
from .constraints import accepted, rejected
from .skew import ROWS_PER_TASK, most_of_a_hash, over
from .surrogate import inferred_key

#: A position behind all others.
NEVER = 2**63 - 1

FACT_COLUMNS = (
    "customer_order_item", "order_id", "order_item_id", "customer", "product",
    "order_date", "delivery_date", "status", "quantity", "unity_price", "total_amount",
    "updated_at", "status_lc", "customer_id", "product_id",
    "first_at", "last_at", "created_at",
)


def join_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines of which both sides are staged, whichever came first.

    The order side has one row per key, so a hot order only repeats on the item side, which AQE
    can split. ``first_at`` is where the line came to be, ``last_at`` where it last changed.
    """
    o, i = orders.alias("o"), items.alias("i")
    later_order = F.col("o.first_seq") >= F.col("i.first_seq")
    newer_order = F.col("o.last_seq") >= F.col("i.last_seq")
    return o.join(i, F.col("o.order_id") == F.col("i.order_id"), "inner").select(
        "i.order_item_id",
        "o.order_id",
        "o.customer_id",
        "i.product_id",
        "o.order_date",
        "o.delivery_date",
        "o.status",
        "i.quantity",
        F.greatest("o.first_seq", "i.first_seq").alias("first_at"),
        F.greatest("o.last_seq", "i.last_seq").alias("last_at"),
        F.when(later_order, F.col("o.created_at")).otherwise(F.col("i.created_at")).alias("created_at"),
        F.when(newer_order, F.col("o.updated_at")).otherwise(F.col("i.updated_at")).alias("updated_at"),
    )


def pending_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Items whose order has not come yet."""
    return items.join(orders.select("order_id"), "order_id", "left_anti")


def pending_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders without an item; item keys are made distinct before they are shuffled."""
    return orders.join(items.select("order_id").distinct(), "order_id", "left_anti")


def members(
    changes: DataFrame,
    key: str,
    columns: list[str],
    source: DataFrame | None = None,
) -> DataFrame:
    """What facts can resolve to: ``key, from_seq, surrogate`` and ``columns``.

    A fact from before the first version of its key gets the member inferred from ``source``,
    the current source table. Without a source table it gets the first version there is.
    """
    rows = changes.select(
        key, F.col("seq").alias("from_seq"), F.col("seq").alias("surrogate"), *columns
    )
    if source is None:
        return rows.unionByName(first_versions(rows, key, "from_seq"))
    inferred = source.select(
        key,
        F.lit(BEGINNING).alias("from_seq"),
        inferred_key(F.col(key)).alias("surrogate"),
        *columns,
    )
    return rows.unionByName(inferred)


class Moves(NamedTuple):
    """When orders and items were touched: ``order_id, seq, ts`` and ``order_item_id, seq, ts``."""

    orders: DataFrame
    items: DataFrame


class Events(NamedTuple):
    """How many order and item events there are at most."""

    orders: int
    items: int


def moves(order_events: DataFrame, item_events: DataFrame) -> Moves:
    return Moves(order_events.select("order_id", "seq", "ts"), item_events.select("order_item_id", "seq", "ts"))


def settle(
    waiting: DataFrame, touched: Moves, rows_per_task: int, may_be_hot: bool
) -> DataFrame | None:
    """The lines without a member, with ``first_at`` and ``created_at`` where those that settle later do.

    A line whose member is unknown when its sides meet is tried again at every later event of
    its order or item. So it comes to be at the first such event at or after the first version of
    each member, which is ``_need``; null if there never is one. None where no line does.
    """
    columns = [name for name in waiting.columns if name != "_need"]
    late = waiting.filter("_need IS NOT NULL").withColumn("_back", -F.col("_need")).drop("_need")
    late = written(late, "late")
    many = late.count()
    if not many:
        return None
    waiting = waiting.drop("_need")
    # The first event from a position on is the last one before it when the order is turned around.
    for table, key, name in ((touched.orders, "order_id", "_o"), (touched.items, "order_item_id", "_i")):
        own = table.join(late.select(key).distinct(), key, "left_semi")
        turned = own.select(key, (-F.col("seq")).alias("_at"), F.struct("seq", "ts").alias("_move"))
        hot = may_be_hot
        if hot:
            # Few of all events are of late lines; read several times where a key may be hot among them.
            turned = written(turned, "moves")
            hot = many + turned.count() > rows_per_task
        late = resolve_asof(late, turned, key, "_at", {"_back": {name: "_move"}}, ["order_item_id"], rows_per_task, hot)
    settled = late.select("order_item_id", F.least("_o", "_i").alias("_settled")).filter("_settled IS NOT NULL")
    moved = waiting.join(settled, "order_item_id", "left")
    return moved.withColumns(
        {"first_at": F.coalesce("_settled.seq", "first_at"), "created_at": F.coalesce("_settled.ts", "created_at")}
    ).select(*columns)


class Keys(NamedTuple):
    """Of a key of lines: whether some key is hot, and the keys with lines from before any version: ``key, _first``."""

    hot: bool
    early: DataFrame


def _some_hot(rows: DataFrame, key: str, rows_per_task: int) -> bool:
    """Whether a key has too many rows; keys are counted only if a fullest hash does."""
    return most_of_a_hash(rows, key) > rows_per_task and not over(rows, key, "n", rows_per_task).isEmpty()


def _judged_keys(lines: DataFrame, versions: DataFrame, key: str, rows_per_task: int) -> Keys:
    """Over the stored lines and versions; only keys with early lines are kept.

    Partial aggregates meet most keys in most tasks, so for all lines little more than the key is shuffled. Positions are compared
    only for keys that may be early: those without a version, or with none up to the first of all lines.
    """
    own = lines.filter(F.col(key).isNotNull()).select(key, "first_at")
    versions = versions.filter(F.col(key).isNotNull()).select(key, "from_seq")
    hot = _some_hot(own, key, rows_per_task) or _some_hot(versions, key, rows_per_task)
    low = F.lit(own.agg(F.min("first_at")).first()[0]).cast("long")
    used = own.groupBy(key).agg(F.max(F.col("first_at").isNull()).alias("_blank"))
    firsts = versions.groupBy(key).agg(F.min("from_seq").alias("_first"))
    late = F.col("_first").isNull() | F.col("_blank") | (F.col("_first") > low)
    suspects = written(used.join(firsts, key, "left").filter(late).select(key, "_first"), "keys")
    counted = own.join(suspects, key).groupBy(key).agg(F.min("first_at").alias("_at"), F.min("_first").alias("_first"))
    early = F.coalesce(F.col("_at") < F.col("_first"), F.lit(True))
    return Keys(hot, written(counted.filter(early).select(key, "_first"), "keys"))


def _without_member(lines: DataFrame, early: dict[str, DataFrame]) -> DataFrame:
    """Lines that have no member where their sides meet, and from where on all members are known: ``_need``."""
    need, known, rows = [F.col("first_at")], F.col("first_at").isNotNull(), lines
    for key, keys in early.items():
        rows = rows.join(keys.select(key, F.struct("_first").alias(f"_{key}")), key, "left")
        first = F.col(f"_{key}._first")
        known = known & F.col(key).isNotNull() & (F.col(f"_{key}").isNull() | F.coalesce(first <= F.col("first_at"), F.lit(False)))
        ever = F.col(key).isNotNull() & (F.col(f"_{key}").isNull() | first.isNotNull())
        need.append(F.when(~ever, F.lit(NEVER)).otherwise(F.coalesce(first, F.lit(BEGINNING))))
    return rows.filter(~known).select(*lines.columns, F.nullif(F.greatest(*need), F.lit(NEVER)).alias("_need"))


def resolve_lines(
    lines: DataFrame,
    customer_changes: DataFrame,
    product_changes: DataFrame,
    touched: Moves,
    customer_source: DataFrame | None = None,
    product_source: DataFrame | None = None,
    price_mode: str = "reference",
    rows_per_task: int = ROWS_PER_TASK,
    events: Events | None = None,
    stored: bool = False,
) -> DataFrame:
    """Lines with ``customer``, ``product``, ``unity_price`` and ``total_amount``.

    Members and unit price are those valid where the line came to be and stay so. With
    ``price_mode`` "reference" the total follows the price at ``last_at``; with "consistent" it
    follows the unit price of the line. Members that never become known leave ``customer`` or
    ``product`` null.

    All lines are stored (unless they are ``stored`` already) and resolved where their sides meet; those without a member, which
    follow from the first version of each key, are tried again (``settle``), and only they. Hot keys are looked for by their
    hashes first. What is resolved is not stored: who reads it more than once does.
    """
    if price_mode not in ("reference", "consistent"):
        raise ValueError(f"unknown price_mode {price_mode!r}")
    # Read up to four times each.
    customers = members(customer_changes, "customer_id", [], customer_source)
    products = members(product_changes, "product_id", ["unity_price"], product_source)
    spark = lines.sparkSession
    customers, products = together(spark, lambda: written(customers, "members"), lambda: written(products, "members"))
    sides = {"customer_id": customers, "product_id": products}
    many_moves = events is None or events.items + events.orders > rows_per_task
    lines = lines if stored else written(lines, "lines")
    keys = dict(zip(sides, together(spark, *[partial(_judged_keys, lines, rows, key, rows_per_task) for key, rows in sides.items()])))
    probes = {"first_at": {"product": "surrogate", "unity_price": "unity_price"}}
    if price_mode == "reference":
        probes["last_at"] = {"_last_price": "unity_price"}

    def resolved(rows: DataFrame, customers: DataFrame = customers, products: DataFrame = products) -> DataFrame:
        for versions, key, wanted in (
            (customers, "customer_id", {"first_at": {"customer": "surrogate"}}),
            (products, "product_id", probes),
        ):
            rows = resolve_asof(rows, versions, key, "from_seq", wanted, ["order_item_id"], rows_per_task, keys[key].hot)
        return rows

    waiting = written(_without_member(lines, {key: one.early for key, one in keys.items()}), "waiting")
    settled = settle(waiting, touched, rows_per_task, many_moves)
    whole = resolved(lines)
    if settled is not None:
        settled = written(settled, "settled")
        own = [rows.join(settled.select(key).distinct(), key, "left_semi") for key, rows in sides.items()]
        whole = whole.filter(_known()).unionByName(resolved(settled, *own))

    paid = "_last_price" if price_mode == "reference" else "unity_price"
    return (
        whole.withColumn("total_amount", line_amount(F.col("quantity"), F.col(paid)))
        .withColumn("unity_price", F.coalesce("unity_price", F.lit(0).cast(MONEY)))
        .drop("_last_price")
    )


class Facts(NamedTuple):
    fact: DataFrame
    unresolved: DataFrame
    quarantine: DataFrame


def _flagged(resolved: DataFrame, dim_dates: DataFrame) -> DataFrame:
    return flag_dates(resolved, dim_dates, ["order_date"], ["delivery_date"])


def _known() -> Column:
    return F.col("customer").isNotNull() & F.col("product").isNotNull()


def _rules() -> dict[str, Column]:
    return {
        "order_date_not_in_calendar": F.col("order_date_ok"),
        "delivery_date_not_in_calendar": F.col("delivery_date_ok"),
        "total_amount_too_large": F.col("total_amount").isNotNull(),
    }


def as_fact(lines: DataFrame) -> DataFrame:
    """Good lines in the layout of the fact table."""
    return (
        lines.withColumn("customer_order_item", F.col("order_item_id"))
        .withColumn("status_lc", F.lower("status"))
        .select(*FACT_COLUMNS)
    )


def split_facts(resolved: DataFrame, dim_dates: DataFrame) -> Facts:
    """Resolved lines into the fact, lines with unknown members, and lines that break a rule."""
    flagged = _flagged(resolved.filter(_known()), dim_dates)
    bad = rejected(flagged, _rules()).drop("order_date_ok", "delivery_date_ok")
    return Facts(as_fact(accepted(flagged, _rules())), resolved.filter(~_known()), bad)


def with_state(resolved: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """The same decision as a column ``state``: fact, unresolved or rejected."""
    good = reduce(lambda a, b: a & b, _rules().values())
    state = F.when(~_known(), "unresolved").when(good, "fact").otherwise("rejected")
    return (
        _flagged(resolved, dim_dates)
        .withColumn("state", state)
        .drop("order_date_ok", "delivery_date_ok")
    )

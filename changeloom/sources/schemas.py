"""Row images on the wire and the table layouts built from them."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _S, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Fields of the "after" image that are read, per source table. ``quanity`` is the wire name.
AFTER = {
    "customers": _struct(customer_id=_L, customer_name=_S, customer_address=_S),
    "products": _struct(product_id=_L, product_name=_S, barcode=_S, unity_price=_S),
    "orders": _struct(order_id=_L, customer_id=_L, order_date=_I, delivery_date=_I, status=_S),
    "order_items": _struct(order_item_id=_L, order_id=_L, product_id=_L, quanity=_I),
}

KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}

_MONEY = T.DecimalType(13, 5)

# Tables that the stream keeps. Rows of orders and order_items are mergeable state, one for each event.
KEPT = {
    "customers": _struct(seq=_L, ts=_TS, customer_id=_L, customer_name=_S, customer_address=_S),
    "products": _struct(
        seq=_L, ts=_TS, product_id=_L, product_name=_S, barcode=_S, unity_price=_MONEY
    ),
    "orders": _struct(
        order_id=_L, first_seq=_L, customer_id=_L, order_date=_I, created_at=_TS,
        last_seq=_L, status=_S, delivery_seq=_L, delivery_date=_I, updated_at=_TS,
    ),
    "order_items": _struct(
        order_item_id=_L, first_seq=_L, order_id=_L, product_id=_L, created_at=_TS,
        last_seq=_L, quantity=_I, updated_at=_TS,
    ),
    "items_of_orders": _struct(order_id=_L, order_item_id=_L),
    "quarantine": _struct(table=_S, seq=_L, value=_S, reasons=T.ArrayType(_S)),
    "lines": _struct(
        order_item_id=_L, order_id=_L, customer_id=_L, product_id=_L, order_date=_I,
        delivery_date=_I, status=_S, quantity=_I, first_at=_L, last_at=_L, created_at=_TS,
        updated_at=_TS, customer=_L, product=_L, unity_price=_MONEY, total_amount=_MONEY, state=_S,
    ),
    # Lines by member: the version they have and up to where a version would matter, or that they wait.
    "settled": _struct(member=_L, order_item_id=_L, until=_L, version=_L),
    "waiting": _struct(member=_L, order_item_id=_L, waits=T.BooleanType()),
    # Lines of an order by what reports group them by; how many orders, or what quantity, a group has.
    "order_counts": _struct(
        order_id=_L, status=_S, delivery_date=_I, customer=_L, customer_id=_L, lines=_L
    ),
    "totals": _struct(
        report=_S, status=_S, delivery_date=_I, member=_L, member_id=_L, amount=_L, lines=_L
    ),
}

CORRUPT = "_corrupt_record"

LOG = _struct(topic=_S, partition=_I, offset=_L, seq=_L, value=_S)


def envelope(table: str) -> T.StructType:
    """Change envelope of one table; text that does not parse lands in ``_corrupt_record``."""
    return _struct(
        after=AFTER[table],
        ts_ms=_L,
        source=_struct(lsn=_L, ts_ms=_L),
        **{CORRUPT: _S},
    )

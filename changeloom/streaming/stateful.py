"""Order lines from keyed state: work per micro-batch grows with the orders that it touches only.

``StarStream`` looks touched keys up in its tables. Here Spark's state store does: each block of orders with neighbouring
ids keeps the rows of its orders and of their items as whole columns, and an event gives out the lines that it
changes. A block is one call and one read and write of its state however many of its orders have events, so a micro-batch of
few events costs as much as one of many: few and large ones are the cheap way through a long log. Orders whose ids are
far apart are a block each. The state of a block is spread over ``salts`` keys by item, order events going to all
of them, so that an order with very many items is the work of many tasks. Items are kept in pages by
ranges of their ids: a micro-batch reads and writes each touched page once and merges it as a whole; an order event reads
the pages of its block.

The order of an item is taken from its first event here; an item that moves between orders
needs ``StarStream``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.asof import BEGINNING
from ..operators.state import item_state, order_state

NO_DATE = 0

#: Ids of items in a page, and (as a power of two) ids of orders in a block.
PAGE = 16384
BLOCK_BITS = 10

_ORDER = (
    "first_seq LONG, customer_id LONG, order_date INT, created_at LONG, last_seq LONG, "
    "status STRING, delivery_seq LONG, delivery_date INT, updated_at LONG"
)
_ITEM = (
    "order_item_id LONG, first_seq LONG, product_id LONG, created_at LONG, last_seq LONG, "
    "quantity LONG, updated_at LONG"
)
_OUT = (
    "order_id LONG, order_item_id LONG, customer_id LONG, product_id LONG, order_date INT, "
    "delivery_date INT, status STRING, quantity INT, first_at LONG, last_at LONG, "
    "created_at LONG, updated_at LONG"
)


def _columns(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


_ORDER_COLUMNS, _ITEM_COLUMNS, _OUT_COLUMNS = _columns(_ORDER), _columns(_ITEM), _columns(_OUT)

#: Kept beside each row: its order, and when its order last had an event there.
_KEPT = ["order_id", "touched"]


#: How the state holds rows: numbers column by column as one compressed piece, and the texts that ``status`` counts in.
_PACKED = "size LONG, numbers BINARY, texts ARRAY<STRING>"
_CODEC = "zstd"


# Columns that are taken together, by the first of them: from the lower or the higher row.
_ORDER_GROUPS = (
    (("first_seq", "customer_id", "order_date", "created_at"), True),
    (("last_seq", "status", "updated_at"), False),
    (("delivery_seq", "delivery_date"), False),
    (("touched",), False),
)
_ITEM_GROUPS = (
    (("first_seq", "product_id", "created_at"), True),
    (("last_seq", "quantity", "updated_at"), False),
    (("touched",), False),
)
_ITEM_KEY = ("order_id", "order_item_id")


Rows = dict[str, np.ndarray]


def merged(rows: Rows, key: str | tuple[str, ...], groups: tuple[tuple[tuple[str, ...], bool], ...]) -> Rows:
    """One row per key, in the order of keys: of each group of columns, those of the row with the lowest or highest order.

    Of equal orders the first row's are taken, so state goes before what comes in.
    """
    names = (key,) if isinstance(key, str) else key
    keys, picked = [rows[name] for name in names], {}
    for columns, lowest in groups:
        by = rows[columns[0]]
        order = np.lexsort((by if lowest else ~by, *reversed(keys)))
        other = [own[order][1:] != own[order][:-1] for own in keys]
        first = order[np.append(True, np.logical_or.reduce(other))[: len(order)]]
        picked |= {name: rows[name][first] for name in names} | {c: rows[c][first] for c in columns}
    return picked


def _together(parts: list[Rows]) -> Rows:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([part[c] for part in parts]) for c in parts[0]}


def _columns_of(columns: list[str], values) -> Rows:
    return {c: np.array(v, dtype=object if c == "status" else np.int64) for c, v in zip(columns, values)}


def packed(rows: Rows, columns: list[str]) -> tuple[int, bytes, list[str]]:
    """Rows in the layout of ``_PACKED``: single values would be converted one by one on their way to the store."""
    texts, numbers = np.zeros(0, object), []
    for name in columns:
        if name == "status":
            codes, texts = pd.factorize(rows[name])
            numbers.append(codes.astype(np.int64))
        else:
            numbers.append(np.ascontiguousarray(rows[name], dtype=np.int64))
    return len(numbers[0]), pa.compress(np.concatenate(numbers).tobytes(), codec=_CODEC, asbytes=True), texts.tolist()


def unpacked(values: tuple[int, bytes, list[str]], columns: list[str]) -> Rows:
    size, numbers, texts = values
    whole = pa.decompress(bytes(numbers), decompressed_size=8 * size * len(columns), codec=_CODEC)
    rows = dict(zip(columns, np.frombuffer(whole, np.int64).reshape(len(columns), size)))
    if "status" in rows:
        # A code of -1 is a null.
        rows["status"] = np.array([*texts, None], dtype=object)[rows["status"]]
    return rows


class OrderLines(StatefulProcessor):
    """State of one (block, salt): the rows of its orders, and of their items in pages of ``PAGE`` ids."""

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.orders = handle.getValueState("orders", _PACKED, self.keep_ms)
        self.pages = handle.getMapState("pages", "page LONG", _PACKED, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
        new, items = [], []
        for chunk in rows:
            is_order = chunk["is_order"].to_numpy(dtype=bool)
            for own, to, columns, by, groups in (
                (is_order, new, _ORDER_COLUMNS, "order_id", _ORDER_GROUPS),
                (~is_order, items, _ITEM_COLUMNS, _ITEM_KEY, _ITEM_GROUPS),
            ):
                if own.any():
                    part = _columns_of(["order_id", *columns], [chunk[c].to_numpy()[own] for c in ("order_id", *columns)])
                    to.append(merged(part | {"touched": np.full(int(own.sum()), now)}, by, groups))
        orders = self._stored(_ORDER_COLUMNS, self.orders.get(), now)
        changed = np.unique(np.concatenate([part["order_id"] for part in new])) if new else np.zeros(0, np.int64)
        if new:
            orders = merged(_together([orders, *new] if orders else new), "order_id", _ORDER_GROUPS)
            self.orders.update(packed(orders, _KEPT + _ORDER_COLUMNS))
        done = set()
        for number, page, touched in self._touched(items, now):
            done.add(number)
            if orders:
                yield from self._lines(orders, page, touched | np.isin(page["order_id"], changed))
        if new:
            for (number,), stored in self.pages.iterator():
                if number not in done:
                    page = self._stored(_ITEM_COLUMNS, stored, now)
                    yield from self._lines(orders, page, np.isin(page["order_id"], changed))

    def _stored(self, columns: list[str], values, now: int) -> Rows:
        """Stored rows, without those whose time has run out; an empty dict if there are none at all."""
        if not values:
            return {}
        rows = unpacked(values, _KEPT + columns)
        if self.keep_ms is None:
            return rows
        alive = rows["touched"] > now - self.keep_ms
        return {c: v[alive] for c, v in rows.items()}

    def _touched(self, items: list[Rows], now: int) -> Iterator[tuple[int, Rows, np.ndarray]]:
        """Merge new items into their pages; each such page, and which of its rows are new or changed."""
        if not items:
            return
        items = merged(_together(items), _ITEM_KEY, _ITEM_GROUPS)
        pages = items["order_item_id"] // PAGE
        for number in np.unique(pages).tolist():
            own = pages == number
            new = {c: v[own] for c, v in items.items()} | {"new": np.ones(int(own.sum()), np.int64)}
            stored = self._stored(_ITEM_COLUMNS, self.pages.getValue((number,)), now)
            if stored:
                stored["new"] = np.zeros(len(stored["order_id"]), np.int64)
            whole = merged(_together([stored, new] if stored else [new]), _ITEM_KEY, (*_ITEM_GROUPS, (("new",), False)))
            whole["touched"][np.isin(whole["order_id"], new["order_id"])] = now
            self.pages.updateValue((number,), packed(whole, _KEPT + _ITEM_COLUMNS))
            yield number, whole, whole["new"] == 1

    @staticmethod
    def _lines(orders: Rows, items: Rows, wanted: np.ndarray) -> Iterator[pd.DataFrame]:
        """Lines of the wanted items whose order is known."""
        items = {c: v[wanted] for c, v in items.items()}
        place = np.searchsorted(orders["order_id"], items["order_id"])
        place = np.minimum(place, max(len(orders["order_id"]) - 1, 0))
        known = orders["order_id"][place] == items["order_id"] if len(orders["order_id"]) else np.zeros(len(place), bool)
        if not known.any():
            return
        items, place = {c: v[known] for c, v in items.items()}, place[known]
        order = {c: orders[c][place] for c in _ORDER_COLUMNS}
        lines = {c: items[c] for c in ("order_id", "order_item_id", "product_id", "quantity")}
        lines |= {c: order[c] for c in ("customer_id", "order_date", "delivery_date", "status")}
        lines["first_at"] = np.maximum(items["first_seq"], order["first_seq"])
        lines["last_at"] = np.maximum(items["last_seq"], order["last_seq"])
        lines["created_at"] = np.where(items["first_seq"] <= order["first_seq"], order["created_at"], items["created_at"])
        lines["updated_at"] = np.where(items["last_seq"] <= order["last_seq"], order["updated_at"], items["updated_at"])
        yield pd.DataFrame({c: lines[c] for c in _OUT_COLUMNS})

    def close(self) -> None:
        pass


def _with_micros(df: DataFrame) -> DataFrame:
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("created_at", "updated_at")}
    return df.withColumns({c: F.coalesce(m, F.lit(BEGINNING)) for c, m in micros.items()})


def changed_lines(
    orders: DataFrame,
    items: DataFrame,
    salts: int = 8,
    keep_delivery_on_null: bool = False,
    keep_ms: int | None = None,
) -> DataFrame:
    """Stream of the lines that order and item event streams change; the last one of a line counts.

    ``keep_ms`` bounds the state: an order's row, or its items in a page, that have had no event for so long
    are forgotten, and a later event begins anew; as it goes by the clock, such a stream does not end by
    itself with ``availableNow``. Needs the RocksDB state store provider.
    """
    spread = F.pmod(F.xxhash64("order_item_id"), F.lit(salts)).cast("int")
    item_rows = _with_micros(item_state(items)).withColumn("salt", spread)
    order_rows = _with_micros(order_state(orders, keep_delivery_on_null)).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    # No nulls in number columns: pandas would turn the column to floating point, which does
    # not hold all ids. Columns of the other kind of row are never looked at.
    none = F.lit(BEGINNING)
    order_rows = order_rows.withColumns(
        {
            "is_order": F.lit(True),
            "delivery_seq": F.coalesce("delivery_seq", none),
            "delivery_date": F.coalesce("delivery_date", F.lit(NO_DATE)),
        }
    )
    both = item_rows.withColumn("is_order", F.lit(False)).unionByName(
        order_rows, allowMissingColumns=True
    )
    both = both.fillna(
        0, ["order_item_id", "customer_id", "product_id", "quantity", "order_date",
            "delivery_seq", "delivery_date"],
    )
    both = both.filter("order_id IS NOT NULL").withColumn("block", F.shiftright("order_id", BLOCK_BITS))
    lines = both.groupBy("block", "salt").transformWithStateInPandas(
        statefulProcessor=OrderLines(keep_ms),
        outputStructType=_OUT,
        outputMode="Update",
        timeMode="None" if keep_ms is None else "ProcessingTime",
    )
    return lines.withColumns(
        {
            c: F.timestamp_micros(F.nullif(F.col(c), F.lit(BEGINNING))).cast("timestamp_ntz")
            for c in ("created_at", "updated_at")
        }
        | {"delivery_date": F.nullif(F.col("delivery_date"), F.lit(NO_DATE))}
    )

"""Small change logs, and a plain event-by-event account of what they must lead to."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa

DAY0 = dt.date(2026, 1, 1)
EPOCH = dt.date(1970, 1, 1)


def stamp(seq: int) -> dt.datetime:
    return dt.datetime(2026, 1, 1) + dt.timedelta(minutes=seq)


def epoch_days(day: dt.date | None) -> int | None:
    return None if day is None else (day - EPOCH).days


def key(day: dt.date | None) -> int | None:
    return None if day is None else int(day.strftime("%Y%m%d"))


def message(seq: int, table: str, after: dict | None, **more) -> tuple:
    millis = int((stamp(seq) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    body = {"before": None, "after": after, "op": "u", "ts_ms": millis} | more
    return (f"shop.operations.{table}", 0, seq, seq, json.dumps(body))


def raw(seq: int, table: str, value: str | None) -> tuple:
    return (f"shop.operations.{table}", 0, seq, seq, value)


def log_frame(spark, messages):
    """From Arrow, so that the planner knows how small it is."""
    names = ["topic", "partition", "offset", "seq", "value"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*messages), kinds)]
    return spark.createDataFrame(pa.table(columns, names=names))


def customer(seq, id_, name="Ann", address="Here"):
    return message(seq, "customers", {"customer_id": id_, "customer_name": name, "customer_address": address})


def product(seq, id_, price="2.50", name="Pen", barcode="123"):
    return message(
        seq, "products", {"product_id": id_, "product_name": name, "barcode": barcode, "unity_price": price}
    )


def order(seq, id_, customer_id=1, status="PENDING", day=DAY0, delivery=DAY0 + dt.timedelta(10)):
    return message(
        seq,
        "orders",
        {
            "order_id": id_,
            "customer_id": customer_id,
            "order_date": epoch_days(day),
            "delivery_date": epoch_days(delivery),
            "status": status,
        },
    )


def item(seq, id_, order_id=1, product_id=1, quantity=3):
    return message(
        seq,
        "order_items",
        {"order_item_id": id_, "order_id": order_id, "product_id": product_id, "quanity": quantity},
    )


def random_world(rng: random.Random, base: int, size: int) -> list[tuple]:
    """A log over a few keys above ``base``; orders and items keep their keys."""
    home, moves = {}, []
    keys = [base + k for k in range(4)]
    for seq in range(base * 100, base * 100 + size):
        kind = rng.choice(["customers", "products", "orders", "orders", "order_items", "order_items"])
        if kind == "customers":
            moves.append(customer(seq, rng.choice(keys), address=rng.choice("ABC")))
        elif kind == "products":
            moves.append(product(seq, rng.choice(keys), price=f"{rng.randint(0, 99)}.{rng.randint(0, 99):02d}"))
        elif kind == "orders":
            delivery = rng.choice([None, DAY0 + dt.timedelta(rng.randint(5, 9))])
            moves.append(
                order(seq, rng.choice(keys), rng.choice(keys), rng.choice(["PENDING", "Open", "DONE"]),
                      DAY0 + dt.timedelta(rng.randint(0, 4)), delivery)
            )
        else:
            id_ = rng.choice([base + k for k in range(8)])
            order_id, product_id = home.setdefault(id_, (rng.choice(keys), rng.choice(keys)))
            moves.append(item(seq, id_, order_id, product_id, rng.randint(0, 9)))
    return moves


def sources(messages, every=2):
    """Source tables that know only some of the members."""
    ids = sorted({id_ for m in messages for id_ in _ids(m)})
    known = [id_ for id_ in ids if id_ % every == 0]
    customers = [(id_, f"Source {id_}", "There") for id_ in known]
    products = [(id_, f"Source {id_}", "0", Decimal("7.25")) for id_ in known]
    return customers, products


def _ids(m):
    after = json.loads(m[4]).get("after") or {}
    return [after[k] for k in ("customer_id", "product_id") if k in after]


def replayed(messages, known_customers=(), known_products=(), price_mode="reference") -> dict[int, dict]:
    """Fact rows by item, from applying the messages one by one in the order of ``seq``."""
    members = {"customers": {}, "products": {}}
    prices = {row[0]: row[3] for row in known_products}
    sourced = {"customers": {r[0] for r in known_customers}, "products": set(prices)}
    orders, items, facts = {}, {}, {}

    def member(table, id_):
        if id_ in members[table]:
            return members[table][id_]
        return -1 - id_ if id_ in sourced[table] else None

    def settle(item_id, seq):
        line, head = items[item_id], orders.get(items[item_id]["order_id"])
        if head is None:
            return
        old = facts.get(item_id)
        who = old["customer"] if old else member("customers", head["customer_id"])
        what = old["product"] if old else member("products", line["product_id"])
        if who is None or what is None:
            return
        price = prices.get(line["product_id"], Decimal(0))
        unit = old["unity_price"] if old else price
        paid = price if price_mode == "reference" else unit
        facts[item_id] = {
            "order_id": line["order_id"], "customer": who, "product": what,
            "order_date": head["order_date"], "delivery_date": head["delivery_date"],
            "status": head["status"], "quantity": line["quantity"], "unity_price": unit,
            "total_amount": (paid * line["quantity"]).quantize(Decimal("0.00001"), ROUND_HALF_UP),
            "updated_at": stamp(seq),
        }

    for topic, _, _, seq, value in sorted(messages, key=lambda m: m[3]):
        table, row = topic.rsplit(".", 1)[1], json.loads(value)["after"]
        if table in members:
            id_ = row["customer_id" if table == "customers" else "product_id"]
            members[table][id_] = seq
            if table == "products":
                prices[id_] = Decimal(row["unity_price"])
        elif table == "orders":
            days = {f: row[f] and key(EPOCH + dt.timedelta(row[f])) for f in ("order_date", "delivery_date")}
            head = orders.setdefault(row["order_id"], {"customer_id": row["customer_id"], "order_date": days["order_date"]})
            head |= {"status": row["status"], "delivery_date": days["delivery_date"]}
            for item_id, line in items.items():
                if line["order_id"] == row["order_id"]:
                    settle(item_id, seq)
        else:
            line = items.setdefault(row["order_item_id"], {"order_id": row["order_id"], "product_id": row["product_id"]})
            line["quantity"] = row["quanity"]
            settle(row["order_item_id"], seq)
    return facts


def fact_dict(fact) -> dict[int, dict]:
    wanted = [
        "order_id", "customer", "product", "order_date", "delivery_date", "status", "quantity",
        "unity_price", "total_amount", "updated_at",
    ]
    rows = fact.collect()
    result = {r["order_item_id"]: {c: r[c] for c in wanted} for r in rows}
    assert len(result) == len(rows), "order_item_id is not unique"
    return result


def source_frames(spark, customers, products):
    def table(rows, names, kinds):
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    text, number = pa.string(), pa.int64()
    return (
        spark.createDataFrame(
            table(customers, ["customer_id", "customer_name", "customer_address"], [number, text, text])
        ),
        spark.createDataFrame(
            table(
                products,
                ["product_id", "product_name", "barcode", "unity_price"],
                [number, text, text, pa.decimal128(13, 5)],
            )
        ),
    )

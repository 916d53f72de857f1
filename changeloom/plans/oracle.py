"""The registered queries as SQL for another engine, written from the rules of the binding."""

from __future__ import annotations

_CTE = {
    "order_events": """
        SELECT o_orderkey AS order_id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) * 100000000000000 + o_orderkey AS seq,
               o_orderdate AS ts, o_custkey AS customer_id, o_orderdate::DATE AS od,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE + 10 END AS dd, 'PENDING' AS status
        FROM orders
        UNION ALL
        SELECT o_orderkey, (date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 5) * 100000000000000 + o_orderkey,
               o_orderdate + INTERVAL 5 DAY, o_custkey + 1, o_orderdate::DATE + 5,
               CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate::DATE + 12
                    WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN o_orderdate::DATE + 10 END,
               CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED'
                    WHEN o_orderpriority = '1-URGENT' THEN 'OPEN' ELSE 'Open' END
        FROM orders WHERE o_orderstatus IN ('O', 'F')""",
    "item_events": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, l_quantity::INT AS quantity, l_shipdate AS ts,
               date_diff('day', DATE '1970-01-01', l_shipdate::DATE) * 100000000000000
                 + l_partkey * 100 + l_quantity::BIGINT AS seq
        FROM lineitem""",
    "customer_changes": """
        SELECT c_custkey AS customer_id, c_custkey AS seq, TIMESTAMP '1995-01-01' AS ts,
               c_name AS customer_name, c_mktsegment AS customer_address
        FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT DISTINCT o_custkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) * 100000000000000 + o_custkey,
               o_orderdate, 'Customer ' || o_custkey, 'Street ' || strftime(o_orderdate, '%Y%m%d')
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "product_changes": """
        SELECT p_partkey AS product_id, p_partkey AS seq, TIMESTAMP '1995-01-01' AS ts,
               p_name AS product_name, p_brand AS barcode, p_retailprice::DECIMAL(13,5) AS unity_price
        FROM part WHERE p_type <> 'ECONOMY'
        UNION ALL
        SELECT l_partkey, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) * 100000000000000 + l_partkey,
               l_shipdate, 'Part ' || l_partkey, 'returned',
               max(l_extendedprice::DECIMAL(13,2))::DECIMAL(13,5)
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey, l_shipdate""",
    "staged_orders": """
        SELECT order_id, min(seq) AS first_seq, arg_min_null(customer_id, seq) AS customer_id,
               strftime(arg_min_null(od, seq), '%Y%m%d')::INT AS order_date,
               arg_min_null(ts, seq) AS created_at, max(seq) AS last_seq,
               arg_max_null(status, seq) AS status,
               strftime(arg_max_null(dd, seq), '%Y%m%d')::INT AS delivery_date,
               arg_max_null(ts, seq) AS updated_at
        FROM order_events GROUP BY order_id""",
    "staged_items": """
        SELECT order_item_id, min(seq) AS first_seq, arg_min_null(order_id, seq) AS order_id,
               arg_min_null(product_id, seq) AS product_id, arg_min_null(ts, seq) AS created_at,
               max(seq) AS last_seq, arg_max_null(quantity, seq) AS quantity,
               arg_max_null(ts, seq) AS updated_at
        FROM item_events GROUP BY order_item_id""",
    "lines": """
        SELECT i.order_item_id, o.order_id, o.customer_id, i.product_id, o.order_date,
               o.delivery_date, o.status, i.quantity,
               greatest(o.first_seq, i.first_seq) AS first_at,
               greatest(o.last_seq, i.last_seq) AS last_at,
               CASE WHEN o.first_seq >= i.first_seq THEN o.created_at ELSE i.created_at END AS created_at,
               CASE WHEN o.last_seq >= i.last_seq THEN o.updated_at ELSE i.updated_at END AS updated_at
        FROM staged_orders o JOIN staged_items i ON o.order_id = i.order_id""",
    "customer_members": """
        SELECT customer_id, seq, seq AS surrogate FROM customer_changes
        UNION ALL
        SELECT c_custkey, -1, -1 - c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "product_members": """
        SELECT product_id, seq, seq AS surrogate, unity_price FROM product_changes
        UNION ALL
        SELECT p_partkey, -1, -1 - p_partkey, p_retailprice::DECIMAL(13,5)
        FROM part WHERE p_type <> 'PROMO'""",
    "first_customer_members": """
        SELECT customer_id, seq, seq AS surrogate FROM customer_changes
        UNION ALL
        SELECT customer_id, -1, min(seq) FROM customer_changes GROUP BY customer_id""",
    "first_product_members": """
        SELECT product_id, seq, seq AS surrogate, unity_price FROM product_changes
        UNION ALL
        SELECT product_id, -1, min(seq), arg_min(unity_price, seq) FROM product_changes GROUP BY product_id""",
    # A line is settled at the first event of its order or item at which both members are known.
    "settled_lines": """
        WITH needs AS (
          SELECT l.order_item_id,
                 CASE WHEN c.first IS NOT NULL AND p.first IS NOT NULL
                      THEN greatest(l.first_at, c.first, p.first) END AS need
          FROM lines l
          LEFT JOIN (SELECT customer_id, min(seq) AS first FROM {c} GROUP BY 1) c USING (customer_id)
          LEFT JOIN (SELECT product_id, min(seq) AS first FROM {p} GROUP BY 1) p USING (product_id)),
        moves AS (
          SELECT order_item_id, seq, ts FROM item_events
          UNION ALL
          SELECT i.order_item_id, e.seq, e.ts FROM staged_items i JOIN order_events e USING (order_id)),
        settled AS (
          SELECT n.order_item_id, min(m.seq) AS at, arg_min(m.ts, m.seq) AS ts
          FROM needs n JOIN moves m ON m.order_item_id = n.order_item_id AND m.seq >= n.need GROUP BY 1)
        SELECT l.* REPLACE (coalesce(s.at, l.first_at) AS first_at, coalesce(s.ts, l.created_at) AS created_at)
        FROM lines l LEFT JOIN settled s USING (order_item_id)""",
    "resolved": """
        SELECT l.*, c.surrogate AS customer, p.surrogate AS product,
               coalesce(p.unity_price, 0)::DECIMAL(13,5) AS unity_price,
               (l.quantity * coalesce(q.unity_price, 0))::DECIMAL(13,5) AS total_amount
        FROM settled_lines l
        ASOF LEFT JOIN {c} c ON l.customer_id = c.customer_id AND l.first_at >= c.seq
        ASOF LEFT JOIN {p} p ON l.product_id = p.product_id AND l.first_at >= p.seq
        ASOF LEFT JOIN {p} q ON l.product_id = q.product_id AND l.{at} >= q.seq""",
    "fact": """
        SELECT *, lower(status) AS status_lc FROM resolved
        WHERE customer IS NOT NULL AND product IS NOT NULL
          AND order_date BETWEEN 19950101 AND 20011231
          AND (delivery_date IS NULL OR delivery_date BETWEEN 19950101 AND 20011231)""",
    "damaged": """
        SELECT o_orderkey AS seq, o_custkey AS customer_id, o_orderstatus AS status,
               strftime(o_orderdate, '%Y%m%d')::INT AS order_date, o_orderpriority AS priority
        FROM orders""",
    "user_changes": "SELECT user_id, event_type, event_id AS seq, ts FROM events",
    "calendar": """
        SELECT strftime(d, '%Y%m%d')::INT AS dim_date, strftime(d, '%Y-%m-%d') AS calendar_date,
               strftime(d, '%A') AS day_of_week, month(d)::INT AS month, quarter(d)::INT AS quarter,
               year(d)::INT AS year
        FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d)""",
    "order_calendar": """
        SELECT * FROM calendar
        WHERE dim_date BETWEEN (SELECT strftime(min(o_orderdate), '%Y%m%d')::INT FROM orders)
                           AND (SELECT strftime(max(o_orderdate), '%Y%m%d')::INT FROM orders)""",
    "order_days": """
        SELECT strftime(o_orderdate, '%Y%m%d')::INT AS dim_date, count(*) AS order_count
        FROM orders GROUP BY 1""",
}

_LINES = ("order_events", "item_events", "staged_orders", "staged_items", "lines")
_FACT = (
    *_LINES, "customer_changes", "product_changes", "customer_members", "product_members",
    "settled_lines", "resolved", "fact",
)
_FIRST = (
    *_LINES, "customer_changes", "product_changes", "first_customer_members",
    "first_product_members", "settled_lines", "resolved", "fact",
)


def _with(names: tuple[str, ...], body: str, c="customer_members", p="product_members", at="last_at") -> str:
    parts = []
    for name in names:
        text = _CTE[name]
        if name in ("settled_lines", "resolved"):
            text = text.format(c=c, p=p, at=at)
        parts.append(f"{name} AS MATERIALIZED ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


_SHOWN_FACT = """
    SELECT order_id, order_item_id, customer, product, order_date, delivery_date, status, quantity,
           unity_price::DOUBLE AS unity_price, total_amount::DOUBLE AS total_amount, updated_at
    FROM fact"""

_VERSIONS = """
    SELECT {key}, {attrs}, seq AS from_seq, lead(seq) OVER w AS to_seq, ts AS valid_from,
           lead(ts) OVER w AS valid_to, lead(seq) OVER w IS NULL AS is_current
    FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY seq)"""


def _versions(key: str, attrs: str, source: str) -> str:
    return _VERSIONS.format(key=key, attrs=attrs, source=source)


_DIM_CUSTOMERS = f"""
    SELECT v.from_seq AS customer, v.* FROM
      ({_versions("customer_id", "customer_name, customer_address", "customer_changes")}) v
    UNION ALL
    SELECT u.customer, u.customer_id, c.c_name, c.c_mktsegment, u.first_at, f.seq, u.created_at, f.ts, f.seq IS NULL
    FROM (SELECT customer, customer_id, min(first_at) AS first_at, arg_min(created_at, first_at) AS created_at
          FROM fact WHERE customer < 0 GROUP BY ALL) u
    JOIN customer c ON c.c_custkey = u.customer_id
    LEFT JOIN (SELECT customer_id, min(seq) AS seq, arg_min(ts, seq) AS ts FROM customer_changes GROUP BY 1) f
      ON f.customer_id = u.customer_id"""

_DIM_PRODUCTS = _with(
    ("product_changes",),
    f"""SELECT v.from_seq AS product, v.* FROM
        ({_versions("product_id", "product_name, barcode", "product_changes")}) v""",
)

# Dense numbers: customers come first, then products by partition and offset.
_SNAPSHOT_SQL = """
    SELECT n AS product_id, sum(quantity)::BIGINT AS total_pending_quantity FROM (
        SELECT p_partkey, (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY p_partkey % 3, p_partkey // 3) AS n FROM part) p
    JOIN (SELECT l_orderkey, max(l_partkey) AS product_id, max(l_quantity)::INT AS quantity
          FROM lineitem GROUP BY l_orderkey, l_linenumber) i ON i.product_id = p_partkey
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    GROUP BY n"""

_FACT_SQL = _with(_FACT, _SHOWN_FACT)


def _snapshot_fact() -> str:
    """The fact where source rows of 1996-06-01 are versions too."""
    at = "date_diff('day', DATE '1970-01-01', DATE '1996-06-01') * 100000000000000, TIMESTAMP '1996-06-01'"
    sql = _with(_FIRST, _SHOWN_FACT, "first_customer_members", "first_product_members")
    for name, rows in (
        ("customer_changes", f"SELECT c_custkey, {at}, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'"),
        ("product_changes", f"SELECT p_partkey, {at}, p_name, p_brand, p_retailprice::DECIMAL(13,5) FROM part WHERE p_type <> 'PROMO'"),
    ):
        sql = sql.replace(_CTE[name], f"{_CTE[name]} UNION ALL {rows}")
    return sql


def oracle() -> dict[str, str]:
    found = {
        "fact_build": _FACT_SQL,
        "fact_from_log": _FACT_SQL,
        "pending_quantity_without_seq": _SNAPSHOT_SQL,
        "stream_fact_build": _FACT_SQL,
        "stream_replay": _FACT_SQL,
        "stream_scd2": _DIM_PRODUCTS,
        "stream_changed_lines": _with(_LINES, "SELECT * FROM lines"),
        "stream_joined_within": _with(
            ("order_events", "item_events"),
            """SELECT o.order_id, i.order_item_id, arg_min_null(o.customer_id, o.seq) AS customer_id,
                      strftime(arg_min_null(o.od, o.seq), '%Y%m%d')::INT AS order_date,
                      arg_max_null(o.status, o.seq) AS status,
                      strftime(arg_max_null(o.dd, o.seq), '%Y%m%d')::INT AS delivery_date,
                      arg_min_null(i.product_id, i.seq) AS product_id,
                      arg_max_null(i.quantity, i.seq) AS quantity,
                      greatest(min(o.seq), min(i.seq)) AS first_at,
                      greatest(max(o.seq), max(i.seq)) AS last_at
               FROM order_events o JOIN item_events i ON i.order_id = o.order_id
                AND i.ts BETWEEN o.ts - INTERVAL 60 DAY AND o.ts + INTERVAL 60 DAY
               GROUP BY o.order_id, i.order_item_id""",
        ),
        "fact_consistent_price": _with(_FACT, _SHOWN_FACT, at="first_at"),
        "fact_without_sources": _with(
            _FIRST, _SHOWN_FACT, "first_customer_members", "first_product_members"
        ),
        "unresolved_facts": _with(
            _FACT,
            """SELECT order_id, order_item_id, customer_id, product_id, customer, product
               FROM resolved WHERE customer IS NULL OR product IS NULL""",
        ),
        "price_asof_amount": _with(
            ("item_events", "product_changes", "first_product_members"),
            """SELECT i.order_item_id, i.product_id, i.seq, i.quantity,
                      coalesce(p.unity_price, 0)::DOUBLE AS unity_price,
                      (i.quantity * coalesce(p.unity_price, 0))::DECIMAL(13,5)::DOUBLE AS amount
               FROM item_events i ASOF LEFT JOIN first_product_members p
                 ON i.product_id = p.product_id AND i.seq >= p.seq""",
        ),
        "staging_orders": _with(("order_events", "staged_orders"), "SELECT * FROM staged_orders"),
        "staging_orders_keep_delivery": _with(
            ("order_events",),
            """SELECT order_id, arg_max_null(status, seq) AS status,
                      strftime(arg_max(dd, seq), '%Y%m%d')::INT AS delivery_date
               FROM order_events GROUP BY order_id""",
        ),
        "staging_items": _with(("item_events", "staged_items"), "SELECT * FROM staged_items"),
        "staging_join": _with(_LINES, "SELECT * FROM lines"),
        "status_propagation": """
            SELECT o_orderkey AS order_id, o_orderkey * 10 + l_linenumber AS order_item_id,
                   CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
                        WHEN o_orderpriority = '1-URGENT' THEN 'OPEN' ELSE 'Open' END AS status,
                   CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                        WHEN o_orderstatus = 'P' THEN strftime(o_orderdate::DATE + 10, '%Y%m%d')::INT
                        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                        WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate::DATE + 12, '%Y%m%d')::INT
                        ELSE strftime(o_orderdate::DATE + 10, '%Y%m%d')::INT END AS delivery_date
            FROM orders JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) ON l_orderkey = o_orderkey""",
        "pending_orders": _with(
            ("order_events", "staged_orders"),
            """SELECT order_id, customer_id, status FROM staged_orders
               WHERE order_id NOT IN (SELECT l_orderkey FROM lineitem)""",
        ),
        "pending_items": _with(
            ("item_events",),
            """SELECT order_item_id, arg_min(order_id, seq) AS order_id, arg_max(quantity, seq) AS quantity
               FROM item_events GROUP BY order_item_id HAVING arg_min(order_id, seq) NOT IN
                 (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
        ),
        "fact_with_snapshot": _snapshot_fact(),
        "envelope_default_dates": """
            SELECT o_orderkey AS order_id,
                   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN strftime(o_orderdate, '%Y%m%d')
                        ELSE strftime(o_orderdate::DATE - 3, '%Y%m%d') END::INT AS order_date,
                   CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                        THEN strftime(o_orderdate::DATE - 3, '%Y%m%d') END::INT AS delivery_date
            FROM orders""",
        "orders_by_delivery_status": _with(
            _FACT,
            """SELECT delivery_date, status, count(DISTINCT order_id) AS order_count FROM fact
               WHERE lower(status) = 'open' GROUP BY delivery_date, status""",
        ),
        "orders_by_delivery_status_range": _with(
            _FACT,
            """SELECT delivery_date, status, count(DISTINCT order_id) AS order_count FROM fact
               WHERE lower(status) = 'pending' AND delivery_date BETWEEN 19960101 AND 19970630
               GROUP BY delivery_date, status""",
        ),
        "top_delivery_dates": _with(
            _FACT,
            """SELECT delivery_date, count(DISTINCT order_id) AS open_order_count FROM fact
               WHERE lower(status) = 'open' AND delivery_date IS NOT NULL
               GROUP BY delivery_date ORDER BY open_order_count DESC, delivery_date LIMIT 10""",
        ),
        "pending_quantity_by_product": _with(
            _FACT,
            """SELECT product AS product_id, sum(quantity)::BIGINT AS total_pending_quantity FROM fact
               WHERE lower(status) = 'open' GROUP BY product""",
        ),
        "pending_quantity_by_natural_product": _with(
            _FACT,
            """SELECT product_id, sum(quantity)::BIGINT AS total_pending_quantity FROM fact
               WHERE lower(status) = 'pending' GROUP BY product_id""",
        ),
        "top_customers_by_orders": _with(
            _FACT,
            """SELECT customer AS customer_id, count(DISTINCT order_id) AS pending_order_count FROM fact
               WHERE lower(status) = 'open' GROUP BY customer
               ORDER BY pending_order_count DESC, customer LIMIT 20""",
        ),
        "top_natural_customers_by_orders": _with(
            _FACT,
            """SELECT customer_id, count(DISTINCT order_id) AS pending_order_count FROM fact
               WHERE lower(status) = 'completed' GROUP BY customer_id
               ORDER BY pending_order_count DESC, customer_id LIMIT 20""",
        ),
        "report_records": _with(
            _FACT,
            """SELECT '{"delivery_date":' || delivery_date || ',"open_order_count":' || n || '}' AS record
               FROM (SELECT delivery_date, count(DISTINCT order_id) AS n FROM fact
                     WHERE lower(status) = 'pending' AND delivery_date IS NOT NULL
                     GROUP BY delivery_date ORDER BY n DESC, delivery_date LIMIT 100)""",
        ),
        "reports_star_month": _with(
            (*_FACT, "calendar"),
            """SELECT c.year, c.quarter, c.month, f.status, count(*) AS line_count,
                      sum(f.quantity)::BIGINT AS total_quantity, sum(f.total_amount)::DOUBLE AS total_amount
               FROM fact f JOIN calendar c ON c.dim_date = f.order_date GROUP BY ALL""",
        ),
        "star_join": _with(
            (*_FACT, "calendar"),
            """SELECT f.order_item_id,
                      CASE WHEN f.customer < 0 THEN cs.c_name ELSE cc.customer_name END AS customer_name,
                      CASE WHEN f.customer < 0 THEN cs.c_mktsegment ELSE cc.customer_address END AS customer_address,
                      CASE WHEN f.product < 0 THEN ps.p_name ELSE pc.product_name END AS product_name,
                      CASE WHEN f.product < 0 THEN ps.p_brand ELSE pc.barcode END AS barcode,
                      o.day_of_week AS order_day_of_week, o.quarter AS order_quarter,
                      d.month AS delivery_month, d.year AS delivery_year
               FROM fact f
               LEFT JOIN customer cs ON cs.c_custkey = f.customer_id
               LEFT JOIN customer_changes cc ON cc.customer_id = f.customer_id AND cc.seq = f.customer
               LEFT JOIN part ps ON ps.p_partkey = f.product_id
               LEFT JOIN product_changes pc ON pc.product_id = f.product_id AND pc.seq = f.product
               JOIN calendar o ON o.dim_date = f.order_date
               LEFT JOIN calendar d ON d.dim_date = f.delivery_date""",
        ),
        "scd2_versions": _with(("user_changes",), _versions("user_id", "event_type", "user_changes")),
        "scd2_changes_only": _with(
            ("user_changes",),
            _versions(
                "user_id",
                "event_type",
                """(SELECT * FROM user_changes QUALIFY event_type IS DISTINCT FROM
                    lag(event_type) OVER (PARTITION BY user_id ORDER BY seq))""",
            ),
        ),
        "scd2_current": """
            SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS from_seq,
                   arg_max(ts, event_id) AS valid_from FROM events GROUP BY user_id""",
        "scd2_customers": _with(_FACT, _DIM_CUSTOMERS),
        "scd2_products": _DIM_PRODUCTS,
        "surrogate_keys": """
            SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) AS member FROM events""",
        "dim_resolve_asof": """
            SELECT b.user_id, b.event_id AS seq, b.ts, v.event_id AS version, v.event_type AS version_type
            FROM (SELECT * FROM events WHERE event_type = 'purchase') b
            ASOF LEFT JOIN (SELECT * FROM events WHERE event_type IN ('signup', 'view')) v
              ON b.user_id = v.user_id AND b.event_id >= v.event_id""",
        "dim_resolve_current": _with(
            ("customer_changes",),
            """SELECT o_orderkey AS order_id, o_custkey AS customer_id, c.customer
               FROM orders LEFT JOIN (SELECT customer_id, max(seq) AS customer FROM customer_changes GROUP BY 1) c
                 ON c.customer_id = o_custkey""",
        ),
        "inferred_members": _with(
            ("customer_changes",),
            """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_address
               FROM customer WHERE c_mktsegment <> 'MACHINERY'
                 AND c_custkey IN (SELECT o_custkey FROM orders)
                 AND c_custkey NOT IN (SELECT customer_id FROM customer_changes)""",
        ),
        "dim_dates": _with(
            ("calendar", "order_calendar", "order_days"),
            """SELECT c.*, coalesce(n.order_count, 0) AS order_count
               FROM order_calendar c LEFT JOIN order_days n USING (dim_date)""",
        ),
        "dim_dates_insert_missing": _with(
            ("calendar", "order_calendar", "order_days"),
            """SELECT dim_date, CASE WHEN dim_date IN (SELECT dim_date FROM order_days)
                                     THEN 'has orders' ELSE day_of_week END AS day_of_week
               FROM order_calendar""",
        ),
        "date_reference_violations": _with(
            _LINES,
            """SELECT order_item_id, order_date, delivery_date,
                      concat_ws(',',
                        CASE WHEN order_date NOT BETWEEN 19960101 AND 20001231 THEN 'order_date_not_in_calendar' END,
                        CASE WHEN delivery_date NOT BETWEEN 19960101 AND 20001231 THEN 'delivery_date_not_in_calendar' END
                      ) AS reasons
               FROM lines WHERE order_date NOT BETWEEN 19960101 AND 20001231
                  OR delivery_date NOT BETWEEN 19960101 AND 20001231""",
        ),
        "constraint_quarantine": """
            SELECT * FROM (
              SELECT o_orderkey AS order_id, concat_ws(',',
                       CASE WHEN o_orderstatus = 'P' THEN 'status_missing' END,
                       CASE WHEN length(o_orderpriority) > 8 THEN 'note_too_long' END,
                       CASE WHEN o_totalprice::DECIMAL(15,2) * 1000 >= 100000000 THEN 'amount_too_large' END) AS reasons
              FROM orders) WHERE reasons <> ''""",
        "envelope_decode": _with(
            ("damaged",),
            """SELECT seq, seq AS order_id, customer_id, order_date, NULL::INT AS delivery_date, status
               FROM damaged WHERE priority = '1-URGENT'""",
        ),
        "envelope_quarantine": _with(
            ("damaged",),
            """SELECT seq, CASE WHEN priority = '4-NOT SPECIFIED' THEN 'status_missing' ELSE 'malformed' END AS reasons
               FROM damaged WHERE priority IN ('3-MEDIUM', '4-NOT SPECIFIED')
                  OR (priority = '5-LOW' AND status = 'P')""",
        ),
        "route_counts": _with(
            ("order_events", "customer_changes", "product_changes"),
            """SELECT 'orders' AS "table", count(*) AS messages FROM order_events
               UNION ALL SELECT 'order_items', count(*) FROM lineitem
               UNION ALL SELECT 'customers', count(*) FROM customer_changes
               UNION ALL SELECT 'products', count(*) FROM product_changes
               UNION ALL SELECT NULL, count(*) FROM events""",
        ),
        "json_props": "SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events",
        "natural_key_upsert": """
            WITH batch AS (
              SELECT CASE WHEN event_type = 'signup' THEN 'Guest ' || user_id
                          ELSE 'Customer#' || lpad(user_id::VARCHAR, 9, '0') END AS customer_name,
                     arg_max(event_type, event_id) AS customer_address, max(event_id) AS event_id
              FROM events GROUP BY 1)
            SELECT c_custkey AS customer_id, c_name AS customer_name,
                   coalesce(b.customer_address, c_mktsegment) AS customer_address
            FROM customer LEFT JOIN batch b ON b.customer_name = c_name
            UNION ALL
            SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY event_id),
                   customer_name, customer_address
            FROM batch WHERE customer_name NOT IN (SELECT c_name FROM customer)""",
        "open_order_per_customer_day": """
            SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y%m%d')::INT AS order_date,
                   min(o_orderkey) AS order_id
            FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2""",
        "id_list": """
            SELECT n // 1000 AS page, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS ids
            FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer)
            GROUP BY 1""",
    }
    # The reports that the stream keeps are those over the fact table.
    for name in ("orders_by_delivery_status", "pending_quantity_by_product", "top_customers_by_orders"):
        found[f"stream_{name}"] = found[name]
    return found

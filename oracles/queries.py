"""One SQL text per registered query."""

from __future__ import annotations

from oracles.base import sql

ORACLES: dict[str, str] = {}

LATE = "starts_with(delivery_status, 'late')"
ON_TIME = "delivery_status IN ('early', 'on_time')"


def days(hours: str, name: str) -> str:
    return f"{hours} / 24e0 AS {name}"


def mean(hours: str, name: str) -> str:
    return f"{mean_of(hours)} AS {name}"


def mean_of(hours: str) -> str:
    return f"round(CAST(sum({hours}) AS DOUBLE) / nullif(24e0 * count({hours}), 0), 6)"


def money(column: str, where: str = "true") -> str:
    return f"CAST(coalesce(sum({column}::DECIMAL(18,2)) FILTER ({where}), 0) AS DOUBLE)"


def share(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def case_label(column: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{value}' THEN '{label}'" for value, label in labels.items())
    return f"CASE {column} {arms} END"


# Names and how they are shown, apart from the code's so that the check is its own.
STATUS = {
    "early": "Early",
    "on_time": "On time",
    "late_1_3_days": "1–3 days late",
    "late_4_7_days": "4–7 days late",
    "late_8_plus_days": "8+ days late",
    "not_delivered": "Not delivered",
}
STAGE = {"approval": "Approval", "seller_handling": "Seller handling", "transit": "Transit"}
BAND = {
    "1. same_city": "Same city",
    "2. same_state": "Same state",
    "3. cross_state": "Cross-state",
    "4. unknown": "Unknown (no seller)",
}
SHAPE = {
    "single_seller_normal_handoff": "Single seller (normal handoff)",
    "single_seller_slow_handoff": "Single seller (slow handoff)",
    "multi_seller": "Multi-seller",
    "unclassified": "Unclassified",
}
REASON = {
    "no_items_on_order": "No items on order",
    "never_approved_or_shipped": "Never approved or shipped",
    "approval_timestamp_missing": "Approval timestamp missing",
    "never_handed_to_carrier": "Never handed to carrier",
}


def place(column: str, values: dict[str, str] | list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CAST(list_position([{listed}], {column}) AS INTEGER)"


STAGE_COLUMNS = ", ".join(
    [
        days("h_approval", "approval_delay_days"),
        days("h_handling", "seller_handling_days"),
        days("h_transit", "transit_days"),
        days("h_total", "total_delivery_days"),
        days("h_delay", "delivery_delay_days"),
    ]
)
MILESTONES = """order_status, order_purchase_at, order_approved_at, order_delivered_carrier_at,
    order_delivered_customer_at, order_estimated_delivery_at"""

ORACLES["stg_orders"] = sql("SELECT * FROM stg_orders")
ORACLES["stg_order_items"] = sql("SELECT * FROM items")
ORACLES["stg_order_reviews"] = sql("SELECT * FROM reviews")
ORACLES["stg_geolocation"] = sql(
    "SELECT * FROM stg_geolocation"
)
ORACLES["product_buckets"] = sql("SELECT * FROM buckets")
ORACLES["order_delivery_stages"] = sql(
    f"SELECT order_id, customer_id, {MILESTONES}, {STAGE_COLUMNS}, delivery_status FROM stages"
)

_SHAPES = f"""SELECT order_id, order_status, delivery_status, {days('h_transit', 'transit_days')},
    {days('h_total', 'total_delivery_days')}, {days('h_delay', 'delivery_delay_days')},
    {days('h_handling', 'seller_handling_days')},
    {days('h_sla', 'carrier_handoff_vs_limit_days')},
    unclassified_reason, order_shape, distance_band FROM shapes"""
ORACLES["order_transit_shape"] = sql(_SHAPES)
ORACLES["order_transit_shape_strict"] = sql(_SHAPES, slow=2, breach=1)

ORACLES["seller_customer_distance"] = sql(
    """SELECT order_id, seller_id, round(seller_lat, 6) AS seller_lat,
    round(seller_lng, 6) AS seller_lng, round(customer_lat, 6) AS customer_lat,
    round(customer_lng, 6) AS customer_lng, round(distance_meters, 3) AS distance_meters
    FROM distances"""
)
ORACLES["place_distances"] = sql(
    """SELECT DISTINCT s.seller_zip_code_prefix, c.customer_zip_code_prefix,
    round(distance_meters, 3) AS distance_meters
    FROM distances d JOIN dim_seller s USING (seller_id) JOIN stages o USING (order_id)
    JOIN dim_customer c ON c.customer_id = o.customer_id"""
)
ORACLES["distance_by_place"] = sql(
    "SELECT order_id, seller_id, round(distance_meters, 3) AS distance_meters FROM distances"
)
ORACLES["items_with_distance"] = sql(
    """SELECT seller_id, count(*) AS items, count(distance_meters) AS located_items,
    round(max(distance_meters), 3) AS farthest_meters
    FROM items LEFT JOIN distances USING (order_id, seller_id) GROUP BY seller_id"""
)
ORACLES["fact_orders"] = sql(
    f"""SELECT order_id, order_item_id, customer_id, seller_id, product_id, is_order_header_row,
    {MILESTONES}, item_shipping_limit_at, item_price, item_freight, {STAGE_COLUMNS},
    delivery_status, item_count, distinct_seller_count, order_revenue, order_freight,
    avg_review_score, review_count FROM fact"""
)
ORACLES["dim_customer"] = sql("SELECT * FROM dim_customer")
ORACLES["dim_seller"] = sql("SELECT * FROM dim_seller")
ORACLES["dim_products"] = sql("SELECT * FROM dim_products")
_DATES = """, dates AS (
    SELECT CAST(unnest(generate_series(
        date_trunc('year', min(order_purchase_at)),
        date_trunc('year', max(order_purchase_at)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
        INTERVAL 1 DAY)) AS DATE) AS d
    FROM stg_orders)"""
ORACLES["dim_date"] = sql(
    _DATES
    + """
    SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%Y-%m') AS year_month, monthname(d) AS month_name,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    dayofweek(d) IN (0, 6) AS is_weekend FROM dates"""
)
ORACLES["dim_geolocation"] = sql(
    """SELECT zip_code_prefix, city, state, round(centroid_lng, 6) AS centroid_lng,
    round(centroid_lat, 6) AS centroid_lat FROM dim_geolocation"""
)

MONTH = "CAST(date_trunc('month', order_purchase_at) AS DATE)"

ORACLES["mart_delivery_kpis"] = sql(
    f"""SELECT {MONTH} AS order_month, customer_state, count(*) AS order_count,
    count(*) FILTER (delivery_status = 'not_delivered') AS not_delivered_count,
    count(*) FILTER ({ON_TIME}) AS on_time_count, count(*) FILTER ({LATE}) AS late_count,
    round({share(f'count(*) FILTER ({LATE})', 'count(*)')}, 6) AS late_pct,
    {mean('h_total', 'avg_delivery_days')}, {mean('h_handling', 'avg_seller_handling_days')},
    {mean('h_transit', 'avg_transit_days')}, {money('order_revenue')} AS total_revenue
    FROM fact JOIN dim_customer USING (customer_id) WHERE is_order_header_row
    GROUP BY ALL"""
)
_SALES = f"""SELECT {MONTH} AS order_month, count(DISTINCT order_id) AS order_count,
    {money('order_revenue')} AS total_revenue, {money('order_freight')} AS total_freight,
    round({share(money('order_revenue'), 'count(DISTINCT order_id)')}, 6) AS avg_order_value
    FROM fact WHERE is_order_header_row GROUP BY ALL"""
ORACLES["mart_monthly_sales"] = sql(_SALES)
_SATISFACTION = f"""SELECT delivery_status, count(*) AS order_count,
    avg(avg_review_score) AS avg_review_score, {mean('h_total', 'avg_delivery_days')},
    {mean('h_delay', 'avg_delivery_delay_days')}
    FROM fact WHERE is_order_header_row AND avg_review_score IS NOT NULL GROUP BY ALL"""
ORACLES["mart_satisfaction_by_delivery"] = sql(
    f"SELECT * REPLACE (round(avg_review_score, 6) AS avg_review_score) FROM ({_SATISFACTION})"
)
_STAGES = f"""SELECT stage, total_days, total_days / sum(total_days) OVER () AS pct_of_delay
    FROM (
        SELECT unnest(['approval', 'seller_handling', 'transit']) AS stage,
               unnest([sum(h_approval), sum(h_handling), sum(h_transit)]) / 24e0 AS total_days
        FROM fact WHERE is_order_header_row AND {LATE})"""
ORACLES["mart_delivery_delay_stages"] = sql(
    f"""SELECT stage, round(total_days, 6) AS total_days, round(pct_of_delay, 6) AS pct_of_delay
    FROM ({_STAGES})"""
)
_CATEGORY = f"""SELECT s.product_category_buckets, s.size AS product_size_buckets,
    count(*) AS product_item_count, {mean('h_total', 'avg_delivery_days')},
    count(*) FILTER (delivery_status = 'not_delivered') AS not_delivered_item_count,
    count(*) FILTER ({ON_TIME}) AS on_time_item_count, count(*) FILTER ({LATE}) AS late_item_count,
    {share(f'count(*) FILTER ({LATE})', 'count(*)')} AS late_item_pct,
    {money('item_price')} AS total_revenue, {money('item_freight')} AS total_freight,
    {share(money('item_price'), 'count(*)')} AS avg_revenue_per_item,
    {share(money('item_freight'), 'count(*)')} AS avg_freight_per_item
    FROM fact JOIN sized s USING (product_id) GROUP BY ALL"""
ORACLES["mart_pdt_delivery"] = sql(
    f"""SELECT * REPLACE (round(late_item_pct, 6) AS late_item_pct,
    round(avg_revenue_per_item, 6) AS avg_revenue_per_item,
    round(avg_freight_per_item, 6) AS avg_freight_per_item) FROM ({_CATEGORY})"""
)


def _zones(other_side: str) -> str:
    """Items joined to another table of the order; the number of its rows is the weight."""
    return f"""SELECT 'Zone ' || (1 + (distance_meters > 100000)::INT
        + (distance_meters > 500000)::INT + (distance_meters > 1500000)::INT) AS distance_bucket,
    z.size AS size_bucket, count(*) AS order_item_count,
    {share(f'count(*) FILTER ({LATE})', 'count(*)')} AS late_pct
    FROM items i JOIN sized z USING (product_id) JOIN distances d USING (order_id, seller_id)
    JOIN {other_side} f USING (order_id)
    WHERE distance_meters IS NOT NULL
    GROUP BY ALL"""


_ROUNDED_ZONES = "SELECT * REPLACE (round(late_pct, 6) AS late_pct) FROM ({0})"
ORACLES["mart_delay_pdt_vs_dist"] = sql(_ROUNDED_ZONES.format(_zones("fact")))
ORACLES["mart_delay_pdt_vs_dist_item_grain"] = sql(_ROUNDED_ZONES.format(_zones("stages")))
_SELLER_PERF = f"""SELECT seller_id, seller_city, seller_state, count(*) AS seller_item_count,
    count(DISTINCT order_id) AS seller_order_count,
    count(*) FILTER (delivery_status = 'not_delivered') AS not_delivered_item_count,
    count(*) FILTER ({ON_TIME}) AS on_time_item_count, count(*) FILTER ({LATE}) AS late_item_count,
    round({share(f'count(*) FILTER ({LATE})', 'count(*)')}, 6) AS late_item_pct,
    {money('item_price')} AS seller_total_revenue
    FROM fact JOIN dim_seller USING (seller_id) GROUP BY ALL"""
ORACLES["mart_seller_perf"] = sql(_SELLER_PERF)
_SHIPPED = "order_delivered_carrier_at IS NOT NULL AND shipping_limit_date IS NOT NULL"
_SHIPPED_LATE = "order_delivered_carrier_at > shipping_limit_date"
_LATE_ORDERS = f"count(DISTINCT order_id) FILTER ({LATE})"
_KNOWN_ORDERS = "count(DISTINCT order_id) FILTER (delivery_status IS NOT NULL)"
_PERFORMANCE = f"""SELECT seller_id, count(DISTINCT order_id) AS order_count,
    count(*) AS item_count, {money('price')} AS total_revenue,
    {money('freight_value')} AS total_freight,
    count(*) FILTER ({_SHIPPED}) AS shipping_item_count,
    count(*) FILTER ({_SHIPPED_LATE}) AS late_shipping_item_count,
    {share(f'count(*) FILTER ({_SHIPPED_LATE})', f'count(*) FILTER ({_SHIPPED})')}
        AS late_shipping_pct,
    {_LATE_ORDERS} AS late_delivery_order_count, {_KNOWN_ORDERS} AS delivered_order_count,
    {share(_LATE_ORDERS, _KNOWN_ORDERS)} AS late_delivery_pct,
    {mean('h_total', 'avg_delivery_days')}
    FROM items LEFT JOIN stages USING (order_id) GROUP BY seller_id"""
_ROUND_SHARES = """* REPLACE (round(late_shipping_pct, 6) AS late_shipping_pct,
    round(late_delivery_pct, 6) AS late_delivery_pct)"""
ORACLES["mart_seller_performance"] = sql(f"SELECT {_ROUND_SHARES} FROM ({_PERFORMANCE})")


def _risk(rows: str) -> str:
    late_revenue = money("order_revenue", LATE)
    return f"""SELECT customer_state, count(*) AS total_orders,
    {money('order_revenue')} AS total_revenue, count(*) FILTER ({LATE}) AS late_orders,
    {late_revenue} AS late_revenue,
    {share(f'count(*) FILTER ({LATE})', 'count(*)')} AS late_delivery_pct,
    {share(late_revenue, money('order_revenue'))} AS late_revenue_pct
    FROM {rows} JOIN dim_customer USING (customer_id)
    WHERE customer_state IS NOT NULL GROUP BY ALL"""


_ROUND_RISK = """SELECT * REPLACE (round(late_delivery_pct, 6) AS late_delivery_pct,
    round(late_revenue_pct, 6) AS late_revenue_pct) FROM ({0})"""
ORACLES["mart_delivery_revenue_risk"] = sql(_ROUND_RISK.format(_risk("fact")))
ORACLES["mart_delivery_revenue_risk_order_grain"] = sql(_ROUND_RISK.format(_risk("header")))


def _sunburst(rows: str) -> str:
    return f"""SELECT customer_state, delivery_status, count(*) AS order_count,
    {money('order_revenue')} AS revenue
    FROM {rows} JOIN dim_customer USING (customer_id)
    WHERE customer_state IN (
        SELECT customer_state FROM {rows} LEFT JOIN dim_customer USING (customer_id)
        GROUP BY customer_state
        ORDER BY sum(order_revenue::DECIMAL(18,2)) DESC, count(*) DESC, customer_state LIMIT 10)
    GROUP BY ALL"""


ORACLES["mart_delivery_sunburst"] = sql(_sunburst("fact"))
ORACLES["mart_delivery_sunburst_order_grain"] = sql(_sunburst("header"))

_DELIVERED = "count(*) FILTER (delivery_status <> 'not_delivered')"
_DRIVERS = f"""SELECT order_shape, distance_band, count(*) AS order_count,
    count(h_transit) AS delivered_order_count, {mean('h_transit', 'avg_transit_days')},
    round(quantile_disc(h_transit, 0.5) / 24e0, 6) AS median_transit_days,
    round(quantile_disc(h_transit, 0.9) / 24e0, 6) AS p90_transit_days,
    {mean('h_handling', 'avg_seller_handling_days')},
    {mean('h_total', 'avg_total_delivery_days')}, {mean('h_delay', 'avg_delivery_delay_days')},
    {mean('h_sla', 'avg_carrier_handoff_vs_limit_days')},
    {share(f'count(*) FILTER ({LATE})', _DELIVERED)} AS late_pct,
    count(*) / CAST((SELECT count(*) FROM shapes) AS DOUBLE) AS pct_of_orders
    FROM shapes GROUP BY order_shape, distance_band"""
ORACLES["mart_transit_drivers"] = sql(
    f"""SELECT * REPLACE (round(late_pct, 6) AS late_pct,
    round(pct_of_orders, 6) AS pct_of_orders) FROM ({_DRIVERS})"""
)
_UNCLASSIFIED = f"""SELECT distance_band, unclassified_reason, order_status,
    count(*) AS order_count, count(h_transit) AS delivered_order_count,
    {mean('h_transit', 'avg_transit_days')}
    FROM shapes WHERE order_shape = 'unclassified' GROUP BY ALL"""
ORACLES["mart_transit_unclassified"] = sql(_UNCLASSIFIED)


# Data quality


def _summary(checks: dict[str, str]) -> str:
    return sql(
        _DATES
        + "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS "check", CAST(({count}) AS BIGINT) AS failing_rows"""
            for name, count in checks.items()
        )
    )


def _repeated(table: str, columns: str) -> str:
    return f"""SELECT count(*) FROM (
        SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)"""


def _nulls(table: str, column: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"


def _orphans(table: str, column: str, parent: str, field: str) -> str:
    return f"""SELECT count(*) FROM {table} t WHERE {column} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = t.{column})"""


ORACLES["dq_unique"] = _summary(
    {
        "dim_customer.customer_id": _repeated("dim_customer", "customer_id"),
        "dim_date.date_key": "SELECT count(*) - count(DISTINCT d) FROM dates",
        "dim_products.product_id": _repeated("dim_products", "product_id"),
        "dim_seller.seller_id": _repeated("dim_seller", "seller_id"),
        "dim_geolocation.zip_code_prefix": _repeated("dim_geolocation", "zip_code_prefix"),
        "mart_seller_perf.seller_id": _repeated(f"({_SELLER_PERF})", "seller_id"),
        "mart_seller_performance.seller_id": _repeated(f"({_PERFORMANCE})", "seller_id"),
        "mart_delivery_delay_stages.stage": _repeated(f"({_STAGES})", "stage"),
        "customers.customer_city": _repeated("dim_customer", "customer_city"),
    }
)
ORACLES["dq_not_null"] = _summary(
    {
        "dim_customer.customer_id": _nulls("dim_customer", "customer_id"),
        "dim_customer.customer_state": _nulls("dim_customer", "customer_state"),
        "dim_date.date_key": _nulls("dates", "d"),
        "dim_products.product_id": _nulls("dim_products", "product_id"),
        "dim_products.product_weight_g": _nulls("dim_products", "product_weight_g"),
        "dim_seller.seller_id": _nulls("dim_seller", "seller_id"),
        "dim_geolocation.zip_code_prefix": _nulls("dim_geolocation", "zip_code_prefix"),
        "fact_orders.order_id": _nulls("fact", "order_id"),
        "fact_orders.is_order_header_row": _nulls("fact", "is_order_header_row"),
        "fact_orders.customer_id": _nulls("fact", "customer_id"),
        "fact_orders.seller_id": _nulls("fact", "seller_id"),
        "mart_seller_perf.seller_id": _nulls(f"({_SELLER_PERF})", "seller_id"),
        "mart_delivery_delay_stages.stage": _nulls(f"({_STAGES})", "stage"),
        "mart_delivery_delay_stages.pct_of_delay": _nulls(f"({_STAGES})", "pct_of_delay"),
        "mart_transit_drivers.order_shape": _nulls(f"({_DRIVERS})", "order_shape"),
        "mart_transit_drivers.distance_band": _nulls(f"({_DRIVERS})", "distance_band"),
        "mart_transit_drivers.order_count": _nulls(f"({_DRIVERS})", "order_count"),
        "mart_transit_unclassified.unclassified_reason": _nulls(
            f"({_UNCLASSIFIED})", "unclassified_reason"
        ),
        "mart_transit_unclassified.order_count": _nulls(f"({_UNCLASSIFIED})", "order_count"),
        "mart_pdt_delivery.product_category_buckets": _nulls(
            f"({_CATEGORY})", "product_category_buckets"
        ),
        "mart_pdt_delivery.product_size_buckets": _nulls(f"({_CATEGORY})", "product_size_buckets"),
        "mart_seller_performance.seller_id": _nulls(f"({_PERFORMANCE})", "seller_id"),
        "mart_seller_performance.late_delivery_pct": _nulls(
            f"({_PERFORMANCE})", "late_delivery_pct"
        ),
    }
)
ORACLES["dq_relationships"] = _summary(
    {
        "fact_orders.customer_id": _orphans("fact", "customer_id", "dim_customer", "customer_id"),
        "fact_orders.seller_id": _orphans("fact", "seller_id", "dim_seller", "seller_id"),
        "mart_seller_perf.seller_id": _orphans(
            f"({_SELLER_PERF})", "seller_id", "dim_seller", "seller_id"
        ),
        "fact_orders.product_id": _orphans("fact", "product_id", "dim_products", "product_id"),
        "dim_customer.customer_zip_code_prefix": _orphans(
            "dim_customer", "customer_zip_code_prefix", "dim_geolocation", "zip_code_prefix"
        ),
    }
)
ORACLES["dq_unique_combo"] = _summary(
    {
        "fact_orders": _repeated("fact", "order_id, order_item_id"),
        "mart_transit_drivers": _repeated(f"({_DRIVERS})", "order_shape, distance_band"),
        "mart_transit_unclassified": _repeated(
            f"({_UNCLASSIFIED})", "distance_band, unclassified_reason, order_status"
        ),
        "order_items by order and product": _repeated("items", "order_id, product_id"),
    }
)


def _outside(table: str, column: str, allowed: dict[str, str] | list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in allowed)
    return f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({listed})"


ORACLES["dq_in_set"] = _summary(
    {
        "fact_orders.delivery_status": _outside("fact", "delivery_status", STATUS),
        "mart_delivery_delay_stages.stage": _outside(f"({_STAGES})", "stage", STAGE),
        "mart_transit_drivers.order_shape": _outside(f"({_DRIVERS})", "order_shape", SHAPE),
        "mart_transit_drivers.distance_band": _outside(f"({_DRIVERS})", "distance_band", BAND),
        "mart_transit_unclassified.unclassified_reason": _outside(
            f"({_UNCLASSIFIED})", "unclassified_reason", REASON
        ),
        "mart_pdt_delivery.product_size_buckets": _outside(
            f"({_CATEGORY})", "product_size_buckets", ["S", "M", "L", "XL"]
        ),
    }
)
ORACLES["dq_between"] = _summary(
    {
        f"fact_orders.item_freight 0..{most}": f"""SELECT count(*) FROM fact
            WHERE NOT item_freight BETWEEN 0 AND {most}"""
        for most in (500, 250)
    }
)
ORACLES["dq_pair_greater"] = _summary(
    {
        "delivered after purchase": """SELECT count(*) FROM fact
            WHERE order_delivered_customer_at <= order_purchase_at""",
        "estimate not before delivery": """SELECT count(*) FROM fact
            WHERE order_estimated_delivery_at < order_delivered_customer_at""",
    }
)
ORACLES["dq_header_invariant"] = _summary(
    {
        "one header row per order": """SELECT count(*) FROM (SELECT order_id FROM fact
            GROUP BY order_id HAVING count(*) FILTER (is_order_header_row) <> 1)"""
    }
)


# Reconciliation: both sides of every check are computed from the items and their copies.

_VALUES = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
_COLUMNS = [*_VALUES[:4], "shipping_limit_date", *_VALUES[4:]]
_KEYS = "order_id || chr(1) || order_item_id"


def _numbers(side: str, columns: list[str]) -> str:
    """One row of everything that the checks compare."""
    totals = [f"sum({c})::DOUBLE AS total_{c}" for c in columns if c in _VALUES]
    gaps = [f"count(*) - count({c}) AS missing_{c}" for c in columns]
    keys = f"count(DISTINCT {_KEYS}) AS keys, string_agg(DISTINCT {_KEYS}, ';' ORDER BY {_KEYS}) AS key_set"
    return f"{side} AS (SELECT count(*) AS n, {keys}, {', '.join(totals + gaps)} FROM {side}_rows)"


def _differing(layer: str, kind: str, columns: list[str], absent: str = "") -> str:
    """The columns that differ, as the findings name them; numbers are left out."""
    near = "abs(s.{0} - l.{0}) <= greatest(1e-9 * greatest(abs(s.{0}), abs(l.{0})), 1e-6)"
    same = near if kind == "total" else "s.{0} = l.{0}"
    named = [
        f"CASE WHEN NOT ({same.format(f'{kind}_{c}')}) THEN '{c}: source= {layer}=' END"
        for c in columns
    ]
    named += [f"'{absent}: source= {layer}='"] if absent else []
    return f"array_to_string(list_sort(list_filter([{', '.join(named)}], lambda x: x IS NOT NULL)), '; ')"


def _findings(layer: str, columns: list[str]) -> str:
    absent = [c for c in _COLUMNS if c not in columns]
    checks = {
        "columns": f"'{'absent: ' + ', '.join(absent) if absent else ''}'",
        "row_count": f"if(s.n = l.n, '', 'source= {layer}=')",
        "distinct_keys": f"if(s.keys = l.keys, '', 'source= {layer}=')",
        "key_fingerprint": f"if(s.key_set = l.key_set, '', 'source= {layer}=')",
        "missing_values": _differing(layer, "missing", columns),
        "numeric_totals": _differing(
            layer, "total", [c for c in columns if c in _VALUES], "".join(absent)
        ),
    }
    return "\nUNION ALL\n".join(
        f"""SELECT 'order_items' AS "table", '{check}' AS "check", '{layer}' AS layer, {found} AS d
        FROM source s, {layer} l"""
        for check, found in checks.items()
    )


_SWAPPED = [c for c in _COLUMNS if c != "freight_value"]
_RECONCILED = f""", source_rows AS (SELECT * FROM items),
prices_rows AS (
    SELECT * REPLACE (price + if(order_id % 1000 = 7, 100, 0) AS price) FROM items),
sellers_rows AS (
    SELECT * EXCLUDE (freight_value)
        REPLACE (CASE WHEN order_id % 1000 <> 7 THEN seller_id END AS seller_id) FROM items),
{_numbers("source", _COLUMNS)}, {_numbers("prices", _COLUMNS)}, {_numbers("sellers", _SWAPPED)},
findings AS (
    SELECT "table", "check", layer, d = '' AS ok,
           CASE WHEN d <> '' THEN d WHEN "check" = 'columns' THEN 'all present' ELSE 'match' END
               AS detail
    FROM ({_findings("prices", _COLUMNS)}
    UNION ALL {_findings("sellers", _SWAPPED)}))"""
ORACLES["reconcile_items_mutated"] = sql(f"{_RECONCILED} SELECT * FROM findings")
ORACLES["reconcile_report"] = sql(
    f"""{_RECONCILED} SELECT layer, count(*) AS checks, count(*) FILTER (NOT ok) AS failures
    FROM findings GROUP BY layer"""
)
ORACLES["reconcile_orders"] = """SELECT * FROM (VALUES
    ('orders', 'columns', 'landing', true, 'all present'),
    ('orders', 'row_count', 'landing', (SELECT count(*) > 0 FROM orders), 'match'),
    ('orders', 'missing_values', 'landing', true, 'match'),
    ('orders', 'numeric_totals', 'landing', true, 'match'),
    ('orders', 'distinct_keys', 'landing', true, 'match'),
    ('orders', 'key_fingerprint', 'landing', true, 'match'),
    ('orders', 'reachable', 'raw', false, NULL)) f("table", "check", layer, ok, detail)"""
_PARTS = ", ".join(
    f"sum(CAST('0x' || substr(digest, {1 + 8 * i}, 8) AS BIGINT)::DECIMAL(38,0)) AS part_{i}"
    for i in range(8)
)
ORACLES["reconcile_key_digest"] = sql(
    f"""SELECT distinct_keys, sha256(concat_ws(':', distinct_keys, {', '.join(f'part_{i}' for i in range(8))}))
        AS fingerprint
    FROM (SELECT count(*) AS distinct_keys, {_PARTS}
          FROM (SELECT DISTINCT sha256(order_id || chr(1) || order_item_id) AS digest FROM items))"""
)
ORACLES["reconcile_key_differences"] = sql(
    """SELECT CAST(order_id AS VARCHAR) AS key, 'source' AS side FROM stg_orders
    WHERE order_id NOT IN (SELECT order_id FROM items)
    UNION ALL
    SELECT DISTINCT CAST(order_id AS VARCHAR), 'layer' FROM items
    WHERE order_id NOT IN (SELECT order_id FROM stg_orders)"""
)
ORACLES["distinct_composite_keys"] = sql(
    """SELECT count(*) AS n
    FROM (SELECT DISTINCT product_weight_g, product_photos_qty FROM dim_products)"""
)


# Exploration

ORACLES["n1_row_counts"] = sql(
    _DATES
    + "\nUNION ALL\n".join(
        f"""SELECT '{schema}' AS dataset, '{name}' AS "table", count(*) AS row_count FROM {rows}"""
        for schema, name, rows in [
            ("warehouse", "stg_orders", "stg_orders"),
            ("warehouse", "stg_order_items", "items"),
            ("warehouse", "stg_order_reviews", "reviews"),
            ("warehouse", "stg_customers", "dim_customer"),
            ("warehouse", "int_order_delivery_stages", "stages"),
            ("warehouse", "dim_customer", "dim_customer"),
            ("warehouse", "dim_date", "dates"),
            ("warehouse", "fact_orders", "fact"),
            (
                "reporting",
                "mart_delivery_kpis",
                f"""(SELECT DISTINCT {MONTH}, customer_state
                FROM header JOIN dim_customer USING (customer_id))""",
            ),
            ("reporting", "mart_satisfaction_by_delivery", f"({_SATISFACTION})"),
            ("reporting", "mart_monthly_sales", f"({_SALES})"),
        ]
    )
)
_PROFILED = [
    "order_purchase_at",
    "order_approved_at",
    "order_delivered_carrier_at",
    "order_delivered_customer_at",
    "order_estimated_delivery_at",
    "avg_review_score",
    "delivery_status",
]
_PERCENT_OF_ROWS = 'round_even("count" / CAST((SELECT count(*) FROM fact) AS DOUBLE) * 100, 1)'
ORACLES["n2_null_profile"] = sql(
    f"SELECT *, CAST({_PERCENT_OF_ROWS} AS DOUBLE) AS pct_of_total FROM ("
    + """SELECT 'total_rows' AS measure, count(*) AS "count" FROM fact UNION ALL """
    + " UNION ALL ".join(
        f"SELECT 'null_{c}', count(*) FROM fact WHERE {c} IS NULL" for c in _PROFILED
    )
    + ")"
)
ORACLES["n3_date_coverage"] = sql(
    """SELECT min(order_purchase_at) AS earliest_order, max(order_purchase_at) AS latest_order,
    min(order_delivered_customer_at) AS earliest_delivery,
    max(order_delivered_customer_at) AS latest_delivery FROM stg_orders"""
)
ORACLES["n4_status_distribution"] = sql(
    f"""SELECT * REPLACE (round(avg_review_score, 6) AS avg_review_score),
    {place('delivery_status', STATUS)} AS position FROM ({_SATISFACTION})"""
)


def _time_columns() -> str:
    raw_names = {
        "order_purchase_at": "order_purchase_timestamp",
        "order_delivered_carrier_at": "order_delivered_carrier_date",
        "order_delivered_customer_at": "order_delivered_customer_date",
        "order_estimated_delivery_at": "order_estimated_delivery_date",
    }
    # table, CTE, ordinal, column in the CTE, type, name in the raw table
    columns = [
        ("orders", "stg_orders", 3, "order_status", "string"),
        ("orders", "stg_orders", 4, "order_purchase_at", "timestamp_ntz"),
        ("orders", "stg_orders", 5, "order_approved_at", "timestamp_ntz"),
        ("orders", "stg_orders", 6, "order_delivered_carrier_at", "timestamp_ntz"),
        ("orders", "stg_orders", 7, "order_delivered_customer_at", "timestamp_ntz"),
        ("orders", "stg_orders", 8, "order_estimated_delivery_at", "timestamp_ntz"),
        ("order_items", "items", 4, "shipping_limit_date", "timestamp_ntz"),
        ("order_reviews", "reviews", 4, "review_creation_date", "timestamp_ntz"),
        ("order_reviews", "reviews", 5, "review_answer_timestamp", "timestamp_ntz"),
        ("customers", "dim_customer", 5, "customer_state", "string"),
        ("sellers", "dim_seller", 4, "seller_state", "string"),
        ("products", "raw_products", 2, "product_category_name", "string"),
        ("geolocation", "stg_geolocation", 1, "zip_code_prefix", "string"),
        ("geolocation", "stg_geolocation", 2, "latitude", "double"),
        ("geolocation", "stg_geolocation", 3, "longitude", "double"),
        ("geolocation", "stg_geolocation", 4, "city", "string"),
        ("geolocation", "stg_geolocation", 5, "state", "string"),
        ("product_category_name_translation", "buckets", 1, "product_category_name", "string"),
        (
            "product_category_name_translation",
            "buckets",
            2,
            "product_category_name_english",
            "string",
        ),
    ]
    listed = []
    for table, cte, ordinal, column, kind in columns:
        name = raw_names.get(column, column)
        if table == "geolocation":
            name = "geolocation_" + {"latitude": "lat", "longitude": "lng"}.get(column, column)
        listed.append(
            f"""SELECT '{table}' AS table_name, {ordinal} AS ordinal_position,
            '{name}' AS column_name, '{kind}' AS data_type, count({column}) AS value_count
            FROM {cte}"""
        )
    return f"""SELECT *, data_type LIKE 'timestamp%' AS is_time_valued,
        data_type LIKE 'timestamp%' AND column_name LIKE '%deliver%' AS is_delivery_event
        FROM ({' UNION ALL '.join(listed)})
        WHERE data_type LIKE 'timestamp%' OR column_name LIKE '%date%' OR column_name LIKE '%_at%'"""


ORACLES["n5_time_columns"] = sql(_time_columns())

_GROUP = "if(sellers > 1, 'multi-seller', 'single-seller')"
ORACLES["n6_deadline_spread"] = sql(
    f"""SELECT {_GROUP} AS grp, count(*) AS orders, round(avg(n), 2) AS avg_items,
    round(quantile_disc(spread, 0.5) / 24e0, 2) AS median_limit_spread_days,
    round(avg((spread > 24)::INT) * 100, 1) AS pct_orders_limits_over_1_day,
    round(avg(freight), 2) AS mean_freight_per_item
    FROM (SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS sellers,
                 date_sub('hour', min(shipping_limit_date), max(shipping_limit_date)) AS spread,
                 avg(freight_value) AS freight
          FROM items GROUP BY order_id)
    WHERE n > 1 GROUP BY ALL"""
)
ORACLES["n7_seller_states"] = sql(
    """SELECT count(*) FILTER (sellers > 1) AS multi_seller_orders,
    count(*) FILTER (sellers > 1 AND states > 1) AS sellers_in_different_states,
    round(CAST(count(*) FILTER (sellers > 1 AND states > 1) AS DOUBLE)
          / nullif(count(*) FILTER (sellers > 1), 0) * 100, 1) AS pct_different_states
    FROM (SELECT order_id, count(DISTINCT seller_id) AS sellers,
                 count(DISTINCT seller_state) AS states
          FROM items JOIN dim_seller USING (seller_id) GROUP BY order_id)"""
)
ORACLES["n8_controlled_transit"] = sql(
    f"""SELECT if(states = 1 AND state = customer_state IS NOT FALSE, 'same-state', 'cross-state')
        AS distance_band,
    {_GROUP} AS grp, count(*) AS orders, round(avg(n), 2) AS avg_items,
    round(quantile_disc(h_transit, 0.5) / 24e0, 2) AS median_transit_days,
    round({mean_of('h_transit')}, 2) AS mean_transit_days
    FROM (SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS sellers,
                 count(DISTINCT seller_state) AS states, min(seller_state) AS state
          FROM items JOIN dim_seller USING (seller_id) GROUP BY order_id)
    JOIN stages USING (order_id) JOIN dim_customer USING (customer_id)
    WHERE n >= 2 AND h_transit IS NOT NULL GROUP BY ALL"""
)
ORACLES["n9_review_spread"] = sql(
    """SELECT CASE WHEN sellers > 1 THEN 'multi-seller'
                   WHEN n = 1 THEN 'single-seller 1 item'
                   ELSE 'single-seller 2+ items' END AS grp,
    count(*) AS orders,
    round(CAST(count(*) FILTER (reviews > 1) AS DOUBLE) / count(*) * 100, 2)
        AS pct_orders_with_multiple_reviews,
    round(CAST(count(*) FILTER (reviews > 1 AND spread > 24) AS DOUBLE) / count(*) * 100, 2)
        AS pct_reviews_over_1d_apart,
    round(quantile_disc(spread, 0.5) FILTER (reviews > 1) / 24e0, 2) AS median_spread_when_multiple
    FROM (SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS sellers
          FROM items GROUP BY order_id)
    JOIN (SELECT order_id, count(*) AS reviews,
                 date_sub('hour', min(review_creation_date), max(review_creation_date)) AS spread
          FROM reviews GROUP BY order_id) USING (order_id)
    GROUP BY ALL"""
)


# Read-back

_TREND = f"""SELECT order_month, order_count, total_revenue,
    CAST(row_number() OVER (ORDER BY order_month) AS INTEGER) AS position
    FROM ({_SALES}) ORDER BY order_month LIMIT 30"""
ORACLES["v1_monthly_trend"] = sql(
    f"SELECT * FROM ({_TREND}) WHERE order_month < DATE '1997-01-01'"
)
ORACLES["v2_change_between"] = sql(
    f"""SELECT p.order_count AS peak_orders, p.total_revenue AS peak_revenue,
    l.order_count AS latest_orders, l.total_revenue AS latest_revenue,
    round(CAST(p.order_count - l.order_count AS DOUBLE) / p.order_count * 100, 6)
        AS order_drop_pct,
    round((p.total_revenue - l.total_revenue) / p.total_revenue * 100, 6) AS revenue_drop_pct
    FROM ({_TREND}) p, ({_TREND}) l
    WHERE p.order_month = DATE '1995-11-01' AND l.order_month = DATE '1996-08-01'"""
)
ORACLES["v3_revenue_risk"] = sql(
    f"""SELECT CAST(row_number() OVER (ORDER BY r.total_revenue DESC, customer_state) AS INTEGER)
        AS position,
    customer_state, round_even(r.total_revenue, 0)::DOUBLE AS total_revenue, total_orders,
    late_orders, round_even(r.late_revenue, 0)::DOUBLE AS late_revenue,
    round_even(r.late_delivery_pct * 100, 1)::DOUBLE AS late_delivery_pct,
    round_even(r.late_revenue_pct * 100, 1)::DOUBLE AS late_revenue_pct
    FROM ({_risk('fact')}) r ORDER BY position LIMIT 10"""
)
ORACLES["v4_revenue_by_outcome"] = sql(
    f"""SELECT customer_state, {case_label('delivery_status', STATUS)} AS delivery_outcome,
    revenue,
    CAST(sum(revenue::DECIMAL(18,2)) OVER (PARTITION BY customer_state) AS DOUBLE)
        AS state_revenue,
    round(revenue / CAST(sum(revenue::DECIMAL(18,2)) OVER (PARTITION BY customer_state)
        AS DOUBLE), 6) AS share_of_state
    FROM ({_sunburst('fact')})"""
)
ORACLES["v5_satisfaction"] = sql(
    f"""SELECT {place('delivery_status', STATUS)} AS position,
    {case_label('delivery_status', STATUS)} AS delivery_outcome, order_count,
    round_even(s.avg_review_score, 2)::DOUBLE AS avg_review_score,
    round_even(s.avg_delivery_days, 1)::DOUBLE AS avg_delivery_days
    FROM ({_SATISFACTION}) s"""
)
_LEADING = f"""SELECT seller_id, order_count, item_count, total_revenue, late_shipping_pct,
    late_delivery_pct, avg_delivery_days, 'Seller ' || left(CAST(seller_id AS VARCHAR), 8)
        AS seller_label
    FROM ({_PERFORMANCE}) WHERE order_count >= 20 ORDER BY total_revenue DESC, seller_id LIMIT 100"""
ORACLES["v6_top_sellers"] = sql(
    f"""SELECT {_ROUND_SHARES},
    CAST(row_number() OVER (ORDER BY total_revenue DESC, seller_id) AS INTEGER) AS position
    FROM ({_LEADING}) ORDER BY position LIMIT 10"""
)
ORACLES["v7_worst_shippers"] = sql(
    f"""SELECT {_ROUND_SHARES},
    round(l.late_shipping_pct * 100, 6) AS late_shipping_display,
    CAST(row_number() OVER (ORDER BY l.late_shipping_pct DESC, total_revenue DESC, seller_id)
        AS INTEGER) AS position
    FROM ({_LEADING}) l WHERE l.late_shipping_pct IS NOT NULL ORDER BY position LIMIT 10"""
)
ORACLES["v8_stage_table"] = sql(
    f"""SELECT {place('stage', STAGE)} AS position, stage, {case_label('stage', STAGE)}
        AS stage_label, round(s.total_days, 6) AS total_days,
    round(pct_of_delay * 100, 6) AS pct_display FROM ({_STAGES}) s"""
)


def _matrix(rows: str, key: str, size: str, value: str, sizes: list[str], extra: str = "") -> str:
    cells = ", ".join(
        f"""round(max({value} * 100) FILTER ({size} = '{s}'), 6) AS "{s}\"""" for s in sizes
    )
    return f"SELECT {key}, {cells}{extra} FROM ({rows}) GROUP BY {key}"


_ALL_SIZES = ["S", "M", "L", "XL", "Too Large or Too Heavy for Delivery"]
_ZONE_PLACE = (
    ", "
    + place("distance_bucket", ["Zone 1", "Zone 2", "Zone 3", "Zone 4"])
    + " AS position"
)
ORACLES["v9_zone_size_matrix"] = sql(
    _matrix(_zones("fact"), "distance_bucket", "size_bucket", "late_pct", _ALL_SIZES, _ZONE_PLACE)
)
ORACLES["v9_zone_size_matrix_chosen"] = sql(
    _matrix(
        f"SELECT * FROM ({_zones('fact')}) WHERE distance_bucket IN ('Zone 2', 'Zone 3')",
        "distance_bucket",
        "size_bucket",
        "late_pct",
        ["L", "XL"],
        _ZONE_PLACE,
    )
)
ORACLES["v10_transit_segments"] = sql(
    f"""SELECT {place('distance_band', BAND)} AS band_position,
    {place('order_shape', SHAPE)} AS shape_position,
    {case_label('distance_band', BAND)} AS distance_band_label,
    {case_label('order_shape', SHAPE)} AS order_shape_label, order_count,
    round(pct_of_orders * 100, 6) AS pct_of_orders_display, avg_transit_days,
    avg_seller_handling_days, round(late_pct * 100, 6) AS late_pct_display
    FROM ({_DRIVERS}) WHERE distance_band <> '4. unknown' AND order_shape <> 'unclassified'"""
)
ORACLES["v11_unclassified_totals"] = sql(
    f"""SELECT CAST(sum(order_count) AS BIGINT) AS total_unclassified,
    CAST(sum(delivered_order_count) AS BIGINT) AS total_delivered FROM ({_UNCLASSIFIED})"""
)
ORACLES["v11_unclassified_by_reason"] = sql(
    f"""SELECT {case_label('unclassified_reason', REASON)} AS reason,
    CAST(sum(order_count) AS BIGINT) AS order_count,
    CAST(sum(delivered_order_count) AS BIGINT) AS delivered_order_count
    FROM ({_UNCLASSIFIED}) GROUP BY unclassified_reason"""
)
ORACLES["v11_unclassified_detail"] = sql(
    f"""SELECT {case_label('u.distance_band', BAND)} AS distance_band,
    {case_label('unclassified_reason', REASON)} AS reason, order_status, order_count,
    delivered_order_count, round_even(u.avg_transit_days, 1)::DOUBLE AS avg_transit_days
    FROM ({_UNCLASSIFIED}) u"""
)
ORACLES["v12_category_size_matrix"] = sql(
    _matrix(
        _CATEGORY,
        "product_category_buckets",
        "product_size_buckets",
        "late_item_pct",
        ["S", "M", "L", "XL"],
    )
)
ORACLES["v13_freight_vs_late"] = sql(
    f"""SELECT product_category_buckets, product_size_buckets, product_item_count,
    round(c.avg_freight_per_item, 6) AS avg_freight_per_item,
    round(late_item_pct * 100, 6) AS late_pct_display
    FROM ({_CATEGORY}) c
    WHERE c.avg_freight_per_item BETWEEN 0 AND 150 AND late_item_pct * 100 BETWEEN 0 AND 50"""
)


# Ingest

_ZONE_TABLES = {
    "orders": "stg_orders",
    "order_items": "items",
    "order_reviews": "reviews",
    "customers": "dim_customer",
    "sellers": "dim_seller",
    "products": "raw_products",
    "geolocation": "stg_geolocation",
    "product_category_name_translation": "buckets",
}
ORACLES["csv_landing_counts"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{zone}' AS zone, '{table}' AS "table", count(*) AS row_count FROM {rows}"""
        for zone in ("landing", "raw")
        for table, rows in _ZONE_TABLES.items()
    )
)
ORACLES["csv_roundtrip_orders"] = sql(
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
    order_status, order_purchase_at AS order_purchase_timestamp, order_approved_at,
    order_delivered_carrier_at AS order_delivered_carrier_date,
    order_delivered_customer_at AS order_delivered_customer_date,
    order_estimated_delivery_at AS order_estimated_delivery_date FROM stg_orders"""
)
ORACLES["incremental_batch"] = """SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-25' AND event_type <> 'error'"""
ORACLES["incremental_backwards"] = """SELECT event_id, ts, value FROM events
    WHERE ts <= TIMESTAMP '2024-01-25' AND ts > TIMESTAMP '2024-01-10'"""
ORACLES["projection_limit"] = """SELECT event_id, ts, event_type FROM events
    WHERE ts <= TIMESTAMP '2024-01-25' ORDER BY ts, event_id LIMIT 500"""
ORACLES["incremental_two_loads"] = "SELECT * FROM events"
ORACLES["incremental_late_copies"] = """SELECT * REPLACE (
    CASE WHEN event_id % 10 > 0 THEN ts
         WHEN event_id % 2 = 0 THEN ts + INTERVAL 30 DAY END AS ts) FROM events"""
def _footer(table: str, columns: str) -> str:
    parts = [
        f"""SELECT '{table}' AS "table", '{c}' AS "column", count(*) AS rows, count({c}) AS present,
        min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM {table}"""
        for c in columns.split()
    ]
    return " UNION ALL ".join(parts)


ORACLES["n1_footer_figures"] = " UNION ALL ".join(
    _footer(*x)
    for x in (
        ("orders", "o_orderkey o_custkey o_totalprice"),
        ("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"),
        ("customer", "c_custkey c_nationkey c_acctbal"),
        ("part", "p_partkey p_size p_retailprice"),
    )
)
ORACLES["price_quantiles"] = """WITH v AS (
    SELECT l_returnflag, l_extendedprice AS value FROM lineitem UNION ALL
    SELECT 'all', l_extendedprice FROM lineitem),
  r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY value) AS place,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM v),
  s(share, thousandths) AS (VALUES (0.01::DOUBLE, 10), (0.25, 250), (0.5, 500), (0.9, 900), (0.99, 990))
  SELECT l_returnflag, share, value, n FROM r JOIN s ON place = greatest(1, (n * thousandths + 999) // 1000)"""
_CUSTOMERS = """SELECT {0}, count(DISTINCT customer_id) AS customers,
    count(DISTINCT customer_id) FILTER ({1}) AS late_customers
    FROM stages JOIN dim_customer USING (customer_id) GROUP BY ALL"""
ORACLES["monthly_customers"] = sql(
    _CUSTOMERS.format("strftime(order_purchase_at, '%Y-%m') AS order_month, customer_state", LATE)
)
ORACLES["yearly_customers"] = sql(
    _CUSTOMERS.format("year(order_purchase_at)::INTEGER AS order_year", LATE)
)
ORACLES["distinct_lines"] = """WITH l AS (SELECT * FROM lineitem)
  SELECT l_returnflag AS of, count(DISTINCT (l_orderkey, l_linenumber)) AS ids FROM l GROUP BY 1 UNION ALL
  SELECT l_linestatus, count(DISTINCT (l_orderkey, l_linenumber)) FROM l GROUP BY 1 UNION ALL
  SELECT 'all', count(DISTINCT (l_orderkey, l_linenumber)) FROM l"""
_CHANGED_LINES = """WITH a AS (
    SELECT DISTINCT concat(l_orderkey, chr(1), l_linenumber, chr(1), l_partkey) AS key FROM lineitem),
  b AS (SELECT DISTINCT concat(l_orderkey, chr(1), l_linenumber + CASE WHEN l_orderkey = 77 THEN 50 ELSE 0 END,
      chr(1), l_partkey) AS key FROM lineitem WHERE l_orderkey <> 1234)"""
ORACLES["reconcile_key_buckets"] = f"""{_CHANGED_LINES},
  d AS (SELECT DISTINCT substr(sha256(key), 1, 4) AS bucket FROM (
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)))
  SELECT bucket, (SELECT count(*) FROM a WHERE substr(sha256(key), 1, 4) = bucket) AS source_keys,
    (SELECT count(*) FROM b WHERE substr(sha256(key), 1, 4) = bucket) AS layer_keys FROM d"""
ORACLES["reconcile_changed_keys"] = f"""{_CHANGED_LINES}
  SELECT replace(key, chr(1), '|') AS key, 'source' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL
  SELECT replace(key, chr(1), '|'), 'layer' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
ORACLES["incremental_indexed"] = """SELECT * REPLACE (
    CASE WHEN event_id % 10 > 0 OR event_id IN (0, 10, 20) THEN ts ELSE ts + INTERVAL 30 DAY END AS ts)
    FROM events"""
ORACLES["incremental_indexed_two_loads"] = "SELECT * FROM events"
ORACLES["incremental_falling"] = """SELECT event_id, ts,
    CASE WHEN ts > TIMESTAMP '2024-01-25' THEN 1 WHEN ts > TIMESTAMP '2024-01-10' THEN 2 ELSE 3 END AS load
    FROM events"""
ORACLES["load_dispositions"] = """WITH e AS (
    SELECT event_id, user_id, event_id % 1000 >= 300 AS second FROM events WHERE event_type <> 'error'),
  landed AS (
    SELECT 'replace' AS disposition, * FROM e WHERE second UNION ALL
    SELECT 'append', * FROM e UNION ALL SELECT 'append', * FROM e WHERE second UNION ALL
    SELECT 'merge', * FROM e UNION ALL SELECT 'merge_indexed', * FROM e)
  SELECT disposition, event_id % 7 AS part, count(*) AS rows, sum(event_id + user_id)::BIGINT AS total
  FROM landed GROUP BY ALL"""
ORACLES["filter_conflicts"] = """WITH o(operator) AS (VALUES ('<'), ('<='), ('>'), ('>='), ('!=')),
  c("cursor", low, high, taken) AS (VALUES
    ('none yet', TIMESTAMP '1900-01-01', TIMESTAMP '2900-01-01', []),
    ('rising', TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-25' - INTERVAL 1 MICROSECOND, ['>=', '<']),
    ('falling', TIMESTAMP '1900-01-01', TIMESTAMP '2024-01-25', ['<=']))
  SELECT "cursor", operator, list_contains(taken, operator) AS conflict,
    CASE WHEN NOT list_contains(taken, operator) THEN (
      SELECT count(*) FROM events WHERE ts BETWEEN low AND high AND CASE operator
        WHEN '<' THEN ts < TIMESTAMP '2024-01-25' WHEN '<=' THEN ts <= TIMESTAMP '2024-01-25'
        WHEN '>' THEN ts > TIMESTAMP '2024-01-25' WHEN '>=' THEN ts >= TIMESTAMP '2024-01-25'
        ELSE ts <> TIMESTAMP '2024-01-25' END) END AS rows
  FROM o, c"""
ORACLES["canonical_float_keys"] = """SELECT concat(
    CASE WHEN l_orderkey % 11 = 0 THEN '<null>'
         WHEN l_quantity = round(l_quantity) THEN l_quantity::BIGINT::VARCHAR ELSE l_quantity::VARCHAR END, '|',
    CASE WHEN l_orderkey % 13 = 0 THEN '<null>' ELSE l_linenumber::VARCHAR END, '|',
    CASE WHEN l_orderkey % 4 = 0 THEN l_suppkey::VARCHAR || '.5' ELSE l_suppkey::VARCHAR END) AS key,
    count(*) AS rows FROM lineitem GROUP BY ALL"""
ORACLES["dispositions"] = """SELECT * FROM (VALUES
    ('replace', (SELECT count(*) FROM nation WHERE n_nationkey % 2 >= 1)),
    ('append', (SELECT count(*) + count(*) FILTER (n_nationkey % 2 >= 1) FROM nation)),
    ('merge', (SELECT count(DISTINCT n_nationkey) FROM nation))) f(disposition, row_count)"""
ORACLES["normalised_values"] = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_tax END AS tax,
    CAST(l_quantity::DECIMAL(10,2) AS VARCHAR) AS quantity,
    lower(hex(l_returnflag::BLOB)) AS flag,
    CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS nested_q,
    CASE WHEN l_orderkey % 7 <> 0 AND l_orderkey % 3 <> 0 THEN l_tax END AS nested_t,
    l_discount AS listed_0, CAST(NULL AS DOUBLE) AS listed_1 FROM lineitem"""


def _digests(table: str, rows: str, columns: dict[str, str]) -> str:
    """Nulls and a digest of each column; what becomes of a value as text is given."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS "table", '{name}' AS "column", count(*) - count(v) AS nulls,
        CAST(coalesce(sum(CAST('0x' || substr(md5(v), 1, 8) AS BIGINT)), 0) AS VARCHAR) AS digest
        FROM (SELECT CAST({text} AS VARCHAR) AS v FROM {rows})"""
        for name, text in columns.items()
    )


def _plain(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _times(**named: str) -> dict[str, str]:
    return {n: f"strftime({c}, '%Y-%m-%d %H:%M:%S')" for n, c in named.items()}


def _rounded(**named: str) -> dict[str, str]:
    return {n: f"CAST(round({c} * 1000) AS BIGINT)" for n, c in named.items()}


ORACLES["csv_contents"] = sql(
    "\nUNION ALL\n".join(
        [
            _digests(
                "orders",
                "stg_orders",
                _plain("order_id", "customer_id", "order_status")
                | _times(
                    order_purchase_timestamp="order_purchase_at",
                    order_approved_at="order_approved_at",
                    order_delivered_carrier_date="order_delivered_carrier_at",
                    order_delivered_customer_date="order_delivered_customer_at",
                    order_estimated_delivery_date="order_estimated_delivery_at",
                ),
            ),
            _digests(
                "order_items",
                "items",
                _plain("order_id", "order_item_id", "product_id", "seller_id")
                | _times(shipping_limit_date="shipping_limit_date")
                | _rounded(price="price", freight_value="freight_value"),
            ),
            _digests(
                "order_reviews",
                "reviews",
                _plain("review_id", "order_id", "review_score")
                | _times(
                    review_creation_date="review_creation_date",
                    review_answer_timestamp="review_answer_timestamp",
                ),
            ),
            _digests(
                "customers",
                "dim_customer",
                _plain(
                    "customer_id",
                    "customer_unique_id",
                    "customer_zip_code_prefix",
                    "customer_city",
                    "customer_state",
                ),
            ),
            _digests(
                "sellers",
                "dim_seller",
                _plain("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
            ),
            _digests(
                "products",
                "raw_products",
                _plain("product_id", "product_category_name")
                | {
                    "product_name_lenght": "product_name_length",
                    "product_description_lenght": "product_description_length",
                }
                | _plain(
                    "product_photos_qty",
                    "product_weight_g",
                    "product_length_cm",
                    "product_height_cm",
                    "product_width_cm",
                ),
            ),
            _digests(
                "product_category_name_translation",
                "buckets",
                _plain("product_category_name", "product_category_name_english"),
            ),
            _digests(
                "geolocation",
                "stg_geolocation",
                {
                    "geolocation_zip_code_prefix": "zip_code_prefix",
                    "geolocation_city": "city",
                    "geolocation_state": "state",
                }
                | _rounded(geolocation_lat="latitude", geolocation_lng="longitude"),
            ),
        ]
    )
)
ORACLES["stream_dedup_events"] = "SELECT * FROM events"
ORACLES["stream_state_dedup"] = "SELECT * FROM events"
ORACLES["stream_within"] = """WITH f AS (
    SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 DAY AS mark FROM events
    WHERE ts < TIMESTAMP '2024-01-25' AND event_id % 11 > 0)
  SELECT events.* FROM events, f WHERE ts > mark OR ts < TIMESTAMP '2024-01-25' AND event_id % 11 > 0"""
ORACLES["materialised_fact_sales"] = sql(
    f"""SELECT strftime(order_purchase_at, '%Y-%m') AS order_month, count(*) AS order_count,
    {money('order_revenue')} AS revenue FROM header GROUP BY ALL"""
)
ORACLES["refreshed_fact_sales"] = ORACLES["materialised_fact_sales"]

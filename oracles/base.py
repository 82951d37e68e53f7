"""The raw tables, the order header and the item-grain fact as shared CTEs."""

BASE = """
WITH
supplier_count AS (SELECT count(*) AS n FROM supplier),
bought AS (
    SELECT o_orderkey AS k, o_custkey, o_orderdate,
           o_orderdate + to_hours(CAST(7 * o_orderkey % 24 AS INTEGER)) AS bought_at
    FROM orders
),
approved AS (
    SELECT *,
           CASE WHEN k % 31 <> 0 AND k % 37 <> 0
                THEN bought_at + to_hours(CAST(13 * k % 72 AS INTEGER))
                               + to_minutes(CAST(17 * k % 60 AS INTEGER)) END AS approved_at
    FROM bought
),
handed AS (
    SELECT *,
           CASE WHEN k % 31 <> 0 AND k % 41 <> 0
                THEN coalesce(approved_at, bought_at) + to_hours(CAST(11 * k % 240 AS INTEGER))
           END AS handed_at
    FROM approved
),
stg_orders AS (
    SELECT k AS order_id, o_custkey AS customer_id,
           CASE WHEN k % 31 = 0 THEN 'canceled' WHEN k % 41 = 0 THEN 'processing'
                WHEN k % 43 = 0 THEN 'shipped' ELSE 'delivered' END AS order_status,
           bought_at AS order_purchase_at, approved_at AS order_approved_at,
           handed_at AS order_delivered_carrier_at,
           CASE WHEN k % 43 <> 0
                THEN handed_at + to_hours(CAST(19 * k % 600 AS INTEGER))
                               + to_minutes(CAST(23 * k % 60 AS INTEGER))
           END AS order_delivered_customer_at,
           o_orderdate + to_days(CAST(12 + k % 16 AS INTEGER)) AS order_estimated_delivery_at
    FROM handed
),
items AS (
    SELECT l.l_orderkey AS order_id,
           CAST(row_number() OVER (
               PARTITION BY l.l_orderkey
               ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
                        l.l_quantity, l.l_shipdate) AS INTEGER) AS order_item_id,
           l.l_partkey AS product_id,
           CASE WHEN l.l_orderkey % 3 = 0 THEN l.l_suppkey
                ELSE 7 * l.l_orderkey % (SELECT n FROM supplier_count) END AS seller_id,
           b.bought_at + to_days(CAST(3 + l.l_linenumber AS INTEGER)) AS shipping_limit_date,
           l.l_extendedprice AS price,
           round(l.l_quantity * (1 + 100 * l.l_tax), 2) AS freight_value
    FROM lineitem l LEFT JOIN bought b ON b.k = l.l_orderkey
),
reviews AS (
    SELECT 2 * order_id + j AS review_id, order_id,
           CAST(1 + (7 * order_id + 3 * j) % 5 AS INTEGER) AS review_score,
           closed + to_days(CAST(2 * j AS INTEGER)) AS review_creation_date,
           closed + to_days(CAST(2 * j AS INTEGER)) + to_hours(CAST(order_id % 72 AS INTEGER))
               AS review_answer_timestamp
    FROM (
        SELECT order_id, j,
               date_trunc('day', coalesce(order_delivered_customer_at,
                                          order_estimated_delivery_at))::TIMESTAMP AS closed
        FROM stg_orders, (VALUES (0), (1)) v(j)
        WHERE (j = 0 AND order_id % 20 <> 0) OR (j = 1 AND order_id % 50 = 1)
    )
),
places AS (
    SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
),
dim_customer AS (
    SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
           CAST(c_nationkey * 100 + c_custkey % 20 AS VARCHAR) AS customer_zip_code_prefix,
           CASE WHEN c_custkey % 5 = 0 THEN upper(n_name) ELSE lower(n_name) END AS customer_city,
           CASE WHEN c_custkey % 211 <> 0 THEN r_name END AS customer_state
    FROM customer JOIN places ON n_nationkey = c_nationkey
),
dim_seller AS (
    SELECT s_suppkey AS seller_id,
           CAST(s_nationkey * 100 + s_suppkey % 20 AS VARCHAR) AS seller_zip_code_prefix,
           n_name AS seller_city, r_name AS seller_state
    FROM supplier JOIN places ON n_nationkey = s_nationkey
),
recorded AS (
    SELECT c_custkey AS key, c_nationkey AS nation,
           CASE WHEN c_custkey % 5 = 0 THEN upper(n_name) ELSE lower(n_name) END AS city,
           r_name AS state
    FROM customer JOIN places ON n_nationkey = c_nationkey
    UNION ALL
    SELECT s_suppkey, s_nationkey, n_name, r_name
    FROM supplier JOIN places ON n_nationkey = s_nationkey
),
stg_geolocation AS (
    SELECT CAST(nation * 100 + key % 20 AS VARCHAR) AS zip_code_prefix,
           -30e0 + 1.2e0 * (nation % 5) + 0.01e0 * (key % 7) AS latitude,
           -65e0 + 4.5e0 * (nation // 5) + 0.01e0 * (key % 4) AS longitude,
           city, state
    FROM recorded WHERE key % 20 <> 19
),
spoken AS (
    SELECT zip_code_prefix, city, state,
           row_number() OVER (PARTITION BY zip_code_prefix
                              ORDER BY count(*) DESC, city, state) AS place
    FROM stg_geolocation GROUP BY zip_code_prefix, city, state
),
vectors AS (
    SELECT zip_code_prefix,
           avg(cos(radians(latitude)) * cos(radians(longitude))) AS x,
           avg(cos(radians(latitude)) * sin(radians(longitude))) AS y,
           avg(sin(radians(latitude))) AS z
    FROM (SELECT DISTINCT zip_code_prefix, latitude, longitude FROM stg_geolocation)
    GROUP BY zip_code_prefix
),
dim_geolocation AS (
    SELECT s.zip_code_prefix, s.city, s.state,
           degrees(atan2(v.y, v.x)) AS centroid_lng,
           degrees(atan2(v.z, sqrt(v.x * v.x + v.y * v.y))) AS centroid_lat
    FROM spoken s LEFT JOIN vectors v USING (zip_code_prefix)
    WHERE s.place = 1
),
raw_products AS (
    SELECT p_partkey AS product_id,
           CASE WHEN p_partkey % 50 <> 0
                THEN 'cat_' || replace(p_brand, 'Brand#', '') END AS product_category_name,
           CAST(length(p_name) AS INTEGER) AS product_name_length,
           CAST(10 * p_size AS INTEGER) AS product_description_length,
           CAST(1 + p_partkey % 6 AS INTEGER) AS product_photos_qty,
           CASE WHEN p_partkey % 97 <> 0 THEN CAST(800 * p_size AS INTEGER) END AS product_weight_g,
           CAST(16 + 2 * p_size AS INTEGER) AS product_length_cm,
           CAST(2 + p_partkey % 100 AS INTEGER) AS product_height_cm,
           CAST(11 + p_partkey % 110 AS INTEGER) AS product_width_cm
    FROM part
),
english(number, name, bucket) AS (
    VALUES
    (1, 'audio', 'Electronics & Technology'),
    (2, 'computers', 'Electronics & Technology'),
    (3, 'telephony', 'Electronics & Technology'),
    (4, 'bed_bath_table', 'Home, Living & Furniture'),
    (5, 'home_confort', 'Home, Living & Furniture'),
    (6, 'housewares', 'Home, Living & Furniture'),
    (7, 'fashio_female_clothing', 'Fashion, Luggage & Watches'),
    (8, 'fashion_shoes', 'Fashion, Luggage & Watches'),
    (9, 'watches_gifts', 'Fashion, Luggage & Watches'),
    (10, 'baby', 'Health, Beauty & Baby'),
    (11, 'health_beauty', 'Health, Beauty & Baby'),
    (12, 'perfumery', 'Health, Beauty & Baby'),
    (13, 'costruction_tools_garden', 'Home Improvement (Construction), Garden & Pets'),
    (14, 'garden_tools', 'Home Improvement (Construction), Garden & Pets'),
    (15, 'pet_shop', 'Home Improvement (Construction), Garden & Pets'),
    (16, 'art', 'Books, Media & Hobbies'),
    (17, 'books_technical', 'Books, Media & Hobbies'),
    (18, 'toys', 'Books, Media & Hobbies'),
    (19, 'drinks', 'Food, Beverage & Party'),
    (20, 'food_drink', 'Food, Beverage & Party'),
    (21, 'auto', 'Automotive, Industrial & B2B'),
    (22, 'market_place', 'Automotive, Industrial & B2B'),
    (23, 'not_in_any_bucket', 'Uncategorized')
),
buckets AS (
    SELECT 'cat_' || e.number AS product_category_name, e.name AS product_category_name_english,
           e.bucket AS product_category_buckets
    FROM english e
    WHERE 'cat_' || e.number IN (SELECT product_category_name FROM raw_products)
),
dim_products AS (
    SELECT p.product_id,
           coalesce(p.product_category_name, 'uncategorized') AS product_category_name,
           coalesce(b.product_category_name_english, 'uncategorized')
               AS product_category_name_english,
           coalesce(b.product_category_buckets, 'Uncategorized') AS product_category_buckets,
           p.* EXCLUDE (product_id, product_category_name),
           CAST(product_length_cm + product_height_cm + product_width_cm AS BIGINT)
               AS product_dimension,
           CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm
               AS product_volume
    FROM raw_products p LEFT JOIN buckets b ON b.product_category_name = p.product_category_name
),
sized AS (
    SELECT product_id, product_category_buckets, product_weight_g, product_dimension,
           list_extract(['S', 'M', 'L', 'XL', 'Too Large or Too Heavy for Delivery'],
               greatest(
                   1 + (product_dimension > 80)::INT + (product_dimension > 120)::INT
                     + (product_dimension > 200)::INT + (product_dimension > 300)::INT,
                   CASE WHEN product_weight_g > 30000 THEN 1
                        ELSE 1 + (product_weight_g > 5000)::INT + (product_weight_g > 10000)::INT
                               + (product_weight_g > 20000)::INT END)) AS size
    FROM dim_products
    WHERE product_weight_g IS NOT NULL AND product_dimension IS NOT NULL
),
hours AS (
    SELECT *,
           date_sub('hour', order_purchase_at, order_approved_at) AS h_approval,
           date_sub('hour', order_approved_at, order_delivered_carrier_at) AS h_handling,
           date_sub('hour', order_delivered_carrier_at, order_delivered_customer_at) AS h_transit,
           date_sub('hour', order_purchase_at, order_delivered_customer_at) AS h_total,
           date_sub('hour', order_estimated_delivery_at, order_delivered_customer_at) AS h_delay,
           date_sub('day', order_estimated_delivery_at, order_delivered_customer_at) AS d_delay
    FROM stg_orders
),
stages AS (
    SELECT *,
           CASE WHEN order_delivered_customer_at IS NULL THEN 'not_delivered'
                WHEN order_delivered_customer_at <= order_estimated_delivery_at
                    THEN if(d_delay <= -1, 'early', 'on_time')
                WHEN d_delay BETWEEN 0 AND 3 THEN 'late_1_3_days'
                WHEN d_delay BETWEEN 4 AND 7 THEN 'late_4_7_days'
                ELSE 'late_8_plus_days' END AS delivery_status
    FROM hours
),
per_order AS (
    SELECT order_id, count(*) AS item_count, count(DISTINCT seller_id) AS distinct_seller_count,
           CAST(sum(price::DECIMAL(18,2)) AS DOUBLE) AS order_revenue,
           CAST(sum(freight_value::DECIMAL(18,2)) AS DOUBLE) AS order_freight,
           max(shipping_limit_date) AS last_limit
    FROM items GROUP BY order_id
),
scores AS (
    SELECT order_id, avg(review_score) AS avg_review_score, count(*) AS review_count
    FROM reviews GROUP BY order_id
),
header AS (
    SELECT s.*, coalesce(p.item_count, 0) AS item_count,
           coalesce(p.distinct_seller_count, 0) AS distinct_seller_count,
           coalesce(p.order_revenue, 0) AS order_revenue,
           coalesce(p.order_freight, 0) AS order_freight,
           p.last_limit, c.avg_review_score, c.review_count
    FROM stages s LEFT JOIN per_order p USING (order_id) LEFT JOIN scores c USING (order_id)
),
fact AS (
    SELECT h.*, i.order_item_id, i.seller_id, i.product_id,
           i.shipping_limit_date AS item_shipping_limit_at, i.price AS item_price,
           i.freight_value AS item_freight,
           row_number() OVER (PARTITION BY h.order_id ORDER BY i.order_item_id) = 1
               AS is_order_header_row
    FROM header h LEFT JOIN items i USING (order_id)
),
seller_totals AS (
    SELECT order_id, seller_id,
           row_number() OVER (PARTITION BY order_id
                              ORDER BY sum(price::DECIMAL(18,2)) DESC, seller_id) AS place
    FROM items GROUP BY order_id, seller_id
),
shape_base AS (
    SELECT h.*, s.seller_city, s.seller_state, c.customer_city, c.customer_state,
           date_sub('hour', h.last_limit, h.order_delivered_carrier_at) AS h_sla,
           CASE WHEN h.item_count = 0 THEN 'no_items_on_order'
                WHEN coalesce(h.order_approved_at, h.order_delivered_carrier_at) IS NULL
                    THEN 'never_approved_or_shipped'
                WHEN h.order_approved_at IS NULL THEN 'approval_timestamp_missing'
                WHEN h.order_delivered_carrier_at IS NULL THEN 'never_handed_to_carrier'
           END AS unclassified_reason
    FROM header h
    LEFT JOIN (SELECT * FROM seller_totals WHERE place = 1) t USING (order_id)
    LEFT JOIN dim_seller s ON s.seller_id = t.seller_id
    LEFT JOIN dim_customer c ON c.customer_id = h.customer_id
),
shapes AS (
    SELECT *,
           CASE WHEN unclassified_reason IS NOT NULL THEN 'unclassified'
                WHEN distinct_seller_count >= 2 THEN 'multi_seller'
                WHEN h_handling > 24 * {slow} AND h_sla > 24 * {breach}
                    THEN 'single_seller_slow_handoff'
                ELSE 'single_seller_normal_handoff' END AS order_shape,
           CASE WHEN seller_state IS NULL OR customer_state IS NULL THEN '4. unknown'
                WHEN seller_state <> customer_state THEN '3. cross_state'
                WHEN lower(seller_city) = lower(customer_city) THEN '1. same_city'
                ELSE '2. same_state' END AS distance_band
    FROM shape_base
),
distances AS (
    SELECT i.order_id, i.seller_id,
           a.centroid_lat AS seller_lat, a.centroid_lng AS seller_lng,
           b.centroid_lat AS customer_lat, b.centroid_lng AS customer_lng,
           -- The angle between both directions, from their cross and dot products.
           6371010e0 * atan2(
               sqrt(pow(cos(radians(b.centroid_lat))
                        * sin(radians(b.centroid_lng - a.centroid_lng)), 2)
                    + pow(cos(radians(a.centroid_lat)) * sin(radians(b.centroid_lat))
                          - sin(radians(a.centroid_lat)) * cos(radians(b.centroid_lat))
                            * cos(radians(b.centroid_lng - a.centroid_lng)), 2)),
               sin(radians(a.centroid_lat)) * sin(radians(b.centroid_lat))
               + cos(radians(a.centroid_lat)) * cos(radians(b.centroid_lat))
                 * cos(radians(b.centroid_lng - a.centroid_lng)))
               AS distance_meters
    FROM (SELECT DISTINCT order_id, seller_id FROM items) i
    JOIN stg_orders o USING (order_id)
    JOIN dim_seller s ON s.seller_id = i.seller_id
    JOIN dim_customer c ON c.customer_id = o.customer_id
    JOIN dim_geolocation a ON a.zip_code_prefix = s.seller_zip_code_prefix
    JOIN dim_geolocation b ON b.zip_code_prefix = c.customer_zip_code_prefix
)
"""


def sql(body: str, slow: float = 5, breach: float = 0) -> str:
    """A query over the shared CTEs."""
    return BASE.format(slow=slow, breach=breach) + body

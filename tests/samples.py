"""Hand-made raw tables. Only the columns a test names differ from the defaults."""

from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import SparkSession

ORDERS = """order_id BIGINT, customer_id BIGINT, order_status STRING,
    order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ,
    order_delivered_carrier_date TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ,
    order_estimated_delivery_date TIMESTAMP_NTZ"""
ITEMS = """order_id BIGINT, order_item_id INT, product_id BIGINT, seller_id BIGINT,
    shipping_limit_date TIMESTAMP_NTZ, price DOUBLE, freight_value DOUBLE"""
REVIEWS = """review_id BIGINT, order_id BIGINT, review_score INT,
    review_creation_date TIMESTAMP_NTZ, review_answer_timestamp TIMESTAMP_NTZ"""
CUSTOMERS = """customer_id BIGINT, customer_unique_id BIGINT, customer_zip_code_prefix STRING,
    customer_city STRING, customer_state STRING"""
SELLERS = "seller_id BIGINT, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING"
PRODUCTS = """product_id BIGINT, product_category_name STRING, product_name_lenght INT,
    product_description_lenght INT, product_photos_qty INT, product_weight_g INT,
    product_length_cm INT, product_height_cm INT, product_width_cm INT"""
GEOLOCATION = """geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE,
    geolocation_lng DOUBLE, geolocation_city STRING, geolocation_state STRING"""
TRANSLATION = "product_category_name STRING, product_category_name_english STRING"


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(f"2018-{text}")


def order(order_id, customer=1, bought="01-01 00:00", approved="01-01 01:00", handed="01-02 00:00",
          delivered="01-08 00:00", due="01-10 00:00", status="delivered"):
    return (order_id, customer, status, ts(bought), ts(approved), ts(handed), ts(delivered), ts(due))


def item(order_id, item_id=1, product=1, seller=1, limit="01-05 00:00", price=10.0, freight=1.0):
    return (order_id, item_id, product, seller, ts(limit), price, freight)


def product(product_id, category=None, weight=100, length=10, height=10, width=10):
    return (product_id, category, 1, 1, 1, weight, length, height, width)


def raw(spark: SparkSession, orders=(), items=(), reviews=(), customers=(), sellers=(),
        products=(), geolocation=(), translation=()) -> SimpleNamespace:
    def table(rows, ddl):
        return spark.createDataFrame(list(rows), ddl)

    return SimpleNamespace(
        orders=table(orders, ORDERS),
        order_items=table(items, ITEMS),
        order_reviews=table(reviews, REVIEWS),
        customers=table(customers or [(1, 1, "01000", "sao paulo", "SP")], CUSTOMERS),
        sellers=table(sellers or [(1, "01000", "SAO PAULO", "SP")], SELLERS),
        products=table(products or [product(1)], PRODUCTS),
        geolocation=table(geolocation, GEOLOCATION),
        product_category_name_translation=table(translation, TRANSLATION),
    )

"""Raw tables: declared column types and natural keys (I-2, R-8).

A natural key is the source's own grain. It is what reconciliation compares
between layers; it is not a promise that the source never repeats a key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Added by storage hops, never part of the data.
ARTIFACT_COLUMNS = frozenset({"_id", "_dlt_id", "_dlt_load_id"})


@dataclass(frozen=True)
class RawTable:
    name: str
    ddl: str
    key: tuple[str, ...] | None
    # Free text may hold line breaks, and such a CSV file cannot be split:
    # deliver a table like this as many files.
    free_text: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


_TABLES = [
    RawTable(
        "orders",
        """order_id STRING, customer_id STRING, order_status STRING,
        order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ,
        order_delivered_carrier_date TIMESTAMP_NTZ,
        order_delivered_customer_date TIMESTAMP_NTZ,
        order_estimated_delivery_date TIMESTAMP_NTZ""",
        ("order_id",),
    ),
    RawTable(
        "order_items",
        """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date TIMESTAMP_NTZ, price DOUBLE, freight_value DOUBLE""",
        ("order_id", "order_item_id"),
    ),
    RawTable(
        "order_payments",
        """order_id STRING, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE""",
        ("order_id", "payment_sequential"),
    ),
    RawTable(
        "order_reviews",
        """review_id STRING, order_id STRING, review_score INT,
        review_comment_title STRING, review_comment_message STRING,
        review_creation_date TIMESTAMP_NTZ, review_answer_timestamp TIMESTAMP_NTZ""",
        ("review_id", "order_id"),
        free_text=True,
    ),
    RawTable(
        "customers",
        """customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
        customer_city STRING, customer_state STRING""",
        ("customer_id",),
    ),
    RawTable(
        "sellers",
        """seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING,
        seller_state STRING""",
        ("seller_id",),
    ),
    RawTable(
        "products",
        """product_id STRING, product_category_name STRING, product_name_lenght INT,
        product_description_lenght INT, product_photos_qty INT, product_weight_g INT,
        product_length_cm INT, product_height_cm INT, product_width_cm INT""",
        ("product_id",),
    ),
    RawTable(
        "geolocation",
        """geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE,
        geolocation_city STRING, geolocation_state STRING""",
        None,
    ),
    RawTable(
        "product_category_name_translation",
        "product_category_name STRING, product_category_name_english STRING",
        ("product_category_name",),
    ),
]

REGISTRY: dict[str, RawTable] = {t.name: t for t in _TABLES}

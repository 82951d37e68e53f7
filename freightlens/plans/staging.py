"""Staging: rename, fill and bucket, one function per raw table (D-1 … D-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from freightlens.functions.labels import relabel

UNCATEGORIZED = "uncategorized"
NO_BUCKET = "Uncategorized"

# Bucket → English category names. Misspelt names are spelt that
# way in the source and must stay.
CATEGORY_BUCKETS = {
    "Electronics & Technology": [
        "audio",
        "computers",
        "computers_accessories",
        "consoles_games",
        "electronics",
        "fixed_telephony",
        "telephony",
        "tablets_printing_image",
    ],
    "Home, Living & Furniture": [
        "air_conditioning",
        "bed_bath_table",
        "furniture_bedroom",
        "furniture_decor",
        "furniture_living_room",
        "furniture_mattress_and_upholstery",
        "home_appliances",
        "home_appliances_2",
        "home_confort",
        "home_comfort_2",
        "housewares",
        "kitchen_dining_laundry_garden_furniture",
        "la_cuisine",
        "office_furniture",
        "small_appliances",
        "small_appliances_home_oven_and_coffee",
    ],
    "Fashion, Luggage & Watches": [
        "fashion_bags_accessories",
        "fashion_childrens_clothes",
        "fashio_female_clothing",
        "fashion_male_clothing",
        "fashion_shoes",
        "fashion_sport",
        "fashion_underwear_beach",
        "luggage_accessories",
        "watches_gifts",
    ],
    "Health, Beauty & Baby": [
        "baby",
        "diapers_and_hygiene",
        "health_beauty",
        "perfumery",
    ],
    "Home Improvement (Construction), Garden & Pets": [
        "construction_tools_construction",
        "costruction_tools_garden",
        "construction_tools_lights",
        "construction_tools_safety",
        "costruction_tools_tools",
        "flowers",
        "garden_tools",
        "home_construction",
        "pet_shop",
    ],
    "Books, Media & Hobbies": [
        "art",
        "arts_and_craftmanship",
        "books_general_interest",
        "books_imported",
        "books_technical",
        "cds_dvds_musicals",
        "cine_photo",
        "cool_stuff",
        "dvds_blu_ray",
        "music",
        "musical_instruments",
        "sports_leisure",
        "stationery",
        "toys",
    ],
    "Food, Beverage & Party": [
        "drinks",
        "food",
        "food_drink",
        "party_supplies",
        "christmas_supplies",
    ],
    "Automotive, Industrial & B2B": [
        "auto",
        "agro_industry_and_commerce",
        "industry_commerce_and_business",
        "market_place",
        "security_and_services",
        "signaling_and_security",
    ],
}
BUCKET_OF = {name: bucket for bucket, names in CATEGORY_BUCKETS.items() for name in names}


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp AS order_purchase_at",
        "order_approved_at",
        "order_delivered_carrier_date AS order_delivered_carrier_at",
        "order_delivered_customer_date AS order_delivered_customer_at",
        "order_estimated_delivery_date AS order_estimated_delivery_at",
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    """Pass-through; a source without item ids or limits yields a narrower table."""
    wanted = [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ]
    return items.select(*[c for c in wanted if c in items.columns])


def stg_order_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    new_names = {
        "zip_code_prefix": "zip_code_prefix",
        "lat": "latitude",
        "lng": "longitude",
        "city": "city",
        "state": "state",
    }
    return geolocation.selectExpr(*[f"geolocation_{o} AS {n}" for o, n in new_names.items()])


def stg_product_cat_buckets(translation: DataFrame) -> DataFrame:
    """Every category with the bucket of its English name."""
    return translation.select(
        "product_category_name",
        "product_category_name_english",
        relabel("product_category_name_english", BUCKET_OF, otherwise=NO_BUCKET).alias(
            "product_category_buckets"
        ),
    )


def stg_products(products: DataFrame, buckets: DataFrame) -> DataFrame:
    """Products with their English category and bucket (J-3).

    A null category is filled before the lookup. The category table is left to
    Spark's own size check: small ones are broadcast, large ones are not.
    """
    named = products.fillna(UNCATEGORIZED, ["product_category_name"])
    found = named.join(buckets, "product_category_name", "left")
    found = found.fillna(
        {"product_category_name_english": UNCATEGORIZED, "product_category_buckets": NO_BUCKET}
    )
    return found.selectExpr(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_category_buckets",
        "product_name_lenght AS product_name_length",
        "product_description_lenght AS product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )

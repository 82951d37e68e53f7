"""All models over one set of raw tables, built on first use."""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame

from freightlens.plans import core, intermediate, marts, staging
from freightlens.session import written


class Layers:
    """Staging, star schema and marts as lazy DataFrames.

    ``raw`` has one attribute per raw table. ``items`` may replace its order
    items by a narrower variant. Nothing runs here but for the small table of
    centroids; each attribute is the plan of one model.
    """

    def __init__(self, raw: Any, items: DataFrame | None = None) -> None:
        self.raw = raw
        self._items = items

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(
            self.raw.order_items if self._items is None else self._items
        )

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw.order_reviews)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw.geolocation)

    @cached_property
    def stg_product_cat_buckets(self) -> DataFrame:
        return staging.stg_product_cat_buckets(self.raw.product_category_name_translation)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products, self.stg_product_cat_buckets)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return core.dim_customer(self.stg_customers)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return core.dim_seller(self.stg_sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(self.stg_products)

    @cached_property
    def dim_date(self) -> DataFrame:
        return core.dim_date(core.order_span(self.stg_orders))

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return core.dim_geolocation(self.stg_geolocation)

    @cached_property
    def zip_centroids(self) -> DataFrame:
        """Written on first use, since every distance reads it twice."""
        return written(core.zip_centroids(self.stg_geolocation), "zip-centroids")

    @cached_property
    def stages(self) -> DataFrame:
        return intermediate.order_delivery_stages(self.stg_orders)

    @cached_property
    def order_facts(self) -> DataFrame:
        return core.order_facts(self.stages, self.stg_order_items, self.stg_order_reviews)

    @cached_property
    def order_amounts(self) -> DataFrame:
        """The order facts without seller columns."""
        return core.order_facts(
            self.stages, self.stg_order_items, self.stg_order_reviews, with_sellers=False
        )

    @cached_property
    def item_facts(self) -> DataFrame:
        return core.item_facts(self.stg_order_items, self.stages)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return core.fact_orders(self.order_facts, self.stg_order_items)

    def shapes(self, **limits: float) -> DataFrame:
        return intermediate.order_transit_shape(
            self.order_facts, self.dim_seller, self.dim_customer, **limits
        )

    @cached_property
    def distances(self) -> DataFrame:
        return intermediate.seller_customer_distance(
            self.stg_order_items,
            self.stg_orders,
            self.dim_seller,
            self.dim_customer,
            self.zip_centroids,
        )

    @cached_property
    def place_distances(self) -> DataFrame:
        """Written on first use, since later models only look distances up."""
        found = intermediate.place_distances(
            self.stg_orders, self.stg_order_items, self.dim_seller, self.dim_customer, self.zip_centroids
        )
        return written(found, "place-distances")

    @cached_property
    def mart_delivery_kpis(self) -> DataFrame:
        return marts.mart_delivery_kpis(self.order_amounts, self.dim_customer)

    @cached_property
    def mart_monthly_sales(self) -> DataFrame:
        return marts.mart_monthly_sales(self.order_amounts)

    @cached_property
    def mart_satisfaction_by_delivery(self) -> DataFrame:
        return marts.mart_satisfaction_by_delivery(self.order_amounts)

    @cached_property
    def mart_delivery_delay_stages(self) -> DataFrame:
        return marts.mart_delivery_delay_stages(self.order_amounts)

    @cached_property
    def mart_pdt_delivery(self) -> DataFrame:
        return marts.mart_pdt_delivery(self.item_facts, self.dim_products)

    def mart_delay_pdt_vs_dist(self, grain: str = "order_pairs") -> DataFrame:
        return marts.mart_delay_pdt_vs_dist(
            self.stg_order_items,
            self.dim_products,
            self.order_amounts,
            self.dim_seller,
            self.dim_customer,
            self.zip_centroids,
            grain,
        )

    @cached_property
    def mart_seller_perf(self) -> DataFrame:
        return marts.mart_seller_perf(self.stg_order_items, self.stages, self.dim_seller)

    @cached_property
    def mart_seller_performance(self) -> DataFrame:
        return marts.mart_seller_performance(self.stg_order_items, self.stages)

    def mart_delivery_revenue_risk(self, order_grain: bool = False) -> DataFrame:
        return marts.mart_delivery_revenue_risk(self.order_amounts, self.dim_customer, order_grain)

    def mart_delivery_sunburst(self, order_grain: bool = False) -> DataFrame:
        return marts.mart_delivery_sunburst(self.order_amounts, self.dim_customer, order_grain)

    def mart_transit_drivers(self, **limits: float) -> DataFrame:
        return marts.mart_transit_drivers(self.shapes(**limits))

    def mart_transit_unclassified(self, **limits: float) -> DataFrame:
        return marts.mart_transit_unclassified(self.shapes(**limits))

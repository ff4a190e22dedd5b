"""The rules of each entity. Domain sets are parameters; the defaults are the fixed ones."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.functions import contains_ignoring_case, is_one_of
from tradegrain.operators.rules import Action, Rule
from tradegrain.sources.schemas import CATEGORIES, CURRENCY, DISCOUNTS, REGIONS, SEGMENTS

# The last day of the clean history, the cost band and the price band.
HISTORY_END = "2026-05-31"
COST_BAND = ("0.62", "0.80")
PRICE_BAND = "0.08"


def customer_rules(regions: Iterable[str] = REGIONS, segments: Iterable[str] = SEGMENTS,
                   on_region: Action = "warn") -> list[Rule]:
    """An unknown region only warns: the outlet is real and has orders that refer to it."""
    name = F.col("customer_name")
    return [
        Rule("customer_id_present", F.col("customer_id").isNotNull()),
        Rule("region_known", is_one_of(F.col("region"), regions), on_region),
        Rule("segment_known", is_one_of(F.col("segment"), segments)),
        Rule("name_not_test", ~contains_ignoring_case(name, "test")),
    ]


def product_rules() -> list[Rule]:
    return [
        Rule("product_id_present", F.col("product_id").isNotNull()),
        Rule("list_price_positive", F.col("list_price") > 0),
    ]


def order_rules(today: date | str | Column = HISTORY_END) -> list[Rule]:
    if not isinstance(today, Column):
        today = F.lit(today).cast("date")
    return [
        Rule("customer_id_present", F.col("customer_id").isNotNull()),
        Rule("product_id_present", F.col("product_id").isNotNull()),
        Rule("quantity_positive", F.col("quantity") > 0),
        Rule("discount_in_range", F.col("discount_pct").between(0, 100)),
        Rule("order_date_not_future", F.col("order_date") <= today),
    ]


def domain_rules_products(categories: Iterable[str] = CATEGORIES) -> list[Rule]:
    """Stated properties of clean products, none of them seeded: they only warn."""
    low, high = (F.lit(x).cast("decimal(3,2)") for x in COST_BAND)
    price, cost = F.col("list_price"), F.col("cost")
    pence = F.lit("0.005").cast("decimal(4,3)")         # cost is rounded to whole pence
    return [
        Rule("category_known", is_one_of(F.col("category"), categories), "warn"),
        Rule("cost_in_band", cost.between(price * low - pence, price * high + pence), "warn"),
    ]


def domain_rules_orders(discounts: Iterable[int] = DISCOUNTS) -> list[Rule]:
    return [
        Rule("discount_known", F.col("discount_pct").isin(list(discounts)), "warn"),
        Rule("discount_whole", F.col("discount_pct") == F.floor("discount_pct"), "warn"),
        Rule("currency_known", F.col("currency") == CURRENCY, "warn"),
    ]


def price_band(lines: DataFrame, products: DataFrame, band: str = PRICE_BAND) -> DataFrame:
    """Lines per product sold outside the band around the list price.

    Each product's sold prices are counted first; the join sees one row per product and price.
    """
    prices = (lines.groupBy("product_id", "unit_price")
              .agg(F.count(F.lit(1)).alias("lines")))
    allowed = F.col("list_price") * F.lit(band).cast("decimal(5,4)")
    pence = F.lit("0.005").cast("decimal(4,3)")
    outside = F.abs(F.col("unit_price") - F.col("list_price")) > allowed + pence
    return (prices.join(products.select("product_id", "list_price"), "product_id")
            .groupBy("product_id")
            .agg(F.sum("lines").alias("lines"),
                 F.sum(F.when(outside, F.col("lines")).otherwise(0)).alias("outside"))
            .filter("outside > 0"))

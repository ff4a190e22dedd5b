"""Order lines summed once to customer x product, and the views of a customer built on that."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.functions import AVERAGE, MONEY, line_revenue, per_unit_of, rolling_start
from tradegrain.session import BROADCAST_ROWS


def anchor_date(lines: DataFrame) -> DataFrame:
    """The latest order date over all lines, also those of unknown products: one row."""
    return lines.agg(F.max("order_date").alias("as_of_date"))


def as_of_column(lines: DataFrame, as_of: date | str | None) -> Column:
    """The given date, or the anchor date as a scalar subquery (computed once, then constant)."""
    if as_of is None:
        return anchor_date(lines).scalar()
    return F.lit(as_of).cast("date")


def until(lines: DataFrame, as_of: date | str | None) -> DataFrame:
    """The history known on the given date."""
    return lines if as_of is None else lines.filter(F.col("order_date") <= F.lit(as_of).cast("date"))


def line_facts(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Each line of a known product with its category, revenue and profit."""
    revenue = line_revenue()
    return (lines.join(products.select("product_id", "category", "cost"), "product_id")
            .select("order_id", "customer_id", "product_id", "order_date", "quantity", "category",
                    revenue.alias("revenue"),
                    (revenue - F.col("quantity") * F.col("cost")).alias("profit")))


def customer_product_grain(lines: DataFrame, products: DataFrame, as_of: Column,
                           months: int = 12) -> DataFrame:
    """One row per customer and known product: lifetime and rolling sums.

    The lines are summed before they meet the products (cost is constant per product), so the
    one shuffle of the facts is of sums by both keys: neither a customer nor a product with a
    third of the lines ends up on one task.
    """
    revenue, recent = F.col("revenue"), F.col("recent")
    # Units of lines without revenue carry no cost either, as profit is NULL on those lines.
    costed = F.when(revenue.isNotNull(), F.col("quantity"))
    amounts = lines.select(
        "order_id", "customer_id", "product_id", "order_date", "quantity",
        line_revenue().alias("revenue"),
        (F.col("order_date") > rolling_start(as_of, months)).alias("recent"))
    sums = amounts.groupBy("customer_id", "product_id").agg(
        F.count("order_id").alias("orders"),
        F.count(revenue).alias("priced"),
        F.sum("quantity").alias("units"),
        F.sum(revenue).alias("revenue"),
        F.sum(costed).alias("costed_units"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_if(recent).alias("r12_lines"),
        F.count(F.when(recent, F.col("order_id"))).alias("r12_orders"),
        F.sum(F.when(recent, revenue)).alias("r12_revenue"),
        F.sum(F.when(recent, costed)).alias("r12_costed_units"))
    return (sums.join(products.select("product_id", "category", "cost"), "product_id")
            .select("customer_id", "product_id", "category", "orders", "priced", "units",
                    "revenue", (F.col("revenue") - F.col("costed_units") * F.col("cost"))
                    .alias("profit"),
                    "first_order_date", "last_order_date", "r12_lines", "r12_orders",
                    "r12_revenue",
                    (F.col("r12_revenue") - F.col("r12_costed_units") * F.col("cost"))
                    .alias("r12_profit")))


def grain_for_one_use(lines: DataFrame, products: DataFrame, as_of: Column,
                      months: int = 12) -> DataFrame:
    """The grain for a view that is taken of it alone, when nothing else reads it.

    Each line is a row of its own: the view then sums them by customer in one shuffle, as pairs of
    customer and product hardly repeat. Products are sent to the lines where they are few enough;
    else the lines go to them once, with the columns that the view takes.
    """
    known = products.select("product_id", "category", "cost")
    if products.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    revenue = line_revenue()
    costed = F.when(revenue.isNotNull(), F.col("quantity")) * F.col("cost")
    recent = F.col("order_date") > rolling_start(as_of, months)
    counted, priced = (F.when(c.isNotNull(), 1).otherwise(0).cast("long")
                       for c in (F.col("order_id"), revenue))
    return (lines.join(known, "product_id")
            .select("customer_id", "product_id", "category", counted.alias("orders"),
                    priced.alias("priced"), F.col("quantity").cast("long").alias("units"),
                    revenue.alias("revenue"), (revenue - costed).alias("profit"),
                    F.col("order_date").alias("first_order_date"),
                    F.col("order_date").alias("last_order_date"),
                    F.when(recent, 1).otherwise(0).cast("long").alias("r12_lines"),
                    F.when(recent, counted).otherwise(0).alias("r12_orders"),
                    F.when(recent, revenue).alias("r12_revenue"),
                    F.when(recent, revenue - costed).alias("r12_profit")))


def lifetime(grain: DataFrame) -> DataFrame:
    return grain.groupBy("customer_id").agg(*_lifetime())


def rolling(grain: DataFrame) -> DataFrame:
    """Customers with lines in the rolling window."""
    return grain.filter("r12_lines > 0").groupBy("customer_id").agg(*_rolling())


def rolling_only(lines: DataFrame, products: DataFrame, as_of: date | str,
                 months: int = 12) -> DataFrame:
    """`rolling` without the rest of the grain: only the lines of the window are read and summed,
    since the given date reaches the scan as a filter."""
    day = F.lit(as_of).cast("date")
    window = until(lines, as_of).filter(F.col("order_date") > rolling_start(day, months))
    return rolling(grain_for_one_use(window, products, day, months))


def category_rank(grain: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums per customer and category, numbered by falling revenue, then by category; each `by`
    apart."""
    sums = grain.groupBy("customer_id", *by, "category").agg(
        *[F.sum(c).alias(c) for c in ("orders", "priced", "units", "revenue", "profit",
                                      "r12_orders", "r12_revenue", "r12_profit")],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"))
    by_revenue = Window.partitionBy("customer_id", *by).orderBy(
        F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_first())
    return sums.withColumn("rn", F.row_number().over(by_revenue))


def top_categories(grain: DataFrame) -> DataFrame:
    """The two categories with the largest revenue per customer, as columns."""
    return category_rank(grain).filter("rn <= 2").groupBy("customer_id").agg(*_top_two())


def customer_rollup(grain: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lifetime, rolling and top-category columns from one pass over the grain, each `by` apart.

    A window over the few categories of a customer and the final sum share one partitioning.
    """
    return (category_rank(grain, by).groupBy("customer_id", *by)
            .agg(*_lifetime(), *_rolling(), *_top_two()))


def purchased(grain: DataFrame) -> DataFrame:
    """Distinct customer and product pairs: the keys of the grain."""
    return grain.select("customer_id", "product_id")


def segment_popularity(grain: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct buyers per segment and product; the grain has one row per buyer and product."""
    return (purchased(grain).join(customers.select("customer_id", "segment"), "customer_id")
            .groupBy("segment", "product_id").agg(F.count(F.lit(1)).alias("buyers")))


def _lifetime() -> list[Column]:
    return [
        F.sum("orders").alias("lifetime_orders"),
        F.sum("units").alias("lifetime_units"),
        F.round(F.sum("revenue"), 2).cast(MONEY).alias("lifetime_revenue"),
        F.round(F.sum("profit"), 2).cast(MONEY).alias("lifetime_profit"),
        F.round(per_unit_of(F.sum("revenue"), F.sum("priced")), 2).cast(AVERAGE)
         .alias("avg_order_value"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    ]


def _rolling() -> list[Column]:
    return [
        F.sum("r12_orders").alias("r12_orders"),
        F.round(F.sum("r12_revenue"), 2).cast(MONEY).alias("r12_revenue"),
        F.round(F.sum("r12_profit"), 2).cast(MONEY).alias("r12_profit"),
    ]


def _top_two() -> list[Column]:
    return [F.max(F.when(F.col("rn") == n, F.col("category"))).alias(f"top_category_{n}")
            for n in (1, 2)]

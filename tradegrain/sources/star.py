"""The TPC-H-like tables seen as customers, products and order lines.

Columns those tables lack are stand-ins computed from columns they have:
account_manager is the nation, join_date follows from the key, cost is 70 % of the list
price, and the unit price is the extended price over the quantity, in whole pence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of these tables.
STAR_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STAR_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STAR_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@dataclass(frozen=True)
class Star:
    customers: DataFrame
    products: DataFrame
    lines: DataFrame


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_star(spark: SparkSession, folder: str) -> Star:
    return Star(
        customers_from(*(table(spark, folder, n) for n in ("customer", "nation", "region"))),
        products_from(table(spark, folder, "part")),
        lines_from(table(spark, folder, "lineitem"), table(spark, folder, "orders")))


def customers_from(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return (customer
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("segment"),
                F.col("n_name").alias("account_manager"),
                F.date_add(F.lit("1994-01-01").cast("date"),
                           (F.col("c_custkey") % 365).cast("int")).alias("join_date")))


def products_from(part: DataFrame) -> DataFrame:
    list_price = F.col("p_retailprice").cast("decimal(10,2)")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        list_price.alias("list_price"),
        (list_price * F.lit("0.70").cast("decimal(3,2)")).cast("decimal(10,2)").alias("cost"))


def lines_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines; works the same when `lineitem` is a stream."""
    return (lineitem
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                F.col("l_quantity").cast("int").alias("quantity"),
                _unit_price().alias("unit_price"),
                (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
                F.lit("GBP").alias("currency")))


def _unit_price() -> Column:
    pence = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (F.floor(pence / F.col("l_quantity")).cast("decimal(10,0)")
            * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)")


# --- the same tables with quality issues seeded by rule ------------------------------------

def customers_with_issues(customers: DataFrame) -> DataFrame:
    number = F.col("customer_id")
    return customers.withColumns({
        "region": F.when(number % 41 == 0, "EMEA")
                   .when(number % 43 == 0, F.concat(F.lit(" "), F.lower("region")))
                   .otherwise(F.col("region")),
        "segment": F.when(number % 53 == 0, "TEST").otherwise(F.col("segment")),
        "customer_name": F.when(number % 59 == 0, F.concat(F.lit("QA Test "), "customer_name"))
                          .otherwise(F.col("customer_name")),
        "customer_id": F.when(number % 61 != 0, number),
    })


def products_with_issues(products: DataFrame) -> DataFrame:
    number = F.col("product_id")
    return products.withColumns({
        "list_price": F.when(number % 67 == 0, F.lit(0).cast("decimal(10,2)"))
                       .otherwise(F.col("list_price")),
        "product_id": F.when(number % 71 != 0, number),
    })


def lines_with_issues(lines: DataFrame) -> DataFrame:
    """Beside the seeded issues, line keys repeat in the tables themselves."""
    number = F.col("order_id")
    bad_discount = F.when(number % 2 == 0, -10).otherwise(150).cast("decimal(5,2)")
    return lines.withColumns({
        "customer_id": F.when(number % 251 != 0, F.col("customer_id")),
        "product_id": F.when(number % 241 != 0, F.col("product_id")),
        "quantity": F.when(number % 257 == 0, -(number % 2).cast("int"))
                     .otherwise(F.col("quantity")),
        "discount_pct": F.when(number % 263 == 0, bad_discount)
                         .otherwise(F.col("discount_pct")),
        "order_date": F.when(number % 269 == 0, F.date_add("order_date", 2600))
                       .otherwise(F.col("order_date")),
    })


# --- the same tables with values outside the stated domains --------------------------------

def products_off_domain(products: DataFrame) -> DataFrame:
    number = F.col("product_id")
    return products.withColumns({
        "category": F.when(number % 73 == 0, "Mixed").otherwise(F.col("category")),
        "cost": F.when(number % 79 == 0, F.col("list_price")).otherwise(F.col("cost")),
    })


def lines_off_domain(lines: DataFrame) -> DataFrame:
    number = F.col("order_id")
    half = (F.col("discount_pct") + F.lit("0.5").cast("decimal(2,1)")).cast("decimal(5,2)")
    return lines.withColumns({
        "discount_pct": F.when(number % 281 == 0, half).otherwise(F.col("discount_pct")),
        "currency": F.when(number % 277 == 0, "EUR").otherwise(F.col("currency")),
    })


# --- raw entities as JSON lines, with faults that only their reader meets ------------------

def json_lines(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One column of text per entity. Some dates and prices are words, some lines lack a key, and
    some are cut off."""
    number = F.col("customer_id")
    customers = raw["customers"].withColumn("join_date", F.when(number % 47 == 0, "soon").otherwise(
        F.col("join_date").cast("string")))
    number = F.col("product_id")
    products = raw["products"].withColumn("list_price", F.when(number % 83 == 0, "oops").otherwise(
        F.col("list_price").cast("string")))
    orders = raw["orders"].withColumn("order_id", F.when(F.col("order_id") % 307 != 0,
                                                         F.col("order_id")))
    whole = F.to_json(F.struct(*orders.columns))
    return {"customers": customers.select(F.to_json(F.struct(*customers.columns)).alias("value")),
            "products": products.select(F.to_json(F.struct(*products.columns)).alias("value")),
            "orders": orders.select(F.when(F.col("order_id") % 293 == 0,
                                           F.regexp_replace(whole, "}$", "")).otherwise(whole)
                                    .alias("value"))}

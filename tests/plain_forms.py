"""The direct forms of the operators, used to check the distributed ones on small tables.

They use the windows, the product of customers and products, and the one-branch-per-metric
joins that the library avoids, so they are for tests and for timing comparisons only.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.operators.grain import line_facts


def next_best(customers: DataFrame, products: DataFrame, bought: DataFrame) -> DataFrame:
    owners = bought.select("customer_id", "product_id").distinct()
    buyers = (owners.join(customers.select("customer_id", "segment"), "customer_id")
              .groupBy("segment", "product_id").agg(F.count("*").alias("buyers")))
    open_pairs = (customers.select("customer_id", "segment")
                  .crossJoin(products.select("product_id", "product_name"))
                  .join(owners, ["customer_id", "product_id"], "left_anti")
                  .join(buyers, ["segment", "product_id"], "left"))
    best = Window.partitionBy("customer_id").orderBy(
        F.coalesce("buyers", F.lit(0)).desc(), "product_id")
    first = open_pairs.withColumn("n", F.row_number().over(best)).filter("n = 1")
    return customers.select("customer_id").join(
        first.select("customer_id", F.col("product_id").alias("cross_sell_product_id"),
                     F.col("product_name").alias("cross_sell_product_name")),
        "customer_id", "left")


def scorecard(customers: DataFrame, products: DataFrame, lines: DataFrame) -> DataFrame:
    facts = line_facts(lines, products)
    anchor = lines.agg(F.max("order_date").alias("d"))
    life = facts.groupBy("customer_id").agg(
        F.count("order_id").alias("lifetime_orders"), F.sum("quantity").alias("lifetime_units"),
        F.round(F.sum("revenue"), 2).alias("lifetime_revenue"),
        F.round(F.sum("profit"), 2).alias("lifetime_profit"),
        F.round(F.avg("revenue"), 2).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))
    r12 = (facts.crossJoin(anchor).filter(F.col("order_date") > F.add_months("d", -12))
           .groupBy("customer_id").agg(
               F.count("order_id").alias("r12_orders"),
               F.round(F.sum("revenue"), 2).alias("r12_revenue"),
               F.round(F.sum("profit"), 2).alias("r12_profit")))
    by_revenue = Window.partitionBy("customer_id").orderBy(F.desc("spent"), "category")
    tops = (facts.groupBy("customer_id", "category").agg(F.sum("revenue").alias("spent"))
            .withColumn("n", F.row_number().over(by_revenue))
            .groupBy("customer_id").agg(
                F.max(F.when(F.col("n") == 1, F.col("category"))).alias("top_category_1"),
                F.max(F.when(F.col("n") == 2, F.col("category"))).alias("top_category_2")))
    offers = next_best(customers, products, facts)
    c, zero = F.col, F.lit(0)

    def pct(profit, revenue):
        return F.round(100 * F.coalesce(c(profit), zero) / F.nullif(c(revenue), zero), 2)

    base = (customers.join(life, "customer_id", "left").join(r12, "customer_id", "left")
            .join(tops, "customer_id", "left").join(offers, "customer_id", "left")
            .crossJoin(anchor)
            .withColumns({
                "tenure_days": F.datediff("d", "join_date"),
                "recency_days": F.datediff("d", "last_order_date"),
                "lifetime_margin_pct": pct("lifetime_profit", "lifetime_revenue"),
                "r12_margin_pct": pct("r12_profit", "r12_revenue"),
                **{n: F.coalesce(n, zero) for n in (
                    "lifetime_orders", "lifetime_units", "lifetime_revenue", "lifetime_profit",
                    "avg_order_value", "r12_orders", "r12_revenue", "r12_profit")}})
            .withColumns({"frequency_12m": c("r12_orders"), "monetary_12m": c("r12_revenue")}))
    w, all_rows = Window.orderBy, Window.partitionBy(F.lit(0))
    top = lambda n: F.nullif(F.max(n).over(all_rows), zero)
    return (base.withColumns({
        "top_categories": F.concat_ws(" | ", "top_category_1", "top_category_2"),
        "r_score": F.ntile(5).over(w(c("recency_days").desc_nulls_last(), "customer_id")),
        "f_score": F.ntile(5).over(w("frequency_12m", "customer_id")),
        "m_score": F.ntile(5).over(w("monetary_12m", "customer_id")),
        "revenue_percentile": F.round(100 * F.percent_rank().over(w("lifetime_revenue")), 1),
        "revenue_percentile_in_segment": F.round(100 * F.percent_rank().over(
            Window.partitionBy("segment").orderBy("lifetime_revenue")), 1),
        "at_risk_score": F.round(100 * (
            0.6 * (c("recency_days") / top("recency_days"))
            + 0.4 * (1 - c("frequency_12m") / top("frequency_12m"))), 1)})
        .withColumn("rfm_cell", F.concat(F.lit("R"), "r_score", F.lit("F"), "f_score",
                                         F.lit("M"), "m_score"))
        .withColumn("at_risk_flag", F.coalesce((c("r_score") <= 2) & (c("m_score") >= 4),
                                               F.lit(False)))
        .drop("d"))

"""The governed sales measures over order lines, customers and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.functions import line_revenue, month_of
from tradegrain.plans.metric_view import Dimension, Distinct, Join, MetricView, Ratio, Total


def sales_metrics(lines: DataFrame, customers: DataFrame, products: DataFrame,
                  **settings) -> MetricView:
    """Lines whose customer or product is unknown stay in: their dimensions are NULL, and
    without a product cost they add to revenue but not to profit."""
    revenue = line_revenue()
    profit = F.col("_p_revenue") - F.col("_p_costed_units") * F.col("_a_products_cost")
    return MetricView(
        source=lines,
        joins={"customers": Join(customers, "customer_id", "customer_id"),
               "products": Join(products, "product_id", "product_id")},
        parts={
            "revenue": revenue,
            "costed_units": F.when(revenue.isNotNull(), F.col("quantity")),
            "lines": F.when(F.col("order_id").isNotNull(), F.lit(1)),
            "units": F.col("quantity"),
        },
        dimensions={
            "Region": Dimension("region", "customers"),
            "Segment": Dimension("segment", "customers"),
            "Account Manager": Dimension("account_manager", "customers"),
            "Category": Dimension("category", "products"),
            "Order Month": Dimension(month_of(F.col("order_date"))),
        },
        measures={
            "Total Revenue": Total(F.col("_p_revenue"), ("revenue",)),
            "Total Profit": Total(profit, ("revenue", "costed_units"),
                                  (("products", "cost"),)),
            "Profit Margin %": Ratio("Total Profit", "Total Revenue", 100),
            "Order Count": Total(F.col("_p_lines"), ("lines",), counts=True),
            "Units Sold": Total(F.col("_p_units"), ("units",)),
            "Avg Order Value": Ratio("Total Revenue", "Order Count"),
            "Distinct Customers": Distinct("customer_id"),
        },
        comment="Governed sales measures over clean order lines.",
        **settings)


def margin_by_segment(view: MetricView) -> DataFrame:
    """Revenue, profit, margin and lines per segment, largest revenue first."""
    found = view.query(["Segment"],
                       ["Total Revenue", "Total Profit", "Profit Margin %", "Order Count"])
    return found.select(
        "Segment",
        F.round("Total Revenue", 2).alias("revenue"),
        F.round("Total Profit", 2).alias("profit"),
        F.round("`Profit Margin %`", 2).alias("margin_pct"),
        F.col("Order Count").alias("orders"),
    ).orderBy(F.desc("revenue"))

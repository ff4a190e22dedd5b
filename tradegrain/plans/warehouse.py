"""From folders of clean JSON to curated tables, the gold scorecard and the metric view."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradegrain.plans.medallion import table_counts
from tradegrain.plans.metric_view import MetricView
from tradegrain.plans.sales_metrics import sales_metrics
from tradegrain.plans.scorecard import scorecard
from tradegrain.session import settle
from tradegrain.sources.json_files import read_json
from tradegrain.sources.schemas import ENTITIES
from tradegrain.sources.tables import read_table, replace_table

SCORECARD = "gold_customer_scorecard"
COMMENTS = {
    "customers": "One row for each customer, with region, segment and manager",
    "products": "One row for each product, with its category, list price and unit cost",
    "orders": "One row for each order line, priced before discount",
    SCORECARD: "One row for each customer, sorted by customer_id: sums, scores, suggestions",
}


class Warehouse(NamedTuple):
    tables: dict[str, DataFrame]
    metrics: MetricView


def load_entity(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The entity's columns in their types; the schema is known, so nothing is inferred."""
    schema = ENTITIES[entity]
    return read_json(spark, folder, schema).select(
        *[F.col(f.name).cast(f.dataType) for f in schema])


def build(spark: SparkSession, clean: str, database: str) -> Warehouse:
    """Rebuild the tables of `database` from clean/customers, clean/products, clean/orders."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for entity in ENTITIES:
        replace_table(load_entity(spark, f"{clean}/{entity}", entity), f"{database}.{entity}",
                      COMMENTS[entity])
    tables = {entity: read_table(spark, f"{database}.{entity}") for entity in ENTITIES}
    customers, products, orders = (tables[e] for e in ("customers", "products", "orders"))
    # Written before it is sorted, since a range sort reads its rows twice.
    card = settle(scorecard(customers, products, orders), SCORECARD)
    replace_table(card, f"{database}.{SCORECARD}", COMMENTS[SCORECARD], key="customer_id")
    tables[SCORECARD] = read_table(spark, f"{database}.{SCORECARD}")
    return Warehouse(tables, sales_metrics(orders, customers, products))


def row_counts(warehouse: Warehouse) -> DataFrame:
    return table_counts(warehouse.tables)

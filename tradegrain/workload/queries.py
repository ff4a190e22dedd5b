"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from tradegrain.functions import slug
from tradegrain.operators import changes, grain, keys, rules
from tradegrain.operators.digests import diff_by_digests
from tradegrain.operators.next_best import next_best
from tradegrain.operators.ranks import add_ranks
from tradegrain.operators.scales import add_scales
from tradegrain.plans import (
    card_history,
    distinct_counts,
    maintained,
    medallion,
    rollups,
    sales_rules,
    serving,
)
from tradegrain.plans import scorecard as cards
from tradegrain.plans.sales_metrics import margin_by_segment, sales_metrics
from tradegrain.session import scratch_path, settle
from tradegrain.sources import star as tpch
from tradegrain.sources.json_files import CORRUPT, read_json
from tradegrain.sources.landing import land, landed_report
from tradegrain.sources.star import Star, load_star, table
from tradegrain.sources.tables import read_table, replace_table
from tradegrain.streaming import jobs, rolling, waiting

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a query over the star; decimals leave as doubles, as the SQL's do."""
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(load_star(spark, folder)))
    QUERIES[build.__name__] = run
    return build


def table_query(build: Query) -> Query:
    """Register a query that reads the tables itself."""
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(spark, folder))
    QUERIES[build.__name__] = run
    return build


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema])


# --- semantic layer ------------------------------------------------------------------------

MEASURES = {"Total Revenue": "revenue", "Total Profit": "profit", "Profit Margin %": "margin_pct",
            "Order Count": "orders", "Units Sold": "units", "Avg Order Value": "avg_order_value",
            "Distinct Customers": "customers"}


def _view(star: Star):
    return sales_metrics(star.lines, star.customers, star.products)


def _named(df: DataFrame, *dimensions: str) -> DataFrame:
    """Plain column names, amounts rounded to 2 decimals."""
    rounded = ("Total Revenue", "Total Profit", "Profit Margin %", "Avg Order Value")
    return df.select(
        *[F.col(f"`{d}`").alias(d.lower().replace(" ", "_")) for d in dimensions],
        *[(F.round(F.col(f"`{m}`"), 2) if m in rounded else F.col(f"`{m}`")).alias(short)
          for m, short in MEASURES.items() if m in df.columns])


@query
def metric_margin_by_segment(star):
    return margin_by_segment(_view(star))


@query
def metric_by_region(star):
    return _named(_view(star).query(["Region"], list(MEASURES)), "Region")


@query
def metric_by_category(star):
    return _named(_view(star).query(["Category"], list(MEASURES)), "Category")


@query
def metric_by_manager(star):
    return _named(_view(star).query(["Account Manager"], list(MEASURES)), "Account Manager")


@query
def metric_by_month(star):
    return _named(_view(star).query(["Order Month"], list(MEASURES)), "Order Month")


@query
def metric_grand_total(star):
    return _named(_view(star).query([], list(MEASURES)))


@query
def metric_distinct_customers(star):
    return _named(_view(star).query(["Segment", "Category"], ["Distinct Customers"]),
                  "Segment", "Category")


@query
def metric_filtered(star):
    found = _view(star).query(
        ["Order Month", "Category"], ["Total Revenue", "Units Sold"],
        where={"Region": lambda region: region.isin("ASIA", "EUROPE")},
        having={"Order Count": lambda lines: lines >= 10}, order_by=["Order Month", "Category"])
    return _named(found, "Order Month", "Category")


@query
def metric_cube_region_segment(star):
    return _named(_view(star).cube(["Region", "Segment"], list(MEASURES)),
                  "slice", "Region", "Segment")


@query
def metric_slices(star):
    found = _view(star).query_slices([["Region"], ["Category", "Order Month"], []],
                                     ["Total Revenue", "Total Profit", "Distinct Customers"])
    return _named(found, "slice", "Region", "Category", "Order Month")


@query
def metric_slices_filtered(star):
    """Slices of which two are equal, by tested dimensions and measures."""
    found = _view(star).query_slices(
        [["Region"], ["Segment", "Region"], ["Region"]], ["Total Revenue", "Units Sold"],
        where={"Category": lambda category: category.isin("PROMO", "LARGE")},
        having={"Order Count": lambda lines: lines >= 20}, order_by=["slice", "Avg Order Value"])
    return _named(found, "slice", "Region", "Segment")


@query
def metric_join_keys(star):
    """Repeated keys of joined tables, one of which holds some customers twice."""
    twice = star.customers.filter(F.col("customer_id") % 7 == 0)
    return sales_metrics(star.lines, star.customers.unionByName(twice),
                         star.products).repeated_keys()


def _stored(star: Star) -> rollups.StoredView:
    return rollups.store(_view(star), ["Region", "Segment", "Category", "Order Month"],
                         list(MEASURES))


@query
def metric_stored_filtered(star):
    """From a stored rollup: the dimensions asked for, and one that is only tested."""
    found = _stored(star).query(
        ["Order Month"], list(MEASURES),
        where={"Region": lambda region: region.isin("ASIA", "EUROPE")},
        having={"Order Count": lambda lines: lines >= 10})
    return _named(found, "Order Month")


@query
def metric_stored_slices(star):
    """Slices, each from the smallest stored rollup that has its dimensions."""
    found = _stored(star).query_slices([["Region"], ["Category", "Order Month"], []],
                                       ["Total Revenue", "Total Profit", "Distinct Customers"])
    return _named(found, "slice", "Region", "Category", "Order Month")


# --- scorecard and its parts ---------------------------------------------------------------

def _grain(star: Star) -> DataFrame:
    return grain.customer_product_grain(star.lines, star.products,
                                        grain.as_of_column(star.lines, None))


def _lines_grain(star: Star) -> DataFrame:
    return grain.grain_for_one_use(star.lines, star.products,
                                   grain.as_of_column(star.lines, None))


def _activity(star: Star, *columns: str) -> DataFrame:
    anchor = F.lit(grain.anchor_date(star.lines).first()[0]).cast("date")
    rollup = grain.customer_rollup(
        grain.customer_product_grain(star.lines, star.products, anchor))
    return settle(cards.activity(star.customers, rollup, anchor)
                  .select("customer_id", *columns), "activity")


@query
def line_facts(star):
    return grain.line_facts(star.lines, star.products)


@query
def anchor_date(star):
    return grain.anchor_date(star.lines)


@query
def customer_product_grain(star):
    return _grain(star).select("customer_id", "product_id", "orders", "units", "revenue",
                               "profit", "first_order_date", "last_order_date", "r12_orders",
                               "r12_revenue", "r12_profit")


@query
def lifetime(star):
    return grain.lifetime(_lines_grain(star))


@query
def rolling_12m(star):
    return grain.rolling_only(star.lines, star.products, grain.anchor_date(star.lines).first()[0])


@query
def top_categories(star):
    return (grain.top_categories(_lines_grain(star))
            .withColumn("top_categories", cards.top_categories_label()))


@query
def purchased_pairs(star):
    return grain.purchased(_grain(star))


@query
def segment_popularity(star):
    return grain.segment_popularity(_grain(star), star.customers)


@query
def cross_sell(star):
    return next_best(star.customers, star.products,
                     settle(grain.purchased(_grain(star)), "bought"))


@query
def rfm_scores(star):
    card = _activity(star, "recency_days", "frequency_12m", "monetary_12m")
    return add_scales(card, cards.rfm_scales(), "customer_id")


@query
def rfm_cells(star):
    card = _activity(star, "recency_days", "frequency_12m", "monetary_12m")
    scored = add_scales(card, cards.rfm_scales(), "customer_id")
    return (scored.withColumn("rfm_cell", cards.rfm_cell())
            .withColumn("at_risk_flag", cards.at_risk_flag())
            .groupBy("rfm_cell", "at_risk_flag").agg(F.count("*").alias("customers")))


@query
def revenue_percentile(star):
    card = _activity(star, "segment", "lifetime_revenue")
    return add_scales(card, cards.percentile_scales()[:1], "customer_id").drop("segment")


@query
def revenue_percentile_in_segment(star):
    card = _activity(star, "segment", "lifetime_revenue")
    return add_scales(card, cards.percentile_scales()[1:], "customer_id")


@query
def revenue_ranks(star):
    """Unrounded ranks of lifetime revenue, over all customers and within their segment."""
    card = _activity(star, "segment", "lifetime_revenue")
    overall = add_ranks(card, "lifetime_revenue", "customer_id")
    return add_ranks(overall, "lifetime_revenue", "customer_id", ["segment"], "segment_")


@query
def quantity_ranks(star):
    """Ranks of the lines' quantities, of which there are few, within each month."""
    lines = star.lines.select("order_id", "product_id", "quantity",
                              F.trunc("order_date", "MM").alias("order_month"))
    ranked = add_ranks(lines.withColumn("_row", F.struct("order_id", "product_id")), "quantity",
                       "_row", ["order_month"])
    return (ranked.groupBy("order_month", "quantity", "rank", "percent_rank", "cume_dist")
            .agg(F.count(F.lit(1)).alias("lines")))


@query
def distinct_customers_merged(star):
    """Distinct customers by three slices, merged from bitmaps by segment, category and month that
    were built in two loads; the lines are not read again."""
    rows = (star.lines.join(star.customers.select("customer_id", "segment"), "customer_id", "left")
            .join(star.products.select("product_id", "category"), "product_id", "left")
            .withColumn("order_month", F.trunc("order_date", "MM")))
    fine = ["segment", "category", "order_month"]
    loads = [distinct_counts.build_bitmaps(rows.where(F.col("order_id") % 2 == i), fine,
                                           "customer_id") for i in (0, 1)]
    stored = settle(distinct_counts.add_bitmaps(*loads), "bitmaps")
    late = F.col("order_month") >= F.lit("1998-01-01").cast("date")
    slices = [([], None), (["segment"], None), (["category", "order_month"], late)]
    found = [distinct_counts.distinct_count(stored, names, where, "customers").select(
        F.lit(i).alias("slice"), *[
            (F.col(c) if c in names else F.lit(None).cast(stored.schema[c].dataType)).alias(c)
            for c in fine], "customers") for i, (names, where) in enumerate(slices)]
    return reduce(DataFrame.unionByName, found)


@query
def at_risk(star):
    card = _activity(star, "recency_days", "frequency_12m")
    return card.withColumn("at_risk_score", cards.at_risk_score(card))


@query
def scorecard(star):
    return cards.scorecard(star.customers, star.products, star.lines).drop("computed_at")


@query
def scorecard_from_silver(star):
    """The card over the cleaned tables, as the medallion pipeline builds it."""
    customers, products, lines = (settle(_silver(star, name).table, "silver")
                                  for name in ("customers", "products", "orders"))
    return cards.scorecard(customers, products, lines).drop("computed_at")


SCORECARD_AS_OF = "1999-06-30"
EARLY = "1995-03-31"      # most customers have no line until then
FIRST_JOINED = "1994-01-01"


@query
def scorecard_as_of_early(star):
    return cards.scorecard(star.customers, star.products, star.lines,
                           as_of=EARLY).drop("computed_at")


@query
def scorecard_as_of(star):
    return cards.scorecard(star.customers, star.products, star.lines,
                               as_of=SCORECARD_AS_OF).drop("computed_at")


CARD_DATES = ("1993-02-28", EARLY, "1996-02-29", "1996-03-31", SCORECARD_AS_OF)


@query
def scorecards_of_dates(star):
    """Cards of several dates, but for the offer, from one pass over the lines."""
    return card_history.scorecards(star.customers, star.products, star.lines, CARD_DATES)


# --- data quality and the bronze, silver and gold layers -----------------------------------

def _raw(star: Star) -> dict[str, DataFrame]:
    return {"customers": tpch.customers_with_issues(star.customers),
            "products": tpch.products_with_issues(star.products),
            "orders": tpch.lines_with_issues(star.lines)}


def _entity(star: Star, name: str) -> medallion.Entity:
    """Only the rules of the lines need the last day of the lines."""
    if name == "customers":
        return medallion.Entity(
            name, star.customers.schema, "customer_id",
            sales_rules.customer_rules(tpch.STAR_REGIONS, tpch.STAR_SEGMENTS),
            {"region": tpch.STAR_REGIONS, "segment": tpch.STAR_SEGMENTS})
    if name == "products":
        return medallion.Entity(name, star.products.schema, "product_id",
                                sales_rules.product_rules(), {"category": tpch.STAR_CATEGORIES})
    today = grain.anchor_date(star.lines).first()[0]
    return medallion.Entity(name, star.lines.schema, "order_id", sales_rules.order_rules(today))


def _entities(star: Star) -> dict[str, medallion.Entity]:
    return {name: _entity(star, name) for name in ("customers", "products", "orders")}


def _violations(star: Star, name: str) -> DataFrame:
    entity = _entity(star, name)
    return rules.violations(medallion.normalise(_raw(star)[name], entity), entity.rules, name)


def _silver(star: Star, name: str) -> medallion.Silver:
    return medallion.silver(_raw(star)[name], _entity(star, name))


def _joined_rules(quarantine: DataFrame) -> DataFrame:
    return quarantine.withColumn(rules.FAILED, F.concat_ws(",", F.sort_array(rules.FAILED)))


@query
def dq_customers(star):
    return _violations(star, "customers")


@query
def dq_products(star):
    return _violations(star, "products")


@query
def dq_orders(star):
    return _violations(star, "orders")


@query
def dq_issue_summary(star):
    return medallion.issue_summary(_raw(star), _entities(star))


@query
def dq_domain(star):
    return (rules.violations(tpch.products_off_domain(star.products),
                             sales_rules.domain_rules_products(tpch.STAR_CATEGORIES), "products")
            .unionByName(rules.violations(tpch.lines_off_domain(star.lines),
                                          sales_rules.domain_rules_orders(), "orders")))


@query
def dq_actions(star):
    """Lines by what becomes of them: a line without positive quantity is dropped, one that breaks
    another rule is set aside, and one without a key would end the job."""
    entity = _entity(star, "orders")
    actions = [replace(rule, action="drop") if rule.name == "quantity_positive" else rule
               for rule in entity.rules]
    actions.append(rules.Rule("order_id_present", F.col("order_id").isNotNull(), "fail"))
    parts = rules.split(rules.apply_rules(_raw(star)["orders"], actions), actions)
    return reduce(DataFrame.unionByName, [
        rows.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"))
        for part, rows in parts._asdict().items()])


@query
def silver_counters(star):
    """Rows and violations per entity and rule, counted while the silver tables were written."""
    return medallion.counts_of({name: _silver(star, name) for name in _raw(star)})


@query
def silver_dropped_and_warned(star):
    """Lines that a rule drops, and customers that stay with a warning."""
    entity = _entity(star, "orders")
    actions = [replace(rule, action="drop") if rule.name == "quantity_positive" else rule
               for rule in entity.rules]
    dropped = medallion.silver(_raw(star)["orders"], replace(entity, rules=actions)).dropped
    return _joined_rules(
        dropped.select(F.lit("dropped").alias("part"), F.col("order_id").cast("string")
                       .alias("key"), rules.FAILED)
        .unionByName(_silver(star, "customers").warned.select(
            F.lit("warned").alias("part"), F.col("customer_id").cast("string").alias("key"),
            rules.FAILED)))


@query
def dq_price_band(star):
    return sales_rules.price_band(star.lines, star.products)


@query
def dq_orphans(star):
    """Lines whose customer or product is gone from the silver tables."""
    silver_customers = _silver(star, "customers").table
    silver_products = _silver(star, "products").table
    found = [keys.orphans(star.lines, key, dimension, key)
             .select(F.lit(key).alias("foreign_key"), F.col(key).alias("value"), "rows")
             for key, dimension in (("customer_id", silver_customers),
                                    ("product_id", silver_products))]
    return found[0].unionByName(found[1])


@query
def dq_repeated_keys(star):
    return keys.repeated_keys(star.lines, ["order_id"])


@query
def dedupe_lines(star):
    return keys.keep_one(star.lines, ["order_id"])


@query
def silver_customers(star):
    return _silver(star, "customers").table


@query
def silver_products(star):
    return _silver(star, "products").table


@query
def silver_orders(star):
    return _silver(star, "orders").table


@query
def quarantine_customers(star):
    return _joined_rules(_silver(star, "customers").quarantine)


@query
def quarantine_products(star):
    return _joined_rules(_silver(star, "products").quarantine)


@query
def quarantine_orders(star):
    return _joined_rules(_silver(star, "orders").quarantine)


@query
def reconciliation(star):
    raw = _raw(star)
    return medallion.reconciliation({name: _silver(star, name).table for name in raw}, raw)


@query
def gold_region_month(star):
    customers, products = (settle(_silver(star, name).table, "silver")
                           for name in ("customers", "products"))
    return medallion.gold_region_month(customers, products, _silver(star, "orders").table)


@query
def table_counts(star):
    card = cards.scorecard(star.customers, star.products, star.lines)
    return medallion.table_counts({"customers": star.customers, "products": star.products,
                                   "orders": star.lines, "gold_customer_scorecard": card})


@query
def name_slug(star):
    return star.customers.select("customer_id", slug(F.concat_ws(
        " -- ", "customer_name", "region", "account_manager")).alias("slug"))


def _json_silver(star: Star) -> dict[str, medallion.Silver]:
    """All three entities written as JSON lines, read as they are, and cleaned."""
    spark, found = star.lines.sparkSession, {}
    for name, lines in tpch.json_lines(_raw(star)).items():
        folder = scratch_path(spark, f"json-{name}")
        lines.write.option("compression", "gzip").text(folder)
        entity = _entity(star, name)
        # Prices come as text, and are parsed when the entity is cleaned.
        schema = StructType([StructField(f.name, StringType() if f.name == "list_price"
                                         else f.dataType) for f in entity.schema])
        found[name] = medallion.silver(medallion.bronze(spark, folder, schema), entity)
    return found


def _key(name: str):
    return F.col({"customers": "customer_id", "products": "product_id", "orders": "order_id"}[name]
                 ).cast("string").alias("key")


@query
def silver_from_json(star):
    return reduce(DataFrame.unionByName, [
        parts.table.select(
            F.lit(name).alias("entity"), _key(name),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                               for c in parts.table.columns]).alias("row"))
        for name, parts in _json_silver(star).items()])


@query
def quarantine_from_json(star):
    return reduce(DataFrame.unionByName, [
        _joined_rules(parts.quarantine).select(
            F.lit(name).alias("entity"), _key(name), rules.FAILED,
            F.col(CORRUPT).isNotNull().alias("malformed"),
            F.col("_source_file").isNotNull().alias("has_source"))
        for name, parts in _json_silver(star).items()])


@query
def rebuilt_table(star):
    """A catalogued table that is built, then replaced by one of other columns, and read."""
    name = f"rebuilt_{uuid.uuid4().hex}"
    replace_table(star.customers.select("customer_id"), name)
    replace_table(star.customers, name, "Customers, built twice", key="customer_id")
    return read_table(star.customers.sparkSession, name)


def _maintained(star: Star) -> maintained.Refreshed:
    """Gold of three months ago, with lines loaded wrongly, after the changes since."""
    number, lines = F.col("order_id"), settle(star.lines, "lines")    # read many times below
    new, old = lines.agg(F.max("order_date").alias("d")).select(
        "d", F.add_months("d", -3)).first()
    early = lines.where(F.col("order_date") <= F.lit(old))
    wrong = early.where(number % 89 == 0)
    misread = wrong.withColumn("quantity", (F.col("quantity") + 1).cast("int"))
    strangers = (early.where(number % 97 == 0)
                 .withColumn("order_date", F.date_sub("order_date", 400)))
    before = early.where(number % 89 != 0).unionByName(misread).unionByName(strangers)
    changes_made = (
        lines.where(F.col("order_date") > F.lit(old)).unionByName(wrong)
        .withColumn("op", F.lit("INSERT"))
        .unionByName(misread.unionByName(strangers).withColumn("op", F.lit("DELETE"))))
    stock = settle(maintained.build_stock(before, old), "stock")
    gold = settle(grain.customer_rollup(maintained.grain_of(stock, star.products)), "gold")
    return maintained.refresh(stock, gold, star.products, before, lines, changes_made, old, new)


@query
def gold_maintained(star):
    """Sums, dates and top categories per customer, kept current through changes of lines."""
    return _maintained(star).gold


@query
def stock_maintained(star):
    """The grain under them."""
    stock = maintained.grain_of(_maintained(star).stock, star.products)
    return stock.select("customer_id", "product_id", "orders", "units",
                        F.round("revenue", 2).alias("revenue"), "first_order_date",
                        "last_order_date", "r12_orders",
                        F.round("r12_revenue", 2).alias("r12_revenue"))


# --- serving -------------------------------------------------------------------------------

BUCKETS = 16


def _rolling_at(star: Star, day) -> DataFrame:
    return grain.rolling_only(star.lines, star.products, day)


def _two_snapshots(star: Star) -> tuple[DataFrame, DataFrame]:
    new, old = grain.anchor_date(star.lines).select(
        "as_of_date", F.add_months("as_of_date", -3)).first()
    return settle(_rolling_at(star, old), "old"), settle(_rolling_at(star, new), "new")


@query
def snapshot_diff(star):
    return changes.diff(*_two_snapshots(star), "customer_id", unchanged=True)


@query
def snapshot_diff_by_digests(star):
    """What changed between the snapshots, of ranges of customers whose digests differ."""
    return diff_by_digests(*_two_snapshots(star), "customer_id")


@table_query
def corrected_orders(spark, folder):
    """Changes of a load that priced a hundredth of the order numbers anew, lost some and stamped
    every row."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    low = F.lit(orders.agg(F.floor(F.max("o_orderkey") / 2)).first()[0])
    place = (F.col("o_orderkey") - low) * 100
    loaded = (orders.where(~place.between(0, low) | (F.col("o_orderkey") % 7 != 0))
              .withColumn("o_totalprice", F.when(place.between(0, low), F.col("o_totalprice") + 1)
                          .otherwise(F.col("o_totalprice"))))
    stamps = [d.withColumn("load", F.lit(n)) for n, d in enumerate((orders, loaded))]
    return (diff_by_digests(*stamps, "o_orderkey", ignore=["load"]).drop("load")
            .withColumn("o_totalprice", F.round("o_totalprice", 2)))


@query
def apply_changes(star):
    old, new = _two_snapshots(star)
    return changes.apply_changes(old, changes.diff(old, new, "customer_id"), "customer_id")


def _order_changes(orders: DataFrame) -> DataFrame:
    """Each order as a change of its customer's record: pending orders delete it."""
    return orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "DELETE").otherwise("UPDATE").alias("op"))


@table_query
def as_of_read(spark, folder):
    """Customer records as they stood at the middle order number."""
    orders = table(spark, folder, "orders")
    middle = orders.agg(F.floor(F.max("o_orderkey") / 2).alias("v")).scalar()
    return changes.as_of(_order_changes(orders), "customer_id", "version", middle)


@query
def sync_and_restore(star):
    """Two syncs of a serving history, then the table as of each."""
    old, new = _two_snapshots(star)
    spark = old.sparkSession
    history = scratch_path(spark, "history")
    serving.sync(old, history, "customer_id", 0)
    serving.sync(new, history, "customer_id", 1)
    restored = [serving.restore(spark, history, "customer_id", version)
                .select(F.lit(version).alias("version"), "customer_id", "r12_orders",
                        "r12_revenue") for version in (0, 1)]
    return restored[0].unionByName(restored[1])


@query
def point_lookup(star):
    """Snapshot rows of the customers that ordered on the last day."""
    spark = star.lines.sparkSession
    snapshot = serving.publish(grain.lifetime(_grain(star)), scratch_path(spark, "snapshot"),
                               "customer_id")
    last_day = grain.anchor_date(star.lines).scalar()
    wanted = star.lines.filter(F.col("order_date") == last_day).select("customer_id")
    return serving.lookup_many(snapshot, "customer_id", wanted)


@query
def bucketed_lookup(star):
    """Snapshot rows of the customers that ordered in the last year, from a bucketed table."""
    name = f"snapshot_{uuid.uuid4().hex}"
    snapshot = serving.publish_bucketed(grain.lifetime(_grain(star)), name, "customer_id", BUCKETS)
    last_day = grain.anchor_date(star.lines).scalar()
    wanted = star.lines.filter(F.col("order_date") > F.add_months(last_day, -12))
    return serving.lookup_bucketed(snapshot, "customer_id", wanted, BUCKETS)


@query
def key_lookup(star):
    """Snapshot rows of the first and the last customer that ordered, and of a key that no one
    has."""
    snapshot = serving.publish(grain.lifetime(_grain(star)),
                               scratch_path(star.lines.sparkSession, "snapshot"), "customer_id")
    ends = snapshot.agg(F.min("customer_id"), F.max("customer_id")).first()
    return serving.lookup(snapshot, "customer_id", [*ends, -1])


# --- files ---------------------------------------------------------------------------------

def _landed(star: Star) -> str:
    root = scratch_path(star.lines.sparkSession, "landing")
    land({"customers": star.customers, "products": star.products, "orders": star.lines}, root,
         "clean")
    land({"customers": tpch.customers_with_issues(star.customers)}, root, "raw")
    return root


@query
def json_ingest(star):
    """Customers written as JSON lines and read back with type hints over inference."""
    spark = star.lines.sparkSession
    return read_json(spark, f"{_landed(star)}/clean/customers",
                     hints="customer_id BIGINT, join_date DATE").select(star.customers.columns)


@query
def json_decimal_hints(star):
    spark = star.lines.sparkSession
    return read_json(spark, f"{_landed(star)}/clean/products",
                     hints="product_id BIGINT, list_price DECIMAL(10,2), cost DECIMAL(10,2)"
                     ).select(star.products.columns)


@query
def landed_files(star):
    spark = star.lines.sparkSession
    report = landed_report(spark, _landed(star), ("clean", "raw"),
                           ("customers", "products", "orders"))
    return report.select("flavour", "entity", (F.col("files") > 0).alias("has_files"),
                         (F.col("bytes") > 0).alias("has_bytes"), "rows")


@query
def bronze_malformed(star):
    """Raw lines of which some are cut off and some hold text where a date belongs."""
    spark = star.lines.sparkSession
    folder = scratch_path(spark, "bronze")
    number = F.col("customer_id")
    whole = F.to_json(F.struct(
        "customer_id", "customer_name",
        F.when(number % 53 == 0, "soon").otherwise(F.col("join_date").cast("string"))
        .alias("join_date")))
    star.customers.select(
        F.when(number % 41 == 0, F.regexp_replace(whole, "}$", "")).otherwise(whole)
        .alias("value")).write.text(folder)
    schema = StructType.fromDDL("customer_id bigint, customer_name string, join_date date")
    raw = medallion.bronze(spark, folder, schema)
    text = F.coalesce("_corrupt_record", F.lit(""))
    return raw.select(
        F.coalesce(F.regexp_extract(text, '"customer_id":([0-9]+)', 1).try_cast("bigint"),
                   "customer_id").alias("customer_id"),
        (text != "").alias("malformed"),
        F.when(text == "", F.col("join_date")).alias("join_date"),
        F.col("_source_file").isNotNull().alias("has_source"))


def _documents(star: Star) -> DataFrame:
    """Bronze of customers whose lines hold fields that no schema names; some are cut off."""
    spark = star.lines.sparkSession
    folder = scratch_path(spark, "documents")
    number = F.col("customer_id")
    whole = F.to_json(F.struct(
        "customer_id", "customer_name",
        F.when(number % 53 == 0, "soon").otherwise(F.col("join_date").cast("string"))
        .alias("join_date"),
        F.when(number % 7 == 0, "gold").alias("loyalty"),
        F.when(number % 11 == 0, F.struct(number.alias("points"), F.array("segment").alias("tags")))
        .alias("club")))
    mixed = F.when(number % 13 == 0, F.regexp_replace(whole, "}$", ',"rank":"first"}')).when(
        number % 13 == 1, F.regexp_replace(whole, "}$", ',"rank":1}')).otherwise(whole)
    star.customers.select(F.when(number % 41 == 0, F.regexp_replace(mixed, "}$", ""))
                          .otherwise(mixed).alias("value")).write.text(folder)
    schema = StructType.fromDDL("customer_id bigint, customer_name string, join_date date")
    return medallion.bronze(spark, folder, schema, documents=True)


@query
def bronze_drift(star):
    """Fields beyond the schema: in how many lines they stand, and as what."""
    schema = StructType.fromDDL("customer_id bigint, customer_name string, join_date date")
    entity = medallion.Entity("customers", schema, "customer_id", [])
    return (medallion.drift({"customers": _documents(star)}, {"customers": entity})
            .select("entity", "field", "type", "rows", F.col("first_file").isNotNull()
                    .alias("has_file")))


@query
def bronze_documents(star):
    """Values of fields beyond the schema, and what bronze made of each line."""
    raw = _documents(star)
    return raw.select(
        F.coalesce(medallion.field_of("customer_id", "bigint"), F.regexp_extract(
            F.coalesce(CORRUPT, F.lit("")), '"customer_id":([0-9]+)', 1).try_cast("bigint"))
        .alias("customer_id"),
        F.col("_document").isNull().alias("no_document"), F.col(CORRUPT).isNotNull()
        .alias("malformed"), "join_date",
        medallion.field_of("loyalty", "string").alias("loyalty"),
        F.try_variant_get("_document", "$.club.points", "bigint").alias("points"),
        F.try_variant_get("_document", "$.club.tags[0]", "string").alias("tag"),
        medallion.field_of("rank", "string").alias("rank"))


# --- streams -------------------------------------------------------------------------------

def _line_stream(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    stream = jobs.table_stream(spark, f"{folder}/lineitem.parquet", lineitem.schema)
    return tpch.lines_from(stream, table(spark, folder, "orders"))


@query
def stream_bronze(star):
    spark = star.lines.sparkSession
    out, state = scratch_path(spark, "bronze"), scratch_path(spark, "state")
    stream = jobs.bronze_stream(spark, f"{_landed(star)}/clean/customers", star.customers.schema)
    jobs.finish(jobs.append_to(stream, out, state))
    return spark.read.parquet(out).select(
        *star.customers.columns, F.col("_corrupt_record").isNotNull().alias("malformed"))


@table_query
def stream_dedupe(spark, folder):
    out, state = scratch_path(spark, "dedupe"), scratch_path(spark, "state")
    lines = (_line_stream(spark, folder)
             .withColumn("event_time", F.col("order_date").cast("timestamp")))
    once = jobs.deduplicated(lines, ["order_id"], "event_time", "30 days", spread=4)
    jobs.finish(jobs.append_to(once.select("order_id"), out, state))
    return spark.read.parquet(out)


def _streamed_silver(spark: SparkSession, folder: str) -> tuple[str, str, medallion.Entity]:
    valid, quarantine, state = (scratch_path(spark, n) for n in ("valid", "quarantine", "state"))
    entity = _entity(load_star(spark, folder), "orders")
    stream = tpch.lines_with_issues(_line_stream(spark, folder))
    jobs.finish(jobs.silver_stream(stream, entity, valid, quarantine, state))
    return valid, quarantine, entity


@table_query
def stream_silver(spark, folder):
    valid, _, entity = _streamed_silver(spark, folder)
    return jobs.current_rows(spark, valid, entity)


@table_query
def stream_quarantine(spark, folder):
    _, quarantine, _ = _streamed_silver(spark, folder)
    return _joined_rules(spark.read.parquet(quarantine).drop("batch"))


@table_query
def stream_counters(spark, folder):
    """Rows and violations per rule over all batches of a stream."""
    valid, quarantine, counts, state = (scratch_path(spark, n) for n in (
        "valid", "quarantine", "counts", "state"))
    entity = _entity(load_star(spark, folder), "orders")
    stream = tpch.lines_with_issues(_line_stream(spark, folder))
    jobs.finish(jobs.silver_stream(stream, entity, valid, quarantine, state, counts))
    return (spark.read.parquet(counts).groupBy("entity", "rule")
            .agg(F.sum("violations").alias("violations")))


@table_query
def stream_daily(spark, folder):
    """Days that the watermark has closed: all but the last week."""
    out, state = scratch_path(spark, "daily"), scratch_path(spark, "state")
    stream = jobs.daily_revenue(_line_stream(spark, folder), "7 days")
    jobs.finish(jobs.append_to(stream, out, state))
    return spark.read.parquet(out).withColumn("revenue", F.round("revenue", 2))


@table_query
def stream_monthly(spark, folder):
    out, state = scratch_path(spark, "monthly"), scratch_path(spark, "state")
    stream = jobs.monthly_revenue(_line_stream(spark, folder))
    jobs.finish(jobs.publish_updates(stream, out, state, "order_month"))
    return (jobs.latest_updates(spark, out, "order_month", jobs.EVERY)
            .withColumn("revenue", F.round("revenue", 2)))


@table_query
def stream_rolling(spark, folder):
    """Sums of the twelve months before the watermark, 30 days behind the last line."""
    out, state = scratch_path(spark, "rolling"), scratch_path(spark, "state")
    jobs.finish(rolling.publish_rolling(_line_stream(spark, folder), "30 days", out, state))
    return (rolling.current_rolling(spark.read.parquet(out))
            .withColumn("r12_revenue", F.round("r12_revenue", 2)))


@table_query
def stream_late_customers(spark, folder):
    """Lines that wait up to 20 days for their customer; none comes in after its first year, so
    that all lines before are decided once the watermark has passed them."""
    out, state = scratch_path(spark, "checked"), scratch_path(spark, "state")
    source = jobs.table_stream(spark, f"{folder}/customer.parquet",
                               table(spark, folder, "customer").schema)
    joined = F.date_add(F.lit(FIRST_JOINED).cast("date"), (F.col("c_custkey") % 365).cast("int"))
    arrivals = source.select(F.col("c_custkey").alias("number"),
                             joined.cast("timestamp").alias("joined"))
    lines = (_line_stream(spark, folder).where(F.year("order_date") == 1994)
             .select("order_id", F.col("customer_id").alias("number"),
                     F.col("order_date").cast("timestamp").alias("ordered")))
    checked = waiting.with_late_matches(lines, arrivals, "number", "ordered", "joined",
                                        "20 days", "1 day 12 hours")
    jobs.finish(jobs.append_to(checked, out, state))
    valid, quarantine = waiting.parted(spark.read.parquet(out), "customer_known")
    return _joined_rules(valid.select("order_id", F.array().cast("array<string>")
                                      .alias(rules.FAILED))
                         .unionByName(quarantine.select("order_id", rules.FAILED)))


@table_query
def stream_upsert(spark, folder):
    history, state = scratch_path(spark, "history"), scratch_path(spark, "state")
    orders = table(spark, folder, "orders")
    stream = jobs.table_stream(spark, f"{folder}/orders.parquet", orders.schema)
    changed = _order_changes(stream).withColumnRenamed("version", "order_id")
    jobs.finish(jobs.upsert_stream(changed, "customer_id", "order_id", history, state))
    return jobs.serving_copy(spark, history, "customer_id", "order_id")

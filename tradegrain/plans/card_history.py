"""Scorecards of many dates from one pass over the lines.

The dates, and the first days of their rolling windows, cut time into intervals. Lines are summed
once to customer x category x interval. What a customer had done by an edge is a running sum over
its intervals; a rolling sum is the difference of two running sums, and both are exact decimals. So
a further date costs rows per customer, not a run over the lines, and the dates need not be ends of
months.

The offer of a next product is not part of these cards: who bought what by each date would be a
customer x product table per date. `scorecard(as_of=...)` has it for one date.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradegrain.functions import line_revenue, rolling_start
from tradegrain.operators.grain import customer_rollup
from tradegrain.operators.scales import add_scales
from tradegrain.plans import scorecard as cards
from tradegrain.session import BROADCAST_ROWS, settle

DATE = "as_of_date"
_SUMS = ("orders", "priced", "units", "revenue", "profit")


def scorecards(customers: DataFrame, products: DataFrame, lines: DataFrame,
               dates: Iterable[date | str], nulls: cards.Nulls = "freshest") -> DataFrame:
    """One row per date and customer: the card as it stood on that date, without the offer."""
    card = settle(activity_on(customers, products, lines, dates), "cards")
    in_segment = F.concat(F.col(DATE).cast("string"),
                          F.coalesce(F.concat(F.lit(":"), "segment"), F.lit("")))
    scales = [*cards.rfm_scales(nulls, DATE), *cards.percentile_scales(DATE, "_in_segment")]
    scored = add_scales(card.withColumn("_in_segment", in_segment), scales, "customer_id")
    most = card.groupBy(DATE).agg(cards.largest().alias("_most"))      # a row per date
    return (scored.join(F.broadcast(most), DATE)
            .withColumn("top_categories", cards.top_categories_label())
            .withColumn("at_risk_score", cards.relative_risk(F.col("_most")))
            .withColumn("rfm_cell", cards.rfm_cell())
            .withColumn("at_risk_flag", cards.at_risk_flag())
            .select(*card.columns, "top_categories", *[s.name for s in scales], "at_risk_score",
                    "rfm_cell", "at_risk_flag"))


def activity_on(customers: DataFrame, products: DataFrame, lines: DataFrame,
                dates: Iterable[date | str], months: int = 12) -> DataFrame:
    """The columns of each date's card that need no other customer's row."""
    days = sorted({d if isinstance(d, date) else date.fromisoformat(d) for d in dates})
    if not days:
        raise ValueError("name at least one date")
    marks = _marks(lines.sparkSession, days, months)
    steps = settle(_steps(lines, products, marks), "steps")
    rollup = customer_rollup(_standing(steps, marks), [DATE])
    everyone = customers.withColumn(DATE, F.explode(F.array(*[F.lit(d) for d in days])))
    return cards.activity(everyone, rollup, F.col(DATE), [DATE])


def _marks(spark: SparkSession, days: list[date], months: int) -> DataFrame:
    """Two rows per date: the edges at which its window begins and ends, numbered in time."""
    given = spark.createDataFrame([(d,) for d in days], f"{DATE} date")
    edges = given.select(DATE, F.explode(F.array(
        F.struct(rolling_start(F.col(DATE), months).alias("edge"), F.lit(False).alias("ends")),
        F.struct(F.col(DATE).alias("edge"), F.lit(True).alias("ends")))).alias("m"))
    # As many rows as the caller named dates, twice; one task numbers them.
    found = edges.select(DATE, "m.*").withColumn("interval",
                                                 F.dense_rank().over(Window.orderBy("edge")) - 1)
    return spark.createDataFrame(found.collect(), found.schema)


def _steps(lines: DataFrame, products: DataFrame, marks: DataFrame) -> DataFrame:
    """Sums per customer, category and interval; an interval ends with its edge."""
    first, last = marks.agg(F.min("edge"), F.max("edge")).first()
    if (last - first).days > BROADCAST_ROWS:
        raise ValueError(f"the dates reach over more than {BROADCAST_ROWS} days")
    edges = marks.select("edge", "interval").distinct()
    before = F.date_add(F.lag("edge").over(Window.orderBy("edge")), 1)
    # A row per day between the first edge and the last; all days before belong to the first.
    days = edges.withColumn("from", before).where("from is not null").select(
        F.explode(F.sequence("from", "edge")).alias("order_date"), "interval")

    revenue = F.col("revenue")
    costed = F.when(revenue.isNotNull(), F.col("quantity"))
    known = (lines.where(F.col("order_date") <= F.lit(last))
             .select("order_id", "customer_id", "product_id", "order_date", "quantity",
                     line_revenue().alias("revenue"))
             .join(F.broadcast(days), "order_date", "left")
             .withColumn("interval", F.coalesce("interval", F.lit(0))))
    # Pairs of customer and product hardly repeat: lines meet the products as they are.
    sold = products.select("product_id", "category", "cost")
    if products.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sold = F.broadcast(sold)
    return (known.join(sold, "product_id")
            .withColumn("profit", revenue - costed * F.col("cost"))
            .groupBy("customer_id", "category", "interval")
            .agg(F.count("order_id").alias("orders"), F.count(revenue).alias("priced"),
                 F.sum("quantity").alias("units"), F.sum(revenue).alias("revenue"),
                 F.sum("profit").alias("profit"),
                 F.min("order_date").alias("first_order_date"),
                 F.max("order_date").alias("last_order_date")))


def _standing(steps: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows that add up to what a customer had done in a category by each date: one with the
    running sums at the date, and one that takes away what was before its window.

    A customer has at most categories x edges rows here, so customers are whole in a task.
    """
    last = marks.agg(F.max("interval")).first()[0]
    filled = (steps.groupBy("customer_id", "category").agg(F.min("interval").alias("since"))
              .select("customer_id", "category",
                      F.explode(F.sequence("since", F.lit(last))).alias("interval"),
                      F.lit(True).alias("_edge")))
    so_far = Window.partitionBy("customer_id", "category").orderBy("interval")
    running = (steps.unionByName(filled, allowMissingColumns=True).repartition("customer_id")
               .select("customer_id", "category", "interval", "_edge",
                       *[F.sum(c).over(so_far).alias(c) for c in _SUMS],
                       F.min("first_order_date").over(so_far).alias("first_order_date"),
                       F.max("last_order_date").over(so_far).alias("last_order_date"))
               .where("_edge"))
    at = running.join(F.broadcast(marks.select(DATE, "interval", "ends")), "interval")
    ends = F.col("ends")
    return at.select(
        "customer_id", "category", DATE,
        *[F.when(ends, F.col(c)).alias(c) for c in (*_SUMS, "first_order_date",
                                                    "last_order_date")],
        *[F.when(ends, F.col(c)).otherwise(-F.col(c)).alias(f"r12_{c}")
          for c in ("orders", "revenue", "profit")])

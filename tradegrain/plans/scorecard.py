"""The per-customer scorecard: rolling sums, RFM, risk, percentiles, categories, cross-sell."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.functions import MONEY, PERCENT, margin_pct
from tradegrain.operators.grain import (
    anchor_date,
    customer_product_grain,
    customer_rollup,
    until,
)
from tradegrain.operators.next_best import next_best
from tradegrain.operators.scales import add_scales, ntile, percentile
from tradegrain.session import settle

Nulls = Literal["freshest", "stalest"]


def scorecard(customers: DataFrame, products: DataFrame, lines: DataFrame,
              as_of: date | str | None = None, nulls: Nulls = "freshest") -> DataFrame:
    """36 columns, one row per customer, also for those without orders.

    With `as_of`, the card as it stood on that date. `nulls` says where customers that never
    ordered go in the recency score: by default a NULL recency sorts last under falling
    recency, so they score with the freshest; "stalest" puts them at the other end.
    """
    return (score(base(customers, products, lines, as_of), nulls)
            .withColumn("computed_at", F.current_timestamp()))


def base(customers: DataFrame, products: DataFrame, lines: DataFrame,
         as_of: date | str | None = None) -> DataFrame:
    """The 26 columns that need no other customer's row, as a written table."""
    known = until(lines, as_of)
    anchor = F.lit(as_of or anchor_date(known).first()[0]).cast("date")
    grain = settle(customer_product_grain(known, products, anchor), "grain")
    offers = next_best(customers, products, grain)
    return settle(activity(customers, customer_rollup(grain), anchor)
                  .join(offers, "customer_id", "left"), "base")


def activity(customers: DataFrame, rollup: DataFrame, anchor: Column,
             by: Sequence[str] = ()) -> DataFrame:
    """Every customer with what they did, absent sums as 0, and days since; each `by`, a column
    of both tables, apart."""
    zero = F.lit(0)
    revenue, profit = F.col("lifetime_revenue"), F.col("lifetime_profit")
    r12_revenue, r12_profit = F.col("r12_revenue"), F.col("r12_profit")
    return customers.join(rollup, ["customer_id", *by], "left").select(
        *by, "customer_id", "customer_name", "region", "segment", "account_manager", "join_date",
        F.datediff(anchor, "join_date").alias("tenure_days"),
        F.coalesce("lifetime_orders", zero).alias("lifetime_orders"),
        F.coalesce("lifetime_units", zero).alias("lifetime_units"),
        _money(revenue).alias("lifetime_revenue"),
        _money(profit).alias("lifetime_profit"),
        _margin(profit, revenue).alias("lifetime_margin_pct"),
        F.coalesce("avg_order_value", zero).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.coalesce("r12_orders", zero).alias("r12_orders"),
        _money(r12_revenue).alias("r12_revenue"),
        _money(r12_profit).alias("r12_profit"),
        _margin(r12_profit, r12_revenue).alias("r12_margin_pct"),
        F.datediff(anchor, "last_order_date").alias("recency_days"),
        F.coalesce("r12_orders", zero).alias("frequency_12m"),
        _money(r12_revenue).alias("monetary_12m"),
        "top_category_1", "top_category_2")


def score(card: DataFrame, nulls: Nulls = "freshest") -> DataFrame:
    """Add the scores that compare customers. `card` should be a written table."""
    ranked = add_scales(card, rfm_scales(nulls) + percentile_scales(), "customer_id")
    return (ranked
            .withColumn("top_categories", top_categories_label())
            .withColumn("at_risk_score", at_risk_score(card))
            .withColumn("rfm_cell", rfm_cell())
            .withColumn("at_risk_flag", at_risk_flag())
            .select(*card.columns, "top_categories", "r_score", "f_score", "m_score",
                    "revenue_percentile", "revenue_percentile_in_segment", "at_risk_score",
                    "rfm_cell", "at_risk_flag"))


def rfm_scales(nulls: Nulls = "freshest", group: str | None = None) -> list:
    """Scores 1 to 5; equal values are told apart by the customer id."""
    return [
        ntile("r_score", -F.col("recency_days"), 5, "last" if nulls == "freshest" else "first",
              group),
        ntile("f_score", F.col("frequency_12m"), 5, group=group),
        ntile("m_score", F.col("monetary_12m"), 5, group=group),
    ]


def percentile_scales(group: str | None = None, segment: str = "segment") -> list:
    revenue = F.col("lifetime_revenue")
    return [percentile("revenue_percentile", revenue, group),
            percentile("revenue_percentile_in_segment", revenue, segment)]


def at_risk_score(card: DataFrame) -> Column:
    """0.6 of relative recency plus 0.4 of missing relative frequency, out of 100."""
    return relative_risk(card.agg(largest()).scalar())


def largest() -> Column:
    """What recency and frequency are relative to."""
    return F.struct(F.max("recency_days").alias("recency"),
                    F.max("frequency_12m").alias("frequency"))


def relative_risk(most: Column) -> Column:
    recency = F.try_divide("recency_days", most["recency"])
    frequency = F.try_divide("frequency_12m", most["frequency"])
    return F.round(100 * (0.6 * recency + 0.4 * (1 - frequency)), 1)


def rfm_cell() -> Column:
    return F.concat(F.lit("R"), F.col("r_score"), F.lit("F"), F.col("f_score"),
                    F.lit("M"), F.col("m_score"))


def at_risk_flag() -> Column:
    """Stale, but among the high spenders."""
    return F.coalesce((F.col("r_score") <= 2) & (F.col("m_score") >= 4), F.lit(False))


def top_categories_label() -> Column:
    return F.concat_ws(" | ", "top_category_1", "top_category_2")


def _money(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0)).cast(MONEY)


def _margin(profit: Column, revenue: Column) -> Column:
    """From the rounded sums."""
    return F.round(margin_pct(F.coalesce(profit, F.lit(0)), revenue), 2).cast(PERCENT)

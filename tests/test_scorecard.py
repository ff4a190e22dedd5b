import random
from datetime import date
from decimal import Decimal

import plain_forms
from frames import customers, line, lines, products
from pyspark.sql import functions as F

from tradegrain.operators import grain
from tradegrain.plans.scorecard import scorecard


def card(*args, **settings):
    found = scorecard(*args, **settings)
    assert len(found.columns) == 36
    return {r["customer_id"]: r for r in found.collect()}


def test_equal_to_direct_form(spark, same):
    rng = random.Random(5)
    who = customers(spark, *[(i, rng.choice(["a", "b", None])) for i in range(80)])
    what = products(spark, *[(f"P{i}", rng.choice(["u", "v", "w"]), f"{rng.randint(1, 900)}.35")
                             for i in range(15)])
    sold = lines(spark, *[
        line(i, rng.randrange(85), f"P{rng.randrange(17)}",
             f"202{rng.choice([4, 5, 6])}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
             rng.randint(1, 40), f"{rng.randint(1, 99)}.{rng.randint(10, 99)}",
             rng.choice(["0", "5", "10", "12.5", "100"])) for i in range(600)])
    same(plain_forms.scorecard(who, what, sold),
         scorecard(who, what, sold).drop("computed_at"))


def test_customer_without_orders(spark):
    found = card(customers(spark, 1, 2), products(spark, "A"), lines(spark, line(1, 1, "A")))
    new = found[2]
    assert (new.lifetime_orders, new.lifetime_revenue, new.avg_order_value) == (0, 0, 0)
    assert (new.lifetime_margin_pct, new.r12_margin_pct, new.recency_days) == (None, None, None)
    assert new.at_risk_score is None and new.at_risk_flag is False
    assert new.top_categories == "" and new.first_order_date is None
    assert (found[1].r_score, new.r_score) == (1, 2)      # a NULL recency sorts as freshest
    worst = card(customers(spark, 1, 2), products(spark, "A"), lines(spark, line(1, 1, "A")),
                 nulls="stalest")
    assert (worst[2].r_score, worst[1].r_score) == (1, 2)


def test_single_customer(spark):
    only = card(customers(spark, 1), products(spark, "A", "B"),
                lines(spark, line(1, 1, "A", quantity=3)))[1]
    assert (only.revenue_percentile, only.revenue_percentile_in_segment) == (0.0, 0.0)
    assert only.rfm_cell == "R1F1M1" and only.at_risk_score is None   # all recencies are 0
    assert only.cross_sell_product_id == "B"
    assert (only.lifetime_revenue, only.lifetime_profit) == (Decimal("30.00"), Decimal("12.00"))


def test_traps(spark):
    what = products(spark, ("A", "Frozen", "6.00"), ("B", "Chilled", "6.00"))
    found = card(customers(spark, 1, 2, 3, 4), what, lines(
        spark,
        line(1, 1, "A", "2023-02-28"), line(2, 1, "A", "2023-03-01"),
        line(3, 2, "A", "2024-01-15", discount="100"),
        line(4, 3, "A", "2024-01-15"), line(5, 3, "B", "2024-01-15"),
        line(6, 4, "A", "2024-01-30"), line(7, 4, "?", "2024-02-29")))
    # The window starts after the day a year before, which is clamped to 28 February.
    assert (found[1].lifetime_orders, found[1].r12_orders) == (2, 1)
    # No revenue, so no margin, and no error.
    assert (found[2].lifetime_revenue, found[2].lifetime_profit) == (0, Decimal("-6.00"))
    assert found[2].lifetime_margin_pct is None
    # Categories of equal revenue are in alphabetical order.
    assert found[3].top_categories == "Chilled | Frozen"
    # A line of an unknown product counts for the anchor date and for nothing else.
    assert (found[4].lifetime_orders, found[4].recency_days) == (1, 30)
    assert found[4].last_order_date == date(2024, 1, 30)


def test_as_of_ignores_later_lines(spark):
    who, what = customers(spark, 1), products(spark, "A")
    past = line(1, 1, "A", "2025-03-10", quantity=2)
    then = card(who, what, lines(spark, past, line(2, 1, "A", "2026-01-01")), as_of="2025-03-31")
    assert then[1].lifetime_units == 2 and then[1].recency_days == 21


def test_missing_values_in_lines(spark, same):
    """NULL prices and quantities count as lines but add neither revenue nor profit."""
    sold = lines(spark, line(1, 1, "A", price=None, quantity=4), line(2, 1, "A", quantity=None),
                 line(3, 1, "A", quantity=2), line(None, 1, "A"))
    who, what = customers(spark, 1), products(spark, "A")
    facts = grain.line_facts(sold, what)
    mine = grain.lifetime(grain.customer_product_grain(sold, what, F.lit("2026-05-31").cast("date")))
    same(facts.groupBy("customer_id").agg(
        F.count("order_id").alias("lifetime_orders"), F.sum("quantity").alias("lifetime_units"),
        F.round(F.sum("revenue"), 2).alias("lifetime_revenue"),
        F.round(F.sum("profit"), 2).alias("lifetime_profit"),
        F.round(F.avg("revenue"), 2).alias("avg_order_value")),
        mine.drop("first_order_date", "last_order_date"))


def test_scores_of_ties_follow_the_id(spark):
    found = card(customers(spark, *range(6)), products(spark, "A"),
                 lines(spark, *[line(i, i, "A") for i in range(6)]))
    assert [found[i].f_score for i in range(6)] == [1, 1, 2, 3, 4, 5]

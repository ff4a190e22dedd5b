"""Lines move once to each table that is too large to send, and by the columns still needed."""

import re
from datetime import date
from pathlib import Path

import pytest
import test_kept_current
from frames import customers, line, lines, products
from pyspark.sql import functions as F

from tradegrain.operators import grain
from tradegrain.plans import card_history, distinct_counts, maintained, rollups
from tradegrain.plans.sales_metrics import sales_metrics
from tradegrain.session import shared_dir
from tradegrain.sources.star import Star
from tradegrain.workload import queries

ALL = ["Total Revenue", "Total Profit", "Order Count", "Units Sold", "Distinct Customers"]


@pytest.fixture
def apart(spark):
    """No table is sent to the lines."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def sold(spark):
    rows = [line(i, i % 7 or None, f"P{i % 5}", f"2026-0{1 + i % 3}-15", i % 4 or None,
                 None if i % 11 == 0 else "2.50") for i in range(1, 60)]
    return (lines(spark, *rows), customers(spark, *[(i, "ABC"[i % 3]) for i in range(1, 6)]),
            products(spark, *[(f"P{i}", "FG"[i % 2], f"{i}.10") for i in range(4)]))


def shuffles(df):
    """The keys of each shuffle in the plan that is not of the tables themselves."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning)\(([^)]*)\)", plan)


def test_lines_go_to_products_and_customers_once(apart, rows):
    # By product, by customer (summed), the two tables, and by region.
    large, small = (sales_metrics(*sold(apart), broadcast_rows=n) for n in (0, 100))
    found = large.query(["Region"], ALL)
    assert len(shuffles(found)) <= 5
    assert rows(found) == rows(small.query(["Region"], ALL))


def test_slices_of_large_tables_count_customers_where_they_lie(apart, rows):
    slices = [["Region"], ["Category", "Order Month"], [], ["Region"]]
    large, small = (sales_metrics(*sold(apart), broadcast_rows=n) for n in (0, 100))
    found = large.query_slices(slices, ALL)
    assert len(shuffles(found)) <= 5
    assert rows(found) == rows(small.query_slices(slices, ALL))
    tested = dict(where={"Category": lambda c: c == "F"}, having={"Order Count": lambda n: n > 2})
    for measures in (ALL, ["Units Sold"]):
        assert (rows(large.query_slices([["Segment"], ["Region", "Segment"]], measures, **tested))
                == rows(small.query_slices([["Segment"], ["Region", "Segment"]], measures,
                                           **tested)))
    for slice_number, names in enumerate(slices):
        one = found.where(F.col("slice") == slice_number).select(
            *[F.col(f"`{c}`") for c in (*names, *ALL)])
        assert rows(one) == rows(large.query(names, ALL))


def test_lifetime_sums_lines_by_customer_alone(apart, rows, monkeypatch):
    facts, _, goods = sold(apart)
    day = F.lit("2026-03-31").cast("date")
    want = rows(grain.lifetime(grain.customer_product_grain(facts, goods, day)))
    monkeypatch.setattr(grain, "BROADCAST_ROWS", 0)
    found = grain.lifetime(grain.grain_for_one_use(facts, goods, day))
    assert rows(found) == want
    assert len(shuffles(found)) == 3      # the lines, the products, and the sums by customer


def test_bitmaps_are_made_whole(apart, rows):
    """No bitmap is shuffled: ids are, to their slice and bucket."""
    facts, buyers, goods = sold(apart)
    built = distinct_counts.build_bitmaps(facts, ["product_id"], "customer_id")
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange")
    view = sales_metrics(facts, buyers, goods)
    stored = rollups.store(view, ["Region", "Segment", "Category"], ALL)
    for names in (["Region"], ["Category", "Segment"], []):
        assert rows(stored.query(names, ALL)) == rows(view.query(names, ALL))


def test_cards_of_dates_sum_lines_by_category(apart):
    facts, _, goods = sold(apart)
    marks = card_history._marks(apart, [date(2026, 3, 31)], 12)
    found = card_history._steps(facts, goods, marks)
    assert not [k for k in shuffles(found) if "customer_id" in k and "product_id" in k]


@pytest.mark.parametrize("was, as_of", [("2026-03-31", "2026-05-31"), ("2026-05-31", "2025-11-30")])
def test_many_changed_pairs_meet_the_stock_once(spark, same, monkeypatch, was, as_of):
    """The gold is still that of a rebuild, and the new stock needs no further join with the old."""
    made, refresh = [], maintained.refresh
    monkeypatch.setattr(maintained, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(maintained, "refresh", lambda *a: made.append(refresh(*a)) or made[-1])
    test_kept_current.test_maintained_gold_equals_the_rebuilt_one(spark, same, was, as_of)
    assert "Join" not in made[0].stock._jdf.queryExecution().optimizedPlan().toString()


def test_landed_json_is_compressed(spark):
    star = Star(customers(spark, 1, 2), products(spark, ("1", "LARGE", "5.00")).drop("launch_date"),
                lines(spark, line(11, 1, "1"), line(12, 2, "1")))
    found = queries._json_silver(star)["orders"]
    assert found.table.count() + found.quarantine.count() == 2
    folders = Path(shared_dir(spark).removeprefix("file:")).glob("tradegrain/json-orders-*")
    newest = max(folders, key=lambda f: f.stat().st_mtime)
    assert {f.suffix for f in newest.glob("part-*")} == {".gz"}

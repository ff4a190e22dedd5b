from decimal import Decimal

import pytest
from frames import customers, line, lines, products
from pyspark.sql import functions as F

from tradegrain.plans.metric_view import RepeatedKey, UnknownName
from tradegrain.plans.sales_metrics import margin_by_segment, sales_metrics

ADDITIVE = ["Total Revenue", "Total Profit", "Order Count", "Units Sold"]


def view(spark, broadcast_rows=200_000, *extra):
    sold = lines(spark,
                 line(1, 1, "A", "2026-05-01", 2), line(2, 1, "B", "2026-04-02", 1),
                 line(3, 2, "A", "2026-05-20", 5, discount="10"), line(4, 3, "B", quantity=4),
                 line(5, 9, "A"), line(6, 1, "?", quantity=3), *extra)
    who = customers(spark, (1, "x"), (2, "y"), (3, None))
    what = products(spark, ("A", "Frozen", "6.00"), ("B", "Chilled", "9.00"))
    return sales_metrics(sold, who, what, broadcast_rows=broadcast_rows)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_measures(spark, rows, limit):
    found = view(spark, limit).query(["Segment"], ["Total Revenue", "Total Profit",
                                                   "Order Count", "Distinct Customers"])
    assert rows(found) == sorted([
        ("x", Decimal(60), Decimal(9), 3, 1),       # no profit for the unknown product
        ("y", Decimal(45), Decimal(15), 1, 1),
        (None, Decimal(50), Decimal(8), 2, 2)], key=repr)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_totals_add_up_over_any_dimension(spark, rows, limit):
    sales = view(spark, limit)
    total = rows(sales.query([], ADDITIVE))
    for dimension in sales.dimensions:
        parts = sales.query([dimension], ADDITIVE)
        assert rows(parts.agg(*[F.sum(F.col(f"`{m}`")) for m in ADDITIVE])) == total


@pytest.mark.parametrize("limit", [200_000, 0])
def test_missing_values(spark, rows, limit):
    more = (line(7, 1, "A", price=None, quantity=7), line(None, 1, "A", quantity=None))
    found = view(spark, limit, *more).query(["Segment"], ADDITIVE)
    assert ("x", Decimal(60), Decimal(9), 4, 13) in rows(found)


def test_ratios_without_revenue_are_null(spark, rows):
    free = view(spark, 200_000, line(8, 2, "B", "2020-01-01", discount="100"))
    found = free.query(["Order Month"], ["Profit Margin %", "Avg Order Value"],
                       where={"Order Month": lambda m: m < "2021-01-01"})
    assert [r[1:] for r in rows(found)] == [(None, Decimal(0))]


def test_where_and_having(spark, rows):
    found = view(spark).query(["Category"], ["Units Sold"],
                              where={"Segment": lambda s: s.isin("x", "y")},
                              having={"Order Count": lambda n: n > 1}, order_by=["Category"])
    assert rows(found) == [("Frozen", 7)]


def test_slices_equal_single_queries(spark, rows):
    for limit in (200_000, 0):
        sales = view(spark, limit)
        slices = [["Segment"], ["Category", "Segment"], []]
        wanted = [*ADDITIVE, "Distinct Customers", "Avg Order Value"]
        found = sales.query_slices(slices, wanted)
        for number, names in enumerate(slices):
            part = found.filter(F.col("slice") == number)
            assert rows(part.select(*names, *[F.col(f"`{m}`") for m in wanted])) == rows(
                sales.query(names, wanted).select(*names, *[F.col(f"`{m}`") for m in wanted]))


def test_cube(spark, rows):
    found = view(spark).cube(["Segment", "Category"], ["Order Count"])
    assert rows(found.filter("slice = 3")) == [(3, None, None, 6)]
    assert sorted(r[0] for r in rows(found.select("slice").distinct())) == [0, 1, 2, 3]


def test_only_needed_tables_are_joined(spark):
    plan = view(spark).query(["Order Month"], ["Total Revenue", "Units Sold"])
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_large_dimensions_meet_sums(spark):
    plan = (view(spark, 0).query(["Segment"], ["Total Revenue"])
            ._jdf.queryExecution().optimizedPlan().toString())
    joined, below = plan.index("Join"), plan.rindex("Aggregate")
    assert below > joined and "strategy=broadcast" not in plan


def test_unknown_names(spark):
    with pytest.raises(UnknownName, match="Segment"):
        view(spark).query(["Shoe Size"], ["Total Revenue"])
    with pytest.raises(UnknownName, match="Units Sold"):
        view(spark).query(["Segment"], ["Happiness"])
    with pytest.raises(UnknownName):
        view(spark).query(["Segment"], [])


def test_margin_by_segment(spark):
    first = margin_by_segment(view(spark)).first()
    assert first.asDict() == {"Segment": "x", "revenue": Decimal("60.00"),
                              "profit": Decimal("9.00"), "margin_pct": Decimal("15.00"),
                              "orders": 3}


def test_repeated_join_keys_are_found(spark, rows):
    sales = view(spark)
    twice = sales_metrics(sales.source, customers(spark, 1, 1, 2), sales.joins["products"].table)
    assert rows(twice.repeated_keys()) == [("customers", "1", 2)]


def test_repeated_join_keys_raise(spark):
    sales = view(spark)
    twice = sales_metrics(sales.source, customers(spark, 1, 1, None, None, 2),
                          sales.joins["products"].table)
    with pytest.raises(RepeatedKey, match="customers"):
        twice.query(["Region"], ["Total Revenue"])
    assert twice.query(["Category"], ["Total Revenue"]).count() == 3    # does not join them


def test_order_by_what_is_not_selected(spark):
    sales = view(spark)
    found = sales.query(["Segment"], ["Units Sold"], order_by=["Total Revenue"])
    assert [tuple(r) for r in found.collect()] == [("y", 5), (None, 5), ("x", 6)]
    found = sales.query_slices([["Segment"], []], ["Units Sold"], order_by=["slice", "Segment"])
    assert [r[0] for r in found.collect()] == [0, 0, 0, 1]
    for wrong in ("Category", "Happiness"):
        with pytest.raises(UnknownName, match=wrong):
            sales.query(["Segment"], ["Units Sold"], order_by=[wrong])


def test_equal_slices_and_tests_of_slices(spark, rows):
    sales = view(spark)
    found = sales.query_slices([["Segment", "Category"], [], ["Category", "Segment"], []],
                               ["Units Sold"], where={"Segment": lambda s: s == "x"},
                               having={"Order Count": lambda n: n >= 1})
    parts = [rows(found.filter(F.col("slice") == n).drop("slice")) for n in range(4)]
    assert parts[0] == parts[2] and parts[1] == parts[3] == [(None, None, 6)]
    assert len(parts[0]) == 3
    cube = sales.cube(["Segment"], ["Units Sold"], having={"Units Sold": lambda n: n > 5})
    assert rows(cube) == [(0, "x", 6), (1, None, 16)]

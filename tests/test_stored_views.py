"""Stored rollups with routing, cards of many dates, lines that wait for their customer."""

import random
from datetime import date, datetime, timedelta

import pytest
from frames import LINE, customers, line, lines, products
from pyspark.sql import functions as F

from tradegrain.plans import card_history, rollups, scorecard
from tradegrain.plans.metric_view import UnknownName
from tradegrain.plans.sales_metrics import sales_metrics
from tradegrain.streaming import jobs, waiting

DIMENSIONS = ["Segment", "Category", "Order Month"]
MEASURES = ["Total Revenue", "Total Profit", "Profit Margin %", "Order Count",
            "Distinct Customers"]


@pytest.fixture(scope="module")
def star(spark):
    draw = random.Random(7)
    who = customers(spark, *[(i, ["Regional", "National", None][i % 3]) for i in range(1, 40)])
    what = products(spark, *[(f"p{i}", ["Frozen", "Dry", "Fresh"][i % 3], f"{i}.10")
                             for i in range(9)])
    start = date(2024, 1, 30)
    sold = [line(n, draw.choice([None, 1, 1, 1, draw.randrange(1, 45)]), f"p{draw.randrange(10)}",
                 (start + timedelta(draw.randrange(800))).isoformat(), draw.randrange(1, 9),
                 draw.choice([None, "3.33", "10.00"]), draw.choice(["0", "15"]))
            for n in range(600)]
    return who, what, lines(spark, *sold).repartition(5)


@pytest.fixture(scope="module")
def stored(star):
    who, what, sold = star
    return rollups.store(sales_metrics(sold, who, what), DIMENSIONS, MEASURES, keep=3)


@pytest.mark.parametrize("dimensions", [[], ["Segment"], ["Category"], ["Order Month"],
                                        ["Category", "Segment"], DIMENSIONS])
def test_stored_equals_lines(star, stored, same, dimensions):
    who, what, sold = star
    plain = sales_metrics(sold, who, what)
    assert stored.route(dimensions, MEASURES) is not None
    same(plain.query(dimensions, MEASURES), stored.query(dimensions, MEASURES))
    settings = {"where": {"Category": lambda c: c.isin("Dry", "Fresh")},
                "having": {"Order Count": lambda n: n > 3}}
    same(plain.query(dimensions, ["Total Profit", "Distinct Customers"], **settings),
         stored.query(dimensions, ["Total Profit", "Distinct Customers"], **settings))
    same(plain.query(dimensions, ["Units Sold"]), stored.query(dimensions, ["Units Sold"]))


def test_slices_equal_lines(star, stored, rows):
    who, what, sold = star
    slices = [["Segment"], ["Order Month", "Category"], [], ["Segment"]]
    plain = sales_metrics(sold, who, what).query_slices(slices, MEASURES)
    assert rows(plain) == rows(stored.query_slices(slices, MEASURES), *plain.columns)
    ordered = stored.query_slices([["Segment"], []], ["Order Count"], order_by=["Total Revenue"])
    by_revenue = stored.query_slices([["Segment"], []], ["Order Count", "Total Revenue"]).collect()
    by_revenue.sort(key=lambda r: r["Total Revenue"])
    assert [r["Order Count"] for r in ordered.collect()] == [r["Order Count"] for r in by_revenue]
    assert len(by_revenue) == 4         # unknown customers have a NULL segment, as some known do


def test_routing_takes_the_smallest_and_falls_back(stored):
    assert stored.route(DIMENSIONS, MEASURES) == frozenset(DIMENSIONS)
    assert stored.route(["Region"], MEASURES) is None
    assert stored.route(["Segment"], ["Units Sold"]) is None
    smallest = stored.route(["Segment"], ["Total Revenue"])
    assert all(stored.sizes[smallest] <= stored.sizes[g] for g in stored.stored if "Segment" in g)
    plan = stored.query(["Segment"], ["Total Revenue"])._jdf.queryExecution().toString()
    assert "rollup-" in plan and "order_date" not in plan
    with pytest.raises(UnknownName):
        stored.query(["Nothing"], MEASURES)


def test_choice_is_greedy_by_rows_saved():
    sizes = {frozenset(k): n for k, n in {
        "abc": 100, "ab": 99, "ac": 50, "bc": 75, "a": 20, "b": 30, "c": 40, "": 1}.items()}
    top = frozenset("abc")
    # ac saves 50 rows for each of ac, a, c and none of the dimensions.
    assert rollups.choose(sizes, top, 1) == [frozenset("ac")]
    # b then saves 70 for itself and 20 for none; bc only 25 for itself and for b.
    assert rollups.choose(sizes, top, 2) == [frozenset("ac"), frozenset("b")]
    assert rollups.choose(sizes, top, 1, {frozenset("bc"): 100.0}) == [frozenset("bc")]
    assert len(rollups.choose(sizes, top, 99)) == 7
    assert rollups.choose(dict.fromkeys(sizes, 5), top, 3) == []


def test_rollups_of_an_empty_table(spark, star, same):
    who, what, _ = star
    none = spark.createDataFrame([], LINE)
    plain = sales_metrics(none, who, what)
    view = rollups.store(plain, DIMENSIONS, MEASURES)
    same(plain.query([], MEASURES), view.query([], MEASURES))
    assert view.query(["Segment"], MEASURES).collect() == []


DATES = ["2023-05-05", "2024-02-29", date(2025, 2, 28), "2025-03-30", "2025-03-31", "2027-01-01"]


@pytest.mark.parametrize("nulls, compared", [("freshest", DATES[1:5:3]), ("stalest", DATES[:1])])
def test_cards_of_dates_equal_cards_of_each(star, rows, nulls, compared):
    who, what, sold = star
    found = card_history.scorecards(who, what, sold, DATES, nulls).cache()
    assert found.count() == len(DATES) * who.count()
    for day in compared:
        one = scorecard.scorecard(who, what, sold, day, nulls)
        kept = [c for c in found.columns if c != "as_of_date"]
        assert rows(found.where(F.col("as_of_date") == F.lit(day).cast("date")), *kept) \
            == rows(one, *kept)


def test_cards_need_a_date_and_take_repeated_ones(star, spark):
    who, what, _ = star
    with pytest.raises(ValueError):
        card_history.scorecards(who, what, spark.createDataFrame([], LINE), [])
    empty = card_history.scorecards(who, what, spark.createDataFrame([], LINE),
                                    ["2025-01-01", date(2025, 1, 1)])
    assert empty.count() == who.count()
    assert empty.where("lifetime_orders <> 0 or top_categories <> ''").count() == 0


def test_computed_at_is_one_time_per_build(star):
    who, what, sold = star
    before = datetime.now()
    times = scorecard.scorecard(who, what, sold).select("computed_at").distinct().collect()
    assert len(times) == 1 and times[0][0] is not None
    assert abs(times[0][0] - before) < timedelta(hours=15)      # of whatever time zone


def test_lines_wait_for_their_customer(spark, tmp_path):
    facts, people, out = (str(tmp_path / n) for n in ("facts", "people", "out"))

    def day(x):
        return datetime(2024, 1, 1) + timedelta(int(x[1:])) if isinstance(x, str) else x

    def put(folder, schema, *entries):
        (spark.createDataFrame([tuple(map(day, e)) for e in entries], schema)
         .coalesce(1).write.mode("append").parquet(folder))

    def run():
        left = jobs.table_stream(spark, facts, spark.read.parquet(facts).schema)
        right = jobs.table_stream(spark, people, spark.read.parquet(people).schema)
        checked = waiting.with_late_matches(left, right, "who", "at", "seen", "5 days", "1 day")
        jobs.finish(jobs.append_to(checked, out, str(tmp_path / "state")))
        valid, quarantine = waiting.parted(spark.read.parquet(out), "known")
        assert {tuple(r["failed_rules"]) for r in quarantine.collect()} <= {("known",)}
        return (sorted(r["id"] for r in valid.collect()),
                sorted(r["id"] for r in quarantine.collect()))

    line_of, person = "id int, who int, at timestamp", "who int, seen timestamp"
    put(facts, line_of, (1, 7, "d0"), (2, 8, "d0"), (3, None, "d0"), (4, 9, "d1"))
    put(people, person, (9, "d0"), (9, "d0"))
    assert run() == ([4], [])                    # 9 was there, twice; the others wait
    put(facts, line_of, (5, 9, "d30"))
    put(people, person, (7, "d4"))
    assert run() == ([1, 4], [])                 # 7 came in time; the people are at day 4 only
    put(people, person, (1, "d40"))
    put(facts, line_of, (6, 1, "d40"))
    assert run() == ([1, 4, 6], [2, 3, 5])       # nobody came for 8 and NULL; 9 came long before

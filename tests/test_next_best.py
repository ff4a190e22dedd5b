import random

import pytest
from pyspark.sql import functions as F

import plain_forms
from frames import customers, products
from tradegrain.operators import next_best as module
from tradegrain.operators.next_best import next_best


def bought(spark, *pairs):
    return spark.createDataFrame(list(pairs), "customer_id int, product_id string")


def check(spark, rows, who, what, pairs, head):
    owned = bought(spark, *pairs)
    found = next_best(who, what, owned, head)
    assert rows(found) == rows(plain_forms.next_best(who, what, owned).select(*found.columns))
    return {r[0]: r[1] for r in rows(found)}


@pytest.mark.parametrize("seed,head", [(1, 1), (3, 256), (4, 3)])
def test_equal_to_direct_form(spark, rows, seed, head):
    rng = random.Random(seed)
    who = customers(spark, *[(i, rng.choice(["x", "x", "y", "z", None])) for i in range(60)])
    ids = [f"P{i:02d}" for i in range(12)]
    pairs = {(c, p) for c in range(50) for p in rng.sample(ids[:10], rng.choice([0, 1, 3, 9, 10]))}
    check(spark, rows, who, products(spark, *ids), sorted(pairs), head)


def test_traps(spark, rows):
    who = customers(spark, (1, "x"), (2, "x"), (3, None), (4, "alone"), (5, "x"))
    what = products(spark, "A", "B", "C")
    pairs = [(1, "A"), (1, "B"), (1, "C"), (2, "B"), (3, "A")]
    best = check(spark, rows, who, what, pairs, head=2)
    assert best == {1: None,    # bought everything
                    2: "A",     # A and C have one buyer each: the lower id
                    3: "B",     # no segment: nothing is popular, the lowest id not bought
                    4: "A",     # no buyers in the segment
                    5: "B"}     # never ordered: the most popular


def test_owner_of_all_sold_in_segment(spark, rows):
    who = customers(spark, (1, "x"), (2, "y"))
    best = check(spark, rows, who, products(spark, "A", "B", "C", "D"),
                 [(1, "B"), (1, "C"), (2, "A")], head=1)
    assert best == {1: "A", 2: "B"}


def test_plan_has_no_product_of_tables(spark):
    who, what = customers(spark, (1, "x"), (2, "x")), products(spark, "A", "B")
    plan = (next_best(who, what, bought(spark, (1, "A")))
            ._jdf.queryExecution().executedPlan().toString())
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_every_customer_once(spark):
    who = customers(spark, *[(i, "x") for i in range(9)])
    found = next_best(who, products(spark, "A", "B"), bought(spark, (1, "A"), (2, "B")))
    assert found.count() == 9 == found.agg(F.count_distinct("customer_id")).first()[0]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_one_rank_for_nearly_all(spark, rows, monkeypatch, limit):
    """Customers that own nothing, with and without segment, by both ways to name their product."""
    monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
    who = customers(spark, *[(i, "x" if i % 2 else None) for i in range(400)])
    best = check(spark, rows, who, products(spark, "A", "B", "C"),
                 [(1, "B"), (2, "A"), (4, "A"), (4, "B"), (4, "C")], head=2)
    assert best[3] == "B" and best[0] == "A" and best[1] == "A" and best[2] == "B"
    assert best[4] is None and len(best) == 400

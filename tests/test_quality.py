from datetime import date
from decimal import Decimal

import pytest
from frames import CUSTOMER, LINE, PRODUCT, customers, line, lines, products
from pyspark.sql import functions as F

from tradegrain.functions import canonical, slug
from tradegrain.operators import keys
from tradegrain.operators.keys import keep_one, orphans, repeated_keys, require_unique, surplus_rows
from tradegrain.operators.rules import Rule, apply_rules, observed, split, violations
from tradegrain.plans import medallion, sales_rules
from tradegrain.sources.schemas import REGIONS, SEGMENTS


def shop(number, name="Shop", region="Wales", segment="Regional"):
    return (number, name, region, segment, "M", date(2023, 5, 1))


def raw_customers(spark):
    """48 good shops, 2 of an unknown region, which only warns, and 13 to set aside: 3 of an
    unknown segment, 5 with a name of a test, 4 without an id, 1 with the first two faults."""
    return spark.createDataFrame(
        [shop(n, f"Shop {n}", REGIONS[n % len(REGIONS)], SEGMENTS[n % len(SEGMENTS)])
         for n in range(48)]
        + [shop(60, region="Lemuria"), shop(61, region=None)]
        + [shop(70, segment="Kiosk"), shop(71, segment=None), shop(72, segment="")]
        + [shop(80 + n, name) for n, name in enumerate(
            ["Test", "the LATEST look", "contest corner", "testament books", "Untested goods"])]
        + [shop(None, f"No number {n}") for n in range(4)]
        + [shop(90, "tEsT kiosk", segment="Kiosk")], CUSTOMER)


def raw_products(spark):
    """20 good products, and 6 to set aside: 2 without an id, 3 without a price above 0, 1 with
    both faults."""
    def product(number, price="4.00", category="Chilled", cost="2.80"):
        return (number, "Thing", category, None if price is None else Decimal(price),
                Decimal(cost), None)

    return spark.createDataFrame(
        [product(f"G{n}") for n in range(20)] + [product(None), product(None, category="Toys")]
        + [product("Z1", "0.00"), product("Z2", "-0.01"), product("Z3", None)]
        + [product(None, "0.00")], PRODUCT)


def raw_orders(spark):
    """600 good lines, 9 more copies of some, and 28 to set aside, 3 of them with two faults."""
    good = [line(n, n % 48, f"G{n % 20}", "2026-02-03", n % 9 + 1) for n in range(600)]
    copies = [good[5]] * 2 + good[100:107]
    bad = [(None, "G1", {})] * 4 + [(1, None, {})] * 5 + [(None, None, {})]
    bad += [(1, "G1", {"quantity": q}) for q in (0, 0, -1, -7, -100, 0)]
    bad += [(1, "G1", {"discount": d}) for d in ("-0.01", "100.01", "250", "-5", "999", "101", "-99")]
    bad += [(1, "G1", {"day": d}) for d in ("2026-06-01", "2027-01-01", "2999-12-31")]
    bad += [(1, "G1", {"quantity": 0, "discount": "200"})] * 2
    return spark.createDataFrame(good + copies + [
        line(5000 + n, customer, product, **faults)
        for n, (customer, product, faults) in enumerate(bad)], LINE)


@pytest.fixture(scope="module")
def raw(spark):
    return {"customers": raw_customers(spark), "products": raw_products(spark),
            "orders": raw_orders(spark)}


def test_issue_summary(spark, raw, rows):
    found = {r[:2]: r[2] for r in rows(medallion.issue_summary(raw, medallion.entities()))}
    assert found == {
        ("customers", "customer_id_present"): 4, ("customers", "region_known"): 2,
        ("customers", "segment_known"): 4, ("customers", "name_not_test"): 6,
        ("products", "product_id_present"): 3, ("products", "list_price_positive"): 4,
        ("orders", "customer_id_present"): 5, ("orders", "product_id_present"): 6,
        ("orders", "quantity_positive"): 8, ("orders", "discount_in_range"): 9,
        ("orders", "order_date_not_future"): 3, ("orders", "order_id_unique"): 9}


def test_silver_sizes(raw):
    sizes = {name: (medallion.silver(raw[name], spec).table.count(),
                    medallion.silver(raw[name], spec).quarantine.count())
             for name, spec in medallion.entities().items()}
    assert sizes == {"customers": (50, 13), "products": (20, 6), "orders": (600, 28)}


def test_strict_region_rule(raw):
    spec = medallion.Entity("customers", raw["customers"].schema, "customer_id",
                            sales_rules.customer_rules(on_region="drop"))
    assert medallion.silver(raw["customers"], spec).table.count() == 48


def test_reconciliation(spark, raw, rows):
    clean = {n: medallion.silver(raw[n], s).table for n, s in medallion.entities().items()}
    assert rows(medallion.reconciliation(clean, raw)) == [
        ("customers", 50, 63, 13), ("orders", 600, 637, 37), ("products", 20, 26, 6)]


def test_parts_make_up_the_input(raw, rows):
    spec = medallion.entities()["orders"]
    checked = apply_rules(raw["orders"], spec.rules)
    parts = split(checked, spec.rules)
    whole = parts.valid.unionByName(parts.quarantine.drop("failed_rules")).unionByName(
        parts.dropped.drop("failed_rules"))
    assert rows(whole) == rows(raw["orders"])


def test_two_rules_broken_quarantined_once(spark, rows):
    bad = lines(spark, line(1, 1, "A", quantity=0, discount="150"))
    checks = sales_rules.order_rules()
    assert dict(r[1:] for r in rows(violations(bad, checks, "o")))["quantity_positive"] == 1
    parts = split(apply_rules(bad, checks), checks)
    assert parts.quarantine.first()["failed_rules"] == ["quantity_positive", "discount_in_range"]
    assert parts.quarantine.count() == 1 and parts.valid.count() == 0


def test_good_copy_survives_a_bad_one(spark, rows):
    spec = medallion.entities()["orders"]
    both = lines(spark, line(1, 1, "A", quantity=-4), line(1, 1, "A", quantity=4))
    found = medallion.silver(both, spec)
    assert rows(found.table, "order_id", "quantity") == [(1, 4)]
    assert found.quarantine.count() == 1


def test_actions(spark):
    df = spark.range(4)
    checks = [Rule("small", F.col("id") < 3, "warn"), Rule("not_one", F.col("id") != 1, "drop"),
              Rule("not_two", F.col("id") != 2)]
    parts = split(apply_rules(df, checks), checks)
    assert [sorted(r[0] for r in p.select("id").collect()) for p in parts] == [[0, 3], [2], [1]]
    with pytest.raises(Exception, match="rule never is violated"):
        apply_rules(df, [Rule("never", F.col("id") < 3, "fail")]).collect()


def test_null_is_a_violation(spark):
    df = spark.createDataFrame([(None,), (5,)], "x int")
    assert violations(df, [Rule("r", F.col("x") > 1)], "t").first()["violations"] == 1


def test_counters_pass_by(spark, raw):
    checks = medallion.entities()["products"].rules
    seen, counters = observed(apply_rules(raw["products"], checks), checks, "products")
    seen.write.format("noop").mode("overwrite").save()
    assert counters.get == {"rows": 26, "product_id_present": 3, "list_price_positive": 4}


def test_normalise(spark, rows):
    df = spark.createDataFrame(
        [("12", " sOUTH east ", "soon"), ("x", "Mordor ", "2024-02-29")],
        "customer_id string, region string, join_date string")
    found = medallion.normalise(df, medallion.entities()["customers"])
    assert rows(found) == sorted([(12, "South East", None),
                                  (None, "Mordor", date(2024, 2, 29))], key=repr)


def test_keep_one(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (1, "a", 3), (2, None, 1), (2, "z", 0)],
                               "k int, s string, n int")
    assert rows(keep_one(df, ["k"])) == [(1, "a", 3), (2, None, 1)]
    assert rows(keep_one(df, ["k"], prefer=["n"])) == [(1, "b", 2), (2, "z", 0)]
    assert rows(keep_one(df.select("k"), ["k"])) == [(1,), (2,)]


@pytest.mark.parametrize("limit", [200_000, 1])
def test_hot_key_collapses_before_the_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(keys, "BROADCAST_ROWS", limit)
    plan = (keep_one(spark.range(100).selectExpr("id % 3 as k", "id"), ["k"])
            ._jdf.queryExecution().executedPlan().toString())
    assert "partial_min" in plan and "Window" not in plan


def test_rows_of_lone_keys_stay_in_place(spark):
    lone = spark.range(100).selectExpr("id as k", "id * 2 as v")
    assert "Exchange" not in keep_one(lone, ["k"])._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [200_000, 30, 1])
def test_keep_one_by_any_way(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(keys, "BROADCAST_ROWS", limit)
    df = (spark.range(400).selectExpr("if(id % 11 = 0, null, id % 97 * (id % 97)) as k",
                                      "if(id % 5 = 0, null, cast(id % 7 as string)) as s",
                                      "id % 3 as n").repartition(5))
    kept = [tuple(r) for r in df.where("k is null").collect()]
    whole = {}
    for k, s, n in df.where("k is not null").collect():
        whole.setdefault(k, []).append((s is not None, s or "", n, (k, s, n)))
    assert rows(keep_one(df, ["k"])) == sorted(kept + [min(v)[3] for v in whole.values()], key=repr)


def test_repeats(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert rows(repeated_keys(df, ["k"])) == [(1, 3), (3, 2)]
    assert rows(surplus_rows(df, ["k"])) == [(3,)]
    assert rows(surplus_rows(df.filter("k = 2"), ["k"])) == [(0,)]


def test_orphans(spark, rows):
    sold = lines(spark, line(1, 1, "A"), line(2, 8, "A"), line(3, 8, "A"), line(4, None, "A"))
    assert rows(orphans(sold, "customer_id", customers(spark, 1, 2), "customer_id")) == [(8, 2)]


def test_require_unique(spark):
    require_unique(spark.range(5), "id")
    for bad in ([1, 1], [1, None]):
        with pytest.raises(ValueError, match="unique"):
            require_unique(spark.createDataFrame([(x,) for x in bad], "k int"), "k")


def test_price_band(spark, rows):
    sold = lines(spark, line(1, 1, "A", price="10.80"), line(2, 1, "A", price="10.81"),
                 line(3, 1, "A", price="9.00"), line(4, 1, "B", price="9.20"))
    assert rows(sales_rules.price_band(sold, products(spark, "A", "B"))) == [("A", 3, 2)]


def test_domain_rules(spark, raw, rows):
    found = violations(raw["products"], sales_rules.domain_rules_products(), "products")
    assert dict(r[1:] for r in rows(found)) == {"category_known": 1, "cost_in_band": 4}
    odd = lines(spark, line(1, 1, "A", discount="7.5"))
    found = violations(odd, sales_rules.domain_rules_orders(), "orders")
    assert dict(r[1:] for r in rows(found)) == {"discount_whole": 1, "discount_known": 1,
                                                "currency_known": 0}
    whole = lines(spark, line(1, 1, "A", discount="7"), line(2, 1, "A", discount="15"))
    found = violations(whole, sales_rules.domain_rules_orders(), "orders")
    assert dict(r[1:] for r in rows(found))["discount_known"] == 1


def test_gold(spark, raw, rows):
    parts = {n: medallion.silver(raw[n], s).table for n, s in medallion.entities().items()}
    gold = medallion.gold_region_month(parts["customers"], parts["products"], parts["orders"])
    assert gold.agg(F.sum("orders")).first()[0] == 600


def test_functions(spark, rows):
    df = spark.createDataFrame([("User@Example.com",), ("--A  b--",), ("é",)], "s string")
    assert [r[0] for r in df.select(slug(F.col("s"))).collect()] == ["user_example_com", "a_b", ""]
    assert [r[0] for r in df.select(canonical(F.col("s"), ["É"])).collect()][2] == "É"

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradegrain.operators.numbering import number_rows
from tradegrain.operators.scales import add_scales, ntile, percentile
from tradegrain.session import settle


def table(spark, n, seed=1, ids=lambda i: i):
    rng = random.Random(seed)
    rows = [(ids(i), rng.choice(["a", "a", "a", "b", None]),
             rng.choice([None, 0, 0, 5, rng.randint(0, 400)]),
             Decimal(rng.choice([0, 0, rng.randint(-500, 10**6)])) / 100) for i in range(n)]
    kind = "string" if isinstance(ids(0), str) else "long"
    return settle(spark.createDataFrame(
        rows, f"id {kind}, g string, v int, m decimal(33,2)").repartition(4), "scales")


def asked():
    return [ntile("r", -F.col("v"), 5, "last"), ntile("w", -F.col("v"), 5, "first"),
            ntile("f", F.col("v"), 5), ntile("m7", F.col("m"), 7),
            percentile("p", F.col("m")), percentile("pg", F.col("m"), "g"),
            percentile("p0", F.col("v"), decimals=0)]


def expected(df):
    def pct(window, d):
        return F.round(100 * F.percent_rank().over(window), d)
    return df.select(
        "*", F.ntile(5).over(W.orderBy(F.col("v").desc_nulls_last(), "id")).alias("r"),
        F.ntile(5).over(W.orderBy(F.col("v").desc_nulls_first(), "id")).alias("w"),
        F.ntile(5).over(W.orderBy("v", "id")).alias("f"),
        F.ntile(7).over(W.orderBy("m", "id")).alias("m7"),
        pct(W.orderBy("m"), 1).alias("p"), pct(W.partitionBy("g").orderBy("m"), 1).alias("pg"),
        pct(W.orderBy("v"), 0).alias("p0"))


@pytest.mark.parametrize("n", [1, 6, 1201])
def test_equal_to_windows(spark, same, n):
    df = table(spark, n)
    same(expected(df), add_scales(df, asked(), "id"))


def test_keys_keep_their_type(spark, same):
    """Doubles that a decimal could not hold, beside keys of other types."""
    values = [1e-9, 2e-9, 9e-9, -3e30, 2e31, 0.0, -0.0, 5e-324, 1.5, float("nan"), float("inf"),
              float("-inf"), None, 2e31]
    df = settle(spark.createDataFrame(
        [(i, "a" if i % 3 else "b", v, i % 4) for i, v in enumerate(values)],
        "id long, g string, d double, v int").repartition(3), "doubles")
    found = add_scales(df, [percentile("p", F.col("d")), percentile("pg", F.col("d"), "g"),
                            ntile("n", F.col("d"), 5), ntile("nv", F.col("v"), 3)], "id")

    def pct(window):
        return F.round(100 * F.percent_rank().over(window), 1)
    wanted = df.select("*", pct(W.orderBy("d")).alias("p"),
                       pct(W.partitionBy("g").orderBy("d")).alias("pg"),
                       F.ntile(5).over(W.orderBy("d", "id")).alias("n"),
                       F.ntile(3).over(W.orderBy("v", "id")).alias("nv"))
    same(wanted.drop("d"), found.drop("d"))


def test_decimals_are_bounded():
    with pytest.raises(ValueError):
        percentile("p", F.col("v"), decimals=4)


def test_text_ids(spark, same):
    df = table(spark, 97, seed=3, ids=lambda i: f"c'{i:04d}\"\\")
    same(expected(df), add_scales(df, asked(), "id"))


def test_all_values_equal(spark, rows):
    df = settle(spark.range(10).select("id", F.lit(7).alias("v")), "equal")
    found = add_scales(df, [ntile("t", F.col("v"), 5), percentile("p", F.col("v"))], "id")
    assert rows(found, "id", "t", "p") == [(i, i // 2 + 1, 0.0) for i in range(10)]


def test_no_single_task_sort(spark):
    df = table(spark, 50)
    plan = add_scales(df, asked(), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_empty_table(spark):
    df = table(spark, 5).filter("id < 0")
    assert add_scales(df, asked(), "id").count() == 0


def test_number_rows(spark, rows):
    df = spark.createDataFrame([(g, i) for g, n in (("a", 70), ("b", 3), (None, 9))
                                for i in range(n)], "g string, i int").repartition(4)
    found = number_rows(df, ["g"], ["i"])
    assert rows(found.selectExpr("g", "i", "position", "group_size")) == sorted(
        [(g, i, i, n) for g, n in (("a", 70), ("b", 3), (None, 9)) for i in range(n)], key=repr)


def test_number_rows_without_group(spark, rows):
    found = number_rows(spark.range(41).repartition(4), [], [F.desc("id")])
    assert rows(found) == sorted([(i, 40 - i, 41) for i in range(41)], key=repr)


def test_equal_values_spread_over_tasks(spark):
    """The tie-break lets the sort cut through a value that fills the table."""
    df = spark.range(8000).select("id", F.lit(0).alias("v")).repartition(4)
    found = number_rows(df, [], ["v", "id"])
    placed = settle(df.orderBy("v", "id").withColumn("task", F.spark_partition_id()), "placed")
    sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
    assert found.agg(F.max("position"), F.count_distinct("position")).first()[:] == (7999, 8000)

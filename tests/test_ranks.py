"""Ranks across tasks and merged distinct counts against Spark's own forms."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradegrain.operators.ranks import add_ranks
from tradegrain.plans.distinct_counts import add_bitmaps, build_bitmaps, distinct_count

CASES = {
    "ties over many tasks": [(i, i % 3 // 2, "a") for i in range(300)],
    "all equal": [(i, 5, "a") for i in range(200)],
    "giant group": [(i, i // 7, "b" if i % 10 else f"g{i}") for i in range(300)],
    "nulls": [(i, None if i % 2 else i % 5, None if i % 3 else "x") for i in range(200)],
    "one row": [(1, 1, "a")],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("group", [[], ["kind"]])
def test_ranks_equal_the_built_in(spark, same, name, group):
    spread = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = spark.createDataFrame(CASES[name], "id int, value int, kind string").repartition(5)
        over = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.col("value").asc_nulls_first())
        want = rows.select("*", F.rank().over(over).cast("long").alias("rank"),
                           F.percent_rank().over(over).alias("percent_rank"),
                           F.cume_dist().over(over).alias("cume_dist"))
        same(want, add_ranks(rows, "value", "id", group))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", spread)


def test_merged_counts_are_exact(spark, same):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 17 != 0, F.pmod(F.col("id") * 7919, F.lit(200)) * 1_000_003 - 5_000_000)
        .alias("who"), (F.col("id") % 4).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 3)
        .alias("b"))
    halves = [build_bitmaps(rows.where(F.col("a") % 2 == i), ["a", "b"], "who") for i in (0, 1)]
    stored = add_bitmaps(*halves)
    for names in ([], ["a"], ["b"], ["a", "b"]):
        want = rows.where("who is not null").groupBy(*names).agg(
            F.count_distinct("who").alias("distinct"))
        same(want, distinct_count(stored, names))
    some = distinct_count(stored, [], F.col("a") > 1)
    assert some.first()[0] == rows.where("a > 1").select("who").distinct().where(
        "who is not null").count()
    assert distinct_count(stored.limit(0)).first()[0] == 0

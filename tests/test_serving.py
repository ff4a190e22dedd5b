import random

import pytest
from pyspark.sql import functions as F

from tradegrain.operators.changes import apply_changes, as_of, diff
from tradegrain.operators import digests
from tradegrain.plans import serving

CARD = "k int, name string, n int, stamp int"


def snapshot(spark, seed, stamp):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(k, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), stamp)
         for k in rng.sample(range(60), 40)], CARD)


def test_diff(spark, rows):
    old = spark.createDataFrame([(1, "a", 1, 0), (2, "b", None, 0), (3, "c", 3, 0)], CARD)
    new = spark.createDataFrame([(2, "b", None, 9), (3, "c", 4, 9), (4, "d", 1, 9)], CARD)
    found = rows(diff(old, new, "k", ["stamp"], unchanged=True), "k", "op")
    assert found == [(1, "DELETE"), (2, "SAME"), (3, "UPDATE"), (4, "INSERT")]
    assert rows(diff(old, new, "k", ["stamp"]), "k") == [(1,), (3,), (4,)]
    assert rows(diff(old, new, "k"), "k") == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("unchanged", [False, True])
def test_applying_the_difference_gives_the_new_snapshot(spark, rows, unchanged):
    old, new = snapshot(spark, 1, 0), snapshot(spark, 2, 0)
    changed = diff(old, new, "k", unchanged=unchanged)
    assert rows(apply_changes(old, changed, "k")) == rows(new)


def test_no_difference(spark):
    card = snapshot(spark, 3, 0)
    assert diff(card, snapshot(spark, 3, 7), "k", ["stamp"]).count() == 0


def test_as_of(spark, rows):
    history = spark.createDataFrame(
        [(1, 1, "INSERT", "a"), (1, 3, "UPDATE", "b"), (1, 5, "DELETE", None),
         (2, 2, "INSERT", "c"), (3, 9, "INSERT", "d")],
        "k int, version int, op string, name string")
    assert rows(as_of(history, "k", "version", 2), "k", "name") == [(1, "a"), (2, "c")]
    assert rows(as_of(history, "k", "version", 4), "k", "name") == [(1, "b"), (2, "c")]
    assert rows(as_of(history, "k", "version"), "k", "name") == [(2, "c"), (3, "d")]


def test_publish_and_lookup(spark, rows, tmp_path):
    card = spark.range(1000).selectExpr("id as k", "id * 2 as v").repartition(4)
    published = serving.publish(card, str(tmp_path / "card"), "k")
    hit = serving.lookup(published, "k", [7, 2000])
    assert rows(hit) == [(7, 14)]
    assert "PushedFilters: [In(k" in hit._jdf.queryExecution().executedPlan().toString()
    wanted = spark.createDataFrame([(3,), (5000,), (3,)], "k long")
    assert rows(serving.lookup_many(published, "k", wanted)) == [(3, 6)]
    assert serving.lookup_many(published, "k", wanted.filter("k < 0")).count() == 0
    with pytest.raises(ValueError):
        serving.publish(card.withColumn("k", F.lit(1)), str(tmp_path / "bad"), "k")


def test_sync_and_restore(spark, rows, tmp_path):
    history = str(tmp_path / "history")
    cards = [snapshot(spark, seed, seed) for seed in (1, 2, 2, 4)]
    for version, card in enumerate(cards):
        serving.sync(card, history, "k", version, ignore=["stamp"])
    serving.sync(cards[3], history, "k", 3, ignore=["stamp"])     # again: replaces itself
    for version, card in enumerate(cards):
        restored = serving.restore(spark, history, "k", version)
        assert rows(restored, "k", "name", "n") == rows(card, "k", "name", "n")
    assert serving.read_history(spark, history).filter("version = 2").count() == 0


@pytest.mark.parametrize("every", [1, 2, 3])
def test_states_from_a_base_and_what_came_since(spark, rows, tmp_path, every):
    history = str(tmp_path / "history")
    cards = [snapshot(spark, seed, 0) for seed in (1, 2, 3, 3, 4, 1)]
    cards.append(cards[-1].withColumn("extra", F.when(F.col("k") % 2 == 0, F.col("n"))))
    cards.append(cards[-1].filter("k > 20"))
    for version, card in enumerate(cards):
        serving.sync(card, history, "k", version, every=every)
    for version, card in enumerate(cards):
        restored = serving.restore(spark, history, "k", version, every)
        assert rows(restored, *card.columns) == rows(card)
    known = serving.recent_history(spark, history, 7, every)
    assert known.count() < serving.read_history(spark, history).count()


@pytest.mark.parametrize("limit", [200_000, 1])
def test_many_keys_leave_the_snapshot_in_place(spark, rows, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(serving, "BROADCAST_ROWS", limit)
    card = spark.range(1000).selectExpr("id as k", "id * 2 as v").repartition(4)
    published = serving.publish(card, str(tmp_path / "card"), "k")
    wanted = spark.range(300, 700, 5).union(spark.range(300, 400, 50)).selectExpr("id as k")
    found = serving.lookup_many(published, "k", wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,300)" in plan and "LessThanOrEqual(k,695)" in plan
    assert limit == 1 or "hashpartitioning" not in plan
    assert rows(found) == [(k, 2 * k) for k in range(300, 700, 5)]


@pytest.mark.parametrize("kind, leaves", [("int", 1), ("int", 64), ("string", 7), ("date", 7),
                                          ("decimal(9,2)", 7)])
def test_difference_by_digests(spark, rows, leaves, kind):
    def keyed(df):
        key = F.date_add(F.lit("2026-01-01"), F.col("k")) if kind == "date" else F.col("k")
        return df.withColumn("k", key.cast(kind))

    pairs = [(snapshot(spark, 1, 0), snapshot(spark, 2, 1)),
             (snapshot(spark, 3, 0), snapshot(spark, 3, 1)),
             (snapshot(spark, 4, 0), snapshot(spark, 4, 1).filter("k not between 20 and 30")),
             (snapshot(spark, 5, 0), snapshot(spark, 5, 0).withColumn("more", F.lit(None).cast("int"))),
             (snapshot(spark, 6, 0).filter("k < 0"), snapshot(spark, 6, 0)),
             (snapshot(spark, 6, 0), snapshot(spark, 6, 0).filter("k < 0"))]
    for old, new in pairs:
        old, new = keyed(old), keyed(new)
        found = digests.diff_by_digests(old, new, "k", ["stamp"], leaves=leaves)
        assert rows(found) == rows(diff(old, new, "k", ["stamp"]))


def test_nulls_in_other_columns_make_other_digests(spark, rows):
    old = spark.createDataFrame([(1, None, "a"), (2, "b", None)], "k int, x string, y string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, x string, y string")
    assert rows(digests.diff_by_digests(old, new, "k"), "k", "op") == [(1, "UPDATE")]


def test_only_changed_ranges_are_read_again(spark, rows, tmp_path):
    def publish(df, name):
        return serving.publish(df, str(tmp_path / name), "k")

    old = publish(spark.range(20_000).selectExpr("id as k", "id * 2 as v"), "old")
    new = publish(old.withColumn("v", F.when(F.col("k").between(7000, 7010), 0)
                                 .otherwise(F.col("v"))), "new")
    cuts = digests.key_cuts(old, "k", 512)
    tree = digests.digest_tree(old, "k", cuts, ["v"])
    changed = digests.changed_leaves(tree, digests.digest_tree(new, "k", cuts, ["v"]))
    assert 1 <= len(changed) <= 4
    found = digests.diff_by_digests(old, new, "k", old_tree=tree, leaves=512)
    assert rows(found, "k", "op") == [(k, "UPDATE") for k in range(7000, 7011)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(k,") == 2 and plan.count("LessThan(k,") == 2
    with pytest.raises(ValueError):
        digests.changed_leaves(tree, digests.digest_tree(new, "k", cuts[1:], ["v"]))
    with pytest.raises(ValueError):
        digests.key_cuts(spark.range(1).select(F.col("id").cast("double").alias("k")), "k")


@pytest.mark.parametrize("changed", [[0], [3], [0, 1, 2], [0, 2, 9], list(range(0, 400, 3)),
                                     [1, 50, 51, 300]])
def test_spans_cover_the_leaves(changed):
    spans = digests._spans(changed)
    assert len(spans) <= digests.SPANS
    assert all(sum(low <= leaf <= high for low, high in spans) == 1 for leaf in changed)
    assert all(low in changed and high in changed for low, high in spans)


def test_bucketed_snapshot_is_not_shuffled(spark, rows):
    card = spark.range(3000).selectExpr("id as k", "id * 2 as v").repartition(4)
    snapshot = serving.publish_bucketed(card, "tradegrain_bucketed_test", "k", 8)
    wanted = spark.range(0, 4000, 3).selectExpr("cast(id as int) as k").union(
        spark.sql("select null as k union all select 3"))
    found = serving.lookup_bucketed(snapshot, "k", wanted, 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    assert rows(found) == rows(card.filter("k % 3 = 0"))
    spark.sql("DROP TABLE tradegrain_bucketed_test")

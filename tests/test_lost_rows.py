"""No row is lost without a trace: missing keys, unparseable values, malformed lines, odd days."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tradegrain.operators.keys import keep_one
from tradegrain.plans import medallion
from tradegrain.sources.schemas import ORDERS
from tradegrain.streaming import jobs

GOOD = ('{"order_id": 1, "customer_id": 7, "product_id": "P", "order_date": "2025-03-30", '
        '"quantity": 2, "unit_price": 5.0, "discount_pct": 0, "currency": "GBP"}')
LINES = [GOOD, GOOD, GOOD.replace("5.0", '"oops"'), GOOD.replace('"order_id": 1', '"order_id": null'),
         GOOD.replace('"order_id": 1', '"order_id": null'), GOOD[:60], GOOD.replace(": 2,", ": -1,")]


def test_rows_without_a_key_stay_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (None, "d")],
                               "k int, v string")
    assert sorted(map(tuple, keep_one(df, ["k"]).collect()), key=repr) == [
        (1, "a"), (None, "c"), (None, "c"), (None, "d")]
    only_keys = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert keep_one(only_keys, ["k"]).count() == 3


def test_every_line_is_kept_or_set_aside(spark, tmp_path):
    (tmp_path / "orders.json").write_text("\n".join(LINES))
    raw = medallion.bronze(spark, str(tmp_path), ORDERS)
    found = medallion.silver(raw, medallion.entities()["orders"])
    reasons = {tuple(r["failed_rules"]) for r in found.quarantine.collect()}
    assert found.table.count() == 1 and found.quarantine.count() == len(LINES) - 2
    assert any("line_parses" in r for r in reasons) and ("quantity_positive",) in reasons
    assert ("order_id_present",) in reasons
    assert {"_corrupt_record", "_source_file"} <= set(found.quarantine.columns)
    assert found.quarantine.where("_corrupt_record like '%oops%'").count() == 1


def test_values_that_do_not_parse_are_violations(spark):
    entity = medallion.entities()["products"]
    raw = spark.createDataFrame([("P1", "x", "Frozen", "oops", "1.0", None),
                                 ("P2", "y", "Frozen", "2.0", "1.0", None)],
                                ", ".join(f"{f.name} string" for f in entity.schema))
    found = medallion.silver(raw, entity)
    assert [r.product_id for r in found.table.collect()] == ["P2"]
    assert "list_price_parses" in found.quarantine.first()["failed_rules"]


@pytest.fixture
def london(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_days_across_a_clock_change(spark, london):
    days = [date(2025, 3, 25) + timedelta(days=k) for k in range(10)]
    lines = spark.createDataFrame([(k, d, 1, 2.0, 0.0) for k, d in enumerate(days)],
                                  "order_id int, order_date date, quantity int, unit_price double, "
                                  "discount_pct double")
    found = jobs.daily_revenue(lines, "3 days")
    assert sorted(r.order_date for r in found.select("order_date").collect()) == days


def test_streamed_rows_without_a_key_all_pass(spark, tmp_path):
    rows = [(1, "2025-01-01 00:00:00"), (1, "2025-01-01 00:00:01"), *[(None, "2025-01-01 00:00:02")] * 3]
    df = spark.createDataFrame(rows, "k int, at string").withColumn("at", F.col("at").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    for spread in (0, 2):
        stream = jobs.deduplicated(jobs.table_stream(spark, str(tmp_path / "in") + "/", df.schema),
                                   ["k"], "at", "1 day", spread)
        out = str(tmp_path / f"out{spread}")
        jobs.finish(jobs.append_to(stream, out, str(tmp_path / f"state{spread}")))
        assert spark.read.parquet(out).count() == 4


def test_rolling_reads_only_its_window(spark, tmp_path, capsys):
    from frames import line, lines, products
    from tradegrain.operators import grain
    frame = lines(spark, line(1, 1, "A", "2020-01-01"), line(2, 1, "A", "2026-01-01"),
                  line(3, 2, "A", "2024-05-31"))
    frame.write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    found = grain.rolling_only(stored, products(spark, "A"), "2026-05-31")
    assert [(r.customer_id, r.r12_orders) for r in found.collect()] == [(1, 1)]
    found.explain("formatted")
    assert "GreaterThan(order_date,2025-05-31)" in capsys.readouterr().out


def test_sync_with_a_new_column(spark, tmp_path):
    from tradegrain.plans import serving
    path = str(tmp_path / "history")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    serving.sync(first, path, "k", 0)
    serving.sync(first.withColumn("extra", F.when(F.col("k") == 2, F.lit("x"))), path, "k", 1)
    assert sorted(map(tuple, serving.restore(spark, path, "k", 1).select("k", "v", "extra").collect())) \
        == [(1, "a", None), (2, "b", "x")]
    with pytest.raises(ValueError):
        serving.sync(first.unionAll(first), path, "k", 2)

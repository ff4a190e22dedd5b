"""Bronze that loses nothing, silver that accounts for every row, gold that follows changes."""

import os
import subprocess
import sys
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from frames import LINE, line, lines, products
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradegrain.operators.grain import customer_product_grain, customer_rollup, rolling_only
from tradegrain.operators.rules import Rule
from tradegrain.plans import maintained, medallion
from tradegrain.sources.json_files import read_json
from tradegrain.streaming import jobs, rolling

SCHEMA = StructType().add("id", "integer").add("name", "string")


@pytest.fixture
def documents(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([
        '{"id": 1, "name": "a", "extra": {"x": [1, 2.5]}}', "", "  ", '{"id": "two", "tag": "t"}',
        '{"id": 3, "name": null, "it\'s": 7, "tag": null}', '[1, 2]', '{"id": 4', "null", "{}"]))
    (tmp_path / "b.json").write_text('{"id": 5, "tag": 9, "name": "b", "ID2": true}\n')
    return medallion.bronze(spark, str(tmp_path), SCHEMA, documents=True)


def test_documents_keep_what_the_schema_does_not_name(documents):
    found = documents.select(
        "id", "name", "_corrupt_record", medallion.field_of("it's", "int").alias("its"),
        medallion.field_of("tag", "string").alias("tag"),
        F.try_variant_get("_document", "$.extra.x[1]", "double").alias("x"))
    rows = {r["id"]: r for r in found.collect() if r["id"] is not None}
    assert (rows[1]["x"], rows[3]["its"], rows[5]["tag"]) == (2.5, 7, "9")
    assert documents.where("_document is null").count() == 1           # the line that is cut off
    wrong = documents.where("id is null and _corrupt_record is not null")
    assert wrong.where(medallion.field_of("tag", "string") == "t").count() == 1
    assert documents.where("_source_file is null or _ingested_at is null").count() == 0


def test_reader_and_documents_agree(spark, documents, tmp_path, same):
    plain = read_json(spark, str(tmp_path), SCHEMA, keep_corrupt=True).cache()
    same(plain.where("id is not null").select("id", "name"),
         documents.where("id is not null").select("id", "name"))


def test_drift(documents, rows):
    entity = medallion.Entity("things", SCHEMA, "id", [])
    found = medallion.drift({"things": documents}, {"things": entity})
    assert {r[1:] for r in rows(found, "entity", "field", "type", "rows")} == {
        ("ID2", "BOOLEAN", 1), ("extra", "OBJECT<x: ARRAY<DECIMAL(21,1)>>", 1),
        ("it's", "BIGINT", 1), ("tag", "VARIANT", 3)}
    assert medallion.drift({"things": documents.limit(0)}, {"things": entity}).collect() == []


def test_silver_accounts_for_every_row(spark, documents):
    entity = medallion.Entity("things", SCHEMA, "id", [
        Rule("small", F.col("id") < 5, "drop"), Rule("named", F.col("name").isNotNull(), "warn")])
    parts = medallion.silver(documents, entity)
    n = parts.table.count() + parts.quarantine.count() + parts.dropped.count()
    assert n == documents.count() == parts.counters["rows"]
    assert [r["id"] for r in parts.dropped.collect()] == [5]
    assert parts.dropped.select(medallion.field_of("tag", "int")).first()[0] == 9
    assert [(r["id"], r["failed_rules"]) for r in parts.warned.collect()] == [(3, ["named"])]
    assert parts.counters["named"] == documents.where("name is null").count()
    report = {r["rule"]: r["violations"] for r in medallion.counts_of({"things": parts}).collect()}
    assert report == parts.counters


RANDOM = np.random.default_rng(3)
DAY = date(2026, 5, 31)


def some_lines(n, first=0):
    out = []
    for i in range(n):
        row = list(line(first + i, int(RANDOM.integers(1, 12)), f"P{RANDOM.integers(1, 8)}",
                        str(DAY - timedelta(days=int(RANDOM.integers(0, 800)))),
                        int(RANDOM.integers(1, 9)), "3.10", str(RANDOM.integers(0, 3) * 5)))
        for at in (0, 2, 4, 5):
            if RANDOM.random() < 0.08:
                row[at] = None
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("was, as_of", [("2026-03-31", "2026-05-31"), ("2026-05-31", "2026-05-31"),
                                        ("2026-05-31", "2025-11-30")])
def test_maintained_gold_equals_the_rebuilt_one(spark, same, was, as_of):
    kept, out, put = some_lines(150), some_lines(60, 1000), some_lines(40, 2000)
    out += [line(3000, 77, "P1", "2020-01-01"), line(3001, kept[0][1], "P2", "2019-01-01")]
    put += [line(3002, 78, "P3"), line(3003, 79, "unknown")] + [kept[1]]
    sold = products(spark, *[(f"P{i}", f"C{i % 3}", "1.25") for i in range(1, 8)])
    before, after = (spark.createDataFrame(x, LINE) for x in (kept + out, kept + put))
    changes = (spark.createDataFrame(put, LINE).withColumn("op", F.lit("INSERT")).unionByName(
        spark.createDataFrame(out, LINE).withColumn("op", F.lit("DELETE"))))
    stock = maintained.build_stock(before, was)
    gold = customer_rollup(maintained.grain_of(stock, sold))
    found = maintained.refresh(stock, gold, sold, before, after, changes, was, as_of)
    known = after.where("customer_id is not null and product_id is not null")
    whole = customer_product_grain(known, sold, F.lit(as_of).cast("date"))
    same(whole, maintained.grain_of(found.stock, sold))
    same(customer_rollup(whole), found.gold)
    same(maintained.build_stock(after, as_of), found.stock)
    touched = {r[0] for r in found.gold_changes.select("customer_id").collect()}
    assert 77 in touched and 78 in touched


def test_no_changes_touch_nothing(spark):
    before = spark.createDataFrame(some_lines(30), LINE)
    stock, sold = maintained.build_stock(before, DAY), products(spark, "P1", "P2")
    gold = customer_rollup(maintained.grain_of(stock, sold))
    found = maintained.refresh(stock, gold, sold, before, before,
                               before.limit(0).withColumn("op", F.lit("INSERT")), DAY, DAY)
    assert found.stock_changes.count() == found.gold_changes.count() == 0


def test_days_leave_when_the_batch_form_drops_them(spark):
    days = [date(2023, 12, 25) + timedelta(days=i) for i in range(450)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    for months in (1, 12, 13):
        for d, left, earlier in frame.select(
                "d", F.lit(None), F.add_months("d", -months)).collect():
            gone = rolling.leaves_on(earlier, months)
            assert gone <= d
            assert rolling.leaves_on(earlier + timedelta(days=1), months) > d


@pytest.mark.parametrize("store", [None, "HDFSBackedStateStoreProvider"])
def test_rolling_stream_finds_its_code_and_store_by_itself(spark, tmp_path, store):
    """Workers cannot import the package, and the session names another state store or none. A
    customer's days leave together or apart, and a line without a date counts for nothing."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    code = cloudpickle.dumps(rolling.RollingSums(12))
    apart = subprocess.run(
        [sys.executable, "-c", "import sys; from pyspark import cloudpickle;"
         "made = cloudpickle.loads(sys.stdin.buffer.read()); print(made.months)"],
        input=code, capture_output=True, cwd=tmp_path,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert apart.stdout.split() == [b"12"], apart.stderr.decode()
    if store:
        spark.conf.set(name, f"org.apache.spark.sql.execution.streaming.state.{store}")
    else:
        spark.conf.unset(name)
    kept = spark.conf.get(name, None)
    try:
        folder = str(tmp_path / "lines")
        days = ["2024-01-01", "2024-01-01", "2024-02-01", "2025-01-20", "2025-06-01"]
        undated = (99, 1, "A", None, *line(99, 1, "A")[4:])
        lines(spark, *[line(i, 1, "A", d) for i, d in enumerate(days)], undated,
              line(50, 2, "A", "2024-01-01")).write.parquet(folder)
        stream = jobs.table_stream(spark, folder, lines(spark, undated).schema)
        jobs.finish(rolling.publish_rolling(stream, "30 days", str(tmp_path / "out"),
                                            str(tmp_path / "state")), 120)
        assert spark.conf.get(name, None) == kept
    finally:
        spark.conf.set(name, before)
    found = rolling.current_rolling(spark.read.parquet(str(tmp_path / "out")))
    assert [(r[0], r[1], float(r[2])) for r in found.collect()] == [(1, 2, 20.0)]


def test_rolling_stream_equals_batch_after_each_batch(spark, tmp_path, same):
    folder = tmp_path / "lines"
    sold = products(spark, *[f"P{i}" for i in range(1, 9)])
    months = [date(2024, 2, 1), date(2024, 6, 15), date(2025, 1, 31), date(2025, 2, 28),
              date(2026, 3, 1)]
    seen = []
    for i, last in enumerate(months):
        seen += [line(100 * i + k, int(RANDOM.integers(1, 6)), "P1",
                      str(last - timedelta(days=int(RANDOM.integers(0, 30)))), 2, "1.50")
                 for k in range(12)] + [line(100 * i + 50, 1, "P1", str(last))]
        lines(spark, *seen[-13:]).coalesce(1).write.mode("append").parquet(str(folder))
        stream = jobs.table_stream(spark, str(folder), lines(spark, *seen[:1]).schema, 1)
        jobs.finish(rolling.publish_rolling(stream, "35 days", str(tmp_path / "out"),
                                            str(tmp_path / "state")), 120)
        found = rolling.current_rolling(spark.read.parquet(str(tmp_path / "out")))
        day = max(r[3] for r in seen) - timedelta(days=35)
        history = lines(spark, *seen)
        window = history.where(F.col("order_date") > F.add_months(F.lit(day), -12))
        want = window.groupBy("customer_id").agg(
            F.count("order_id").alias("r12_orders"),
            F.sum(F.col("quantity") * F.col("unit_price")).alias("r12_revenue"))
        same(want, found)


def test_start_of_window_and_leaving_day_agree():
    for months in (1, 11, 12, 13, 24):
        for i in range(1200):
            day = date(2023, 1, 1) + timedelta(days=i)
            start = rolling.start_on(day, months)
            assert rolling.leaves_on(start, months) <= day
            assert rolling.leaves_on(start + timedelta(days=1), months) > day


@pytest.mark.parametrize("kind, first", [("bigint", 2**60), ("string", "")])
def test_rolling_state_is_kept_by_share(spark, tmp_path, same, kind, first):
    """The state store holds a row per share, not per customer; large numbers and no number at all
    stay the customers they are, and a customer whose lines all leave is gone."""
    schema = LINE.replace("customer_id int", f"customer_id {kind}")
    folder, out, state = (str(tmp_path / n) for n in ("lines", "out", "state"))
    names = [None, *(first + (i if kind == "bigint" else str(i)) for i in range(40))]
    seen = []
    for i, last in enumerate([date(2024, 2, 29), date(2025, 1, 31), date(2026, 3, 1)]):
        new = [(1000 * i + k, name, "P1", last - timedelta(days=int(RANDOM.integers(0, 30))),
                int(RANDOM.integers(-2, 9)), None if k % 9 == 0 else Decimal("1.55"),
                Decimal(k % 4 * 5), "GBP")
               for k, name in enumerate(names * 3) if k % 41 == 0 or k % 41 % 3 != i]
        new.append((None, names[1], "P1", last, 2, Decimal("99999999.99"), Decimal(0), "GBP"))
        seen += new
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.table_stream(spark, folder, spark.createDataFrame(seen, schema).schema, 1)
        with rolling._rocksdb(spark):
            jobs.finish(jobs.publish_updates(
                rolling.rolling_sums(stream, "35 days", shares=3), out, state), 120)
            held = spark.read.format("statestore").option("stateVarName", "share").load(state)
            assert 1 < held.count() <= 4
        day = max(r[3] for r in seen) - timedelta(days=35)
        window = spark.createDataFrame(seen, schema).where(
            F.col("order_date") > F.add_months(F.lit(day), -12))
        revenue = F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100)
        want = window.groupBy("customer_id").agg(
            F.count("order_id").alias("r12_orders"),
            F.sum(F.coalesce(revenue, F.lit(0))).cast("decimal(38,8)").alias("r12_revenue"))
        same(want, rolling.current_rolling(spark.read.parquet(out)))


def test_rolling_days_are_packed_by_share(monkeypatch):
    """Rows reach the stateful processor one by one, so there is one for a share and day, and the
    lines of a customer on it are summed."""
    money = [Decimal("-3.00000001"), Decimal("12345678901234567890.5"), Decimal(0)]
    rows = [(k % 4, k % 5, k % 3, 1, k % 2, money[k % 3]) for k in range(240)]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.decimal128(38, 8)]
    table = pa.table({name: pa.array(values, kind) for name, values, kind in zip(
        ("share", "customer_id", "day", "lines", "orders", "revenue"), zip(*rows), kinds)})
    for at_once, packs in ((1000, 1), (120, 2)):
        monkeypatch.setattr(rolling, "PACKED_ROWS", at_once)
        found = pa.Table.from_batches(rolling._packed(iter(table.to_batches(max_chunksize=40))))
        assert len(found) == packs * 12
        parts = found.to_pandas()
        back = {}
        for share, own in parts.groupby("share"):
            for r in rolling._unpacked(own, False).to_pylist():
                was = back.get((share, r["customer"], r["day"]), (0, 0, Decimal(0)))
                back[share, r["customer"], r["day"]] = (
                    was[0] + r["lines"], was[1] + r["orders"], was[2] + r["revenue"])
        assert back == {k: (4, 4 * (k[0] % 2), 4 * money[k[2]]) for k in {r[:3] for r in rows}}

import json
import os

import pytest
from frames import LINE, line, lines
from pyspark.sql import functions as F

from tradegrain.plans import medallion
from tradegrain.sources.schemas import ORDERS
from tradegrain.streaming import jobs


@pytest.fixture
def feed(spark, tmp_path):
    """Adds a file of lines to a folder, as arriving JSON."""
    folder = tmp_path / "in"
    folder.mkdir()

    def add(*entries):
        text = [json.dumps({f: (None if v is None else str(v) if not isinstance(v, int) else v)
                            for f, v in zip(ORDERS.fieldNames(), e)}) for e in entries]
        number = len(list(folder.iterdir()))
        file = folder / f"{number:03d}.json"
        file.write_text("\n".join(text) + "\n")
        os.utime(file, (1e9 + number, 1e9 + number))       # files arrive in this order
        return str(folder)
    return add


def strings(schema):
    """Raw fields as text, since the feed writes them so."""
    out = type(schema)()
    for f in schema:
        out = out.add(f.name, "integer" if f.dataType.simpleString() == "int" else "string")
    return out


def stream(spark, folder, files=1):
    raw = jobs.bronze_stream(spark, folder, strings(ORDERS), files)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ORDERS])


def test_only_new_files_are_read(spark, rows, feed, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(folder):
        raw = jobs.bronze_stream(spark, folder, strings(ORDERS))
        jobs.finish(jobs.append_to(raw, out, state), 120)
        return spark.read.parquet(out).count()

    assert run(feed(line(1, 1, "A"), line(2, 1, "A"))) == 2
    assert run(feed(line(3, 1, "A"))) == 3
    assert run(str(tmp_path / "in")) == 3


@pytest.mark.parametrize("spread", [0, 4])
def test_deduplication_across_batches(spark, rows, feed, tmp_path, spread):
    feed(line(1, 1, "A"), line(1, 1, "A"), line(2, 1, "A"))
    folder = feed(line(2, 1, "A"), line(3, 1, "A"), line(1, 1, "A"))
    once = jobs.deduplicated(
        stream(spark, folder).withColumn("at", F.col("order_date").cast("timestamp")),
        ["order_id"], "at", "10 days", spread)
    out = str(tmp_path / "out")
    jobs.finish(jobs.append_to(once, out, str(tmp_path / "state")), 180)
    assert rows(spark.read.parquet(out), "order_id") == [(1,), (2,), (3,)]


def test_streamed_silver_equals_batch(spark, rows, feed, tmp_path):
    entries = [line(i % 7, i % 3 or None, "A", quantity=i % 5) for i in range(40)]
    feed(*entries[:20])
    folder = feed(*entries[20:])
    entity = medallion.entities()["orders"]
    valid, bad = str(tmp_path / "valid"), str(tmp_path / "bad")
    jobs.finish(jobs.silver_stream(stream(spark, folder), entity, valid, bad,
                                   str(tmp_path / "state")), 120)
    batch = medallion.silver(spark.createDataFrame(entries, LINE), entity)
    assert rows(jobs.current_rows(spark, valid, entity)) == rows(batch.table)
    assert rows(spark.read.parquet(bad).drop("batch")) == rows(batch.quarantine)


def test_late_lines_are_left_out_of_closed_days(spark, rows, feed, tmp_path):
    feed(line(1, 1, "A", "2026-01-01"), line(2, 1, "A", "2026-01-10"))
    feed(line(3, 1, "A", "2026-01-20"))
    folder = feed(line(4, 1, "A", "2026-01-02"), line(5, 1, "A", "2026-01-25"))
    out = str(tmp_path / "out")
    jobs.finish(jobs.append_to(jobs.daily_revenue(stream(spark, folder), "3 days"), out,
                               str(tmp_path / "state")), 120)
    days = [str(r[0]) for r in rows(spark.read.parquet(out), "order_date")]
    assert days == ["2026-01-01", "2026-01-10", "2026-01-20"]


def test_monthly_equals_batch(spark, rows, feed, tmp_path):
    entries = [line(i, 1, "A", f"2026-0{i % 4 + 1}-15", i) for i in range(1, 30)]
    feed(*entries[:9])
    feed(*entries[9:15])
    folder = feed(*entries[15:])
    out = str(tmp_path / "out")
    jobs.finish(jobs.publish_updates(jobs.monthly_revenue(stream(spark, folder)), out,
                                     str(tmp_path / "state")), 120)
    assert rows(jobs.latest_updates(spark, out, "order_month")) == rows(
        jobs.monthly_revenue(lines(spark, *entries)))


def test_upsert(spark, rows, feed, tmp_path):
    feed(line(1, 1, "A"), line(2, 2, "A"), line(8, 1, "B"))
    folder = feed(line(5, 2, "C"), line(4, 2, "D"), line(6, 3, "E"), line(7, 1, "late"))
    history = str(tmp_path / "history")
    changed = stream(spark, folder).select("customer_id", "order_id", "product_id", F.when(
        F.col("product_id") == "E", "DELETE").otherwise("UPDATE").alias("op"))
    jobs.finish(jobs.upsert_stream(changed, "customer_id", "order_id", history,
                                   str(tmp_path / "state")), 120)

    def copy(version=None):
        return rows(jobs.serving_copy(spark, history, "customer_id", "order_id", version),
                    "customer_id", "product_id")

    assert copy(0) == [(1, "B"), (2, "A")]
    assert copy() == [(1, "B"), (2, "C")]       # not the late change of 1, nor the deleted 3


def test_upsert_over_folded_batches(spark, rows, feed, tmp_path):
    batches = [(line(10, 1, "A"), line(20, 2, "A")), (line(30, 3, "E"), line(31, 1, "B")),
               (line(11, 1, "late"), line(21, 2, "B")), (line(29, 3, "late"),),
               (line(40, 4, "A"),), (line(50, 2, "E"),)]
    for batch in batches:
        folder = feed(*batch)
    history = str(tmp_path / "history")
    changed = stream(spark, folder, 1).select("customer_id", "order_id", "product_id", F.when(
        F.col("product_id") == "E", "DELETE").otherwise("UPDATE").alias("op"))
    jobs.finish(jobs.upsert_stream(changed, "customer_id", "order_id", history,
                                   str(tmp_path / "state"), every=2), 120)

    def copy(version=None):
        return rows(jobs.serving_copy(spark, history, "customer_id", "order_id", version, 2),
                    "customer_id", "product_id")

    assert copy(1) == [(1, "B"), (2, "A")]
    assert copy(2) == copy(3) == [(1, "B"), (2, "B")]
    assert copy() == [(1, "B"), (4, "A")]


@pytest.mark.parametrize("every", [1, 2])
def test_folded_outputs_equal_batch(spark, rows, feed, tmp_path, every):
    entries = [line(i % 9, i % 4 or None, "A", f"2026-0{i % 3 + 1}-15", quantity=i % 5 or 1)
               for i in range(50)]
    for start in range(0, 50, 10):
        folder = feed(*entries[start:start + 10])
    entity = medallion.entities()["orders"]
    valid, bad, out = (str(tmp_path / n) for n in ("valid", "bad", "out"))
    jobs.finish(jobs.silver_stream(stream(spark, folder), entity, valid, bad,
                                   str(tmp_path / "state"), every=every), 180)
    batch = medallion.silver(spark.createDataFrame(entries, LINE), entity)
    assert rows(jobs.current_rows(spark, valid, entity, every)) == rows(batch.table)
    jobs.finish(jobs.publish_updates(jobs.monthly_revenue(stream(spark, folder)), out,
                                     str(tmp_path / "state2"), "order_month", every), 180)
    found = jobs.latest_updates(spark, out, "order_month", every)
    assert rows(found) == rows(jobs.monthly_revenue(lines(spark, *entries)))
    assert rows(found) == rows(jobs.latest_updates(spark, out, "order_month"))


def test_table_stream_reads_a_folder_or_a_file(spark, rows, tmp_path):
    table = tmp_path / "t.parquet"
    spark.range(4).coalesce(1).write.parquet(str(table))
    file = next(table.glob("*.parquet"))
    for number, path in enumerate((table, file)):
        out = str(tmp_path / f"out{number}")
        read = jobs.table_stream(spark, str(path), spark.range(1).schema)
        jobs.finish(jobs.append_to(read, out, str(tmp_path / f"state{number}")), 120)
        assert rows(spark.read.parquet(out)) == [(0,), (1,), (2,), (3,)]



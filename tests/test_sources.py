from datetime import date
from decimal import Decimal

import pytest
from frames import customers, products
from pyspark.sql.types import StructType

from tradegrain import session
from tradegrain.plans.medallion import bronze, table_counts
from tradegrain.sources import (
    CUSTOMERS,
    hinted_schema,
    land,
    landed_report,
    read_json,
    read_table,
    replace_files,
    replace_table,
)
from tradegrain.sources.tables import recover_table


def write_lines(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text(
        "\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_hints_override_inference(spark, tmp_path):
    folder = write_lines(tmp_path / "in", '{"id": 1, "price": 8.4, "day": "2024-02-29", "n": "x"}',
                         '{"id": null, "price": 1.239, "day": null, "n": "Caf\\u00e9"}')
    write_lines(tmp_path / "in", '{"id": 3, "price": 2, "day": "2024-01-01", "n": "y"}')
    found = read_json(spark, folder, hints="id INT, price DECIMAL(10,2), day DATE, extra STRING")
    assert dict(found.dtypes) == {"id": "int", "price": "decimal(10,2)", "day": "date",
                                  "n": "string", "extra": "string"}
    by_name = {r["n"]: r for r in found.collect()}
    assert by_name["x"].price == Decimal("8.40") and by_name["x"].day == date(2024, 2, 29)
    assert by_name["Café"].price == Decimal("1.24") and by_name["Café"].id is None
    assert len(by_name) == 3


def test_hinted_schema_keeps_order():
    seen = StructType().add("a", "long").add("b", "double")
    assert hinted_schema(seen, StructType().add("b", "date")).simpleString() == \
        "struct<a:bigint,b:date>"


def test_malformed_lines_are_kept(spark, tmp_path):
    folder = write_lines(tmp_path / "in", '{"customer_id": 1, "customer_name": "A"}',
                         '{"customer_id": 2, "customer_name": "B"', 'not json',
                         '{"customer_id": "three", "customer_name": "C"}')
    found = bronze(spark, folder, CUSTOMERS)
    rows = found.collect()
    assert len(rows) == 4
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"]) == [
        'not json', '{"customer_id": "three", "customer_name": "C"}',
        '{"customer_id": 2, "customer_name": "B"']
    assert {r["customer_name"] for r in rows} >= {"A", "C"}
    assert all(r["_source_file"].endswith(".json") and r["_ingested_at"] for r in rows)


def test_landing(spark, rows, tmp_path):
    root = str(tmp_path)
    land({"customers": customers(spark, 1, 2), "products": products(spark, "A")}, root, "raw")
    land({"customers": customers(spark, 1)}, root, "raw")          # again: replaces
    found = landed_report(spark, root, ["raw", "clean"], ["customers", "products"])
    report = {(r["flavour"], r["entity"]): r for r in found.collect()}
    assert [report[k]["rows"] for k in (("raw", "customers"), ("raw", "products"),
                                        ("clean", "customers"))] == [1, 1, 0]
    assert report[("raw", "products")]["bytes"] > 50
    assert report[("clean", "products")]["files"] == 0


def test_round_trip_through_json(spark, same, tmp_path):
    what = products(spark, "A", ("B", "Chilled", "1.05"))
    land({"products": what}, str(tmp_path), "clean")
    same(what, read_json(spark, f"{tmp_path}/clean/products", what.schema))


def test_replace_files(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    replace_files(spark.range(5).toDF("x"), path)
    assert rows(replace_files(spark.range(2).toDF("x"), path)) == [(0,), (1,)]
    assert rows(read_table(spark, path)) == [(0,), (1,)]


def test_replace_table_from_itself_or_not_at_all(spark, rows):
    name = "tradegrain_beside_test"
    replace_table(spark.range(3).toDF("x"), name)
    replace_table(spark.table(name).selectExpr("x + 1 as x", "'y' as y"), name)
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.table(name).selectExpr("raise_error('broken') as x"), name)
    assert rows(spark.table(name)) == [(1, "y"), (2, "y"), (3, "y")]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("schema", ["", "default."])
def test_rebuild_cut_off_between_renamings(spark, rows, schema):
    name = f"{schema}tradegrain_cut_off_test"
    assert not recover_table(spark, name)
    replace_table(spark.range(2).toDF("x"), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_old_a")
    spark.range(5).toDF("x").write.saveAsTable(f"{name}_new_a")
    assert recover_table(spark, name) and not recover_table(spark, name)
    assert spark.table(name).count() == 5
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_old_b")        # its new rows are gone
    assert recover_table(spark, name)
    assert spark.table(name).count() == 5
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_old_c")
    spark.range(4).toDF("x").write.saveAsTable(f"{name}_new_c")
    replace_table(spark.range(1).toDF("x"), name)
    assert rows(spark.table(name)) == [(0,)]
    assert [t.name for t in spark.catalog.listTables()
            if t.name.startswith("tradegrain_cut_off")] == ["tradegrain_cut_off_test"]
    spark.sql(f"DROP TABLE {name}")


def test_replace_table(spark, rows):
    for n in (3, 2):
        replace_table(spark.range(n).toDF("x"), "tradegrain_replace_test", "it's a \\ test")
    assert rows(read_table(spark, "tradegrain_replace_test")) == [(0,), (1,)]
    about = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED tradegrain_replace_test").collect()}
    assert about["Comment"] == "it's a \\ test"
    spark.sql("DROP TABLE tradegrain_replace_test")


def test_table_counts(spark):
    found = table_counts({"b": spark.range(3), "a": spark.range(0)})
    assert [tuple(r) for r in found.collect()] == [("a", 0), ("b", 3)]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """A session without spark.checkpoint.dir."""
    def __init__(self, master):
        self.conf = type("Conf", (), {"get": lambda self, key, default: default})()
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("yarn"))


def test_local_session_gets_a_folder():
    local = Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.folder

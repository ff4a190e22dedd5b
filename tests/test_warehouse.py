from decimal import Decimal

from frames import customers, line, lines, products

from tradegrain.plans import warehouse
from tradegrain.plans.sales_metrics import margin_by_segment
from tradegrain.sources import land


def test_from_files_to_tables(spark, tmp_path):
    def deliver(*sold):
        land({"customers": customers(spark, (1, "x"), (2, "y")), "orders": lines(spark, *sold),
              "products": products(spark, "A", "B")}, str(tmp_path), "clean")
        return warehouse.build(spark, f"{tmp_path}/clean", "tradegrain_test")

    deliver(line(1, 1, "A"))
    built = deliver(line(1, 1, "A", quantity=3), line(2, 2, "B", discount="12.5"))   # again
    assert [tuple(r) for r in warehouse.row_counts(built).collect()] == [
        ("customers", 2), ("gold_customer_scorecard", 2), ("orders", 2), ("products", 2)]
    card = built.tables["gold_customer_scorecard"].orderBy("customer_id").collect()
    assert len(card[0]) == 36 and card[0].lifetime_revenue == Decimal("30.00")
    assert card[1].lifetime_revenue == Decimal("8.75") and card[1].cross_sell_product_id == "A"
    assert [r.Segment for r in margin_by_segment(built.metrics).collect()] == ["x", "y"]
    assert dict(built.tables["orders"].dtypes)["unit_price"] == "decimal(10,2)"
    spark.sql("DROP DATABASE tradegrain_test CASCADE")

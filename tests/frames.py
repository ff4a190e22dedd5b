"""Small hand-made tables."""

from datetime import date
from decimal import Decimal

LINE = ("order_id int, customer_id int, product_id string, order_date date, quantity int,"
        " unit_price decimal(10,2), discount_pct decimal(5,2), currency string")
CUSTOMER = ("customer_id int, customer_name string, region string, segment string,"
            " account_manager string, join_date date")
PRODUCT = ("product_id string, product_name string, category string,"
           " list_price decimal(10,2), cost decimal(10,2), launch_date date")


def customers(spark, *entries):
    """Entries are (id, segment) or an id."""
    full = []
    for entry in entries:
        number, segment = entry if isinstance(entry, tuple) else (entry, "Regional")
        full.append((number, f"Outlet {number}", "Wales", segment, "Manager", date(2024, 1, 1)))
    return spark.createDataFrame(full, CUSTOMER)


def products(spark, *entries):
    """Entries are (id, category, cost) or an id."""
    full = []
    for entry in entries:
        number, category, cost = (entry if isinstance(entry, tuple)
                                  else (entry, "Frozen", "6.00"))
        full.append((number, f"Product {number}", category, Decimal("10.00"), Decimal(cost),
                     date(2023, 1, 1)))
    return spark.createDataFrame(full, PRODUCT)


def line(number, customer, product, day="2026-05-31", quantity=1, price="10.00", discount="0"):
    return (number, customer, product, date.fromisoformat(day), quantity,
            None if price is None else Decimal(price), Decimal(discount), "GBP")


def lines(spark, *entries):
    return spark.createDataFrame(list(entries), LINE)

"""The three entities: customers, products and order lines."""

from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructType

CUSTOMERS = (StructType()
             .add("customer_id", IntegerType())
             .add("customer_name", StringType())
             .add("region", StringType())
             .add("segment", StringType())
             .add("account_manager", StringType())
             .add("join_date", DateType()))

PRODUCTS = (StructType()
            .add("product_id", StringType())
            .add("product_name", StringType())
            .add("category", StringType())
            .add("list_price", DecimalType(10, 2))
            .add("cost", DecimalType(10, 2))
            .add("launch_date", DateType()))

# One row per order line; order_id is the key of the line.
ORDERS = (StructType()
          .add("order_id", IntegerType())
          .add("customer_id", IntegerType())
          .add("product_id", StringType())
          .add("order_date", DateType())
          .add("quantity", IntegerType())
          .add("unit_price", DecimalType(10, 2))
          .add("discount_pct", DecimalType(5, 2))
          .add("currency", StringType()))

ENTITIES = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS}

# Fixed values of the business domain, which the quality rules check against.
REGIONS = (
    "London", "South East", "South West", "East of England", "Midlands", "North West",
    "North East", "Yorkshire", "Scotland", "Wales", "Northern Ireland",
)
SEGMENTS = ("National Group", "Regional", "Independent")
CATEGORIES = ("Beverages", "Ambient", "Chilled", "Frozen", "Alcohol")
CURRENCY = "GBP"
DISCOUNTS = (0, 5, 10, 15, 20)

"""Gold kept current: changed lines are carried through the grain to the customers they touch.

The stock holds the sums of every customer and product as numbers that add and subtract. A change
set of lines (`op` INSERT or DELETE; a correction is both) becomes signed sums per pair, and so do
the lines that enter or leave the rolling window when its date moves. Only the stock of these pairs
is joined to them. Earliest and latest dates cannot be subtracted from: where a deleted line held
one, the pair's remaining lines are read for it, and no others. The customers of changed pairs are
summed anew from their own stock.

Lines without a customer or product reach no card and are left out. A line that is deleted must
carry the values that it was inserted with.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.functions import line_revenue, rolling_start
from tradegrain.operators.changes import OP, apply_changes
from tradegrain.operators.grain import customer_rollup
from tradegrain.session import BROADCAST_ROWS, settle

PAIR = ["customer_id", "product_id"]
COUNTS = ("lines", "orders", "priced", "counted", "units", "revenue", "costed_units")
DATES = ("first_order_date", "last_order_date")
SUMS = (*COUNTS, *(f"r12_{c}" for c in COUNTS))


class Refreshed(NamedTuple):
    """The stock and the gold after a change, and what changed in each (with `op`)."""
    stock: DataFrame
    gold: DataFrame
    stock_changes: DataFrame
    gold_changes: DataFrame


def _numbers(lines: DataFrame, recent: Column, sign: Column | None = None) -> DataFrame:
    """Each line as numbers that add up; `sign` turns them, and NULLs are zeros beside counts."""
    revenue, quantity = line_revenue(), F.col("quantity")
    sign = F.lit(1) if sign is None else sign

    def whole(x: Column) -> Column:
        return (sign * x).cast("long")

    values = {
        "lines": whole(F.lit(1)),
        "orders": whole(F.col("order_id").isNotNull().cast("int")),
        "priced": whole(revenue.isNotNull().cast("int")),
        "counted": whole(quantity.isNotNull().cast("int")),
        "units": whole(F.coalesce(quantity, F.lit(0))),
        "revenue": F.when(sign < 0, -revenue).otherwise(revenue),
        "costed_units": whole(F.when(revenue.isNotNull(), quantity).otherwise(0)),
    }
    known = lines.where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    return known.select(
        *PAIR, "order_date", sign.alias("_sign"),
        *[v.alias(c) for c, v in values.items()],
        *[F.when(recent, v).alias(f"r12_{c}") for c, v in values.items()])


def _summed(numbers: DataFrame, *more: Column) -> DataFrame:
    return numbers.groupBy(*PAIR).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS], *more)


def build_stock(lines: DataFrame, as_of: date | str, months: int = 12) -> DataFrame:
    """The stock of all lines, its rolling sums as of the given date."""
    recent = F.col("order_date") > rolling_start(F.lit(as_of).cast("date"), months)
    return _summed(_numbers(lines, recent), F.min("order_date").alias(DATES[0]),
                   F.max("order_date").alias(DATES[1]))


def grain_of(stock: DataFrame, products: DataFrame) -> DataFrame:
    """The stock as the customer x product grain that the card is built from."""
    def amount(name: str, count: str) -> Column:
        return F.when(F.col(count) != 0, F.col(name))

    def profit(prefix: str) -> Column:
        return amount(f"{prefix}revenue", f"{prefix}priced") - F.col(f"{prefix}costed_units") \
            * F.col("cost")

    return (stock.join(products.select("product_id", "category", "cost"), "product_id")
            .select(*PAIR, "category", "orders", "priced", amount("units", "counted").alias("units"),
                    amount("revenue", "priced").alias("revenue"), profit("").alias("profit"),
                    *DATES, "r12_lines", "r12_orders",
                    amount("r12_revenue", "r12_priced").alias("r12_revenue"),
                    profit("r12_").alias("r12_profit")))


def signed_sums(changes: DataFrame, before: DataFrame, was: date | str, as_of: date | str,
                months: int = 12) -> DataFrame:
    """One row per touched pair: what to add to its sums, and the dates put in and taken out.

    Of the lines `before`, only those are read whose place in the window differs between the two
    dates; that range of dates reaches the scan as a filter.
    """
    start, old = (rolling_start(F.lit(d).cast("date"), months) for d in (as_of, was))
    day = F.col("order_date")
    sign = F.when(F.col(OP) == "DELETE", -1).otherwise(1)
    changed = _numbers(changes, day > start, sign)
    moved = before.where((day > F.least(start, old)) & (day <= F.greatest(start, old)))
    window = _numbers(moved, F.lit(True), F.when(day > start, 1).otherwise(-1))
    # A line that only enters or leaves the window moves the rolling sums alone.
    window = window.withColumns({c: F.lit(0).cast(window.schema[c].dataType) for c in COUNTS})
    put, out = F.col("_sign") > 0, F.col("_sign") < 0
    touched = changed.withColumn("_moved", F.lit(False)).unionByName(
        window.withColumn("_moved", F.lit(True)))
    put, out = (c & ~F.col("_moved") for c in (put, out))
    return _summed(touched, F.min(F.when(put, day)).alias("put_first"),
                   F.max(F.when(put, day)).alias("put_last"),
                   F.min(F.when(out, day)).alias("out_first"),
                   F.max(F.when(out, day)).alias("out_last"))


def refresh(stock: DataFrame, gold: DataFrame, products: DataFrame, before: DataFrame,
            after: DataFrame, changes: DataFrame, was: date | str, as_of: date | str,
            months: int = 12) -> Refreshed:
    """Carry a change set through the stock and the gold (`customer_rollup` of the stock's grain).

    `before` and `after` are the lines without and with the changes; the first is read where the
    window moves over it, the second for pairs that lost a date. Sides are broadcast only once
    their rows were counted against the library's bound.
    """
    delta = settle(signed_sums(changes, before, was, as_of, months), "delta")
    few = delta.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # With many changed pairs the stock meets them once: what stays is written beside what changes.
    old = stock.join(F.broadcast(delta.select(*PAIR)), PAIR, "left_semi") if few else stock
    held = old.select(*PAIR, *[F.col(c).alias(f"_{c}") for c in (*SUMS, *DATES)])
    joined = delta.withColumn("_changed", F.lit(True)).join(held, PAIR, "left" if few else "full")
    sums = {c: F.coalesce(F.col(f"_{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0)) for c in SUMS}
    lost = ((F.col("out_first") <= F.coalesce(f"_{DATES[0]}", "out_first"))
            | (F.col("out_last") >= F.coalesce(f"_{DATES[1]}", "out_last")))
    met = settle(joined.select(
        *PAIR, *[sums[c].cast(stock.schema[c].dataType).alias(c) for c in SUMS],
        F.least(f"_{DATES[0]}", "put_first").alias(DATES[0]),
        F.greatest(f"_{DATES[1]}", "put_last").alias(DATES[1]),
        F.coalesce(lost, F.lit(False)).alias("_lost"),
        F.col("_lines").isNotNull().alias("_known"), "_changed"), "touched")
    new = met.where("_changed")

    orphaned = new.where("_lost and lines > 0").select(*PAIR)
    dates = (after.join(F.broadcast(orphaned) if few else orphaned, PAIR, "left_semi")
             .groupBy(*PAIR).agg(F.min("order_date").alias("_first"),
                                 F.max("order_date").alias("_last")))
    op = (F.when(F.col("lines") <= 0, "DELETE").when(F.col("_known"), "UPDATE")
          .otherwise("INSERT"))
    stock_changes = settle(
        new.join(dates, PAIR, "left")
        .select(*PAIR, *SUMS, F.when(F.col("_lost"), F.col("_first")).otherwise(F.col(DATES[0]))
                .alias(DATES[0]),
                F.when(F.col("_lost"), F.col("_last")).otherwise(F.col(DATES[1])).alias(DATES[1]),
                op.alias(OP))
        .where(~((F.col(OP) == "DELETE") & ~F.col("_known"))), "stock_changes")
    stays = (stock.join(F.broadcast(stock_changes.select(*PAIR)), PAIR, "left_anti") if few
             else met.where("_changed is null").select(*stock.columns))
    fresh = stays.unionByName(
        stock_changes.where(F.col(OP) != "DELETE").select(*stock.columns))

    # With many, customers are told apart once they are summed, and not in their whole stock.
    customers = stock_changes.select("customer_id").distinct()
    own = fresh.join(F.broadcast(customers), "customer_id", "left_semi") if few else fresh
    rollup = customer_rollup(grain_of(own, products))
    gold_changes = settle(
        customers.withColumn("_touched", F.lit(True)).join(
            rollup.withColumn("_there", F.lit(True)), "customer_id", "left")
        .select(*gold.columns, F.when(F.col("_there"), "UPDATE").otherwise("DELETE").alias(OP)),
        "gold_changes")
    return Refreshed(fresh, apply_changes(gold, gold_changes, "customer_id"), stock_changes,
                     gold_changes)

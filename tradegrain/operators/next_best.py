"""Next-best product: the most bought product of a customer's segment that they lack.

Products rank by falling number of buyers in the segment, then by product id. A customer's
recommendation is then the first rank missing among the ranks of what they bought, so it can
be found from their purchases alone: no table of customers x products is built. A rank r + 1
is open if r is held and r + 1 is not, which takes one shuffle by (customer, rank) and spreads
the purchases of a customer over all tasks.

Most customers lack one of the segment's top few products, so a short ranking settles them
with a small, usually broadcast, list. Who holds all of it goes on to the whole ranking of
the segment, and who holds all of that (or whose segment has no buyers) to the products by id,
where customers without a segment go at once.

Many customers share a first missing rank (all who own nothing share rank 1). The distinct ranks
that are needed find their products first; those answers are broadcast after their rows were
counted, and beyond the bound both sides are spread over SPREAD shares of a rank.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.operators.numbering import number_rows
from tradegrain.session import BROADCAST_ROWS, settle

HEAD = 256
SPREAD = 64


def next_best(customers: DataFrame, products: DataFrame, bought: DataFrame,
              head: int = HEAD) -> DataFrame:
    """One row per customer; the product is NULL for who bought everything.

    `customers` has customer_id and segment, `products` product_id and product_name, and
    `bought` distinct customer_id, product_id pairs of known products. `bought` is read up to
    four times and should be a written table; only these two columns of it are shuffled.
    """
    everyone = customers.select("customer_id", "segment")
    todo = everyone.filter(F.col("segment").isNotNull())
    pairs = bought.select("customer_id", "product_id")
    popularity = (pairs.join(todo, "customer_id").groupBy("segment", "product_id").agg(F.count(F.lit(1)).alias("buyers"))
                  .join(products.select("product_id", "product_name"), "product_id"))

    rankings: list[Callable[[], DataFrame]] = [
        lambda: _top_of_segment(popularity, head),
        lambda: _whole_segment(popularity),
    ]
    done: list[DataFrame] = []
    for make in rankings:
        found = settle(_first_missing(todo, pairs.join(todo, "customer_id"), make()),
                       "next-best")
        done.append(found.filter(F.col("product_id").isNotNull()))
        todo = found.filter(F.col("product_id").isNull()).select("customer_id", "segment")
        if todo.isEmpty():
            break

    todo = todo.unionByName(everyone.filter(F.col("segment").isNull()))
    if not todo.isEmpty():
        done.append(_first_missing(todo, pairs.join(todo, "customer_id"), _by_id(products)))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select("customer_id", F.col("product_id").alias("cross_sell_product_id"),
                         F.col("product_name").alias("cross_sell_product_name"))


def _top_of_segment(popularity: DataFrame, head: int) -> DataFrame:
    """Ranks 1..head; each task keeps at most `head` rows per segment before the shuffle."""
    order = Window.partitionBy("segment").orderBy(F.desc("buyers"), "product_id")
    return settle(popularity.withColumn("rank", F.row_number().over(order).cast("long"))
                  .filter(F.col("rank") <= head)
                  .select("segment", "product_id", "product_name", "rank"), "head")


def _whole_segment(popularity: DataFrame) -> DataFrame:
    order = popularity.withColumn("_fewer", -F.col("buyers"))
    return (number_rows(order, ["segment"], ["_fewer", "product_id"])
            .select("segment", "product_id", "product_name",
                    (F.col("position") + 1).alias("rank")))


def _by_id(products: DataFrame) -> DataFrame:
    return (number_rows(products.select("product_id", "product_name"), [], ["product_id"])
            .select("product_id", "product_name", (F.col("position") + 1).alias("rank")))


def _first_missing(customers: DataFrame, held: DataFrame, ranking: DataFrame) -> DataFrame:
    """The product at the lowest rank a customer does not hold; NULL beyond the ranking."""
    keys = [c for c in ("segment",) if c in ranking.columns]
    ranks = (held.join(ranking.select(*keys, "product_id", "rank"), [*keys, "product_id"])
             .select("customer_id", "rank"))
    marks = ranks.select("customer_id", F.explode(F.array(
        F.struct(F.col("rank").alias("at"), F.lit(True).alias("holds")),
        F.struct((F.col("rank") + 1).alias("at"), F.lit(False).alias("holds")))).alias("mark"))
    missing = (marks.groupBy("customer_id", "mark.at")
               .agg(F.max("mark.holds").alias("holds"))
               .groupBy("customer_id")
               .agg(F.min(F.when(~F.col("holds"), F.col("at"))).alias("gap"),
                    F.max(F.col("holds") & (F.col("at") == 1)).alias("holds_first")))
    gaps = settle(customers.join(missing, "customer_id", "left").select(
        "customer_id", "segment",
        F.when(F.col("holds_first"), F.col("gap")).otherwise(1).cast("long").alias("rank")), "gaps")
    needed = gaps.select(*keys, "rank").distinct()
    answers = settle(needed.join(ranking, [*keys, "rank"])
                     .select(*keys, "rank", "product_id", "product_name"), "answers")
    if answers.count() <= BROADCAST_ROWS:
        named = gaps.join(F.broadcast(answers), [*keys, "rank"], "left")
    else:
        shares = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
        named = (gaps.withColumn("_share", F.pmod(F.xxhash64("customer_id"), F.lit(SPREAD)).cast("int"))
                 .join(answers.withColumn("_share", shares), [*keys, "rank", "_share"], "left"))
    return named.select("customer_id", "segment", "product_id", "product_name")

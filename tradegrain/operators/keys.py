"""Key checks: one row per key, repeated keys, unmatched foreign keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.session import BROADCAST_ROWS, settle


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the least by the `prefer` columns, then by all others in order.

    An aggregate rather than a numbered window, so that each task first reduces its own copies
    of a key to one; a key with a third of the rows then sends one row per task. Rows without a
    whole key are no copies of each other: all of them stay.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    payload = [*prefer, *rest] or list(keys)

    def least(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_kept"))
                .select(*[F.col(c) if c in keys else F.col(f"_kept.{c}") for c in df.columns]))

    return reduce_repeats(df, keys, least)


def reduce_repeats(df: DataFrame, keys: Sequence[str],
                   one_each: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`df` with `one_each`, which makes one row per key, applied to the rows of repeated keys.

    Least and greatest rows are found by sorting, before a shuffle and after. Most keys stand
    alone as a rule, so the keys are counted by themselves first, and rows of a key that stands
    alone stay in place, neither shuffled nor sorted. Up to BROADCAST_ROWS repeated keys are sent
    to the rows; if more repeat, `one_each` gets all rows that have a key. Rows without a whole
    key pass.
    """
    without = missing(keys)
    again = settle(repeated_keys(df.filter(~without), keys).select(*keys), "repeated")
    found = again.count()
    if not found:
        return df
    if found > BROADCAST_ROWS:
        alone, copies = df.filter(without), df.filter(~without)
    else:
        again = F.broadcast(again)
        alone, copies = (df.join(again, list(keys), how) for how in ("left_anti", "left_semi"))
    return alone.unionByName(one_each(copies)).select(*df.columns)


def missing(keys: Sequence[str]) -> Column:
    """Whether any of the key's columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows are beyond the first of their key."""
    return repeated_keys(df, keys).agg(
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))


def orphans(df: DataFrame, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a match, with their row counts.

    The values are counted before the join, so a frequent value meets the dimension once.
    """
    values = (df.filter(F.col(foreign_key).isNotNull())
              .groupBy(foreign_key).agg(F.count(F.lit(1)).alias("rows")))
    return values.join(dimension.select(F.col(key).alias(foreign_key)), foreign_key, "left_anti")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise unless `key` is filled and unique."""
    bad = (df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
           .filter((F.col("rows") > 1) | F.col(key).isNull()).take(1))
    if bad:
        raise ValueError(f"{key} must be unique and not NULL; found {bad[0].asDict()}")

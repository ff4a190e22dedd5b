"""NTILE and rounded PERCENT_RANK over whole tables or over a few giant groups.

Both give every row one of few levels, and the level never falls as the sort key rises. So a
row's level follows from the sort keys at which the level changes: n - 1 keys for NTILE(n),
at most 1000 for a percentile with one decimal, however many rows there are. Those keys are
found in one distributed sort of the narrow key columns (all scales together); the rows
themselves are then scored in place, by a binary search in a short array.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.operators.numbering import number_rows
from tradegrain.session import settle

MOST_DECIMALS = 3      # of a percentile, whose levels are one array in each group


@dataclass(frozen=True)
class Scale:
    """A score column `name` that rises with the numeric `key`.

    `level(position, size)` is the score of the row at a 0-based position in its group.
    With `ties_apart` rows of equal key are told apart by the tie column; otherwise they all
    get the level of the first of them.
    """
    name: str
    key: Column
    level: Callable[[Column, Column], Column]
    lowest: int | float
    max_levels: int
    type: str
    ties_apart: bool
    group: str | None = None
    nulls: Literal["first", "last"] = "first"


def ntile(name: str, key: Column, tiles: int, nulls: Literal["first", "last"] = "first",
          group: str | None = None) -> Scale:
    """NTILE(tiles) over the ascending key, whole or per group."""
    def level(position: Column, size: Column) -> Column:
        each = F.floor(size / tiles)
        larger = size % tiles                       # the first tiles hold one row more
        in_larger = larger * (each + 1)
        tile = F.when(position < in_larger, F.floor(position / (each + 1))).otherwise(
            larger + F.floor((position - in_larger) / F.greatest(each, F.lit(1))))
        return tile + 1
    return Scale(name, key, level, 1, tiles, "int", True, group, nulls)


def percentile(name: str, key: Column, group: str | None = None, decimals: int = 1) -> Scale:
    """ROUND(100 * PERCENT_RANK(), decimals) over the ascending key, whole or per group."""
    if not 0 <= decimals <= MOST_DECIMALS:
        raise ValueError(f"decimals must be 0 to {MOST_DECIMALS}")

    def level(position: Column, size: Column) -> Column:
        rank = F.when(size > 1, position / F.greatest(size - 1, F.lit(1))).otherwise(0.0)
        return F.round(F.lit(100) * rank, decimals)
    return Scale(name, key, level, 0.0, 100 * 10 ** decimals + 1, "double", False, group)


def add_scales(df: DataFrame, scales: Sequence[Scale], tie: str) -> DataFrame:
    """Add one column per scale. `tie` is a unique column; `df` should be a written table,
    since it is read once for the keys and once for the scores."""
    kinds = [df.select(scale.key).schema[0].dataType.simpleString() for scale in scales]
    levels = settle(_levels(df, scales, kinds, tie), "levels")
    scored, scores = df, {}
    for number, scale in enumerate(scales):
        key, mine = _sort_key(scale, kinds, number, tie), levels.filter(F.col("_scale") == number)
        array = f"_levels_{number}"
        if scale.group is None:
            # One row of bounded size: the same value for all rows, without a join.
            scored = scored.withColumn(array, mine.select("_levels").scalar())
        else:
            mine = mine.select(F.col("_group").alias(f"_group_{number}"),
                               F.col("_levels").alias(array))
            scored = scored.join(mine, F.equal_null(F.col(scale.group).cast("string"),
                                                    F.col(f"_group_{number}")), "left")
        found = _find(F.col(array), key, scale.max_levels)["level"]
        scores[scale.name] = F.coalesce(found, F.lit(scale.lowest).cast("double")).cast(scale.type)
    return scored.select(*df.columns, *[score.alias(name) for name, score in scores.items()])


def _levels(df: DataFrame, scales: Sequence[Scale], kinds: Sequence[str], tie: str) -> DataFrame:
    """Per scale and group, the sorted array of (last key of a level, level that follows)."""
    keys = F.array(*[
        F.struct(F.lit(i).alias("_scale"),
                 (F.col(s.group).cast("string") if s.group else F.lit(None).cast("string"))
                 .alias("_group"),
                 _null_rank(s).alias("_null"), *_keys(s, kinds, i))
        for i, s in enumerate(scales)])
    long = (df.select(F.explode(keys).alias("_k"), F.col(tie).alias("_tie"))
            .select("_k.*", "_tie"))
    names = [f"_key_{n}" for n in range(len(set(kinds)))]
    numbered = number_rows(long, ["_scale", "_group"], ["_null", *names, "_tie"])

    def level(position: Column) -> Column:
        size = F.col("group_size")
        return reduce(lambda rest, one: rest.when(F.col("_scale") == one[0],
                                                  one[1].level(position, size).cast("double")),
                      enumerate(scales), F)

    apart = F.lit(False)
    for i, s in enumerate(scales):
        apart = apart | ((F.col("_scale") == i) & F.lit(s.ties_apart))
    changes = (numbered
               .filter(F.col("position") + 1 < F.col("group_size"))
               .withColumn("_next", level(F.col("position") + 1))
               .filter(level(F.col("position")) != F.col("_next")))
    step = F.struct(
        F.struct("_null", *names, F.when(apart, F.col("_tie")).alias("_tie")).alias("key"),
        F.col("_next").alias("level"))
    return (changes.groupBy("_scale", "_group")
            .agg(F.array_sort(F.collect_list(step)).alias("_levels")))


def _null_rank(scale: Scale) -> Column:
    return F.when(scale.key.isNotNull(), 0).otherwise(-1 if scale.nulls == "first" else 1)


def _keys(scale: Scale, kinds: Sequence[str], number: int) -> list[Column]:
    """A column for each type of key, in its own type; only the scale's own one is filled."""
    return [(scale.key if kind == kinds[number] else F.lit(None)).cast(kind).alias(f"_key_{n}")
            for n, kind in enumerate(dict.fromkeys(kinds))]


def _sort_key(scale: Scale, kinds: Sequence[str], number: int, tie: str) -> Column:
    """The row's key as in the level array; a NULL tie sorts before all, so that rows of
    equal key come after no change that one of them made."""
    return F.struct(_null_rank(scale).alias("_null"), *_keys(scale, kinds, number),
                    F.when(F.lit(scale.ties_apart), F.col(tie)).alias("_tie"))


def _find(array: Column, key: Column, max_levels: int) -> Column:
    """The last element of the sorted array whose key is below the given one, else NULL."""
    steps = [1 << bit for bit in reversed(range(max_levels.bit_length()))]
    below = F.reduce(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda found, step: F.when(
            (found + step <= F.size(array)) & (F.get(array, found + step - 1)["key"] < key),
            found + step).otherwise(found))
    return F.get(array, below - 1)

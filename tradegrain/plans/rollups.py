"""Stored rollups of a metric view, and the routing of queries to the smallest that can answer.

Parts add up, and so do the bitmaps of distinct ids: a grouping stores sums and bitmaps per slice
and bucket of ids, and any coarser grouping follows from it without the lines. The lines are read
once, for the finest grouping. Which others are stored is chosen greedily by the rows they save
over all groupings that they can answer, each weighing the same unless `weights` says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.plans.distinct_counts import BITMAP, BUCKET
from tradegrain.plans.metric_view import Distinct, MetricView, Test, Total, UnknownName
from tradegrain.session import settle

MOST_DIMENSIONS = 10       # the lattice has a grouping for each subset of them
Grouping = frozenset[str]


@dataclass
class StoredView(MetricView):
    """A metric view that answers from `stored` groupings where they have all that is named, and
    from the lines otherwise. It shows the lines as of the time it was built."""
    stored: Mapping[Grouping, DataFrame] = field(default_factory=dict)
    sizes: Mapping[Grouping, int] = field(default_factory=dict)
    stored_measures: frozenset[str] = frozenset()

    def route(self, dimensions: Sequence[str], measures: Sequence[str]) -> Grouping | None:
        """The stored grouping with the fewest rows that has the dimensions; None: the lines."""
        if not self.stored_measures.issuperset(self._with_operands(measures)):
            return None
        covering = [g for g in self.stored if g.issuperset(dimensions)]
        return min(covering, key=lambda g: (self.sizes[g], sorted(g)), default=None)

    def query(self, dimensions: Sequence[str] = (), measures: Sequence[str] = (),
              where: Mapping[str, Test] | None = None,
              having: Mapping[str, Test] | None = None,
              order_by: Sequence[str | Column] = ()) -> DataFrame:
        where, having = where or {}, having or {}
        self._check(dimensions, measures, where, having)
        wanted = self._wanted(dimensions, measures, having, order_by)
        grouping = self.route([*dimensions, *where], wanted)
        if grouping is None:
            return super().query(dimensions, measures, where, having, order_by)
        rows = self.stored[grouping]
        for name, test in where.items():
            rows = rows.filter(test(F.col(f"`{name}`")))
        names = self._with_operands(wanted)
        counted = any(isinstance(self.measures[n], Distinct) for n in names)
        if counted:
            rows = _merge(rows, dimensions, [n for n in names if f"_t_{n}" in rows.columns], True)
        totals = (rows.groupBy(*[F.col(f"`{d}`") for d in dimensions])
                  .agg(*[self._merged(n) for n in names]))
        return self._finish(totals, list(dimensions), measures, wanted, having, order_by)

    def query_slices(self, slices: Sequence[Sequence[str]], measures: Sequence[str],
                     where: Mapping[str, Test] | None = None,
                     having: Mapping[str, Test] | None = None,
                     order_by: Sequence[str | Column] = ()) -> DataFrame:
        """Each slice from its own smallest grouping; all from the lines if one must be."""
        where, having = where or {}, having or {}
        names = list(dict.fromkeys(name for one in slices for name in one))
        self._check(names, measures, where, having)
        wanted = self._wanted(["slice", *names], measures, having, order_by)
        if not slices or any(self.route([*one, *where], wanted) is None for one in slices):
            return super().query_slices(slices, measures, where, having, order_by)
        parts = [self.query(list(dict.fromkeys(one)), wanted, where, having)
                 .withColumn("slice", F.lit(number)) for number, one in enumerate(slices)]
        found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if order_by:
            found = found.orderBy(*[F.col(f"`{o}`") if isinstance(o, str) else o
                                    for o in order_by])
        return found.select("slice", *[F.col(f"`{c}`") for c in (*names, *measures)])

    def _merged(self, name: str) -> Column:
        measure = self.measures[name]
        if isinstance(measure, Distinct):
            column = F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0))
        else:
            column = F.sum(f"`_t_{name}`")
            column = F.coalesce(column, F.lit(0)) if measure.counts else column
        return column.alias(f"_m_{name}")


def store(view: MetricView, dimensions: Sequence[str], measures: Sequence[str], keep: int = 4,
          weights: Mapping[Grouping, float] | None = None) -> StoredView:
    """Build and write the finest grouping of the dimensions and up to `keep` coarser ones.

    One column of whole numbers may be counted distinct; measures of others stay with the lines.
    """
    dimensions = list(dict.fromkeys(dimensions))
    view._check(dimensions, measures, {}, {})
    if len(dimensions) > MOST_DIMENSIONS:
        raise UnknownName(f"at most {MOST_DIMENSIONS} dimensions can be stored together")
    names = view._with_operands(measures)
    totals = [n for n in names if isinstance(view.measures[n], Total)]
    counted = _counted(view, names)
    rows = view._rows_to_sum(dimensions, [*totals, *counted], {})
    finest = settle(_finest(rows, dimensions, totals,
                            view.measures[counted[0]].column if counted else None), "rollup")

    top = frozenset(dimensions)
    sizes = _sizes(finest, dimensions)
    stored = {top: finest}
    for grouping in choose(sizes, top, keep, weights):
        parent = min((g for g in stored if g > grouping), key=lambda g: sizes[g])
        kept = [d for d in dimensions if d in grouping]
        stored[grouping] = settle(_merge(stored[parent], kept, totals, bool(counted)), "rollup")
    own = {f.name: getattr(view, f.name) for f in fields(MetricView)}
    return StoredView(**own, stored=stored, sizes={g: sizes[g] for g in stored},
                      stored_measures=frozenset([*totals, *counted]))


def choose(sizes: Mapping[Grouping, int], top: Grouping, keep: int,
           weights: Mapping[Grouping, float] | None = None) -> list[Grouping]:
    """Up to `keep` groupings beside `top`, each the one that then saves most rows to read.

    A grouping without rows to save is not chosen. Equal savings go to the smaller, then by name.
    """
    weights = weights or {}
    cost = dict.fromkeys(sizes, sizes[top])
    chosen: list[Grouping] = []
    while len(chosen) < keep:
        def saved(one: Grouping) -> float:
            return sum(weights.get(q, 1.0) * max(0, cost[q] - sizes[one])
                       for q in sizes if q <= one)
        best = max((g for g in sizes if g != top and g not in chosen),
                   key=lambda g: (saved(g), -sizes[g], sorted(g)), default=None)
        if best is None or saved(best) <= 0:
            break
        chosen.append(best)
        for q in sizes:
            if q <= best:
                cost[q] = min(cost[q], sizes[best])
    return sorted(chosen, key=lambda g: (-len(g), sorted(g)))


def _counted(view: MetricView, names: Sequence[str]) -> list[str]:
    """The distinct counts that bitmaps can hold: those of the first whole-number column."""
    types = dict(view.source.dtypes)
    found = [n for n in names if isinstance(view.measures[n], Distinct)
             and types.get(view.measures[n].column) in ("tinyint", "smallint", "int", "bigint")]
    return [n for n in found if view.measures[n].column == view.measures[found[0]].column]


def _finest(rows: DataFrame, dimensions: Sequence[str], totals: Sequence[str],
            ident: str | None) -> DataFrame:
    keys = [F.col(f"`{d}`") for d in dimensions]
    sums = [F.sum(f"`_t_{n}`").alias(f"_t_{n}") for n in totals]
    if ident is None:
        return rows.groupBy(*keys).agg(*sums)
    value = F.col(f"`_k_{ident}`")
    # Bitmaps of a few ids are far larger than the ids: so the sums of each id are brought to its
    # slice and bucket, at most 32,768 of them to one, and only whole bitmaps are made.
    of_ids = rows.groupBy(*keys, value).agg(*sums)
    apart = of_ids.withColumn(BUCKET, F.bitmap_bucket_number(value)).repartition(
        *keys, F.col(BUCKET))
    return (apart.groupBy(*keys, BUCKET)
            .agg(*sums, F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITMAP)))


def _merge(stored: DataFrame, dimensions: Sequence[str], totals: Sequence[str],
           counted: bool) -> DataFrame:
    """A stored grouping summed to some of its dimensions."""
    keys = [F.col(f"`{d}`") for d in dimensions] + ([F.col(BUCKET)] if counted else [])
    sums = [F.sum(f"`_t_{n}`").alias(f"_t_{n}") for n in totals]
    bits = [F.bitmap_or_agg(BITMAP).alias(BITMAP)] if counted else []
    return stored.groupBy(*keys).agg(*sums, *bits)


def _sizes(finest: DataFrame, dimensions: Sequence[str]) -> dict[Grouping, int]:
    """How many slices each subset of the dimensions has: one row per subset."""
    keys = [F.col(f"`{d}`") for d in dimensions]
    if not keys:
        return {frozenset(): 1}
    slices = (finest.select(*keys).distinct().cube(*keys)
              .agg(F.grouping_id().alias("_set")).groupBy("_set").count())
    found = {r["_set"]: r["count"] for r in slices.collect()}
    return {frozenset(subset): found.get(_left_out(dimensions, subset), 1 if not subset else 0)
            for n in range(len(dimensions) + 1) for subset in combinations(dimensions, n)}


def _left_out(dimensions: Sequence[str], subset: Sequence[str]) -> int:
    """Spark's number of a grouping set: a set bit for each column left out, the last lowest."""
    return sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in subset)

"""A semantic layer: named measures by named dimensions over a fact table and its dimensions.

A measure is written over *parts*, line amounts that add up. Because parts add up, the facts may
be summed to the key of a dimension table that is too large to broadcast before they meet it, where
that key is all that is still asked of them: the shuffle then carries one row per key and map task
instead of one per line, and a key that holds a third of the lines collapses before it is sent.
The joins are ordered so that this comes about, and facts that keep several keys, whose
combinations hardly repeat, go to each large table once, with the columns that are still needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradegrain.session import BROADCAST_ROWS


@dataclass(frozen=True)
class Join:
    """A many-to-one join from the fact's `fact_key` to the table's unique `key`."""
    table: DataFrame
    fact_key: str
    key: str


@dataclass(frozen=True)
class Dimension:
    """`column` of the joined table named `join`, or an expression over the fact if `join` is None."""
    column: str | Column
    join: str | None = None


@dataclass(frozen=True)
class Total:
    """Sum of `expr`, linear in `parts`; `attributes` are (join, column) pairs it multiplies by."""
    expr: Column
    parts: tuple[str, ...]
    attributes: tuple[tuple[str, str], ...] = ()
    counts: bool = False


@dataclass(frozen=True)
class Distinct:
    """Number of distinct values of a fact column. Does not add up across groups."""
    column: str


@dataclass(frozen=True)
class Ratio:
    """factor x one total / another, both taken at the grain of the query."""
    above: str
    below: str
    factor: int = 1


Measure = Total | Distinct | Ratio
Test = Callable[[Column], Column]


class UnknownName(ValueError):
    """A dimension or measure that the view does not define."""


class RepeatedKey(ValueError):
    """A joined table has several rows for one key."""


@dataclass
class MetricView:
    source: DataFrame
    parts: Mapping[str, Column]
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]
    joins: Mapping[str, Join] = field(default_factory=dict)
    comment: str = ""
    broadcast_rows: int = BROADCAST_ROWS
    _rows: dict[str, int] = field(default_factory=dict, repr=False)

    # --- queries ---------------------------------------------------------------------------

    def query(self, dimensions: Sequence[str] = (), measures: Sequence[str] = (),
              where: Mapping[str, Test] | None = None,
              having: Mapping[str, Test] | None = None,
              order_by: Sequence[str | Column] = ()) -> DataFrame:
        """The measures at the grain of the dimensions; none of them gives the grand total.

        Only the dimension tables that the names need are joined. `where` tests dimensions
        and `having` tests measures, each by name. `order_by` takes the dimensions of the query
        and any measure, also one that is not selected.
        """
        where, having = where or {}, having or {}
        self._check(dimensions, measures, where, having)
        wanted = self._wanted(dimensions, measures, having, order_by)
        rows = self._rows_to_sum(list(dict.fromkeys(dimensions)), wanted, where)
        totals = rows.groupBy(*[F.col(_quoted(d)) for d in dimensions]).agg(*self._totals(wanted))
        return self._finish(totals, list(dimensions), measures, wanted, having, order_by)

    def query_slices(self, slices: Sequence[Sequence[str]], measures: Sequence[str],
                     where: Mapping[str, Test] | None = None,
                     having: Mapping[str, Test] | None = None,
                     order_by: Sequence[str | Column] = ()) -> DataFrame:
        """Several groupings in one pass, told apart by `slice` (its number in the list). Equal
        slices are computed once and listed under each of their numbers.

        The facts are first summed to the finest grain, so that the expansion into one copy
        per slice happens on that small table and not on the lines; but not where distinct values
        are counted, whose grain is nearly that of the lines.
        """
        where, having = where or {}, having or {}
        names = list(dict.fromkeys(name for one in slices for name in one))
        self._check(names, measures, where, having)
        wanted = self._wanted(["slice", *names], measures, having, order_by)
        rows = self._rows_to_sum(names, wanted, where)
        if not any(c.startswith("_k_") for c in rows.columns):
            rows = _sum_up(rows, names, [c for c in rows.columns if c.startswith("_t_")])
        numbers: dict[int, list[int]] = {}
        for i, one in enumerate(slices):
            numbers.setdefault(_grouping_id(names, one), []).append(i)
        # Not Spark's grouping sets: rows that lie by a counted key must be known to do so still.
        copies = rows.withColumn("_set", F.explode(F.array(*map(F.lit, numbers))))
        left_out = {name: F.col("_set").bitwiseAND(1 << i) != 0
                    for i, name in enumerate(reversed(names))}
        copies = copies.withColumns({name: F.when(~left_out[name], F.col(_quoted(name)))
                                     for name in names})
        totals = (copies.groupBy("_set", *[F.col(_quoted(name)) for name in names])
                  .agg(*self._totals(wanted)))
        number = F.create_map(*[x for bits, own in numbers.items()
                                for x in (F.lit(bits), F.array(*map(F.lit, own)))])
        totals = totals.withColumn("slice", F.explode(number[F.col("_set")]))
        return self._finish(totals, ["slice", *names], measures, wanted, having, order_by)

    def cube(self, dimensions: Sequence[str], measures: Sequence[str],
             where: Mapping[str, Test] | None = None, having: Mapping[str, Test] | None = None,
             order_by: Sequence[str | Column] = ()) -> DataFrame:
        """All subsets of the dimensions as slices; slice bits mark the dimensions left out."""
        subsets = [[d for i, d in enumerate(reversed(dimensions)) if not bits >> i & 1][::-1]
                   for bits in range(2 ** len(dimensions))]
        return self.query_slices(subsets, measures, where, having, order_by)

    def repeated_keys(self) -> DataFrame:
        """Keys that occur more than once in a joined table; a query that joins it raises."""
        found = [join.table.groupBy(F.col(join.key).cast("string").alias("key"))
                 .agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
                 .select(F.lit(name).alias("join"), "key", "rows")
                 for name, join in self.joins.items()]
        result = found[0]
        for other in found[1:]:
            result = result.unionByName(other)
        return result

    # --- compilation to one aggregate ------------------------------------------------------

    def _rows_to_sum(self, dimensions: Sequence[str], measures: Iterable[str],
                     where: Mapping[str, Test]) -> DataFrame:
        """Rows with the dimensions, the distinct-counted keys and one amount per total."""
        parts, attributes, distinct = self._needs(measures)
        named = list(dict.fromkeys([*dimensions, *where]))
        used = list(dict.fromkeys(
            [self.dimensions[d].join for d in named if self.dimensions[d].join]
            + [join for join, _ in attributes]))
        keys = list(dict.fromkeys([*(self.joins[j].fact_key for j in used), *distinct]))

        facts = self.source
        own = [d for d in dimensions if not self.dimensions[d].join]
        for name, test in where.items():
            if not self.dimensions[name].join:
                facts = facts.filter(test(_column(self.dimensions[name].column)))
        facts = facts.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            *[_column(self.dimensions[d].column).alias(d) for d in own],
            *[self.parts[p].alias(f"_p_{p}") for p in parts])
        large = {j for j in used if self._row_count(j) > self.broadcast_rows}
        selected = {self.dimensions[d].join for d in dimensions}
        totals = [m for m in self._with_operands(measures) if isinstance(self.measures[m], Total)]
        # Small tables first; then those whose columns turn parts into totals; then those that only
        # test; and last the one whose key is counted, as the rows then lie by that key.
        open_joins = sorted(used, key=lambda j: (
            j in large, all(j != owner for owner, _ in attributes), j in selected,
            self.joins[j].fact_key in distinct))
        amounts, found = [f"_p_{p}" for p in parts], own
        while True:
            priced = all(owner not in open_joins for owner, _ in attributes)
            if priced and amounts and amounts[0].startswith("_p_"):
                kept = [c for c in facts.columns if not c.startswith(("_p_", "_a_"))]
                facts = facts.select(*[F.col(_quoted(c)) for c in kept],
                                     *[self.measures[m].expr.alias(f"_t_{m}") for m in totals])
                amounts = [f"_t_{m}" for m in totals]
            if not open_joins:
                break
            name = open_joins[0]
            needed = {self.joins[j].fact_key for j in open_joins} | set(distinct)
            if name in large and len(needed) == 1 and not found and (
                    priced or all(owner == name for owner, _ in attributes)):
                facts = _sum_up(facts, [f"_k_{k}" for k in needed], amounts)
            facts = self._join(facts, name, named, attributes, name in large)
            for d in named:
                if d in where and self.dimensions[d].join == name:
                    facts = facts.filter(where[d](F.col(_quoted(d))))
            found = found + [d for d in dimensions if self.dimensions[d].join == name]
            open_joins = open_joins[1:]
        return facts.select(*[F.col(_quoted(d)) for d in dimensions],
                            *[f"_k_{k}" for k in distinct],
                            *[F.col(_quoted(a)) for a in amounts])

    def _join(self, facts: DataFrame, name: str, dimensions: Iterable[str],
              attributes: Iterable[tuple[str, str]], large: bool) -> DataFrame:
        join = self.joins[name]
        table = join.table.select(
            F.col(join.key).alias(f"_on_{name}"),
            *[_column(self.dimensions[d].column).alias(d) for d in dimensions
              if self.dimensions[d].join == name],
            *[F.col(column).alias(f"_a_{name}_{column}")
              for owner, column in attributes if owner == name])
        return facts.join(table if large else F.broadcast(table),
                          F.col(f"_k_{join.fact_key}") == F.col(f"_on_{name}"), "left")

    def _needs(self, measures: Iterable[str]):
        parts, attributes, distinct = [], [], []
        for name in self._with_operands(measures):
            measure = self.measures[name]
            if isinstance(measure, Total):
                parts.extend(measure.parts)
                attributes.extend(measure.attributes)
            elif isinstance(measure, Distinct):
                distinct.append(measure.column)
        return (list(dict.fromkeys(x)) for x in (parts, attributes, distinct))

    def _with_operands(self, measures: Iterable[str]) -> list[str]:
        names = []
        for name in measures:
            measure = self.measures[name]
            if isinstance(measure, Ratio):
                names += [measure.above, measure.below]
            else:
                names.append(name)
        return list(dict.fromkeys(names))

    def _totals(self, measures: Iterable[str]) -> list[Column]:
        columns = []
        for name in self._with_operands(measures):
            measure = self.measures[name]
            if isinstance(measure, Distinct):
                column = F.count_distinct(F.col(f"_k_{measure.column}"))
            else:
                column = F.sum(_quoted(f"_t_{name}"))
                column = F.coalesce(column, F.lit(0)) if measure.counts else column
            columns.append(column.alias(f"_m_{name}"))
        return columns

    def _finish(self, totals: DataFrame, dimensions: list[str], measures: Sequence[str],
                wanted: Sequence[str], having: Mapping[str, Test],
                order_by: Sequence[str | Column]) -> DataFrame:
        def value(name: str) -> Column:
            measure = self.measures[name]
            if isinstance(measure, Ratio):
                return F.try_divide(F.lit(measure.factor) * F.col(_quoted(f"_m_{measure.above}")),
                                    F.col(_quoted(f"_m_{measure.below}")))
            return F.col(_quoted(f"_m_{name}"))

        kept = [F.col(_quoted(d)) for d in dimensions]
        result = totals.select(*kept, *[value(m).alias(m) for m in wanted])
        for name, test in having.items():
            result = result.filter(test(F.col(_quoted(name))))
        if order_by:
            result = result.orderBy(*[F.col(_quoted(o)) if isinstance(o, str) else o
                                      for o in order_by])
        return result.select(*kept, *[F.col(_quoted(m)) for m in measures])

    # --- helpers ---------------------------------------------------------------------------

    def _row_count(self, join: str) -> int:
        """Rows of a joined table. The same aggregate of its keys finds repeated ones, which
        would count lines more than once."""
        if join not in self._rows:
            key = self.joins[join].key
            counts = (self.joins[join].table.groupBy(F.col(key).alias("key"))
                      .agg(F.count(F.lit(1)).alias("rows")))
            matched = F.when(F.col("key").isNotNull(), F.col("rows"))
            rows, most, example = counts.agg(
                F.coalesce(F.sum("rows"), F.lit(0)), F.max(matched),
                F.max_by(F.col("key").cast("string"), matched)).first()
            if (most or 0) > 1:
                raise RepeatedKey(f"{key} of {join} must be unique; {example} has {most} rows")
            self._rows[join] = rows
        return self._rows[join]

    def _wanted(self, dimensions: Iterable[str], measures: Iterable[str],
                having: Iterable[str], order_by: Iterable[str | Column]) -> list[str]:
        """The measures to compute: those selected, tested, or ordered by."""
        ordered = [o for o in order_by if isinstance(o, str) and o not in dimensions]
        for name in ordered:
            if name not in self.measures:
                raise UnknownName(f"cannot order by {name!r}; there are: "
                                  f"{', '.join([*dimensions, *self.measures])}")
        return list(dict.fromkeys([*measures, *having, *ordered]))

    def _check(self, dimensions: Iterable[str], measures: Iterable[str],
               where: Mapping[str, Test], having: Mapping[str, Test]) -> None:
        for kind, names, known in (("dimension", [*dimensions, *where], self.dimensions),
                                   ("measure", [*measures, *having], self.measures)):
            for name in names:
                if name not in known:
                    raise UnknownName(f"no {kind} {name!r}; there are: {', '.join(known)}")
        if not list(measures):
            raise UnknownName(f"name at least one measure of: {', '.join(self.measures)}")


def _sum_up(rows: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    grouped = rows.groupBy(*[F.col(_quoted(k)) for k in keys])
    if not amounts:
        return grouped.agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")
    return grouped.agg(*[F.sum(_quoted(a)).alias(a) for a in amounts])


def _grouping_id(names: Sequence[str], kept: Sequence[str]) -> int:
    """The bit pattern Spark gives a grouping set: a set bit for each column left out."""
    return sum(1 << i for i, name in enumerate(reversed(names)) if name not in kept)


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _quoted(name: str) -> str:
    return f"`{name}`"

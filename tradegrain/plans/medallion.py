"""Bronze, silver and gold: land as-is, then clean, check and de-duplicate, then aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tradegrain.functions import canonical
from tradegrain.operators.keys import keep_one, surplus_rows
from tradegrain.operators.rules import (
    FAILED,
    Rule,
    apply_rules,
    observed,
    split,
    violations,
    warned,
)
from tradegrain.plans.sales_metrics import sales_metrics
from tradegrain.plans.sales_rules import customer_rules, order_rules, product_rules
from tradegrain.session import settle
from tradegrain.sources.json_files import (
    CORRUPT,
    DOCUMENT,
    LINEAGE,
    read_documents,
    read_json,
    unseen_fields,
    with_lineage,
)
from tradegrain.sources.schemas import (
    CATEGORIES,
    CUSTOMERS,
    ORDERS,
    PRODUCTS,
    REGIONS,
    SEGMENTS,
)


@dataclass(frozen=True)
class Entity:
    """How one entity is cleaned. `spelling` maps columns to their allowed values."""
    name: str
    schema: StructType
    key: str
    rules: Sequence[Rule]
    spelling: dict[str, Sequence[str]] = field(default_factory=dict)


class Silver(NamedTuple):
    """The clean table; the rows set aside and left out, each with the rules it breaks and what
    bronze knows of it; the keys of rows that stay although they break rules that only warn; and
    the number of rows and of violations of each rule, counted as the rows were written."""
    table: DataFrame
    quarantine: DataFrame
    dropped: DataFrame
    warned: DataFrame
    counters: dict[str, int]


def entities() -> dict[str, Entity]:
    """The three entities with their fixed domains. Needs an active session."""
    return {
        "customers": Entity("customers", CUSTOMERS, "customer_id", customer_rules(),
                            {"region": REGIONS, "segment": SEGMENTS}),
        "products": Entity("products", PRODUCTS, "product_id", product_rules(),
                           {"category": CATEGORIES}),
        "orders": Entity("orders", ORDERS, "order_id", order_rules()),
    }


def bronze(spark: SparkSession, path: str, schema: StructType | None = None,
           documents: bool = False) -> DataFrame:
    """The raw lines as they are, malformed ones kept as text, with file and read time.

    Written once with all columns: a JSON reader that is asked for some columns only does not see
    what is malformed in the others, and later steps would disagree about a line. With `documents`
    (and a `schema`) the whole line is kept as a VARIANT too, with the fields that the schema does
    not name; see `drift` and `field_of`.
    """
    if documents:
        return settle(read_documents(spark, path, schema), "bronze")
    return settle(with_lineage(read_json(spark, path, schema, keep_corrupt=True)), "bronze")


def drift(raw: dict[str, DataFrame], specs: dict[str, Entity]) -> DataFrame:
    """Per entity, the fields that its lines hold beyond its schema: type, rows, first file."""
    return reduce(DataFrame.unionByName, [
        unseen_fields(raw[name], spec.schema.names)
        .select(F.lit(name).alias("entity"), "field", "type", "rows", "first_file")
        for name, spec in specs.items()])


def field_of(name: str, kind: str) -> Column:
    """A field of the bronze documents as `kind`; NULL where it is absent or of another type."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"no path can name a field with both quotes: {name}")
    return F.try_variant_get(DOCUMENT, f"$[{quote}{name}{quote}]", kind)


def normalise(raw: DataFrame, entity: Entity, beside: Sequence[str] = ()) -> DataFrame:
    """The entity's columns, typed where the value allows it, trimmed, in allowed spelling; and
    the columns named `beside` as they are."""
    def clean(name: str, kind) -> Column:
        column = F.col(name)
        if name in entity.spelling:
            return canonical(column, entity.spelling[name]).alias(name)
        if isinstance(kind, StringType):
            return F.trim(column.cast("string")).alias(name)
        return column.try_cast(kind).alias(name)

    return raw.select(*[clean(f.name, f.dataType) for f in entity.schema if f.name in raw.columns],
                      *beside)


def parse_rules(raw: DataFrame, entity: Entity) -> list[Rule]:
    """A value that is there but not of its column's type is a violation, and so are a missing key
    and a line that bronze could not read. The rules read the raw values as `_raw_` columns."""
    kinds = dict(raw.dtypes)
    typed = [f.name for f in entity.schema if f.name in kinds and not isinstance(
        f.dataType, StringType) and kinds[f.name] != f.dataType.simpleString()]
    rules = [Rule(f"{name}_parses", F.col(f"_raw_{name}").isNull() | F.col(name).isNotNull())
             for name in typed]
    present = f"{entity.key}_present"
    if present not in {r.name for r in entity.rules}:
        rules.append(Rule(present, F.col(entity.key).isNotNull()))
    if CORRUPT in raw.columns:
        rules.append(Rule("line_parses", F.col(CORRUPT).isNull()))
    return rules


def silver(raw: DataFrame, entity: Entity) -> Silver:
    """Normalise, check, part, and keep one row per key. Rules run before de-duplication, so
    a good copy of a row survives a bad one. What bronze knows of a row, its text if it was
    malformed, its document and its lineage, stays with rows that are set aside or dropped."""
    known = [f.name for f in entity.schema if f.name in raw.columns]
    parsing = parse_rules(raw, entity)
    held = [r.name.removesuffix("_parses") for r in parsing
            if r.name.endswith("_parses") and r.name != "line_parses"]
    extra = [c for c in raw.columns if c in (CORRUPT, DOCUMENT, *LINEAGE)]
    beside = raw.select("*", *[F.col(c).alias(f"_raw_{c}") for c in held])
    wide = normalise(beside, entity, [*extra, *(f"_raw_{c}" for c in held)])
    rules = [*entity.rules, *parsing]
    # Written once: all parts, and the count of repeated keys, read it.
    checked, counters = observed(apply_rules(wide, rules), rules, f"checked {entity.name}")
    checked = settle(checked, "checked")
    parts = split(checked, rules)
    hidden = [f"_raw_{c}" for c in held]
    return Silver(keep_one(parts.valid.select(*known), [entity.key]),
                  parts.quarantine.drop(*hidden), parts.dropped.drop(*hidden),
                  warned(checked, rules).select(entity.key, FAILED), counters.get)


def counts_of(silvers: dict[str, Silver]) -> DataFrame:
    """(entity, rule, violations) from the counters, and the rows of each entity as rule `rows`."""
    rows = [(name, rule, n) for name, parts in silvers.items()
            for rule, n in parts.counters.items()]
    return next(iter(silvers.values())).table.sparkSession.createDataFrame(
        rows, "entity string, rule string, violations long")


def issue_summary(raw: dict[str, DataFrame], specs: dict[str, Entity]) -> DataFrame:
    """Violations per entity and rule, repeated order keys among them."""
    reports = []
    for name, spec in specs.items():
        clean = normalise(raw[name], spec)
        reports.append(violations(clean, spec.rules, name))
        if name == "orders":
            reports.append(surplus_rows(clean.filter(F.col(spec.key).isNotNull()), [spec.key])
                           .select(F.lit(name).alias("entity"),
                                   F.lit("order_id_unique").alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, reports)


def reconciliation(clean: dict[str, DataFrame], raw: dict[str, DataFrame]) -> DataFrame:
    """Clean rows, raw rows and the difference per entity."""
    counts = [frames[name].agg(F.lit(name).alias("entity"), F.lit(i).alias("raw"),
                               F.count(F.lit(1)).alias("rows"))
              for i, frames in enumerate((clean, raw)) for name in clean]
    return (reduce(DataFrame.unionByName, counts).groupBy("entity")
            .agg(F.sum(F.when(F.col("raw") == 0, F.col("rows"))).alias("clean_rows"),
                 F.sum(F.when(F.col("raw") == 1, F.col("rows"))).alias("raw_rows"))
            .withColumn("added_rows", F.col("raw_rows") - F.col("clean_rows")))


def gold_region_month(customers: DataFrame, products: DataFrame, lines: DataFrame) -> DataFrame:
    """Business metrics by region and month over the silver tables."""
    view = sales_metrics(lines, customers, products)
    found = view.query(["Region", "Order Month"],
                       ["Total Revenue", "Total Profit", "Order Count", "Units Sold"])
    return found.select(
        F.col("Region").alias("region"), F.col("Order Month").alias("order_month"),
        F.round("Total Revenue", 2).alias("revenue"), F.round("Total Profit", 2).alias("profit"),
        F.col("Order Count").alias("orders"), F.col("Units Sold").alias("units"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [frame.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
              for name, frame in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table")



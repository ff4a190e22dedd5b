"""Newline-delimited JSON folders, read with a given schema or with hints over inference."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
LINEAGE = ("_source_file", "_ingested_at")
DOCUMENT = "_document"


def hinted_schema(inferred: StructType, hints: str | StructType) -> StructType:
    """The inferred schema with the hinted fields' types; hinted fields not seen are added."""
    wanted = StructType.fromDDL(hints) if isinstance(hints, str) else hints
    types = {field.name: field.dataType for field in wanted}
    known = set(inferred.fieldNames())
    return StructType(
        [StructField(f.name, types.get(f.name, f.dataType), True) for f in inferred
         if f.name != CORRUPT]
        + [StructField(f.name, f.dataType, True) for f in wanted if f.name not in known])


def read_json(spark: SparkSession, path: str, schema: StructType | None = None,
              hints: str | StructType | None = None, keep_corrupt: bool = False,
              sampling: float = 1.0) -> DataFrame:
    """Read every JSON file of a folder.

    Give `schema` for large folders: inference (used with or without `hints`) reads the data once
    more, or the share `sampling` of its lines; a field that only others have is then not a column.
    With `keep_corrupt`, a line that is malformed or has a field of the
    wrong type is kept as text in `_corrupt_record` while the fields that parse are filled.
    """
    if schema is None:
        schema = hinted_schema(spark.read.option("samplingRatio", sampling).json(path).schema,
                               hints or StructType())
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """`read_json` with `keep_corrupt`, and the whole line as a VARIANT beside the typed columns,
    so that a field outside `schema` is kept. One pass over the text; blank lines are no rows. A
    line that is no JSON has no document, and its text."""
    text = spark.read.text(path).where(F.trim("value") != "")
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE",
                                         "columnNameOfCorruptRecord": CORRUPT})
    return text.select(parsed.alias("parsed"), F.try_parse_json("value").alias(DOCUMENT),
                       F.col("_metadata.file_path").alias("_source_file"),
                       F.current_timestamp().alias("_ingested_at")).select(
        "parsed.*", DOCUMENT, *LINEAGE)


def unseen_fields(documents: DataFrame, known: Collection[str]) -> DataFrame:
    """(field, type, rows, first_file) of the top-level fields of the documents that are not among
    `known`: the type that holds all their values, and in how many rows they stand. Fields are
    counted where they are read, so a field of all rows is one row a task in the shuffle."""
    field = documents.select(DOCUMENT, "_source_file").lateralJoin(
        documents.sparkSession.tvf.variant_explode(F.col(DOCUMENT).outer()))
    return (field.where(~F.col("key").isin(list(known))).groupBy(F.col("key").alias("field"))
            .agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("rows"),
                 F.min("_source_file").alias("first_file")))


def with_lineage(df: DataFrame) -> DataFrame:
    """Which file a row came from, and when it was read."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"))

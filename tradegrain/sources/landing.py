"""Landing of raw and clean files, one folder per flavour and entity, and a report on them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def land(frames: Mapping[str, DataFrame], root: str, flavour: str) -> None:
    """Write each entity as newline-delimited JSON to root/flavour/entity."""
    for entity, frame in frames.items():
        (frame.write.mode("overwrite").option("ignoreNullFields", "false")
         .json(f"{root}/{flavour}/{entity}"))


def landed_report(spark: SparkSession, root: str, flavours: Iterable[str],
                  entities: Iterable[str]) -> DataFrame:
    """Files, bytes and rows per flavour and entity; a missing folder reports zeros."""
    return reduce(DataFrame.unionByName,
                  [_folder_report(spark, root, flavour, entity)
                   for flavour in flavours for entity in entities])


def _folder_report(spark: SparkSession, root: str, flavour: str, entity: str) -> DataFrame:
    try:
        lines = spark.read.text(f"{root}/{flavour}/{entity}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "file_size long, rows long")
    else:
        files = (lines.groupBy("_metadata.file_path", "_metadata.file_size")
                 .agg(F.count(F.lit(1)).alias("rows")))
    return files.agg(
        F.lit(flavour).alias("flavour"), F.lit(entity).alias("entity"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))

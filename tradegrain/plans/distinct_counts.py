"""Distinct counts that add up: exact bitmaps of ids at a fine grain, merged to any coarser slice.

An id's bit stands in the bitmap of its bucket of 32,768 ids (4 KB), so a fine slice holds one row
for each bucket that it has ids in. Ids are made distinct first and go to their slice and bucket as
they are, at most 32,768 to one, since a bitmap of few ids is far larger than these; bitmaps are
merged by aggregates that reduce on the map side. The lines are read once, when the table is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "_bucket", "_bitmap"


def build_bitmaps(rows: DataFrame, dimensions: Sequence[str], ident: str) -> DataFrame:
    """One row per slice of the dimensions and bucket of the whole-number column `ident`; rows
    without one count for nothing."""
    ids = rows.where(F.col(ident).isNotNull()).select(*dimensions, ident).distinct()
    apart = ids.withColumn(BUCKET, F.bitmap_bucket_number(ident)).repartition(*dimensions, BUCKET)
    return (apart.groupBy(*dimensions, BUCKET)
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias(BITMAP)))


def add_bitmaps(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Two such tables of the same dimensions as one, as when new lines arrive."""
    keys = [c for c in stored.columns if c != BITMAP]
    return (stored.unionByName(more).groupBy(*keys)
            .agg(F.bitmap_or_agg(BITMAP).alias(BITMAP)))


def distinct_count(stored: DataFrame, dimensions: Sequence[str] = (),
                   where: Column | None = None, name: str = "distinct") -> DataFrame:
    """The exact number of ids in each slice of some of the stored dimensions; `where` tests
    stored dimensions. Without dimensions, one row for all."""
    rows = stored if where is None else stored.where(where)
    merged = rows.groupBy(*dimensions, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    return merged.groupBy(*dimensions).agg(
        F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0)).alias(name))

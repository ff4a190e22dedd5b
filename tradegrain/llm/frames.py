"""Small helpers shared by the operators: column names, row-wise Arrow passes, sizes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import tradegrain

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that they import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = Path(tradegrain.__file__).parent
        folder = tempfile.mkdtemp(prefix="package-")     # on the driver; Spark serves the file
        context.addPyFile(shutil.make_archive(f"{folder}/{home.name}", "zip", home.parent,
                                              home.name))
        _shipped.add(context.applicationId)


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
          schema: StructType | str) -> DataFrame:
    """mapInArrow with a function of this package. A task gives back what it has freed when it
    ends, since its Python worker lives on."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def release() -> None:
    """Return freed memory to the system: Arrow's pool and, where there is one, glibc's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def quoted(columns: list[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in columns]


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (names differ beyond case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_fold(id_column: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, by remainder; an id that is null counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("null"))) % modulus == remainder


def add_columns(df: DataFrame, inputs: list[str], outputs: StructType,
                compute: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """`df` with the columns of `outputs`, which `compute` makes from a batch of `inputs`.

    Rows stay where they are: nothing is shuffled, and all other columns pass through.
    """
    # By position, since mapInArrow does not take every name.
    names = [*df.columns, *(f.name for f in outputs)]
    where = [df.columns.index(c) for c in inputs]
    plain = [f"c{i}" for i in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = pa.RecordBatch.from_arrays([batch.column(i) for i in where], names=inputs)
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(wanted)], names=plain)

    fields = [*df.schema.fields, *(StructField(f.name, f.dataType, True) for f in outputs)]
    schema = StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(plain, fields)])
    return arrow(df.toDF(*plain[:len(df.columns)]), run, schema).toDF(*names)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).cast("long")).first()[0]

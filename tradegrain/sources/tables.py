"""Curated tables: scans, and full rebuilds that can be run again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalogued table by name, or a Parquet folder by path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def recover_table(spark: SparkSession, name: str) -> bool:
    """Bring back a table whose rebuild was cut off between the two renamings, and say whether that
    was so: `name` is then missing, and its old and its new rows stand beside it. The new ones are
    complete, as the old ones are renamed only after that; they become the table.

    Not to be called while another job may be rebuilding the table.
    """
    if spark.catalog.tableExists(name):
        return False
    short = name.rpartition(".")[2]
    prefix = name[:len(name) - len(short)]
    schema = f" IN {prefix[:-1]}" if prefix else ""
    beside = {r["tableName"] for r in spark.sql(f"SHOW TABLES{schema}").collect()}
    start = f"{short}_old_".lower()
    for old in sorted(t for t in beside if t.lower().startswith(start)):
        new = f"{short}_new_{old[len(start):]}"
        if new.lower() in {t.lower() for t in beside}:
            spark.sql(f"ALTER TABLE {prefix}{new} RENAME TO {name}")
            spark.sql(f"DROP TABLE {prefix}{old}")
        else:
            spark.sql(f"ALTER TABLE {prefix}{old} RENAME TO {name}")
        return True
    return False


def replace_table(df: DataFrame, name: str, comment: str | None = None,
                  key: str | None = None) -> None:
    """Create or replace a catalogued table from a query, in the order of `key` if one is given,
    so that a lookup reads few row groups.

    The new rows are written beside the table, and the two change names once they are complete:
    a rebuild that fails leaves the table as it was, and `df` may read from it. One that is cut off
    between the two renamings is completed by the next rebuild, or by `recover_table`.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, name)
    new, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
    if key is not None:
        df = df.repartitionByRange(key).sortWithinPartitions(key)
    try:
        df.write.format("parquet").saveAsTable(new)
        if comment is not None:
            quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {new} IS '{quoted}'")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    if replaced:
        spark.sql(f"DROP TABLE {old}")


def replace_files(df: DataFrame, path: str) -> DataFrame:
    """Write a Parquet folder anew and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

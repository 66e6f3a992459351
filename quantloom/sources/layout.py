"""Tables written in buckets of their key, so that joins and groupings by it need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from quantloom.sources.io import scratch


def write_buckets(df: DataFrame, name: str, key: tuple[str, ...] = ("date", "code"), buckets: int | None = None, *, order: tuple[str, ...] = (), dealt: bool = False, partitions: tuple[str, ...] = ()) -> str:
    """Writes df to the shared folder in buckets of key, sorted by order (by the key without one), and returns the table's name.

    dealt: df is in as many partitions by the key already, so it is written as it lies. partitions: columns with a folder for each value.

    Tables that are joined need the same number of buckets; by default it is that of shuffle partitions, so that a table joins
    a shuffled one too. One task writes a bucket, as a file. Rows with a null key share a bucket.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    writer = (df if dealt else df.repartition(n, *key)).write.bucketBy(n, *key).sortBy(*(order or key)).option("path", scratch(spark, name))
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)
    return table


def in_buckets(df: DataFrame, name: str, key: tuple[str, ...] = ("date", "code"), buckets: int | None = None) -> DataFrame:
    """df, read from its buckets."""
    return df.sparkSession.table(write_buckets(df, name, key, buckets))

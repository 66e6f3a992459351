"""A sink that replaces the dates of a range in a table of monthly partitions (A6, and I4 for predictions).

A write has three steps. The new content of the touched months is staged beside them, in a folder that readers skip; the
list of these months is written as a plan, whose completion is the commit; then month after month gives way to its staged
folder. A write that ends before its plan is complete leaves the table as it was, one that ends later is carried through
by the next write or by repair(); each month is moved by one rename, so what has been done is seen from what is left.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGED, PLAN = "_staged", "_plan"


def _files(spark: SparkSession, path: str):
    """The file system of path and a way to name files below it."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = java.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda name: java.Path(root, name)


def repair(spark: SparkSession, path: str) -> None:
    """Carries a committed write through and drops one that wasn't committed."""
    fs, at = _files(spark, path)
    if fs.exists(at(f"{PLAN}/_SUCCESS")):
        # At most a row a month.
        for row in spark.read.schema("month string, filled boolean").json(f"{path}/{PLAN}").collect():
            target, staged = at(f"month={row.month}"), at(f"{STAGED}/month={row.month}")
            if fs.exists(staged):
                fs.delete(target, True)
                if not fs.rename(staged, target):
                    raise OSError(f"{staged} wasn't moved")
            elif not row.filled:
                fs.delete(target, True)
    fs.delete(at(STAGED), True)
    fs.delete(at(PLAN), True)


def replace_dates(new: DataFrame, path: str, first: date, last: date, *, date_field: str = "date") -> None:
    """Makes new the only rows of path whose dates lie from first to last; other rows stay, other months' files untouched.

    Every row of new must be dated within these days, or nothing is written. Dates that new lacks are gone afterwards.
    Writing the same again changes nothing. The table has one writer at a time.
    """
    spark = new.sparkSession
    inside = F.coalesce(F.col(date_field).between(F.lit(first), F.lit(last)), F.lit(False))
    if stray := new.where(~inside).limit(1).count():
        raise ValueError(f"{stray} or more rows of {first} to {last} lie outside these days")
    repair(spark, path)
    fs, at = _files(spark, path)
    months = [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    held = [m for m in months if fs.exists(at(f"month={m}"))]
    content = new
    if held:
        # The months named by folder, so that no other is listed or read.
        old = spark.read.schema(new.schema).option("basePath", path).parquet(*[f"{path}/month={m}" for m in held])
        content = old.where(~inside).select(new.columns).unionByName(new)
    content = content.withColumn("month", F.date_format(date_field, "yyyy-MM"))
    content.repartition("month").write.mode("overwrite").partitionBy("month").parquet(f"{path}/{STAGED}")
    told = [(m, fs.exists(at(f"{STAGED}/month={m}"))) for m in months]
    spark.createDataFrame(told, "month string, filled boolean").coalesce(1).write.mode("overwrite").json(f"{path}/{PLAN}")
    repair(spark, path)


def stored_dates(spark: SparkSession, path: str) -> DataFrame:
    """The table, after any write that was cut off has been carried through."""
    repair(spark, path)
    return spark.read.parquet(path)

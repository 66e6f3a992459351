"""Running sums over long groups, without gathering a group in one task.

All rows are dealt out by ranges of group and value. Spark draws the bounds from a sample of the rows, so ranges hold about
as many rows each whatever the values are; where many are equal the ties go on the dealing. A range of a group is a slice: sums per
slice are summed up over the slices (a small table), and what is left is a window within each slice. The dealt rows are
written, as the sums and the windows must see the same slices, also when a task runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources.io import kept


def sliced(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """df, written, with the slice (column __slice) of each row; within a group slices ascend in the order."""
    return kept(df.repartitionByRange(*by, *order).withColumn("__slice", F.spark_partition_id()), "sliced")


def below(df: DataFrame, by: list[str], value: str, counts: list[str]) -> DataFrame:
    """df with below_<c> and all_<c> for each count column: its sum over the group's rows of smaller values, and over all. Values are distinct in a group and not null."""
    cut = sliced(df, by, [value])
    sums = cut.groupBy(*by, "__slice").agg(*[F.sum(c).alias(c) for c in counts])
    over, every = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by)
    base = sums.select(*by, "__slice", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"__b_{c}") for c in counts], *[F.sum(c).over(every).alias(f"all_{c}") for c in counts])
    inside = Window.partitionBy(*by, "__slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = {f"below_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__b_{c}") for c in counts}
    return cut.join(base, [*by, "__slice"]).withColumns(own).drop("__slice", *[f"__b_{c}" for c in counts])


def rank_from_top(df: DataFrame, by: list[str], value: str, ties: list[str]) -> DataFrame:
    """df with __rank, the place of each row in its group, highest value first, equal values by ties, and __n, the group's rows."""
    order = [F.desc(value), *ties]
    cut = sliced(df, by, order)
    sums = cut.groupBy(*by, "__slice").agg(F.count("*").alias("__c"))
    over, every = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by)
    base = sums.select(*by, "__slice", F.coalesce(F.sum("__c").over(over), F.lit(0)).alias("__b"), F.sum("__c").over(every).alias("__n"))
    inside = F.row_number().over(Window.partitionBy(*by, "__slice").orderBy(*order))
    return cut.join(base, [*by, "__slice"]).withColumn("__rank", inside + F.col("__b")).drop("__slice", "__b")

"""Reading, writing and incremental loads."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.clean import nan_inf_to_null


_FOLDERS: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); in a temporary one only where that isn't set and the master is local.

    The paths of a session are in one folder, which goes when the session's JVM ends.
    """
    session = spark.sparkContext.applicationId
    if session not in _FOLDERS:
        shared, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if not shared and not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{shared or tempfile.gettempdir()}/quantloom-{uuid.uuid4().hex}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _FOLDERS[session] = folder
    return f"{_FOLDERS[session]}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read from there, so that its plan and its loss end here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def load(spark: SparkSession, path: str, fields: list[str], *, date_field: str = "date", start: str | None = None, end: str | None = None, condition: str | None = None) -> DataFrame:
    """A1: fields of the rows between two dates that meet a condition; filters and columns reach the scan."""
    df = spark.read.parquet(path)
    if start:
        df = df.where(F.col(date_field) >= F.lit(start).cast("timestamp"))
    if end:
        df = df.where(F.col(date_field) < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    return (df.where(condition) if condition else df).select(*fields)


def read_scores(spark: SparkSession, pattern: str, columns: tuple[str, ...]) -> DataFrame:
    """A2: prediction files as one dataset, codes as text."""
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("code", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in columns)])
    return spark.read.schema(schema).option("header", True).csv(pattern)


def long_weights(wide: DataFrame, codes: list[str]) -> DataFrame:
    """A3: a row per date and code with a positive weight."""
    return wide.unpivot(["date"], codes, "code", "weight").where("weight > 0")


def wide_prices(df: DataFrame, codes: list[str], value: str = "close") -> DataFrame:
    """A4: a column per code, the mean of its values on a date; codes are stated, so no pass looks for them."""
    return df.groupBy("date").pivot("code", codes).agg(F.avg(value))


def store(df: DataFrame, path: str, *, mode: str = "overwrite", partition: str | None = None) -> None:
    """A5: infinite and undefined numbers as null, with the time of writing."""
    clean = df.withColumns({f.name: nan_inf_to_null(f.name) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)})
    writer = clean.withColumn("time_stamp", F.current_timestamp()).write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def replace_range(existing: DataFrame, new: DataFrame, date_field: str = "date") -> DataFrame:
    """Existing rows outside the new rows' dates, and the new rows; loading twice is loading once. Nothing new replaces nothing."""
    span = new.agg(F.min(date_field).alias("__from"), F.max(date_field).alias("__to"))
    kept = existing.crossJoin(F.broadcast(span)).where(f"__from IS NULL OR {date_field} < __from OR {date_field} > __to OR {date_field} IS NULL").drop("__from", "__to")
    return kept.unionByName(new)


def replace_from_first(existing: DataFrame, new: DataFrame, key: str = "code", date_field: str = "date") -> DataFrame:
    """A key's rows from its first new date on are replaced."""
    first = new.groupBy(key).agg(F.min(date_field).alias("__first"))
    kept = existing.join(first, key, "left").where(f"__first IS NULL OR {date_field} < __first").drop("__first")
    return kept.select(existing.columns).unionByName(new.select(existing.columns))


def load_plan(source: DataFrame, target: DataFrame, calendar: DataFrame, lags: tuple[int, ...], *, today: date | None = None) -> DataFrame:
    """One row (action, last_date, lookback_start) from both tables' last dates.

    full: the target is empty; incremental: the source is ahead; rerun: both end on the same day and it is today (the
    day is deleted and planned again); nothing otherwise. The lookback starts max(3 * the longest lag, 252) trade days
    before the first new one.
    """
    back = max(3 * max(lags), 252)
    ends = source.agg(F.max("date").alias("s")).crossJoin(target.agg(F.max("date").alias("t")))
    plan = ends.select(
        F.when(F.col("t").isNull(), "full").when(F.col("s") > F.col("t"), "incremental").when((F.col("s") == F.col("t")) & (F.col("t") == F.lit(today)), "rerun").otherwise("nothing").alias("action"),
        F.col("t").alias("last_date"),
    )
    last = plan.join(F.broadcast(calendar.withColumnRenamed("date", "d")), F.col("d") == F.col("last_date"), "left").select("action", "last_date", F.greatest(F.col("day_idx") - back, F.lit(0)).alias("i"))
    return last.join(F.broadcast(calendar), F.col("day_idx") == F.col("i"), "left").select("action", "last_date", F.col("date").alias("lookback_start"))


def recompute(df: DataFrame, feature, last_date, lookback_start, date_field: str = "date") -> DataFrame:
    """A feature's rows after last_date, from the rows since lookback_start only."""
    return feature(df.where(F.col(date_field) >= F.lit(lookback_start))).where(F.col(date_field) > F.lit(last_date))


def first_complete(sources: list[DataFrame], calendar: DataFrame) -> DataFrame:
    """A10: the rows of the first source that holds every trade day; of the last one if none does."""
    days = calendar.select("date").distinct()
    missing = None
    for i, s in enumerate(sources):
        n = days.join(s.select("date").distinct(), "date", "left_anti").agg(F.count("*").alias("n")).select(F.lit(i).alias("i"), F.when(F.col("n") == 0, 0).otherwise(1).alias("bad"))
        missing = n if missing is None else missing.union(n)
    choice = missing.agg(F.coalesce(F.min(F.when(F.col("bad") == 0, F.col("i"))), F.lit(len(sources) - 1)).alias("__choice"))
    tagged = None
    for i, s in enumerate(sources):
        one = s.withColumn("source_id", F.lit(i))
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.join(F.broadcast(choice), F.col("source_id") == F.col("__choice")).drop("__choice")


def dated_fallback(final: DataFrame, backup: DataFrame, date_field: str = "date") -> DataFrame:
    """A10: the final scores, and the backup's rows of the dates that the final ones lack altogether."""
    missing = backup.join(final.select(date_field).distinct(), date_field, "left_anti")
    return final.withColumn("is_backup", F.lit(0)).unionByName(missing.select(final.columns).withColumn("is_backup", F.lit(1)))


def only_new(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the union whose key occurs once; every key that occurs twice goes, in both."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return both.withColumn("__n", F.count("*").over(Window.partitionBy(*key))).where("__n = 1 AND __new = 1").drop("__n", "__new")


def latest(df: DataFrame, anchor: DataFrame, date_field: str = "date") -> DataFrame:
    """Rows of the table's last date, dated as the anchor's last date."""
    end = df.agg(F.max(date_field).alias("__end")).crossJoin(anchor.agg(F.max(date_field).alias("__as")))
    return df.join(F.broadcast(end), F.col(date_field) == F.col("__end")).withColumn(date_field, F.col("__as")).drop("__end", "__as")


def in_step(a: DataFrame, b: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both tables up to the earlier of their last dates, and the trade days after it that both must load."""
    end = a.agg(F.max("date").alias("x")).crossJoin(b.agg(F.max("date").alias("y"))).select(F.least("x", "y").alias("__end"))
    cut = lambda df: df.crossJoin(F.broadcast(end)).where("date <= __end").drop("__end")
    return cut(a), cut(b), calendar.crossJoin(F.broadcast(end)).where("__end IS NULL OR date > __end").select("date")

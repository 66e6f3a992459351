"""Feature assembly, sampling and splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources.io import kept
from quantloom.sources.layout import in_buckets


@dataclass(frozen=True)
class Part:
    """A table of an assembly: its merge key, columns to drop, and the prefix of the others.

    small: it should have a row per date or category. It is written first, so that its size is known: within
    spark.sql.autoBroadcastJoinThreshold it is broadcast, beyond it is joined by an exchange.
    """

    table: DataFrame
    key: tuple[str, ...]
    prefix: str = ""
    drop: tuple[str, ...] = ()
    small: bool = False


def wide_panel(anchor: DataFrame, parts: list[Part]) -> DataFrame:
    """The anchor's rows with the columns of each part; of rows with one key the part's first in order of all columns counts.

    Parts in buckets of their key (`sources/layout.py`) neither shuffle to find these rows nor to join an anchor in the same buckets.
    """
    out = anchor
    for p in parts:
        others = [c for c in p.table.columns if c not in p.key and c not in p.drop]
        one = p.table.groupBy(*p.key).agg(F.min(F.struct(*others)).alias("__r")).select(*p.key, *[F.col(f"__r.{c}").alias(p.prefix + c) for c in others])
        out = out.join(kept(one, "part") if p.small else one, list(p.key), "left")
    return out


def assembled(anchor: DataFrame, waves: list[list[Part]], buckets: int | None = None) -> DataFrame:
    """G1 with G2: one wave of parts after the other; between waves the panel is written, where its plan ends: in buckets of (date, code), or as it lies before small parts only."""
    out = anchor
    for i, parts in enumerate(waves):
        if i:
            out = kept(out, "wave") if all(p.small for p in parts) else in_buckets(out, "wave", buckets=buckets)
        out = wide_panel(out, parts)
    return out


def screened(df: DataFrame, days: str = "LIST_DAYNUM", st: str = "ST_FLAG", least: int = 60) -> DataFrame:
    """Listed for more than `least` days and not under special treatment; unknown values don't pass."""
    return df.where((F.col(days) > least) & (F.col(st) == 0))


def one_hot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """A 0/1 column per stated value; null is none of them."""
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, vs in values.items() for v in vs})


def rounded_one_hot(df: DataFrame, column: str, digits: int = 0, most: int = 1000) -> DataFrame:
    """One-hot of the values that occur, rounded and scaled to whole numbers.

    Each value makes a column, so the distinct values come to the driver; more than most of them are an error.
    """
    whole = F.round(F.round(column, digits) * 10**digits).cast("long")
    found = sorted(r[0] for r in df.select(whole.alias("v")).where("v IS NOT NULL").distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return df.withColumns({f"{column}:{v}": F.coalesce((whole == v).cast("int"), F.lit(0)) for v in found})


def labelled(df: DataFrame, labels: DataFrame, label: str, *, training: bool) -> DataFrame:
    """Rows with a known label to train on; all rows to test on, an unknown label as 0."""
    j = df.join(labels.select("date", "code", label), ["date", "code"], "inner" if training else "left")
    return j.dropna(subset=[label]) if training else j.fillna(0, [label])


def bucket_of(seed: int, n: int, *columns: str) -> Column:
    """A number from 0 to n - 1 by the first six hex digits of an MD5 of the columns, so that any engine gives the same."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, 6)
    return F.conv(digits, 16, 10).cast("long") % n


def hash_split(df: DataFrame, *columns: str, seed: int = 0, tenths: int = 9) -> tuple[DataFrame, DataFrame]:
    """90 / 10 by a hash of the key, the same at any partitioning."""
    return df.where(bucket_of(seed, 10, *columns) < tenths), df.where(bucket_of(seed, 10, *columns) >= tenths)


def past_sample(df: DataFrame, year: Column, current: int, *columns: str, percent: int = 20, seed: int = 0) -> DataFrame:
    """All rows of the current year and a share of each past year, by a hash of the key."""
    return df.where((year == current) | ((year < current) & (bucket_of(seed, 100, *columns) < percent)))


def balanced(df: DataFrame, label: str, *columns: str, seed: int = 0) -> DataFrame:
    """As many rows of each class as the smallest one has, those with the smallest hashes.

    Class sizes are counted first; the cut is a rank within slices of a class, so that no class is gathered in one task.
    """
    known = df.where(F.col(label).isNotNull()).withColumn("__h", F.xxhash64(F.lit(seed), *columns)).withColumn("__s", F.shiftright("__h", 56))
    sizes = known.groupBy(label, "__s").agg(F.count("*").alias("n"))
    least = sizes.groupBy(label).agg(F.sum("n").alias("n")).agg(F.min("n").alias("__least"))
    before = sizes.withColumn("__before", F.sum("n").over(Window.partitionBy(label).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1))).select(label, "__s", F.coalesce("__before", F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(label, "__s").orderBy("__h", *columns))
    ranked = known.join(F.broadcast(before), [label, "__s"]).withColumn("__r", rank + F.col("__before")).crossJoin(F.broadcast(least))
    return ranked.where("__r <= __least").drop("__h", "__s", "__before", "__r", "__least")


def moving_windows(spark, first: int = 2012, last: int = 2017, stop: tuple[int, int] = (2017, 3), years: int = 1) -> DataFrame:
    """(window_id, train_from, train_to, test_from, test_to): a year of training that ends 30 days short of a season of two months."""
    start = F.make_date("year", F.col("season") * 2 - 1, F.lit(1))
    plan = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("season"))
    plan = plan.where((F.col("year") < stop[0]) | (F.col("season") < stop[1])).select(
        (F.col("year") * 10 + F.col("season")).alias("window_id"), F.add_months(start, -12 * years).alias("train_from"), F.date_sub(start, 31).alias("train_to"), start.alias("test_from"), F.last_day(F.add_months(start, 1)).alias("test_to")
    )
    return plan


def in_windows(df: DataFrame, plan: DataFrame) -> DataFrame:
    """The panel's rows in each window they belong to, as train or test; the plan is small."""
    part = F.when(F.col("date").between(F.col("train_from"), F.col("train_to")), "train").when(F.col("date").between(F.col("test_from"), F.col("test_to")), "test")
    return df.join(F.broadcast(plan), F.col("date").between(F.col("train_from"), F.col("test_to"))).withColumn("part", part).where("part IS NOT NULL").drop("train_from", "train_to", "test_from", "test_to")


def chains(df: DataFrame, key: list[str], columns: list[str], length: int, order: str = "date") -> DataFrame:
    """Each row with the rows after it, as an array of structs; shorter ends are left out."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(0, length - 1)
    return df.select(*key, order, F.collect_list(F.struct(order, *columns)).over(w).alias("chain")).where(F.size("chain") == length)


def unchained(df: DataFrame, key: list[str], order: str = "date") -> DataFrame:
    """One value per row from chain predictions (arrays of (order, value)): the first chain's items, then each chain's last."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    out = df.withColumn("__n", n).select(*key, "__n", F.posexplode("predicted").alias("__p", "item"), F.size("predicted").alias("__s"))
    return out.where("__n = 1 OR __p = __s - 1").select(*key, "item.*")

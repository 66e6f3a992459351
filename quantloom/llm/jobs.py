"""Small helpers for the Spark side of the operators: lineage cuts, joins with hot keys, and connected components."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of all rows counts as hot; so there are at most a thousand of them, whatever the table.
HOT_SHARE = 1000


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the cluster's shared checkpoint folder and reads it from there; a lost executor costs nothing that was written.

    The folder is spark.checkpoint.dir. Where that is unset a temporary one is made, but only if the session has no
    other machines (a local master); on a cluster each executor would write to a disk of its own, so that is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that none can clash with what an operator adds."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("row")


def digest(docs: DataFrame, prefix: str = "", seed: int = 42) -> Column:
    """A hash of all columns of docs but those that hold maps, which have no order."""
    return F.xxhash64(F.lit(seed), *[F.col(f"{prefix}`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])


def held_out(doc_id) -> Column:
    """True for the fifth of the rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def join_hot(rows: DataFrame, facts: DataFrame, key: str, n_rows: int) -> DataFrame:
    """rows joined (inner) with facts on key. facts holds one row a key, with the number of rows of that key in column n.

    Rows of hot keys, those with over n_rows / HOT_SHARE of the n_rows rows, stay where they are and meet the facts of
    these keys as a broadcast table of at most HOT_SHARE rows; so no task gathers a key. All others meet by a shuffle.
    """
    hot = facts.where(F.col("n") * HOT_SHARE > n_rows).drop("n")
    known = hot.select(key, F.struct(*[F.col(c) for c in hot.columns if c != key]).alias("__hot"))
    told = rows.join(F.broadcast(known), key, "left")
    at_once = told.where("__hot IS NOT NULL").select(*rows.columns, "__hot.*")
    shuffled = told.where("__hot IS NULL").select(*rows.columns).join(facts.where(F.col("n") * HOT_SHARE <= n_rows).drop("n"), key)
    return at_once.unionByName(shuffled)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b) of longs, as rows (node, root) where root is the component's smallest node.

    Alternates large-star and small-star steps: each hangs a node's neighbours under its smallest one, by a
    pre-aggregated minimum and a join that deals hot nodes to many tasks, so no task gathers a component. Nulls and
    self-links are ignored. Nodes without links don't appear.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e, before = cut(e), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = cut(join_hot(both.where("v > u"), least, "u", 2 * now[0]).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        below = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
        small = join_hot(large, below, "hi", now[0]).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = cut(small.union(below.select("hi", F.col("m").alias("lo"))).distinct())
    roots = e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())

"""A corpus pipeline: quality, near-duplicates, decontamination, personal data and mixing.

Every stage takes documents with the columns doc_id, text and source and any others, whatever their names, and returns
these columns; the last one adds repeats, taken, size, source_size and target. Null or repeated ids and null, empty or very
long texts are rows like any other; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.decontaminate import decontaminate
from quantloom.llm.jobs import cut, packed, table
from quantloom.llm.mixing import mix_sources, row_keys
from quantloom.llm.near_dedup import near_duplicates
from quantloom.llm.pii import fit as fit_pii
from quantloom.llm.pii import redact
from quantloom.llm.quality import scored, train


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, each judged by its own text; it learns from the labelled ones among docs."""
    return scored(docs, train(docs, table(spark, sf_dir, "labels"))).where("score >= 0.3").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the one with the smallest id (null last); of its ids' repeats one."""
    return near_duplicates(docs, keep=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated by benchmark items; these stay as they are."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=True).where("NOT contaminated").select("row.*")


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their personal data replaced by the kind's name and n_chars counted anew where that happened."""
    return redact(docs, fit_pii(docs), length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: each row with its repeats and the words taken; rows that it doesn't take go.

    Rows that are equal in all columns are one row here, with the repeats of all of them. Columns of docs that are named
    like the added ones are replaced.
    """
    sums = [F.first(c).alias(c) for c in ("size", "source_size", "target")] + [F.sum(c).alias(c) for c in ("repeats", "taken")]
    taken = mix_sources(docs).groupBy("key", "key2").agg(*sums).where("repeats > 0")
    rows = docs.select(packed(docs), *row_keys(docs)).dropDuplicates(["key", "key2"])
    added = ("size", "source_size", "target", "repeats", "taken")
    return rows.join(taken, ["key", "key2"]).select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in added], *added)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("personal_data", redact_personal), ("mixing", mix)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs

"""Operator 9: mixing sources to target weights by balanced sampling with the cube method.

A source's documents are taken floor(r) or floor(r) + 1 times, where r is its target over its size. The fractional part
is an inclusion probability; the cube method moves these probabilities along directions that keep both the expected
tokens and the expected documents, until only a few stay fractional. Sources are dealt into blocks by a hash; what a
block can't decide meets in the next round, so a hot source is never gathered into one task. Every block has its flight; the
few rows that a source's last one leaves open are the landing problem.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import cut, digest, table

_NEAR = 1e-9
_DRAWS = 1 << 40
#: Open rows that a source's last flight leaves to the landing.
_FEW = 4


def source_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> dict[str | None, float]:
    """Each source's part of share times all sizes, by weights dealt to the sources in code point order (null last, over and over).

    No part passes most times its source's size; what would is dealt again by weight among the others.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(share) * sum(sizes.values()), set(names), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if rate * weight[s] > most * sizes[s]}
        for s in full or open_:
            out[s] = Fraction(most * sizes[s]) if full else rate * weight[s]
            left -= out[s]
        open_ -= full or open_
    return {s: float(t) for s, t in out.items()}


def _both(sizes: np.ndarray, k: int) -> np.ndarray:
    """The move of unit k alone, projected on the moves that keep the sum of chances and that of chances times sizes."""
    apart = sizes - sizes.mean()
    spread = float(apart @ apart)
    u = np.full(len(sizes), -1 / len(sizes)) - (apart[k] / spread * apart if spread > 0 else 0.0)
    u[k] += 1
    return np.where(np.abs(u) < 1e-12, 0.0, u)


def _words_only(sizes: np.ndarray, p: np.ndarray, k: int) -> np.ndarray:
    """A move of unit k that the others make up for in words, each by its size and by how far it is from being settled."""
    give = sizes * p * (1 - p)
    give[k] = 0.0
    total = float(give @ sizes)
    u = -sizes[k] / total * give if total > 0 else np.zeros(len(sizes))
    u[k] = 1.0
    return u


def _reach(p: np.ndarray, u: np.ndarray) -> tuple[float, float]:
    """How far p can move along u, and back, until a unit is settled."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)).min(), np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf)).min()


def _moved(p: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """p moved along u, up or down, until one of its units is settled, at such odds that no chance changes on average."""
    up, down = _reach(p, u)
    p = p + u * (up if rng.random() * (up + down) < down else -down)
    return np.where((p < _NEAR) | (p > 1 - _NEAR), np.round(p), p)


def _outsize(sizes: np.ndarray, p: np.ndarray) -> bool:
    """Whether the others hold too few words, taken or left, to make up for the first unit's next settlement."""
    return float(sizes[1:] @ p[1:]) < sizes[0] * (1 - p[0]) or float(sizes[1:] @ (1 - p[1:])) < sizes[0] * p[0]


def flight(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator, stay: int = 2, last: bool = False) -> np.ndarray:
    """Moves chances to 0 or 1 while keeping the sums of chances and of chances times sizes; at most stay (at least two) remain between.

    Units come by falling size. Each time the largest open one moves as far as the others can make up for it; so what
    stays open is small. In a source's last block no later round helps an outsize unit, one that both constraints pin or
    that the others can't make up for in words: it moves first, under that constraint alone.
    """
    p = np.where((chances < _NEAR) | (chances > 1 - _NEAR), np.round(chances), chances)
    at, k = np.flatnonzero((p > 0) & (p < 1)), 0
    while len(at) > stay and k < len(at):
        u = _both(sizes[at], k)
        if last and k == 0 and (u[0] < _NEAR or _outsize(sizes[at], p[at])):
            u = _words_only(sizes[at], p[at], 0)
        if u[k] < _NEAR:
            k += 1
            continue
        p[at] = _moved(p[at], u, rng)
        at, k = at[(p[at] > 0) & (p[at] < 1)], 0
    return p


def landing(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Settles the few units that the flight of a source's last block leaves, largest first, giving up one constraint at a time.

    A unit moves under both constraints if that settles it for sure, else under that of words only; the last one is drawn.
    No chance changes on average.
    """
    p = np.where((chances < _NEAR) | (chances > 1 - _NEAR), np.round(chances), chances)
    at = np.flatnonzero((p > 0) & (p < 1))
    while len(at) > 1:
        x, u = p[at], _both(sizes[at], 0)
        up, down = _reach(x, u)
        if u[0] < _NEAR or up * u[0] < 1 - x[0] - _NEAR or down * u[0] < x[0] - _NEAR:
            u = _words_only(sizes[at], x, 0)
        p[at] = _moved(x, u, rng)
        at = at[(p[at] > 0) & (p[at] < 1)]
    for k in at:
        p[k] = float(rng.random() < p[k])
    return p


def _settle(group: pd.DataFrame) -> pd.DataFrame:
    """The flight of a block, and after it the landing if it is its source's last one."""
    group = group.sort_values(["size", "draw", "doc_id"], ascending=[False, True, True], na_position="last", kind="stable").reset_index(drop=True)
    sizes, rng = group["size"].to_numpy(float), np.random.default_rng((group["draw"].to_numpy() * _DRAWS).astype(np.int64).tolist())
    last = bool(group["last"].iloc[0])
    chances = flight(sizes, group["chance"].to_numpy(float), rng, _FEW if last else max(2, min(32, len(sizes) // 4)), last)
    return group.assign(chance=landing(sizes, chances, rng) if last else chances)


def row_keys(docs: DataFrame, seed: int = 7) -> list[Column]:
    """Two hashes of a row's columns, 128 bits in all: rows of equal keys are equal."""
    return [digest(docs, seed=seed).alias("key"), digest(docs, seed=seed + 100).alias("key2")]


def _copies(rows: DataFrame, most: int = 4096) -> DataFrame:
    """A row per number of rows that are equal, so that each is drawn for itself: in two steps, as a third of all rows may be equal."""
    n = F.least(F.lit(most), F.col("n") - (F.col("part") - 1) * most)
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("n") / most)))).withColumn("n", n)
    dealt = parts.where(F.col("n") < most).unionByName(parts.where(F.col("n") >= most).repartition("part", "key"))
    return dealt.withColumn("copy", F.explode(F.sequence((F.col("part") - 1) * most + 1, (F.col("part") - 1) * most + F.col("n")))).drop("part", "n")


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 7, block_rows: int = 1024, most_sources: int = 1_000_000,
) -> DataFrame:
    """How often each document goes into the mix.

    Returns a row per row of docs: doc_id, source, size (words of the text), source_size, target (of the source),
    repeats (0 to most), taken (repeats times size), and key and key2 (see row_keys).

    A null text has size 0, and a null source is a source of its own, the last one. Documents of a source without
    words are never taken. Ids may be null or repeat; rows that are equal in all columns are drawn each for itself.
    Reruns agree, as every draw is a hash of the row. Empty docs give no rows. Other columns only tell rows apart.

    The table of source sizes comes to the driver; most_sources bounds it, and more sources are an error. A source's
    words differ from its target by less than the words of its last open document, as a rule one of its smallest.
    """
    if block_rows < 16:
        raise ValueError("a block has 16 rows at least")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"), *row_keys(docs, seed),
    )
    rows = cut(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")))
    known = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).limit(most_sources + 1).collect()
    if len(known) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    targets = source_targets({r.source: r.size for r in known}, weights, share, most)
    plan = []
    for r in known:
        rate = targets[r.source] / r.size if r.size else 0.0
        whole = math.floor(rate + _NEAR)
        plan.append((r.source, r.size, targets[r.source], whole, max(0.0, rate - whole) if rate - whole > _NEAR else 0.0))
    # The plan has a row per source, bounded above, and joins each side of it null-safely.
    plan = rows.sparkSession.createDataFrame(plan, "of string, source_size long, target double, whole long, chance double")
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "key", "key2", "copy"), F.lit(_DRAWS)) / float(_DRAWS)
    columns = ["doc_id", "source", "size", "source_size", "target", "whole", "chance", "draw", "key", "key2", "copy"]
    dealt = _copies(rows).join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of"))).withColumn("draw", draw).select(columns)
    settled, open_ = dealt.where("chance <= 0"), dealt.where("chance > 0")
    result, level, counts = [settled], 0, {r.source: r.n for r in known if targets[r.source] > 0}
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields) + ", last boolean, block long"
    while True:
        # As many blocks as a source's open rows need; one block for the last rows.
        need = [(s, max(1, -(-n // block_rows))) for s, n in counts.items()]
        blocks = rows.sparkSession.createDataFrame(need, "of string, blocks long")
        block = F.pmod(F.xxhash64(F.lit(level), "key", "key2", "copy"), F.col("blocks"))
        dealt = open_.join(F.broadcast(blocks), F.col("source").eqNullSafe(F.col("of"))).select(*columns, (F.col("blocks") == 1).alias("last"), block.alias("block"))
        moved = cut(dealt.groupBy("source", "block").applyInPandas(_settle, schema)).select(columns)
        result.append(moved.where("chance <= 0 OR chance >= 1"))
        open_ = moved.where("chance > 0 AND chance < 1")
        counts = {r.source: r["count"] for r in open_.groupBy("source").count().collect()}
        if not counts:
            break
        level += 1
    out = result[0]
    for more in result[1:]:
        out = out.unionByName(more)
    repeats = (F.col("whole") + F.round("chance")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"), "key", "key2")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9_mixing aims at: the words of each document and its source, and the source's target."""
    return op9_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: Every source that no later round caps has the same rate; a round caps those above twice their size, until none is.
MIX_TARGETS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r AS (
  SELECT 0 AS round, source, n, w, false AS capped, (SELECT sum(n) * 1.5 FROM s) AS all_words FROM s
  UNION ALL
  SELECT round + 1, source, n, w, capped OR w * rate > 2 * n, all_words FROM (
    SELECT *, (all_words - sum(CASE WHEN capped THEN 2 * n ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0) AS rate FROM r
  ) WHERE round < (SELECT count(*) FROM s)
),
t AS (SELECT *, (all_words - sum(CASE WHEN capped THEN 2 * n ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0) AS rate FROM r WHERE round = (SELECT count(*) FROM s))
SELECT doc_id, size, n::BIGINT AS source_size, round(CASE WHEN capped THEN 2 * n ELSE w * rate END, 3) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

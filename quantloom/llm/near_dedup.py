"""Operator 8: SimHash near-duplicates through an inverted index of byte positions with count filtering.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so at least 4 positional
bytes agree. A posting list per single positional byte would hold a 256th of all fingerprints; the index therefore
keys on positional byte triples, from a family of 20 that meets every set of 4 positions (Turan's construction). Pairs
that meet in a list have their shared positional bytes tallied, those below 4 go, and the rest is verified bit by bit.
A list that is too long for a task is dealt again by further positions, under the same tally and check.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.fingerprints import fingerprint_batches
from quantloom.llm.jobs import components, cut, digest, join_hot, packed, table
from quantloom.llm.text import arrow_rows, mix

_PARTS = ((0, 1, 2), (3, 4, 5), (6, 7))
#: Three positions of one part, or two of a part and one of the next: each 4 of the 8 positions hold such a triple.
TRIPLES = sorted({t for part in _PARTS for t in combinations(part, 3)} | {tuple(sorted((*two, one))) for i, part in enumerate(_PARTS) for two in combinations(part, 2) for one in _PARTS[(i + 1) % 3]})


#: The bits of the eight bytes, by position.
_BYTES = tuple(np.uint64(255 << 8 * i) for i in range(8))


def posting_keys(fp) -> Column:
    """The 20 lists of a fingerprint: key (number of the triple, then its three bytes) and the bits that the key leaves open."""
    byte = lambda i: F.shiftright(fp, 8 * i).bitwiseAND(F.lit(255))
    left = [int((~np.bitwise_or.reduce([_BYTES[i] for i in t])).view(np.int64)) for t in TRIPLES]
    return F.array(*[F.struct((F.lit(n << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c)).alias("key"), F.lit(left[n]).alias("left")) for n, (a, b, c) in enumerate(TRIPLES)])


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connects pairs (a, b): each node with the smallest one it reaches."""
    nodes, ids = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y, label = ids[: len(a)], ids[len(a) :], np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if (label == before).all():
            return nodes, nodes[label]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    node, root = _roots(a, b)
    return node[node != root], root[node != root]


def links_in_lists(key: np.ndarray, fp: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one posting list, as (fp, root) with one root per group of this task."""
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]))) if len(key) else np.zeros(0, bool)
    key, fp = key[fresh], fp[fresh]
    a, b, step = [], [], 1
    at = np.arange(len(key))
    while True:
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not at.size:
            break
        differ = fp[at] ^ fp[at + step]
        tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        passed = at[tally >= 8 - most_bits]
        near = passed[np.bitwise_count(fp[passed] ^ fp[passed + step]) <= most_bits]
        a.append(fp[near])
        b.append(fp[near + step])
        step += 1
        if sum(map(len, a)) > 1 << 20:
            # A dense list: its links so far are held as a forest.
            a, b = ([x] for x in _forest(np.concatenate(a), np.concatenate(b)))
    if not a or not sum(map(len, a)):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate(a), np.concatenate(b))


def _list_links(group: pa.Table, most_bits: int) -> pa.Table:
    key, fp = (group.column(c).to_numpy() for c in ("key", "fp"))
    node, root = links_in_lists(key, fp.view(np.uint64), most_bits)
    return pa.table({"a": node.view(np.int64), "b": root.view(np.int64)})


def dealt_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rule of the bytes on the bits that a long list's key leaves open: cut into eight positions, 20 lists by three of them.

    Rows (key, left, fp) to rows of the same kind. Two members within four bits share at least four of the eight
    positions, so they meet in one of the new lists.
    """
    for batch in batches:
        key, left, fp = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "left", "fp"))
        for mask in np.unique(left):
            mine = left == mask
            bits = [np.uint64(1) << np.uint64(i) for i in range(64) if int(mask) >> i & 1]
            parts = [np.bitwise_or.reduce(x) for x in np.array_split(np.array(bits, np.uint64), 8)]
            for n, t in enumerate(TRIPLES):
                fixed = np.bitwise_or.reduce([parts[i] for i in t])
                again = mix(mix(key[mine] + np.uint64(n + 1)) ^ (fp[mine] & fixed))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (again, np.full(len(again), mask & ~fixed), fp[mine])], ["key", "left", "fp"])


def fingerprint_links(fps: DataFrame, *, most_bits: int = 4, list_rows: int = 4096, task_rows: int = 200_000) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) exactly as all pairs within most_bits (4 at most) would.

    Lists of up to list_rows (at least 256) fingerprints are compared within their task, which returns a spanning
    forest. A longer list is dealt again into lists by further positions among the bits that are still open, as often
    as needed; each time at least three eighths of them become part of the key, so that no list stays long.
    """
    if not 0 <= most_bits <= 4 or list_rows < 256:
        raise ValueError("most_bits is 4 at most, list_rows at least 256")
    lists, links = fps.select(F.explode(posting_keys(F.col("fp"))).alias("p"), "fp").select("p.key", "p.left", "fp"), None
    while True:
        told = cut(lists.groupBy("key").count().where("count > 1").select("key", F.col("count").alias("n"), F.col("count").alias("size")))
        rows = int(told.agg(F.sum("n")).first()[0] or 0)
        shared = join_hot(lists, told, "key", rows)
        tasks = max(64, -(-rows // task_rows))
        dealt = shared.where(F.col("size") <= list_rows).select(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"), "key", "fp")
        found = dealt.groupBy("task").applyInArrow(lambda group: _list_links(group, most_bits), "a long, b long")
        links = found if links is None else links.union(found)
        if not told.where(F.col("size") > list_rows).limit(1).count():
            return links
        long = shared.where(F.col("size") > list_rows).select("key", "left", "fp")
        lists = cut(long.mapInArrow(dealt_again, "key long, left long, fp long"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, most_bits: int = 4, list_rows: int = 4096, keep: bool = False,
) -> DataFrame:
    """The class of near-duplicates of each document.

    Returns a row per row of docs: doc_id, fp (long) and component_id, the smallest doc_id reachable over links between
    fingerprints that differ in most_bits bits or fewer. With keep it returns one row of each class instead: the
    columns of docs of the row with the smallest id (null last), then the smallest fingerprint; rows that agree in
    both are chosen among by a hash of all columns.

    A null text, or one without words, has fingerprint zero and is linked like any other. Repeated rows and ids give a
    row each. A null id never names a class; a class of null ids only has a null component_id. Empty docs give no rows.
    Other columns are ignored, or with keep returned as they are, whatever their names.
    """
    arrow_rows(docs.sparkSession)
    # Only a written table has row numbers that hold when a task runs again.
    base = cut(docs.select(packed(docs), F.monotonically_increasing_id().alias("at"))) if keep else None
    rows = base.select("at", digest(docs, "row.").alias("tie"), *_keyed("row.", id_col, text_col)) if keep else docs.select(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("tie"), *_keyed("", id_col, text_col))
    fps = cut(rows.mapInArrow(partial(fingerprint_batches, size=shingle, seed=seed), "at long, tie long, doc_id long, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "tie", "at")).alias("first")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), *[first] * keep)
    roots = components(fingerprint_links(classes.select("fp"), most_bits=most_bits, list_rows=list_rows))
    of_root = cut(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    if keep:
        stay = of_root.groupBy("root").agg(F.min("first").alias("first")).select("first.at")
        return base.join(stay, "at", "left_semi").select("row.*")
    named = of_root.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    of_fp = join_hot(of_root.select("root", "fp", F.col("n").alias("rows")), named, "root", of_root.count()).select("fp", "component_id", F.col("rows").alias("n"))
    return join_hot(fps, cut(of_fp), "fp", fps.count()).select("doc_id", "fp", "component_id")


def _keyed(prefix: str, id_col: str, text_col: str) -> list[Column]:
    return [F.col(f"{prefix}`{id_col}`").cast("long").alias("doc_id"), F.col(f"{prefix}`{text_col}`").cast("string").alias("text")]


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

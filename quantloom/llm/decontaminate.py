"""Operator 2: benchmark decontamination with an FM-index per training shard.

Each Arrow batch of documents is a shard. Words outside the phrases' vocabulary can't take part in a match, so the
shard's index covers the maximal runs of vocabulary words that are long enough for some phrase. Phrases are searched
backwards through wavelet-tree ranks, occurrences are located from sampled suffix positions, and overlapping
occurrences are merged into removal spans. The benchmark goes out in blocks of bounded size, one narrow pass per
block; documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm.jobs import cut, packed, table
from quantloom.llm.text import arrow_rows, utf8

#: A-Z become a-z; every ASCII character that is neither a letter nor a digit separates words; other characters are word characters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class WaveletTree:
    """Ranks over a sequence of symbols 0..sigma-1, a level per bit of the symbol."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=1 << self.levels))))
        self.ones = []
        narrow = seq.astype(np.uint16) if self.levels <= 16 else seq
        for level in range(self.levels):
            # The nodes of a level, side by side, each in the sequence's order.
            order = np.argsort(narrow >> (self.levels - level), kind="stable") if level else slice(None)
            bits = (narrow[order] >> (self.levels - 1 - level)) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits))).astype(np.int32))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the sequence before each end."""
        at = ends.astype(np.int64)
        for level, ones in enumerate(self.ones):
            keep = self.levels - level
            base = self.starts[(symbols >> keep) << keep]
            right = ones[base + at] - ones[base]
            at = np.where((symbols >> (keep - 1)) & 1, right, at - right)
        return at


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence in which each 0 ends a run; equal runs stand in the order of their ends."""
    n, ends = len(seq), seq == 0
    rank = seq.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    step = 1
    rank = np.unique(rank, return_inverse=True)[1]
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search and location over runs of symbols; the sequence holds 0 after each run and no other 0."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = 8):
        sa = suffix_array(seq)
        self.last = seq[sa - 1]
        self.tree = WaveletTree(self.last, sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        # Every sample-th position is kept, and each start of a run, so that no walk crosses a 0.
        self.kept = (sa % sample == 0) | (self.last == 0)
        self.kept_rank = np.cumsum(self.kept) - 1
        self.positions = sa[self.kept]

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (a row of symbols, -1 for one that isn't here) the range of its suffixes."""
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        live = np.flatnonzero((phrases >= 0).all(axis=1))
        low[live], high[live] = 0, len(self.last)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            low[live] = self.first[c] + self.tree.rank(c, low[live])
            high[live] = self.first[c] + self.tree.rank(c, high[live])
            live = live[high[live] > low[live]]
            if not live.size:
                break
        gone = np.ones(len(phrases), bool)
        gone[live] = False
        low[gone] = high[gone] = 0
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        at, steps, out = rows.copy(), 0, np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while live.size:
            known = self.kept[at[live]]
            done = live[known]
            out[done] = self.positions[self.kept_rank[at[done]]] + steps
            live = live[~known]
            c = self.last[at[live]]
            at[live] = self.first[c] + self.tree.rank(c, at[live])
            steps += 1
        return out


def phrase_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(item, text) to a row (phrase, item) for each window of the item's words, or for all of them if they are fewer."""
    for batch in batches:
        phrases, items = [], []
        for item, text in zip(batch.column("item").to_pylist(), utf8(batch.column("text")), strict=True):
            words = text.translate(_FOLD).split()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                phrases.append(b" ".join(words[i : i + window]))
                items.append(item)
        yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(items, pa.string())], ["phrase", "item"])


class PhraseSet:
    """A block of phrases as arrays of word numbers, by length."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for phrase, item in sorted(rows):
            by_length[phrase.count(b" ") + 1][phrase].append(item)
        number = self.vocabulary.setdefault
        self.groups = [
            (n, np.array([[number(w, len(self.vocabulary) + 1) for w in p.split(b" ")] for p in of], np.int32), list(of.values()))
            for n, of in sorted(by_length.items())
        ]
        self.shortest = min(by_length, default=0)


def search(words: list[list[bytes]], phrases: PhraseSet, sample: int) -> list[tuple[int, int, int, list[str]]]:
    """Occurrences in a shard of documents: (document, first word, words, items)."""
    get, zero = phrases.vocabulary.get, itertools.repeat(0)
    sizes = [len(w) for w in words]
    ids = np.zeros(sum(sizes) + len(words), np.int32)
    begin = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.array(sizes, np.int64) + 1)))
    for at, w in zip(begin.tolist(), words, strict=False):
        ids[at : at + len(w)] = np.fromiter(map(get, w, zero), np.int32, len(w))
    edges = np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0])))
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - first >= phrases.shortest
    first, end = first[long], end[long]
    if not first.size:
        return []
    # The runs side by side, each with the 0 that follows it.
    lengths = end - first + 1
    place = np.repeat(first - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
    symbols, seq = np.unique(ids[place], return_inverse=True)
    to_symbol = np.full(len(phrases.vocabulary) + 1, -1, np.int64)
    to_symbol[symbols] = np.arange(len(symbols))
    index, found = FMIndex(seq.astype(np.int64), len(symbols), sample), []
    for n, numbers, items in phrases.groups:
        low, high = index.find(to_symbol[numbers])
        which = np.flatnonzero(high > low)
        if not which.size:
            continue
        times = (high - low)[which]
        rows = np.repeat(low[which] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(int(times.sum()))
        at = place[index.locate(rows)]
        doc = np.searchsorted(begin, at, side="right") - 1
        found += [(d, p, n, items[k]) for d, p, k in zip(doc.tolist(), (at - begin[doc]).tolist(), np.repeat(which, times).tolist(), strict=True)]
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan_batches(batches: Iterator[pa.RecordBatch], block: Broadcast, sample: int) -> Iterator[pa.RecordBatch]:
    """Adds the hits of one block of phrases to those of the blocks before: words, hit word spans and items of each document."""
    phrases: PhraseSet = block.value
    for batch in batches:
        words = [t.translate(_FOLD).split() for t in utf8(batch.column("text"))]
        spans = [list(map(tuple, zip(x[::2], x[1::2], strict=True))) for x in batch.column("spans").to_pylist()]
        items = [set(x) for x in batch.column("items").to_pylist()]
        for doc, at, n, of in search(words, phrases, sample):
            spans[doc].append((at, at + n))
            items[doc].update(of)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([[e for s in _merged(x) for e in s] for x in spans], pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                batch.column("row"),
            ],
            ["doc_id", "text", "n_words", "spans", "items", "row"],
        )


def result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word spans to character spans, and the digest of the items."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        cuts, hits, digests = [], [], []
        for text, flat, items in zip(batch.column("text"), batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            pairs = list(zip(flat[::2], flat[1::2], strict=True))
            hits.append(sum(b - a for a, b in pairs))
            digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            at = [m.span() for m in _WORD.finditer(text.as_py())] if pairs else []
            cuts.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in pairs])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hits, pa.int64()), batch.column("items"), pa.array(digests, pa.string()), pa.array(cuts, kind), batch.column("row")],
            ["doc_id", "n_words", "n_hit", "items", "items_sha256", "cuts", "row"],
        )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, sample: int = 8, block_phrases: int = 200_000, keep: bool = False,
) -> DataFrame:
    """The occurrences of benchmark windows in documents.

    Returns a row per row of docs: doc_id, n_words, n_hit (words inside an occurrence), items (ids of the items with an
    occurrence, sorted as strings), items_sha256, cuts (merged removal spans in characters, end exclusive) and
    contaminated (at least one word in twenty is hit).

    A null or empty text has no words and no hits. Repeated rows and repeated ids give a row each; ids may be null.
    Items without an id, a text or words are ignored, and a repeated item counts once. With no item at all nothing is
    hit. Empty docs give no rows. Other columns of either table are ignored; with keep, a further column row holds all
    columns of docs as a struct.

    block_phrases bounds what is broadcast at once: a benchmark with more windows is dealt into blocks by a hash, each
    searched in a pass of its own. A pass but the last writes the documents with the hits so far to the shared folder
    and then gives its block up, so that a task never holds two; a larger bound saves such passes.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).dropna()
    phrases = cut(rows.mapInArrow(partial(phrase_batches, window=window), "phrase binary, item string").distinct())
    blocks = -(-phrases.count() // block_phrases)
    row = packed(docs) if keep else F.lit(0)
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items"), row.alias("row"),
    )
    schema = found.schema
    last = max(1, blocks) - 1
    for k in range(last + 1):
        part = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(last + 1)) == k).collect()
        block = spark.sparkContext.broadcast(PhraseSet([(bytes(p), i) for p, i in part]))
        scan = partial(scan_batches, block=block, sample=sample)
        if k < last:
            found = cut(found.mapInArrow(scan, schema))
            block.unpersist()
    # The last pass also makes the results, so that a task needs no further Python worker for them.
    kinds = T.StructType.fromDDL("doc_id long, n_words long, n_hit long, items array<string>, items_sha256 string, cuts array<struct<start: bigint, end: bigint>>")
    out = found.mapInArrow(lambda batches: result_batches(scan(batches)), T.StructType([*kinds.fields, schema["row"]]))
    return (out if keep else out.drop("row")).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", "contaminated")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM p),
g AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), m AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p USING (n, phrase)),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

"""Operator 7: quality rules by gradient-boosted trees over document statistics.

The statistics are counted over whole texts. The trees are grown on histograms of a bounded sample of labelled rows,
with monotonic constraints on the statistics that can only speak against a document, and flattened into node arrays so
that a batch walks all trees with a few numpy steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import held_out, table
from quantloom.llm.text import arrow_rows, in_pieces, joined, keyed_text, mix, span_hash, utf8, word_bounds

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_capitals", "n_digits", "n_marks", "n_again", "n_bare")
#: Each rate and its constraint: -1 if a higher value can only lower the score.
RATES = {"log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1, "digits": 0, "marks": 0, "again": -1, "bare": -1, "line_words": 0}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"'(),-./:;?[]_{}~+=@\\^`")] = True
_WINDOW = 8


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(flags)))[offsets])


def statistics(texts: list[bytes]) -> np.ndarray:
    """COUNTS and some more counts of each text, in columns."""
    out = np.zeros((len(texts), len(COUNTS) + len(_MORE)), np.int64)
    for first, last in in_pieces(texts):
        part = texts[first:last]
        buf, offsets = joined(part)
        starts, ends = word_bounds(buf)
        at = np.searchsorted(starts, offsets)
        n_words = np.diff(at)
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        symbols, marks = _SYMBOL[buf], _MARK[buf]
        row = out[first:last]
        row[:, 0] = n_words
        row[:, 1] = _per_text(in_word & ((buf & 0xC0) != 0x80), offsets)
        row[:, 2] = _per_text(symbols, offsets)
        for i, text in enumerate(part):
            lines = [x for x in text.split(b"\n") if x.strip()]
            row[i, 3], row[i, 5] = len(lines) - len(set(lines)), len(lines)
        row[:, 6] = _per_text((buf >= 65) & (buf <= 90), offsets)
        row[:, 7] = _per_text((buf >= 48) & (buf <= 57), offsets)
        row[:, 8] = _per_text(marks, offsets)
        words = span_hash(buf, starts, ends)
        n, text_of = len(words), np.repeat(np.arange(len(part)), n_words)
        again = np.zeros(n, bool)
        again[1:] = (words[1:] == words[:-1]) & (text_of[1:] == text_of[:-1])
        row[:, 9] = _per_text(again, at)
        odd = np.concatenate((np.zeros(1, np.int64), np.cumsum(symbols | marks)))
        row[:, 10] = _per_text(odd[ends] - odd[starts] == ends - starts, at)
        if n >= _WINDOW:
            h = np.zeros(n - _WINDOW + 1, np.uint64)
            for j in range(_WINDOW):
                h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : n - _WINDOW + 1 + j]
            begin = np.flatnonzero(text_of[: n - _WINDOW + 1] == text_of[_WINDOW - 1 :])
            h = mix(mix(h[begin]) + text_of[begin].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            twice = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(h) else np.zeros(0, bool)
            hit = begin[order[twice]]
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + _WINDOW, -1)
            row[:, 4] = _per_text(np.cumsum(cover[:-1]) > 0, at)
    return out


def rates(counts: np.ndarray) -> np.ndarray:
    c = {k: counts[:, i].astype(float) for i, k in enumerate(COUNTS + _MORE)}
    words, lines, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["word_chars"], 1)
    found = {
        "log_words": np.log1p(c["n_words"]), "mean_word": c["word_chars"] / words, "symbols": c["n_symbols"] / words, "dup_lines": c["n_dup_lines"] / lines,
        "repeats": c["n_repeat_words"] / words, "capitals": c["n_capitals"] / chars, "digits": c["n_digits"] / chars, "marks": c["n_marks"] / words,
        "again": c["n_again"] / words, "bare": c["n_bare"] / words, "line_words": c["n_words"] / lines,
    }
    return np.stack([found[k] for k in RATES], axis=1)


@dataclass
class Trees:
    """Boosted trees in node arrays: a leaf points to itself."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw, rows = np.full(len(x), self.start), np.arange(len(x))[:, None]
        if len(self.roots) and len(x):
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] < self.bound[node], self.left[node], self.right[node])
            raw = raw + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def boost(x: np.ndarray, good: np.ndarray, signs: tuple[int, ...], *, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 48, least_rows: float = 8, ridge: float = 1.0) -> Trees:
    """Logistic boosting on histograms. signs: per feature 1 (score rises), -1 (falls) or 0 (free); bounds of a split's
    middle value pass down to both sides, so that the constraint holds for whole trees."""
    n, (n1, n0) = len(x), (int(good.sum()), int((~good).sum()))
    nodes: dict[str, list] = {k: [] for k in ("feature", "bound", "left", "right", "value")}
    roots: list[int] = []
    start = float(np.log((n1 + 1) / (n0 + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])] if n else []
    place = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, len(signs)), int)

    def node(**of) -> int:
        for k, v in of.items():
            nodes[k].append(v)
        return len(nodes["value"]) - 1

    def weight(g: float, h: float, low: float, high: float) -> float:
        return min(max(g / (h + ridge), low), high)

    def gain(g: float, h: float, w: float) -> float:
        return 2 * g * w - (h + ridge) * w * w

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, left: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        w = weight(g, h, low, high)
        me = node(feature=0, bound=np.inf, left=0, right=0, value=rate * w)
        nodes["left"][me] = nodes["right"][me] = me
        if not left or len(rows) < 2 * least_rows:
            return me
        best = (gain(g, h, w) + 1e-6, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = place[rows, f]
            gs, hs, ns = (np.cumsum(np.bincount(b, weights=v, minlength=len(e) + 1))[:-1] for v in (grad[rows], hess[rows], np.ones(len(rows))))
            for k in np.flatnonzero((ns >= least_rows) & (len(rows) - ns >= least_rows)).tolist():
                wl, wr = weight(gs[k], hs[k], low, high), weight(g - gs[k], h - hs[k], low, high)
                if signs[f] * (wr - wl) < 0:
                    continue
                if (found := gain(gs[k], hs[k], wl) + gain(g - gs[k], h - hs[k], wr)) > best[0]:
                    best = (found, (f, k, (wl + wr) / 2))
        if best[1] is None:
            return me
        f, k, middle = best[1]
        to_left = place[rows, f] <= k
        l_low, l_high, r_low, r_high = low, high, low, high
        if signs[f] > 0:
            l_high = r_low = middle
        elif signs[f] < 0:
            l_low = r_high = middle
        nodes["feature"][me], nodes["bound"][me] = f, float(edges[f][k])
        nodes["left"][me] = grow(rows[to_left], grad, hess, left - 1, l_low, l_high)
        nodes["right"][me] = grow(rows[~to_left], grad, hess, left - 1, r_low, r_high)
        return me

    raw = np.full(n, start)
    for _ in range(rounds if n1 and n0 else 0):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(n), good - p, p * (1 - p), depth, -np.inf, np.inf))
        tree = Trees(0.0, np.array(roots[-1:]), *(np.array(nodes[k]) for k in ("feature", "bound", "left", "right", "value")), depth)
        at = np.full(n, roots[-1])
        for _ in range(depth):
            at = np.where(x[np.arange(n), tree.feature[at]] < tree.bound[at], tree.left[at], tree.right[at])
        raw = raw + tree.value[at]
    return Trees(start, np.array(roots, int), *(np.array(nodes[k]) for k in ("feature", "bound", "left", "right", "value")), depth)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(list(statistics(utf8(batch.column("text")))), pa.list_(pa.int64()))], ["doc_id", "good", "counts"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", sample_rows: int = 8000) -> Trees:
    """Learns from at most sample_rows labelled documents, those with the smallest hashes of their ids; held-out ids are left out.

    Labels other than 0 and 1 are ignored; an id with both counts as 0; of repeated ids one text counts, the first in
    order. Without both classes the trees are empty and every score is the classes' smoothed share.
    """
    arrow_rows(docs.sparkSession)
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("good")).where("doc_id IS NOT NULL AND good IN (0, 1)").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = keyed_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("good").alias("good"))
    found = sorted(texts.mapInArrow(_count_batches, "doc_id long, good int, counts array<bigint>").collect(), key=lambda r: r.doc_id)
    counts = np.array([r.counts for r in found], np.int64).reshape(-1, len(COUNTS) + len(_MORE))
    return boost(rates(counts), np.array([r.good == 1 for r in found], bool), tuple(RATES.values()))


def _judge_batches(batches: Iterator[pa.RecordBatch], trees: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = statistics(utf8(batch.column("text")))
        score = trees.value.scores(rates(counts))
        n, repeats = counts[:, 0], counts[:, 4]
        failed = (n < 20) | (100 * repeats > 30 * n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(counts[:, i].copy()) for i in range(len(COUNTS))), pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))],
            ["doc_id", *COUNTS, "base_failed", "score", "kept"],
        )


def judge(docs: DataFrame, trees: Trees, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Statistics and verdict of each document.

    Returns a row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    (fewer than 20 words, or over 30 % of them in repeated 8-word windows), score and kept (neither failed nor scored
    below threshold). A null or empty text has zero counts and fails. Repeated rows and null ids give a row each; empty
    docs give none. Other columns are ignored.
    """
    arrow_rows(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(trees)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return keyed_text(docs, id_col, text_col).mapInArrow(partial(_judge_batches, trees=sent, threshold=threshold), schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels"))).select("doc_id", *COUNTS, "base_failed", "kept", "score")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics and base rules of op7_quality_rules, which SQL can express; the trees have no part in them."""
    return judge(table(spark, sf_dir, "documents"), Trees(0.0, *[np.zeros(0, int)] * 6, 0)).select("doc_id", *COUNTS, "base_failed")


COUNTS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 7], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
t AS (SELECT doc_id, h FROM g GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM g SEMI JOIN t USING (doc_id, h)) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
"""

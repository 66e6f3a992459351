"""Operator 3: language identification by the nearest of several clustered centroids per language.

A text is a normalised TF-IDF vector of hashed byte n-grams of its letters. Document frequencies come from all rows
that may be learnt from; the centroids come from spherical k-means over a bounded sample per language. The nearest
centroid by cosine names the language; a text further from it than its training members nearly all are is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import held_out, table
from quantloom.llm.text import arrow_rows, in_pieces, joined, mix, utf8

WIDTH = 4096
_SIZES = (1, 2, 3)
#: ASCII letters in lower case, other characters' bytes as they are, everything else a space.
_LETTER = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
UNKNOWN = "und"


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def gram_counts(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Counts of each text's hashed n-grams."""
    for first, last in in_pieces(texts):
        buf, offsets = joined(texts[first:last])
        letters = _LETTER[buf]
        keep = np.concatenate(([True], (letters[1:] != 32) | (letters[:-1] != 32)))
        keep[offsets[:-1]] = True
        stream = letters[keep].astype(np.uint64)
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(keep)))[offsets]
        codes = []
        for n in _SIZES:
            h = np.zeros(max(0, len(stream) - n + 1), np.uint64)
            for j in range(n if len(h) else 0):
                h = (h << np.uint64(8)) | stream[j : len(stream) - n + 1 + j]
            codes.append((mix(h + np.uint64(n << 40)) & np.uint64(WIDTH - 1)).astype(np.int64))
        for i in range(last - first):
            a, b = at[i], at[i + 1]
            yield np.bincount(np.concatenate([c[a : max(a, b - n + 1)] for c, n in zip(codes, _SIZES, strict=True)]), minlength=WIDTH)


@dataclass
class LanguageModel:
    """idf by n-gram; unit centroids in rows with their language and the distance from which they reject."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    reach: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts).astype(np.float32) * self.idf
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(norm > 0, norm, 1)

    def predict(self, texts: list[bytes]) -> list[tuple[str, float, bool]]:
        """Language, cosine (0 to 1) and whether the text is rejected as too far, of each text."""
        out: list[tuple[str, float, bool]] = []
        counts = gram_counts(texts)
        for a in range(0, len(texts), 128):
            part = texts[a : a + 128]
            cosine = self.vectors(np.stack([next(counts) for _ in part])) @ self.centroids.T if self.languages else np.zeros((len(part), 1))
            best = cosine.argmax(axis=1)
            for text, row, k in zip(part, cosine, best.tolist(), strict=True):
                if not self.languages or not has_letter(text):
                    out.append((UNKNOWN, 0.0, True))
                else:
                    out.append((self.languages[k], float(min(1.0, max(0.0, row[k]))), bool(1 - row[k] > self.reach[k])))
        return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Unit centroids of unit rows; the first is drawn, each next one is the row furthest from those before."""
    centres = x[[np.random.default_rng(seed).integers(len(x))]]
    for _ in range(min(k, len(x)) - 1):
        centres = np.vstack((centres, x[(x @ centres.T).max(axis=1).argmin()]))
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[nearest == j].sum(axis=0) if (nearest == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centres


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the number of texts with each n-gram; the number of texts stands at WIDTH."""
    total = np.zeros(WIDTH + 1, np.int64)
    for batch in batches:
        texts = utf8(batch.column("text"))
        for counts in gram_counts(texts):
            total[:WIDTH] += counts > 0
        total[WIDTH] += len(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1)), pa.array(total)], ["gram", "n"])


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, counts = [], []
        for c in gram_counts(utf8(batch.column("text"))):
            at = np.flatnonzero(c)
            grams.append(at.astype(np.uint16).tobytes())
            counts.append(c[at].astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("lang"), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], ["h", "lang", "grams", "counts"])


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", clusters: int = 4, lang_rows: int = 1500, reach: float = 0.999, slack: float = 0.05, seed: int = 3,
    most_rows: int = 20_000, most_languages: int = 10_000,
) -> LanguageModel:
    """Learns from rows with a text and a language whose id isn't held out.

    Document frequencies use all of these rows. The clusters use about lang_rows different texts of each language, those
    with the smallest hashes; a text that repeats counts once, and every language has one at least. With many languages
    each has its part of most_rows, so the sample on the driver is bounded; the model has a centroid a language at least,
    and more than most_languages of them are an error. A centroid rejects beyond the quantile reach of its members'
    distances plus slack.
    """
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang", F.xxhash64(F.lit(seed), "text").alias("h"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"), F.min("h").alias("least")).limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    seen = {r.gram: r.n for r in rows.select("text").mapInArrow(_frequency_batches, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    frequency = np.array([seen.get(g, 0) for g in range(WIDTH)], float)
    idf = np.log((1 + seen.get(WIDTH, 0)) / (1 + frequency)) + 1
    model = LanguageModel(idf.astype(np.float32), np.zeros((0, WIDTH), np.float32), [], np.zeros(0))
    if not sizes:
        return model
    each = max(1, min(lang_rows, most_rows // len(sizes)))
    clusters = max(1, min(clusters, 2 * most_languages // len(sizes)))
    # A row per language, so at most most_languages.
    bounds = docs.sparkSession.createDataFrame([(r.lang, r.least, int((1 << 30) * min(1.0, each / max(1, r.n)))) for r in sizes], "lang string, least long, bound long")
    picked = rows.join(F.broadcast(bounds), "lang").where("h = least OR pmod(h, 1073741824) < bound").dropDuplicates(["lang", "h"]).select("h", "lang", "text")
    found: dict[str, list[tuple[int, bytes, bytes]]] = {r.lang: [] for r in sizes}
    for r in picked.mapInArrow(_sample_batches, "h long, lang string, grams binary, counts binary").collect():
        found[r.lang].append((r.h, bytes(r.grams), bytes(r.counts)))
    centres, reaches = [], []
    for lang in sorted(found):
        mine = sorted(found[lang])
        counts = np.zeros((len(mine), WIDTH), np.float32)
        for row, (_, grams, n) in zip(counts, mine, strict=True):
            row[np.frombuffer(grams, np.uint16)] = np.frombuffer(n, np.uint32)
        x = model.vectors(counts)
        x = x[(x * x).sum(axis=1) > 0]
        if not len(x):
            continue
        c = spherical_kmeans(x, clusters, 12, seed)
        near = x @ c.T
        for j in range(len(c)):
            own = 1 - near[near.argmax(axis=1) == j, j]
            reaches.append(float(np.quantile(own, reach)) + slack if len(own) else slack)
            model.languages.append(lang)
        centres.append(c)
    model.centroids, model.reach = np.vstack([model.centroids, *centres]).astype(np.float32), np.array(reaches)
    return model


def _predict_batches(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = model.value.predict(utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
            ["doc_id", "lang_pred", "score", "rejected"],
        )


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of each document, from its text alone.

    Returns a row per row of docs: doc_id, lang_pred, score (cosine with the nearest centroid) and rejected (true if
    that is further than the centroid's reach). A null text, one without a letter, and every text if the model learnt
    nothing, is `und` with score 0, rejected. Of equal cosines the first centroid in language order counts. Repeated
    rows and null ids give a row each; empty docs give none. Other columns are ignored.
    """
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(partial(_predict_batches, model=sent), "doc_id long, lang_pred string, score double, rejected boolean")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")

"""Operator 4: a quality classifier by Naive Bayes support vectors.

The features are indicators of hashed n-grams: of the text's shape (runs of letters, capitals, digits, white space and
of each other character), of a marker that says whether a word repeats one of the eight before it, and of words. Each
indicator is scaled by its log-count ratio between the classes; dual coordinate descent fits a linear hinge-loss model
on the scaled indicators of a bounded sample of labelled rows; a logistic curve turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import held_out, packed, table
from quantloom.llm.text import arrow_rows, in_pieces, joined, keyed_text, mix, span_hash, utf8, word_bounds

FEATURES = 1 << 17
_SHAPES, _REPEATS = (1, 2, 3, 5), (4, 8, 16)

#: Letters, capitals, digits, line ends, other white space; every other ASCII character is a class of its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91], _CLASS[48:58], _CLASS[10] = 2, 3, 4
_CLASS[[9, 11, 12, 13, 32]] = 5


def _grams(values: np.ndarray, size: int, bits: int, salt: int) -> np.ndarray:
    h = np.zeros(len(values) - size + 1, np.uint64)
    for j in range(size):
        h = (h << np.uint64(bits)) | values[j : len(values) - size + 1 + j]
    return (mix(h + np.uint64(salt << 56)) & np.uint64(FEATURES - 1)).astype(np.int32)


def indicator_codes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each text."""
    stamp = np.empty(FEATURES, np.int32)
    for first, last in in_pieces(texts):
        buf, offsets = joined(texts[first:last])
        kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def add(codes: np.ndarray, size: int, firsts: np.ndarray, to=kinds) -> None:
            # n-grams that run into the next text are left out.
            to.append((codes, firsts[:-1], np.maximum(firsts[:-1], firsts[1:] - size + 1)))

        classes = _CLASS[buf]
        keep = np.concatenate(([True], classes[1:] != classes[:-1]))
        keep[offsets[:-1]] = True
        shape = classes[keep].astype(np.uint64)
        firsts = np.concatenate((np.zeros(1, np.int64), np.cumsum(keep)))[offsets]
        for n in _SHAPES:
            if len(shape) >= n:
                add(_grams(shape, n, 7, n), n, firsts)
        starts, ends = word_bounds(buf)
        words, firsts = span_hash(buf, starts, ends), np.searchsorted(starts, offsets)
        if len(words):
            text_of = np.repeat(np.arange(last - first), np.diff(firsts))
            again = np.zeros(len(words), bool)
            for k in range(1, 9):
                again[k:] |= (words[k:] == words[:-k]) & (text_of[k:] == text_of[:-k])
            for n in _REPEATS:
                if len(words) >= n:
                    add(_grams(again.astype(np.uint64), n, 1, 32 + n), n, firsts)
            add(_grams(words >> np.uint64(8), 1, 0, 64), 1, firsts)
            if len(words) > 1:
                add(_grams(words >> np.uint64(36), 2, 28, 65), 2, firsts)
        for i in range(last - first):
            codes = np.concatenate([codes[a[i] : b[i]] for codes, a, b in kinds])
            at = np.arange(len(codes), dtype=np.int32)
            stamp[codes] = at
            yield codes[stamp[codes] == at]


@dataclass
class QualityModel:
    """Weight of each indicator (log-count ratio included), bias, and the curve from margins to scores."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        margins = np.fromiter((self.weights[c].sum() / np.sqrt(len(c) + 1) + self.bias for c in indicator_codes(texts)), float, len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, width: int, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias; each row has columns (numbers) and their values, each sign is -1 or 1."""
    weights, bias, alpha = np.zeros(width), 0.0, np.zeros(len(rows))
    norm, rng = [float(v @ v) + 1 for v in values], np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, v, s = rows[i], values[i], signs[i]
            to = min(max(alpha[i] - (s * (weights[x] @ v + bias) - 1) / norm[i], 0.0), cost)
            if (step := to - alpha[i]) != 0.0:
                weights[x] += step * s * v
                bias += step * s
                alpha[i] = to
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def _curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    want, x = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)), np.stack((margins, np.ones(len(margins))), axis=1)
    c = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - want) + 1e-3 * (c - [1, 0]))
        c -= np.clip(step, -1, 1)
    return max(float(c[0]), 1e-3), float(c[1])


def fit(rows: list[np.ndarray], good: np.ndarray, *, cost: float = 1.0, epochs: int = 20, seed: int = 11) -> QualityModel:
    """rows: distinct feature numbers of each labelled text. Without both classes every score is their smoothed share."""
    n1, n0 = int(good.sum()), int((~good).sum())
    if not n1 or not n0:
        return QualityModel(np.zeros(FEATURES), 0.0, 1.0, float(np.log((n1 + 1) / (n0 + 1))))
    one, zero = np.ones(FEATURES), np.ones(FEATURES)
    for x, g in zip(rows, good, strict=True):
        (one if g else zero)[x] += 1
    ratio = np.log(one / (n1 + 2)) - np.log(zero / (n0 + 2))
    values = [ratio[x] / np.sqrt(len(x) + 1) for x in rows]
    weights, bias = dual_coordinate_descent(rows, values, np.where(good, 1.0, -1.0), FEATURES, cost, epochs, seed)
    slope, shift = _curve(np.array([weights[x] @ v + bias for x, v in zip(rows, values, strict=True)]), good)
    return QualityModel(weights * ratio, bias, slope, shift)


def _code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [c.tobytes() for c in indicator_codes(utf8(batch.column("text")))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(codes, pa.binary())], ["doc_id", "good", "codes"])


def _score_batches(batches: Iterator[pa.RecordBatch], model: Broadcast, field: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.struct_field(batch.column("row"), [field]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.value.scores(utf8(text)))], ["row", "score"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", sample_rows: int = 8000) -> QualityModel:
    """Learns from at most sample_rows labelled documents, those with the smallest hashes of their ids.

    Held-out ids (a fifth, by a checksum) are never learnt from. Labels other than 0 and 1 are ignored; an id with both
    counts as 0; of repeated ids one text counts, the first in order.
    """
    arrow_rows(docs.sparkSession)
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("good")).where("doc_id IS NOT NULL AND good IN (0, 1)").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # The sample has a bounded number of ids and labels.
    texts = keyed_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("good").alias("good"))
    found = texts.mapInArrow(_code_batches, "doc_id long, good int, codes binary").collect()
    found.sort(key=lambda r: r.doc_id)
    return fit([np.frombuffer(r.codes, np.int32) for r in found], np.array([r.good == 1 for r in found], bool))


def scored(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """A row (row, score) per row of docs: all of its columns as a struct, and its score from 0 to 1, higher for better ones.

    A null text counts as empty, whose score is that of the bare bias and line end. Repeated rows and ids give a row
    each; empty docs give none. No name of a column of docs can clash.
    """
    arrow_rows(docs.sparkSession)
    sent, rows = docs.sparkSession.sparkContext.broadcast(model), docs.select(packed(docs))
    return rows.mapInArrow(partial(_score_batches, model=sent, field=docs.columns.index(text_col)), rows.withColumn("score", F.lit(0.0)).schema)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """docs with a column score, see scored; one of that name is replaced."""
    found = scored(docs, model, text_col)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "score"], "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    found = score(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

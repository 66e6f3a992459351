"""Vectorised helpers on UTF-8 bytes that the operators share inside their tasks.

All of them work on one buffer that holds many texts, so that the cost per text stays small.
A null text counts as empty everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word of the pattern [^\x20\x09-\x0D]+ (the UTF-8 bytes of other characters are all word bytes).
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS = {"n": 0, "p": None, "inv": None}


def arrow_rows(spark: SparkSession, rows: int = 2000) -> None:
    """Bounds the rows of an Arrow batch, as texts may be long; a session setting that only ever shrinks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def keyed_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, by fixed names, so that other columns of docs can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a fixed odd number and of its inverse, modulo 2**64; kept per process."""
    if _POWERS["n"] < n:
        size = 1 << max(16, int(n - 1).bit_length())
        p, inv = np.full(size, _P), np.full(size, _INV)
        p[0] = inv[0] = 1
        _POWERS.update(n=size, p=np.multiply.accumulate(p), inv=np.multiply.accumulate(inv))
    return _POWERS["p"][:n], _POWERS["inv"][:n]


def word_bounds(buf: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word in a byte buffer."""
    if not buf.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.diff(np.concatenate(([True], space[buf], [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    p, inv = _powers(len(buf) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[: len(buf)], dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each closed by a newline, and the offset at which each starts (one more at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))


def in_pieces(texts: list[bytes], most: int = 1 << 21):
    """Runs (first, last exclusive) of texts of about this many bytes in all; a longer text makes a run of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)

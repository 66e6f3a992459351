"""Operator 13: periodic runs of words through a dictionary of basic factors.

The dictionary names every factor of 2**k words of a text, equal factors alike, by naming pairs of names of the level
below. At each level the next occurrence of each factor is looked up; those within twice the length that go on as an
arithmetic progression (the next but one is as far again) propose their distance as a period, which is extended as far
as words that far apart agree.

No run of exponent four or more is missed: with 2**k the next power of two from its period q, factors of that length
from its start on occur again q words on and not sooner, as q is its smallest period, and do so twice within the run.
For the same reason no proposed distance has a smaller period where it is extended. A factor that occurs once in a text
stays unique at all longer lengths, so only repeated ones go up a level, which in prose are few after the second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import table
from quantloom.llm.text import arrow_rows, in_pieces, joined, keyed_text, mix, span_hash, utf8, word_bounds

#: Words of a run, at least, and of its exponent.
LEAST_WORDS, LEAST_EXPONENT = 6, 4

RUNS = "array<struct<start:long,length:long,period:long>>"


def successors(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 64-bit keys at ascending places: the places whose keys occur more than once, their names, and the distance to the next (0: none)."""
    n = len(key)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    scrambled = mix(key)
    # Keys are sorted by their leading bits with the place below them; keys that agree in these without being equal are sorted in full.
    packed = np.sort((scrambled & ~low) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    alike = (packed[1:] ^ packed[:-1]) <= low
    same = key[order[1:]] == key[order[:-1]]
    if (alike & ~same).any():
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
    again, before = np.concatenate((same, [False])), np.concatenate(([False], same))
    name, far, kept = np.empty(n, np.int64), np.zeros(n, np.int64), np.empty(n, bool)
    name[order] = np.cumsum(~before)
    far[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
    kept[order] = again | before
    return at[kept], name[kept], far[kept]


def proposals(word: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods at which progressions of factors begin. word: a key per word that differs between texts; longest: words of the longest text."""
    places, periods, length = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    key, at = word, np.arange(len(word))
    while len(at) > 1:
        at, name, far = successors(key, at)
        distance, names = np.zeros(len(word) + 2 * length + 1, np.int64), np.full(len(word) + length, -1)
        distance[at], names[at] = far, name
        # Half the length and less have been proposed a level below.
        near = (2 * far > length) & (far <= 2 * length)
        place, period = at[near], far[near]
        goes_on = distance[place + period] == period
        place, period = place[goes_on], period[goes_on]
        fresh = np.concatenate(([True], (np.diff(place) != 1) | (np.diff(period) != 0)))[: len(place)]
        places.append(place[fresh])
        periods.append(period[fresh])
        other = names[at + length]
        key, at = (name.astype(np.uint64) << np.uint64(32) | other.astype(np.uint64))[other >= 0], at[other >= 0]
        length *= 2
        if length > longest // 2:
            break
    return np.concatenate(places), np.concatenate(periods)


def text_runs(word: np.ndarray, place: np.ndarray, period: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one text that its proposals lead to, by start, then period."""
    found = set()
    for q in np.unique(period).tolist():
        # Stretches over which words q apart agree.
        edge = np.diff(np.concatenate(([0], (word[q:] == word[:-q]).view(np.int8), [0])))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hit = np.unique(np.searchsorted(begins, place[period == q], "right") - 1)
        for a, b in zip(begins[hit].tolist(), ends[hit].tolist(), strict=True):
            if b + q - a >= max(LEAST_WORDS, LEAST_EXPONENT * q):
                found.add((a, b + q - a, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    buf, offsets = joined(texts)
    starts, ends = word_bounds(buf)
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    word = span_hash(buf, starts, ends)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(word):
        return out
    place, period = proposals(word ^ mix(owner + np.uint64(1)), int(counts.max()))
    of = np.searchsorted(bounds, place, "right") - 1
    for i in np.unique(of).tolist():
        mine = of == i
        out[i] = text_runs(word[bounds[i] : bounds[i + 1]], place[mine] - bounds[i], period[mine])
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats."""
    if runs:
        stays = np.ones(len(words), bool)
        for start, length, period in runs:
            stays[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        texts = utf8(batch.column("text"))
        for a, b in in_pieces(texts, 1 << 21):
            runs = runs_of(texts[a:b])
            words = [t.split() for t in texts[a:b]]
            told = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
            left = pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([len(w) for w in words], pa.int64()), pa.array(told, kind), left], ["doc_id", "n_words", "runs", "text"])


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The runs of words in each text and the text without their repeats.

    A run is a stretch of words with a smallest period q (words q apart agree) over at least four periods and six words
    that can't be made longer. Returns a row per row of docs: doc_id, n_words, runs (start and length in words and
    period, by start, then period) and text, the words joined by one space without those of a run after its first q.

    A null text has no words; a null or repeated id and repeated rows are rows like any other, each judged by its own
    text alone. Empty docs give no rows. Other columns are ignored, whatever their names. There is no shuffle, and a task holds
    about two megabytes of texts at a time, or one longer text.
    """
    arrow_rows(docs.sparkSession)
    return keyed_text(docs, id_col, text_col).mapInArrow(_run_batches, f"doc_id long, n_words long, runs {RUNS}, text string")


def _made_periodic(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts, by their ids, go on with a period from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.concat_ws(" ", F.slice(w, F.lit(1), a.cast("int")), F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(w, (a + i % p).cast("int"))))

    # The words are bound once, by an array of one element.
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(""))
    return F.when(h % 10 == 0, made[0]).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    told = F.sha2(F.concat(F.array_join(told, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("most"), told.alias("runs_sha256"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"))
    length, start, period = F.col("most.length"), -F.col("most.start"), -F.col("most.period")
    return found.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

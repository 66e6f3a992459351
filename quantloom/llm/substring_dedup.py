"""Operator 5: removal of repeated passages by matching statistics against suffix automata of reference shards.

A passage may repeat anywhere, so every document is a reference, and a broadcast of all of it would grow with the
corpus. The shards are therefore cut by content: each window of 13 words belongs to the shard of its minimizer (the
smallest hash among its 7-word grams), so equal windows always meet, and a shard is streamed only by the passages that
can match it. Documents are dealt into blocks; three exchanges of packed arrays run between blocks and shards:

1. each block sends its distinct minimizers to their shards, which answer which of them stand in two documents or more;
2. each block sends the distinct passages around those, with their smallest document; each shard builds one suffix
   automaton per minimizer over them, states holding the smallest document, and streams every passage through it;
3. the answer, the smallest document of each window, goes back to the block, which removes the words.

A block sends each minimizer or passage once however often it holds it, so that a passage in a third of all documents
costs a shard one entry per block. Where such a passage meets different neighbours, the minimizers at its edges have a
passage a document; no shard gathers these. With the minimizers a block sends how many passages each has here and a byte
of their digest; a minimizer with more than a bounded number of passages is answered as hot, and each of its windows then
goes out as a passage of its own, to the shard of the window's own hash.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import cut, table
from quantloom.llm.text import in_pieces, joined, keyed_text, mix, span_hash, utf8, word_bounds

_GRAM = 7
_LAST = np.iinfo(np.int64).max


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _window_hash(grams: np.ndarray, width: int) -> np.ndarray:
    """A hash of each width neighbouring grams, above all minimizers."""
    out = np.zeros(len(grams) - width + 1, np.uint64)
    for j in (0, width // 2, width - 1):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + grams[j : len(grams) - width + 1 + j])
    return (out >> np.uint64(2) | np.uint64(1 << 62)).view(np.int64)


class Passages:
    """The windows of a run of texts, grouped into passages of neighbours with one minimizer."""

    def __init__(self, texts: list[bytes], window: int):
        self.buf, offsets = joined(texts)
        self.starts, self.ends = word_bounds(self.buf)
        #: Number of the first word of each text, and one more at the end.
        self.first_word = np.searchsorted(self.starts, offsets)
        sizes = np.diff(self.first_word)
        n, gram = len(self.starts), min(_GRAM, window)
        if n < window:
            self.minimizer = self.begin = self.count = self.text_of = self.digest = np.zeros(0, np.int64)
            return
        word = span_hash(self.buf, self.starts, self.ends)
        grams = np.zeros(n - gram + 1, np.uint64)
        for j in range(gram):
            grams = grams * np.uint64(0xD6E8FEB86659FD93) + word[j : n - gram + 1 + j]
        least = _sliding_min(mix(grams) >> np.uint64(2), window - gram + 1).view(np.int64)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        at = np.flatnonzero(text_of[: n - window + 1] == text_of[window - 1 :])
        value, owner = least[at], text_of[at]
        fresh = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))) if len(at) else np.zeros(0, np.int64)
        #: Hash of each window by its first word, and of each passage by its windows.
        self.window_hash = _window_hash(grams, window - gram + 1)
        #: For each passage its minimizer, its first window's first word, its number of windows and its text.
        self.minimizer, self.begin, self.text_of = value[fresh], at[fresh], owner[fresh]
        self.count = np.diff(np.concatenate((fresh, [len(at)])))
        self.digest = np.add.reduceat(self.window_hash[at], fresh) if len(at) else np.zeros(0, np.int64)


def _shard(minimizer: np.ndarray, shards: int) -> np.ndarray:
    return minimizer % shards


def _block(group: pa.Table) -> tuple[int, np.ndarray, list[bytes]]:
    """Number of the block, and its documents' ids (null as the largest) and texts in a fixed order."""
    ids = group.column("doc_id").fill_null(_LAST).to_numpy()
    texts = [x for chunk in group.column("text").chunks for x in utf8(chunk)]
    return group.column("block")[0].as_py(), ids, texts


def minimizers_of_block(ids: np.ndarray, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimizers of a block, which of them stand in texts of different ids, how many further distinct passages each has (255 at most), and a byte of its first passage's digest."""
    values, docs, digests = [], [], []
    for a, b in in_pieces(texts):
        p = Passages(texts[a:b], window)
        values.append(p.minimizer)
        docs.append(ids[a:b][p.text_of] if len(p.text_of) else np.zeros(0, np.int64))
        digests.append(p.digest)
    value, doc, digest = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (values, docs, digests))
    distinct, group = np.unique(value, return_inverse=True)
    if not len(distinct):
        return distinct, np.zeros(0, bool), np.zeros(0, np.uint8), np.zeros(0, np.uint8)
    order = np.lexsort((doc, group))
    at = np.searchsorted(group[order], np.arange(len(distinct)))
    last = np.concatenate((at[1:], [len(value)])) - 1
    several = doc[order][at] != doc[order][last]
    order = np.lexsort((digest, group))
    digest = digest[order]
    fresh = np.concatenate(([True], (digest[1:] != digest[:-1]) | (group[order][1:] != group[order][:-1])))
    more = np.add.reduceat(fresh.astype(np.int64), at) - 1
    return distinct, several, np.minimum(more, 255).astype(np.uint8), (digest[at] & 255).astype(np.uint8)


def _ask_minimizers(group: pa.Table, window: int, shards: int) -> pa.Table:
    block, ids, texts = _block(group)
    columns = minimizers_of_block(ids, texts, window)
    shard = _shard(columns[0], shards)
    order = np.argsort(shard, kind="stable")
    shard, (value, several, more, digest) = shard[order], (c[order] for c in columns)
    firsts = np.flatnonzero(np.diff(shard, prepend=-1))
    lasts = np.append(firsts[1:], len(shard))[: len(firsts)]
    runs = list(zip(firsts, lasts, strict=True))
    return pa.table(
        {
            "shard": pa.array(shard[firsts], pa.int64()),
            "block": pa.array(np.full(len(firsts), block), pa.int64()),
            "value": pa.array([value[a:b].tobytes() for a, b in runs], pa.binary()),
            "several": pa.array([np.packbits(several[a:b]).tobytes() for a, b in runs], pa.binary()),
            "more": pa.array([more[a:b].tobytes() for a, b in runs], pa.binary()),
            "digest": pa.array([digest[a:b].tobytes() for a, b in runs], pa.binary()),
        }
    )


def hot_minimizers(value: np.ndarray, more: np.ndarray, digest: np.ndarray, hot_passages: int) -> np.ndarray:
    """Minimizers that may have over hot_passages distinct passages, from a row per block and minimizer.

    The passages of a block beyond its first count as distinct, the first ones by their digests' bytes; from 64 bytes
    on, which say too little of the number, each block's first passage counts.
    """
    every, group, times = np.unique(value, return_inverse=True, return_counts=True)
    kinds = np.bincount(np.unique(group.astype(np.int64) * 256 + digest) // 256, minlength=len(every))
    further = np.bincount(group, weights=more, minlength=len(every))
    return every[np.where(kinds < 64, kinds, times) + further > hot_passages]


def _answer_minimizers(group: pa.Table, hot_passages: int) -> pa.Table:
    """For each block the minimizers of this shard that repeat, and which of these are hot."""
    values = [np.frombuffer(x, np.int64) for x in group.column("value").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(v)).astype(bool) for x, v in zip(group.column("several").to_pylist(), values, strict=True)]
    more, digest = (np.concatenate([np.frombuffer(x, np.uint8) for x in group.column(c).to_pylist()]) for c in ("more", "digest"))
    every, times = np.unique(np.concatenate(values), return_counts=True)
    repeats = np.union1d(every[times > 1], np.concatenate([v[s] for v, s in zip(values, several, strict=True)]))
    hot = hot_minimizers(np.concatenate(values), more, digest, hot_passages)
    mine = [v[np.isin(v, repeats, assume_unique=True)] for v in values]
    return pa.table({"block": group.column("block"), "value": pa.array([v.tobytes() for v in mine], pa.binary()), "hot": pa.array([v[np.isin(v, hot, assume_unique=True)].tobytes() for v in mine], pa.binary())})


def repeated_passages(ids: np.ndarray, texts: list[bytes], repeats: np.ndarray, hot: np.ndarray, window: int):
    """Passages of a block around repeated minimizers, piece by piece: the texts' range, its Passages, and those passages' first words, numbers of windows, texts and keys.

    A hot minimizer's windows are passages of their own, keyed by their hashes.
    """
    for a, b in in_pieces(texts):
        p = Passages(texts[a:b], window)
        hit = np.flatnonzero(np.isin(p.minimizer, repeats))
        begin, count, text_of, value = p.begin[hit], p.count[hit], p.text_of[hit], p.minimizer[hit]
        split = np.isin(value, hot)
        if split.any():
            times = np.where(split, count, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            split, begin = np.repeat(split, times), np.repeat(begin, times) + step
            count = np.where(split, 1, np.repeat(count, times))
            text_of, value = np.repeat(text_of, times), np.repeat(value, times)
            value = np.where(split, p.window_hash[begin], value)
        starts, ends = p.starts[begin], p.ends[begin + count + window - 2] if len(begin) else begin
        keys = [(v, b" ".join(p.buf[x:y].tobytes().split())) for v, x, y in zip(value.tolist(), starts.tolist(), ends.tolist(), strict=True)]
        yield a, b, p, begin, count, text_of, keys


def _numbers(answers: pa.Table, column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in answers.column(column).to_pylist()]])


def _ask_passages(docs: pa.Table, answers: pa.Table, window: int, shards: int) -> pa.Table:
    kind = {"shard": pa.int64(), "block": pa.int64(), "value": pa.list_(pa.int64()), "passage": pa.list_(pa.binary()), "doc": pa.list_(pa.int64()), "hot": pa.binary()}
    rows: dict[str, list] = {k: [] for k in kind}
    if docs.num_rows and answers.num_rows:
        block, ids, texts = _block(docs)
        least: dict[tuple[int, bytes], int] = {}
        hot = _numbers(answers, "hot")
        for a, b, _, _, _, text_of, keys in repeated_passages(ids, texts, _numbers(answers, "value"), hot, window):
            for k, doc in zip(keys, ids[a:b][text_of].tolist(), strict=True):
                if doc < least.get(k, _LAST + 1):
                    least[k] = doc
        by_shard = defaultdict(list)
        for k in sorted(least):
            by_shard[k[0] % shards].append(k)
        for shard, keys in by_shard.items():
            for column, x in zip(rows.values(), (shard, block, [k[0] for k in keys], [k[1] for k in keys], [least[k] for k in keys], b"" if rows["hot"] else hot.tobytes()), strict=True):
                column.append(x)
    return pa.table({k: pa.array(rows[k], t) for k, t in kind.items()})


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state holds the smallest document that its words end in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [_LAST]

    def add(self, words: list[bytes], doc: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)
            self.least[last] = min(self.least[last], doc)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        cur = self._state({}, -1, length[last] + 1, _LAST)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: bytes) -> int:
        new = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, _LAST)
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def _state(self, following: dict, link: int, length: int, least: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(least)
        return len(self.link) - 1

    def close(self) -> None:
        """Hands each state's smallest document on to the states of its suffixes."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            self.least[up] = min(self.least[up], self.least[s])

    def statistics(self, words: list[bytes], window: int) -> list[int]:
        """For each window of words the smallest document it stands in (_LAST: none).

        Streams the words for their matching statistics, the longest match that ends at each word, held at window.
        """
        state, size, out = 0, 0, []
        nxt, link, length = self.next, self.link, self.length
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state, size = nxt[state][w], size + 1
            if size > window:
                size = window
            while length[link[state]] >= size and state and link[state] > 0:
                state = link[state]
            if i >= window - 1:
                out.append(self.least[state] if size == window else _LAST)
        return out


def shard_answers(keys: list[tuple[int, bytes]], docs: list[int], window: int) -> dict[tuple[int, bytes], list[int]]:
    """For each passage (minimizer, words) the smallest document of each of its windows, or one number if they agree."""
    least: dict[int, dict[bytes, int]] = defaultdict(dict)
    for (value, passage), doc in zip(keys, docs, strict=True):
        of = least[value]
        of[passage] = min(of.get(passage, _LAST), doc)
    out = {}
    for value, of in least.items():
        automaton = SuffixAutomaton()
        split = {p: p.split(b" ") for p in sorted(of)}
        for p, words in split.items():
            automaton.add(words, of[p])
        automaton.close()
        for p, words in split.items():
            found = automaton.statistics(words, window)
            out[value, p] = found[:1] if len(set(found)) == 1 else found
    return out


def _answer_passages(group: pa.Table, window: int) -> pa.Table:
    """For each block the keys' numbers of its passages here, in the order in which it sent them, its hot minimizers, and the packed answers: how many numbers each passage has, and the numbers."""
    values, passages, docs = (group.column(c).to_pylist() for c in ("value", "passage", "doc"))
    keys = [list(zip(v, p, strict=True)) for v, p in zip(values, passages, strict=True)]
    answers = shard_answers([k for ks in keys for k in ks], [d for ds in docs for d in ds], window)
    found = [[answers[k] for k in ks] for ks in keys]
    packed = {
        "value": [np.array(v, np.int64).tobytes() for v in values],
        "sizes": [np.fromiter(map(len, of), np.int32, len(of)).tobytes() for of in found],
        "least": [np.array([d for one in of for d in one], np.int64).tobytes() for of in found],
    }
    return pa.table({"block": group.column("block"), "shard": group.column("shard"), "hot": group.column("hot"), **{k: pa.array(v, pa.binary()) for k, v in packed.items()}})


def _matched(keys: list[tuple[int, bytes]], answers: pa.Table, shards: int) -> dict[tuple[int, bytes], list[int]]:
    """The answer of each distinct passage of a block: a shard answers in the passages' order."""
    by_shard = defaultdict(list)
    for k in sorted(set(keys)):
        by_shard[k[0] % shards].append(k)
    out = {}
    for shard, sizes, least in zip(*(answers.column(c).to_pylist() for c in ("shard", "sizes", "least")), strict=True):
        ends, numbers = np.cumsum(np.frombuffer(sizes, np.int32)).tolist(), np.frombuffer(least, np.int64).tolist()
        for k, a, b in zip(by_shard[shard], [0, *ends[:-1]], ends, strict=True):
            out[k] = numbers[a:b]
    return out


def _remove(docs: pa.Table, answers: pa.Table, window: int, shards: int) -> pa.Table:
    """The kept words of each document of a block."""
    columns: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "kept_sha256": []}
    if docs.num_rows:
        _, ids, texts = _block(docs)
        hot = _numbers(answers, "hot")
        pieces = list(repeated_passages(ids, texts, np.union1d(_numbers(answers, "value"), hot), hot, window))
        least = _matched([k for *_, keys in pieces for k in keys], answers, shards)
        for a, b, p, begins, counts, text_of, keys in pieces:
            gone = np.zeros(len(p.starts) + 1, np.int32)
            owner = ids[a:b][text_of] if len(text_of) else np.zeros(0, np.int64)
            for k, doc, begin, count in zip(keys, owner.tolist(), begins.tolist(), counts.tolist(), strict=True):
                found = least[k]
                if len(found) == 1:
                    if found[0] < doc:
                        gone[begin] += 1
                        gone[begin + count + window - 1] -= 1
                else:
                    for j, first in enumerate(found):
                        if first < doc:
                            gone[begin + j] += 1
                            gone[begin + j + window] -= 1
            lost = np.cumsum(gone[:-1]) > 0
            for i in range(b - a):
                f, l = p.first_word[i], p.first_word[i + 1]
                words, mask = texts[a + i].split(), lost[f:l]
                kept = b" ".join(words) if not mask.any() else b" ".join([w for w, x in zip(words, mask.tolist(), strict=True) if not x])
                for column, x in zip(list(columns.values())[1:], (len(words), int(mask.sum()), kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(x)
        columns["doc_id"] = docs.column("doc_id").to_pylist()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    out = pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), kinds, strict=True)})
    return out.set_column(3, "kept", out.column("kept").cast(pa.string()))


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block_chars: int = 2 << 20, shard_chars: int = 8 << 20, hot_passages: int = 128) -> DataFrame:
    """Documents without the words of passages that also start in a document with a smaller id.

    Returns a row per row of docs: doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and
    kept_sha256. A word goes if a window of 13 words that covers it stands in a document with a smaller id; windows are
    judged on the input.

    A null text counts as empty; a text of fewer than 13 words has no window and stays. Rows with one id never remove
    each other's words, repeated rows included. A null id counts as the largest long. Empty docs give no rows.
    Other columns are ignored.

    block_chars and shard_chars are about the text of a block and of a shard; a longer document makes a block larger.
    hot_passages (255 at most) bounds the distinct passages of a minimizer that a shard gathers.
    """
    rows = keyed_text(docs, id_col, text_col)
    total = int(rows.agg(F.sum(F.length("text"))).first()[0] or 0)
    blocks, shards = max(64, total // block_chars), max(64, total // shard_chars)
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text")).withColumn("block", F.pmod(F.col("row"), F.lit(blocks)))
    of_block = rows.groupBy("block")
    asked = of_block.applyInArrow(lambda group: _ask_minimizers(group, window, shards), "shard long, block long, value binary, several binary, more binary, digest binary")
    repeats = asked.groupBy("shard").applyInArrow(lambda group: _answer_minimizers(group, hot_passages), "block long, value binary, hot binary")
    passages = of_block.cogroup(repeats.groupBy("block")).applyInArrow(
        lambda key, left, right: _ask_passages(left, right, window, shards), "shard long, block long, value array<bigint>, passage array<binary>, doc array<bigint>, hot binary"
    )
    least = passages.groupBy("shard").applyInArrow(lambda group: _answer_passages(group, window), "block long, shard long, hot binary, value binary, sizes binary, least binary")
    return of_block.cogroup(least.groupBy("block")).applyInArrow(lambda key, left, right: _remove(left, right, window, shards), "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT h, min(doc_id) AS least FROM g GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN f USING (h) WHERE f.least < g.doc_id),
x AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id),
k AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN x USING (doc_id)),
e AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM e ANTI JOIN r USING (doc_id, i) GROUP BY doc_id)
SELECT k.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN t USING (doc_id)
"""

"""64-bit SimHash fingerprints of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from quantloom.llm.text import utf8

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: For each byte value, its eight bits spread over the eight bytes of a word, so that up to 255 bytes can be added lane by lane.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64).ravel()


def shingle_hashes(text: bytes, size: int, seed: int) -> list[int]:
    words = text.translate(_LOWER).split()
    if not words:
        return []
    whole = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(whole, seed)]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    digest = xxhash.xxh64_intdigest
    return [digest(whole[a:b], seed) for a, b in zip((ends - lens)[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)]


def simhash(hashes: list[list[int]]) -> np.ndarray:
    """For each list of 64-bit hashes the value whose bits are set in over half of them; 0 for an empty list."""
    out = np.zeros(len(hashes), np.uint64)
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    if not counts.sum():
        return out
    flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, int(counts.sum()))
    begins = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    full = np.flatnonzero(counts)
    # Steps of at most 255 hashes of one text, as each lane holds a byte.
    steps, owner = [], []
    for i in full.tolist():
        s = np.arange(begins[i], begins[i + 1], 255)
        steps.append(s)
        owner.append(np.full(len(s), i))
    steps, owner = np.concatenate(steps), np.concatenate(owner)
    lanes = _LANES[flat.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, steps, axis=0).view(np.uint8).reshape(len(steps), 64).astype(np.int64)
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    votes = np.add.reduceat(sums, firsts, axis=0)
    bits = (2 * votes > counts[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint_batches(batches: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, text, by fp, a few hundred texts at a time."""
    for batch in batches:
        texts, others = utf8(batch.column("text")), batch.drop_columns(["text"])
        for a in range(0, len(texts), 256):
            part = texts[a : a + 256]
            fps = simhash([shingle_hashes(t, size, seed) for t in part])
            yield others.slice(a, len(part)).append_column("fp", pa.array(fps.view(np.int64)))

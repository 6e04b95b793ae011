"""Whole Arrow batches of text as flat numpy arrays: words, rolling hashes and their slices.

All work is vectorised over a slice of a batch of about a million bytes, so memory is bounded by that size or by
the longest single text. Hashes are 64 bits: polynomial prefix sums modulo 2**64, then a finalising mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i below ``n`` at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 65_536)
        up = np.full(size, base % 2**64, U)
        down = np.full(size, pow(base, -1, 2**64), U)
        up[0] = down[0] = 1
        have = _POWERS[base] = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)
    return have


def release() -> None:
    """Gives back what earlier tasks left in this worker: tables of powers and Arrow's unused memory."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()


class Rolling:
    """Hash of any slice of a sequence of numbers in constant time."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum((values.astype(U) + U(1)) * self.up[: len(values)], dtype=U, out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sum over ``start <= i < end`` of value times ``base**(i - start)``, not mixed."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (np.asarray(end) - np.asarray(start)).astype(U) * U(0xD6E8FEB86659FD93))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts hold about ``limit`` bytes together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield batch.slice(start)


def flat(texts: pa.Array, separator: str = "") -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts (null: empty), each followed by ``separator``, and the offset of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if separator:
        texts = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(separator, pa.large_string()))
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with each ``text`` compressed by itself as ``body_``, last, for shuffles of whole texts."""
    codec = pa.Codec("zstd", compression_level=3)
    for whole in batches:
        for batch in slices(whole, "text"):
            raw = (None if x is None else x.encode() for x in batch.column("text").to_pylist())
            body = [None if x is None else len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in raw]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(body, pa.binary())], [*rest, "body_"])


def unpack(batches: Iterator[pa.RecordBatch], rows: int = 100) -> Iterator[pa.RecordBatch]:
    """The batches with ``body_`` as ``text`` again, in its place, a few rows at a time."""
    codec = pa.Codec("zstd")
    for whole in batches:
        for k in range(0, len(whole), rows):
            batch = whole.slice(k, rows)
            bodies = batch.column("body_").to_pylist()
            texts = [None if x is None else codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in bodies]
            text = pa.array(texts, pa.binary()).cast(pa.string())
            names = ["text" if c == "body_" else c for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([text if c == "text" else batch.column(c) for c in names], names)


def lower(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[raw]


class Words:
    """Words (runs of bytes that aren't in ``gaps``) of a column: start, end, hash, and offsets by row.

    Gaps are space and ``\\t`` to ``\\r`` unless given; a space must be one of them.
    """

    def __init__(self, texts: pa.Array, fold: bool = True, gaps: np.ndarray = _SPACE):
        raw, at = flat(texts, " ")
        self.bytes, self.at = lower(raw) if fold else raw, at
        inside = ~gaps[raw]
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)  # a separator ends the last word of each text
        self.offsets = np.searchsorted(self.start, at)
        self.hash = Rolling(self.bytes).hash(self.start, self.end)
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(self.offsets))

    def text(self, i: int) -> str:
        return self.bytes[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


_MULTIPLIERS = [U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def shingles(words: Words, size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than ``size`` make one shingle, no words none."""
    n = len(words.hash)
    joined = np.zeros(max(0, n - size + 1), U)
    for k in range(size):
        joined = mix(joined + words.hash[k : n - size + 1 + k] * _MULTIPLIERS[k % 5]) if len(joined) else joined
    for a, b in zip(words.offsets[:-1], words.offsets[1:]):
        if b - a >= size:
            yield np.unique(joined[a : b - size + 1])
        elif b > a:
            one = np.zeros(1, U)
            for k in range(a, b):
                one = mix(one + words.hash[k : k + 1] * _MULTIPLIERS[(k - a) % 5])
            yield one + U(b - a)
        else:
            yield np.zeros(0, U)

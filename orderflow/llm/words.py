"""Words of many texts at once, as 64-bit hashes, with numpy on the UTF-8 bytes of an Arrow column.

A word class is given by its separator bytes, all ASCII, so that every byte of a multi-byte character belongs to a
word. The hash of a byte range is a difference of running sums of random byte values times powers of an odd base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)  # an odd base of full order


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordClass:
    """Words between separator bytes, A-Z taken as a-z."""

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        fold = np.arange(256, dtype=np.uint64)
        fold[65:91] += 32
        self.value = _mixed(fold + np.uint64(1))
        self.power = self.inverse = None

    def __getstate__(self):
        return self.__dict__ | {"power": None, "inverse": None}

    def _chunks(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges that no word crosses; a word longer than a chunk makes a longer range."""
        start = 0
        while start < len(data):
            end = start + CHUNK
            while end < len(data):
                gap = np.flatnonzero(~self.inside[data[end : end + 65536]])
                if len(gap):
                    end += int(gap[0])
                    break
                end += 65536
            yield start, min(end, len(data))
            start = min(end, len(data))

    def _sums(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums with a leading 0, and the inverse powers of the base."""
        if self.power is None:
            self.power, self.inverse = _powers(int(_BASE)), _powers(pow(int(_BASE), -1, 1 << 64))
        power, inverse = self.power, self.inverse
        while len(power) < len(part):  # only for a word longer than a chunk
            n = np.uint64(pow(int(_BASE), len(power), 1 << 64)), np.uint64(pow(int(_BASE), -len(inverse), 1 << 64))
            power, inverse = np.concatenate([power, power * n[0]]), np.concatenate([inverse, inverse * n[1]])
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(self.value[part] * power[: len(part)], out=sums[1:])
        return sums, inverse

    def _scan(self, data: np.ndarray, offsets: np.ndarray, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
        for start, end in self._chunks(data):
            part = data[start:end]
            inside = self.inside[part]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            cuts = offsets[np.searchsorted(offsets, start, "right") : np.searchsorted(offsets, end)] - start
            first[cuts] = inside[cuts]
            after = np.ones(len(part), bool)
            after[:-1] = ~inside[1:]
            after[cuts - 1] = True
            begins, ends = np.flatnonzero(first), np.flatnonzero(inside & after) + 1
            sums, inverse = self._sums(part)
            words = _mixed((sums[ends] - sums[begins]) * inverse[begins])
            docs = np.searchsorted(offsets, begins + start, "right") - 1
            if not gram:
                yield words, docs
                continue
            # all runs of ``gram`` bytes inside words
            many = np.maximum(ends - begins - gram + 1, 0)
            at = np.repeat(begins - (np.cumsum(many) - many), many) + np.arange(many.sum())
            yield words, docs, _mixed((sums[at + gram] - sums[at]) * inverse[at] + np.uint64(gram)), np.repeat(docs, many)

    def hashes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes of all texts in order, words per text)."""
        data, offsets = utf8(texts)
        found = list(self._scan(data, offsets, 0))
        words = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.uint64)
        docs = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
        return words, np.bincount(docs, minlength=len(texts)).astype(np.int64)

    def features(self, texts: pa.Array, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hash, text number) of words and of all runs of ``gram`` bytes inside words, chunk by chunk."""
        data, offsets = utf8(texts)
        for words, docs, grams, gram_docs in self._scan(data, offsets, gram):
            yield np.concatenate([words, grams]), np.concatenate([docs, gram_docs])


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls empty, and the start of every text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(texts) == 0:
        return data[:0], np.zeros(0, np.int64)
    return data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``size`` bytes of text, or one longer text, and at most ``rows`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        length = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(length)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, end - start)
            start = end


#: Words of letters a-z, digits and all characters beyond ASCII.
ALPHANUMERIC = WordClass(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Words between white space.
SPACED = WordClass(bytes([0x20, *range(0x09, 0x0E)]))

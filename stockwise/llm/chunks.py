"""Ids of text chunks, learned once per distinct chunk in each worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def ragged(values: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``which`` of a ragged array (row i is ``values[ends[i]:ends[i + 1]]``)
    joined, and where each starts and the last ends."""
    count = np.diff(ends)[which]
    upto = np.concatenate([[0], np.cumsum(count)])
    return values[np.repeat(ends[which] - upto[:-1], count) + np.arange(upto[-1])], upto


class ChunkTable:
    """Distinct chunks with their ids; starts anew when it holds ``most``.
    ``learn`` gets new chunks and returns them in any order, their ids joined and
    the number of ids of each."""

    def __init__(self, learn: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]], most: int) -> None:
        self.learn, self.most = learn, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)

    def _add(self, chunks: list[str]) -> None:
        n = len(self.index)
        chunks, flat, count = self.learn(chunks)
        self.index.update(zip(chunks, range(n, n + len(chunks))))
        upto = self.ends[n] + np.cumsum(count)
        while n + len(chunks) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while upto[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.ends[n]:upto[-1]] = flat
        self.ends[n + 1:n + 1 + len(chunks)] = upto

    def ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All chunks' ids joined, and where each chunk's start and the last end."""
        coded = pc.dictionary_encode(chunks)
        words = coded.dictionary.to_pylist()
        if len(self.index) > self.most:
            self.clear()
        fresh = [w for w in words if w not in self.index]
        if fresh:
            self._add(fresh)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        return ragged(self.flat, self.ends, at[np.asarray(coded.indices)])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large_string texts, and where each starts and the last ends."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def chunk_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data)))


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    size = np.asarray(pc.binary_length(texts), np.int64)
    start, total = 0, 0
    for i, n in enumerate(size):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(size):
        yield start, len(size)

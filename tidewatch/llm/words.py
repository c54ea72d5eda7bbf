"""Words of whole Arrow batches of texts, found and hashed by array arithmetic on their bytes.

A batch is cut into runs of documents of a few megabytes, so that memory does not
depend on how many rows a batch holds; one document is never cut.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15


def byte_class(inside) -> np.ndarray:
    """A table over all byte values of those that belong to words."""
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``; bytes of longer code points are never blanks.
NOT_BLANK = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, after lower-casing A-Z.
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    up = np.full(size, _ODD, dtype=np.uint64)
    down = np.full(size, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of a run of documents: ``first`` holds each document's first word number."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    rows: slice

    def __len__(self) -> int:
        return len(self.starts)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, equal for equal words in any batch."""
        up, down = _powers(1 << max(20, int(len(self.data)).bit_length()))
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * up[: len(self.data)], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def text(self, a: int, b: int) -> list[str]:
        """Words ``a`` up to ``b`` of the run."""
        return [self.data[s:e].tobytes().decode() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True)]


def words_of(texts: pa.Array, inside: np.ndarray, lower: bool, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """Words of a string column, run by run. A null text has none."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1)
        part, cuts = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        part = LOWER[part] if lower else part
        # A blank in front of and behind each side, and cuts between documents.
        word = np.zeros(len(part) + 2, dtype=bool)
        word[1:-1] = inside[part]
        before, after = word[:-2].copy(), word[2:].copy()
        own = cuts[:-1][cuts[:-1] < cuts[1:]]
        before[own] = False
        after[cuts[1:][cuts[:-1] < cuts[1:]] - 1] = False
        starts = np.flatnonzero(word[1:-1] & ~before)
        ends = np.flatnonzero(word[1:-1] & ~after) + 1
        yield Words(part, starts, ends, np.searchsorted(starts, cuts), slice(at, to))
        at = to


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, documents' borders not minded."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for j in range(1, size):
        out = out * np.uint64(_ODD) + words[j : j + n]
    return mixed(out ^ np.uint64(size))


def window_minima(h: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` neighbours the place of its smallest value, the leftmost of equal ones."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    value, place, width = h, np.arange(len(h)), 1
    while width < size:
        step = min(width, size - width)
        left, right = value[:-step], value[step:]
        place = np.where(right < left, place[step:], place[:-step])
        value = np.minimum(left, right)
        width += step
    return place

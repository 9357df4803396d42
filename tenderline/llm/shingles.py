"""Sets of hashed word shingles, many texts at a time in numpy.

A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a shingle is five neighbouring words; a text
with fewer words has its whole word sequence as its one shingle, a text without words has none.
Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from tenderline.llm.common import mixed, powers

WIDTH = 5
#: Bytes hashed at a time; a longer text is hashed on its own.
CHUNK = 1 << 20
_BASE = 0xD6E8FEB86659FD93
_STEPS = mixed(np.arange(1001, 1001 + WIDTH, dtype=np.uint64)) | np.uint64(1)


@lru_cache(maxsize=1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = mixed(np.arange(1, 257, dtype=np.uint64))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values, powers(_BASE, size), powers(pow(_BASE, -1, 1 << 64), size)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _hashed(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = b"\n" + b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    values, up, down = _tables(max(CHUNK + (1 << 16), 1 << (len(data) + 1).bit_length()))
    edge = np.diff(_SPACE[raw].astype(np.int8))
    first, last = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=sums[1:])
    word = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    cut = np.concatenate(([0], np.searchsorted(first, ends)))
    runs = len(word) - WIDTH + 1
    if runs > 0:
        joined = np.zeros(runs, dtype=np.uint64)
        for i in range(WIDTH):
            joined += word[i : i + runs] * _STEPS[i]
        joined = mixed(joined)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        n = b - a
        if n >= WIDTH:
            own = joined[a : b - WIDTH + 1].copy()
            own.sort()
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            own = np.uint64(n)
            with np.errstate(over="ignore"):
                for i in range(n):
                    own = own + word[a + i] * _STEPS[i]
            out.append(mixed(np.array([own], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in order."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > CHUNK:
            yield from _hashed(held)
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield from _hashed(held)


def set_id(own: np.ndarray) -> int:
    """A 64-bit name of a set, the same for equal sets."""
    total = np.array([np.sum(mixed(own + np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(own))], dtype=np.uint64)
    return int(mixed(total).view(np.int64)[0])

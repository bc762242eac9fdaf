"""Whole-batch word and shingle hashing over UTF-8 bytes.

A word is a run of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased. Hashes are 64-bit: a
polynomial over random values per byte, taken from one running sum for all texts of a slice, then
mixed. Work is in slices of a few MB of text, so memory doesn't depend on the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
SLICE = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(_rng.integers(1, 2**62)) * 4 + 1
_AT = _rng.integers(1, 2**63, 16, dtype=U) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []
_KEPT = SLICE * 5 // 4


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64. Those for usual slices are kept, longer ones made anew."""

    def made(size: int) -> tuple[np.ndarray, ...]:
        steps = [np.full(size, U(base & (2**64 - 1))) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
        for s in steps:
            s[0] = U(1)
            np.multiply.accumulate(s, out=s)
        return tuple(steps)

    if n > _KEPT:
        return made(n)
    if not _powers:
        _powers.extend(made(_KEPT))
    return _powers[0][:n], _powers[1][:n]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, end, UTF-8 texts) of runs of texts of about ``SLICE`` bytes; null is empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > SLICE:
            yield first, i, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, len(texts), held


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the texts in order, number of words before each text and in all)."""
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers(len(data) + 1)
    total = np.empty(len(data) + 1, U)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts])
    begins = np.cumsum([1, *(len(r) + 1 for r in raw)])
    return words, np.searchsorted(starts, begins)


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """For every text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words has its whole word sequence as its one shingle; one without words, or null,
    has none.
    """
    for _, _, raw in slices(texts):
        words, bounds = word_hashes(raw)
        n = len(words) - width + 1
        grams = mix(sum((words[k : k + n] * _AT[k] for k in range(1, width)), words[:n] * _AT[0])) if n > 0 else words[:0]
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= width:
                own = np.sort(grams[lo : hi - width + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own
            elif hi > lo:
                yield mix((words[lo:hi] * _AT[: hi - lo]).sum(keepdims=True, dtype=U) + U(hi - lo))
            else:
                yield words[:0]

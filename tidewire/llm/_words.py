"""Words, word hashes and word shingles, for the operators that compare texts by shingles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

#: A word is a maximal run of letters and digits of the lower-cased text.
WORD = re.compile(r"[^\W_]+")

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@cache
def _is_word() -> np.ndarray:
    """For each code point, whether ``WORD`` takes it."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(length, _BASE, U64))
    down = np.cumprod(np.full(length, pow(_BASE, -1, 1 << 64), U64))
    return up, down


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """The hashes of ``words_of`` each text, without making the words.

    The hash of a word is a polynomial of its code points mod 2^64, read off
    running sums over all texts at once, then mixed.
    """
    lowered = [t.lower() if t else "" for t in texts]
    c = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _is_word()[c]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    up, down = _powers(1 << max(16, int(len(c)).bit_length()))
    total = np.cumsum(c * up[: len(c)])
    h = mixed((total[end - 1] - total[start - 1]) * down[start])
    bounds = np.cumsum([1, *(len(t) + 1 for t in lowered)])
    return np.split(h, np.searchsorted(start, bounds[1:-1])) if lowered else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, in text order; the whole text if it is shorter."""
    k = min(k, len(hashes))
    if not k:
        return np.empty(0, U64)
    n = len(hashes) - k + 1
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * U64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mixed(out)


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd factors: x -> x * a mod 2^64 orders mixed hashes anew for each of them."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, count, dtype=U64) | U64(1)


def portions(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Lists of consecutive items of about ``limit`` weight together, so that batches of long texts stay small."""
    part, total = [], 0
    for x in items:
        part.append(x)
        total += weight(x)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def values_of(column) -> Iterator:
    """The values of an Arrow array, made a few at a time: a batch may hold many long texts."""
    for first in range(0, len(column), 250):
        yield from column.slice(first, 250).to_pylist()

"""Words of many texts at once, and hashes of runs of words, in numpy.

Works on the UTF-8 bytes of an Arrow column; white space is one of six ASCII bytes, so
no character is ever cut.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import threading
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = map(U, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators other than white space: ASCII but letters, and ASCII but letters and digits.
NOT_LETTERS = np.zeros(256, bool)
NOT_LETTERS[:128] = [not chr(b).isalpha() for b in range(128)]
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text that are scanned at once.
BLOCK = 2 << 20


def give_back() -> None:
    """Return freed memory to the system: idle workers, of which an executor may have several, keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


#: Seconds after its last task in which a worker still has what it kept.
IDLE = 4.0
_kept: dict = {}


@contextlib.contextmanager
def kept(key: tuple, make: Callable[[], object]) -> Iterator[object]:
    """What ``make`` gives, kept by the worker for tasks that follow at once and ask for the same; one thing at a time."""
    if timer := _kept.pop("timer", None):
        timer.cancel()
    if _kept.get("key") != key:
        _kept.clear()
        _kept.update(key=key, value=make())
    try:
        yield _kept["value"]
    finally:
        _kept["timer"] = timer = threading.Timer(IDLE, _forget)
        timer.daemon = True
        timer.start()


def _forget() -> None:
    _kept.clear()
    give_back()


def released(f: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A function over batches that gives memory back when its task ends."""

    @functools.wraps(f)
    def run(batches: Iterable) -> Iterator:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def released_group(f: Callable) -> Callable:
    """The same for a function over one group."""

    @functools.wraps(f)
    def run(table):
        try:
            return f(table)
        finally:
            give_back()

    return run


@dataclass
class Words:
    """``data`` holds each word followed by one space; ``first[d]`` is the first word of text d, ``first[-1]`` their number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def blocks(lengths: np.ndarray, most: int = BLOCK) -> list[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes; a longer text stands alone."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > most:
            out.append((begin, i))
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        out.append((begin, len(lengths)))
    return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text; nulls are empty."""
    filled = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def scan(texts: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE) -> Words:
    raw, at = bytes_of(texts)
    if lower:
        raw = _LOWER[raw]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(8, np.uint8), none, none, np.zeros(len(at), np.int64))
    space = separators[raw]
    before, after = np.empty_like(space), np.empty_like(space)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[at[:-1][at[:-1] < len(raw)]] = True
    ends = at[1:][at[1:] > 0] - 1
    after[ends] = True
    inside = ~space
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    size = end - start
    new = np.concatenate(([0], np.cumsum(size + 1)))
    data = np.full(new[-1] + 8, 0x20, np.uint8)
    data[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = raw[inside]
    return Words(data, new[:-1], new[:-1] + size, np.searchsorted(start, at))


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start : start + size]`` for each range; ``data`` has 8 bytes to spare at its end."""
    out = np.empty(len(start), U)
    wide = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    half = np.ndarray((len(data) - 3,), "<u4", data, strides=(1,))
    with np.errstate(over="ignore"):
        long = np.flatnonzero(size >= 32)
        if len(long):
            raw = data.tobytes() if len(long) * 64 > len(data) else memoryview(np.ascontiguousarray(data))
            out[long] = [xxhash.xxh64_intdigest(raw[a:b], seed) for a, b in zip(start[long].tolist(), (start[long] + size[long]).tolist(), strict=True)]
        short = np.flatnonzero(size < 32)
        at, left = start[short].astype(np.int64), size[short].astype(np.int64)
        h = left.astype(U) + (U(seed) + P5)
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            if not len(on):
                break
            k = _rot(wide[at[on]] * P2, 31) * P1
            h[on] = _rot(h[on] ^ k, 27) * P1 + P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        if len(on):
            h[on] = _rot(h[on] ^ (half[at[on]].astype(U) * P1), 23) * P2 + P3
            at[on] += 4
            left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left > 0)
            if not len(on):
                break
            h[on] = _rot(h[on] ^ (data[at[on]].astype(U) * P5), 11) * P1
            at[on] += 1
            left[on] -= 1
        h ^= h >> U(33)
        h *= P2
        h ^= h >> U(29)
        h *= P3
        h ^= h >> U(32)
        out[short] = h
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits (the finaliser of XXH64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(33))) * P2
        x = (x ^ (x >> U(29))) * P3
        return x ^ (x >> U(32))


def rolling(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of each n consecutive word hashes, by doubling: position i covers i to i + n - 1."""
    if len(words) < n:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        power, width, have = U(base | 1), 1, words
        out, done = None, 0
        while True:
            if n & width:
                if out is None:
                    out, done = have, width
                else:
                    m = len(words) - done - width + 1
                    out = out[:m] * power + have[done : done + m]
                    done += width
            if done == n:
                return mix(out)
            m = len(words) - 2 * width + 1
            have = have[:m] * power + have[width : width + m]
            power, width = power * power, 2 * width

"""Byte-pair merging with a heap of pairs over a doubly linked list of symbols."""

from __future__ import annotations

import contextlib
import gc
import heapq
from collections.abc import Callable, Iterator, Sequence
from typing import Any


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Python's cycle collector rests: what a worker remembers are strings without cycles, costly to look through again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def merge(symbols: Sequence[Any], rank: Callable[[Any, Any], tuple[int, Any] | None]) -> list[Any]:
    """The symbols after all merges: the adjacent pair of lowest rank, leftmost first, merges again and again.

    ``rank`` gives a pair's rank and merged symbol, or None. Each merge pushes two
    pairs at most, so n symbols take O(n log n) however long a word is.
    """
    n = len(symbols)
    at: list[Any] = list(symbols)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = []

    def push(i: int, j: int) -> None:
        if found := rank(at[i], at[j]):
            heapq.heappush(heap, (found[0], i, j, at[i], at[j], found[1]))

    for i in range(n - 1):
        push(i, i + 1)
    while heap:
        _, i, j, a, b, merged = heapq.heappop(heap)
        if at[i] != a or at[j] != b or right[i] != j:  # a neighbour has merged since
            continue
        at[i], at[j] = merged, None
        right[i] = k = right[j]
        if k >= 0:
            left[k] = i
            push(i, k)
        if left[i] >= 0:
            push(left[i], i)
    return [s for s in at if s is not None]

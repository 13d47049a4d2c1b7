"""Merging adjacent symbols in the order of their ranks: what a merge vocabulary does to one stretch of text."""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heapify, heappop, heappush
from operator import add

# Up to this many symbols the agenda is a list, beyond it a heap.
LISTED = 32


def merged(symbols: list[Sequence], ranks: dict[Sequence, int]) -> list[Sequence]:
    """The symbols (strings or bytes) left when no two neighbours make an entry of ``ranks``. The pair of the lowest
    rank is merged first, the leftmost among equals. Ranks are below ``len(ranks)``."""
    return _by_list(symbols, ranks) if len(symbols) <= LISTED else _by_heap(symbols, ranks)


def _by_list(symbols: list, ranks: dict) -> list:
    """A rank for each adjacent pair; finding the least of a few beats keeping them in order."""
    rank_of, never = ranks.get, len(ranks)
    agenda = [rank_of(a + b, never) for a, b in zip(symbols, symbols[1:])]
    while agenda:
        best = min(agenda)
        if best == never:
            break
        i = agenda.index(best)
        pair = symbols[i] = symbols[i] + symbols.pop(i + 1)
        del agenda[i]
        if i < len(agenda):
            agenda[i] = rank_of(pair + symbols[i + 1], never)
        if i:
            agenda[i - 1] = rank_of(symbols[i - 1] + pair, never)
    return symbols


def _by_heap(symbols: list, ranks: dict) -> list:
    """Every mergeable pair is one number on the heap, its rank and then its place; an entry whose pair has since got
    another rank is skipped when it comes up. Time grows with n log n, whatever the length."""
    rank_of = ranks.get
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = [
        rank * n + i for i, rank in enumerate(map(rank_of, map(add, symbols, symbols[1:]))) if rank is not None
    ]
    heapify(agenda)
    while agenda:
        rank, left = divmod(heappop(agenda), n)
        right = after[left]
        if right >= n or not symbols[left]:
            continue
        pair = symbols[left] + symbols[right]
        if rank_of(pair) != rank:
            continue
        symbols[left], symbols[right] = pair, pair[:0]
        following = after[left] = after[right]
        if following < n:
            before[following] = left
            rank = rank_of(pair + symbols[following])
            if rank is not None:
                heappush(agenda, rank * n + left)
        previous = before[left]
        if previous >= 0:
            rank = rank_of(symbols[previous] + pair)
            if rank is not None:
                heappush(agenda, rank * n + previous)
    return [s for s in symbols if s]

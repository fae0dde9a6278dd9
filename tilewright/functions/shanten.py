"""Standard shanten and accepted tiles, by a table of suits.

In each suit, melds (m) and partial melds (t) are taken so that 10 m + t is
largest, always using up the lowest tile that is left: as a triplet, a run, two
adjacent tiles, two tiles with a gap, or a pair.  When the lowest tile can do
none of these the rest of the suit counts for nothing.  The choice depends on
the suit's nine counts alone, so it is tabulated once, on the driver, and
broadcast: one byte for each of the 5**9 suits.
"""

from __future__ import annotations

from functools import cache, lru_cache

import numpy as np

_DIGITS = 9
_BASE = 5
_PLACE = _BASE ** np.arange(_DIGITS)
MOST_TILES = 15  # a hand and the tile that is tried; up to here t is below 10
_ORPHANS = np.array([0, 8, 9, 17, 18, 26, 27, 28, 29, 30, 31, 32, 33])
# What a move takes, counted from the lowest tile on, and what it adds to m and t.
_MOVES = [((3,), 1, 0), ((1, 1, 1), 1, 0), ((1, 1), 0, 1), ((1, 0, 1), 0, 1), ((2,), 0, 1)]


@cache
def suit_table() -> np.ndarray:
    """10 m + t of every suit of up to MOST_TILES tiles, by its counts read as a number in base 5; 255 for larger suits."""
    codes = np.arange(_BASE**_DIGITS, dtype=np.int32)
    counts = np.empty((_DIGITS + 2, len(codes)), np.uint8)
    counts[_DIGITS:] = 0
    for i in range(_DIGITS):
        counts[i] = codes // _PLACE[i] % _BASE
    total = counts.sum(0, dtype=np.uint8)
    low = (counts > 0).argmax(0)
    best = np.full(len(codes), 255, np.uint8)
    best[0] = 0
    by_total = np.argsort(total, kind="stable")
    ends = np.searchsorted(total[by_total], np.arange(MOST_TILES + 2))
    for k in range(1, MOST_TILES + 1):
        some = by_total[ends[k] : ends[k + 1]]
        first = low[some]
        found = np.zeros(len(some), np.uint8)
        for takes, dm, dt in _MOVES:
            fits = first + len(takes) <= _DIGITS
            for step, n in enumerate(takes):
                fits &= counts[first + step, some] >= n
            at = np.flatnonzero(fits)
            rest = some[at].astype(np.int64)
            for step, n in enumerate(takes):
                rest -= n * _PLACE[np.minimum(first[at] + step, _DIGITS - 1)]
            found[at] = np.maximum(found[at], best[rest] + 10 * dm + dt)
        best[some] = found
    return best


@lru_cache(1 << 16)
def _suit(counts: tuple[int, ...]) -> tuple[int, int]:
    """(m, t) by the same rule, for counts above 4 and larger suits, which a sound hand has not."""
    low = next((i for i, c in enumerate(counts) if c > 0), None)
    best = (0, 0)
    if low is None:
        return best
    for takes, dm, dt in _MOVES:
        after = counts[low : low + len(takes)]
        if len(after) == len(takes) and all(c >= n for c, n in zip(after, takes, strict=True)):
            m, t = _suit(counts[:low] + tuple(c - n for c, n in zip(after, takes, strict=True)) + counts[low + len(takes) :])
            if 10 * (m + dm) + t + dt > 10 * best[0] + best[1]:
                best = (m + dm, t + dt)
    return best


def _suit_value(suit: np.ndarray, table: np.ndarray) -> np.ndarray:
    """2 m + t of each row of nine counts."""
    value = table[np.clip(suit, 0, _BASE - 1) @ _PLACE].astype(np.int64)
    out = 2 * (value // 10) + value % 10
    for i in np.flatnonzero((value == 255) | (suit >= _BASE).any(1)):
        m, t = _suit(tuple(int(max(c, 0)) for c in suit[i]))
        out[i] = 2 * m + t
    return out


def _honor_value(honors: np.ndarray) -> np.ndarray:
    return (2 * (honors // 3) + (honors % 3 == 2)).sum(1)


def _pairs(hand: np.ndarray) -> np.ndarray:
    pairs, kinds = (hand >= 2).sum(1), (hand >= 1).sum(1)
    return 6 - pairs + np.maximum(0, 7 - kinds)


def _orphans(hand: np.ndarray) -> np.ndarray:
    own = hand[:, _ORPHANS]
    return 13 - (own > 0).sum(1) - (own > 1).any(1)


def evaluate(hand: np.ndarray, remaining: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(standard shanten, least of the three, accepted tiles) for rows of 34 counts; table is suit_table()."""
    suits = [hand[:, 9 * s : 9 * s + 9] for s in range(3)]
    values = [_suit_value(s, table) for s in suits] + [_honor_value(hand[:, 27:])]
    whole = sum(values)
    standard = np.maximum(0, 8 - whole)
    shanten = np.minimum(standard, np.minimum(_pairs(hand), _orphans(hand)))
    accepted = np.zeros(len(hand), np.int64)
    for tile in range(34):
        open_ = np.flatnonzero(remaining[:, tile] > 0)
        if not len(open_):
            continue
        more = hand[open_].copy()
        more[:, tile] += 1
        s = min(tile // 9, 3)
        value = whole[open_] - values[s][open_] + (_suit_value(more[:, 9 * s : 9 * s + 9], table) if s < 3 else _honor_value(more[:, 27:]))
        now = np.minimum(np.maximum(0, 8 - value), np.minimum(_pairs(more), _orphans(more)))
        accepted[open_] += np.where(now < shanten[open_], remaining[open_, tile], 0)
    return standard, shanten, accepted

"""Shanten and accepted tiles by the textbook, as another mode beside the published rule of the module shanten.

A hand is four blocks and a pair; calls are blocks already.  In each suit any
tile may be left over.  A suit's counts have, for each number of blocks and with
or without the hand's pair, a best value: two for a meld, one for a partial
block, one for the pair.  Suits are put together by a max-plus convolution over
blocks and pair, of which at most four and one count.  The table of suits is
built on the driver and broadcast; its size does not depend on the input.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .shanten import _BASE, _DIGITS, _PLACE, MOST_TILES, _orphans, _pairs

BLOCKS = 4
_WIDTH = BLOCKS + 1  # values for 0 to 4 blocks, without the pair and then with it
_NONE = -50
# What a move takes, counted from the lowest tile on, its blocks, pairs and value.
_MOVES = [((1,), 0, 0, 0), ((3,), 1, 0, 2), ((1, 1, 1), 1, 0, 2), ((1, 1), 1, 0, 1), ((1, 0, 1), 1, 0, 1), ((2,), 1, 0, 1), ((2,), 0, 1, 1)]


def _moved(rest: np.ndarray, blocks: int, pairs: int, value: int) -> np.ndarray:
    """Values of suits from those of what a move leaves of them."""
    out = np.full_like(rest, _NONE)
    source = rest[:, :_WIDTH] if pairs else rest
    target = out[:, _WIDTH:] if pairs else out
    for half in range(source.shape[1] // _WIDTH):
        a = half * _WIDTH
        target[:, a + blocks : a + _WIDTH] = source[:, a : a + _WIDTH - blocks] + value
    return np.maximum(out, _NONE)


@cache
def suit_values() -> tuple[np.ndarray, np.ndarray]:
    """(row of each suit, -1 for suits of more than MOST_TILES tiles; values of the rows), by the suit's counts read as a number in base 5."""
    codes = np.arange(_BASE**_DIGITS, dtype=np.int32)
    counts = np.stack([codes // p % _BASE for p in _PLACE]).astype(np.uint8)
    total = counts.sum(0)
    rows = np.full(len(codes), -1, np.int32)
    by_total = [np.flatnonzero(total == k) for k in range(MOST_TILES + 1)]
    at = 0
    for some in by_total:
        rows[some] = np.arange(at, at + len(some))
        at += len(some)
    best = np.full((at, 2 * _WIDTH), _NONE, np.int8)
    best[rows[0], 0] = 0
    low = (counts > 0).argmax(0)
    for some in by_total[1:]:
        first, mine = low[some], rows[some]
        for takes, blocks, pairs, value in _MOVES:
            fits = first + len(takes) <= _DIGITS
            for step, n in enumerate(takes):
                fits &= counts[np.minimum(first + step, _DIGITS - 1), some] >= n
            found = np.flatnonzero(fits)
            rest = some[found].astype(np.int64)
            for step, n in enumerate(takes):
                rest -= n * _PLACE[first[found] + step]
            best[mine[found]] = np.maximum(best[mine[found]], _moved(best[rows[rest]], blocks, pairs, value))
    return rows, best


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values of two parts of a hand together."""
    out = np.full((len(a), 2 * _WIDTH), _NONE, np.int16)
    for j, k in ((0, 0), (0, 1), (1, 0)):
        for x in range(_WIDTH):
            for y in range(_WIDTH - x):
                at = (j + k) * _WIDTH + x + y
                out[:, at] = np.maximum(out[:, at], a[:, j * _WIDTH + x].astype(np.int16) + b[:, k * _WIDTH + y])
    return np.maximum(out, _NONE)


def _suit(counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    rows, best = table
    at = rows[np.clip(counts, 0, _BASE - 1) @ _PLACE]
    if (at < 0).any():
        raise ValueError(f"more than {MOST_TILES} tiles of a suit")
    return best[at]


def _honors(counts: np.ndarray) -> np.ndarray:
    out = np.full((len(counts), 2 * _WIDTH), _NONE, np.int16)
    out[:, 0] = 0
    for kind in range(counts.shape[1]):
        one = np.full((len(counts), 2 * _WIDTH), _NONE, np.int16)
        n = counts[:, kind]
        one[:, 0] = 0
        one[:, 1] = np.where(n >= 3, 2, np.where(n == 2, 1, _NONE))
        one[:, _WIDTH] = np.where(n >= 2, 1, _NONE)
        out = _joined(out, one)
    return out


def _standard(values: np.ndarray, calls: np.ndarray) -> np.ndarray:
    """Shanten of the values of whole hands; -1 for a hand that is complete."""
    blocks = np.tile(np.arange(_WIDTH), 2)
    allowed = blocks[None, :] + np.clip(calls, 0, BLOCKS)[:, None] <= BLOCKS
    return 8 - 2 * np.clip(calls, 0, BLOCKS) - np.where(allowed, values, _NONE).max(1)


def _least(standard: np.ndarray, hand: np.ndarray, calls: np.ndarray) -> np.ndarray:
    """Seven pairs and thirteen orphans are for hands without calls."""
    return np.where(calls > 0, standard, np.minimum(standard, np.minimum(_pairs(hand), _orphans(hand))))


def evaluate(hand: np.ndarray, remaining: np.ndarray, calls: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(standard shanten, least of the three, accepted tiles) of rows of 34 counts; remaining says how many of each tile are left."""
    suits = [_suit(hand[:, 9 * s : 9 * s + 9], table) for s in range(3)] + [_honors(hand[:, 27:])]
    pairs = {(0, 1): _joined(suits[0], suits[1]), (2, 3): _joined(suits[2], suits[3])}
    others = [_joined(pairs[2, 3], suits[1]), _joined(pairs[2, 3], suits[0]), _joined(pairs[0, 1], suits[3]), _joined(pairs[0, 1], suits[2])]
    standard = _standard(_joined(pairs[0, 1], pairs[2, 3]), calls)
    shanten = _least(standard, hand, calls)
    accepted = np.zeros(len(hand), np.int64)
    for tile in range(34):
        open_ = np.flatnonzero(remaining[:, tile] > 0)
        if not len(open_):
            continue
        more = hand[open_].copy()
        more[:, tile] += 1
        s = min(tile // 9, 3)
        part = _suit(more[:, 9 * s : 9 * s + 9], table) if s < 3 else _honors(more[:, 27:])
        now = _least(_standard(_joined(others[s][open_], part), calls[open_]), more, calls[open_])
        accepted[open_] += np.where(now < shanten[open_], remaining[open_, tile], 0)
    return standard, shanten, accepted


def textbook_shanten(hand: Column, seen: Column, calls: Column) -> Column:
    """struct(standard, shanten, ukeire) of a hand (34 counts) with a number of calls; seen are the counts of all tiles that can be seen, the hand's too.

    Null counts and calls count as zero.
    """
    from .boards import _counts

    table = SparkSession.active().sparkContext.broadcast(suit_values())  # 12 MB, whatever the input

    @F.arrow_udf("standard int, shanten int, ukeire int")
    def compute(hand: pa.Array, seen: pa.Array, calls: pa.Array) -> pa.Array:
        found = evaluate(_counts(hand, 34), np.maximum(4 - _counts(seen, 34), 0), calls.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), table.value)
        return pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in found], names=["standard", "shanten", "ukeire"])

    return compute(hand, seen, calls)

"""The textbook's shanten against a search of all ways to take a hand apart."""

from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import textbook


@cache
def brute_suit(counts, honor):
    """(blocks, pair, value) of every way to take a suit apart, tile by tile."""
    low = next((i for i, c in enumerate(counts) if c), None)
    if low is None:
        return frozenset([(0, 0, 0)])

    def less(*takes):
        left = list(counts)
        for k, n in takes:
            if low + k >= len(left) or left[low + k] < n:
                return None
            left[low + k] -= n
        return tuple(left)

    out = set(brute_suit(less((0, 1)), honor))
    moves = [(((0, 3),), 1, 0, 2), (((0, 2),), 1, 0, 1), (((0, 2),), 0, 1, 1)]
    if not honor:
        moves += [(((0, 1), (1, 1), (2, 1)), 1, 0, 2), (((0, 1), (1, 1)), 1, 0, 1), (((0, 1), (2, 1)), 1, 0, 1)]
    for takes, b, j, v in moves:
        left = less(*takes)
        if left is not None:
            out |= {(x + b, y + j, z + v) for x, y, z in brute_suit(left, honor) if x + b <= 4 and y + j <= 1}
    best = {}
    for b, j, v in out:
        best[b, j] = max(best.get((b, j), 0), v)
    return frozenset((b, j, v) for (b, j), v in best.items())


def brute(hand, calls):
    whole = {(0, 0, 0)}
    for a, b in ((0, 9), (9, 18), (18, 27), (27, 34)):
        whole = {(x + p, y + q, z + r) for x, y, z in whole for p, q, r in brute_suit(tuple(hand[a:b]), a == 27) if x + p + calls <= 4 and y + q <= 1}
    return 8 - 2 * calls - max(v for *_, v in whole)


def hands(n, seed, sizes=(14, 13, 11, 8, 5, 2)):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        kinds = np.repeat(np.arange(34), 4)
        if k % 3:  # few suits make blocks likelier
            kinds = kinds[(kinds < 9) | ((kinds >= 27) & (kinds < 29))] if k % 3 == 1 else kinds[kinds < 18]
        out.append(np.bincount(rng.permutation(kinds)[: sizes[k % len(sizes)]], minlength=34))
    return np.array(out)


def test_ten_thousand_hands():
    some = hands(10_000, 1)
    calls = (14 - some.sum(1)) // 3
    found, _, _ = textbook.evaluate(some, np.zeros_like(some), calls, textbook.suit_values())
    assert found.tolist() == [brute(h.tolist(), int(c)) for h, c in zip(some, calls, strict=True)]
    assert set(range(-1, 6)) <= set(found.tolist())


def test_accepted_tiles():
    some = hands(60, 2, (13, 10, 7))
    calls = (14 - some.sum(1)) // 3
    left = np.maximum(4 - some, 0)
    standard, shanten, accepted = textbook.evaluate(some, left, calls, textbook.suit_values())
    for h, c, r, s, best, n in zip(some, calls, left, standard, shanten, accepted, strict=True):
        if c == 0:
            continue
        assert s == best
        better = [t for t in range(34) if r[t] and brute((h + np.eye(34, dtype=int)[t]).tolist(), int(c)) < s]
        assert n == sum(r[t] for t in better)


def hand_of(text):
    """As in 123m456p789s11z."""
    out, digits = [0] * 34, []
    for c in text:
        if c.isdigit():
            digits.append(int(c))
        else:
            for d in digits:
                out["mpsz".index(c) * 9 + d - 1] += 1
            digits = []
    return out


@pytest.mark.parametrize(
    ("text", "calls", "standard", "least"),
    [
        ("123m456p789s111z22z", 0, -1, -1),
        ("157m", 3, 1, 1),
        ("19m19p19s1234567z", 0, 8, 0),
        ("1122m3344p5566s7z", 0, 3, 0),
        ("13579m13579p135s", 0, 4, 4),
        ("1111m", 3, 0, 0),
        ("157m35688p358s256z", 0, 4, 4),  # published, as 5 by the other rule
    ],
)
def test_hands(spark, text, calls, standard, least):
    df = spark.createDataFrame([(hand_of(text), hand_of(text), calls)], "hand array<int>, seen array<int>, calls int")
    row = df.select(textbook.textbook_shanten(F.col("hand"), F.col("seen"), F.col("calls")).alias("r")).first()["r"]
    assert (row.standard, row.shanten) == (standard, least)

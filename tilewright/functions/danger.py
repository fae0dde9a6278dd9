"""Deal-in danger of tiles, for all tiles and seats of a batch of boards at once.

The products are taken in a fixed order, since the result is cut to an integer.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1200.0
# The model's constants.
_NUMBER, _HONOR, _DORA, _SUJI, _RIICHI, _MOST = 150.0, 80.0, 50.0, 80.0, 1.8, 3000.0
_WALL = np.array([0.0, 0.0, -20.0, -80.0, -120.0])  # by tiles seen, 4 and more alike
_MELD = np.array([1.0, 1.1, 1.3, 1.5])  # by meld tiles, 3 and more alike
_TENPAI = ((4, 0.03), (7, 0.15), (10, 0.45), (12, 0.75), (15, 0.90))  # up to this turn

_TILE = np.arange(34)
_PLACE = _TILE % 9
_BELOW = np.where((_TILE < 27) & (_PLACE >= 2), _TILE - 2, 34)
_ABOVE = np.where((_TILE < 27) & (_PLACE <= 6), _TILE + 2, 34)


def suji(discards: np.ndarray) -> np.ndarray:
    """For rows of 34 discard counts: of which tiles the tile two below or two above in the suit is discarded."""
    out = np.concatenate([discards > 0, np.zeros((len(discards), 1), bool)], 1)
    return out[:, _BELOW] | out[:, _ABOVE]


def tenpai_prob(turn: np.ndarray, riichi: np.ndarray) -> np.ndarray:
    return np.select([riichi, *[turn <= t for t, _ in _TENPAI]], [1.0, *[p for _, p in _TENPAI]], 1.0)


def tile_dangers(seen: np.ndarray, discards: np.ndarray, melds: np.ndarray, riichi: np.ndarray, turn: np.ndarray, dora: np.ndarray) -> np.ndarray:
    """Mean danger of each tile over the four seats, cut to an integer in 0 to 3000.

    seen (n, 34); discards and melds (n, 4, 34); riichi (n, 4); turn (n);
    dora (n, 34) flags. A seat that has discarded the tile adds nothing. The
    number of meld tiles, not of melds, sets the meld factor.
    """
    start = np.where(_TILE < 27, _NUMBER, _HONOR) + np.where(dora, _DORA, 0.0)
    wall = _WALL[np.clip(seen, 0, 4)]
    total = np.zeros(seen.shape)
    for seat in range(4):
        flag = riichi[:, seat]
        risk = np.maximum(start - np.where(suji(discards[:, seat]), _SUJI, 0.0) + wall, 0.0)
        risk = risk * _MELD[np.clip(melds[:, seat].sum(1), 0, 3)][:, None]
        risk = risk * np.where(flag, _RIICHI, 1.0)[:, None] * tenpai_prob(turn, flag)[:, None]
        total += np.where(discards[:, seat] > 0, 0.0, risk)
    return np.clip(total / 4, 0.0, _MOST).astype(np.int64)


def danger_to_prob(danger: Column) -> Column:
    return F.when(danger < 0, 0.0).otherwise(F.lit(1.0) - F.exp(-danger / SCALE))


def risk_estimate(dangers: Column) -> Column:
    """struct(safe_prob, avg_prob, risk_prob) of a hand's dangers; zeros for an empty hand."""
    mean = F.aggregate(dangers, F.lit(0), lambda a, d: a + d) / F.size(dangers)
    some = F.size(dangers) > 0
    prob = lambda d: F.when(some, danger_to_prob(d)).otherwise(0.0)
    return F.struct(prob(F.array_min(dangers).cast("double")).alias("safe_prob"), prob(mean).alias("avg_prob"), prob(F.array_max(dangers).cast("double")).alias("risk_prob"))

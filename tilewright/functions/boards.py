"""All features of boards in one Arrow function."""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .danger import tile_dangers
from .prompt import MELD_WORD, NONE, SEATS
from .shanten import evaluate, suit_table
from .tiles import TILE_NAMES

_FIELDS = ("standard", "shanten", "ukeire")
CHUNK = 1024  # boards that are worked out at once, so that what is made on the way stays small


def in_chunks(compute: Callable[..., pa.Array]) -> Callable[..., pa.Array]:
    """compute() for some rows of a batch after the other."""

    @functools.wraps(compute)
    def run(*columns: pa.Array) -> pa.Array:
        parts = [compute(*[c.slice(k, CHUNK) for c in columns]) for k in range(0, max(len(columns[0]), 1), CHUNK)]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    return run


def _counts(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of width counts; what is missing, null or below zero is zero."""
    while pa.types.is_list(lists.type.value_type):
        lists = pa.array([None if x is None else [c for one in x for c in (list(one or []) + [0] * 34)[:34]] for x in lists.to_pylist()], pa.list_(pa.int32())) if _ragged(lists, width) else _merged(lists)
    flat = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False)
    if lists.null_count or len(flat) != width * len(lists):
        flat = np.array([[c or 0 for c in (list(x or []) + [0] * width)[:width]] for x in lists.to_pylist()])
    return np.maximum(flat.astype(np.int64).reshape(len(lists), width), 0)


def _ragged(lists: pa.Array, width: int) -> bool:
    inner = lists.flatten()
    return bool(lists.null_count or inner.null_count or len(inner.flatten()) != width * len(lists))


def _merged(lists: pa.Array) -> pa.Array:
    """Lists of lists of equal length as lists."""
    flat = lists.flatten().flatten()
    each = len(flat) // max(len(lists), 1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * each), flat)


def _following() -> np.ndarray:
    """The dora of each indicator."""
    tile = np.arange(34)
    start = np.select([tile < 27, tile < 31], [tile // 9 * 9, 27], 31)
    size = np.select([tile < 27, tile < 31], [9, 4], 3)
    return start + (tile - start + 1) % size


def _named(counts: np.ndarray) -> pa.Array:
    """Names of the tiles of each row of 34 counts, with spaces between."""
    row, kind = np.nonzero(counts)
    names = pa.array(TILE_NAMES).take(pa.array(np.repeat(kind, counts[row, kind])))
    ends = np.concatenate(([0], np.cumsum(counts.sum(1)))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), names), " ")


def _seats(counts: np.ndarray, pov: pa.Array, word: str) -> pa.Array:
    """Each seat's tiles, from the own seat on, of four times 34 counts in each row."""
    own = pov.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    known, rows, parts = pov.is_valid().to_numpy(zero_copy_only=False), np.arange(len(own)), []
    for i, name in enumerate(SEATS):
        seat = own if i == 0 else np.fmod(own + i, 4)
        there = known & (seat >= 0) & (seat < 4)
        tiles = _named(np.where(there[:, None], counts[rows, np.clip(seat, 0, 3)], 0))
        parts.append(pc.binary_join_element_wise(f"{name}{word}：", pc.if_else(pc.equal(tiles, ""), NONE, tiles), ""))
    return pc.binary_join_element_wise(*parts, ", ")


def board_texts(hand: Column, melds: Column, discards: Column, pov: Column) -> Column:
    """struct(hand, melds, discards): the tiles of a board as the prompt names them."""

    @F.arrow_udf("hand string, melds string, discards string")
    @in_chunks
    def compute(hand: pa.Array, melds: pa.Array, discards: pa.Array, pov: pa.Array) -> pa.Array:
        own = pc.if_else(hand.is_valid(), _named(_counts(hand, 34)), None)
        seats = [_seats(_counts(x, 136).reshape(-1, 4, 34), pov, word) for x, word in ((melds, MELD_WORD), (discards, ""))]
        return pa.StructArray.from_arrays([own, *seats], names=["hand", "melds", "discards"])

    return compute(hand, melds, discards, pov)


def board_features(hand: Column, indicators: Column, melds: Column, discards: Column, riichi: Column) -> Column:
    """struct(turn, standard, shanten, ukeire, tiles, dangers): tiles are the distinct tiles of the hand, dangers theirs."""
    table = SparkSession.active().sparkContext.broadcast(suit_table())  # 2 MB

    @F.arrow_udf("turn int, standard int, shanten int, ukeire int, tiles array<int>, dangers array<int>")
    @in_chunks
    def compute(hand: pa.Array, indicators: pa.Array, melds: pa.Array, discards: pa.Array, riichi: pa.Array) -> pa.Array:
        own, shown = _counts(hand, 34), _counts(indicators, 34)
        called, thrown = _counts(melds, 136).reshape(-1, 4, 34), _counts(discards, 136).reshape(-1, 4, 34)
        flags = _counts(riichi.cast(pa.list_(pa.int32())), 4) > 0
        turn = thrown.sum((1, 2)) // 4 + 1
        seen = own + called.sum(1) + thrown.sum(1) + shown
        dora = np.zeros(own.shape, bool)
        row, tile = np.nonzero(shown)
        dora[row, _following()[tile]] = True
        found = evaluate(own, np.maximum(4 - seen, 0), table.value)
        dangers = tile_dangers(seen, thrown, called, flags, turn, dora)
        row, tile = np.nonzero(own)
        ends = np.concatenate(([0], np.cumsum((own > 0).sum(1)))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (tile, dangers[row, tile])]
        return pa.StructArray.from_arrays([pa.array(turn.astype(np.int32)), *[pa.array(x.astype(np.int32)) for x in found], *lists], names=["turn", *_FIELDS, "tiles", "dangers"])

    return compute(hand, indicators, melds, discards, riichi)

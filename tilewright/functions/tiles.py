"""Tiles and board features as column expressions.

Tiles are numbers 0 to 33: three suits of nine, four winds, three dragons.  A
board's tiles are arrays of 34 counts.  All functions here are built-in
expressions; nulls in an array of counts count as zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = 34
# Tile, wind and round names.
TILE_NAMES = [f"{n}{suit}" for suit in "万筒索" for n in range(1, 10)] + list("东南西北白发中")
WIND_NAMES = list("东南西北")
ROUND_NUMBERS = list("一二三四")
_ORPHANS = [0, 8, 9, 17, 18, 26, 27, 28, 29, 30, 31, 32, 33]


def _literals(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def tile_name(tile: Column, outside: str = "无效索引(%d)") -> Column:
    """The tile's name; a number outside 0 to 33 is put in `outside`."""
    known = tile.between(0, KINDS - 1)
    return F.when(known, F.element_at(_literals(TILE_NAMES), F.when(known, tile + 1).otherwise(1).cast("int"))).otherwise(F.format_string(outside, tile.cast("int")))


def tile_index(name: Column) -> Column:
    """The tile's number, -1 for a name that is none."""
    return (F.coalesce(F.array_position(_literals(TILE_NAMES), name), F.lit(0)) - 1).cast("int")


def wind_name(wind: Column) -> Column:
    """The wind's name; out of 0 to 3 the number is shown as not valid, null is unknown."""
    known = wind.between(0, 3)
    return F.when(wind.isNull(), "未知").when(known, F.element_at(_literals(WIND_NAMES), F.when(known, wind + 1).otherwise(1).cast("int"))).otherwise(F.format_string("无效场风(%d)", wind.cast("int")))


def expand_counts(counts: Column) -> Column:
    """Tile numbers, each as often as its count says, in order."""
    return F.flatten(F.transform(counts, lambda c, i: F.array_repeat(i.cast("int"), F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("int"))))


def tile_names(tiles: Column) -> Column:
    return F.transform(tiles, lambda t: tile_name(t))


def count_map(counts: Column) -> Column:
    """Map from name to count for the tiles that are there."""
    entries = F.transform(counts, lambda c, i: F.struct(tile_name(i).alias("key"), c.alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


def dora_tile(indicator: Column) -> Column:
    """The tile that follows an indicator within its suit, winds or dragons."""
    start = F.when(indicator < 27, F.floor(indicator / 9) * 9).when(indicator < 31, 27).otherwise(31)
    size = F.when(indicator < 27, 9).when(indicator < 31, 4).otherwise(3)
    return (start + (indicator - start + 1) % size).cast("int")


def dora_tiles(indicators: Column) -> Column:
    """Distinct dora of the indicators, sorted; indicators outside 0 to 33 are passed over."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(indicators, lambda i: i.between(0, KINDS - 1)), dora_tile)))


def turn(discards: Column) -> Column:
    """Turn number from the players' discard counts: a quarter of all discards, rounded down, plus 1."""
    total = F.aggregate(F.flatten(discards), F.lit(0), lambda a, c: a + F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("int"))
    return (F.floor(total / 4) + 1).cast("int")


def _at(counts: Column, i: Column) -> Column:
    return F.coalesce(F.get(counts, i), F.lit(0))


def seen_counts(hand: Column, melds: Column, discards: Column, indicators: Column) -> Column:
    """How many of each tile are in sight: hand, all melds, all discards and indicators."""
    groups = F.concat(F.array(hand), melds, discards, F.array(indicators))
    return F.transform(F.sequence(F.lit(0), F.lit(KINDS - 1)), lambda t: F.aggregate(groups, F.lit(0), lambda a, g: a + _at(g, t).cast("int")))


def remaining_counts(seen: Column) -> Column:
    return F.transform(seen, lambda c: F.greatest(F.lit(0), F.lit(4) - c).cast("int"))


def shanten_pairs(hand: Column) -> Column:
    """Shanten towards seven pairs; -1 when complete."""
    pairs = F.size(F.filter(hand, lambda c: c >= 2))
    kinds = pairs + F.size(F.filter(hand, lambda c: c == 1))
    return (F.lit(6) - pairs + F.greatest(F.lit(0), F.lit(7) - kinds)).cast("int")


def shanten_orphans(hand: Column) -> Column:
    """Shanten towards thirteen orphans; -1 when complete."""
    own = F.transform(_literals(_ORPHANS), lambda i: F.get(hand, i))
    return (F.lit(13) - F.size(F.filter(own, lambda c: c > 0)) - F.when(F.exists(own, lambda c: c > 1), 1).otherwise(0)).cast("int")

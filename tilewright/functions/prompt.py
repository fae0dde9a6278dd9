"""Boards as text: the prompt's parts and the training line."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tiles import ROUND_NUMBERS, tile_name, tile_names, wind_name

# The prompt's wording.
SEATS = ["本家", "下家", "对家", "上家"]
NONE = "无"
MELD_WORD = "副露"
TEMPLATE = """[情景分析]
- 牌局: {round}，{role} (第{turn}巡，牌墙余{wall}张{sticks})。
- 状态: 当前排名 {rank}/4 (与一位差 {diff})。
- 宝牌: {dora}
- 各玩家分数: {scores}。
- 你的手牌: {hand}
- 牌效: {shanten} 向听，进张 {ukeire} 张。
- 防御：
  最安全牌放铳率：{safe}
  平均放铳率：{mean}
  最危险牌放铳率：{risk}
场上已见牌信息
各玩家副露信息:{melds}
各玩家牌河信息:{discards}

[任务]
根据当前情景，选择一张最应该打出的手牌。"""


def fill(template: str, fields: dict[str, Column]) -> Column:
    """The template with each {name} replaced by the field's text."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[fields[x].cast("string") if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def round_name(wind: Column, dealer: Column) -> Column:
    known = wind.between(0, 3) & dealer.between(0, 3)
    number = F.element_at(F.array(*map(F.lit, ROUND_NUMBERS)), F.when(dealer.between(0, 3), dealer + 1).otherwise(1).cast("int"))
    return F.when(known, F.concat(wind_name(wind), number, F.lit("局"))).otherwise(F.format_string("局名解析异常(风=%s, 庄=%d)", wind_name(wind), dealer))


def stick_info(honba: Column, sticks: Column) -> Column:
    some = F.format_string("，%d本场", honba)
    with_sticks = F.when(sticks > 0, F.format_string("，供托%d根", sticks)).otherwise("")
    return F.when((honba > 0) | (sticks > 0), F.concat(some, with_sticks)).otherwise("")


def dealer_label(pov: Column, dealer: Column) -> Column:
    return F.when(pov == dealer, "你是庄家").otherwise("你是闲家")


def own_score(scores: Column, pov: Column) -> Column:
    return F.coalesce(F.get(scores, pov), F.lit(0))


def rank(scores: Column, pov: Column) -> Column:
    """1 and how many scores are above the own one, as text; ? if no seat has the own score."""
    mine = own_score(scores, pov)
    return F.when(F.array_contains(scores, mine), (F.size(F.filter(scores, lambda s: s > mine)) + 1).cast("string")).otherwise("?")


def diff_to_top(scores: Column, pov: Column) -> Column:
    return own_score(scores, pov) - F.array_max(scores)


def _seat(i: int, pov: Column) -> Column:
    return pov if i == 0 else (pov + i) % 4


def seat_scores(scores: Column, pov: Column) -> Column:
    def one(i: int) -> Column:
        text = F.coalesce(F.get(scores, _seat(i, pov)).cast("string"), F.lit("?"))
        return F.concat(F.lit("你有 " if i == 0 else f"{SEATS[i]}: "), text, F.lit("分"))

    return F.concat_ws(", ", *[one(i) for i in range(4)])


def joined(names: Column) -> Column:
    """Names with spaces between, or the word for none."""
    return F.coalesce(F.when(F.size(names) > 0, F.array_join(names, " ")), F.lit(NONE))


def percent(p: Column) -> Column:
    return F.format_string("%.1f%%", p * 100)


def prompt(b: dict[str, Column]) -> Column:
    """The prompt of a board.

    b has wind, dealer, pov, honba, sticks, wall, turn, scores, dora, shanten,
    ukeire, safe_prob, avg_prob, risk_prob and, as text, the hand, melds and
    discards of boards.board_texts().
    """
    pov, scores = b["pov"], b["scores"]
    fields = {name: b[name] for name in ("turn", "wall", "shanten", "ukeire")}
    fields |= {"round": round_name(b["wind"], b["dealer"]), "role": dealer_label(pov, b["dealer"]), "sticks": stick_info(b["honba"], b["sticks"])}
    fields |= {"rank": rank(scores, pov), "diff": diff_to_top(scores, pov), "scores": seat_scores(scores, pov)}
    fields |= {"dora": joined(tile_names(b["dora"])), "hand": b["hand"], "melds": b["melds"], "discards": b["discards"]}
    fields |= {name: percent(b[f"{of}_prob"]) for name, of in (("safe", "safe"), ("mean", "avg"), ("risk", "risk"))}
    return fill(TEMPLATE, fields)


def answer(label: Column) -> Column:
    """The label's tile name; null, for which the row goes, if it is no tile."""
    return F.when(label.between(0, 33), tile_name(label))

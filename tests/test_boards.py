"""Published boards, and the edges of the features."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import danger, prompt, shanten, tiles
from tilewright.functions.tiles import TILE_NAMES
from tilewright.plans.queries import features
from tilewright.sources import boards as source


def counts(names: str) -> list[int]:
    out = [0] * 34
    for n in names.split():
        out[TILE_NAMES.index(n)] += 1
    return out


def board(hand, shown, discards=("", "", "", ""), riichi=(True,) * 4, label=0, **more):
    return dict(wind=0, dealer=0, pov=0, honba=0, sticks=0, wall=70, scores=[25000] * 4, riichi=list(riichi), hand=counts(hand), indicators=counts(shown), melds=[[0] * 34] * 4, discards=[counts(d) for d in discards], label=label) | more


PUBLISHED = [
    ("1万 5万 7万 3筒 5筒 6筒 8筒 8筒 3索 5索 8索 南 白 发", "4万", ("", "", "", ""), 5, 82, (11.3, 18.5, 25.9)),
    ("2万 5万 6万 7万 6筒 7筒 1索 1索 3索 东 南 西 发 中", "8索", ("", "", "", ""), 5, 48, (11.3, 16.7, 20.1)),
    ("4万 5万 7万 8万 5筒 7筒 8筒 8筒 1索 2索 3索 3索 5索 北", "8索", ("", "", "西", ""), 1, 25, (11.3, 19.0, 20.1)),
    ("1万 6万 9万 2筒 2筒 3筒 4筒 5筒 2索 4索 6索 8索 9索 南", "8索", ("西", "北", "", ""), 3, 46, (11.3, 19.6, 25.9)),
]
SCHEMA = "wind int, dealer int, pov int, honba int, sticks int, wall int, scores array<int>, riichi array<boolean>, hand array<int>, indicators array<int>, melds array<array<int>>, discards array<array<int>>, label int"


def frame(spark, boards):
    names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(b[n] for n in names) for b in boards], SCHEMA)


def test_published_boards(spark):
    found = features(frame(spark, [board(h, s, d) for h, s, d, *_ in PUBLISHED])).collect()
    for row, (_, _, _, n, accepted, probs) in zip(found, PUBLISHED, strict=True):
        assert (row.turn, row.shanten, row.ukeire) == (1, n, accepted)
        assert tuple(round(100 * row[c], 1) for c in ("safe_prob", "avg_prob", "risk_prob")) == probs


def test_empty_hand_and_broken_counts(spark):
    rows = [board("", ""), board("东 东 东", "", label=None), board("", "") | {"hand": [None] * 34}, board("", "") | {"hand": [5] + [0] * 33}]
    found = features(frame(spark, rows)).collect()
    assert [tuple(r[c] for c in ("safe_prob", "avg_prob", "risk_prob")) for r in found[:1]] == [(0.0, 0.0, 0.0)]
    assert found[1].standard == 6 and found[2].dangers == []
    assert found[3].standard == 8 - 2 - 1  # a triplet and a pair of one tile


@pytest.mark.parametrize(("hand", "pairs", "orphans"), [("1万 1万 2万 2万 3万 3万 4万 4万 5万 5万 6万 6万 7万 7万", -1, 11), ("1万 9万 1筒 9筒 1索 9索 东 南 西 北 白 发 中 中", 5, -1)])
def test_complete_special_hands(spark, hand, pairs, orphans):
    row = frame(spark, [board(hand, "")]).select(tiles.shanten_pairs(F.col("hand")).alias("p"), tiles.shanten_orphans(F.col("hand")).alias("o")).first()
    assert (row.p, row.o) == (pairs, orphans)


def test_lowest_tile_hides_the_rest_of_its_suit():
    table = shanten.suit_table()
    code = lambda s: sum(int(c) * 5**i for i, c in enumerate(s))
    assert [table[code(s)] for s in ("100010100", "111000000", "000000033", "000000000")] == [0, 10, 20, 0]
    rng = np.random.default_rng(0)
    for s in np.minimum(rng.integers(0, 5, (500, 9)), rng.integers(0, 5, (500, 9))):
        a, b = shanten._suit(tuple(map(int, s)))
        if s.sum() <= shanten.MOST_TILES:
            assert 10 * a + b == table[int(s @ 5 ** np.arange(9))]


def test_indicators_wrap_and_repeat(spark):
    df = spark.createDataFrame([(i, [i, i]) for i in range(-1, 35)], "i int, shown array<int>").select("i", tiles.dora_tiles(F.col("shown")).alias("d"))
    found = {r.i: r.d for r in df.collect()}
    assert found[8] == [0] and found[17] == [9] and found[26] == [18] and found[30] == [27] and found[33] == [31] and found[-1] == [] and found[34] == []


def test_names(spark):
    df = spark.createDataFrame([(0, "1万"), (33, "中"), (34, "x"), (None, None)], "i int, n string")
    rows = df.select(tiles.tile_name(F.col("i")).alias("name"), tiles.tile_index(F.col("n")).alias("index"), tiles.wind_name(F.col("i")).alias("wind")).collect()
    assert [r.name for r in rows][:3] == ["1万", "中", "无效索引(34)"]
    assert [r["index"] for r in rows] == [0, 33, -1, -1]
    assert [r.wind for r in rows] == ["东", "无效场风(33)", "无效场风(34)", "未知"]


def test_rank_with_ties_and_unknown_seat(spark):
    df = spark.createDataFrame([([100, 300, 300, 0], p) for p in (0, 1, 2, 3, 7)], "scores array<int>, pov int")
    rows = df.select(prompt.rank(F.col("scores"), F.col("pov")).alias("r"), prompt.diff_to_top(F.col("scores"), F.col("pov")).alias("d")).collect()
    assert [(r.r, r.d) for r in rows] == [("3", -200), ("1", 0), ("1", 0), ("4", -300), ("4", -300)]


def test_danger_branches():
    seen, dora = np.zeros((1, 34), int), np.zeros((1, 34), bool)
    discards, melds = np.zeros((1, 4, 34), int), np.zeros((1, 4, 34), int)
    quiet = np.zeros((1, 4), bool)
    base = danger.tile_dangers(seen, discards, melds, quiet, np.array([16]), dora)[0]
    assert base[0] == 150 and base[27] == 80
    discards[0, 1, 2] = 1  # suji for tiles 0 and 4, and safe itself
    found = danger.tile_dangers(seen, discards, melds, quiet, np.array([16]), dora)[0]
    assert found[0] == 130 and found[4] == 130 and found[2] == 112
    melds[0, 0, 0] = 2
    assert danger.tile_dangers(seen, discards, melds, quiet, np.array([16]), dora)[0][27] == int((80 * 1.3 + 240) / 4)
    seen[0, 27] = 4
    assert danger.tile_dangers(seen, discards, melds, quiet, np.array([16]), dora)[0][27] == 0


def test_positions(spark, tmp_path):
    b = frame(spark, [board("1万 2万", "中", label=3), board("东", "", label=None)]).withColumn("round_number", F.lit(4)).withColumn("game_id", F.lit("g"))
    source.unpack(b).write.parquet(str(tmp_path / "a"))
    back = source.pack(source.read_boards(spark, str(tmp_path / "a")))
    assert sorted(back.select("hand", "label", "game_id", "round_number").collect()) == sorted(b.select("hand", "label", "game_id", "round_number").collect()) or back.exceptAll(b.select(*back.columns)).count() == 0


def test_bad_positions_have_defaults(spark):
    df = spark.createDataFrame([(float("nan"), None, "x")], "a double, b int, c string")
    row = source.pack(df).first()
    assert (row.wind, row.dealer, row.pov, row.wall, row.label, row.game_id) == (None, 0, 0, 70, None, "")


def test_limit_per_file(spark, tmp_path):
    for k in range(2):
        spark.range(5).selectExpr("id AS game_id").coalesce(1).write.parquet(str(tmp_path / f"f{k}"))
    df = source.read_boards(spark, str(tmp_path / "f*"))
    assert source.limit_per_file(df, 2).count() == 4


def test_texts_of_odd_boards(spark):
    from tilewright.functions.boards import board_texts

    one = [0] * 34
    one[0], one[33] = 2, 1
    none = [0] * 34
    schema = "k int, hand array<int>, melds array<array<int>>, discards array<array<int>>, pov int"
    rows = [(0, one, [one, none, none, none], [none, one, none, None], 1), (1, None, None, None, 0), (2, none, [one] * 4, [one] * 4, 7), (3, [None, -1, 1], [], [[1]], None), (4, one, [one] * 4, [one] * 4, 3)]
    df = spark.createDataFrame(rows, schema)
    found = {r.k: r.t for r in df.select("k", board_texts(*[F.col(c) for c in ("hand", "melds", "discards", "pov")]).alias("t")).collect()}
    tiles_ = "1万 1万 中"

    def seats(word, *texts):
        return ", ".join(f"{n}{word}：{t}" for n, t in zip(("本家", "下家", "对家", "上家"), texts, strict=True))

    assert found[0] == (tiles_, seats("副露", "无", "无", "无", tiles_), seats("", tiles_, "无", "无", "无"))
    assert found[1] == (None, seats("副露", *["无"] * 4), seats("", *["无"] * 4))
    assert found[2] == ("", seats("副露", "无", tiles_, tiles_, tiles_), seats("", "无", tiles_, tiles_, tiles_))
    assert found[3] == ("3万", seats("副露", *["无"] * 4), seats("", *["无"] * 4))
    assert found[4] == (tiles_, seats("副露", *[tiles_] * 4), seats("", *[tiles_] * 4))


def test_rules_as_columns_and_in_arrow_batches_agree(spark, sf_dir):
    from tilewright.functions import tiles
    from tilewright.plans import queries, synth

    b = queries.features(synth.boards(spark, sf_dir))
    least = F.least("standard", tiles.shanten_pairs(F.col("hand")), tiles.shanten_orphans(F.col("hand")))
    kinds = F.array_distinct(tiles.expand_counts(F.col("hand")))
    wrong = b.where((F.col("shanten") != least) | (F.col("turn") != tiles.turn(F.col("discards"))) | (F.col("tiles") != kinds))
    assert b.count() == 1500 and wrong.count() == 0

import pytest
from pyspark.sql import functions as F

from tilewright.functions import text


def values(spark, given, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    return [r.r for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def test_turns(spark):
    given = ["(第5巡，x", "第5巡", "x", "(第0巡)", None, "(第12巡)"]
    assert values(spark, given, text.turn_in_line) == [5, None, None, 0, None, 12]
    assert values(spark, given, text.turn_in_text) == [5, 5, None, 0, None, 12]


def test_stages(spark):
    df = spark.createDataFrame([(t,) for t in (None, 0, 1, 3, 4, 6, 7, 12, 13)], "t int")
    assert [r[0] for r in df.select(text.bucket(F.col("t"))).collect()] == [None, "early", "early", "early", "mid_pre", "mid_pre", "mid_mid", "mid_mid", "late"]
    assert [r[0] for r in df.select(text.category(F.col("t"))).collect()] == ["unknown", "unknown", "early", "early", "early", "early", "mid", "mid", "late"]


def test_gold(spark):
    assert values(spark, ["[任务]\n问题\nA", "[a]\n[b]", "", None, "x\n 6筒 \n\n[y]", "　6筒　"], text.gold_answer) == ["A", "", "", "", "6筒", "6筒"]


def test_clean(spark):
    given = ["[任务]\n问题\nA", "p\n[任务]\n\n问题\n\nA\nB\n[x]\nC\n[任务]\nq\nr", "无", None]
    assert values(spark, given, text.clean_prompt) == ["[任务]\n问题", "p\n[任务]\n\n问题\n\n[x]\nC\n[任务]\nq", "无", None]


def test_answers(spark):
    given = ["", None, "答案：", "x\n答案：\n 6筒。因为", "**6筒**", "6筒。因为…", "6筒，短", "一二三四五六七八九十十一，长", ".5筒", "　6筒　", "a\n\nb.c", "   ", "答案：**东**\n后面", "__x__"]
    want = ["", None, "答案：", "6筒", "6筒", "6筒", "6筒", "一二三四五六七八九十十一，长", ".5筒", "6筒", "b", "", "东", "x"]
    assert values(spark, given, text.extract_answer) == want


def test_score(spark):
    df = spark.createDataFrame([("6筒。", " 6筒 "), ("", "6筒"), ("6筒", ""), (None, None), ("5筒", "6筒")], "a string, g string")
    assert [r[0] for r in df.select(text.score(F.col("a"), F.col("g"), 2, -1)).collect()] == [2.0, -1.0, -1.0, -1.0, -1.0]


def test_mixed_and_names(spark):
    assert values(spark, ['["6筒", 1, 2, 3]', "6筒", ""], text.first_of_mixed) == ["6筒", "6筒", ""]
    assert values(spark, ["a/b\\c.jsonl", "c"], text.base_name) == ["c.jsonl", "c"]
    assert values(spark, ['a:b/c?"'], text.safe_name) == ["a_b_c__"]


@pytest.mark.parametrize(("ratios", "valid"), [({"early": 0.3, "mid": 0.3, "late": 0.4}, True), ({"early": 0.3, "mid": 0.3}, False), ({"early": 0.5, "mid": 0.5, "late": 0.5}, False), ({"early": -0.1, "mid": 0.5, "late": 0.6}, False), ({"early": "a", "mid": 0, "late": 1}, False)])
def test_ratios(ratios, valid):
    assert text.valid_ratios(ratios) == valid

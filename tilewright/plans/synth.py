"""Inputs of the queries, derived from the tables that are there.

`boards` deals 107 of 136 tiles by an affine permutation for each order,
`responses` makes nine answers for each order, `requests` are the events.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boards import in_chunks
from ..sources.tables import dealt
from ..sources.tables import read_table as table

MODELS = ("A", "B", "C")


_DEAL = "hand array<int>, indicators array<int>, melds array<array<int>>, discards array<array<int>>, first array<int>"


@in_chunks
def _dealt(keys: pa.Array) -> pa.Array:
    """Counts of the hand, indicators, melds and discards of a key's deal, and the hand's tiles in the order dealt."""
    key = keys.to_numpy(zero_copy_only=False).astype(np.int64)
    step = 2 * (key % 67) + 1
    step += 2 * (step % 17 == 0)
    kinds = ((step[:, None] * np.arange(107) + (key % 136)[:, None]) % 136) // 4
    place = np.arange(107)

    def counts(start: int, n: np.ndarray) -> np.ndarray:
        """Counts of the n tiles from start on, for each key."""
        out = np.zeros((len(key), 34), np.int32)
        row, at = np.nonzero((place >= start) & (place < start + n[:, None]))
        np.add.at(out, (row, kinds[row, at]), 1)
        return out

    def lists(x: np.ndarray) -> pa.Array:
        flat = pa.array(x.reshape(-1).astype(np.int32))
        for width in x.shape[:0:-1]:
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), flat)
        return flat

    hand, shown = counts(0, np.full(len(key), 14)), counts(14, 1 + key % 2)
    melds = np.stack([counts(83 + 6 * j, 3 * ((key + j) % 3)) for j in range(4)], 1)
    discards = np.stack([counts(16 + 16 * j, np.minimum(16, key % 17 + (j < key % 4))) for j in range(4)], 1)
    return pa.StructArray.from_arrays([lists(hand), lists(shown), lists(melds), lists(discards), lists(kinds[:, :14])], names=["hand", "indicators", "melds", "discards", "first"])


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("key"))


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boards_of(_keys(spark, sf_dir))


def boards_of(keys: DataFrame) -> DataFrame:
    """The boards of keys, where the keys are.

    Dealing is called nondeterministic, as else a condition on what is dealt
    would be moved to before the keys are and deal there once more.
    """
    return keys.withColumn("d", F.arrow_udf(_dealt, _DEAL).asNondeterministic()("key")).select(
        "key",
        F.expr("CAST(key % 5 AS INT)").alias("wind"),
        F.expr("CAST((key DIV 3) % 5 AS INT)").alias("dealer"),
        F.expr("CAST(key % 4 AS INT)").alias("pov"),
        F.expr("CAST(key % 3 AS INT)").alias("honba"),
        F.expr("CAST((key DIV 5) % 3 AS INT)").alias("sticks"),
        F.expr("CAST(70 - 4 * (key % 17) AS INT)").alias("wall"),
        F.expr("transform(sequence(0, 3), j -> CAST(25000 + (key * (j + 1) * 37 % 401 - 200) * 100 AS INT))").alias("scores"),
        F.expr("transform(sequence(0, 3), j -> (key + 2 * j) % 5 = 0)").alias("riichi"),
        "d.hand", "d.indicators", "d.melds", "d.discards",
        F.expr("CASE WHEN key % 29 = 0 THEN NULL WHEN key % 31 = 0 THEN 34 ELSE d.first[CAST(key % 14 AS INT)] END").alias("label"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.tiles import tile_name

    orders = _keys(spark, sf_dir)
    rows = orders.select("key", F.posexplode(F.array(*map(F.lit, MODELS))).alias("m", "model")).select("key", "m", "model", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("eval_id"))
    rows = rows.withColumn("gold", tile_name((F.col("key") % 34).cast("int"))).withColumn("variant", F.expr("(key * 7 + m * 3 + eval_id * (1 + key % 2)) % 6"))
    answer = F.expr(
        "CASE variant WHEN 0 THEN gold WHEN 1 THEN concat('分析\n', gold, '。因为牌效') WHEN 2 THEN concat('我想一下。\n答案：', gold, '。\n完') "
        "WHEN 3 THEN concat('**', gold, '**') WHEN 4 THEN CASE WHEN key % 2 = 0 THEN concat(gold, '，因为更安全') ELSE '9999' END ELSE CASE WHEN key % 3 = 0 THEN '  ' ELSE '' END END"
    )
    return rows.select(
        "model", F.expr("concat('data/set_', CAST(key % 3 AS STRING), '.jsonl')").alias("dataset_path"), F.expr("concat('set_', CAST(key % 3 AS STRING))").alias("dataset"),
        F.col("key").cast("long").alias("sample_id"), "eval_id", "gold", answer.alias("answer"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """responses with extracted and score."""
    from ..operators.evaluation import scored

    return scored(responses(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    seconds = F.coalesce(F.abs("value"), F.lit(0.0))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.select(
        "event_id", F.element_at(F.array(*map(F.lit, MODELS)), (F.col("user_id") % 3 + 1).cast("int")).alias("model"),
        micros.alias("_start"), F.floor(seconds * 1000).alias("_millis"), F.get_json_object("props", "$.k").cast("int").alias("prompt_tokens"),
    )
    return rows.select(
        "event_id", "model", F.timestamp_micros("_start").alias("start_ts"), F.timestamp_micros(F.col("_start") + F.col("_millis") * 1000).alias("end_ts"), (F.col("_millis") / 1000).alias("seconds"),
        "prompt_tokens", (F.col("prompt_tokens") % 7).alias("completion_tokens"), (F.col("prompt_tokens") + F.col("prompt_tokens") % 7).alias("total_tokens"),
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short prompts with turn, section marks and answer, one for each order; some lack a part."""
    orders = _keys(spark, sf_dir)
    mark = F.expr("CASE key % 4 WHEN 0 THEN concat('(第', CAST(key % 19 AS STRING), '巡，牌墙余9张)') WHEN 1 THEN concat('第', CAST(key % 19 AS STRING), '巡') WHEN 2 THEN concat('x(第', CAST(key % 19 AS STRING), '巡)') ELSE '没有' END")
    tail = F.expr("CASE key % 5 WHEN 0 THEN '\n 6筒 \n' WHEN 1 THEN '\n[答]' WHEN 2 THEN '\n\n东\n西' WHEN 3 THEN '' ELSE '\n[下一节]\n白' END")
    return orders.select("key", F.concat(F.lit("[情景分析]\n- 牌局"), mark, F.lit("\n[任务]\n选择一张。"), tail).alias("text"))

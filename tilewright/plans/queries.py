"""One query for each group of operators, over the derived inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boards, danger, prompt, text, textbook, tiles
from ..operators import evaluation, limits, metrics, sampling
from ..sources import boards as board_source
from . import synth

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def features(b: DataFrame) -> DataFrame:
    """Boards with turn, dora, the shanten numbers, ukeire, the hand's tiles with their dangers, and the risk estimate."""
    b = b.withColumn("f", boards.board_features(*[F.col(c) for c in ("hand", "indicators", "melds", "discards", "riichi")]))
    b = b.select("*", "f.*").drop("f").withColumn("dora", tiles.dora_tiles(tiles.expand_counts(F.col("indicators"))))
    return b.withColumn("risk", danger.risk_estimate(F.col("dangers"))).select("*", "risk.*").drop("risk")


def training_text(b: DataFrame) -> DataFrame:
    """Boards with the text of their training line; boards without a valid label go."""
    b = features(b.where(F.col("label").between(0, 33)))
    b = b.withColumn("texts", boards.board_texts(*[F.col(c) for c in ("hand", "melds", "discards", "pov")]))
    fields = {c: F.col(c) for c in b.columns} | {c: F.col(f"texts.{c}") for c in ("hand", "melds", "discards")}
    return b.withColumn("text", F.concat(prompt.prompt(fields), F.lit("\n"), prompt.answer(F.col("label")))).drop("texts")


def _ints(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


@query
def q_tile_expand(spark, sf_dir):
    return synth.boards(spark, sf_dir).select("key", F.array_join(tiles.tile_names(tiles.expand_counts(F.col("hand"))), " ").alias("hand"))


@query
def q_dora(spark, sf_dir):
    b = synth.boards(spark, sf_dir).withColumn("dora", tiles.dora_tiles(tiles.expand_counts(F.col("indicators"))))
    return b.select("key", _ints("dora").alias("dora"), F.size("dora").alias("n_dora"))


@query
def q_turn_bucket(spark, sf_dir):
    b = synth.boards(spark, sf_dir).select("key", tiles.turn(F.col("discards")).alias("turn"))
    return b.select("key", "turn", text.bucket(F.col("turn")).alias("bucket"), text.category(F.col("turn")).alias("category"))


@query
def q_remaining(spark, sf_dir):
    b = synth.boards(spark, sf_dir)
    seen = tiles.seen_counts(F.col("hand"), F.col("melds"), F.col("discards"), F.col("indicators"))
    return b.withColumn("remaining", tiles.remaining_counts(seen)).select("key", _ints("remaining").alias("remaining"))


@query
def q_shanten_special(spark, sf_dir):
    return synth.boards(spark, sf_dir).select("key", tiles.shanten_pairs(F.col("hand")).alias("pairs"), tiles.shanten_orphans(F.col("hand")).alias("orphans"))


@query
def q_shanten(spark, sf_dir):
    return features(synth.boards(spark, sf_dir)).select("key", "standard", "shanten", "ukeire")


@query
def q_shanten_textbook(spark, sf_dir):
    """By the textbook, with the own seat's calls as blocks that are there."""
    b = synth.boards(spark, sf_dir)
    calls = F.expr("CAST(aggregate(melds[pov], 0, (a, x) -> a + x) DIV 3 AS INT)")
    return b.select("key", textbook.textbook_shanten(F.col("hand"), F.col("hand"), calls).alias("r")).select("key", "r.standard", "r.shanten")


@query
def q_tile_danger(spark, sf_dir):
    b = features(synth.boards(spark, sf_dir))
    return b.select("key", F.explode(F.arrays_zip(F.col("tiles").alias("tile"), F.col("dangers").alias("danger"))).alias("d")).select("key", "d.tile", "d.danger")


@query
def q_danger_prob(spark, sf_dir):
    b = features(synth.boards(spark, sf_dir))
    return b.select("key", *[F.round(c, 9).alias(c) for c in ("safe_prob", "avg_prob", "risk_prob")])


@query
def q_prompt(spark, sf_dir):
    return training_text(synth.boards(spark, sf_dir)).select("key", "text")


@query
def q_positional_round_trip(spark, sf_dir):
    """Training lines of boards that went through the 512 positions."""
    b = synth.boards(spark, sf_dir).withColumn("round_number", F.lit(0)).withColumn("game_id", F.col("key").cast("string"))
    return training_text(board_source.pack(board_source.unpack(b))).select(F.col("game_id").try_cast("long").alias("key"), "text").where("key <> 0")


@query
def q_rank_seats(spark, sf_dir):
    b = synth.boards(spark, sf_dir)
    scores, pov = F.col("scores"), F.col("pov")
    return b.select("key", prompt.rank(scores, pov).alias("rank"), prompt.diff_to_top(scores, pov).alias("diff"), prompt.seat_scores(scores, pov).alias("seats"), prompt.round_name(F.col("wind"), F.col("dealer")).alias("round"), prompt.stick_info(F.col("honba"), F.col("sticks")).alias("sticks"))


@query
def q_turn_extract(spark, sf_dir):
    p = synth.prompts(spark, sf_dir).select("key", text.turn_in_line(F.col("text")).alias("turn_line"), text.turn_in_text(F.col("text")).alias("turn_text"))
    return p.select("*", text.bucket(F.col("turn_line")).alias("bucket"), text.category(F.col("turn_text")).alias("category"))


@query
def q_gold_answer(spark, sf_dir):
    return synth.prompts(spark, sf_dir).select("key", text.gold_answer(F.col("text")).alias("gold"))


@query
def q_clean_prompt(spark, sf_dir):
    return synth.prompts(spark, sf_dir).select("key", text.clean_prompt(F.col("text")).alias("prompt"))


@query
def q_extract_answer(spark, sf_dir):
    return synth.results(spark, sf_dir).select("model", "sample_id", "eval_id", "extracted")


@query
def q_score(spark, sf_dir):
    return evaluation.scored(synth.responses(spark, sf_dir), 2.0, -1.0).select("model", "sample_id", "eval_id", "score")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = (F.col("o_orderkey") % 17 + 1).cast("int")
    return synth.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), text.bucket(turn).alias("bucket"), text.category(turn).alias("category"))


@query
def q_random_split(spark, sf_dir):
    return sampling.random_split(_lines(spark, sf_dir).select("key"), "key", 1000, seed=7)


@query
def q_bucket_counts(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"))


@query
def q_rebalance(spark, sf_dir):
    return sampling.rebalance(_lines(spark, sf_dir).select("key", "bucket"), "key", "bucket", 100, seed=7)


@query
def q_stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(_lines(spark, sf_dir).select("key", "category"), "key", "category", 500, seed=7)


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = spark.range(3).select(F.element_at(F.array(*map(F.lit, synth.MODELS)), (F.col("id") + 1).cast("int")).alias("model"))
    samples = synth.table(spark, sf_dir, "orders").select(F.expr("concat('data/set_', CAST(o_orderkey % 3 AS STRING), '.jsonl')").alias("dataset_path"), F.col("o_orderkey").alias("sample_id"))
    return evaluation.work_list(models, samples, 4)


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.pending(_work(spark, sf_dir), synth.responses(spark, sf_dir).where("answer <> ''"))


@query
def q_pending(spark, sf_dir):
    return _pending(spark, sf_dir)


@query
def q_pending_counts(spark, sf_dir):
    return _pending(spark, sf_dir).groupBy("model").agg(F.count("*").alias("pending"), F.count_distinct("sample_id").alias("samples"))


@query
def q_budget_global(spark, sf_dir):
    return evaluation.budget(_pending(spark, sf_dir), 1000)


@query
def q_budget_model(spark, sf_dir):
    return evaluation.budget_per_model(_pending(spark, sf_dir), {"A": 500, "B": 0, "C": None})


@query
def q_unfinished(spark, sf_dir):
    _, empty = evaluation.split_empty(synth.results(spark, sf_dir), True)
    return evaluation.unfinished(_pending(spark, sf_dir).withColumn("reason", F.lit("not_completed")), empty)


@query
def q_filter_empty(spark, sf_dir):
    entries = evaluation.filter_empty_entries(evaluation.grouped(synth.results(spark, sf_dir)))
    return entries.select("model", "dataset_path", "sample_id", F.array_join("extracted_answers", "|").alias("extracted"), F.aggregate("scores", F.lit(0.0), lambda a, s: a + s).alias("final_score"))


@query
def q_fill_paths(spark, sf_dir):
    r = synth.responses(spark, sf_dir).where("model = 'A' AND eval_id = 0").select("sample_id", F.concat("dataset", F.lit(".jsonl")).alias("dataset"), F.expr("CASE WHEN sample_id % 2 = 0 THEN dataset_path END").alias("dataset_path"))
    datasets = spark.sql("SELECT * FROM VALUES ('old\\\\set_0.jsonl', 0), ('data/set_0.jsonl', 1), ('data/set_1.jsonl', 2) AS t(dataset_path, place)")
    return evaluation.with_paths(r, datasets)


@query
def q_config(spark, sf_dir):
    counts = synth.responses(spark, sf_dir).groupBy("model").agg(F.count("*").alias("requests"))
    configs = spark.sql("SELECT * FROM VALUES ('A', 0.1D, 20), ('B', CAST(NULL AS DOUBLE), 5) AS t(model, temperature, per_minute)")
    return evaluation.with_config(counts, configs, {"temperature": 0.7, "per_minute": 10})


@query
def q_sample_score(spark, sf_dir):
    return metrics.sample_scores(synth.results(spark, sf_dir), mean="mean_score")


@query
def q_model_score(spark, sf_dir):
    return metrics.model_scores(synth.results(spark, sf_dir))


@query
def q_accuracy(spark, sf_dir):
    return metrics.sample_accuracy(synth.results(spark, sf_dir))


@query
def q_perfect_zero(spark, sf_dir):
    return metrics.perfect_zero_rates(synth.results(spark, sf_dir))


@query
def q_classify(spark, sf_dir):
    return metrics.classify(synth.results(spark, sf_dir))


@query
def q_completed(spark, sf_dir):
    return metrics.completed_counts(synth.results(spark, sf_dir))


@query
def q_remaining_requests(spark, sf_dir):
    plan = _work(spark, sf_dir).groupBy("model").agg(F.count("*").alias("planned"))
    return metrics.remaining(plan, metrics.completed_counts(synth.results(spark, sf_dir)))


@query
def q_timing(spark, sf_dir):
    t = metrics.timing(synth.requests(spark, sf_dir))
    return t.select("model", "requests", *[F.round(c, 3).alias(c) for c in ("total_seconds", "mean_seconds")])


@query
def q_tokens(spark, sf_dir):
    return metrics.tokens(synth.requests(spark, sf_dir))


@query
def q_request_span(spark, sf_dir):
    return metrics.request_span(synth.requests(spark, sf_dir)).withColumn("model", F.coalesce("model", F.lit("all")))


@query
def q_rate_60s(spark, sf_dir):
    return metrics.rate_window(synth.requests(spark, sf_dir)).select("event_id", "model", "in_window")


@query
def q_rate_limited(spark, sf_dir):
    """When requests that all arrive at the start of their day may be sent, under another limit an hour for each model."""
    day = 86_400_000_000
    rows = synth.requests(spark, sf_dir).select("event_id", "model", (F.floor(F.unix_micros(F.col("start_ts").cast("timestamp")) / day) * day).cast("long").alias("arrival_us"))
    limit = F.expr("CASE model WHEN 'A' THEN 5 WHEN 'B' THEN 11 END")
    return limits.rate_limited(rows, limit, 3600).select("event_id", "model", "number", "submit_us", "wait_us")


@query
def q_in_flight(spark, sf_dir):
    return metrics.in_flight(synth.requests(spark, sf_dir))


@query
def q_running_score(spark, sf_dir):
    return metrics.running_score(metrics.sample_scores(synth.results(spark, sf_dir)))


@query
def q_merge_scores(spark, sf_dir):
    r = synth.results(spark, sf_dir)
    return metrics.merge_scores(metrics.model_scores(r.where("eval_id = 0")), metrics.model_scores(r.where("eval_id > 0 AND model <> 'C'")))


@query
def q_merge_dedupe(spark, sf_dir):
    r = synth.results(spark, sf_dir).select("model", "dataset", "sample_id", "eval_id", "score")
    return metrics.merge_results([r.where("eval_id <= 1"), r.where("eval_id >= 1")], dedupe=True).groupBy("model").agg(F.count("*").alias("n"), F.sum("score").alias("score"))


@query
def q_cumulative(spark, sf_dir):
    done = metrics.completed_counts(synth.results(spark, sf_dir))
    return metrics.cumulative(done.where("model <> 'A'"), done.where("model <> 'B'"), "completed")

"""Scores, accuracy, times and tokens of evaluations as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from .prefix import running_sum

SAMPLE = ["model", "dataset", "sample_id"]


def sample_scores(results: DataFrame, agg: str = "sum", mean: str | None = None) -> DataFrame:
    """Each sample's score over its repetitions: their sum, or (for anything but sum) their mean; with mean, their mean in that column as well."""
    how = F.sum if agg == "sum" else F.avg
    return results.groupBy(*SAMPLE).agg(how("score").alias("final_score"), *([F.avg("score").alias(mean)] if mean else []))


def model_scores(results: DataFrame, agg: str = "sum") -> DataFrame:
    return sample_scores(results, agg).groupBy("model").agg(F.sum("final_score").alias("score"))


def sample_accuracy(results: DataFrame, correct: float = 1.0, wrong: float = 0.0) -> DataFrame:
    """For each model how many samples are right, and how many wrong, in all repetitions.

    A sample whose scores are all null, as one without any repetition, counts
    as right; if right and wrong score the same, right counts.
    """
    every = results.groupBy(*SAMPLE).agg(F.coalesce(F.every(F.col("score") == correct), F.lit(True)).alias("right"), F.coalesce(F.every(F.col("score") == wrong), F.lit(True)).alias("wrong"))
    found = every.groupBy("model").agg(F.count("*").alias("sample_count"), F.count_if("right").alias("full_correct_count"), F.count_if(~F.col("right") & F.col("wrong")).alias("full_wrong_count"))
    return found.select("*", (F.col("full_correct_count") / F.col("sample_count")).alias("full_correct_rate"), (F.col("full_wrong_count") / F.col("sample_count")).alias("full_wrong_rate"))


def perfect_zero_rates(results: DataFrame) -> DataFrame:
    """For each model the percentage of samples with only 1 and only 0; without scores a sample is neither."""
    return rates_of(outcomes(results))


def outcomes(results: DataFrame) -> DataFrame:
    """Each sample with whether its scores are all 1 and all 0, null if it has none, and their number."""
    return results.groupBy(*SAMPLE).agg(F.every(F.col("score") == 1.0).alias("ones"), F.every(F.col("score") == 0.0).alias("zeros"), F.count("score").alias("test_count"))


def rates_of(samples: DataFrame) -> DataFrame:
    """perfect_zero_rates() of outcomes()."""
    found = samples.groupBy("model").agg(F.count("*").alias("total_samples"), F.count_if(F.coalesce("ones", F.lit(False))).alias("perfect_samples"), F.count_if(F.coalesce("zeros", F.lit(False))).alias("zero_samples"))
    rate = lambda c: F.col(c) * 100.0 / F.col("total_samples")
    return found.select("*", rate("perfect_samples").alias("perfect_rate"), rate("zero_samples").alias("zero_rate"))


def classify(results: DataFrame) -> DataFrame:
    """Each sample as perfect, zero or mixed, with its number of scores; without scores it is perfect."""
    return classes_of(outcomes(results))


def classes_of(samples: DataFrame) -> DataFrame:
    """classify() of outcomes()."""
    all_of = lambda c: F.coalesce(c, F.lit(True))
    return samples.select(*SAMPLE, "test_count", F.when(all_of("ones"), "perfect").when(all_of("zeros"), "zero").otherwise("mixed").alias("class"))


def completed_counts(results: DataFrame) -> DataFrame:
    """For each model how many answers there are, and how many of them are not blank."""
    return results.groupBy("model").agg(F.count("*").alias("completed"), F.count_if(~is_blank(F.col("extracted"))).alias("completed_non_empty"))


def cumulative(history: DataFrame, increment: DataFrame, value: str) -> DataFrame:
    """Sums by model over both tables, whichever of them has the model."""
    return history.select("model", value).unionByName(increment.select("model", value)).groupBy("model").agg(F.sum(value).alias(value))


def timing(requests: DataFrame) -> DataFrame:
    return requests.groupBy("model").agg(F.sum("seconds").alias("total_seconds"), F.avg("seconds").alias("mean_seconds"), F.count("seconds").alias("requests"))


def tokens(requests: DataFrame) -> DataFrame:
    """Sums and means of the three token counts, over requests that have them."""
    kinds = ("prompt_tokens", "completion_tokens", "total_tokens")
    aggs = [x for k in kinds for x in (F.sum(k).alias(f"sum_{k}"), F.avg(k).alias(f"mean_{k}"))]
    return requests.where("prompt_tokens IS NOT NULL").groupBy("model").agg(F.count("*").alias("requests"), *aggs)


def request_span(requests: DataFrame) -> DataFrame:
    """First start, last end and the seconds between, for each model and (model null) for all."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = requests.select("model", micros("start_ts").alias("first_us"), micros("end_ts").alias("last_us"))
    found = rows.rollup("model").agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))
    return found.withColumn("duration_s", (F.col("last_us") - F.col("first_us")) / 1e6)


def rate_window(requests: DataFrame, seconds: int = 60) -> DataFrame:
    """Requests with how many of the same model began in the seconds before, both ends and itself included.

    Each request is looked at in the slice of time that it is in, and counts
    in the next one too, so a task holds two slices of a model's requests.
    """
    width = seconds * 1_000_000
    rows = requests.withColumn("_at", F.unix_micros(F.col("start_ts").cast("timestamp")))
    rows = rows.withColumn("_next", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_slice", F.floor(F.col("_at") / width) + F.col("_next"))
    frame = Window.partitionBy("model", "_slice").orderBy("_at").rangeBetween(-width, 0)
    return rows.withColumn("in_window", F.count("*").over(frame)).where("_next = 0").drop("_at", "_next", "_slice")


def in_flight(requests: DataFrame) -> DataFrame:
    """For each model the most requests that ran at once; one that ends when another begins is over."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    events = requests.select("model", F.explode(F.array(F.struct(micros("start_ts").alias("at"), F.lit(1).alias("step")), F.struct(micros("end_ts").alias("at"), F.lit(-1).alias("step")))).alias("e")).select("model", "e.at", "e.step")
    hour = F.floor(F.col("at") / 3_600_000_000)
    return running_sum(events, ["model"], hour, ["at", "step"], "step", "running").groupBy("model").agg(F.max("running").alias("most_in_flight"))


def running_score(samples: DataFrame, slice_ids: int = 4096) -> DataFrame:
    """Each sample with the model's score up to and with it, by dataset and sample_id; slices of ids are summed apart."""
    order = F.struct("dataset", F.floor(F.col("sample_id") / slice_ids))
    return running_sum(samples, ["model"], order, ["sample_id"], "final_score", "running_score")


def merge_scores(*tables: DataFrame) -> DataFrame:
    """Scores of several runs (model, score) added up by model."""
    every = tables[0].select("model", "score")
    for t in tables[1:]:
        every = every.unionByName(t.select("model", "score"))
    return every.groupBy("model").agg(F.sum("score").alias("score"))


def merge_results(tables: list[DataFrame], dedupe: bool = False) -> DataFrame:
    """All results of several runs; deduped, one for each request."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    return every.dropDuplicates([*SAMPLE, "eval_id"]) if dedupe else every


def remaining(plan: DataFrame, done: DataFrame) -> DataFrame:
    """plan (model, planned) with how many requests are done and left, and whether none is left."""
    found = plan.join(done.select("model", F.col("completed").alias("_done")), "model", "left").withColumn("completed", F.coalesce("_done", F.lit(0))).drop("_done")
    return found.withColumn("remaining", F.greatest(F.col("planned") - F.col("completed"), F.lit(0))).withColumn("is_complete", F.col("remaining") == 0)


def top_k_hit(results: DataFrame, ranked: str, gold: str, k: int) -> DataFrame:
    """results with whether gold is among the first k of the ranked answers."""
    place = F.array_position(F.col(ranked), F.col(gold))
    return results.withColumn(f"hit_at_{k}", F.coalesce((place >= 1) & (place <= k), F.lit(False)))

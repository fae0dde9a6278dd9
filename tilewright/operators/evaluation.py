"""Evaluation as tables: work lists, resuming, budgets and scoring.

A request is one (model, dataset_path, sample_id, eval_id).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import extract_answer, is_blank, score
from .prefix import first_rows

KEYS = ["model", "dataset_path", "sample_id", "eval_id"]
#: Why a request is unfinished; the later reason wins.
REASONS = ["unfinished", "not_completed", "empty_result"]


def work_list(models: DataFrame, samples: DataFrame, eval_times: int) -> DataFrame:
    """Every model (column model, a short list) with every sample (dataset_path, sample_id) and repetition."""
    repeated = samples.select("dataset_path", "sample_id", F.explode(F.sequence(F.lit(0), F.lit(eval_times - 1))).alias("eval_id")) if eval_times > 0 else samples.select("dataset_path", "sample_id", F.lit(0).alias("eval_id")).limit(0)
    names = [r["model"] for r in models.select("model").distinct().limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("more than 10000 models")
    # rows are multiplied in place, without a join
    return repeated.select(F.explode(F.array(*map(F.lit, sorted(names))) if names else F.array().cast("array<string>")).alias("model"), "dataset_path", "sample_id", "eval_id")


def pending(work: DataFrame, done: DataFrame) -> DataFrame:
    """The requests of the work list that are not done.

    Both sides are sorted by the keys: Spark takes the size of `done` from its
    files, which says nothing once rows were multiplied, and would broadcast it.
    """
    return work.join(done.select(*KEYS).hint("merge"), KEYS, "left_anti")


def restrict(samples: DataFrame, allowed: DataFrame) -> DataFrame:
    """The samples that some allowed request is for; joined as in pending()."""
    return samples.join(allowed.select("dataset_path", "sample_id").hint("merge"), ["dataset_path", "sample_id"], "left_semi")


def request_order() -> list[Column]:
    return [F.col(c) for c in KEYS]


def budget_per_model(requests: DataFrame, limits: dict[str, int | None]) -> DataFrame:
    """The first requests of each model, as many as its limit; without a limit all, with 0 none."""
    bounds = {m: n for m, n in limits.items() if n is not None}
    if not bounds:
        return requests
    bounded = F.coalesce(F.col("model").isin(*bounds), F.lit(False))
    first = first_rows(requests.where(bounded), request_order(), bounds, F.col("model"))
    return first.unionByName(requests.where(~bounded))


def budget(requests: DataFrame, limit: int | None) -> DataFrame:
    """The first requests of all; 0 or None is no limit."""
    return first_rows(requests, request_order(), {0: limit}) if limit else requests


def predict(requests: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Answers of a model: call() gets some requests as pandas rows and gives answers; what it raises counts as empty answers without tokens, and is told in the column error if the schema has one."""
    told = "error" in StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                answers = call(batch)
                yield answers.assign(error=None) if told and "error" not in answers else answers
            except Exception as e:  # a model that fails must not end the run
                yield batch.assign(answer="", prompt_tokens=0, completion_tokens=0, total_tokens=0, **({"error": repr(e)} if told else {}))

    return requests.mapInPandas(run, schema)


def predict_timed(requests: DataFrame, ask: Callable[[dict], dict]) -> DataFrame:
    """requests with answer and the three token counts, which ask() gives for one request, start_ts, end_ts and seconds of the call, and error.

    A call that raises is timed too, and counts as an empty answer without
    tokens; error says what it raised, and is null for others.
    """
    counts = ("prompt_tokens", "completion_tokens", "total_tokens")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            given, starts, seconds, errors = [], [], [], []
            for request in batch.to_dict("records"):
                starts.append(time.time())
                clock = time.perf_counter()
                try:
                    given.append(ask(request))
                    errors.append(None)
                except Exception as e:  # a model that fails must not end the run
                    given.append({})
                    errors.append(repr(e))
                seconds.append(time.perf_counter() - clock)
            start, took = np.array(starts), np.array(seconds)
            moments = {name: pd.to_datetime(x, unit="s").floor("us") for name, x in (("start_ts", start), ("end_ts", start + took))}
            yield batch.assign(answer=[g.get("answer", "") for g in given], **{c: [int(g.get(c, 0)) for g in given] for c in counts}, **moments, seconds=took, error=pd.Series(errors, batch.index, dtype=object))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return requests.mapInPandas(run, f"{schema}, answer string, prompt_tokens int, completion_tokens int, total_tokens int, start_ts timestamp_ntz, end_ts timestamp_ntz, seconds double, error string")


def scored(responses: DataFrame, correct: float = 1.0, wrong: float = 0.0) -> DataFrame:
    """responses (with answer and gold) with extracted and score."""
    found = responses.withColumn("extracted", extract_answer(F.col("answer")))
    return found.withColumn("score", score(F.col("answer"), F.col("gold"), correct, wrong, F.col("extracted")))


def split_empty(responses: DataFrame, filter_empty: bool) -> tuple[DataFrame, DataFrame]:
    """(responses that count, requests that stay unfinished because their answer is blank)."""
    blank = is_blank(F.col("extracted"))
    if not filter_empty:
        return responses, responses.where(F.lit(False)).select(*KEYS, F.lit("empty_result").alias("reason"))
    return responses.where(~blank), responses.where(blank).select(*KEYS, F.lit("empty_result").alias("reason"))


def grouped(responses: DataFrame) -> DataFrame:
    """One row for each sample of a model: arrays over its repetitions, in their order."""
    rows = F.sort_array(F.collect_list(F.struct("eval_id", "answer", "extracted", "score")))
    found = responses.groupBy("model", "dataset_path", "sample_id").agg(rows.alias("_rows"))
    return found.select("model", "dataset_path", "sample_id", *[F.col("_rows")[c].alias(n) for c, n in (("eval_id", "eval_ids"), ("answer", "model_answers"), ("extracted", "extracted_answers"), ("score", "scores"))])


def filter_empty_entries(entries: DataFrame, keep_without_answers: bool = False) -> DataFrame:
    """Entries with some answer that is not blank; on request also those without any answer at all."""
    some = F.exists("extracted_answers", lambda x: ~is_blank(x))
    return entries.where(some | (F.size("extracted_answers") == 0) if keep_without_answers else some)


def unfinished(*tables: DataFrame) -> DataFrame:
    """One row for each request with its weightiest reason, of tables of KEYS and reason."""
    every = tables[0].select(*KEYS, "reason")
    for t in tables[1:]:
        every = every.unionByName(t.select(*KEYS, "reason"))
    weight = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reason"))
    return every.groupBy(*KEYS).agg(F.max_by("reason", weight).alias("reason"))


def with_paths(rows: DataFrame, datasets: DataFrame) -> DataFrame:
    """rows (dataset, and dataset_path where known) with the path filled in from datasets; rows without any path go.

    datasets has dataset_path and its place in the list; of several with the same name the first counts.
    """
    name = F.substring_index(F.replace("dataset_path", F.lit("\\"), F.lit("/")), "/", -1)
    first = datasets.groupBy(name.alias("dataset")).agg(F.min_by("dataset_path", "place").alias("_path"))
    return rows.join(first, "dataset", "left").withColumn("dataset_path", F.coalesce("dataset_path", "_path")).drop("_path").where("dataset_path IS NOT NULL")


def with_config(rows: DataFrame, configs: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """rows with their model's settings, or the default for each that is missing."""
    found = rows.join(configs, "model", "left")
    for name, value in defaults.items():
        found = found.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return found


def prefer_frozen(frozen: DataFrame, fresh: DataFrame) -> DataFrame:
    """Frozen samples, and fresh ones for datasets that have none frozen."""
    return frozen.unionByName(fresh.join(frozen.select("dataset_path").distinct(), "dataset_path", "left_anti"))

"""Evaluations as streams: answers that arrive in files, each request stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.evaluation import KEYS
from ..sources import files

ANSWERS = "model string, dataset_path string, sample_id int, eval_id int, answer string, gold string, start_ts timestamp"


def answers(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the JSON lines that are put in a folder."""
    return spark.readStream.schema(ANSWERS).json(path)


def first_answers(rows: DataFrame) -> DataFrame:
    """One row for each request, the one that began first; of several at once the least by its other columns."""
    others = [c for c in rows.columns if c not in KEYS]
    order = sorted(others, key=lambda c: c != "start_ts")
    found = rows.groupBy(*KEYS).agg(F.min(F.struct(*order)).alias("_first"))
    return found.select(*[F.col(c) if c in KEYS else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def _batches(spark: SparkSession, path: str) -> dict[int, str]:
    """Number and folder of the batches that have been stored whole."""
    _, found = files._listed(spark, path)
    numbers = {int(n.removeprefix("batch=")): f"{path}/{n}" for n in found if n.startswith("batch=")}
    return {n: folder for n, folder in numbers.items() if files.exists(spark, f"{folder}/_SUCCESS")}


def stored(spark: SparkSession, path: str, schema: str | StructType = ANSWERS, before: int | None = None, only: int | None = None) -> DataFrame:
    """What is stored in a folder: all of it, what the batches before one have stored, or only one."""
    folders = [folder for n, folder in sorted(_batches(spark, path).items()) if (before is None or n < before) and only in (None, n)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def store(rows: DataFrame, batch: int, path: str, asked: DataFrame | None = None) -> None:
    """Store a batch's requests that no batch before it has stored.

    Each batch has a folder of its own, which it overwrites, and is compared
    with those before it alone; so a batch that is run again, after a failure
    at any point, changes nothing.  Of what is stored only the keys are read,
    and if asked is given (a table with the batch's keys) only its keys are
    compared; rows are computed once either way, and nothing is broadcast.
    """
    spark = rows.sparkSession
    rows = first_answers(rows)
    known = stored(spark, path, rows.schema, before=batch).select(*KEYS)
    if asked is not None:
        known = known.join(asked.select(*KEYS), KEYS, "left_semi")
    new = rows.join(known.hint("merge"), KEYS, "left_anti")
    new.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/batch={batch}")


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store the first answer of each request that is there and stop; the next run goes on from there.

    Requests are never forgotten, and no answer is too late: nothing depends on
    the time at which an answer began or arrives.
    """
    return stream.writeStream.foreachBatch(lambda rows, batch: store(rows, batch, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def request_rate(stream: DataFrame, delay: str = "1 minute", width: str = "60 seconds", slide: str = "10 seconds") -> DataFrame:
    """Requests of each model in sliding windows."""
    return stream.withWatermark("start_ts", delay).groupBy(F.window("start_ts", width, slide), "model").agg(F.count("*").alias("requests"))


def run_updates(rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store the windows that a batch has changed, in a folder for each batch, and stop; a batch that is run again overwrites its own."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return rates.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_rates(stored: DataFrame) -> DataFrame:
    """Each window of a model once, as the last batch that changed it has it."""
    return stored.groupBy("window", "model").agg(F.max_by("requests", "batch").alias("requests"))

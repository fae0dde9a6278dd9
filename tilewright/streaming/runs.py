"""An evaluation that can be stopped and goes on: requests in slices, each stored when it is answered, with progress by model."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.evaluation import KEYS, pending, predict_timed
from . import resume

ANSWERS = "model string, dataset_path string, sample_id long, eval_id int, answer string, prompt_tokens int, completion_tokens int, total_tokens int, start_ts timestamp_ntz, end_ts timestamp_ntz, seconds double, error string"


class Progress:
    """How many requests of each model are stored, of how many: min(current, total). A batch that is counted again takes the place of its first count."""

    def __init__(self, totals: dict[str, int]):
        self.totals = dict(totals)
        self._batches: dict[int, dict[str, int]] = {}
        self._lock = threading.Lock()

    def stored(self, batch: int, counts: dict[str, int]) -> None:
        with self._lock:
            self._batches[batch] = dict(counts)

    def current(self) -> dict[str, tuple[int, int]]:
        with self._lock:
            return {m: (min(sum(b.get(m, 0) for b in self._batches.values()), total), total) for m, total in self.totals.items()}

    def of_all(self) -> tuple[int, int]:
        pairs = self.current().values()
        return sum(n for n, _ in pairs), sum(total for _, total in pairs)


class Evaluation:
    """Answers of a model to the requests of a work list that are not stored yet.

    work is a table of the request's keys (sample_id long).  The requests are
    dealt to slices by their hash; a slice is one Spark job and one batch of
    the store (see resume.store), so what an interrupted slice has not stored
    is asked again by the next run, and nothing else is.
    """

    def __init__(self, spark: SparkSession, work: DataFrame, ask: Callable[[dict], dict], path: str, slices: int = 8):
        self.spark, self.work, self.ask, self.path, self.slices = spark, work, ask, path, slices
        self.progress = Progress({r["model"]: r["count"] for r in work.groupBy("model").count().collect()})
        self.error: BaseException | None = None
        self.after_slice: Callable[[int], None] = lambda k: None
        self._tag = f"evaluation-{uuid.uuid4().hex}"
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None

    def start(self) -> Evaluation:
        self._thread = InheritableThread(target=self._run)
        self._thread.start()
        return self

    def stop(self) -> None:
        """Ask the run to end; returns at once. The slice that is running is interrupted."""
        self._stop.set()
        threading.Thread(target=lambda: self.spark.interruptTag(self._tag), daemon=True).start()

    def join(self, timeout: float | None = None) -> bool:
        """Wait for the end; whether it has come. What has failed, but for an interrupted slice, is raised."""
        self._thread.join(timeout)
        if self.error is not None:
            raise self.error
        return not self._thread.is_alive()

    def left(self) -> DataFrame:
        """The requests that are not stored."""
        return pending(self.work, resume.stored(self.spark, self.path, ANSWERS))

    def _run(self) -> None:
        self.spark.addTag(self._tag)
        try:
            known = {r["batch"]: {} for r in self._counts().select("batch").distinct().collect()}
            for r in self._counts().collect():
                known[r["batch"]][r["model"]] = r["count"]
            for batch, counts in known.items():
                self.progress.stored(batch, counts)
            first = max(known, default=-1) + 1
            for k in range(self.slices):
                if self._stop.is_set():
                    return
                mine = self.left().where(F.pmod(F.xxhash64(*KEYS), F.lit(self.slices)) == k)
                resume.store(predict_timed(mine, self.ask), first + k, self.path, mine)
                stored = resume.stored(self.spark, self.path, ANSWERS, only=first + k)
                self.progress.stored(first + k, {r["model"]: r["count"] for r in stored.groupBy("model").count().collect()})
                self.after_slice(k)
        except Exception as e:
            if not self._stop.is_set():  # an interrupted slice is no failure
                self.error = e
        finally:
            self.spark.removeTag(self._tag)

    def _counts(self) -> DataFrame:
        """model, batch, count of what earlier runs have stored."""
        batches = resume._batches(self.spark, self.path)
        if not batches:
            return self.spark.createDataFrame([], "model string, batch int, count long")
        rows = self.spark.read.schema(ANSWERS).option("basePath", self.path).parquet(*batches.values())
        return rows.groupBy("model", F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("int").alias("batch")).count()


class BatchListener(StreamingQueryListener):
    """Hands (query's name, batch, rows read, rows a second) of each micro-batch to a function."""

    def __init__(self, told: Callable[[str | None, int, int, float], None]):
        self.told = told

    def onQueryStarted(self, event) -> None:  # noqa: N802  Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.told(p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

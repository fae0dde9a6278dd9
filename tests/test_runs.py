"""Evaluations that are stopped and go on, and their progress."""

import time

import pytest
from pyspark.sql import functions as F

from tilewright.streaming import resume, runs


def work(spark, n=200):
    return spark.range(n).select(F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int")).alias("model"), F.lit("d").alias("dataset_path"), (F.col("id") / 2).cast("long").alias("sample_id"), F.lit(0).alias("eval_id"))


def slow(request):
    time.sleep(0.05)
    return {"answer": f"{request['model']}{request['sample_id']}", "total_tokens": 3}


def quick(request):
    return {"answer": "quick", "total_tokens": 1}


def test_each_request_is_asked_once(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def counted(request):
        asked.add(1)
        return {"answer": "x"}

    assert runs.Evaluation(spark, work(spark, 50), counted, str(tmp_path / "out"), slices=2).start().join(120)
    assert asked.value == 50


def test_stop_and_go_on(spark, tmp_path):
    path = str(tmp_path / "out")
    run = runs.Evaluation(spark, work(spark).repartition(4), slow, path, slices=8).start()
    while run.progress.of_all()[0] == 0:
        time.sleep(0.05)
    began = time.perf_counter()
    run.stop()
    assert time.perf_counter() - began < 0.1
    assert run.join(60)
    done, total = run.progress.of_all()
    assert 0 < done < total == 200
    stored = {(r.model, r.sample_id): r.answer for r in resume.stored(spark, path, runs.ANSWERS).collect()}
    assert len(stored) == done
    rest = runs.Evaluation(spark, work(spark), quick, path, slices=3)
    assert rest.left().count() == total - done
    assert rest.start().join(120)
    assert rest.progress.current() == {"A": (100, 100), "B": (100, 100)}
    rows = resume.stored(spark, path, runs.ANSWERS).collect()
    assert len(rows) == len({(r.model, r.sample_id) for r in rows}) == 200
    # what the first run has stored is as it was, and the second one asked for the rest only
    assert {k: v for k, v in ((((r.model, r.sample_id)), r.answer) for r in rows) if v != "quick"} == stored
    assert runs.Evaluation(spark, work(spark), slow, path).left().count() == 0


def test_a_run_that_fails_says_so(spark, tmp_path):
    run = runs.Evaluation(spark, work(spark, 4), quick, str(tmp_path / "out"), slices=1)
    run.work = run.work.withColumn("dataset_path", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        run.start().join(60)


def test_progress_never_passes_the_total():
    p = runs.Progress({"A": 5, "B": 2, "C": 1})
    p.stored(0, {"A": 3})
    p.stored(1, {"A": 4, "B": 1, "other": 9})
    assert p.current() == {"A": (5, 5), "B": (1, 2), "C": (0, 1)}
    p.stored(1, {"A": 1})
    assert p.current() == {"A": (4, 5), "B": (0, 2), "C": (0, 1)} and p.of_all() == (4, 8)


def test_micro_batches_are_told(spark, tmp_path):
    told = []
    listener = runs.BatchListener(lambda *x: told.append(x))
    spark.streams.addListener(listener)
    try:
        spark.range(7).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        stream.writeStream.queryName("told").format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(60)
        for _ in range(100):
            if any(name == "told" and rows == 7 for name, _, rows, _ in told):
                break
            time.sleep(0.1)
        assert ("told", 0, 7) in [t[:3] for t in told]
    finally:
        spark.streams.removeListener(listener)

"""Streams that resume, schedules under limits, and orders that are cut, against plain Python."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from tilewright.operators import limits, prefix, sampling
from tilewright.sources import files, jsonl
from tilewright.streaming import resume, schedule

ROW = '{"model": "A", "dataset_path": "d", "sample_id": 1, "eval_id": %d, "answer": "%s", "gold": "x", "start_ts": "2024-01-01T%02d:00:00Z"}\n'


def run(spark, tmp_path):
    resume.run_once(resume.answers(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)


def found(spark, tmp_path):
    return sorted((r.eval_id, r.answer) for r in resume.stored(spark, str(tmp_path / "out")).collect())


def test_stream_counts_each_request_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text(ROW % (0, "b", 11) + ROW % (0, "a", 10) + ROW % (1, "c", 10))
    run(spark, tmp_path)
    (tmp_path / "in/2.json").write_text(ROW % (1, "later", 15) + ROW % (2, "early", 1) + ROW % (2, "early", 1))
    run(spark, tmp_path)
    (tmp_path / "in/3.json").write_text(ROW % (0, "much later", 23) + ROW % (3, "d", 0))
    run(spark, tmp_path)
    run(spark, tmp_path)
    assert found(spark, tmp_path) == [(0, "a"), (1, "c"), (2, "early"), (3, "d")]


def test_a_batch_that_is_stored_again_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = lambda *rows: spark.createDataFrame([("A", "d", 1, e, a, "x", None) for e, a in rows], resume.ANSWERS)
    resume.store(batch((0, "a"), (1, "b")), 0, out)
    resume.store(batch((1, "again"), (2, "c")), 1, out)
    before = found(spark, tmp_path)
    resume.store(batch((0, "a"), (1, "b")), 0, out)
    resume.store(batch((1, "again"), (2, "c")), 1, out)
    assert found(spark, tmp_path) == before == [(0, "a"), (1, "b"), (2, "c")]
    # a batch that was broken off has no mark and is not read, and is overwritten when it runs again
    (tmp_path / "out/batch=2").mkdir()
    (tmp_path / "out/batch=2/part-0.parquet").write_text("half a file")
    assert found(spark, tmp_path) == before
    resume.store(batch((2, "again"), (3, "d")), 2, out)
    assert found(spark, tmp_path) == [*before, (3, "d")]
    resume.store(batch(), 3, out)
    assert len(found(spark, tmp_path)) == 4


def brute_schedule(rows, per, cap, window):
    sent, times, ends, out = -(10**18), [], [], {}
    for arrival, i, busy in sorted(rows):
        submit = max(arrival, sent, times[-per] + window if per and len(times) >= per else sent)
        times.append(submit)
        start = submit
        while cap and len([e for e in ends if e > start]) >= cap:
            start = min(e for e in ends if e > start)
        ends.append(start + busy)
        sent = start
        out[i] = (submit, start, start + busy)
    return out


@pytest.mark.parametrize(("per", "cap"), [(0, 1), (0, 2), (3, 0), (4, 8), (2, 3)])
def test_one_sender(per, cap):
    rng = random.Random(per * 10 + cap)
    rows = sorted((rng.randrange(0, 2000), i, rng.randrange(1, 200)) for i in range(300))
    sender = schedule.Sender(per, cap, 60)
    assert {i: sender.send(a, b) for a, i, b in rows} == brute_schedule(rows, per, cap, 60)
    assert len(sender.times) <= per and len(sender.ends) <= max(cap, 0)
    assert sender.ends == heapq.nsmallest(len(sender.ends), sender.ends) or sender.ends[0] == min(sender.ends)


def test_schedule_goes_on_after_a_restart(spark, tmp_path):
    rng = random.Random(8)
    rows = {m: sorted((rng.randrange(0, 5_000_000), 100 * k + i, rng.randrange(1, 900_000)) for i in range(60)) for k, m in enumerate("ABC")}
    bounds = {"A": (2, 1), "B": (0, 2), "C": (5, 8)}
    kind = "model string, request_id long, arrival_us long, busy_us long"
    for part in range(3):
        some = [(m, i, a, b) for m, mine in rows.items() for a, i, b in mine[20 * part : 20 * part + 20]]
        spark.createDataFrame(some, kind).write.mode("append").parquet(str(tmp_path / "in"))
        stream = schedule.scheduled(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), bounds, seconds=1)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        got.setdefault(r.model, {})[r.request_id] = (r.submit_us, r.start_us, r.end_us)
    assert got == {m: brute_schedule(mine, *bounds[m], 1_000_000) for m, mine in rows.items()}


def test_rate_limit(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ABC"), i, rng.choice([None, rng.randrange(0, 50_000_000), 7])) for i in range(500)]
    limit = {"A": 3, "B": 40, "C": None}
    df = spark.createDataFrame(rows, "model string, event_id long, arrival_us long")
    got = {r.event_id: (r.number, r.submit_us, r.wait_us) for r in limits.rate_limited(df, F.expr("CASE model WHEN 'A' THEN 3 WHEN 'B' THEN 40 END"), 1).collect()}
    want = {}
    for m in "ABC":
        sent = []
        for n, (a, i) in enumerate(sorted((a or 0, i) for mm, i, a in rows if mm == m)):
            sent.append(max(a, sent[-limit[m]] + 1_000_000) if limit[m] and n >= limit[m] else a)
            want[i] = (n, sent[-1], sent[-1] - a)
    assert got == want
    assert limits.rate_limited(df.limit(0), F.lit(3)).count() == 0


def test_first_rows_of_an_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice([*"ABC", None]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    order = [F.col("x"), F.col("i")]
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        for n in (0, 1, 500, 2999, 3000, 5000):
            cut = prefix.first_rows(df, order, {0: n})
            assert sorted((r.x, r.i) for r in cut.collect()) == sorted((x, i) for _, x, i in rows)[:n]
        sizes = {"A": 0, "B": 333, "C": 10_000, "absent": 5}
        got = prefix.first_rows(df, order, sizes, F.col("g")).collect()
        assert sorted((r.g, r.x, r.i) for r in got) == sorted(r for g in "ABC" for r in sorted(r for r in rows if r[0] == g)[: sizes[g]])
        plan = prefix.first_rows(df, order, {0: 500})._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_strata_from_one_scan(spark):
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), F.element_at(F.array(*map(F.lit, ["early", "mid", "late", "late", "other", None])), (F.col("id") % 6 + 1).cast("int")).alias("category"))
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    for n in (1, 10, 500, 1500, 2500, 9000):
        before = scans.value
        got = sampling.stratified_sample(rows.mapInArrow(counted, rows.schema), "key", "category", n, seed=5)
        got = got.collect()
        assert scans.value - before == 3000
        all_rows = [(r.key, r.category) for r in rows.collect()]
        have = {c: sum(x == c for _, x in all_rows) for c in ("early", "mid", "late")}
        take, everything = sampling.strata_sizes(have, n)
        import hashlib

        place = lambda r: (hashlib.md5(f"5-{r[0]}".encode()).hexdigest(), r[0])
        known = sorted((r for r in all_rows if r[1] in have), key=place)
        if not everything:
            known = [r for c in have for r in [r for r in known if r[1] == c][: take[c]]]
            known = sorted(known, key=place)[: max(n, sum(take.values()) if sum(take.values()) <= n else n)]
        assert sorted((r.key, r.category) for r in got) == sorted(known[:n] if everything else known)


def test_a_part_is_a_task(spark, tmp_path):
    df = spark.range(10_000).select((F.col("id") % 1000).alias("part"), "id", F.col("id").cast("string").alias("line"))
    sizes = jsonl.dealt_parts(df, "part", "id").select(F.spark_partition_id().alias("task"), "part").groupBy("task").agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts")).collect()
    assert len(sizes) == 1000 and {(r.n, r.parts) for r in sizes} == {(10, 1)}
    few = jsonl.dealt_parts(df, "part", "id", tasks=30).select(F.spark_partition_id().alias("task"), "part").distinct().groupBy("task").count().collect()
    assert len(few) == 30 and max(r["count"] for r in few) - min(r["count"] for r in few) <= 1
    path = str(tmp_path / "parts")
    jsonl.write_part_files(df.where("part < 20"), path, "part", "id", "train")
    got = files.lines_in_order(spark, path).orderBy("file_name", "place").collect()
    assert [(r.file_name, int(r.line)) for r in got] == [(f"train_{p:05d}.jsonl", p + 1000 * k) for p in range(20) for k in range(10)]


def test_names_that_are_escaped_and_renames_that_fail(spark, tmp_path):
    path = str(tmp_path / "buckets")
    df = spark.createDataFrame([("a:b", "1"), ("c d", "2")], "bucket string, line string")
    jsonl.write_bucket_files(df.coalesce(1), path)
    assert {r.file_name.replace("%20", " ") for r in files.lines_in_order(spark, path).collect()} == {"a_b.jsonl", "c d.jsonl"}
    with pytest.raises(ValueError, match="same file name"):
        jsonl.write_bucket_files(spark.createDataFrame([("a:b", "1"), ("a_b", "2")], "bucket string, line string"), str(tmp_path / "same"))

    class Fails:
        def exists(self, path):
            return False

        def rename(self, a, b):
            return False

    with pytest.raises(OSError, match="could not be renamed"):
        files._renamed(spark, Fails(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/a"), "/b")

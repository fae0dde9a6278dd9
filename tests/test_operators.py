import pytest
from pyspark.sql import functions as F

from tilewright.operators import evaluation, metrics, sampling
from tilewright.sources import jsonl, results, tasks


def lines(spark, counts):
    return spark.createDataFrame([(f"{b}{i}", b) for b, n in counts.items() for i in range(n)], "key string, bucket string")


def test_split_has_every_row_once(spark):
    df = sampling.random_split(spark.range(1001).withColumnRenamed("id", "key"), "key", 100, seed=3)
    rows = df.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1001))
    assert sorted(r.key for r in rows) == list(range(1001)) and rows[-1].part == 10
    assert [r.key for r in rows] != list(range(1001))
    with pytest.raises(ValueError):
        sampling.random_split(df, "key", 0)


def test_buckets_follow_the_rows(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "key")
    want = sorted((r.key, r.position) for r in sampling.random_split(df, "key", 100, seed=3).collect())
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 1 / 1000)  # now five digits make a bucket
    assert sorted((r.key, r.position) for r in sampling.random_split(df, "key", 100, seed=3).collect()) == want


def test_files_by_the_scarcest_bucket(spark):
    assert sampling.needed_per_file(10) == {"early": 1, "mid_pre": 2, "mid_mid": 3, "late": 4}
    df = lines(spark, {"early": 3, "mid_pre": 100, "mid_mid": 100, "late": 100, "other": 5})
    rows = sampling.rebalance(df, "key", "bucket", 10).collect()
    assert len(rows) == 30 and {r.file_no for r in rows} == {0, 1, 2}
    for f in range(3):
        mine = [r for r in rows if r.file_no == f]
        assert sorted(r.place for r in mine) == list(range(1, 11))
        assert [sum(r.bucket == b for r in mine) for b in sampling.BUCKETS] == [1, 2, 3, 4]
    assert sampling.rebalance(df, "key", "bucket", 10, max_files=1).count() == 10
    assert sampling.rebalance(lines(spark, {"early": 3}), "key", "bucket", 10).count() == 0


@pytest.mark.parametrize(
    ("available", "n", "want"),
    [
        ({"early": 50, "mid": 50, "late": 50}, 10, ({"early": 3, "mid": 3, "late": 4}, False)),
        ({"early": 0, "mid": 50, "late": 50}, 10, ({"early": 0, "mid": 7, "late": 3}, False)),
        ({"early": 1, "mid": 1, "late": 1}, 10, ({"early": 1, "mid": 1, "late": 1}, False)),
        ({"early": 9, "mid": 9, "late": 9}, 1, ({"early": 1, "mid": 1, "late": 1}, False)),
        ({}, 5, ({"early": 0, "mid": 0, "late": 0}, False)),
    ],
)
def test_strata(available, n, want):
    found, everything = sampling.strata_sizes(available, n)
    assert sum(found.values()) == sum(want[0].values()) and everything == want[1]


def test_stratified_sample(spark):
    df = spark.createDataFrame([(i, ("early", "mid", "late", "unknown")[i % 4]) for i in range(400)], "key int, category string")
    rows = sampling.stratified_sample(df, "key", "category", 50).collect()
    assert len(rows) == 50 and "unknown" not in {r.category for r in rows}
    assert sorted(r.key for r in rows) == sorted(r.key for r in sampling.stratified_sample(df, "key", "category", 50).collect())
    assert sampling.stratified_sample(df, "key", "category", 1).count() == 1
    assert sampling.stratified_sample(df, "key", "category", 1000).count() == 300


def test_resume_and_budgets(spark):
    models = spark.createDataFrame([("A",), ("B",)], "model string")
    samples = spark.createDataFrame([("d", i) for i in range(5)], "dataset_path string, sample_id int")
    work = evaluation.work_list(models, samples, 2)
    assert work.count() == 20 and evaluation.work_list(models, samples, 0).count() == 0
    done = work.where("sample_id < 2")
    left = evaluation.pending(work, done.unionByName(done))
    assert left.count() == 12
    assert evaluation.budget(left, 5).count() == 5 and evaluation.budget(left, 0).count() == 12
    assert {(r.model, r["count"]) for r in evaluation.budget_per_model(left, {"A": 4, "B": None}).groupBy("model").count().collect()} == {("A", 4), ("B", 6)}
    assert evaluation.budget_per_model(left, {"A": 0, "B": 0}).count() == 0
    assert evaluation.restrict(samples, left).count() == 3


def test_failing_model_gives_empty_answers(spark):
    def fail(_):
        raise OSError("no network")

    df = spark.createDataFrame([("A", "d", 1, 0)], "model string, dataset_path string, sample_id int, eval_id int")
    found = evaluation.predict(df, fail, "model string, dataset_path string, sample_id int, eval_id int, answer string, prompt_tokens int, completion_tokens int, total_tokens int").first()
    assert (found.answer, found.total_tokens) == ("", 0)


def scores(spark, rows):
    return spark.createDataFrame(rows, "model string, dataset string, sample_id int, score double")


def test_three_meanings_of_no_scores(spark):
    df = scores(spark, [("m", "d", 1, None), ("m", "d", 2, 1.0), ("m", "d", 3, 0.0), ("m", "d", 4, 1.0), ("m", "d", 4, 0.0)])
    a = metrics.sample_accuracy(df).first()
    assert (a.sample_count, a.full_correct_count, a.full_wrong_count) == (4, 2, 1)
    p = metrics.perfect_zero_rates(df).first()
    assert (p.perfect_samples, p.zero_samples, p.perfect_rate) == (1, 1, 25.0)
    assert {r.sample_id: r["class"] for r in metrics.classify(df).collect()} == {1: "perfect", 2: "perfect", 3: "zero", 4: "mixed"}
    same = metrics.sample_accuracy(scores(spark, [("m", "d", 1, 1.0)]), 1.0, 1.0).first()
    assert (same.full_correct_count, same.full_wrong_count) == (1, 0)


def test_reasons(spark):
    ddl = "model string, dataset_path string, sample_id int, eval_id int, reason string"
    a = spark.createDataFrame([("m", "d", 1, 0, "unfinished"), ("m", "d", 1, 0, "empty_result"), ("m", "d", 2, 0, "not_completed")], ddl)
    assert {r.sample_id: r.reason for r in evaluation.unfinished(a, a).collect()} == {1: "empty_result", 2: "not_completed"}


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "甲\\n乙"}\n\n{bad\n{"other": 1}\n   \n{"text": "x"}', encoding="utf-8")
    assert jsonl.read_lines(spark, str(tmp_path)).count() == 4 and jsonl.read_lines(spark, str(tmp_path), keep_empty=True).count() == 6
    df = jsonl.parse(jsonl.read_lines(spark, str(tmp_path)))
    assert sorted(r.text for r in df.collect()) == ["", "x", "甲\n乙"]
    jsonl.write_lines(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where("text = '甲\n乙'").count() == 1


def test_parts_and_buckets(spark, tmp_path):
    df = sampling.random_split(spark.range(25).selectExpr("id AS key", "concat('l', id) AS line"), "key", 10)
    jsonl.write_parts(df, str(tmp_path / "parts"), "part", "position")
    assert [spark.read.text(str(tmp_path / f"parts/part={p}")).count() for p in range(3)] == [10, 10, 5]
    jsonl.write_buckets(lines(spark, {"early": 2, "late": 3}).withColumn("line", F.col("key")), str(tmp_path / "b"))
    assert spark.read.text(str(tmp_path / "b/bucket=late")).count() == 3


def test_result_files(spark, tmp_path):
    entry = '{"dataset": "d", "sample_id": 1, "model_answers": ["a", ["b", 1, 2, 3]], "extracted_answers": ["a", "b"], "scores": [1.0, 0.0], "final_score": 1.0}'
    (tmp_path / "map.json").write_text('{"m": [' + entry + "]}")
    (tmp_path / "list.json").write_text('[{"model_name": "n", ' + entry[1:] + "]")
    found = results.read_results(spark, str(tmp_path))
    assert {r.model: r.model_answers for r in found.collect()} == {"m": ["a", "b"], "n": ["a", "b"]}
    rows = results.explode_entries(found).where("model = 'm'").orderBy("eval_id").collect()
    assert [(r.eval_id, r.answer, r.score) for r in rows] == [(0, "a", 1.0), (1, "b", 0.0)]


def test_score_reports(spark, tmp_path):
    (tmp_path / "r.txt").write_text("报告\n模型分数:\n  a: 1.5\n  b-2: 3\n  bad: x\n====\n平均时间:\n  a: 9\n", encoding="utf-8")
    assert {(r.model, r.score) for r in results.read_scores(spark, str(tmp_path / "r.txt")).collect()} == {("a", 1.5), ("b-2", 3.0)}


def test_settings():
    c = results.EvaluationConfig.from_json('{"eval_times": 3, "other": 1}')
    assert (c.eval_times, c.sample_count, c.score_agg) == (3, 10, "sum")


def test_reports_read_back(spark, tmp_path):
    scores_ = spark.createDataFrame([("a", 1.5), ("b", -2.0)], "model string, score double")
    times = spark.createDataFrame([("a", 3.0, 1.5, 2)], "model string, total_seconds double, mean_seconds double, requests long")
    lines_ = results.report(scores_, times)
    assert "  a: 总耗时 3.00秒, 平均耗时 1.50秒, 请求次数 2" in lines_ and "  b: 总耗时 0.00秒, 平均耗时 0.00秒, 请求次数 0" in lines_
    none = spark.createDataFrame([], "model string, requests long")
    assert results.report(scores_, tokens=none)[-2:] == ["  a: 暂无Token消耗数据", "  b: 暂无Token消耗数据"]
    (tmp_path / "r.txt").write_text("\n".join(lines_), encoding="utf-8")
    assert {(r.model, r.score) for r in results.read_scores(spark, str(tmp_path / "r.txt")).collect()} == {("a", 1.5), ("b", -2.0)}


def test_statistics_file(spark, tmp_path):
    df = scores(spark, [("m", "d", 1, 1.0), ("m", "d", 2, 0.0)])
    results.write_statistics(metrics.perfect_zero_rates(df), metrics.classify(df), str(tmp_path / "s"))
    row = spark.read.json(str(tmp_path / "s")).first()
    assert row.summary.perfect_rate == 50.0 and row.details.zero_samples[0].sample_key == "d_2" and row.details.mixed_samples == []


def test_settings_of_models(spark):
    a = tasks.ModelSettings.from_dict({"model_name": "x", "temperature": 0.1, "other": 1})
    assert (a.model, a.request_model, a.temperature, a.max_concurrent_requests) == ("x", "x", 0.1, 10)
    assert tasks.ModelSettings.from_dict({}).model == "unknown"
    assert tasks.settings_table(spark, [a]).first().temperature == 0.1


def test_settings_are_moved_into_their_ranges():
    a = tasks.ModelSettings(temperature=9, top_p=-1, max_tokens=0, timeout=1e6, max_concurrent_requests=0, max_concurrent_total=-5).in_range()
    assert (a.temperature, a.top_p, a.max_tokens, a.timeout, a.max_concurrent_requests, a.max_concurrent_total) == (2.0, 0.0, 1, 600.0, 1, -1)
    assert tasks.ModelSettings().in_range() == tasks.ModelSettings()
    c = results.EvaluationConfig(sample_count=0, eval_times=101, correct_score=-1, wrong_score=1).in_range()
    assert (c.sample_count, c.eval_times, c.correct_score, c.wrong_score) == (1, 100, 0, 0)


def test_errors_are_told(spark):
    def ask(request):
        raise KeyError("x") if request["sample_id"] else OSError("no answer")

    df = spark.createDataFrame([("m", "d", i, 0) for i in range(2)], "model string, dataset_path string, sample_id long, eval_id int")
    assert {r.error for r in evaluation.predict_timed(df, ask).collect()} == {"KeyError('x')", "OSError('no answer')"}

    def call(batch):
        raise ValueError("broken")

    schema = "model string, dataset_path string, sample_id long, eval_id int, answer string, prompt_tokens int, completion_tokens int, total_tokens int"
    assert {r.error for r in evaluation.predict(df, call, f"{schema}, error string").collect()} == {"ValueError('broken')"}
    assert [r.answer for r in evaluation.predict(df, call, schema).collect()] == ["", ""]


def test_checkpoints_and_tasks(spark, tmp_path):
    (tmp_path / "temp_progress_1.json").write_text('{"task_name": "t", "scores": {"a": 1.0}, "completed_requests": 1, "total_tasks": 9}')
    (tmp_path / "temp_progress_2.json").write_text('{"task_name": "t",\n "scores": {"a": 2.0}, "completed_requests": 5, "total_tasks": 9, "unfinished_requests": [{"model": "a", "dataset": "d", "sample_id": 1, "eval_id": 0, "reason": "unfinished"}]}')
    c = tasks.read_checkpoints(spark, str(tmp_path))
    last = tasks.latest_checkpoint(c).first()
    assert (last.completed_requests, last.file_name) == (5, "temp_progress_2.json")
    assert metrics.merge_scores(tasks.checkpoint_scores(c)).first().score == 3.0
    assert tasks.checkpoint_unfinished(c).count() == 1
    t = spark.createDataFrame([("a", 5, 5, None), ("b", 5, 4, None), ("c", 5, 0, True), ("d", None, None, None)], "task_name string, total_requests long, completed_requests long, is_completed boolean")
    assert {r.task_name for r in tasks.open_tasks(t).collect()} == {"b", "d"}
    assert [r[0] for r in t.limit(2).select(tasks.is_complete(F.col("completed_requests"), F.col("total_requests"), F.lit(0))).collect()] == [True, False]
    samples = spark.createDataFrame([("d", 1), ("d", 2)], "dataset_path string, sample_id int")
    assert tasks.total_requests(tasks.freeze(samples, str(tmp_path / "frozen")), 3, 2) == 12


def test_scratch_tables_go_with_their_scope(spark):
    import os

    from tilewright import scratch

    def there(table):
        return os.path.exists(table.scratch_path.removeprefix("file://"))

    with scratch.scope(spark) as outer:
        with scratch.scope(spark) as inner:
            a, b, c = (scratch.written(spark.range(5), name) for name in "abc")
            path = scratch.scratch(spark, "files")
            spark.range(3).write.parquet(path)
            both = inner.keep(a.join(b.where("id > 1"), "id"))
        assert [there(t) for t in (a, b, c)] == [True, True, False]
        assert not os.path.exists(path.removeprefix("file://"))
        assert both.count() == 3
        d = outer.keep(scratch.written(both, "d"))
    assert [there(t) for t in (a, b, d)] == [False, False, True]
    assert d.count() == 3
    with pytest.raises(ValueError), scratch.scope(spark) as scope:
        e = scope.keep(scratch.written(spark.range(5), "e"))
        raise ValueError
    assert not there(e)
    scratch.drop(d)
    assert not there(d)
    f = scratch.written(spark.range(5), "f")
    scratch.clear(spark)
    assert not there(f)


def test_where_results_are(spark, tmp_path):
    for name in ("b", "a", "empty"):
        (tmp_path / name).mkdir()
    for name in ("b", "a"):
        (tmp_path / name / "complete_test_results.json").write_text("{}")
        (tmp_path / name / "temp_progress_1.json").write_text("{}")
    root = str(tmp_path)
    assert results.result_paths(spark, root) == [f"{root}/{n}/complete_test_results*.json" for n in "ab"]
    assert results.result_paths(spark, f"{root}/a") == [f"{root}/a/complete_test_results*.json"]
    assert results.result_paths(spark, f"{root}/a/complete_test_results.json") == [f"{root}/a/complete_test_results.json"]
    assert results.result_paths(spark, f"{root}/empty") == results.result_paths(spark, f"{root}/none") == []


def test_reports_refuse_too_many_models(spark, monkeypatch):
    monkeypatch.setattr(results, "MOST_MODELS", 2)
    assert len(results.report(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, score double"))) == 6
    with pytest.raises(ValueError):
        results.report(spark.createDataFrame([(m, 1.0) for m in "abc"], "model string, score double"))


def test_progress_files_are_cleaned_up(spark, tmp_path):
    for name in ("temp_progress_1.json", "temp_progress_2-00001.json", "complete_test_results.json"):
        (tmp_path / name).write_text("{}")
    tasks.clean_up(spark, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["complete_test_results.json"]

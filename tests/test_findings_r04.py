import json

from pyspark.sql import functions as F

from tilewright.sources import publish, results, tasks


def entries(spark, n):
    arrays = {"eval_ids": "array(0)", "model_answers": "array('a')", "extracted_answers": "array('b')", "scores": "array(1.0D)"}
    return spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B\"' END AS model", "'d' AS dataset", "'p' AS dataset_path", "CAST(id AS INT) AS sample_id", *[f"{v} AS {k}" for k, v in arrays.items()])


def test_documents_get_longer_where_they_would_be_too_many(spark, tmp_path, monkeypatch):
    assert results.documents_of(1, 2000) == 1 and results.documents_of(20_000, 2000) == 10
    assert results.documents_of(162_000_000, 2000) == 2048 and results.documents_of(10**10, 2000) == 100_000
    monkeypatch.setattr(results, "MOST_DOCUMENTS", 7, raising=False)
    results.write_results(entries(spark, 300), str(tmp_path), per_file=2)
    written = sorted(tmp_path.glob("complete_test_results-*.json"))
    assert len(written) == 7 and all(set(json.loads(p.read_text())) <= {"A", 'B"'} for p in written)
    found = results.read_results(spark, str(tmp_path))
    assert found.groupBy("model").agg(F.count("*"), F.count_distinct("sample_id")).orderBy("model").collect() == [("A", 100, 100), ('B"', 200, 200)]
    ranges = results.read_results(spark, str(tmp_path), whole_bytes=0, split_bytes=300)
    assert sorted(ranges.collect()) == sorted(found.collect())


def test_a_checkpoint_has_few_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(results, "MOST_DOCUMENTS", 5, raising=False)
    left = spark.range(40).selectExpr("'A' AS model", "'d' AS dataset", "'p' AS dataset_path", "CAST(id AS INT) AS sample_id", "0 AS eval_id", "'empty_result' AS reason")
    scores = spark.createDataFrame([("A", 1.5)], "model string, score double")
    completed = spark.createDataFrame([("A", 3)], "model string, completed long")
    tasks.write_checkpoint(str(tmp_path), "1", 't"', entries(spark, 90), left, scores, completed, 9, per_file=1)
    assert len(list(tmp_path.glob("temp_progress_1-*.json"))) == 11 and publish.visible(spark, str(tmp_path)) is None
    found = tasks.read_checkpoints(spark, str(tmp_path))
    assert {(r.timestamp, r.task_name) for r in found.collect()} == {("1", 't"')}
    assert tasks.checkpoint_done(found).distinct().count() == 90 and tasks.checkpoint_unfinished(found).distinct().count() == 40
    assert tasks.latest_checkpoint(found).first().total_tasks == 9


def test_numbered_files_are_listed_in_groups(spark, sf_dir, duck, same, monkeypatch):
    from tilewright.plans import files as plans
    from tilewright.plans import files_oracle
    from tilewright.sources import files

    monkeypatch.setattr(files, "LISTED", 4, raising=False)
    listed, scans = [], []
    each, lines = files._each, files._lines if hasattr(files, "_lines") else None
    monkeypatch.setattr(files, "_each", lambda step, names: (listed.append(len(names)), each(step, names))[1])
    monkeypatch.setattr(files, "_lines", lambda df: (scans.append(len(df.inputFiles())), lines(df))[1], raising=False)
    same(plans.q_balanced_files(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_balanced_files"]).df())
    assert len(listed) > 1 and max(listed) <= 4 and len(scans) == len(listed) and max(scans) <= 4


def test_converted_lines_are_not_moved(spark, sf_dir, duck, same, monkeypatch):
    from tilewright.plans import files as plans
    from tilewright.plans import files_oracle
    from tilewright.sources import jsonl

    seen = []
    write = getattr(jsonl, "write_in_order", None)
    monkeypatch.setattr(jsonl, "write_in_order", lambda df, path, *a, **k: (seen.append((df._jdf.queryExecution().executedPlan().toString(), path)), write(df, path, *a, **k))[1], raising=False)
    monkeypatch.setattr(plans, "BOARD_ROWS", 100, raising=False)
    same(plans.q_convert_folder(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_convert_folder"]).df())
    assert len(seen) == 1 and "Exchange" not in seen[0][0]
    rows = spark.read.text(seen[0][1]).select(F.col("_metadata.file_name").alias("name"))
    assert {n[-9:] for (n,) in rows.select("name").distinct().collect()} == {".jsonl.gz"} and rows.select("name").distinct().count() > 9
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_task_reads_several_ranges(spark, tmp_path, monkeypatch):
    from tilewright.sources import large_json

    results.write_results(entries(spark, 600), str(tmp_path), per_file=1000)
    monkeypatch.setattr(large_json, "TASKS_A_CORE", 2, raising=False)
    with large_json._split_at(spark, 400):
        pieces = large_json._pieces(spark, str(tmp_path), 0)
        assert pieces.select("start").distinct().count() > 100 and pieces.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
    found = results.read_results(spark, str(tmp_path), whole_bytes=0, split_bytes=400)
    assert sorted(found.collect()) == sorted(results.read_results(spark, str(tmp_path)).collect())
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None

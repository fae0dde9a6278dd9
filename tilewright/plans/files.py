"""Queries that write files as the sinks do and read them as the sources do, over the derived inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, tiles
from ..operators import evaluation, metrics, sampling
from ..scratch import scratch, written
from ..sources import boards as board_source
from ..sources import files, jsonl, results, tasks
from ..streaming import resume, runs, schedule
from . import synth
from .queries import _lines, _work, query, training_text


def _raw_lines(spark, sf_dir) -> DataFrame:
    """JSON lines of the prompts, of which some are blank, broken, without text or no object."""
    line = F.expr("CASE key % 13 WHEN 3 THEN '' WHEN 4 THEN '  ' WHEN 5 THEN '{bad' WHEN 6 THEN '{\"other\": 1}' END")
    return synth.prompts(spark, sf_dir).select("key", F.coalesce(line, jsonl.to_line("text")).alias("value"))


def _folder_of_lines(spark, sf_dir) -> str:
    """A folder with those lines in files train-00000.jsonl and so on, and another file in it."""
    path = scratch(spark, "jsonl")
    _raw_lines(spark, sf_dir).select("value").write.text(path)
    files.name_files(spark, path, lambda k, n: f"train-{k:05d}.jsonl")
    spark.createDataFrame([("not a line",)], "value string").write.mode("append").text(path)
    return path


@query
def q_jsonl_raw(spark, sf_dir):
    """Raw lines of a folder, and how many of them are blank."""
    every = jsonl.read_lines(spark, _folder_of_lines(spark, sf_dir), keep_empty=True)
    return every.groupBy("line").agg(F.count("*").alias("n"), F.count_if(text.is_blank(F.col("line"))).alias("blank"))


@query
def q_jsonl_parsed(spark, sf_dir):
    return jsonl.parse(jsonl.read_lines(spark, _folder_of_lines(spark, sf_dir))).groupBy("text").agg(F.count("*").alias("n"))


@query
def q_jsonl_sink(spark, sf_dir):
    """Texts that were written as named files and read back from them."""
    path = scratch(spark, "lines")
    jsonl.write_lines(synth.prompts(spark, sf_dir), path, name="data-train")
    return jsonl.parse(jsonl.read_lines(spark, f"{path}/data-train*.jsonl")).groupBy("text").agg(F.count("*").alias("n"))


@query
def q_output_name(spark, sf_dir):
    names = spark.sql("SELECT * FROM VALUES (0, 'd/a.parquet'), (1, 'a.b.parquet'), (2, 'x\\\\y\\\\c.PARQUET'), (3, 'noext'), (4, '.hidden') AS t(k, path)")
    return synth.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 5).cast("int").alias("k")).join(names, "k").select("key", files.output_name(F.concat(F.lit("y"), F.col("key") % 3), F.col("path")).alias("name"))


@query
def q_part_files(spark, sf_dir):
    path = scratch(spark, "parts")
    split = sampling.random_split(_lines(spark, sf_dir).select("key"), "key", 1000, seed=7)
    n = jsonl.write_part_files(split.withColumn("line", F.col("key").cast("string")), path, "part", "position", "train")
    return files.numbered_in_order(spark, path, lambda k: jsonl.part_name("train", k), n).select("file_name", "place", F.col("line").cast("long").alias("key"))


@query
def q_bucket_files(spark, sf_dir):
    path = scratch(spark, "buckets")
    rows = _lines(spark, sf_dir).select("bucket", F.col("key").cast("string").alias("line"))
    jsonl.write_bucket_files(rows, path)
    # a bucket that several tasks have written is in numbered files
    found = spark.read.text(path).select(F.regexp_replace(files.file_name(), r"-\d{5}(?=\.jsonl$)", "").alias("file_name"), F.col("value").cast("long").alias("key"))
    return found.where("file_name LIKE '%.jsonl'")


@query
def q_balanced_files(spark, sf_dir):
    path = scratch(spark, "balanced")
    rows = sampling.rebalance(_lines(spark, sf_dir).select("key", "bucket"), "key", "bucket", 100, seed=7)
    n = jsonl.write_balanced(rows.withColumn("line", F.col("key").cast("string")), path)
    return files.numbered_in_order(spark, path, lambda k: jsonl.part_name(jsonl.BALANCED, k), n).select("file_name", "place", F.col("line").cast("long").alias("key"))


@query
def q_rebalance_unknown(spark, sf_dir):
    """Lines without a turn go before files are balanced; of samples, those of no category. Turns are looked for once and stored, since rows are counted and drawn from them."""
    turns = synth.prompts(spark, sf_dir).select("key", text.turn_in_line(F.col("text")).alias("in_line"), text.turn_in_text(F.col("text")).alias("in_text"))
    p = written(turns.select("key", text.bucket(F.col("in_line")).alias("bucket"), text.category(F.col("in_text")).alias("category")), "turns")
    balanced = sampling.rebalance(p.select("key", "bucket"), "key", "bucket", 20, seed=7).select("key", F.lit("file").alias("taken"))
    sample = sampling.stratified_sample(p.select("key", "category"), "key", "category", 100, seed=7).select("key", F.lit("sample").alias("taken"))
    return balanced.unionByName(sample)


def _entries(spark, sf_dir) -> DataFrame:
    r = synth.results(spark, sf_dir)
    return evaluation.grouped(r).withColumn("dataset", F.concat(F.lit("set_"), F.regexp_extract("dataset_path", r"_(\d+)\.", 1))).withColumn("sample_id", F.col("sample_id").cast("int"))


@query
def q_results_files(spark, sf_dir):
    """Results that were written as JSON documents, found in a task's folder and read back."""
    root = scratch(spark, "results")
    entries = written(_entries(spark, sf_dir), "entries")
    results.write_results(entries, f"{root}/task_1")
    tasks.clean_up(spark, f"{root}/task_1")
    spark.range(1).selectExpr("'{}' AS value").write.text(f"{root}/task_2")  # a folder without results
    found = results.read_results(spark, results.result_paths(spark, root))
    return results.explode_entries(found).select("model", "dataset", "dataset_path", "sample_id", "eval_id", "answer", "extracted", "score")


@query
def q_results_large(spark, sf_dir):
    """The same results from documents that are read by byte ranges, of which each cuts some."""
    root = scratch(spark, "large")
    results.write_results(_entries(spark, sf_dir), root, per_file=10 * results.ENTRIES)
    found = results.read_results(spark, root, whole_bytes=0, split_bytes=1 << 18)
    return results.explode_entries(found).select("model", "dataset", "dataset_path", "sample_id", "eval_id", "answer", "extracted", "score")


@query
def q_partial_results(spark, sf_dir):
    """Results of a run that is not over: they are no complete results, but are read by their path."""
    root = scratch(spark, "partial")
    entries = written(_entries(spark, sf_dir).where("model <> 'C'"), "entries")
    results.write_results(entries, f"{root}/task_1", name="partial_results_20240101_000000")
    complete = results.result_paths(spark, root)
    found = results.explode_entries(results.read_results(spark, f"{root}/task_1/partial_results_*.json"))
    return found.groupBy("model").agg(F.count("*").alias("answers"), F.sum("score").alias("score"), F.lit(len(complete)).alias("complete"))


@query
def q_stream_once(spark, sf_dir):
    """Answers that arrive in two batches of files, each run going on where the last one ended; a request counts once.

    The second batch repeats what the first one has of repetition 1, five hours
    later, and what it has of repetition 2 began an hour before everything else
    and comes twice. In the end a batch is stored once more.
    """
    root = scratch(spark, "stream")
    rows = synth.responses(spark, sf_dir).select("model", "dataset_path", F.col("sample_id").cast("int").alias("sample_id"), "eval_id", "answer", "gold")
    at = lambda moment: F.lit(f"2024-01-01T{moment}Z").alias("start_ts")
    batches = [
        rows.where("eval_id < 2").select("*", at("10:00:00")),
        rows.where("eval_id = 1").select("*", at("15:00:01")).unionByName(rows.where("eval_id = 2").select("*", F.explode(F.array(at("09:00:00"), at("09:30:00"))).alias("start_ts"))),
    ]
    for batch in batches:
        batch.write.mode("append").option("compression", "gzip").json(f"{root}/in")
        resume.run_once(resume.answers(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    resume.store(batches[0].withColumn("start_ts", F.col("start_ts").cast("timestamp")), 0, f"{root}/out")
    micros = F.unix_micros("start_ts")
    return resume.stored(spark, f"{root}/out").groupBy("model", "eval_id").agg(F.count("*").alias("answers"), F.count_distinct("sample_id").alias("samples"), F.min(micros).alias("first_us"), F.max(micros).alias("last_us"))


@query
def q_stream_rate(spark, sf_dir):
    """Requests of each model in sliding windows of 60 seconds, counted by a stream that has ended."""
    root = scratch(spark, "rate")
    q = synth.requests(spark, sf_dir).select("model", "start_ts")
    q.write.parquet(f"{root}/in")
    rate = resume.request_rate(spark.readStream.schema(q.schema).parquet(f"{root}/in"))
    resume.run_updates(rate, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return resume.latest_rates(spark.read.parquet(f"{root}/out")).select(F.unix_micros(F.col("window.start")).alias("from_us"), "model", "requests")


@query
def q_schedule(spark, sf_dir):
    """When requests that arrive at the start of their day are sent under a rate and a number in flight, by a stream that is stopped and goes on."""
    root = scratch(spark, "schedule")
    day = 86_400_000_000
    q = synth.requests(spark, sf_dir).select(
        F.concat("model", (F.col("event_id") % 8).cast("string")).alias("model"), F.col("event_id").alias("request_id"),
        (F.floor(F.unix_micros(F.col("start_ts").cast("timestamp")) / day) * day).cast("long").alias("arrival_us"), (F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))).alias("busy_us"),
    )
    limits = {f"{m}{k}": (0 if k % 4 == 0 else 6, in_flight) for m, in_flight in zip(synth.MODELS, (1, 2, 8), strict=True) for k in range(8)}
    half = F.col("arrival_us") < F.unix_micros(F.lit("2024-01-15T00:00:00Z").cast("timestamp"))
    for part in (half, ~half):
        q.where(part).write.mode("append").parquet(f"{root}/in")
        stream = schedule.scheduled(spark.readStream.schema(q.schema).parquet(f"{root}/in"), limits, seconds=600)
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


LISTED_ENTRIES = 20_000  # of a list, at most, about


@query
def q_results_listed(spark, sf_dir):
    """Results as a list of entries with model_name and mixed answers, as older runs have them."""
    path = scratch(spark, "listed")
    entry = F.to_json(F.struct(F.col("model").alias("model_name"), "dataset", "dataset_path", "sample_id", F.transform("model_answers", lambda a: F.array(a, F.lit("1"), F.lit("2"), F.lit("3"))).alias("model_answers"), "extracted_answers", "scores"))
    slices = max(50, synth.table(spark, sf_dir, "orders").count() // LISTED_ENTRIES)
    lists = _entries(spark, sf_dir).groupBy("model", (F.col("sample_id") % slices).alias("slice")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(entry), ","), F.lit("]")).alias("value"))
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    found = results.explode_entries(results.read_results(spark, path))
    return found.select("model", "sample_id", "eval_id", "answer", "score")


def _checkpoints(spark, sf_dir) -> DataFrame:
    """Two progress files of one task: the first answers, then all of them; blank answers are unfinished."""
    path = scratch(spark, "temp")
    every = written(synth.results(spark, sf_dir).withColumn("sample_id", F.col("sample_id").cast("int")), "results")
    total = _total(spark, sf_dir)
    for stamp, last in (("20240101_000000", 0), ("20240101_000500", 1)):
        some = every.where(F.col("eval_id") <= last)
        kept, empty = evaluation.split_empty(some, True)
        entries = evaluation.grouped(kept).withColumn("dataset", F.concat(F.lit("set_"), F.regexp_extract("dataset_path", r"_(\d+)\.", 1)))
        left = empty.withColumn("dataset", F.concat(F.lit("set_"), F.regexp_extract("dataset_path", r"_(\d+)\.", 1)))
        tasks.write_checkpoint(path, stamp, "task", written(entries, "entries"), written(left, "left"), metrics.model_scores(some), metrics.completed_counts(some), total)
    return tasks.read_checkpoints(spark, path)


def _total(spark, sf_dir) -> int:
    return tasks.total_requests(synth.table(spark, sf_dir, "orders"), len(synth.MODELS), 4)


@query
def q_checkpoint_resume(spark, sf_dir):
    """What is left of the work after the checkpoints."""
    work = _work(spark, sf_dir).withColumn("sample_id", F.col("sample_id").cast("int"))
    return evaluation.pending(work, tasks.checkpoint_done(_checkpoints(spark, sf_dir)))


@query
def q_checkpoint_latest(spark, sf_dir):
    last = tasks.latest_checkpoint(_checkpoints(spark, sf_dir))
    over = tasks.is_complete(F.col("completed_requests"), F.col("total_tasks"), F.lit(0))
    return last.select("task_name", F.substring("file_name", 1, 29).alias("file"), "completed_requests", "total_tasks", F.col("model_completed_requests")["B"].alias("of_b"), over.alias("is_complete"))


@query
def q_checkpoint_scores(spark, sf_dir):
    return metrics.merge_scores(tasks.checkpoint_scores(_checkpoints(spark, sf_dir)))


@query
def q_checkpoint_unfinished(spark, sf_dir):
    left = tasks.checkpoint_unfinished(_checkpoints(spark, sf_dir))
    return left.groupBy("model", "dataset", "dataset_path", "sample_id", "eval_id", "reason").agg(F.count("*").alias("times"))


def _report(spark, sf_dir) -> list[str]:
    r = written(synth.results(spark, sf_dir), "results")
    q = synth.requests(spark, sf_dir)
    return results.report(metrics.model_scores(r), metrics.timing(q), metrics.tokens(q), metrics.sample_accuracy(r), metrics.request_span(q), {"early": 0.6, "mid": 0.3, "late": 0.1})


@query
def q_report(spark, sf_dir):
    """All lines of a report with every section."""
    return spark.createDataFrame(list(enumerate(_report(spark, sf_dir), 1)), "place long, line string")


@query
def q_report_scores(spark, sf_dir):
    """The scores read back from a report file."""
    path = scratch(spark, "report")
    results.write_report(spark, _report(spark, sf_dir), path)
    return results.read_scores(spark, f"{path}/model_scores.txt")


@query
def q_statistics_file(spark, sf_dir):
    path = scratch(spark, "statistics")
    samples = written(metrics.outcomes(synth.results(spark, sf_dir)), "outcomes")
    results.write_statistics(metrics.rates_of(samples), metrics.classes_of(samples), path, per_file=1000)
    sample = "array<struct<sample_key:string,dataset:string,test_count:long>>"
    found = spark.read.schema(f"model string, summary struct<total_samples:long,perfect_rate:double>, details struct<perfect_samples:{sample},zero_samples:{sample},mixed_samples:{sample}>").json(path)
    kinds = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"details.{c}_samples").alias("samples")) for c in ("perfect", "zero", "mixed")])
    rows = found.select("model", F.col("summary.total_samples").alias("total_samples"), F.inline(kinds)).select("model", "total_samples", "class", F.explode("samples").alias("s"))
    return rows.select("model", "total_samples", "class", "s.sample_key", "s.test_count")


def _samples(spark, sf_dir) -> DataFrame:
    return sampling.stratified_sample(_lines(spark, sf_dir).select("key", "category"), "key", "category", 200, seed=7).select(F.concat(F.lit("data/set_"), F.col("key") % 3, F.lit(".jsonl")).alias("dataset_path"), F.col("key").alias("sample_id"))


@query
def q_frozen_samples(spark, sf_dir):
    """Samples that were frozen in a task's folder, and fresh ones for a dataset without."""
    frozen = tasks.freeze(_samples(spark, sf_dir).where("dataset_path <> 'data/set_2.jsonl'"), scratch(spark, "task"))
    fresh = synth.table(spark, sf_dir, "orders").select(F.concat(F.lit("data/set_"), F.col("o_orderkey") % 3, F.lit(".jsonl")).alias("dataset_path"), F.col("o_orderkey").alias("sample_id"))
    return evaluation.prefer_frozen(frozen, fresh)


@query
def q_restrict(spark, sf_dir):
    """Samples that some request with an answer is for."""
    samples = synth.table(spark, sf_dir, "orders").select(F.concat(F.lit("data/set_"), F.col("o_orderkey") % 3, F.lit(".jsonl")).alias("dataset_path"), F.col("o_orderkey").alias("sample_id"))
    return evaluation.restrict(samples, synth.responses(spark, sf_dir).where("model = 'A' AND answer <> ''"))


def _tasks(spark, sf_dir) -> DataFrame:
    """Task files, one for each customer, read back."""
    path = scratch(spark, "tasks")
    rows = synth.table(spark, sf_dir, "customer").selectExpr(
        "c_name AS task_name", "array('A', 'B') AS models", "CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 5 * 10 END AS total_requests", "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 11 * 5 END AS completed_requests", "CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS is_completed"
    )
    rows.write.option("ignoreNullFields", "true").option("maxRecordsPerFile", 200).json(path)
    return spark.read.schema(tasks.TASK).json(path)


@query
def q_open_tasks(spark, sf_dir):
    return tasks.open_tasks(_tasks(spark, sf_dir)).select("task_name", "total_requests", "completed_requests")


@query
def q_task_state(spark, sf_dir):
    """Whether tasks are over, and the names of their folders."""
    t = _tasks(spark, sf_dir)
    over = tasks.is_complete(F.coalesce("completed_requests", F.lit(0)), F.coalesce("total_requests", F.lit(10)), F.size("models") - 2)
    return t.select("task_name", tasks.named(F.concat(F.lit("  "), F.nullif(F.substring("task_name", -1, 1), F.lit("0")), F.lit("　"))).alias("name"), text.safe_name(F.concat("task_name", F.lit('<a>:"b"/c\\d|e?f*'))).alias("folder"), over.alias("is_complete"))


@query
def q_total_requests(spark, sf_dir):
    return spark.createDataFrame([(_total(spark, sf_dir),)], "total long")


@query
def q_ratios(spark, sf_dir):
    """Which ratios of three are valid."""
    o = synth.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", "CAST(o_orderkey % 5 / 4 AS DOUBLE) AS early", "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 3 / 4 AS DOUBLE) END AS mid", "CAST(o_orderkey % 7 / 4 - 0.25 AS DOUBLE) AS late")
    return o.select("key", text.ratios_are_valid(F.col("early"), F.col("mid"), F.col("late")).alias("valid"))


@query
def q_mixed_answers(spark, sf_dir):
    """Answers that are a list of content and token counts, and plain ones."""
    mixed = F.when(F.col("eval_id") == 0, F.to_json(F.array("answer", F.lit("5"), F.lit("6"), F.lit("11")))).otherwise(F.col("answer"))
    return synth.responses(spark, sf_dir).select("model", "sample_id", "eval_id", text.first_of_mixed(mixed).alias("answer"))


@query
def q_tile_index(spark, sf_dir):
    """Numbers of the names that answers have, -1 for what is no tile."""
    return synth.results(spark, sf_dir).select("model", "sample_id", "eval_id", tiles.tile_index(F.col("extracted")).alias("tile"))


@query
def q_count_map(spark, sf_dir):
    """How many of each tile a hand has."""
    return synth.boards(spark, sf_dir).select("key", F.explode(tiles.count_map(F.col("hand"))).alias("tile", "n"))


BOARD_ROWS = 50_000  # in a part of a file of boards, about


def _board_files(spark, sf_dir) -> str:
    """Three Parquet files of boards, in the order of their keys, numbered where a file has several parts, and one that is none.

    Keys are dealt to parts, and boards are made where their part is written, so
    a task's work is that of a part, however long the files are.
    """
    path = scratch(spark, "boards")
    orders = synth.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    parts = max(3, -(-orders.count() // BOARD_ROWS))
    dealt = orders.repartitionByRange(parts, F.col("key") % 3, "key")
    # keys are in order where boards are made of them, so that no wide rows are sorted
    b = synth.boards_of(dealt.sortWithinPartitions(F.col("key") % 3, "key")).withColumn("round_number", F.lit(0)).withColumn("game_id", F.col("key").cast("string"))
    with files.settings(spark, files.UNSORTED):
        board_source.unpack(b).withColumn("file", F.col("c511").cast("long") % 3).write.partitionBy("file").parquet(path)
    files.name_folders(spark, path, "file", lambda v: f"boards_{v}", ".parquet")
    spark.range(1).selectExpr("'no parquet' AS value").coalesce(1).write.mode("append").text(path)
    files.name_files(spark, path, lambda k, n: "bad.parquet")
    return path


@query
def q_board_files(spark, sf_dir):
    """Boards of the files of a folder, of which one is not readable."""
    df = board_source.read_boards(spark, _board_files(spark, sf_dir), skip_unreadable=True)
    return df.groupBy(files.whole_name(text.base_name(F.col("source_file")), "parquet").alias("file_name")).agg(F.count("*").alias("boards"), F.sum("c0").alias("winds"))


@query
def q_convert_folder(spark, sf_dir):
    """The training lines of a folder's files, in a file named after each; the file that is not readable is passed over."""
    out, boards = scratch(spark, "converted"), _board_files(spark, sf_dir)
    read = board_source.read_boards(spark, boards, skip_unreadable=True)
    packed = board_source.pack(read.withColumn("_file", files.output_name(F.lit("train"), F.col("source_file"))), "_file", "source_row")
    lines = training_text(packed).select("_file", "source_row", jsonl.to_line("text").alias("line"))
    with files.whole_files(spark, boards):
        jsonl.write_in_order(lines, out, "_file", compression="gzip")
    found = jsonl.read_lines(spark, out).select(files.whole_name(files.file_name(), "jsonl").alias("file_name"), F.get_json_object("line", "$.text").alias("text"))
    # dealt before they are counted: nearly all texts differ, and counting them where they are read would only spill them
    parts = max(spark.sparkContext.defaultParallelism, -(-synth.table(spark, sf_dir, "orders").count() // BOARD_ROWS))
    return found.repartition(parts, "file_name", "text").groupBy("file_name", "text").agg(F.count("*").alias("n"))


@query
def q_evaluation_run(spark, sf_dir):
    """A run that is stopped after its first slice and another one that does the rest, with their progress."""
    path = scratch(spark, "run")
    work = written(_work(spark, sf_dir).where("eval_id = 0"), "work")
    ask = lambda request: {"answer": f"{request['model']}{request['sample_id']}"}
    first = runs.Evaluation(spark, work, ask, path, slices=2)
    first.after_slice = lambda k: first.stop() if k == 0 else None
    first.start().join()
    rest = runs.Evaluation(spark, work, ask, path, slices=2)
    stopped = spark.createDataFrame([(m, n < total) for m, (n, total) in first.progress.current().items()], "model string, stopped boolean")
    rest.start().join()
    done = spark.createDataFrame([(m, n, total) for m, (n, total) in rest.progress.current().items()], "model string, done long, total long")
    stored = resume.stored(spark, path, runs.ANSWERS).groupBy("model").agg(F.count("*").alias("answers"), F.count_distinct("answer").alias("distinct"))
    return stored.join(done, "model").join(stopped, "model")


@query
def q_limit_per_file(spark, sf_dir):
    """The first 100 boards of each file."""
    read = board_source.read_boards(spark, f"{_board_files(spark, sf_dir)}/boards_*.parquet").select("c511", "source_file", "source_row")
    df = board_source.limit_per_file(read, 100, whole=files.whole_name(text.base_name(F.col("source_file")), "parquet"))
    return df.select(F.col("c511").cast("long").alias("key"))


@query
def q_predict(spark, sf_dir):
    """Answers of a model that fails on some requests, with the time that each call took."""

    def ask(request: dict) -> dict:
        if request["sample_id"] % 5 == 0:
            raise OSError("no answer")
        return {"answer": request["model"] + str(request["sample_id"]), "prompt_tokens": 3, "completion_tokens": request["eval_id"], "total_tokens": 3 + request["eval_id"]}

    found = evaluation.predict_timed(_work(spark, sf_dir), ask)
    timed = (F.col("seconds") >= 0) & (F.col("end_ts") >= F.col("start_ts"))
    return found.select("model", "sample_id", "eval_id", "answer", "total_tokens", timed.alias("timed"))


@query
def q_top_k(spark, sf_dir):
    """Whether the right answer is among the first one and three of a sample's answers."""
    found = _entries(spark, sf_dir).withColumn("gold", tiles.tile_name((F.col("sample_id") % 34).cast("int")))
    for k in (1, 3):
        found = metrics.top_k_hit(found, "extracted_answers", "gold", k)
    return found.select("model", "sample_id", "hit_at_1", "hit_at_3")

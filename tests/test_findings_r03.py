from pyspark.sql import functions as F

from tilewright.operators import evaluation


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_done_requests_are_not_broadcast(spark):
    # a few rows by their files, many once they are exploded: Spark's estimate is of the former
    done = spark.range(50).select(F.lit("A").alias("model"), F.lit("d").alias("dataset_path"), F.col("id").alias("sample_id"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("eval_id"))
    work = spark.range(60).select(F.lit("A").alias("model"), F.lit("d").alias("dataset_path"), F.col("id").alias("sample_id"), F.lit(3).alias("eval_id"))
    left, allowed = evaluation.pending(work, done), evaluation.restrict(work, done)
    assert "Broadcast" not in plan(left) + plan(allowed)
    assert left.count() == 10 and allowed.count() == 50


def test_components_do_not_double_their_edges(spark):
    from tilewright.llm import _components

    edges = spark.createDataFrame([(b, a) for b in range(1, 30) for a in {0, b // 2}], "a long, b long").where("a > b")
    large = _components._large(edges, False)
    assert "Generate" not in plan(large)
    assert sorted(map(tuple, large.collect())) == sorted((r.a, 0) for r in edges.collect())
    hot = _components._large(edges, True)
    assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, large.collect()))


def test_files_are_named_several_at_once(spark, tmp_path, monkeypatch):
    import threading

    from tilewright.sources import files, publish

    used = set()
    renamed = files._renamed
    monkeypatch.setattr(files, "_renamed", lambda *a: (used.add(threading.get_ident()), renamed(*a))[1])
    rows = spark.range(40).selectExpr("CAST(id AS STRING) AS value", "id AS part")
    path = str(tmp_path / "set")
    publish.publish(spark, path, "x", lambda at: rows.select("value").repartition(40).write.option("maxRecordsPerFile", 1).text(at), lambda k, n: f"x-{k:05d}.json")
    assert len(used) > 1 and publish.visible(spark, path) is None
    assert sorted(int(r.value) for r in spark.read.text(path).collect()) == list(range(40))
    rows.write.partitionBy("part").text(str(tmp_path / "parts"))
    files.name_folders(spark, str(tmp_path / "parts"), "part", lambda v: f"p{v}", ".jsonl")
    assert {p.name: p.read_text() for p in (tmp_path / "parts").glob("p*.jsonl")} == {f"p{k}.jsonl": f"{k}\n" for k in range(40)}
    assert not list((tmp_path / "parts").glob("part=*"))


def test_files_of_boards_have_parts(spark, sf_dir, duck, same, monkeypatch):
    from tilewright.plans import files, files_oracle

    made = []
    folder = files._board_files
    monkeypatch.setattr(files, "BOARD_ROWS", 100, raising=False)
    monkeypatch.setattr(files, "_board_files", lambda *a: made.append(folder(*a)) or made[-1])
    same(files.q_limit_per_file(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_limit_per_file"]).df())
    rows = spark.read.parquet(f"{made[0]}/boards_*.parquet").groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(rows) > 9 and max(r["count"] for r in rows) < 400
    same(files.q_board_files(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_board_files"]).df())


def test_a_stored_batch_is_computed_once(spark, tmp_path):
    from tilewright.streaming import resume

    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def answer(k):
        computed.add(1)
        return f"a{k}"

    def batch(*ids):
        rows = spark.createDataFrame([("A", "d", k, 0) for k in ids], "model string, dataset_path string, sample_id int, eval_id int")
        return rows.select("*", answer("sample_id").alias("answer"), F.lit("g").alias("gold"), F.lit("2024-01-01").cast("timestamp").alias("start_ts"))

    out = str(tmp_path / "out")
    resume.store(batch(*range(20)), 0, out)
    assert computed.value == 20
    resume.store(batch(*range(10, 40)), 1, out)
    assert computed.value == 50
    assert sorted(r.sample_id for r in resume.stored(spark, out).collect()) == list(range(40))


def test_rows_made_of_a_key_stay_where_it_is(spark, tmp_path, monkeypatch):
    from tilewright.plans import synth
    from tilewright.sources import tables

    spark.range(900).selectExpr("id AS o_orderkey", "id AS o_custkey").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(tables, "DEALT_ROWS", 100, raising=False)
    rows = synth.responses(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 9
    sums = rows.groupBy("model", "dataset", "sample_id").count()
    assert sums.count() == 2700 and sums._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_sums_and_means_of_samples_take_one_pass(spark, sf_dir, duck, same):
    from tilewright.plans import oracle, queries

    found = queries.q_sample_score(spark, sf_dir)
    assert "Join" not in plan(found)
    same(found.toPandas(), duck.sql(oracle.ORACLE_SQL["q_sample_score"]).df())


def test_merged_requests_are_not_moved_again(spark, sf_dir, duck, same):
    from tilewright.plans import oracle, queries

    found = queries.q_merge_dedupe(spark, sf_dir)
    # the keys of each side and the sums; the requests themselves stay
    assert plan(found).count("Exchange") <= 3 and "eval_id" not in "".join(x for x in plan(found).split("\n") if "Exchange" in x)
    same(found.toPandas(), duck.sql(oracle.ORACLE_SQL["q_merge_dedupe"]).df())


def test_statistics_are_not_dealt_by_model(spark, tmp_path):
    from tilewright.operators import metrics
    from tilewright.sources import results

    rows = spark.range(4000).selectExpr("'A' AS model", "'d' AS dataset", "id AS sample_id", "CAST(id % 3 = 0 AS DOUBLE) AS score")
    samples = metrics.outcomes(rows)
    rates = metrics.rates_of(samples).unionByName(metrics.rates_of(samples).withColumn("model", F.lit("none")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results.write_statistics(rates, metrics.classes_of(samples), str(tmp_path / "s"), per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = spark.read.json(str(tmp_path / "s")).withColumn("n", F.size("details.perfect_samples"))
    assert found.where("model = 'A'").agg(F.sum("n"), F.count("*")).first() == (1334, 40)
    assert found.where("model = 'none'").count() == 1
    assert len([p for p in (tmp_path / "s").glob("part-*") if p.stat().st_size > 1000]) == 4


def test_turns_are_looked_for_once(spark, sf_dir, duck, same, monkeypatch):
    from tilewright.operators import sampling
    from tilewright.plans import files, files_oracle

    plans = []
    rebalance = sampling.rebalance
    monkeypatch.setattr(sampling, "rebalance", lambda df, *a, **k: (plans.append(plan(df)), rebalance(df, *a, **k))[1])
    same(files.q_rebalance_unknown(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_rebalance_unknown"]).df())
    assert plans and "regexp" not in plans[0]


def test_listed_results_have_lists_of_bounded_length(spark, sf_dir, duck, same, monkeypatch):
    from tilewright.plans import files, files_oracle
    from tilewright.sources import results

    paths = []
    read = results.read_results
    monkeypatch.setattr(results, "read_results", lambda s, path, *a: (paths.append(path), read(s, path, *a))[1])
    monkeypatch.setattr(files, "LISTED_ENTRIES", 2, raising=False)
    same(files.q_results_listed(spark, sf_dir).toPandas(), duck.sql(files_oracle.ORACLE_SQL["q_results_listed"]).df())
    sizes = spark.read.text(paths[0], wholetext=True).selectExpr("size(from_json(value, 'array<struct<model_name:string>>')) AS n")
    assert sizes.agg(F.max("n")).first()[0] <= 3


def test_boards_are_dealt_once(spark, sf_dir):
    from tilewright.plans import queries

    found = plan(queries.q_prompt(spark, sf_dir))
    assert found.count("_dealt(") <= 2  # the node's name and its output
    assert "_dealt" not in found[found.index("Exchange") :]


def test_whole_numbers_are_taken_as_they_are(spark):
    from tilewright.sources import boards

    row = spark.range(3).select(*[(F.col("id") + i).cast("int").alias(f"c{i}") for i in range(511)], F.lit("g").alias("c511"))
    whole, doubles = boards.pack(row), boards.pack(row.select(*[F.col(c).cast("double") if c != "c511" else F.col(c) for c in row.columns]))
    assert plan(whole.select("hand")).count("double") == 0
    assert whole.collect() == doubles.collect()


def test_boards_are_worked_out_in_chunks(monkeypatch):
    import pyarrow as pa

    from tilewright.functions import boards
    from tilewright.plans import synth

    sizes = []
    inner = boards.in_chunks(lambda x: (sizes.append(len(x)), x)[1])
    monkeypatch.setattr(boards, "CHUNK", 100)
    assert inner(pa.array(range(950))).to_pylist() == list(range(950)) and max(sizes) == 100
    assert len(inner(pa.array([], pa.int64()))) == 0
    cut = synth._dealt(pa.array(range(950)))
    monkeypatch.setattr(boards, "CHUNK", 10_000)
    assert cut.equals(synth._dealt(pa.array(range(950))))

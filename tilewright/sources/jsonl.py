"""JSON lines with one field text: reading, and writing in files, parts and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from . import files


def read_lines(spark: SparkSession, path: str, keep_empty: bool = False) -> DataFrame:
    """line: the raw lines of a file or of the *.jsonl files of a folder, which may be compressed (*.jsonl.gz)."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl{,.gz}").text(path).withColumnRenamed("value", "line")
    return lines if keep_empty else lines.where(strip(F.col("line")) != "")


def parse(lines: DataFrame) -> DataFrame:
    """text of each line that is a JSON object; a missing text is empty, lines that are none go."""
    parsed = F.from_json("line", "text string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    found = lines.select(parsed.alias("_r")).where("_r IS NOT NULL AND _r._bad IS NULL")
    return found.select(F.coalesce("_r.text", F.lit("")).alias("text"))


def to_line(text: str = "text") -> Column:
    return F.to_json(F.struct(F.col(text).alias("text")))


def write_lines(df: DataFrame, path: str, text: str = "text", name: str | None = None) -> None:
    """A line for each row; with a name the files are name.jsonl, or name-00000.jsonl and so on where there are several."""
    df.select(to_line(text).alias("value")).write.mode("overwrite").text(path)
    if name is not None:
        files.name_files(df.sparkSession, path, lambda k, n: f"{name}-{k:05d}.jsonl" if n > 1 else f"{name}.jsonl")


#: Tasks that write parts, at most; beyond, a task writes several parts, one after the other.
PART_TASKS = 10_000


def dealt_parts(df: DataFrame, part: str, order: str, tasks: int = PART_TASKS) -> DataFrame:
    """df with one partition for each part number from 0 up to the greatest, sorted by part and order."""
    parts = (df.agg(F.max(part)).first()[0] or 0) + 1
    n = max(1, min(parts, tasks))
    return df.repartitionById(n, F.coalesce(F.pmod(F.col(part), F.lit(n)), F.lit(0)).cast("int")).sortWithinPartitions(part, order)


def write_parts(df: DataFrame, path: str, part: str, order: str, line: str = "line") -> None:
    """One folder for each part, its lines in the given order. A part is a task of its own, so parts of equal sizes are tasks of equal sizes."""
    dealt_parts(df, part, order).select(F.col(part), F.col(line).alias("value")).write.mode("overwrite").partitionBy(part).text(path)


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket", line: str = "line") -> None:
    """One folder for each bucket, in as many files as there are tasks."""
    df.select(F.col(bucket), F.col(line).alias("value")).write.mode("overwrite").partitionBy(bucket).text(path)


def write_named(df: DataFrame, path: str, file_name: str, order: list[str], line: str = "line") -> None:
    """One file for each value of file_name, which it is called, its lines in order; a file is written by one task, as a stream."""
    rows = df.repartition(F.col(file_name)).sortWithinPartitions(file_name, *order)
    rows.select(F.col(file_name), F.col(line).alias("value")).write.mode("overwrite").partitionBy(file_name).text(path)
    files.name_folders(df.sparkSession, path, file_name, lambda v: v, "")


def write_in_order(df: DataFrame, path: str, file_name: str, line: str = "line", compression: str | None = None) -> None:
    """A file for each value of file_name, which it is called (and .gz, with gzip), of rows that lie in order in the task that has the file.

    Unlike write_named() this moves and sorts no lines. A name whose rows lie in
    several tasks gets numbered files.
    """
    if compression not in (None, "gzip"):
        raise ValueError("compression is gzip or None")
    with files.settings(df.sparkSession, files.UNSORTED):
        df.select(F.col(file_name), F.col(line).alias("value")).write.mode("overwrite").option("compression", compression or "none").option("maxRecordsPerFile", 0).partitionBy(file_name).text(path)
    suffix = ".jsonl.gz" if compression else ".jsonl"
    files.name_folders(df.sparkSession, path, file_name, lambda v: v.removesuffix(".jsonl"), suffix)


def part_name(prefix: str, k: int) -> str:
    return f"{prefix}_{k:05d}.jsonl"


def write_part_files(df: DataFrame, path: str, part: str, order: str, prefix: str, line: str = "line") -> int:
    """write_parts() as files prefix_00000.jsonl and so on; gives their number. Parts lie in folders of files.LISTED at most until they have their names."""
    rows = dealt_parts(df.withColumn("_group", F.floor(F.col(part) / files.LISTED)), part, order).sortWithinPartitions("_group", part, order)
    rows.select("_group", F.col(part), F.col(line).alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("_group", part).text(path)
    return files.name_parts(df.sparkSession, path, "_group", part, lambda k: part_name(prefix, k))


def write_bucket_files(df: DataFrame, path: str, bucket: str = "bucket", line: str = "line") -> None:
    """write_buckets() as files named after the buckets, numbered where a bucket has several."""
    write_buckets(df, path, bucket, line)
    files.name_folders(df.sparkSession, path, bucket, lambda v: v, ".jsonl")


BALANCED = "train_balanced"


def write_balanced(df: DataFrame, path: str, line: str = "line") -> int:
    """The files of sampling.rebalance(), train_balanced_00000.jsonl and so on, each shuffled within; gives their number."""
    return write_part_files(df, path, "file_no", "place", BALANCED, line)

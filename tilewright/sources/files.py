"""Names of output files. Spark's writers name files themselves; here they get the names that other programs look for."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch

RENAMERS = 16  # threads that ask the file system for renames


def _listed(spark: SparkSession, path: str):
    """(file system, status of each entry of a folder by name)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.listStatus(folder)) if fs.exists(folder) else []
    return fs, {s.getPath().getName(): s for s in found}


def _renamed(spark: SparkSession, fs, source, path: str) -> None:
    """Rename a file; what has the name already is replaced. An error if the file system does not do it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"{source.toString()} could not be renamed to {path}")


def _each(step: Callable[[str], object], names: list[str]) -> None:
    """Do step for each name: one after the other if they are few, else several at once, since a file system takes its time for each."""
    if len(names) <= RENAMERS:
        for name in names:
            step(name)
        return
    with ThreadPoolExecutor(RENAMERS) as pool:
        list(pool.map(step, names))


def name_files(spark: SparkSession, path: str, name: Callable[[int, int], str]) -> None:
    """Give the part files in a folder the names name(k, how many there are). Only names are changed, no data is moved."""
    fs, found = _listed(spark, path)
    parts = sorted(n for n in found if n.startswith("part-"))
    names = {part: name(k, len(parts)) for k, part in enumerate(parts)}
    _each(lambda part: _renamed(spark, fs, found[part].getPath(), f"{path}/{names[part]}"), parts)


def name_folders(spark: SparkSession, path: str, column: str, name: Callable[[str], str], suffix: str) -> None:
    """Turn the folders column=value of a partitioned table into files name(value) + suffix, numbered where a folder has several.

    What file names cannot have becomes an underscore; values whose files would
    then have one name are an error. A folder is deleted when all its files have
    been moved.
    """
    fs, found = _listed(spark, path)
    folders = sorted(n for n in found if n.startswith(f"{column}="))
    stems = {n: re.sub(r'[\\/:*?"<>|]', "_", name(unquote(n.split("=", 1)[1]))) for n in folders}
    if len(set(stems.values())) < len(stems):
        raise ValueError(f"values of {column} give the same file name")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    parts: dict[str, list[str]] = {n: [] for n in folders}

    def listed(folder: str) -> None:
        inside = fs.listStatus(at(f"{path}/{folder}"))
        names = (s.getPath().getName() for s in inside)
        parts[folder] = sorted(n for n in names if n.startswith("part-"))

    def moved(folder: str) -> None:
        for k, part in enumerate(parts[folder]):
            new = f"{stems[folder]}{f'-{k:05d}' if len(parts[folder]) > 1 else ''}{suffix}"
            if new in found:
                fs.delete(at(f"{path}/{new}"), False)
            if not fs.rename(at(f"{path}/{folder}/{part}"), at(f"{path}/{new}")):
                raise OSError(f"{path}/{folder}/{part} could not be renamed to {path}/{new}")

    def emptied(folder: str) -> None:
        listed(folder)
        if parts[folder]:
            raise OSError(f"{path}/{folder} still has files")
        fs.delete(at(f"{path}/{folder}"), True)

    for step in (listed, moved, emptied):
        _each(step, folders)


#: Settings with which rows of a partitioned table are written as they come, as long as a task has no more values than that.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """With other settings of Spark inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def whole_files(spark: SparkSession, path: str) -> Iterator[None]:
    """Inside, a task reads one file of a folder, and all of it, so that rows come in the file's order."""
    _, found = _listed(spark, path)
    longest = str(max([s.getLen() for s in found.values()], default=0) + 1)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": longest, "spark.sql.files.openCostInBytes": longest}):
        yield


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str, names: Callable[[str], bool] | None = None) -> None:
    """Delete a folder, or those of its entries whose names satisfy `names`."""
    if names is None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        return
    fs, found = _listed(spark, path)
    for name, status in found.items():
        if names(name):
            fs.delete(status.getPath(), True)


def file_name() -> Column:
    """The name of the file that a row was read from."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -1)


def whole_name(name: Column, suffix: str) -> Column:
    """The name of the file that a numbered or compressed file is a part of or stands for; of others their own."""
    return F.regexp_replace(F.regexp_replace(name, rf"(?<=\.{suffix})\.gz$", ""), rf"-\d{{5}}(?=\.{suffix}$)", "")


def output_name(folder: Column, path: Column) -> Column:
    """The name of the JSON lines made from a Parquet file: the folder's name and the file's without its last extension."""
    base = F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)
    stem = F.when(F.locate(".", base, 2) > 0, F.regexp_replace(base, r"\.[^.]*$", "")).otherwise(base)
    return F.concat(folder, F.lit("-"), stem, F.lit(".jsonl"))


#: Files that are listed at once, at most, where their number grows with the rows.
LISTED = 1 << 14


def name_parts(spark: SparkSession, path: str, group: str, part: str, name: Callable[[int], str]) -> int:
    """Turn the one file in each of the folders group=g/part=k of a new table into a file name(k), one group after the other; gives how many there are.

    Only the files of a group are known to the driver at once, so its memory
    does not follow the table. Their paths come in one call to the JVM.
    """
    fs, groups = _listed(spark, path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
    n = 0
    for g in sorted(g for g in groups if g.startswith(f"{group}=")):
        found = jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(at(f"{literal}/{g}/{part}=*/part-*")).mkString("\n")
        files = re.findall(rf"/{re.escape(g)}/{re.escape(part)}=([^/\n]+)/(part-[^/\n]+)", found)
        if len({k for k, _ in files}) < len(files):
            raise OSError(f"{path}/{g} has parts of several files")

        def moved(file: tuple[str, str], g: str = g) -> None:
            k, source = file
            if not fs.rename(at(f"{path}/{g}/{part}={k}/{source}"), at(f"{path}/{name(int(k))}")):
                raise OSError(f"{path}/{g}/{part}={k}/{source} could not be renamed")

        _each(moved, files)
        fs.delete(at(f"{path}/{g}"), True)
        n += len(files)
    return n


def _lines(files: DataFrame) -> DataFrame:
    files = files.select(file_name().alias("file_name"), F.regexp_replace("value", r"\n\z", "").alias("value"))
    return files.select("file_name", F.posexplode(F.split("value", "\n")).alias("place", "line")).withColumn("place", F.col("place") + 1)


def lines_in_order(spark: SparkSession, path: str, suffix: str = "jsonl") -> DataFrame:
    """file_name, place (from 1), line of the files of a folder, each of which a task reads whole."""
    return _lines(spark.read.option("pathGlobFilter", f"*.{suffix}").text(path, wholetext=True))


def numbered_in_order(spark: SparkSession, path: str, name: Callable[[int], str], n: int) -> DataFrame:
    """lines_in_order() of the files name(0) to name(n - 1) of a folder.

    Where they are more than LISTED, they are read that many at a time into a
    table: Spark keeps on the driver what it knows of each file of a scan.
    """
    if n <= LISTED:
        return lines_in_order(spark, path)
    table, tasks = scratch(spark, "lines"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(tasks)
    try:
        spark.conf.set(tasks, "64")  # else a task looks for each file
        for a in range(0, n, LISTED):
            some = spark.read.text([f"{path}/{name(k)}" for k in range(a, min(n, a + LISTED))], wholetext=True)
            _lines(some).write.mode("append").parquet(table)
    finally:
        spark.conf.set(tasks, before)
    return spark.read.parquet(table)

"""Tables in the folder that driver and executors share: for cutting lineage, and for files that are read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own[app] = tempfile.mkdtemp(prefix="tilewright-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{_own[app]}")
    return f"file://{_own[app]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder; it belongs to the scope that is open, if one is."""
    path = f"{_part(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].paths.append(path)
    return path


class Scope:
    """The scratch paths of one piece of work."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, result: DataFrame) -> DataFrame:
        """result, with the tables that its plan reads kept beyond the scope's end."""
        read = read_by(result)
        self.kept.update(p for p in self.paths if _qualified(self.spark, p) in read)
        return result


_scopes: list[Scope] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """What is written inside is deleted at the end, also after an error, but for what is kept.

    What is kept belongs to the scope around this one, if there is one.
    """
    mine = Scope(spark)
    _scopes.append(mine)
    try:
        yield mine
    except BaseException:
        mine.kept.clear()
        raise
    finally:
        _scopes.remove(mine)
        for path in mine.paths:
            if path not in mine.kept:
                _forget(spark, path)
            elif _scopes:
                _scopes[-1].paths.append(path)


def read_by(result: DataFrame) -> set[str]:
    """The folders that the plan of a DataFrame reads."""
    paths, leaves = set(), result._jdf.queryExecution().analyzed().collectLeaves().toList()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or not leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            continue
        roots = leaf.relation().location().rootPaths()
        paths.update(_qualified(result.sparkSession, roots.apply(i).toString()) for i in range(roots.size()))
    return paths


def _qualified(spark: SparkSession, path: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _part(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tilewright/{spark.sparkContext.applicationId}"


#: Tables that were written: application, path, and a weak reference to what every plan that reads the table holds.
_tables: list[tuple[str, str, object]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: computed once, with a short lineage, and safe when executors are lost.

    The table goes with the scope that it was written in.  Outside of scopes,
    and after them for what was kept, it is deleted, when another is written,
    once the JVM has collected every plan that reads it; so a chain of steps
    whose results are stored needs no more room than the last of them.
    """
    spark = df.sparkSession
    sweep(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    files = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    _tables.append((spark.sparkContext.applicationId, path, spark.sparkContext._jvm.java.lang.ref.WeakReference(files)))
    table.scratch_path = path
    return table


def sweep(spark: SparkSession) -> None:
    """Delete the tables that no plan reads any more."""
    app = spark.sparkContext.applicationId
    for entry in [t for t in _tables if t[0] == app and t[2].get() is None]:
        _tables.remove(entry)
        _delete(spark, entry[1])


def drop(table: DataFrame) -> None:
    """Delete a table from written(), of which nothing is read any more."""
    _forget(table.sparkSession, table.scratch_path)


def _forget(spark: SparkSession, path: str) -> None:
    _tables[:] = [t for t in _tables if t[1] != path]
    _delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder. Results that have not been stored yet can't be read after that."""
    _tables[:] = [t for t in _tables if t[0] != spark.sparkContext.applicationId]
    _delete(spark, _part(spark))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

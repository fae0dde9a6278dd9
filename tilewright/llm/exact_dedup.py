"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort
places equal texts next to each other, and one pass over each partition
compares neighbours in full.  The splitters' key is the first characters of the
normalised text, then its SHA-256, then the id: whole texts as keys would have
to be sampled to the driver, and a text that fills several partitions is split
among them by id, so no partition has to hold a whole group of copies.  Texts
with the same first characters thus lie in the order of their digests.  A group
cut by a partition's border is put together from one row for each side, again
by full comparison.

Texts are normalised and hashed once, into a written table, and travel once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ._common import SPACES, drop, written

_PREFIX = 32  # characters of a text in the splitters' key

_RUNS = "doc_id long, text_sha256 string, part int, run_keep long, run_size long, first boolean, run int, border string"
_RUN_NAMES = [x.split()[0] for x in _RUNS.split(", ")]


def normalised(text: str | Column) -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACES, " ")


def _sorted_texts(docs: DataFrame, id_col: str, text_col: str, keep: list[str], partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows, the table that they are read from). Columns doc_id, text, text_sha256, part, and those in keep, sorted by content within numbered partitions of ranges of contents."""
    # under names of our own, whatever the others are
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    rows = written(rows.withColumn("text_sha256", F.sha2(normalised("text"), 256)).withColumn("prefix", F.substring(normalised("text"), 1, _PREFIX)), "hashed")
    keys = [F.col("prefix"), F.col("text_sha256"), F.col("doc_id").asc_nulls_last()]
    parts = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys).drop("prefix").withColumn("part", F.spark_partition_id()), rows


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Each batch that has rows, its normalised texts, and the places in it where another text begins."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        norm = pc.replace_substring_regex(batch["text"].fill_null(""), SPACES, " ")
        same = np.zeros(batch.num_rows, bool)
        if len(same) > 1:
            same[1:] = pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        same[0] = last is not None and norm[0].as_py() == last
        last = norm[len(norm) - 1].as_py()
        yield batch, norm, np.flatnonzero(~same)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the first id and the size of their run of equal texts.

    run is 0 in the partition's first run and 1 in its last, which may go on
    next door; the first row of these has the text as border.  Only the ids of
    one run are kept at a time.
    """
    pending: list[pa.Array] = []
    sha = part = border = None
    opening = True

    def closed(is_last: bool) -> pa.RecordBatch:
        nonlocal opening
        ids = pa.concat_arrays(pending)
        n = len(ids)
        first = np.zeros(n, bool)
        first[0] = True
        run = pa.scalar(0 if opening else 1 if is_last else None, pa.int32())
        borders = pa.array([border if opening or is_last else None] + [None] * (n - 1), pa.string())
        opening = False
        return pa.RecordBatch.from_arrays([ids, pa.repeat(sha, n), pa.repeat(part, n), pa.repeat(ids[0], n), pa.repeat(pa.scalar(n, pa.int64()), n), pa.array(first), pa.repeat(run, n), borders], names=_RUN_NAMES)

    def singles(batch: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        """Runs of one row each, all inside the batch and at none of the partition's borders."""
        rows = batch.select(["doc_id", "text_sha256", "part"]).take(pa.array(at))
        n = len(at)
        return pa.RecordBatch.from_arrays([*rows.columns, rows["doc_id"], pa.array(np.ones(n, np.int64)), pa.array(np.ones(n, bool)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=_RUN_NAMES)

    for batch, norm, starts in _starts(batches):
        ids = batch["doc_id"]
        bounds = np.append(starts, batch.num_rows)
        if bounds[0] > 0:
            pending.append(ids[: bounds[0]])
        lone = np.diff(bounds) == 1
        lone[-1:] = False  # the batch's last run may go on
        alone = []
        for k, a in enumerate(starts):
            if pending:
                yield closed(False)
                pending = []
            if lone[k] and not opening:
                alone.append(a)
                continue
            pending = [ids[a : bounds[k + 1]]]
            sha, part, border = batch["text_sha256"][a], batch["part"][a], norm[a].as_py()
        if alone:
            yield singles(batch, np.array(alone))
    if pending:
        yield closed(True)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one
    space.  Null texts count as empty texts, and all empty texts are equal to
    each other.  Of equal texts the row with the smallest id is kept; null ids
    come last.  Of rows that also share the id exactly one is kept.  An empty
    table gives an empty result.  Other columns are not looked at.
    """
    rows, hashed = _sorted_texts(docs, id_col, text_col, [], partitions)
    runs = written(rows.mapInArrow(_runs, _RUNS), "runs")
    drop(hashed)
    # at most two of these for each partition
    of_text = Window.partitionBy("border")
    cut = runs.where("border IS NOT NULL").select("part", "run", F.min("run_keep").over(of_text).alias("all_keep"), F.sum("run_size").over(of_text).alias("all_size"), (F.row_number().over(of_text.orderBy("part", "run")) == 1).alias("leads"))
    cut = written(cut, "borders")
    inner = runs.where("run IS NULL").select("doc_id", F.col("run_keep").alias("keep_id"), F.col("run_size").alias("group_size"), F.col("first").alias("kept"), "text_sha256")
    outer = runs.where("run IS NOT NULL").join(cut, ["part", "run"]).select("doc_id", F.col("all_keep").alias("keep_id"), F.col("all_size").alias("group_size"), (F.col("first") & F.col("leads")).alias("kept"), "text_sha256")
    return inner.unionByName(outer)


def _firsts(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first row of each run of equal texts of a sorted partition; border is the text of its first and its last run."""

    def finished(rows: pa.RecordBatch, norm: pa.Array, edge: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[rows[c] for c in names], norm if edge else pa.nulls(len(norm), pa.string())], names=[*names, "border"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last run's first row, which may be the partition's last
        opening = True
        for batch, norm, starts in _starts(batches):
            if not len(starts):
                continue
            if held is not None:
                yield finished(*held, opening)
                opening = False
            at = pa.array(starts)
            rows, texts = batch.take(at), norm.take(at)
            if opening and len(starts) > 1:
                yield finished(rows.slice(0, 1), texts.slice(0, 1), True)
                opening = False
                rows, texts = rows.slice(1), texts.slice(1)
            yield finished(rows.slice(0, rows.num_rows - 1), texts.slice(0, rows.num_rows - 1), False)
            held = rows.slice(rows.num_rows - 1), texts.slice(rows.num_rows - 1)
        if held is not None:
            yield finished(*held, True)

    return first


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """The rows of docs that exact_duplicates() keeps, with all their columns; names that differ only in case are not allowed.

    Null texts count as empty and are equal to each other.  Of equal texts the
    row with the smallest id stays, null ids last; of those that share it, one.
    An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c != text_col]
    rows, hashed = _sorted_texts(docs, id_col, text_col, others, partitions)
    rows = rows.drop("text_sha256")
    names = rows.columns
    firsts = written(rows.mapInArrow(_firsts(names), StructType([*rows.schema.fields, StructField("border", StringType())])), "firsts")
    drop(hashed)
    order = Window.partitionBy("border").orderBy(F.col("doc_id").asc_nulls_last(), "part")
    cut = firsts.where("border IS NOT NULL").withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
    kept = firsts.where("border IS NULL").unionByName(cut)
    names = {c: f"keep_{i}" for i, c in enumerate(others)} | {text_col: "text"}
    return kept.select(*[F.col(names[c]).alias(c) for c in docs.columns])

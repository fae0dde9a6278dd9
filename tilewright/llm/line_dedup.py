"""Line deduplication over levelled sorted runs of line hashes.

The distinct keys of each document's lines are hashed once.  Documents come in
batches, those with the largest ids first.  A batch's keys are anti-joined with
the runs that are there, which drops what they have settled: keys of enough
documents whose last holder is known.  What is left becomes the batch's own
run, sorted and bucketed by hash, so that runs are merged with each other and
with batches bucket by bucket.  When a level has FANOUT runs they are compacted
into one run of the next level.  In the end the runs say which keys are common
and which document keeps them, and each document drops its other common lines.

No task holds all rows of a key or all lines of a batch: a key's rows are
counted before they are shuffled by key, and what a common key is looked up for
is dealt out to several tasks.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scope
from ..shipping import ship
from ._common import scratch, written
from ._components import HOT, joined

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
_BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a UTF-8 line without white space at its ends and with A-Z in lower case; None if it has fewer code points than min_chars."""
    key = line.strip(_BLANK)
    # a code point has four bytes at most
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part, key: the distinct line keys of each row with an id.

    part is the CRC-32 of the text: rows that share an id but not a text lie in
    different parts, so that no one set of keys has to hold them all.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, found = [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"].cast(pa.binary()), strict=True):
                text = text.as_py() or b""
                mine = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                ids += [doc_id.as_py()] * len(mine)
                parts += [zlib.crc32(text)] * len(mine)
                found += mine
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "part", "key"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    return rows.mapInArrow(keys, "doc_id long, part long, key binary")


class Runs:
    """Levels of runs (key, docs, last): in how many documents a key was counted, and the largest id among them.

    A run is a table sorted and bucketed by key.  A key may be in several runs;
    its documents are the sum over them, since each is counted in one batch.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc_id, key), whose documents are in no other batch."""
        own = keys.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("last"))
        for name in self._names():
            settled = self.spark.table(name).where(F.col("docs") >= self.min_docs).select(F.col("key").alias("of_key"), F.col("last").alias("held"))
            own = own.join(settled, (F.col("key") == F.col("of_key")) & (F.col("held") >= F.col("last")), "left_anti")
        self._put(own, 0)

    def common(self) -> DataFrame:
        """key, docs, last of the keys of at least min_docs documents.

        docs is min_docs at least, but no full count: what was settled is not
        counted on.
        """
        names = self._names()
        if not names:
            return self.spark.createDataFrame([], "key binary, docs long, last long")
        return self._merged(names).where(F.col("docs") >= self.min_docs)

    def clear(self) -> None:
        for name in self._names():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        """One run of several. Two are merged bucket by bucket, without a shuffle."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("key", F.col("docs").alias("more"), F.col("last").alias("also"))
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            rows = rows.join(other, "key", "full_outer").select("key", docs.alias("docs"), F.greatest("last", "also").alias("last"))
        return rows

    def _put(self, rows: DataFrame, level: int) -> None:
        """Write rows, of which a partition has few buckets' keys, as a run; compact the level if it is full."""
        name = f"tilewright_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", scratch(self.spark, "run")).saveAsTable(name)
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            self._put(self._merged(self.levels[level]), level + 1)
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []


def _kept(min_chars: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, gone = [], [], []
            for text, drop in zip(batch["text"].cast(pa.binary()), batch["drop"], strict=True):
                parts = (text.as_py() or b"").split(b"\n")
                lines.append(len(parts))
                if drop.is_valid:
                    drop = set(drop.as_py())
                    parts = [p for p in parts if line_key(p, min_chars) not in drop]
                gone.append(lines[-1] - len(parts))
                texts.append(b"\n".join(parts))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])

    return kept


def without_common_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of docs: doc_id, text, n_lines, n_dropped.

    Texts are split at line feeds; a null or empty text is one empty line.  A
    line's key is the line without white space (space, tab to carriage return)
    at its ends, A-Z in lower case.  Keys of at least min_chars code points that
    are in at least min_docs documents lose all their lines, except those of
    the largest id that holds them; n_lines counts before that.  Documents are
    told apart by id: rows that share one count as one document, and each loses
    or keeps its own lines.  Rows without an id are counted in no document and
    keep their lines.  An empty table gives an empty result.  Other columns are
    not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with scope(spark) as tables:
        cuts = rows.agg(F.percentile_approx("doc_id", [b / batches for b in range(1, batches)], 10_000)).first()[0] or []
        batch = sum((F.col("doc_id") <= cut).cast("int") for cut in cuts) if cuts else F.lit(0)
        path = scratch(spark, "line-keys")
        line_keys(rows, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
        keys = spark.read.schema("doc_id long, part long, key binary, batch int").parquet(path)
        runs = Runs(spark, min_docs, fanout)
        try:
            for b in range(len(cuts) + 1):
                runs.add(keys.where(F.col("batch") == b))
            common = written(runs.common().withColumnRenamed("docs", "n"), "common")
        finally:
            runs.clear()
        hot = not common.where(F.col("n") > HOT).isEmpty()
        drops = joined(keys.select("doc_id", "part", "key"), common, ["key"], hot).where("doc_id < last")
        drops = tables.keep(written(drops.groupBy("doc_id", "part").agg(F.collect_set("key").alias("drop")), "drops"))
    some = rows.where("doc_id IS NOT NULL").withColumn("part", F.crc32(F.coalesce("text", F.lit("")))).join(drops, ["doc_id", "part"], "left").select("doc_id", "text", "drop")
    others = rows.where("doc_id IS NULL").withColumn("drop", F.lit(None).cast("array<binary>"))
    return some.unionByName(others).mapInArrow(_kept(min_chars), "doc_id long, text string, n_lines long, n_dropped long")

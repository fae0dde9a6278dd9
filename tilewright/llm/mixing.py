"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are shuffled by a hash of their id; later passes over
the source start where the last one ended.  A document's virtual finish time is
the number of its source's words up to its end, divided by the source's target
weight.  The queue is sorted by these times over all sources and truncated at
the total budget: what lies before the cut is taken, what lies behind it is
not, and nothing else limits a source.

As in packet networks, a long document is queued in packets, each with a
virtual finish time of its own (the document's is that of its last one), and
what the cut falls into is taken up to the cut.  So a source misses its target
by about a packet, however long its documents are.

Running sums are taken in two steps, within buckets whose number follows the
number of rows and over the buckets' totals; the cut is looked for in one of
the sorted queue's partitions.  So no task has to hold a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, id_text, written

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = "mix"
PACKET = 128  # words of a document that are queued together, at most
GROUP = 1 << 16  # rows that a task of a running sum holds, about


def words(text: str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, budget: int | None = None) -> DataFrame:
    """For each source its size in words and its target.

    Sources in code point order, null last, get the weights in turn.  They
    share the budget (default: the size of everything) by weight; a target
    stops at `repeats` times the source's size, and the rest is shared again.
    A budget above what repeats allow gives every source its most.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(every) - 1) % len(weights)
    sources = sources.select("source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("weight"))
    sources = sources.withColumn("most", (F.col("source_size") * repeats).cast("double"))
    # Sources fill up in the order of what they can take for each unit of weight. The level at which the rest fills follows from those before.
    fill = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole).cast("double") if budget is None else F.lit(float(budget))
    sources = sources.select(
        "*",
        ((total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"),
        F.row_number().over(fill).alias("place"),
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("place", "level"))
    sources = sources.withColumn("rest", F.min(fits).over(whole))
    target = F.when(F.col("rest").isNull() | (F.col("place") < F.col("rest.place")), F.col("most")).otherwise(F.col("rest.level") * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def shuffled(sizes: DataFrame, targets: DataFrame, buckets: int = 1) -> DataFrame:
    """sizes with source_size, target and before: the words of the source's documents that come earlier in the shuffle.

    Earlier is what has the smaller key; then go doc_id, size and row.  buckets
    is how many parts of a source are summed apart, at least.
    """
    digits = 1  # of the key, which is hexadecimal, that make a bucket
    while 16**digits < buckets:
        digits += 1
    sized = sizes.withColumn("bucket", F.substring("key", 1, digits))
    totals = sized.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    shares = targets.select(F.col("source").alias("of_source"), "source_size", "target")
    offsets = offsets.join(shares.withColumnRenamed("of_source", "s"), F.col("of_source").eqNullSafe(F.col("s"))).drop("s")
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket")))
    return rows.select("row", "doc_id", "source", "size", "source_size", "target", (F.col("offset") + F.col("inside")).alias("before"))


def _order() -> list[Column]:
    return [F.col("virtual_finish"), F.col("source").asc_nulls_last(), F.col("end")]


def queue(rows: DataFrame, repeats: int = REPEATS, packet: int = PACKET, parts: int = 1) -> DataFrame:
    """source, virtual_finish, end, words, part of every packet of the rows of shuffled(), in `repeats` passes.

    end is the number of the source's words up to the packet's end.  part
    numbers partitions that follow each other in the queue's order:
    virtual_finish, then source, null last, then end.
    """
    passes = rows.where("size > 0 AND target > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    packets = passes.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(packet).cast("long"))))
    packets = packets.withColumn("words", F.least(F.lit(packet).cast("long"), F.col("size") - F.col("from")))
    end = F.col("pass") * F.col("source_size") + F.col("before") + F.col("from") + F.col("words")
    packets = packets.select("source", (end / F.col("target")).alias("virtual_finish"), end.alias("end"), "words")
    parts = max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return packets.repartitionByRange(parts, *_order()).withColumn("part", F.spark_partition_id())


def truncated(queued: DataFrame, budget: int) -> DataFrame:
    """source, served: the words of each source that lie before the budget's end in the queue; sources without any are left out."""
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = queued.groupBy("part").agg(F.sum("words").alias("total")).withColumn("offset", F.coalesce(F.sum("total").over(every), F.lit(0)))
    cut = parts.where((F.col("offset") <= budget) & (F.col("offset") + F.col("total") > budget)).first()
    if cut is None:  # the budget is enough for everything
        return queued.groupBy("source").agg(F.sum("words").alias("served"))
    ahead = Window.partitionBy("part").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    position = F.coalesce(F.sum("words").over(ahead), F.lit(0)) + cut["offset"]
    last = queued.where(F.col("part") == cut["part"]).select("source", F.least("words", F.lit(budget) - position).alias("words")).where("words > 0")
    return queued.where(F.col("part") < cut["part"]).select("source", "words").unionByName(last).groupBy("source").agg(F.sum("words").alias("served"))


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, budget: int | None = None, seed: str = SEED, packet: int = PACKET, group: int = GROUP, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, taken.

    taken is how many of the document's words the mix takes, repeats counted,
    at most `repeats` times its size.  Null texts and texts without words have
    size 0 and nothing is taken of them; a null source is a source like others,
    and comes last.  Ties in the shuffle (equal ids) go by size, so repeated
    rows change nothing but which of them is served first.  The same input
    gives the same result.  An empty table gives an empty result.  Other
    columns are not looked at.  With row_col, a column of numbers that differ,
    the result has these too, as row.
    """
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    sizes = docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(text_col).alias("size"), F.md5(F.concat(F.lit(f"{seed}-"), id_text(id_col))).alias("key"))
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, weights, repeats, budget), "targets")
    n, packets, total = sizes.agg(F.count("*"), F.sum(F.ceil(F.col("size") / packet)), F.sum("size")).first()
    rows = written(shuffled(sizes, targets, n // group), "shuffled")
    queued = written(queue(rows, repeats, packet, repeats * (packets or 0) // group), "queue")
    served = truncated(queued, (total or 0) if budget is None else budget)
    rows = rows.join(served.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")), "left")
    left = F.coalesce("served", F.lit(0)) - F.col("before")
    passes = [F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("source_size") * p)) for p in range(repeats)]
    taken = sum(passes[1:], passes[0]).cast("long").alias("taken")
    return rows.select(*([] if row_col is None else ["row"]), "doc_id", "size", "source_size", "target", taken)

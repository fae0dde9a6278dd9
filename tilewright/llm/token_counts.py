"""Token counts of a corpus from the exact histogram of its documents' encoded lengths.

Documents are aggregated by their number of tokens, first within each Arrow
batch and then over all.  Running sums over the histogram, from both ends,
answer for every context limit how many documents and tokens lie within it,
what is left when longer documents are cut at it, and every quantile.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import written
from .byte_bpe import loaded

SLICE = 1024  # lengths summed together before the slices are


def histogram(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """n_tokens, n_docs: how many rows of docs have each length.

    Null texts count as empty and have 0 tokens; repeated rows each count.  An
    empty table gives an empty result.  Other columns are not looked at.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            lengths, n = np.unique(np.fromiter(bpe.lengths(t.as_py() or "" for t in batch["text"]), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array(n.astype(np.int64))], names=["n_tokens", "n_docs"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "n_tokens long, n_docs long")
    return parts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def limits(lengths: DataFrame) -> DataFrame:
    """The histogram with what each length would give as a context limit.

    docs_within and tokens_within: documents up to that length and their
    tokens; docs_beyond and tokens_beyond: longer ones; truncated_total: all
    tokens when longer documents are cut there; share_within: documents within
    over all.  An empty histogram gives an empty result.
    """
    rows = written(lengths.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / SLICE).alias("slice")), "lengths")
    slices = rows.groupBy("slice").agg(F.sum("n_docs").alias("slice_docs"), F.sum("tokens").alias("slice_tokens"))
    # one row for each slice of lengths: as many as the longest document has slices
    after = Window.orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices = slices.select(
        "slice",
        F.coalesce(F.sum("slice_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("slice_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("slice_docs").over(every).alias("all_docs"),
        F.sum("slice_tokens").over(every).alias("all_tokens"),
    )
    longer = Window.partitionBy("slice").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    beyond = lambda c: F.coalesce(F.sum(c).over(longer), F.lit(0))
    rows = rows.withColumn("docs_beyond", beyond("n_docs")).withColumn("tokens_beyond", beyond("tokens")).join(slices, "slice")
    docs, tokens = F.col("docs_beyond") + F.col("docs_after"), F.col("tokens_beyond") + F.col("tokens_after")
    return rows.select(
        "n_tokens",
        "n_docs",
        (F.col("all_docs") - docs).alias("docs_within"),
        docs.alias("docs_beyond"),
        (F.col("all_tokens") - tokens).alias("tokens_within"),
        tokens.alias("tokens_beyond"),
        (F.col("all_tokens") - tokens + docs * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("all_docs") - docs) / F.col("all_docs")).alias("share_within"),
    )


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, n_tokens: of limits(), the smallest length within which that share of the documents lies; nothing for an empty table."""
    found = table.agg(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_within") >= s, F.col("n_tokens"))).alias("n_tokens")) for s in shares]).alias("rows"))
    return found.select(F.inline("rows")).where("n_tokens IS NOT NULL")


def truncated_totals(lengths: DataFrame, at: Sequence[int]) -> DataFrame:
    """context_limit, total: all tokens when documents are cut at each limit, whether or not a document has that length.

    What is within the largest length up to the limit, and the limit for every
    document beyond it.  Nothing for an empty histogram.
    """

    def total(limit: int) -> Column:
        below = F.max_by(F.struct("tokens_within", "docs_beyond"), F.when(F.col("n_tokens") <= limit, F.col("n_tokens")))
        return F.coalesce(below["tokens_within"] + below["docs_beyond"] * limit, F.max("docs_within") * limit)

    found = limits(lengths).agg(F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"), total(int(x)).alias("total")) for x in at]).alias("rows"))
    return found.select(F.inline("rows")).where("total IS NOT NULL")

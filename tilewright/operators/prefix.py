"""Running values over groups of any size, and the first rows of an order of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def ranged(df: DataFrame, order: list[Column], name: str = "_part") -> DataFrame:
    """df, written in partitions of ranges of the order, with the partition's number, which rises with the order."""
    return written(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), "ranged")


def running(df: DataFrame, group: list[str], bucket: Column, order: list, value: str, name: str, how=F.sum) -> DataFrame:
    """df with the sum (or with F.max the greatest) of value up to and with each row, in the order of bucket, then order, within group.

    The bucket has to rise with the order. Values are taken within buckets and
    over what the buckets have as a whole, so no task holds a whole group.
    """
    df = df.withColumn("_bucket", bucket)
    totals = df.groupBy(*group, "_bucket").agg(how(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", how("_total").over(before)).drop("_total")
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("_inside", how(value).over(inside))
    both = F.greatest("_offset", "_inside") if how is F.max else F.coalesce("_offset", F.lit(0)) + F.col("_inside")
    return summed.join(offsets, [*group, "_bucket"]).withColumn(name, both).drop("_bucket", "_offset", "_inside")


def running_sum(df: DataFrame, group: list[str], bucket: Column, order: list[str], value: str, name: str) -> DataFrame:
    """running() with sums."""
    return running(df, group, bucket, order, value, name)


def first_rows(df: DataFrame, order: list[Column], limits: dict[object, int], group: Column | None = None) -> DataFrame:
    """The first rows of each group in limits, as many as it says; without a group, limits has one entry, for all rows.

    Rows are dealt to partitions by ranges of group and order and counted there;
    only the partition that a limit falls into is ranked.  The driver gets a
    count for each partition and group in it.
    """
    group = F.lit(0) if group is None else group
    rows = df.withColumn("_group", group).where(F.col("_group").isin(*limits))
    rows = ranged(rows, [F.col("_group"), *order])
    cuts = []  # (group, partition, rows to take of it)
    left = dict(limits)
    for r in rows.groupBy("_group", "_part").count().orderBy("_group", "_part").collect():
        if left[r["_group"]] > 0 and r["count"] > left[r["_group"]]:
            cuts.append((r["_group"], r["_part"], left[r["_group"]]))
        elif left[r["_group"]] <= 0 and not any(c[0] == r["_group"] for c in cuts):
            cuts.append((r["_group"], r["_part"], 0))
        left[r["_group"]] -= r["count"]
    last = lambda g, p: (F.col("_group") == g) & (F.col("_part") == p)
    beyond, in_cut = F.lit(False), F.lit(False)
    for g, p, n in cuts:
        beyond |= (F.col("_group") == g) & (F.col("_part") >= p)
        in_cut |= last(g, p) if n else F.lit(False)
    whole = rows.where(~beyond).drop("_group", "_part")
    if not any(n for *_, n in cuts):
        return whole
    take = F.coalesce(*[F.when(F.col("_group") == g, n) for g, _, n in cuts if n])
    place = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    ranked = rows.where(in_cut).withColumn("_place", place).where(F.col("_place") <= take)
    return whole.unionByName(ranked.drop("_group", "_part", "_place"))

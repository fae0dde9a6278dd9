"""Reading the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows of a partition that dealt() makes, about.
DEALT_ROWS = 1 << 16


def read_table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """The Parquet table `name` of a folder.

    With spread, a table that Spark would read in fewer tasks than there are
    cores (a small one in a single file) is dealt out to as many as there are.
    A table of many files is read as it is, without a shuffle.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def dealt(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table's keys, dealt by their hash to as many tasks as their number needs, for rows that are made from them.

    A file with little in each row is read in few tasks, which would hold all
    that is made of its keys. What has a key lies together after that, so that
    grouping by the key and more moves no rows. The count is in the file's footer.
    """
    keys = read_table(spark, folder, name).select(key)
    return keys.repartition(max(spark.sparkContext.defaultParallelism, -(-keys.count() // DEALT_ROWS)), key)

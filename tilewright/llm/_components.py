"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written

ROUNDS = 60
HOT = 1000  # rows beyond which a key is dealt out to several tasks
SALTS = 32


def joined(rows: DataFrame, of_key: DataFrame, key: list[str], hot: bool) -> DataFrame:
    """rows with the columns of of_key, which has one row for each key and, as n, how many of rows have it.

    hot: whether some n is above HOT.  Rows of such keys are dealt to SALTS
    tasks, and what belongs to the key goes to each; rows of other keys are
    joined as usual.  That is a choice of plan, and the rows are the same.
    """
    if not hot:
        return rows.join(of_key.drop("n"), key)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    heavy = of_key.where(F.col("n") > HOT).drop("n").withColumn("_heavy", F.lit(True)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = rows.withColumn("_salt", salt).join(heavy, [*key, "_salt"], "left")
    rest = both.where("_heavy IS NULL").select(*rows.columns).join(of_key.where(F.col("n") <= HOT).drop("n"), key)
    return both.where("_heavy").drop("_heavy", "_salt").unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """node, component for the nodes of edges (a, b) that are not their component's smallest node themselves.

    Small-star and large-star steps in turn: each node hands its smaller
    neighbours, then its larger ones, to the smallest node it knows of.  The
    edges become no more than they were, each round is a written table, and the
    edges of one node need not be in one task.  It is over when every node has
    one edge, to a node that has none of its own.
    """
    edges = written(_small(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"), False), "stars")
    for _ in range(ROUNDS):
        # counted at each end apart: rows of edges are never doubled
        up = edges.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("up")).withColumn("down", F.lit(0))
        down = edges.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("down")).withColumn("up", F.lit(0))
        nodes = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        open_, most = nodes.agg(F.count_if((F.col("up") > 1) | (F.col("up") == 1) & (F.col("down") > 0)), F.max(F.col("up") + F.col("down"))).first()
        if open_ == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        hot = most > HOT
        edges = written(_small(_large(edges, hot), hot), "stars")
    raise RuntimeError(f"no components after {ROUNDS} rounds")


def _large(edges: DataFrame, hot: bool) -> DataFrame:
    """Each edge's larger end with the smallest node that its smaller end knows of, itself included: larger neighbours can't be that."""
    least = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    least = edges.groupBy("b").agg(F.count("*").alias("n")).join(least, "b", "left").withColumn("m", F.coalesce("m", "b"))
    return joined(edges, least, ["b"], hot).select("a", F.col("m").alias("b"))


def _small(edges: DataFrame, hot: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    # each smaller neighbour goes to m, and so does the node itself, which its row with m itself stands for
    handed = joined(down, least, ["a"], hot).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return handed.distinct()

"""A Merkle manifest of a dataset, by Pregel-style supersteps on RDDs.

Each row is a leaf.  The leaves of a language, in the order of their ids, make a
tree whose inner nodes hash their two children, and the languages' roots make a
tree of the same kind.

A vertex is a subtree of LEVELS levels; vertices are keyed by tree and number.
In a superstep, children message their vertex's digests; a vertex that has all
of them hashes them and forwards its root, which is a child's message of the
next superstep.  Trees that are down to one node halt.  The reverse supersteps
start at the roots: a vertex gets the siblings on the way from it to the root,
puts those within it before them, and messages the whole path to each child,
down to the leaves, where the path is folded again.

So a tree of n leaves takes log2(n) / LEVELS supersteps each way.  A vertex has
2**LEVELS children, however large its language is; only digests and paths are
shuffled, and each superstep's digests are a written table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scope
from ..shipping import ship
from ._common import written

LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Iterable[str | Column]) -> Column:
    """SHA-256 of the fields: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with idx, their place in their tree from 0, and n, the rows of the tree. Rows are sorted by tree (null first) and order, in ranges."""
    keys = [tree, *order]
    # equal rows may fall into several partitions
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie").withColumn("row", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.shiftright("row", 33)), "placed")
    # one for each partition and tree, and the partitions are sorted by tree
    runs = placed.groupBy(F.col("part").alias("of_part"), F.col(tree).alias("of_tree")).agg(F.min("row").alias("first"), F.count("*").alias("size"))
    of_tree = Window.partitionBy("of_tree")
    runs = runs.withColumn("before", F.coalesce(F.sum("size").over(of_tree.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("n", F.sum("size").over(of_tree))
    found = placed.join(runs, (F.col("part") == F.col("of_part")) & F.col(tree).eqNullSafe(F.col("of_tree")))
    return found.select(*rows.columns, (F.col("row") - F.col("first") + F.col("before")).alias("idx"), "n")


def _place(key: tuple[str | None, int]) -> int:
    return zlib.crc32(repr(key).encode())


def _grown(children: list[str], n: int, levels: int) -> list[list[str]]:
    """The levels of a vertex, from its children up; n is how many nodes the whole tree has at the children's level."""
    grown = [children]
    for _ in range(levels):
        if n == 1:
            break
        below = grown[-1]
        grown.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
        n = (n + 1) // 2
    return grown


def _siblings(grown: list[list[str]], at: int) -> list[str]:
    """What a child has beside it on its way up the vertex: `<` or `>` for the side and the digest, or nothing for a node that is alone."""
    path = []
    for level in grown[:-1]:
        other = at ^ 1
        path.append(("<" if other < at else ">") + level[other] if other < len(level) else "")
        at >>= 1
    return path


def fold(leaf: str, path: Iterable[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = digest(step[1:], leaf) if step[:1] == "<" else digest(leaf, step[1:])
    return leaf


def _nodes(nodes: DataFrame, levels: int) -> RDD:
    """((tree, vertex), (place, n, digest, payload)) of nodes tree, idx, n, digest, payload."""
    return nodes.select("tree", "idx", "n", "digest", "payload").rdd.map(lambda r: ((r[0], r[1] >> levels), (r[1] & ((1 << levels) - 1), r[2], r[3], r[4])))


def climb(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """(the nodes at each superstep, the roots: tree, step, root) of nodes tree, idx, n, digest, payload.

    step is the superstep before which the tree was down to one node.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def forward(vertex: tuple) -> tuple:
        (tree, at), messages = vertex
        messages = sorted(messages)
        n = messages[0][1]
        return tree, at, -(-n >> levels), _grown([m[2] for m in messages], n, levels)[-1][0]

    steps, roots = [nodes], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(steps[-1].where("n = 1").select("tree", F.lit(len(steps) - 1).alias("step"), F.col("digest").alias("root")))
        if most <= 1:
            break
        # the payload stays with the leaves
        messages = _nodes(steps[-1].where("n > 1").withColumn("payload", F.lit(None).cast("int")), levels).mapValues(lambda m: m[:3])
        vertices = messages.groupByKey(parts, _place).map(forward)
        steps.append(written(spark.createDataFrame(vertices, "tree string, idx long, n long, digest string").withColumn("payload", F.lit(None).cast("int")), "superstep"))
        most = -(-most >> levels)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return steps, found


def descend(steps: list[DataFrame], above: RDD, levels: int = LEVELS) -> RDD:
    """(payload, digest, path, further) of each leaf.

    above has (tree, step, path from the tree's root on, further) for each tree;
    further is handed down to the leaves.
    """
    parts = int(steps[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def down(vertex: tuple) -> Iterator[tuple]:
        (tree, at), messages = vertex
        from_above, children = None, []
        for message in messages:
            if len(message) == 2:
                from_above = message
            else:
                children.append(message)
        children.sort(key=lambda c: c[0])
        path, further = from_above
        grown = _grown([c[2] for c in children], children[0][1], levels)
        for place, _, own, payload in children:
            yield (tree, (at << levels) + place), (_siblings(grown, place) + path, further), own, payload

    found = None
    for step in range(len(steps) - 1, -1, -1):
        messages = above.filter(lambda a, step=step: a[1] == step).map(lambda a: ((a[0], 0), (a[2], a[3])))
        if found is not None:
            messages = messages.union(found.map(lambda f: (f[0], f[1])))
        found = _nodes(steps[step], levels).union(messages).groupByKey(parts, _place).flatMap(down)
    return found.map(lambda f: (f[3], f[2], *f[1]))


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row for each row of leaves (id, tree, leaf, offered): id, leaf, subroot, root, path, folded_root, verified.

    The leaves of a tree are taken by id, null first, and then by digest; trees
    by name, null first, bytewise.  Of two nodes that follow each other, or the
    last that is alone, the hash of their digests is one node of the next level.
    path has the siblings from the leaf to the root: `<` or `>` for the side and
    the digest, or an empty text where a node is alone.  folded_root is what
    offered, or if that is null the leaf, gives with the path.  Repeated rows
    are leaves of their own.  An empty table gives an empty result.
    """
    spark = leaves.sparkSession
    ship(spark)
    schema = "id long, leaf string, subroot string, root string, path array<string>, folded_root string, verified boolean"
    with scope(spark) as tables:
        rows = numbered(written(leaves.select("id", "tree", "leaf", "offered"), "leaves"), "tree", ["id", "leaf"])
        nodes = tables.keep(written(rows.select("tree", "idx", "n", F.col("leaf").alias("digest"), F.struct("id", "offered").alias("payload")), "nodes"))
        steps, roots = climb(nodes, levels)
        roots = written(roots, "subroots")
        trees = numbered(roots.select(F.lit("").alias("of"), F.col("tree").alias("name"), "step", "root"), "of", ["name"])
        trees = tables.keep(written(trees.select(F.col("of").alias("tree"), "idx", "n", F.col("root").alias("digest"), F.struct("name", "step").alias("payload")), "trees"))
        upper, top = climb(trees, levels)
        found = top.first()  # one root for the whole table
        for table in (*steps, *upper):
            tables.keep(table)
    if found is None:
        return spark.createDataFrame([], schema)
    root = found["root"]
    above = spark.sparkContext.parallelize([("", found["step"], [], None)], 1)
    paths = descend(upper, above, levels).map(lambda t: (t[0][0], t[0][1], t[2], t[1]))

    def verified(leaf: tuple) -> tuple:
        payload, own, path, subroot = leaf
        folded = fold(payload[1] or own, path)
        return payload[0], own, subroot, root, path, folded, folded == root

    return spark.createDataFrame(descend(steps, paths, levels).map(verified), schema)


def tampered_manifest(docs: DataFrame, levels: int = LEVELS, id_col: str = "doc_id", tree_col: str = "lang", count_col: str = "n_chars", fields: Iterable[str] = FIELDS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row of docs, see manifest().

    Where 7 divides the CRC-32 of the id, count_col is one more in what is
    offered for verification (a null stays); rows without an id are offered as
    they are.  proof_sha256 is the hash of the path's digests.  Nulls in any
    column are hashed as `-`.  Other columns are not looked at.
    """
    one_more = leaf_digest([F.col(f) + 1 if f == count_col else F.col(f) for f in fields])
    offered = F.when(F.crc32(F.col(id_col).cast("string")) % 7 == 0, one_more)
    found = manifest(docs.select(F.col(id_col).cast("long").alias("id"), F.col(tree_col).cast("string").alias("tree"), leaf_digest(fields).alias("leaf"), offered.alias("offered")), levels)
    siblings = F.concat_ws("", F.transform("path", lambda p: F.substr(p, F.lit(2))))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified")

"""Nearest neighbours by inner product with one vantage-point tree for each shard.

Every vector gets one more coordinate that brings it to the length of the
shard's longest one; a query gets zero.  Euclidean distance in that space falls
as the inner product rises, so a metric tree can search for large products.  A
subtree is passed over when the triangle inequality shows that all it holds is
farther than the k-th candidate found so far; `factor` multiplies that lower
bound.  Factor one is exact, larger factors prune more and may miss some.

Vectors are spread over shards of bounded size by a hash of their id, and equal
vectors of a shard are one entry of its tree, however many they are.  A query
is first searched for in one shard, and then, with the k-th candidate's product
as its bound, in all others.  Each of the two steps is one job, whose tasks
hold one shard and one block of queries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import written

SHARD_BYTES = 32 << 20  # of a shard's vectors, in doubles
BLOCK_BYTES = 16 << 20  # of a block of queries
LEAF_ROWS = 64
CHUNK = 512  # queries that go through a tree together
_TRIED = 8  # rows of a node that are tried as its vantage point
_SPREAD = 256  # rows that their distances are compared on

_HITS = "query long, query_id long, vec_id long, score double"
_NO_ID = np.iinfo(np.int64).max


class Tree:
    """A vantage-point tree over the different rows of a matrix, kept in leaf order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        vectors, of = np.unique(vectors, axis=0, return_inverse=True)
        lengths = np.einsum("ij,ij->i", vectors, vectors)
        self.longest2 = float(lengths.max())
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(self.longest2 - lengths, 0))])
        self.nodes: list[tuple] = []  # (start, end, vantage, (lo, hi, child) of the near and far half) or (start, end)
        rows = np.arange(len(vectors))
        self._grow(lifted, rows, 0, leaf_rows)
        self.vectors = vectors[rows]
        place = np.empty_like(rows)
        place[rows] = np.arange(len(rows))
        of = place[of.reshape(-1)]
        order = np.lexsort((ids, of))
        # ids of entry x, rising: members[starts[x] : starts[x + 1]]
        self.members, self.starts = ids[order], np.searchsorted(of[order], np.arange(len(rows) + 1))
        self.first = self.members[self.starts[:-1]]
        # the smallest id that is not the first one
        other = np.where(self.members == np.repeat(self.first, np.diff(self.starts)), _NO_ID, self.members)
        self.second = np.minimum.reduceat(other, self.starts[:-1])
        self.scored = 0  # products that searches have computed

    def _grow(self, lifted: np.ndarray, rows: np.ndarray, start: int, leaf_rows: int) -> int:
        """Put the rows (a view, reordered here) under a new node; its number."""
        number = len(self.nodes)
        self.nodes.append((start, start + len(rows)))
        if len(rows) <= leaf_rows:
            return number
        vantage = self._vantage(lifted, rows)
        distance = np.sqrt(((lifted[rows] - vantage) ** 2).sum(1))
        order = np.argsort(distance, kind="stable")
        rows[:], distance = rows[order], distance[order]
        half = len(rows) // 2
        near = (distance[0], distance[half - 1], self._grow(lifted, rows[:half], start, leaf_rows))
        far = (distance[half], distance[-1], self._grow(lifted, rows[half:], start + half, leaf_rows))
        self.nodes[number] = (start, start + len(rows), vantage, near, far)
        return number

    @staticmethod
    def _vantage(lifted: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """That of a few rows whose distances to others differ most."""
        tried = lifted[rows[np.linspace(0, len(rows) - 1, _TRIED).astype(int)]]
        others = lifted[rows[np.linspace(0, len(rows) - 1, min(_SPREAD, len(rows))).astype(int)]]
        distances = np.sqrt(((tried[:, None] - others[None]) ** 2).sum(2))
        return tried[distances.std(1).argmax()]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, vec_id, score) of each query's k nearest, rows of the query's own id left out.

        least: for each query, a product below which nothing is wanted.
        """
        least = np.full(len(queries), -np.inf) if least is None else least
        found = [self._search(query_ids[a : a + CHUNK], queries[a : a + CHUNK], k, factor, least[a : a + CHUNK], a) for a in range(0, len(queries), CHUNK)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _search(self, query_ids, queries, k, factor, least, first):
        n = len(queries)
        length2 = np.einsum("ij,ij->i", queries, queries)
        slack = 1e-10 * np.sqrt(length2 * self.longest2)  # above what rounding can do
        lifted = np.column_stack([queries, np.zeros(n)])
        # the best entries so far: product, smallest id that counts, place
        best, best_id, best_at = np.full((n, k), -np.inf), np.full((n, k), _NO_ID), np.full((n, k), -1)
        seen = np.full(n, -1)  # the leaf that a query has seen already

        def bound(some: np.ndarray) -> np.ndarray:
            return np.maximum(best[some, -1], least[some]) - slack[some]

        def leaf(number: int, some: np.ndarray) -> None:
            start, end = self.nodes[number][:2]
            score = queries[some] @ self.vectors[start:end].T
            self.scored += score.size
            own = query_ids[some]
            id_ = np.where(self.first[None, start:end] == own[:, None], self.second[None, start:end], self.first[None, start:end])
            score[id_ == _NO_ID] = -np.inf
            enough = bound(some)
            if end - start > k:
                enough = np.maximum(enough, -np.partition(-score, k - 1, axis=1)[:, k - 1] - 2 * slack[some])
            q, x = np.nonzero((score >= enough[:, None]) & (score > -np.inf))
            if not len(q):
                return
            exact = inner(queries, self.vectors, some[q], x + start)
            ids = id_[q, x]
            gains, q = np.unique(q, return_inverse=True)
            some = some[gains]
            owner = np.concatenate([np.repeat(np.arange(len(some)), k), q])
            value = np.concatenate([best[some].reshape(-1), exact])
            ids = np.concatenate([best_id[some].reshape(-1), ids])
            at = np.concatenate([best_at[some].reshape(-1), x + start])
            order = np.lexsort((ids, -value, owner))
            keep = order[np.arange(len(order)) - np.searchsorted(owner[order], owner[order]) < k]
            best[some], best_id[some], best_at[some] = (a[keep].reshape(-1, k) for a in (value, ids, at))

        def home(number: int, some: np.ndarray) -> None:
            """The leaf on whose side each query lies."""
            node = self.nodes[number]
            if len(node) == 2:
                leaf(number, some)
                seen[some] = number
                return
            _, _, vantage, near, far = node
            left = np.sqrt(((lifted[some] - vantage) ** 2).sum(1)) < (near[1] + far[0]) / 2
            for side, child in ((left, near), (~left, far)):
                if side.any():
                    home(child[2], some[side])

        def rest(number: int, some: np.ndarray) -> None:
            node = self.nodes[number]
            if len(node) == 2:
                some = some[seen[some] != number]
                if len(some):
                    leaf(number, some)
                return
            distance = np.sqrt(((lifted[some] - node[2]) ** 2).sum(1))
            gaps = [np.maximum(np.maximum(low - distance, distance - high), 0) for low, high, _ in node[3:]]
            # the half that is nearer to most comes first
            for which in (0, 1) if (gaps[0] <= gaps[1]).mean() >= 0.5 else (1, 0):
                reach = np.sqrt(np.maximum(length2[some] + self.longest2 - 2 * bound(some), 0))
                go = ~(factor * gaps[which] > reach * (1 + 1e-9) + 1e-9 * np.sqrt(self.longest2))
                if go.any():
                    rest(node[3 + which][2], some[go])

        home(0, np.arange(n))
        rest(0, np.arange(n))
        return self._members_of(query_ids, best, best_id, best_at, k, least - slack, first)

    def _members_of(self, query_ids, best, best_id, best_at, k, least, first):
        """The k best ids of each query, from its best entries."""
        q, place = np.nonzero((best_at >= 0) & (best >= least[:, None]))
        score, ids, at = best[q, place], best_id[q, place], best_at[q, place]
        more: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(q, ids, score)]
        for i in np.flatnonzero(np.diff(self.starts)[at] > 1):
            some = self.members[self.starts[at[i]] : self.starts[at[i] + 1]]
            # the smallest one is there already; equal ids stand together
            own = query_ids[q[i]]
            some = np.concatenate([some[: np.searchsorted(some, own)][: k + 1], some[np.searchsorted(some, own, "right") :][: k + 1]])[1 : k + 1]
            more.append((np.full(len(some), q[i]), some, np.full(len(some), score[i])))
        q, ids, score = (np.concatenate(x) for x in zip(*more, strict=True))
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[keep] + first, ids[keep], score[keep]


def inner(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of a with rows j of b, added up from the first component to the last."""
    out = np.empty(len(i))
    for s in range(0, len(i), 1 << 16):
        x, y = a[i[s : s + (1 << 16)]].T.copy(), b[j[s : s + (1 << 16)]].T.copy()
        total = np.zeros(x.shape[1])
        for p, q in zip(x, y, strict=True):
            total += p * q
        out[s : s + (1 << 16)] = total
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array of double): the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0.0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_bytes: int = SHARD_BYTES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row for each shard and dimension: dim, shard, shards (their number), tree. Every usable vector is in one."""
    rows = usable(vectors, id_col, vector_col).withColumn("dim", F.size("v"))
    shards = max(1, -(-(rows.agg(F.sum("dim")).first()[0] or 0) * 8 // shard_bytes))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def grow(group: pa.Table) -> pa.Table:
        tree = Tree(group["vec_id"].to_numpy(), _matrix(group["v"]), leaf_rows)
        return pa.table({"dim": group["dim"][:1], "shard": group["shard"][:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    return rows.groupBy("dim", "shard").applyInArrow(grow, "dim int, shard int, tree binary").withColumn("shards", F.lit(shards))


def _searched(index: DataFrame, asked: DataFrame, blocks: int, k: int, factor: float) -> DataFrame:
    """Hits of rows query, vec_id, v, dim, least, shard in their shards."""

    def search(asked: pa.Table, tree: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not asked.num_rows or not tree.num_rows:
            return schema.empty_table()
        numbers, ids = asked["query"].to_numpy(), asked["vec_id"].to_numpy()
        q, x, score = pickle.loads(tree["tree"][0].as_py()).search(ids, _matrix(asked["v"]), k, factor, asked["least"].to_numpy())
        return pa.table([numbers[q], ids[q], x, score], schema=schema)

    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return asked.groupBy("dim", "shard", "block").cogroup(spread.groupBy("dim", "shard", "block")).applyInArrow(search, _HITS)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_bytes: int = SHARD_BYTES, leaf_rows: int = LEAF_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of vectors with the largest inner product with each row of queries.

    Nearest first, ties to the smaller vec_id; fewer than k where there are not
    enough.  Rows whose id is the query's own are left out.  Rows with a null
    id, and vectors that are null, zero or hold null, NaN or infinite
    components take no part, neither as query nor as candidate; nor do vectors
    of another dimension than the query's.  Repeated rows all take part.
    Without a query or without a vector the result is empty.
    """
    spark = vectors.sparkSession
    index = written(build_index(vectors, id_col, vector_col, shard_bytes, leaf_rows), "vp-index")
    asked = usable(queries, id_col, vector_col).withColumn("query", F.monotonically_increasing_id()).withColumn("dim", F.size("v"))
    asked = written(asked, "queries")
    size = (asked.agg(F.sum("dim")).first()[0] or 0) * 8
    shards = index.agg(F.max("shards")).first()[0]
    if not size or not shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    home = asked.withColumn("least", F.lit(float("-inf"))).withColumn("shard", F.pmod(F.xxhash64("query"), F.lit(shards)).cast("int"))
    hits = written(_searched(index, home, -(-size // (block_bytes * shards)), k, factor), "hits")
    if shards > 1:
        known = hits.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k).select("query", "least")
        rest = home.drop("least").withColumnRenamed("shard", "home").join(known, "query", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home").drop("home")
        hits = hits.unionByName(written(_searched(index, rest, -(-size // block_bytes), k, factor), "more-hits"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

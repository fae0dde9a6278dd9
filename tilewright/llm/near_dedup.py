"""Near-duplicate detection with circulant MinHash and exact verification.

Every shingle is placed in a universe of 2**PLACES by one permutation; a second
permutation, shifted circularly by 0, 1, 2 and so on, gives the values whose
minima over a text's shingles are the coordinates of its signature.  Bands of
coordinates are hashed, and texts that share a band belong to one candidate
group.  Within a group every link that can exist is decided on the texts' full
shingle sets, so groups only have to be large enough, never exact.

Texts with equal shingle sets are one class, and only one of a class is
compared.  A group with many classes is cut into blocks of bounded size, and
each block is linked within itself and with a few hubs of its group, by at most
one link for each class, not pairs.  What links are left lead from classes that
are not in their group's largest component.  These are compared with the
classes of other components that share a band with them, or with all of the
group where that is less work, again in blocks.  Tasks hold one or two blocks
and give links that join two components, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written
from ._components import HOT, components, joined
from ._shingles import mix, shingle_sets

SHINGLE_WORDS = 5
THRESHOLD = (85, 100)  # link if 100 * intersection >= 85 * union
BANDS, ROWS = 48, 6  # at 0.85 a pair shares no band with probability 1.3e-10
PLACES = 21
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1 << 20
HUBS = 16
SLACK = 7.0  # standard deviations by which the estimate may be below the threshold
_SEED = 0xC1AC
_U = np.uint64


class Circulant:
    """Signatures from two permutations."""

    def __init__(self, size: int, places: int = PLACES):
        values = np.random.default_rng(_SEED).permutation(1 << places).astype(np.uint32)
        self.size = size
        self.shift = _U(64 - places)
        # row i holds the second permutation at i under the shifts 0 to size - 1
        self.rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:size]]), size)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        place = (mix(shingles ^ _U(_SEED)) >> self.shift).astype(np.int64)
        out = np.full(self.size, np.iinfo(np.uint32).max, np.uint32)
        for a in range(0, len(place), 2048):
            np.minimum(out, self.rows[place[a : a + 2048]].min(0), out=out)
        return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of every band of every signature; the band's number is part of it."""
    out = mix(np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1)))
    parts = signatures[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    for r in range(rows):
        out = mix(out + parts[:, :, r])
    return out


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell shingle sets apart, as two signed integers."""
    a = mix(shingles + _U(0x51ED)).sum(dtype=np.uint64)
    b = mix(shingles * _U(0x9E3779B97F4A7C15) ^ _U(0xABCD)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


_circulants: dict[int, Circulant] = {}


def _circulant(size: int) -> Circulant:
    if size not in _circulants:
        _circulants[size] = Circulant(size)
    return _circulants[size]


def _signed(rows: DataFrame, bands: int, per_band: int, width: int) -> DataFrame:
    """doc_id, t, n_shingles, h1, h2 and the band hashes (null for texts without words) of rows doc_id, text, t."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = _circulant(bands * per_band)
        for batch in batches:
            sizes, h1, h2, signatures = [], [], [], []
            for s in shingle_sets(batch["text"], width):
                sizes.append(len(s))
                a, b = set_hash(s) if len(s) else (None, None)
                h1.append(a)
                h2.append(b)
                signatures.append(minhash.signature(s))
            hashes = band_hashes(np.array(signatures, np.uint32).reshape(len(sizes), -1), bands, per_band).astype(np.int64)
            some = np.array(sizes, np.int64) > 0
            offsets = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["t"], pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), lists], names=["doc_id", "t", "n_shingles", "h1", "h2", "bands"])

    return rows.mapInArrow(sign, "doc_id long, t long, n_shingles long, h1 long, h2 long, bands array<long>")


class _Forest:
    def __init__(self, labels: np.ndarray):
        """Things with equal labels are in one tree."""
        _, self.up = np.unique(labels, return_inverse=True)
        self.tree = list(range(len(self.up)))

    def root(self, i: int) -> int:
        i, tree = self.up[i], self.tree
        while tree[i] != i:
            tree[i] = tree[tree[i]]
            i = tree[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.tree[self.root(i)] = self.root(j)


def _short_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit coordinates for each set."""
    minhash = _circulant(BANDS * ROWS)
    return np.array([minhash.signature(s) & 0xFFFF for s in sets], np.uint16).reshape(len(sets), minhash.size)


def _least_agreeing(threshold: tuple[int, int]) -> float:
    """How many coordinates agree, at least, if two sets are as similar as the threshold, but for SLACK."""
    share, size = threshold[0] / threshold[1], BANDS * ROWS
    return (share - SLACK * (share * (1 - share) / size) ** 0.5) * size


def _similar(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return threshold[1] * both >= threshold[0] * (len(a) + len(b) - both)


class _Texts:
    """Shingle sets and signatures of the rows of a table (doc_id, text, h1, h2), by size; each class once."""

    def __init__(self, table: pa.Table, width: int, threshold: tuple[int, int]):
        sets, rows, seen = [], [], set()
        ids, h1, h2 = (table[c].to_pylist() for c in ("doc_id", "h1", "h2"))
        k = 0
        for chunk in table["text"].chunks:
            for s in shingle_sets(chunk, width):
                # rows may share an id with the class's own; repeated rows come again
                if len(s) and ids[k] not in seen and set_hash(s) == (h1[k], h2[k]):
                    seen.add(ids[k])
                    sets.append(s)
                    rows.append(k)
                k += 1
        self.order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        self.sets = [sets[i] for i in self.order]
        self.rows = np.array([rows[i] for i in self.order], np.int64)
        self.ids = np.array(ids, np.int64)[self.rows] if len(self.rows) else np.zeros(0, np.int64)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.threshold = threshold
        self.signatures = _short_signatures(self.sets)
        self.least = _least_agreeing(threshold)

    def reach(self, i: int) -> int:
        """End of the texts that are not too large for text i to link with, from i on."""
        low, whole = self.threshold
        return int(np.searchsorted(self.sizes, self.sizes[i] * whole // low, "right"))

    def likely(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of others whose signature agrees enough, likeliest first."""
        agree = (self.signatures[others] == self.signatures[i]).sum(1)
        near = agree >= self.least
        return others[near][np.argsort(-agree[near], kind="stable")]

    def linked(self, i: int, j: int) -> bool:
        return _similar(self.sets[i], self.sets[j], self.threshold)


def _link_block(texts: _Texts) -> list[tuple[int, int]]:
    """For each text that links lead from to a smaller id: it, and the smallest such."""
    forest = _Forest(np.arange(len(texts.sets)))
    for i in range(len(texts.sets)):
        for j in texts.likely(i, np.arange(i + 1, texts.reach(i))):
            if forest.root(i) != forest.root(j) and texts.linked(i, j):
                forest.join(i, int(j))
    least: dict[int, int] = {}
    for i in np.argsort(texts.ids, kind="stable").tolist():
        least.setdefault(forest.root(i), i)
    return [(i, least[forest.root(i)]) for i in range(len(texts.sets)) if least[forest.root(i)] != i]


def _link_across(texts: _Texts, labels: np.ndarray, home: np.ndarray, rest: np.ndarray, asking: np.ndarray) -> list[tuple[int, int]]:
    """Links between different labels: of asking texts (which are all in rest) with all texts of other home blocks."""
    forest, out = _Forest(labels), []
    for i in np.flatnonzero(asking):
        low = int(np.searchsorted(texts.sizes, -(-texts.sizes[i] * texts.threshold[0] // texts.threshold[1])))
        others = np.arange(low, texts.reach(i))
        # two of the rest meet twice, once from each side
        others = others[(home[others] != home[i]) & (labels[others] != labels[i]) & (~rest[others] | (texts.ids[others] > texts.ids[i]))]
        for j in texts.likely(i, others):
            if forest.root(i) != forest.root(j) and texts.linked(i, j):
                forest.join(i, j)
                out.append((int(i), int(j)))
    return out


def _links(texts: _Texts, found: list[tuple[int, int]]) -> pa.Table:
    i, j = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"a": texts.ids[i], "b": texts.ids[j]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, width: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text", block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    A text's set is its distinct shingles of `width` words; a text with fewer
    words has its whole sequence as one shingle; null, empty and blank texts
    have none and are linked with nothing.  Two texts are linked if
    threshold[1] * |intersection| >= threshold[0] * |union|.  component_id is
    the smallest id that links lead to, and kept marks the rows that have it
    for their own.  Links are between rows: rows that share an id are each taken
    for their own text, and may belong to different components.
    A row with a null id takes no part: its component_id is null and kept is
    true.  The threshold may not be below 0.8, for which the bands are made.
    An empty table gives an empty result.  Other columns are not looked at.
    """
    if threshold[0] * 10 < threshold[1] * 8:
        raise ValueError("the bands are made for thresholds of 0.8 and more")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    signed = written(_signed(rows, BANDS, ROWS, width), "signatures")
    takes_part = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = signed.where(takes_part).groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "t")).alias("first"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = classes.select(F.monotonically_increasing_id().alias("rep"), "h1", "h2", F.col("first.doc_id").alias("least"), F.col("first.t").alias("t"), "n", "n_shingles", "bands")
    classes = written(classes, "classes")
    # rows may share an id without being of one class; where classes share their least id, they go by numbers, else by it
    shared = not _empty(classes.groupBy("least").agg(F.count("*").alias("n")).where("n > 1"))
    if not shared:
        classes = classes.withColumn("rep", F.col("least"))
    banded = classes.select("rep", F.explode("bands").alias("band"))
    centres = written(banded.groupBy("band").agg(F.min("rep").alias("b"), F.count("*").alias("n")).where("n > 1"), "centres")
    candidates = joined(banded, centres, ["band"], _hot(centres)).select(F.col("rep").alias("a"), "b")
    groups = components(candidates)
    roots = groups.select(F.col("component").alias("rep"), F.col("component").alias("cluster")).distinct()
    groups = groups.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).unionByName(roots)

    row = ["least", "t"] if shared else []  # of the row whose text is the class's
    members = written(groups.join(classes.select("rep", "n_shingles", "h1", "h2", *row), "rep"), "members")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    sizes = written(sizes.select("cluster", "n", F.col("n").alias("texts"), F.greatest(F.ceil(F.col("n") / block_texts), F.ceil(F.col("shingles") / block_shingles)).cast("int").alias("blocks")), "sizes")
    many = not _empty(sizes.where("blocks > 1"))
    placed = joined(members, sizes, ["cluster"], _hot(sizes)).select(
        "rep", "cluster", "h1", "h2", *row, "n_shingles", "blocks",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"),
        ((F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit("hub"), "rep"), F.greatest(F.lit(1), F.floor(F.col("texts") / HUBS))) == 0)).alias("hub"),
    )
    placed = written(placed, "placed")
    # the texts of the groups alone, since all that follows needs no others
    if shared:
        texts = placed.select("rep", F.col("least").alias("doc_id"), "t").join(rows.where("doc_id IS NOT NULL"), ["doc_id", "t"]).select("rep", "text")
    else:
        texts = placed.select("rep").join(rows.select(F.col("doc_id").alias("rep"), "text").where("rep IS NOT NULL"), "rep")
    if many:
        texts = written(texts, "texts")

    dealt = placed.withColumn("block", F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))

    def within(table: pa.Table) -> pa.Table:
        some = _Texts(table, width, threshold)
        found = _links(some, _link_block(some))
        return found.append_column("whole", pa.array([table["blocks"][0].as_py() == 1] * len(found), pa.bool_()))

    with_text = dealt.select(F.col("rep"), "cluster", "block", "blocks", "h1", "h2").join(texts, "rep").withColumnRenamed("rep", "doc_id")
    links = written(with_text.groupBy("cluster", "block").applyInArrow(within, "a long, b long, whole boolean"), "links")
    # in a group of one block every link leads to the component already
    found = links.where("whole").select(F.col("a").alias("node"), F.col("b").alias("component"))
    if many:
        known = components(links.where("NOT whole"))
        more = _across(placed.where("blocks > 1"), texts, classes, known, width, threshold, block_texts, block_shingles)
        if more is not None:
            known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
        found = found.unionByName(known)
    found = found.select(F.col("node").alias("rep"), "component")
    if shared:  # from numbers back to ids
        found = found.unionByName(found.select(F.col("component").alias("rep"), "component").distinct()).join(classes.select("rep", "least"), "rep")
        found = written(found, "found")
        lowest = written(found.groupBy("component").agg(F.min("least").alias("lowest"), F.count("*").alias("n")), "lowest")
        found = joined(found.select("rep", "component"), lowest, ["component"], _hot(lowest)).select("rep", F.col("lowest").alias("component"))
    of_class = classes.select("h1", "h2", "n", "rep", "least").join(found, "rep", "left")
    of_class = of_class.select("h1", "h2", "n", F.coalesce("component", "least").alias("component"))
    kept = F.col("doc_id") == F.col("component")
    linked = joined(signed.where(takes_part).select("doc_id", "n_shingles", "h1", "h2"), of_class, ["h1", "h2"], _hot(classes))
    alone = signed.where(~takes_part).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")).unionByName(alone)


def _hot(of_key: DataFrame) -> bool:
    """Whether a key has so many rows that they are to be dealt out."""
    return not _empty(of_key.where(F.col("n") > HOT))


def _across(placed: DataFrame, texts: DataFrame, classes: DataFrame, known: DataFrame, width: int, threshold: tuple[int, int], block_texts: int, block_shingles: int) -> DataFrame | None:
    """Links between components of one group that the first round has not found; None if there are none.

    They lead from the rest, the classes outside the group's largest component,
    to classes of another component and another block.  A group is compared
    band by band, or as a whole where that is less work (as in a group of near
    copies, whose members share most bands).
    """
    labelled = placed.join(known.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = written(labelled.select("rep", "cluster", "h1", "h2", "n_shingles", "component", F.col("block").alias("home")), "labelled")
    by_component = labelled.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    largest = by_component.groupBy("cluster").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.sum("n").alias("n"), F.count("*").alias("components")).where("components > 1").drop("components")
    labelled = joined(labelled, largest, ["cluster"], _hot(largest)).withColumn("rest", F.col("component") != F.col("largest")).drop("largest")
    labelled = written(labelled, "open")  # groups that are one component have dropped out
    if _empty(labelled):
        return None
    banded = labelled.join(classes.select("rep", "h1", "h2", "bands"), ["rep", "h1", "h2"]).select(*labelled.columns, F.explode("bands").alias("band"))

    def parts(rows: DataFrame, *keys: str) -> DataFrame:
        """How many blocks of classes, and of the rest, there are under a key with several components."""
        found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("rest").alias("rests"), F.sum("n_shingles").alias("shingles"), F.sum(F.when(F.col("rest"), F.col("n_shingles"))).alias("rest_shingles"), F.min("component").alias("low"), F.max("component").alias("high"))
        blocks = lambda n, shingles: F.greatest(F.ceil(F.col(n) / block_texts), F.ceil(F.col(shingles) / block_shingles)).cast("int")
        return found.where("rests > 0 AND low <> high").select(*keys, "n", "rests", blocks("n", "shingles").alias("blocks"), blocks("rests", "rest_shingles").alias("turns"))

    buckets, whole = written(parts(banded, "cluster", "band"), "buckets"), parts(labelled, "cluster")
    work = buckets.groupBy("cluster").agg(F.sum(F.col("n") * F.col("rests")).alias("by_band"))
    whole = written(whole.join(work, "cluster").withColumn("banded", F.col("by_band") < F.col("n") * F.col("rests")), "whole")
    buckets = written(buckets.join(whole.where("banded").select("cluster"), "cluster"), "compared")
    in_bands = joined(banded, buckets.drop("rests"), ["cluster", "band"], _hot(buckets))
    as_whole = joined(labelled, whole.where("NOT banded").drop("rests", "by_band", "banded"), ["cluster"], _hot(whole)).withColumn("band", F.lit(0).cast("long"))
    chosen = in_bands.unionByName(as_whole)
    place = lambda of: F.pmod(F.xxhash64("rep"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    common = [F.col(c) for c in ("cluster", "band", "rep", "h1", "h2", "component", "home", "rest")]
    asked = chosen.select(*common, place("blocks").alias("block"), every("turns").alias("turn"), F.lit(False).alias("asking"))
    asking = chosen.where("rest").select(*common, every("blocks").alias("block"), place("turns").alias("turn"), F.lit(True).alias("asking"))
    keys = ["cluster", "band", "turn", "block"]
    pieces = asked.unionByName(asking).join(texts, "rep").withColumnRenamed("rep", "doc_id")
    # a text that is in both parts is asking
    pieces = pieces.repartition(*keys).sortWithinPartitions(*keys, F.col("asking").desc())
    links = written(pieces.mapInArrow(_linking(width, threshold), "a long, b long"), "links-across")
    return None if _empty(links) else links


def _linking(width: int, threshold: tuple[int, int]):
    """Links in each group of sorted pieces, at most one for each two components."""

    def linked(group: pa.Table) -> pa.Table:
        some = _Texts(group, width, threshold)
        picked = group.take(pa.array(some.rows))
        labels, home = picked["component"].to_numpy(), picked["home"].to_numpy()
        rest, asks = (picked[c].to_numpy(zero_copy_only=False) for c in ("rest", "asking"))
        return _links(some, _link_across(some, labels, home, rest, asks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("cluster", "band", "turn", "block")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if last is not None and not np.array_equal(last, keys[a]):
                    yield from linked(pa.Table.from_batches(waiting)).to_batches()
                    waiting = []
                last = keys[a]
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield from linked(pa.Table.from_batches(waiting)).to_batches()

    return run


def _empty(table: DataFrame) -> bool:
    return table.limit(1).count() == 0

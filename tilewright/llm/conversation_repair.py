"""Conversation structure repair by shortest paths over small integer costs.

A conversation is repaired by edits of its rows in order: Keep (K) costs 0,
Rerole to user or assistant (R) 1, Delete (D) 2, Insert an empty user or
assistant turn (I) 5.  Blank and duplicate rows have to be deleted, and a
truncated row that is not deleted adds 5.  What comes out has to follow
`(s?(ua)+)?`, so a node of the search graph is a number of rows consumed and
one of four states of that pattern, and an arc is an edit.  The label of an arc
and its node determine where it leads.

Arcs cost 0 to 6, so Dial's queue of seven buckets, used in a ring, gives the
distance of every node from the end.  From the start, tight arcs (whose cost is
the difference of their ends' distances) are then followed, the least label
first, which gives the least audit of all cheapest ones.

A conversation's rows stream through their task in order: the search holds a
byte for each row and four distances, never the texts, and the repair reads the
rows again beside the audit.  A conversation is one stream of one task in both,
since an audit, and a digest of what was repaired, go from its first row to its
last.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scope
from ..shipping import ship
from ._common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_BUCKETS = max(REROLE + TRUNCATED, DELETE, INSERT) + 1
_FAR = (1 << 31) - 1

# states: nothing yet, after a system turn, after a user turn, after an assistant turn
_NEXT = (2, 2, 3, 2)  # the state after the user or assistant turn that may follow
_ROLES = {2: "user", 3: "assistant"}
_ENDS = (0, 3)
_STATES = 4
_GONE, _CUT = 4, 8  # flags of a row's code: to be deleted, truncated; below them the initial: 0 s, 1 u, 2 a, 3 any other


def _kept_as(initial: int, state: int) -> int | None:
    """The state after a row that is kept; None if its role does not fit."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state != 2 else None
    return 3 if initial == 2 and state == 2 else None


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(label, cost, next state) of the edits of a row, by label; an insertion comes between D and K."""
    found = [("D", DELETE, state)]
    if not code & _GONE:
        more = TRUNCATED if code & _CUT else 0
        after = _kept_as(code & 3, state)
        found += [("K", KEEP + more, after)] if after is not None else []
        found += [("R", REROLE + more, _NEXT[state])]
    return found


_EDITS = [[_edits(code, state) for state in range(_STATES)] for code in range(16)]
#: What leads into a state, for each code: (cost, state before).
_INTO = [[[(cost, s) for s in range(_STATES) for _, cost, to in of_code[s] if to == t] for t in range(_STATES)] for of_code in _EDITS]
_INSERTED = [[s for s in range(_STATES) if _NEXT[s] == t] for t in range(_STATES)]


def distances(codes: bytes) -> array:
    """Distance of each node (rows consumed, state), at _STATES * rows + state, from the end; only up to the start's distance are all known."""
    n = len(codes)
    far = array("i", [_FAR]) * (_STATES * (n + 1))
    ring: list[list[int]] = [[] for _ in range(_BUCKETS)]

    def reach(node: int, d: int) -> None:
        if d < far[node]:
            far[node] = d
            ring[d % _BUCKETS].append(node)

    for state in _ENDS:
        reach(_STATES * n + state, 0)
    d = 0
    while d <= far[0]:
        bucket = ring[d % _BUCKETS]
        while bucket:  # arcs without cost add to the bucket that is being emptied
            node = bucket.pop()
            if far[node] != d:
                continue  # it was reached by less meanwhile
            at, state = divmod(node, _STATES)
            for before in _INSERTED[state]:
                reach(_STATES * at + before, d + INSERT)
            if at:
                for cost, before in _INTO[codes[at - 1]][state]:
                    reach(_STATES * (at - 1) + before, d + cost)
        d += 1
    return far


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these codes; of equal costs the least audit."""
    far, n, at, state, out = distances(codes), len(codes), 0, 0, bytearray()
    left = far[0]
    while at < n or left:
        arcs = [(label, cost, 1, to) for label, cost, to in _EDITS[codes[at]][state]] if at < n else []
        arcs.insert(1, ("I", INSERT, 0, _NEXT[state]))
        label, cost, used, state = next(a for a in arcs if far[_STATES * (at + a[2]) + a[3]] == left - a[1])
        at, left = at + used, left - cost
        out += label.encode()
    return far[0], out.decode()


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows conv_id, turn, role, text, copy, gone with the damage that crc32 of `conv_id:turn` says; rows that are dropped have gone true. Nulls count as one space."""
    hit = F.crc32(F.concat_ws(":", F.coalesce(F.col(conv_col).cast("string"), F.lit(" ")), F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))) % 20
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    return rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (hit == 0).alias("gone"),
    )


#: Order of a conversation's rows: by turn, null first; rows of one turn by role and hash of the text.
_ORDER = ["turn", "role", "digest", "copy"]


def summaries(rows: DataFrame) -> DataFrame:
    """For each conversation of damaged rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    marked = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), "copy", "gone", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z").alias("cut"))
    # blank rows and rows that are gone are not looked up, so they need not be in one place
    alone = F.when(F.col("blank") | F.col("gone"), F.xxhash64("turn", "copy"))
    seen = Window.partitionBy("conv_id", "role", "digest", "gone", alone).orderBy("turn", "copy")
    fault = F.when(F.col("gone"), 0).when(F.col("blank"), 1).when(F.row_number().over(seen) > 1, 2).when(F.col("cut"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    marked = marked.select("conv_id", *_ORDER, "gone", fault.alias("fault"), F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"))
    marked = marked.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return marked.select("conv_id", "turn", "gone", "fault", "initial").mapInArrow(_summed, schema)


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.faults = conv_id, bytearray(), [0, 0, 0, 0]
        self.first = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, fault: int, initial: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.codes and (self.codes[-1] & 3, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.faults[fault] += 1
        self.codes.append(initial | (_GONE if fault in (1, 2) else _CUT if fault == 3 else 0))

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, *cheapest(bytes(self.codes)))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [pa.int64()] * 7 + [pa.string()]

    def table(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    now = None
    for batch in batches:
        done = []
        for conv_id, turn, gone, fault, initial in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv_id)
            if not gone:
                now.add(turn, fault, initial)
        if done:
            yield table(done)
    if now is not None:
        yield table([now.row()])


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the rows that are left of damaged rows, in order, after the edits of their conversation's audit."""
    null = lambda kind: F.lit(None).cast(kind)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), null("long").alias("turn"), null("string").alias("role"), null("string").alias("digest"), null("int").alias("copy"), F.col("audit").alias("text"))
    parts = rows.where("NOT gone").select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "copy", "text")
    both = heads.unionByName(parts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    return both.select("conv_id", "kind", "role", "text").mapInArrow(_edited, "conv_id long, place long, edit string, role string, text string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv = audit = None
    at = place = state = 0
    out: list[tuple] = []

    def put(edit: str, role: str, text: str) -> None:
        nonlocal place
        place += 1
        out.append((conv, place, edit, role, text))

    def inserts() -> None:
        """Insertions from here on, up to the next row's edit."""
        nonlocal at, state
        while audit is not None and at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            put("I", _ROLES[state], "")

    def table() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "place", "edit", "role", "text"])

    for batch in batches:
        for conv_id, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                inserts()  # the last conversation's
                conv, audit, at, place, state = conv_id, text, 0, 0, 0
                continue
            inserts()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _kept_as("sua".find(role[:1]) if role else 3, state)
                put("K", role, text)
            elif edit == "R":
                state = _NEXT[state]
                put("R", _ROLES[state], text)
        yield table()
        out.clear()
    inserts()
    yield table()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None

    def table(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1].hexdigest() for d in done], pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        done = []
        for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place == 1:
                done += [now] if now is not None else []
                now = (conv_id, hashlib.sha256())
            now[1].update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
        yield table(done)
    yield table([now] if now is not None else [])


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of conversations with rows in repaired(), whose order it needs."""
    return rows.select("conv_id", "place", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")


def damaged_and_repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation of rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged first, see damaged().  A null role or text counts as one
    space; a null id is a conversation like others; null turns come first and
    make no gaps.  Rows of one turn are taken by role and then by the MD5 of the
    text, so repeated rows follow each other and the later ones are duplicates.
    A conversation without rows after the damage has zeros, an empty audit and
    the empty text's digest.  An empty table gives an empty result.  Other
    columns are not looked at.
    """
    spark = rows.sparkSession
    ship(spark)
    broken = damaged(rows, conv_col, turn_col, role_col, text_col)
    with scope(spark) as tables:
        summed = tables.keep(written(summaries(broken), "summaries"))
    hashes = digests(repaired(broken, summed)).withColumnRenamed("conv_id", "of_conv")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    found = summed.join(hashes, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left")
    return found.select(*summed.columns, F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))

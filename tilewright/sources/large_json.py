"""Result documents of any size, read by byte ranges.

A document is a map from models to lists of entries, or a list of entries, in
one file.  Spark's text reader cuts it at closing braces, so its byte ranges are
tasks, and what stands between two braces is a row.  Where a range starts, the
reader cannot know whether it is in a string and how deep it is nested; so

1. each range says what it does to that state, for both beginnings: in a string
   or not, how many brackets of before it closes and which it opens;
2. a document's ranges, one small row each, are folded in order, which gives the
   state at each range's start;
3. each range is read again from its state and gives its units, where a unit is
   what lies between two entries' ends.  An entry is an object, so it ends at
   the end of a row.  Units that run over the ends of ranges are put together
   from a piece for each.

A task holds one unit and a batch of rows, however large the document is.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import scope, written
from ..shipping import ship
from .files import settings

#: Where an entry has ended: in a list of entries, in a model's list, or in the place of a model's list.
_ENDS = ("[", "{[", "{")
_NO_BRACKET = re.compile(r"[^][{}]+")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[][{}:]', re.S)
_PIECE = "document string, start long, place long, value string"


def _reduced(brackets: str) -> str:
    """Brackets without those that close each other."""
    while True:
        less = brackets.replace("[]", "").replace("{}", "")
        if less == brackets:
            return brackets
        brackets = less


def _step(text: str, quoted: bool) -> tuple[bool, str]:
    """(whether a string is open after a row and its brace, brackets that do not close each other), from whether one is open before."""
    return _after(_parts(text), quoted)


def _parts(text: str) -> list[str]:
    """What stands between the quotes of a row."""
    return (text.replace("\\\\", "").replace('\\"', "") if "\\" in text else text).split('"')


def _after(parts: list[str], quoted: bool) -> tuple[bool, str]:
    after = quoted ^ (len(parts) % 2 == 0)
    return after, _NO_BRACKET.sub("", "".join(parts[int(quoted) :: 2])) + ("" if after else "}")


def _steps(text: str, *quoted: bool) -> list[tuple[bool, str]]:
    """_step() from several states; the row is cut once, and a state that comes again is not worked out again."""
    parts = _parts(text)
    known: dict[bool, tuple[bool, str]] = {}
    return [known[q] if q in known else known.setdefault(q, _after(parts, q)) for q in quoted]


def _open(stack: str, brackets: str) -> str:
    return stack[:-1] if len(brackets) == 1 and stack and stack[-1] + brackets in ("[]", "{}") else _reduced(stack + brackets)


def _pieces(spark: SparkSession, paths: str | list[str], above: int) -> DataFrame:
    """document, start of the byte range, place, value: what stands before each closing brace of documents larger than above."""
    rows = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(paths).where(F.col("_metadata.file_size") > above)
    return rows.select(F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), "value")


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: end and brackets, when it starts outside (0) and inside (1) of a string."""
    now, ends, brackets = None, [], []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"document": [now[0]], "start": [now[1]], "end0": [ends[0]], "end1": [ends[1]], "brackets0": [brackets[0]], "brackets1": [brackets[1]]})

    for batch in batches:
        for document, start, value in zip(*(batch[c].to_pylist() for c in ("document", "start", "value")), strict=True):
            if now != (document, start):
                if now is not None:
                    yield row()
                now, ends, brackets = (document, start), [False, True], ["", ""]
            for q, (end, more) in enumerate(_steps(value, *ends)):
                ends[q], brackets[q] = end, _open(brackets[q], more) if more else brackets[q]
    if now is not None:
        yield row()


def _folded(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each of a document's ranges."""
    ranges = ranges.sort_values("start")
    quoted, stack, states = False, "", []
    for r in ranges.itertuples(index=False):
        states.append((quoted, stack))
        stack = _open(stack, r.brackets1 if quoted else r.brackets0)
        quoted = r.end1 if quoted else r.end0
    return pd.DataFrame({"document": ranges["document"], "start": ranges["start"], "quoted": [s[0] for s in states], "stack": [s[1] for s in states]})


def parsed_unit(unit: str, stack: str) -> tuple[str | None, str]:
    """(the last model that is named before the entry, the entry) of a unit that starts with these brackets open."""
    model = last = None
    for m in _TOKEN.finditer(unit):
        token = m[0]
        if token[0] == '"':
            last = token
        elif token == ":":
            model = json.loads(last) if stack == "{" else model
        elif token == "{" and (stack in ("[", "{[") or (stack == "{" and last is not None)):
            return model, unit[m.start() :]
        else:
            stack, last = _open(stack, token), None
    return model, ""


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind unit: an entry with its model, if that is named in the range; head, middle and tail: pieces of units that run over the range's ends.

    stack is what is open where a piece begins.
    """
    names = ["document", "start", "place", "kind", "stack", "model", "text"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []
    now = begun = model = None
    quoted, stack, text, ended, seen = False, "", [], False, 0

    def put(kind: str, model: str | None, value: str) -> None:
        out.append((*now, seen, kind, begun, model, value))

    def table() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        out.clear()
        return found

    for batch in batches:
        for document, start, value, q, s in zip(*(batch[c].to_pylist() for c in ("document", "start", "value", "quoted", "stack")), strict=True):
            if now != (document, start):
                if now is not None:
                    put("tail" if ended else "middle", None, "".join(text))
                now, quoted, stack, begun, text, ended, seen, model = (document, start), q, s, s, [], False, 0, None
            quoted, brackets = _step(value, quoted)
            stack = _open(stack, brackets)
            text.append(value + "}")
            if quoted or stack not in _ENDS:
                continue
            unit = "".join(text)
            if ended:
                named, entry = parsed_unit(unit, begun)
                model = model if named is None else named
                put("unit", model, entry)
            else:
                put("head", None, unit)
            begun, text, ended, seen = stack, [], True, seen + 1
        yield table()
    if now is not None:
        put("tail" if ended else "middle", None, "".join(text))
        yield table()


#: Tasks for each core, at most, where byte ranges have a size that is given; beyond, a task reads several ranges, one after the other.
TASKS_A_CORE = 16


@contextmanager
def _split_at(spark: SparkSession, size: int | None) -> Iterator[None]:
    """With a size, byte ranges have that many bytes instead of what is set, and tasks do not follow their number."""
    if size is None:
        yield
        return
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size), "spark.sql.files.maxPartitionNum": str(tasks)}):
        yield


def read_entries(spark: SparkSession, paths: str | list[str], above: int = 0, split_bytes: int | None = None) -> DataFrame:
    """document, model, entry: each entry of the documents larger than `above` bytes, as JSON text.

    model is null in a list of entries.  A model whose value is an object has
    that as its only entry.  Documents without entries give no rows.  What
    follows a place where a document is no JSON is not read as entries, or not
    rightly.
    """
    ship(spark)
    with scope(spark) as tables, _split_at(spark, split_bytes):
        effects = _pieces(spark, paths, above).mapInArrow(_effects, "document string, start long, end0 boolean, end1 boolean, brackets0 string, brackets1 string")
        states = written(effects.groupBy("document").applyInPandas(_folded, "document string, start long, quoted boolean, stack string"), "states")
        pieces = _pieces(spark, paths, above).join(states, ["document", "start"]).sortWithinPartitions("document", "start", "place")
        units = tables.keep(written(pieces.mapInArrow(_units, "document string, start long, place long, kind string, stack string, model string, text string"), "units"))
    # a unit over several ranges: a tail, any number of middles, and the next range's head
    head = F.when(F.col("kind") == "head", F.col("start"))
    order = [F.col("start"), F.col("kind") == "tail"]
    following = Window.partitionBy("document").orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    parts = units.where("kind <> 'unit'").withColumn("ends", F.first(head, ignorenulls=True).over(following)).where("ends IS NOT NULL")
    whole = parts.groupBy("document", F.col("ends").alias("start")).agg(F.array_sort(F.collect_list(F.struct("start", (F.col("kind") == "tail").alias("late"), "stack", "text"))).alias("p"))
    crossing = whole.select("document", "start", F.lit(-1).cast("long").alias("place"), F.col("p")[0]["stack"].alias("stack"), F.array_join("p.text", "").alias("text")).mapInArrow(_parsed, "document string, start long, place long, model string, text string")
    entries = units.where("kind = 'unit'").select("document", "start", "place", "model", "text").unionByName(crossing).where("text <> ''")
    # what a range does not name is what the ranges before it, or the unit that it began with, have named last
    earlier = Window.partitionBy("document").orderBy("start")
    known = F.when(F.col("model").isNotNull(), F.struct("place", "model"))
    named = entries.groupBy("document", "start").agg(F.max(known)["model"].alias("last"), F.max(F.when(F.col("place") < 0, F.col("model"))).alias("first"))
    named = named.select("document", "start", F.coalesce("first", F.last("last", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1))).alias("inherited"))
    return entries.join(named, ["document", "start"]).select("document", F.coalesce("model", "inherited").alias("model"), F.col("text").alias("entry"))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [parsed_unit(text, stack) for text, stack in zip(batch["text"].to_pylist(), batch["stack"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["document"], batch["start"], batch["place"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], names=["document", "start", "place", "model", "text"])

"""A quality classifier on document statistics.

Statistics of the whole text are standardised and mapped to random Fourier
features, cosines whose inner products approximate a Gaussian kernel.  Ridge
regression on them is solved from normal equations that are summed partition
by partition.  Isotonic regression on labelled rows that the ridge has not seen
turns its scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, written
from ._shingles import _word_hashes, mix, text_buffers

FEATURES = 384
PENALTY = 0.3
WIDTH = 0.5  # of the kernel: gamma is this over the number of statistics
SAMPLE = 100_000  # labelled rows that the classifier is fitted on, about
PARTITIONS = 16  # of these rows, whose sums come to the driver
CALIBRATION = 4  # one labelled row in so many calibrates
SEED = 7
_BLOCK = 1 << 19

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "space", "newline", "beyond_ascii", "period", "comma", "exclamation", "question", "bar", "slash", "quote", "bracket", "symbol", "byte_entropy",
    "word_length", "word_length_spread", "distinct_words", "repeated_runs", "words_a_line", "words_with_capital", "words_with_end_mark",
)


def _members(characters: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(characters.encode())] = 1
    return out


_CLASSES = np.stack(
    [
        _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _members("abcdefghijklmnopqrstuvwxyz"),
        _members("0123456789"),
        _members(" \t\r\x0b\x0c"),
        _members("\n"),
        (np.arange(256) >= 128).astype(float),
        _members("."),
        _members(","),
        _members("!"),
        _members("?"),
        _members("|"),
        _members("/\\"),
        _members("'\""),
        _members("()[]{}<>"),
        _members("#$%&*+-=@^_~`:;"),
    ],
    1,
)
_UPPER = _CLASSES[:, 0].astype(bool)
_END_MARK = _members(".,!?;:|*#$%&").astype(bool)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text; null counts as empty, an empty text has zeros."""
    offsets, data = text_buffers(texts)
    out = np.zeros((len(texts), len(STATISTICS)))
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _BLOCK, "right")) - 1)
        lengths = offsets[i + 1 : j + 1] - offsets[i:j]
        starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        block = np.full(int(starts[-1]), 0x20, np.uint8)
        keep = np.ones(len(block), bool)
        keep[starts[1:] - 1] = False
        block[keep] = data[offsets[i] : offsets[j]]
        out[i:j] = _block_statistics(block, starts, lengths)
        i = j
    return out


def _block_statistics(block: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Statistics of texts that start at starts and are each followed by a space that is not theirs."""
    n = len(lengths)
    owner = np.repeat(np.arange(n), np.diff(starts))
    histogram = np.bincount(owner * 256 + block, minlength=n * 256).reshape(n, 256).astype(float)
    histogram[:, 0x20] -= 1
    size = np.maximum(lengths, 1)[:, None]
    share = histogram / size
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(share > 0, share * np.log2(share), 0).sum(1)
    at, hashes = _word_hashes(block)
    bounds = np.searchsorted(at, starts)
    words = np.diff(bounds)
    some = np.maximum(words, 1)
    space = np.isin(block, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    ends = np.flatnonzero(np.diff(np.concatenate((space.view(np.int8), [1]))) == 1) + 1 if len(block) else np.zeros(0, int)
    ends = ends[: len(at)]
    length = (ends - at).astype(float)

    def summed(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(x)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    mean = summed(length) / some
    spread = np.sqrt(np.maximum(summed(length**2) / some - mean**2, 0))
    capital, marked = _UPPER[block[at]], _END_MARK[block[ends - 1]] if len(at) else np.zeros(0, bool)
    runs = hashes[:-2] + np.uint64(3) * hashes[1:-1] + np.uint64(5) * hashes[2:] if len(hashes) > 2 else np.zeros(0, np.uint64)
    runs = mix(runs)
    distinct, repeated = np.zeros(n), np.zeros(n)
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            distinct[k] = len(np.unique(hashes[a:b])) / (b - a)
        if b - a > 2:
            repeated[k] = 1 - len(np.unique(runs[a : b - 2])) / (b - a - 2)
    lines = histogram[:, 10] + 1
    return np.column_stack([np.log1p(lengths), np.log1p(words), np.log1p(histogram[:, 10]), (histogram @ _CLASSES) / size, entropy, mean, spread, distinct, repeated, np.log1p(words / lines), summed(capital) / some, summed(marked) / some])


@dataclass
class Kernel:
    """Standardisation and random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.column_stack([np.ones(len(x)), np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)])


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    knots: np.ndarray  # of the isotonic curve: ridge scores
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values)


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean score of each pool) and values (share of ones), both rising.

    Equal scores are one pool from the start, so that the order of the rows does not matter.
    """
    levels, at = np.unique(scores, return_inverse=True)
    n, ones = np.bincount(at), np.bincount(at, labels)
    pools: list[list[float]] = []  # sum of labels, of scores, number
    for s, y, k in zip(levels, ones, n, strict=True):
        pools.append([y, s * k, k])
        while len(pools) > 1 and pools[-2][0] * pools[-1][2] >= pools[-1][0] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    y, s, n = np.array(pools).T
    return s / n, y / n


def _column(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    x = rows["x"].combine_chunks() if isinstance(rows, pa.Table) else rows["x"]
    return x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(STATISTICS))


def _summed(rows: DataFrame, of) -> list[np.ndarray]:
    """of(x, y) gives arrays for some rows; their sums over all rows, partition by partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_column(batch), batch["y"].to_numpy())
                total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[np.asarray(a, float).tobytes() for a in total]], pa.list_(pa.binary()))], names=["sums"])

    found = rows.mapInArrow(add, "sums array<binary>").collect()
    return [np.sum([np.frombuffer(r["sums"][k]) for r in found], axis=0) for k in range(len(found[0]["sums"]))] if found else []


def document_statistics(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, x (the STATISTICS) of each row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch["text"])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], flat], names=["doc_id", "held_out", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(measure, "doc_id long, held_out boolean, x array<float>")


def fit(rows: DataFrame, features: int = FEATURES, penalty: float = PENALTY, width: float = WIDTH, seed: int = SEED) -> Model | None:
    """A model of rows (doc_id, x, y with y 0 or 1); None without rows.

    A row in CALIBRATION, by a hash of its id, calibrates; with rows of one
    side only, the same rows do both.  The rows are a bounded sample; they are
    dealt out to PARTITIONS tasks, each of which hands in its sums.
    """
    rows = written(rows.select("doc_id", "x", "y").repartition(PARTITIONS), "labelled")
    side = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(CALIBRATION)) == 0
    for fitting, calibrating in ((rows.where(~side), rows.where(side)), (rows, rows)):
        sums = _summed(fitting, lambda x, y: [np.array([len(x)]), x.sum(0), (x**2).sum(0)])
        if sums and calibrating.count():
            break
    else:
        return None
    n, first, second = sums
    mean = first / n
    scale = np.sqrt(np.maximum(second / n - mean**2, 0))
    scale[scale < 1e-9] = 1
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(len(mean), features)) * np.sqrt(2 * width / len(mean))
    kernel = Kernel(mean, scale, directions, rng.uniform(0, 2 * np.pi, features))

    def equations(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z = kernel(x)
        return [(z.T @ z).reshape(-1), z.T @ y]

    square, right = _summed(fitting, equations)
    square = square.reshape(features + 1, features + 1)
    ridge = np.full(features + 1, penalty)
    ridge[0] = 1e-6
    weights = np.linalg.solve(square + np.diag(ridge), right)
    model = Model(kernel, weights, np.zeros(1), np.zeros(1))
    known = calibrating.select("x", "y").toArrow()  # a bounded sample's part
    model.knots, model.values = isotonic(model.raw(_column(known)), known["y"].to_numpy().astype(float))
    return model


def scored(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    Labels are learned from rows whose crc32 of the id modulo folds is not
    fold, about `sample` of them by a hash of the id.  Labels that are null are
    passed over; an id with several labels has their mean, a half counting as
    1.  Empty and null texts have a score like others.  Without any label every
    score is 0.5.  Null ids stay null, with held_out false; repeated rows stay
    repeated.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    x = written(document_statistics(docs, crc_mod(id_col, folds) == fold, id_col, text_col), "statistics")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
    learned = known.where(crc_mod("doc_id", folds) != fold)
    n = learned.count()
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))
    model = fit(x.where(~F.col("held_out")).join(learned.where(draw), "doc_id"), **options)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sent.value(_column(batch)) if sent.value is not None else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return x.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")

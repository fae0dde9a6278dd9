"""Language identification by prediction by partial matching over bytes.

For each language the counts of what follows every context of up to ORDER
bytes form a context tree.  A byte's code length is that of the longest
context that has been seen: the byte's own share there, or an escape (method
C: as many escapes as different followers) and then the next shorter context
without the bytes that were excluded already, down to a uniform choice among
the bytes that are left.  With the statistics frozen, the code length depends
on the last ORDER bytes and the byte alone, so that it is worked out once for
each different run of ORDER + 1 bytes in a block of texts, and a text's exact
code length is a sum of these.

The trees are kept sparse, as sorted numbers of contexts and of what follows
them: their size goes with the different runs in the training texts, not with
languages times contexts.

Bytes are folded first: ASCII letters to lower case, other ASCII bytes than
letters and the apostrophe to one separator, so that digits, markup and line
breaks say nothing.  Runs of separators count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, drop, written
from ._shingles import text_buffers

ORDER = 3
SAMPLE = 2000  # documents that a language is learned from, about; whole texts
UNKNOWN = "und"
MODEL_BYTES = 512 << 20  # that a model may have to be sent to every executor
_BLOCK = 1 << 18  # bytes scored at a time

_SEPARATOR = 0


def _fold() -> np.ndarray:
    """Byte classes: 0 the separator, then the bytes that letters are made of."""
    kept = [ord("'"), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]
    table = np.zeros(256, np.uint8)
    table[kept] = np.arange(1, len(kept) + 1)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


_CLASS = _fold()
_SYMBOLS = int(_CLASS.max()) + 1  # 156 fits in 8 bits


def _folded(offsets: np.ndarray, data: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of texts i to j, each after a separator and with runs of separators as one; and where each starts."""
    lengths = offsets[i + 1 : j + 1] - offsets[i:j]
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.zeros(int(starts[-1]), np.uint8)
    keep = np.ones(len(out), bool)
    keep[starts[:-1]] = False
    out[keep] = _CLASS[data[offsets[i] : offsets[j]]]
    last = out == _SEPARATOR
    keep[0], keep[1:] = True, ~(last[1:] & last[:-1])
    keep[starts[:-1]] = True
    sums = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], sums[starts]


def _grams(symbols: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Each symbol with the order symbols before it, 8 bits each; before a text there are separators."""
    out = np.zeros(len(symbols), np.uint64)
    place = np.arange(len(symbols)) - np.repeat(starts[:-1], np.diff(starts))
    for k in range(order + 1):
        shifted = np.zeros(len(symbols), np.uint64)
        shifted[k:] = symbols[: len(symbols) - k]
        shifted[place < k] = _SEPARATOR
        out |= shifted << np.uint64(8 * k)
    return out


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, classes, starts) of runs of texts of bounded size; a longer text comes alone."""
    offsets, data = text_buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _BLOCK, "right")) - 1)
        yield i, j, *_folded(offsets, data, i, j)
        i = j


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n of the rows' lang and text: how often each run of order + 1 byte classes occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch["lang"].unique().to_pylist():
                of = batch.filter(pa.compute.equal(batch["lang"], lang))
                grams = [_grams(s, at, order) for _, _, s, at in _blocks(of["text"])]
                if grams:
                    gram, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(gram)), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Tree:
    """Contexts of one length and what follows them, with what is left of them when what follows a longer one is excluded."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, longer: _Tree | None):
        """grams: sorted numbers of a context and, in the last 8 bits, a symbol. longer: the tree of contexts one symbol longer."""
        self.grams, self.n = grams, n
        self.contexts, first = np.unique(grams >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(n, first) if len(n) else np.zeros(0)
        self.kinds = np.diff(np.append(first, len(grams)))
        self.longer = longer

    def context_of(self, context: np.ndarray) -> np.ndarray:
        """Place of each context; -1 for those that are not known."""
        return _places(self.contexts, context)

    def excluded(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each longer context: the counts here of the symbols that follow it, added up, and the place of its ending here."""
        mask = np.uint64((1 << 8 * (length + 1)) - 1)
        at = _places(self.grams, self.longer.grams & mask)
        owner = np.repeat(np.arange(len(self.longer.contexts)), self.longer.kinds)
        return np.bincount(owner, self.n[at], len(self.longer.contexts)), self.context_of(self.longer.contexts & (mask >> np.uint64(8)))


def _places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place in the sorted known of each of wanted, -1 where it is not among them."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


class _Language:
    """One language's context trees, longest contexts first in use."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, order: int):
        self.trees: list[_Tree] = []
        tree = None
        for k in range(order, -1, -1):
            some, back = np.unique(grams & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            tree = _Tree(some, np.bincount(back, n, len(some)), tree)
            self.trees.append(tree)
        # for every context: what is left of its ending, one symbol shorter, without what follows it
        self.left: list[tuple[np.ndarray, np.ndarray]] = []
        for k, shorter in zip(range(order - 1, -1, -1), self.trees[1:], strict=True):
            total, at = shorter.excluded(k)
            self.left.append((shorter.total[at] - total, shorter.kinds[at] - shorter.longer.kinds))
        for t in self.trees:
            t.longer = None

    def size(self) -> int:
        return sum(x.nbytes for t in self.trees for x in (t.grams, t.n, t.contexts, t.total, t.kinds)) + sum(a.nbytes + b.nbytes for a, b in self.left)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last symbol of each gram after the others."""
        order = len(self.trees) - 1
        out, paid = np.zeros(len(grams)), np.zeros(len(grams))
        todo = np.arange(len(grams))
        before = np.full(len(grams), -1)  # place of the longer context, where it was known
        for step, tree in enumerate(self.trees):
            k = order - step
            here = grams[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = tree.context_of(here >> np.uint64(8))
            seen = at >= 0
            total, kinds = np.where(seen, tree.total[at], 0), np.where(seen, tree.kinds[at], 0)
            if step:
                escaped = before >= 0
                left, fewer = self.left[step - 1]
                total, kinds = np.where(escaped, left[before], total), np.where(escaped, fewer[before], kinds)
            found = _places(tree.grams, here)
            coded = found >= 0
            whole = total + kinds
            out[todo[coded]] = paid[todo[coded]] + np.log2(whole[coded] / tree.n[found[coded]])
            more = ~coded & (kinds > 0)
            paid[todo[more]] += np.log2(whole[more] / kinds[more])
            todo, before = todo[~coded], at[~coded]
        if len(todo):
            out[todo] = paid[todo] + np.log2(_SYMBOLS - len(self.trees[-1].grams))
        return out


class Model:
    """Frozen statistics of every language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        if not 0 <= order <= 7:
            raise ValueError("order must be 0 to 7: a context and what follows it are kept in 64 bits")
        self.order = order
        self.languages = sorted(counts)
        self.trees = [_Language(counts[name][0].astype(np.uint64), counts[name][1].astype(float), order) for name in self.languages]

    def size(self) -> int:
        """Bytes of the trees."""
        return sum(t.size() for t in self.trees)

    def code_lengths(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bits of each text in each language, number of symbols of each text)."""
        bits, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for i, j, symbols, starts in _blocks(texts):
            grams, back = np.unique(_grams(symbols, starts, self.order), return_inverse=True)
            for k, tree in enumerate(self.trees):
                each = tree.bits(grams)[back]
                each[starts[:-1]] = 0  # the separator before the text
                sums = np.concatenate(([0], np.cumsum(each)))
                bits[i:j, k] = sums[starts[1:]] - sums[starts[:-1]]
            sizes[i:j] = np.diff(starts) - 1
        return bits, sizes


def fit(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, sample: int = SAMPLE) -> Model:
    """A model of the rows that satisfy `training` (a condition) and have a language and a text.

    Of each language about `sample` documents are taken, whole, by a hash of
    their id; all of them where there are fewer.  Without such rows it knows no
    language.
    """
    rows = docs.where(training).select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("language-id"), "doc_id"), F.lit(1 << 30))
    shares = F.create_map(*[F.lit(x) for lang, n in seen.items() for x in (lang, int(min(1.0, sample / n) * (1 << 30)))]) if seen else None
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    if seen:
        learned = written(gram_counts(rows.where(draw < shares[F.col("lang")]), order), "grams")
        if (least := 16 * learned.count()) > MODEL_BYTES:  # a gram and its count
            raise ValueError(f"the model would have more than {least} bytes, more than the {MODEL_BYTES} that are sent to executors: learn from fewer documents or with a lower order")
        found = learned.toArrow()
        drop(learned)
        langs, gram, n = found["lang"].combine_chunks(), found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
        for lang in langs.unique().to_pylist():
            of = pa.compute.equal(langs, lang).to_numpy(zero_copy_only=False)
            order_of = np.argsort(gram[of])
            counts[lang] = gram[of][order_of], n[of][order_of].astype(np.float64)
    return Model(counts, order)


def predict(docs: DataFrame, model: Model, held_out, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score, then the columns in keep.

    score is the posterior probability of lang_pred when all languages are
    equally likely before.  A text that is null or has no letter is `und` with
    score 0, and so is every text if no language was learned.  Equal code
    lengths go to the first language by name.  Null ids stay null, with
    held_out false; repeated rows stay repeated.  An empty table gives an empty
    result.  Other columns are not looked at.
    """
    if model.size() > MODEL_BYTES:
        raise ValueError(f"the model has {model.size()} bytes, more than the {MODEL_BYTES} that are sent to executors: learn from fewer documents or with a lower order")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    languages = pa.array([*model.languages, UNKNOWN])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            letters = pa.compute.match_substring_regex(batch["_text"], r"\pL").fill_null(False).to_numpy(zero_copy_only=False)
            if model.languages:
                bits, _ = model.code_lengths(batch["_text"])
                best = bits.argmin(1)
                chance = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
                best[~letters] = len(model.languages)
                chance[~letters] = 0
            else:
                best, chance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            out = [batch["doc_id"], batch["held_out"], languages.take(pa.array(best)), pa.array(chance)]
            yield pa.RecordBatch.from_arrays([*out, *[batch["_text" if c == text_col else c] for c in keep]], names=["doc_id", "held_out", "lang_pred", "score", *keep])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("_text"), *[F.col(c) for c in keep if c != text_col])
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema += "".join([f", `{c}` {fields[c]}" for c in keep])
    return rows.mapInArrow(score, schema)


def languages(docs: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """predict() by a model of the documents outside the fold: crc32 of the id modulo folds is not fold.

    Documents with a null id, text or language are not learned from; repeated
    rows count as often as they are there.  Without a language to learn, and
    for null texts and texts without a letter, the prediction is `und`.  An
    empty table gives an empty result.
    """
    side = crc_mod(id_col, folds)
    return predict(docs, fit(docs, side != fold, id_col, text_col, **options), side == fold, id_col, text_col)

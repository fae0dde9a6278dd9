"""Language, quality, pages, near copies and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilewright.llm import _shingles, html_text, language_id, near_dedup, quality
from tilewright.llm._components import components
from tilewright.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, held_out boolean, score double, bands int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, None, None, None) for i, t, lang, s in rows], DOCS)


# near copies ------------------------------------------------------------------


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates(spark, block):
    rng = random.Random(5)
    texts = family(rng, 40, 200, 4) + family(rng, 30, 60, 2) + family(rng, 10, 2000, 20) + ["", None, "  ", "one two", "ONE  two", "one two three", "A b C d E", "a B c\td e", "İx İx İx İx İx"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    found = near_dedup.near_duplicates(documents(spark, [(i, t, None, None) for i, t in rows]), block_texts=block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def chain(n, words, shift):
    """Texts of which neighbours share most words, but none is a near copy of another; each fifth has one of its own."""
    line = [f"c{i}" for i in range(n * shift + words)]
    texts = [" ".join(line[i * shift : i * shift + words]) for i in range(n)]
    return texts + [t + " and more" for t in texts[::5]]


def test_a_chained_group_takes_work_in_proportion(spark, monkeypatch):
    """One candidate group of unlike classes: what is compared grows with their number, not with its square, and no link is lost."""
    kept = {}
    write = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: kept.setdefault(name, []).append(write(df, name)) or kept[name][-1])
    work = []
    for n in (700, 2800):
        kept.clear()
        texts = chain(n, 144, 20)
        rng = random.Random(n)
        ids = rng.sample(range(10 * n), len(texts))
        docs = documents(spark, [(i, t, None, None) for i, t in zip(ids, texts, strict=True)])
        found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, block_texts=64).collect()}
        want = {i: i for i in ids}
        for k in range(n, len(texts)):
            pair = ids[(k - n) * 5], ids[k]
            want |= dict.fromkeys(pair, min(pair))
        assert found == want
        assert max(r.texts for r in kept["sizes"][0].collect()) > n // 2  # it is one group, or nearly
        compared = sum(r.n * r.rests for r in kept["compared"][0].collect())
        work.append(compared / len(texts))
    assert work[1] < 1.5 * work[0]


def test_blocks_and_hot_keys_give_the_same(spark, monkeypatch):
    """Keys beyond HOT are dealt out; bands with more classes than a block are cut in a grid."""
    from tilewright.llm import _components

    rng = random.Random(8)
    texts = family(rng, 60, 120, 14) + family(rng, 40, 60, 2) + ["one text"] * 30 + [None] * 30 + [""] * 5
    rows = [(2000 - i, t) for i, t in enumerate(texts)] + [(5, texts[3]), (6, texts[70])]
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    want = brute_components(rows)
    monkeypatch.setattr(near_dedup, "HOT", 10)
    monkeypatch.setattr(_components, "HOT", 10)
    found = near_dedup.near_duplicates(docs, block_texts=5).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


@pytest.mark.parametrize("block", [1024, 4])
def test_rows_that_share_an_id_are_judged_each_by_its_text(spark, block):
    rng = random.Random(12)
    t, u = family(rng, 2, 100, 1), family(rng, 3, 100, 1)
    rows = [(5, t[0]), (5, u[0]), (3, t[1]), (9, u[1]), (1, u[2])]
    found = near_dedup.near_duplicates(documents(spark, [(i, x, None, None) for i, x in rows]), block_texts=block).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found)
    assert got == brute_components(rows)
    assert [c for *_, c in got] == [1, 3, 1, 3, 1]
    for seed in range(2):
        rng = random.Random(seed)
        texts = [x for _ in range(12) for x in family(rng, rng.randrange(1, 7), 60, 3)] + ["one two", "One two", "", None]
        rows = [(rng.randrange(9), x) for x in texts for _ in range(rng.choice([1, 1, 2]))]
        found = near_dedup.near_duplicates(documents(spark, [(i, x, None, None) for i, x in rows]), block_texts=block).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


def test_near_duplicates_edges(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0
    rows = near_dedup.near_duplicates(documents(spark, [(None, "a b c d e f", None, None), (3, "a b c d e f", None, None), (3, "a b c d e f", None, None), (2, "", None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in rows) == [("2", 0, 2, True), ("3", 2, 3, True), ("3", 2, 3, True), ("None", 2, None, True)]
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(documents(spark, []), threshold=(1, 2))


def test_shingle_hashes_tell_the_same_as_shingles():
    texts = ["a b c d e f a b c d e f", "", None, "x", "ü" * 3_000_000 + " b c d e f", "A\x0bb\x0cC d e"]
    found = list(_shingles.shingle_sets(pa.array(texts)))
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    assert list(_shingles.word_counts(pa.array(texts))) == [len(words(t)) for t in texts]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    minhash = near_dedup.Circulant(288)
    x, y = (minhash.signature(np.concatenate([both, s])) for s in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.1


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 2000 + i) for i in range(50)]
    up = {}

    def root(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: root(i) for i in up if root(i) != i}


# languages ---------------------------------------------------------------------


def test_code_lengths_by_hand():
    """One language, order 1, against a direct reading of the method."""
    counts = np.unique(np.concatenate([language_id._grams(s, at, 1) for _, _, s, at in language_id._blocks(pa.array(["abab ac"]))]), return_counts=True)
    model = language_id.Model({"x": (counts[0], counts[1].astype(float))}, order=1)
    bits, sizes = model.code_lengths(pa.array(["ab"]))
    # after a separator: itself once (before the text), a twice; after a: b twice, c once
    assert sizes[0] == 2
    assert bits[0, 0] == pytest.approx(math.log2(5 / 2) + math.log2(5 / 2), rel=1e-6)


def counted(texts, order):
    grams = np.concatenate([language_id._grams(s, at, order) for _, _, s, at in language_id._blocks(pa.array(texts))])
    return np.unique(grams, return_counts=True)


def test_a_symbols_chances_add_up_to_one():
    model = language_id.Model({"x": counted(["some text or other, and more text", "another text"], 3)})
    for context in list({int(g) >> 8 for g in model.trees[0].trees[0].grams}) + [1, 77 << 8, 5 << 16]:
        grams = np.array([context << 8 | s for s in range(language_id._SYMBOLS)], np.uint64)
        assert np.exp2(-model.trees[0].bits(grams)).sum() == pytest.approx(1)


def direct_code_length(training, text, order):
    """Bits of a text by partial matching with escapes by method C and exclusion, symbol by symbol over dictionaries."""

    def symbols(t):
        out = [0]
        for b in t.encode():
            c = int(language_id._CLASS[b])
            if c or out[-1]:
                out.append(c)
        return out

    counts = {}
    for t in training:
        s = [0] * order + symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                followers = counts.setdefault(tuple(s[i - k : i]), {})
                followers[s[i]] = followers.get(s[i], 0) + 1
    s = [0] * order + symbols(text)
    bits = 0.0
    for i in range(order + 1, len(s)):
        excluded = set()
        for k in range(order, -1, -1):
            left = {x: n for x, n in counts.get(tuple(s[i - k : i]), {}).items() if x not in excluded}
            whole = sum(left.values()) + len(left)
            if s[i] in left:
                bits += math.log2(whole / left[s[i]])
                break
            if left:
                bits += math.log2(whole / len(left))
            excluded |= set(left)
        else:
            bits += math.log2(language_id._SYMBOLS - len(excluded))
    return bits


@pytest.mark.parametrize("order", [0, 1, 3, 5, 7])
def test_code_lengths_against_a_direct_reading(order):
    rng = random.Random(order)
    speech = {name: [" ".join(rng.choice(stock) for _ in range(rng.randrange(1, 40))) for _ in range(12)] for name, stock in (("a", ["the", "cat's", "and", "Dog", "ran"]), ("b", ["der", "Hund", "läuft", "und", "die"]), ("c", ["кот", "и", "the", "2 3"]))}
    model = language_id.Model({name: counted(texts, order) for name, texts in speech.items()}, order)
    texts = ["the cat and der Hund", "", "x", "лäß zzz", "кот и и  и 12 the", "!", *speech["b"][:2], "word " * 5000]
    bits, _ = model.code_lengths(pa.array(texts))
    for i, text in enumerate(texts):
        for k, name in enumerate(model.languages):
            assert bits[i, k] == pytest.approx(direct_code_length(speech[name], text, order), rel=1e-9, abs=1e-9)


def test_other_names_and_limits(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"the cat {i} and the dog", "en") for i in range(20)] + [(99, None, None)], "k long, body string, lang string")
    found = language_id.languages(rows, id_col="k", text_col="body", order=5).collect()
    assert {r.lang_pred for r in found} == {"en", "und"} and len(found) == 21
    with pytest.raises(ValueError):
        language_id.Model({}, order=8)
    monkeypatch.setattr(language_id, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        language_id.languages(rows, id_col="k", text_col="body")


def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op4_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == docs.count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.95 and found.score.between(0, 1).all()


def test_languages_edges(spark):
    rows = [(i, "the cat and the dog " * 5, "en", None) for i in range(20)] + [(20 + i, "der hund und die katze " * 5, "de", None) for i in range(20)]
    odd = [(100, None, "en", None), (101, "", "en", None), (102, "123 !?", None, None), (None, "the cat", None, None), (103, "и кот", None, None), (104, "und die katze " * 50_000, None, None), (104, "the", None, None)]
    found = {(r.doc_id, r.lang_pred) for r in language_id.languages(documents(spark, rows + odd)).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (104, "de"), (104, "en"), (3, "en"), (25, "de")} <= found
    assert {r.lang_pred for r in language_id.languages(documents(spark, [(1, "x", None, None)])).collect()} == {"und"}
    assert language_id.languages(documents(spark, [])).count() == 0


# quality -----------------------------------------------------------------------


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op9_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    ones, zeros = found[found.quality == 1].score.to_numpy(), found[found.quality == 0].score.to_numpy()
    auc = (ones[:, None] > zeros).mean() + (ones[:, None] == zeros).mean() / 2
    assert auc >= 0.9 and (found.predicted == found.quality).mean() >= 0.9


def test_quality_edges(spark):
    docs = documents(spark, [(1, None, None, None), (2, "", None, None), (3, "a b. c", None, None), (None, "x", None, None), (3, "a b. c", None, None), (4, "w " * 500_000, None, None)])
    labels = spark.createDataFrame([(1, None), (3, 1), (3, 0), (4, 0), (None, 1)], "doc_id long, quality int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert [r.score for r in quality.scored(docs, labels.limit(0)).collect()] == [0.5] * 6
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_isotonic():
    knots, values = quality.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert list(values) == [0, 0.5, 1] and (np.diff(knots) > 0).all()


@pytest.mark.parametrize("seed", range(6))
def test_isotonic_with_ties(seed):
    """Against the largest of the smallest means of runs of scores, which is another form of the same regression."""
    rng = np.random.default_rng(seed)
    scores, labels = rng.integers(0, 12, 80) / 4, rng.integers(0, 2, 80).astype(float)
    levels = np.unique(scores)
    mean = lambda a, b: labels[(scores >= levels[a]) & (scores <= levels[b])].mean()
    want = [max(min(mean(a, b) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]
    knots, values = quality.isotonic(scores, labels)
    order = rng.permutation(80)
    again = quality.isotonic(scores[order], labels[order])
    assert np.array_equal(knots, again[0]) and np.array_equal(values, again[1]) and (np.diff(knots) > 0).all()
    assert sorted(set(np.round(want, 12))) == list(np.round(values, 12))
    assert list(quality.isotonic(np.zeros(4), np.array([0.0, 1, 0, 1]))[1]) == [0.5]


def test_fit_against_a_dense_solution(spark):
    """Ridge weights from the whole matrix at once, and scores from them."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATISTICS))).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    rows = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(300)], "doc_id long, x array<float>, y double")
    model = quality.fit(rows, features=40)
    side = {r.doc_id for r in rows.where(F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(quality.CALIBRATION)) == 0).collect()}
    fitted = np.array([i not in side for i in range(300)])
    mean, scale = x[fitted].astype(float).mean(0), x[fitted].astype(float).std(0)
    assert np.allclose(model.kernel.mean, mean) and np.allclose(model.kernel.scale, scale, rtol=1e-5)
    z = np.clip((x - mean) / scale, -6, 6)
    features = np.column_stack([np.ones(300), np.sqrt(2 / 40) * np.cos(z @ model.kernel.directions + model.kernel.phases)])
    penalty = np.diag([1e-6] + [quality.PENALTY] * 40)
    weights = np.linalg.solve(features[fitted].T @ features[fitted] + penalty, features[fitted].T @ y[fitted])
    assert np.allclose(model.weights, weights, atol=1e-6)
    raw = features @ weights
    knots, values = quality.isotonic(raw[~fitted], y[~fitted])
    assert np.allclose(model(x), np.interp(raw, knots, values), atol=1e-5)
    assert np.allclose(model.weights, quality.fit(rows.orderBy(F.rand(1)), features=40).weights, rtol=1e-9)


def test_statistics_of_texts_do_not_mix():
    texts = ["A b. c", "", "x|y\n1!", None, "é é é é"]
    together = quality.statistics(pa.array(texts))
    assert np.allclose(together, np.concatenate([quality.statistics(pa.array([t])) for t in texts]))
    assert (together[1] == 0).sum() >= len(quality.STATISTICS) - 1


# pages -------------------------------------------------------------------------

STORY = "<p>First sentence, with a comma. And a second one, of some length, to read.</p><p>Short.</p><p>Third &amp; last, with <a href=x>a link</a> inside.</p>"
WANT = "First sentence, with a comma. And a second one, of some length, to read.\n\nShort.\n\nThird & last, with a link inside."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>t</title></head><body></body></html>", ""),
        (f"<nav><a>Menu</a></nav><article><h1>T</h1>{STORY}</article><footer>(c)</footer>", f"T\n\n{WANT}"),
        (f'<div class="site-header">x</div><div id="content"><h2>T</h2>{STORY}</div><div class="sidebar-left">y, z.</div><div id="comments"><p>Great post, really.</p></div>', f"T\n\n{WANT}"),
        (f'<main>{STORY}<section class="comments"><article class="comment"><p>No.</p></article></section><form><p>Sign up, now.</p></form></main>', WANT),
        (f"<body><h1>T</h1><div>{STORY}</div><script>if (a < b) {{ document.write('<p>x</p>') }}</script><style>p {{}}</style><!-- <p>c</p> --></body>", f"T\n\n{WANT}"),
        (f"<div class=cookie-notice>We use cookies, fine.</div><article>{STORY}<div class='ad'>Buy, now.</div><aside>More, here.</aside></article>", WANT),
        ("<article><p>a<br>b\n\t c&nbsp;d<p>e<ul><li>f<li>g</ul><table><tr><td>h<td>i</table></article>", "a b c d\n\ne\n\nf\n\ng\n\nh\n\ni"),
        ("<article><p><b>bold<br><p>next</article>", "bold\n\nnext"),
        ("<p>a < b and <3 &lt;x&gt; &#228; &eacute &bogus;", "a < b and <3 <x> ä é &bogus;"),
        ("<article><p>cut <a hre", "cut"),
        ("plain text only", "plain text only"),
    ],
)
def test_pages(html, want):
    assert html_text.main_text(html) == want


def test_page_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "x"), (None, None, None, "y"), (1, "u", "<p>é</p>", "x")], "page_id long, url string, html string, text string")
    rows = html_text.extracted(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in rows) == [("1", "é", 1), ("1", "é", 1), ("None", "", 0)]
    assert html_text.extracted(df.limit(0)).count() == 0


def test_all_pages(spark, sf_dir):
    from html import unescape

    for r in html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(x for x in parts if x)


def test_deep_and_odd_pages():
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert html_text.main_text("</p></b></div><p>x</i></p>") == "x"
    assert html_text.main_text("<p>" + "word, " * 200_000) == ("word, " * 200_000).strip()


# pipeline ----------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id = 1")).unionByName(spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34", "en", None, 1)], docs.schema)).withColumn("score", F.lit(1)).cache()
    named = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, sf_dir).cache()
        named[name] = current
        assert name == "byte_bpe" or current.columns == docs.columns
    first = {r.doc_id for r in named["language_id"].collect()}
    assert -1 not in first and -2 not in first and len(first) >= 0.99 * (docs.count() - 3)
    texts = {r.doc_id: r.text for r in docs.collect()}
    groups = {}
    for i in first:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", texts[i]), []).append(i)
    second = sorted(r.doc_id for r in named["exact_dedup"].collect())
    assert second == sorted(map(min, groups.values()))
    third = sorted(r.doc_id for r in named["near_dedup"].collect())
    assert third == sorted({c for *_, c in brute_components([(i, texts[i]) for i in second], 80)})  # the pipeline's threshold, not op1's
    fourth = [r.doc_id for r in named["source_mix"].collect()]
    assert set(fourth) <= set(third) and max(map(fourth.count, set(fourth))) <= 3
    assert named["byte_bpe"].count() == len(fourth)


def test_language_of_rows_with_small_ids_and_too_large_a_model(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "the cat and the dog" if i % 2 else "die Katze und der Hund", "en" if i % 2 else "de") for i in range(40)], "doc_id int, text string, lang string")
    found = language_id.languages(rows).collect()
    assert len(found) == 40 and all(r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in found)
    monkeypatch.setattr(language_id, "MODEL_BYTES", 100)
    with pytest.raises(ValueError, match="fewer documents"):
        language_id.languages(rows)

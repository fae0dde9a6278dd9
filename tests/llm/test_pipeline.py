"""The pipeline's stages on odd tables, each against what its operator says."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tilewright.llm import exact_dedup

#: columns with the names that the operators use themselves
NAMES = "doc_id long, text string, lang string, source string, n_chars long, row long, kept boolean, border string, part int, copies int, score double, size long, _copies int, _kept_id long, c0 string, keep_0 int"
WIDTH = len(NAMES.split(", "))
LONG = " ".join(f"word{i}" for i in range(30_000))


def table(spark, rows):
    """rows: doc_id, text, lang, source."""
    return spark.createDataFrame([(*r, k, *[None] * (WIDTH - 5)) for k, r in enumerate(rows)], NAMES)


def rows():
    rng = random.Random(1)
    out = [(i, " ".join(rng.choice(["the", "cat", "and", "dog", "ran", "on"]) + str(rng.randrange(60)) for _ in range(40)), "en", rng.choice("ab")) for i in range(25)]
    out += [(100 + i, " ".join(rng.choice(["der", "hund", "und", "die", "lief"]) + str(rng.randrange(60)) for _ in range(40)), "de", None) for i in range(25)]
    out += [(3, out[3][1], "en", "a"), (3, out[4][1], "en", "a"), (None, out[5][1], "en", None), (None, out[5][1], None, "b"), (None, None, None, None), (7, None, None, "a"), (8, "", "en", "a"), (9, " ", None, None), (200, LONG, "en", "a"), (201, LONG + " more", "en", "a"), (202, LONG.replace(" ", "  "), None, "b")]
    return out


def plain(df):
    return sorted((str(r.doc_id), str(r.text), str(r.source), r.n_chars) for r in df.collect())


def test_stages_with_nulls_repeats_and_clashing_names(spark, sf_dir):
    docs = table(spark, rows())
    known = corpus_pipeline.by_language(spark, docs, sf_dir)
    assert known.columns == docs.columns
    assert {r.n_chars for r in known.collect()} == {k for k, (_, t, *_) in enumerate(rows()) if t and t.strip()}

    once = corpus_pipeline.without_copies(spark, docs, sf_dir)
    assert once.columns == docs.columns
    groups = {}
    for k, (i, t, *_) in enumerate(rows()):
        groups.setdefault(" ".join((t or "").split(" ")) if t != LONG.replace(" ", "  ") else LONG, []).append((i is None, i or 0, k))
    found = once.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted(min(g)[:2] for g in [*[g for t, g in groups.items() if t.strip()], groups[""], groups[" "]])

    near = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert near.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in near.collect()]
    assert sum((t or "").startswith("word0 ") for _, t in texts) == 1 and (200, LONG) in texts
    # of id 3 its own text, once, and that of id 4, which goes
    assert sum(i is None for i, _ in texts) == 3 and [t for i, t in sorted(texts, key=str) if i in (3, 4)] == sorted([rows()[3][1], rows()[4][1]])

    mixed = corpus_pipeline.mixed_sources(spark, docs, sf_dir)
    assert mixed.columns == docs.columns
    copies = [r.n_chars for r in mixed.collect()]
    assert max(map(copies.count, set(copies))) <= 3 and all((rows()[k][1] or "").strip() for k in copies)

    assert corpus_pipeline.tokens(spark, docs, sf_dir).count() == len(rows())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_on_nothing(spark, sf_dir, stage):
    empty = table(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    found = stage(spark, empty, sf_dir)
    assert found.columns == empty.columns and found.count() == 0


@pytest.mark.parametrize("partitions", [1, 2, 9])
def test_without_duplicates_keeps_what_exact_duplicates_keeps(spark, partitions):
    rng = random.Random(partitions)
    same = "x" * 40  # one prefix for texts that differ
    texts = ["a  b", "a b", "", None, " ", same + "1", same + "2", same + " 2", same + "\t2", "b"]
    docs = table(spark, [(rng.choice([None, *range(50)]), rng.choice(texts), "en", "s") for _ in range(400)])
    kept = exact_dedup.without_duplicates(docs, partitions=partitions).collect()
    want = exact_dedup.exact_duplicates(docs, partitions=partitions).where("kept").collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r.doc_id) for r in want)
    sha = docs.select("n_chars", F.sha2(exact_dedup.normalised("text"), 256).alias("sha")).collect()
    of = {r.n_chars: r.sha for r in sha}
    assert sorted((str(r.doc_id), of[r.n_chars]) for r in kept) == sorted((str(r.doc_id), r.text_sha256) for r in want)

"""Edges and brute-force comparisons: exact copies, mixing, tokens, archives, search."""

import base64
import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.llm import _common, byte_bpe, exact_dedup, mixing, token_counts, vector_search, warc
from tilewright.llm import queries as llm

DOCS = "doc_id long, text string, lang string, source string, kept boolean, size int, score double, row int"


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, None, None, None, None) for i, t, lang, s in rows], DOCS)


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_and_sql(spark, sf_dir, duck, same, name):
    same(llm.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(llm.ORACLE_SQL[name]).df())


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_exact_dedup(spark, partitions):
    rng = random.Random(1)
    texts = ["a  b", "a b", "", None, " ", "x" * 100_000, "x" * 100_000, "a b ", "ä\tb", "ä b", "a b"]
    rows = [(i, rng.choice(texts), "en", "s") for i in range(300)] + [(7, "a b", "en", "s"), (7, "a b", "en", "s"), (None, "a b", None, None), (None, "only", None, None), (None, "only", None, None)]
    rng.shuffle(rows)
    found = exact_dedup.exact_duplicates(documents(spark, rows), partitions=partitions).collect()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    assert len(found) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = {}
    for r in found:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
        kept.setdefault(r.text_sha256, []).append(r.kept)
        assert not r.kept or r.doc_id == r.keep_id
    assert all(sum(k) == 1 for k in kept.values())


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


def test_mix_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 5)], "source string, size long")
    found = {r.source: r for r in mixing.source_targets(sizes).collect()}
    # weights 5, 2, 1, 5: a stops at 30, the null source at 15, b at 300, the rest goes to c
    assert found["a"].target == 30 and found[None].target == 15 and found["b"].target == 300
    assert found["c"].target == pytest.approx(1115 - 345)


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 400])) if i % 40 else None, "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(500)]
    rows += rows[:3]
    docs = documents(spark, rows)
    a = mixing.mixed(docs).collect()
    assert len(a) == len(rows)
    total = sum(r["size"] for r in a)
    source = {i: s for i, _, _, s in rows}
    for name in set(source.values()):
        mine = [r for r in a if source[r.doc_id] == name]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= mixing.PACKET
    assert all(0 <= r.taken <= 3 * r["size"] for r in a) and sum(r.taken for r in a) == total
    assert sorted(map(tuple, a)) == sorted(map(tuple, mixing.mixed(docs.repartition(3)).collect()))
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mixed(documents(spark, [(1, None, None, None), (2, " ", None, None)])).collect()] == [0, 0]


def brute_mix(rows, targets, budget, packet=mixing.PACKET, repeats=3):
    """taken of rows (doc_id, source, size), by a queue that is one list."""
    key = lambda r: (hashlib.md5(f"mix-{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[2])
    queue, taken = [], [0] * len(rows)
    for source in {r[1] for r in rows}:
        end = 0
        for _ in range(repeats):
            for i in sorted((i for i, r in enumerate(rows) if r[1] == source), key=lambda i: key(rows[i])):
                for a in range(0, rows[i][2], packet):
                    words = min(packet, rows[i][2] - a)
                    end += words
                    queue.append((end / targets[source], source is None, source or "", end, i, words))
    for *_, i, words in sorted(queue):
        taken[i] += min(words, budget)
        budget -= min(words, budget)
    return taken


@pytest.mark.parametrize("budget", [None, 0, 700, 10**6])
def test_the_queues_cut_decides(spark, budget):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "b", "c", None]), rng.choice([0, 1, 7, 130, 300])) for i in range(120)] + [(500, "a", 5000), (501, "b", 3), (501, "b", 3), (None, "a", 9), (None, "c", 9)]
    docs = documents(spark, [(i, "w " * n, "en", s) for i, s, n in rows])
    found = mixing.mixed(docs, budget=budget, group=16).collect()
    source = {i: s for i, s, _ in rows}
    # rows without an id are of two sources and sizes differ between none of them
    sizes = spark.createDataFrame([(s, n) for _, s, n in rows], "source string, size long")
    targets = {r.source: r.target for r in mixing.source_targets(sizes, budget=budget).collect()}
    total = sum(n for *_, n in rows)
    want = brute_mix(rows, targets, total if budget is None else budget) if budget != 0 else [0] * len(rows)
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r["size"], r.target, r.taken) for r in found), key=key) == sorted(((i, n, targets[s], t) for (i, s, n), t in zip(rows, want, strict=True)), key=key)
    uncut = brute_mix(rows, targets, 10**9) if budget != 0 else []
    assert (want == uncut) == (budget == 10**6)  # nothing but the cut limits what is taken
    assert all(abs(sum(t for (_, s, _), t in zip(rows, want, strict=True) if s == name) - targets[name]) <= 2 * mixing.PACKET for name in set(source.values())) or budget is not None


TEXTS = [
    "", None, "Hello world's  don't  ", "a\n\n b\t\tc   ", "中文字符 mixed 123 ４５６ ²³", "émile Ünïcödé ñandú", "x" * 5000, "   ", " 　 \x1c", "🙂🙂 é", "<|endoftext|> </s> <unk>", "1234567890" * 50, "'s 'S 't", "퟿\U0010ffff", "😀" * 40 + "don't",
]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as p
    import tiktoken

    path = p.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, p.PATTERN, tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens(spark, sf_dir, tokenizer):
    path, pattern, enc = tokenizer
    rows = [(i, t, None, None) for i, t in enumerate(TEXTS)] + [(None, "a", None, None), (0, "", None, None)]
    rows += [(1000 + r.doc_id, r.text, None, None) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    docs = documents(spark, rows)
    texts = dict((i, t or "") for i, t, *_ in rows)
    found = byte_bpe.token_digests(docs, path, pattern).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    back = byte_bpe.decode_ids(byte_bpe.encode_ids(docs, path, pattern), path, pattern)
    assert all(bytes(r.data).decode() == texts[r.doc_id] for r in back.collect())
    assert byte_bpe.token_digests(docs.limit(0), path, pattern).count() == 0


def test_long_text_is_encoded_in_parts(tokenizer):
    path, pattern, enc = tokenizer
    text = "wörd 12 中 " * 60_000
    ids = enc.encode_ordinary(text)
    assert list(byte_bpe.ByteBpe(path, pattern).digests(["a", text, "b"]))[1][:2] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_token_counts(spark, sf_dir, tokenizer):
    path, pattern, enc = tokenizer
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "doc_id", F.lit(1).alias("n_docs"), F.lit(2).alias("n_tokens"))
    docs = docs.unionByName(spark.createDataFrame([(None, 1, 1, 1), ("", 2, 1, 1), ("", 2, 1, 1)], docs.schema))
    lengths = np.array([len(enc.encode_ordinary(r.text or "")) for r in docs.collect()])
    found = token_counts.histogram(docs, path, pattern)
    table = token_counts.limits(found)
    rows = table.collect()
    assert [r.n_tokens for r in sorted(rows)] == sorted(set(lengths.tolist()))
    for r in rows:
        n, within = r.n_tokens, lengths[lengths <= r.n_tokens]
        assert (r.n_docs, r.docs_within, r.docs_beyond) == ((lengths == n).sum(), len(within), len(lengths) - len(within))
        assert (r.tokens_within, r.tokens_beyond, r.truncated_total) == (within.sum(), lengths.sum() - within.sum(), np.minimum(lengths, n).sum())
        assert r.share_within == pytest.approx(len(within) / len(lengths))
    middle = token_counts.quantiles(table, [0.5, 1.0]).collect()
    assert {r.share: r.n_tokens for r in middle} == {0.5: int(np.quantile(lengths, 0.5, method="inverted_cdf")), 1.0: int(lengths.max())}
    assert {r.context_limit: r.total for r in token_counts.truncated_totals(found, [0, 100, 10**6]).collect()} == {x: np.minimum(lengths, x).sum() for x in (0, 100, 10**6)}
    assert token_counts.limits(token_counts.histogram(docs.limit(0), path, pattern)).count() == 0


PAGES = "page_id long, url string, html string, digest string, bytes long, salt int"


def test_archives(spark):
    big = "äöü€" * 40_000
    rows = [(1, "u1", "<p>x"), (2, "u 2\r\nX: y", "<p>x"), (3, None, big), (4, "u", ""), (5, "u", None), (9, "u", big), (6, "v", "\r\n\r\nWARC/1.1\r\n0\r\n\r\n"), (None, "n", "<p>x"), (7, "w", "one"), (7, "w", "one"), (None, None, "lone")]
    pages = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES)
    found = warc.round_trip(pages, segment_bytes=1000, chunk_bytes=300).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        newest = max((j for j, _, h in rows if (h or "") == (html or "") and j is not None), default=None)
        revisit = newest is not None and i != newest
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", newest if revisit else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    assert warc.round_trip(pages.limit(0)).count() == 0
    least = {(r.page_id, r.record_type) for r in warc.round_trip(pages.where("page_id < 3"), least_bytes=5).collect()}
    assert least == {(1, "response"), (2, "response")}


def test_revisits_name_a_record_of_the_archive(spark):
    big = "long " * 3000
    rows = [(1, "u", "<p>x"), (2, "v", "<p>x"), (3, "w", big), (4, "w", big), (4, "w", big), (5, None, big), (5, None, big), (None, "n", "<p>x"), (6, "o", "one")]
    newest = {"<p>x": 2, big: 5}
    path = _common.scratch(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path, segment_bytes=1000, file_records=7)
    names, refers = [], []
    for r in spark.read.format("binaryFile").load(path).collect():
        for fields, _ in warc.parse_archive(bytes(r.content)):
            if fields["warc-type"] == "response":
                names.append(fields["warc-record-id"])
            refers += [fields["warc-refers-to"]] if "warc-refers-to" in fields else []
    assert len(refers) == 5 and set(refers) <= set(names)
    found = warc.read_warc(spark, path).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.refers_to or 0) for r in found) == sorted((i or 0, len(h), newest.get(h, 0) if newest.get(h, i) != i else 0) for i, _, h in rows)


def test_broken_archives_are_refused():
    record = next(warc.page_records(0, 1, "u", "hello", None, warc.payload_digest(b"hello"), 5)).encode() + b"\r\n\r\n"
    assert len(list(warc.parse_archive(record * 2))) == 2
    with pytest.raises(warc.WarcError):
        list(warc.parse_archive(record[:-5]))
    with pytest.raises(warc.WarcError):
        warc._payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhellO\r\n0\r\n\r\n", warc.payload_digest(b"hello"))
    part = {"segment": 1, "record_type": "response", "block": b"HTTP/1.1 200 OK\r\n\r\nhello", "origin": "o", "digest": None, "total": None}
    with pytest.raises(warc.WarcError):
        warc.assembled([part, {"segment": 3, "record_type": "continuation", "block": b"x", "origin": "o", "total": 25}])
    assert warc.assembled([part, {"segment": 2, "record_type": "continuation", "block": b"x", "origin": "o", "total": 25}])[1] == b"hellox"
    assert warc.dechunked(b"3;a=b\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for i, q in good:
        if i % 20 == 0:
            found = sorted((-sum(float(a) * float(b) for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))[:k]
            out += [(i, n + 1, j, s) for n, (s, j) in enumerate(found)]
    return sorted((i, n, j) for i, n, j, _ in out)


def test_search_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(60)]
    rows += [(400, None), (420, [0.0] * 8), (440, [None] + [1.0] * 7), (460, [float("nan")] * 8), (480, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (2000, [])]
    df = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], "vec_id long, embedding array<double>, score double, rank int")
    found = vector_search.nearest(df, df.where("vec_id % 20 = 0"), k=5, shard_bytes=50 * 64, leaf_rows=8, block_bytes=1000)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect()) == brute_nearest(rows, 5)
    assert vector_search.nearest(df.limit(0), df.limit(0)).count() == 0
    assert vector_search.nearest(df, df.limit(0)).count() == 0


def test_larger_factors_find_most(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = {(r.query_id, r.vec_id) for r in vector_search.nearest(df, df.where("vec_id % 20 = 0"), leaf_rows=16).collect()}
    loose = {(r.query_id, r.vec_id) for r in vector_search.nearest(df, df.where("vec_id % 20 = 0"), factor=1.5, leaf_rows=16).collect()}
    assert len(exact & loose) / len(exact) >= 0.9


def clustered(rng, n, dim, clusters, width):
    centres = rng.normal(size=(clusters, dim))
    vectors = centres[rng.integers(0, clusters, n)] + width * rng.normal(size=(n, dim))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def found_by(tree, ids, queries, k, factor, least=None):
    tree.scored = 0
    q, x, score = tree.search(ids, queries, k, factor, least)
    return set(zip(q.tolist(), x.tolist(), strict=True)), tree.scored


def test_the_tree_prunes_clustered_vectors():
    """Factor one is exact and scores less than half; a larger factor scores less again and finds nine of ten."""
    rng = np.random.default_rng(5)
    vectors, ids = clustered(rng, 8000, 16, 80, 0.1), np.arange(8000)
    tree = vector_search.Tree(ids, vectors)
    asked = np.arange(0, 8000, 20)
    products = vectors[asked] @ vectors.T
    products[np.arange(len(asked)), asked] = -np.inf
    want = {(q, int(x)) for q, row in enumerate(products) for x in np.argsort(-row, kind="stable")[:20]}
    exact, scored = found_by(tree, asked, vectors[asked], 20, 1.0)
    assert exact == want and scored < 0.2 * products.size
    loose, fewer = found_by(tree, asked, vectors[asked], 20, 3.0)
    assert len(loose & want) >= 0.9 * len(want) and fewer < 0.8 * scored
    # a bound from another shard prunes from the start, and keeps what reaches it
    least = np.sort(products, 1)[:, -5]
    bound, less = found_by(tree, asked, vectors[asked], 20, 1.0, least)
    assert bound == {(q, x) for q, x in want if products[q, x] >= least[q]} and less <= scored


def test_a_third_of_equal_vectors():
    """They are one entry, whose ids count one by one."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 8))
    vectors[1000:2000] = vectors[1000] * 4
    ids = rng.permutation(3000)
    tree = vector_search.Tree(ids, vectors, 16)
    assert len(tree.vectors) == 2001
    asked = np.array([5, 1000, 1001, 2500])
    found, _ = found_by(tree, ids[asked], vectors[asked], 7, 1.0)
    exact = vector_search.inner(vectors, vectors, np.repeat(asked, 3000), np.tile(np.arange(3000), 4)).reshape(4, -1)
    assert found == {(q, int(ids[x])) for q in range(4) for x in [x for x in np.lexsort((ids, -exact[q])) if x != asked[q]][:7]}


def test_shards_and_blocks_give_the_same(spark):
    rng = np.random.default_rng(7)
    vectors = (clustered(rng, 600, 8, 10, 0.2) * 16).round()  # products are exact, and there are ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = vector_search.nearest(df, df.where("vec_id % 20 = 0"), k=20, shard_bytes=100 * 64, leaf_rows=8, block_bytes=600).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == brute_nearest([(i, v.tolist()) for i, v in enumerate(vectors)], 20)


def test_scratch_is_cleared(spark):
    from tilewright.llm import _common

    path = _common.scratch(spark, "x").removeprefix("file://")
    df = _common.written(spark.range(3).toDF("i"), "x")
    assert df.count() == 3 and os.path.isdir(os.path.dirname(path))
    _common.clear(spark)
    assert not os.path.exists(os.path.dirname(path))

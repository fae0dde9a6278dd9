"""Line runs, conversation repair and the Merkle manifest against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tilewright.llm import conversation_repair as repair
from tilewright.llm import line_dedup, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, batch int, part long, docs int, last int"


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, n, *[None] * 6) for i, t, lang, s, n in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_lines(rows, min_chars, min_docs):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in k) if len(k) >= min_chars else None

    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and key(line) is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def line_rows(seed):
    rng = random.Random(seed)
    common = ["Same line Ä%d" % k + "x" * (k % 7) for k in range(12)] + ["ü" * 9, "ü" * 10, "  padded line here\t", "PADDED line here\x0b", "a" * 50_000]
    rows = []
    for i in range(120):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))] + [f"own line number {i}" for _ in range(rng.randrange(2))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "en", "s", 1))
    rows += [(7, "ü" * 10, None, None, None), (7, rows[7][1], None, None, None), (None, "ü" * 10 + "\n", None, None, None), (None, None, None, None, None), (200, None, None, None, None), (201, "", None, None, None), (202, "\n\n", None, None, None), (202, "\n\n", None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("batches", "fanout", "min_docs"), [(1, 2, 5), (4, 2, 5), (5, 3, 9), (3, 9, 1)])
def test_line_dedup(spark, batches, fanout, min_docs):
    rows = line_rows(batches)
    found = line_dedup.without_common_lines(documents(spark, rows), min_chars=10, min_docs=min_docs, batches=batches, fanout=fanout)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, 10, min_docs)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.without_common_lines(documents(spark, [])).collect() == []
    rows = [(None, "x" * 60, None, None, None)] * 7
    assert [r.n_dropped for r in line_dedup.without_common_lines(documents(spark, rows)).collect()] == [0] * 7


def test_line_runs_are_compacted_and_settled_keys_stay_out(spark):
    runs = line_dedup.Runs(spark, min_docs=2, fanout=2)
    batch = lambda *rows: spark.createDataFrame([(i, k.encode()) for i, k in rows], "doc_id long, key binary")
    try:
        runs.add(batch((9, "a"), (8, "a"), (8, "a"), (8, "b")))
        runs.add(batch((7, "a"), (7, "b"), (7, "c")))  # a is settled
        assert [len(level) for level in runs.levels] == [0, 1]
        runs.add(batch((6, "c"), (5, "b"), (99, "a")))  # but a has a new last holder now
        assert [len(level) for level in runs.levels] == [1, 1]
        assert sorted((bytes(r.key).decode(), r.docs, r.last) for r in runs.common().collect()) == [("a", 3, 99), ("b", 2, 8), ("c", 2, 7)]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = runs._merged(runs._names())._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount" in plan
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        runs.clear()


def brute_repair(codes):
    """Least (cost, audit) over all sequences of edits with at most two insertions between rows."""
    best = {0: (0, "")}  # by state
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def inserted(states):
        for _ in range(3):
            for q, (cost, audit) in list(states.items()):
                to = 3 if q == 2 else 2
                states[to] = min(states.get(to, (1 << 30, "")), (cost + 5, audit + "I"))
        return states

    best = inserted(best)
    for code in codes:
        after = {}
        for q, (cost, audit) in best.items():
            options = [(2, "D", q)]
            if not code & 4:
                more = 5 if code & 8 else 0
                options += [(1 + more, "R", 3 if q == 2 else 2)]
                if (q, "sua?"[code & 3]) in step:
                    options += [(more, "K", step[q, "sua?"[code & 3]])]
            for c, label, to in options:
                after[to] = min(after.get(to, (1 << 30, "")), (cost + c, audit + label))
        best = inserted(after)
    return min(best[q] for q in (0, 3) if q in best)


def every_audit(codes):
    """Least (cost, audit) by trying every audit of bounded length."""
    found = []
    for n in range(len(codes) + 5):
        for audit in itertools.product("DIKR", repeat=n):
            at, cost, roles = 0, 0, ""
            for e in audit:
                expected = "a" if roles[-1:] == "u" else "u"
                if e == "I":
                    cost, roles = cost + 5, roles + expected
                    continue
                if at == len(codes) or (e != "D" and codes[at] & 4):
                    break
                cost += {"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and codes[at] & 8 else 0)
                roles += {"D": "", "K": "sua?"[codes[at] & 3], "R": expected}[e]
                at += 1
            else:
                if at == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, "".join(audit)))
    return min(found)


def test_shortest_paths():
    rng = random.Random(3)
    assert repair.cheapest(b"") == (0, "")
    for _ in range(60):
        codes = bytes(rng.choice((0, 1, 2, 3, 1, 2, 5, 9, 10, 8, 6)) for _ in range(rng.randrange(5)))
        assert repair.cheapest(codes) == every_audit(codes) == brute_repair(codes), codes
    for _ in range(400):
        codes = bytes(rng.choice((0, 1, 2, 3, 1, 2, 5, 9, 10, 8, 6)) for _ in range(rng.randrange(40)))
        assert repair.cheapest(codes) == brute_repair(codes), codes


def brute_conversations(rows):
    text_of = lambda x: " " if x is None else x
    convs = {}
    for c, t, role, text in rows:
        mine = convs.setdefault(c, [])
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        mine += [(t, role, text)] * (2 if hit == 3 else 1)
    out = []
    for c, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, *_ in mine if t is not None]
        faults, seen, codes = [0, 0, 0, 0], set(), []
        for _, role, text in mine:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            codes.append("sua".find(role[0]) % 4 if role else 3)
            codes[-1] |= 4 if fault in (1, 2) else 8 if fault == 3 else 0
        illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in itertools.pairwise(mine))
        cost, audit = brute_repair(codes)
        at, state, lines = 0, "", []
        for e in audit:
            expected = {"u": "assistant"}.get(state, "user")
            if e == "I":
                lines.append(f"{expected}:")
                state = expected[0]
                continue
            _, role, text = mine[at]
            at += 1
            if e != "D":
                role = role if e == "K" else expected
                lines.append(f"{role}:{text}")
                state = role[0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *faults[1:], illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id long, turn long, role string, text string, copy int, gone boolean, audit string, cost int"


def test_conversation_repair(spark):
    rng = random.Random(5)
    texts = ["Hello.", "Why?", "No end", "", None, " \t", "End. \n", "Wait!x", "ä.", "x" * 100_000]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User", "sys"]
    rows = [(rng.choice([*range(60), None]), rng.choice([*range(12), None]), rng.choice(roles), rng.choice(texts)) for _ in range(900)]
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (101, 3, "user", None), (102, -5, "user", "a."), (102, 7, "assistant", "b.")]
    gone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "only row, dropped.")]
    found = repair.damaged_and_repaired(spark.createDataFrame([(*r, None, None, None, None) for r in rows], CONVERSATIONS))
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == brute_conversations(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", sha("")) in got
    assert repair.damaged_and_repaired(spark.createDataFrame([], CONVERSATIONS)).collect() == []


def brute_manifest(rows):
    def enc(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(i, t, lang, s, n):
        return sha("".join(map(enc, (i, s, lang, n, t))))

    def tree(nodes):
        """(root, siblings and sides of each node)"""
        paths, place, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for k, p in enumerate(place):
                other = p ^ 1
                paths[k].append((level[other] if other < len(level) else "", other < p))
            level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
            place = [p // 2 for p in place]
        return level[0], paths

    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(langs[lang], key=lambda x: x[:3])]) for lang in names}
    root, upper = tree([trees[lang][0] for lang in names])
    out = []
    for lang, above in zip(names, upper, strict=True):
        for (_, _, digest, row), path in zip(sorted(langs[lang], key=lambda x: x[:3]), trees[lang][1], strict=True):
            i, t, _, s, n = row
            tampered = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
            folded = leaf(i, t, lang, s, n + 1) if tampered else digest
            for other, left in path + above:
                folded = sha(other + folded if left else folded + other)
            out.append((i, digest, trees[lang][0], root, sha("".join(x for x, _ in path + above)), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_merkle(spark, levels):
    rng = random.Random(levels)
    langs = ["en"] * 5 + ["de", "fr", None, "", "ä", "Z", "\U0001f600"]
    rows = [(i, rng.choice(["text", "", None, "äö", "x" * 50_000]), rng.choice(langs), rng.choice(["s", None]), rng.choice([1, None, 20])) for i in range(137)]
    rows += [(5, "again", "en", "s", 1), (5, "again", "en", "s", 1), (None, "no id", "en", "s", 1), (None, "no id", None, None, None), (-3, "alone", "xx", "s", 7)]
    rng.shuffle(rows)
    found = merkle.tampered_manifest(documents(spark, rows), levels=levels)
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == brute_manifest(rows)
    assert {v for *_, v in got} == {True, False}


def test_merkle_of_little(spark):
    assert merkle.tampered_manifest(documents(spark, [])).collect() == []
    one = [(7, "x", None, None, None)]
    assert list(map(tuple, merkle.tampered_manifest(documents(spark, one)).collect())) == brute_manifest(one)
    two = [(1, "x", "a", None, None), (2, "x", "b", None, 1)]
    assert sorted(map(tuple, merkle.tampered_manifest(documents(spark, two)).collect()), key=str) == brute_manifest(two)

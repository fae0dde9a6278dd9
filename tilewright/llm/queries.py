"""The queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, conversation_repair, exact_dedup, html_text, language_id, line_dedup, merkle, mixing, near_dedup, quality, token_counts, vector_search, warc
from ._common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), threshold=(85, 100))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.limits(token_counts.histogram(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20, factor=1.0)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.without_common_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_html_text,
        op3_exact_dedup,
        op4_language_id,
        op5_byte_bpe,
        op6_token_counts,
        op7_warc,
        op8_source_mix,
        op9_quality,
        op10_vector_search,
        op11_line_dedup,
        op12_conversation_repair,
        op13_merkle,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), e AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
        ), links AS (
            SELECT a, b FROM e UNION ALL SELECT b, a FROM e
        ), reach(d, c) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.d, links.b FROM reach r JOIN links ON r.c = links.a
        )
        SELECT d AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, min(c) = d AS kept FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d
    """,
    "op3_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM n
    """,
    "op7_warc": r"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), h AS (
            SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
                   array_to_string(list_transform(string_split(sha1(encode(payload)), ''), lambda c:
                       ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', c)]), '') AS bits
            FROM p
        ), d AS (
            SELECT page_id, payload_bytes,
                   array_to_string(list_transform(range(32), lambda i:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda j: CASE WHEN substr(bits, 5 * i + j + 1, 1) = '1' THEN [16, 8, 4, 2, 1][j + 1] ELSE 0 END)) AS INT), 1)), '') AS payload_digest
            FROM h
        ), m AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> newest THEN newest END AS refers_to
        FROM m
    """,
    "op8_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                   md5(concat('mix-', CAST(doc_id AS VARCHAR))) AS key
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS weight
            FROM d GROUP BY source
        ), f AS (
            SELECT source, source_size, weight, CAST(3 * source_size AS DOUBLE) AS most,
                   row_number() OVER w AS place,
                   (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(CAST(3 * source_size AS DOUBLE)) OVER b, 0))
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
            FROM s
            WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST),
                   b AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), r AS (
            SELECT min(place) AS place, min_by(level, place) AS level FROM f WHERE level * weight <= most
        ), t AS (
            SELECT source, source_size, CASE WHEN f.place < r.place THEN most ELSE r.level * weight END AS target FROM f, r
        ), c AS (
            SELECT d.doc_id, d.size, t.source_size, t.target,
                   d.source, CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id) AS BIGINT) - d.size AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), p AS (
            SELECT source, target, size, skip, e * source_size + before + skip AS start
            FROM (SELECT *, unnest(range(0, size, 128)) AS skip, e FROM c, (SELECT unnest([0, 1, 2]) AS e))
        ), q AS (
            SELECT source, least(128, size - skip) AS words, start + least(128, size - skip) AS finish, target FROM p
        ), o AS (
            SELECT source, words, sum(words) OVER (ORDER BY finish / target, source NULLS LAST, finish ROWS UNBOUNDED PRECEDING) - words AS position FROM q
        ), v AS (
            SELECT source, CAST(sum(greatest(0, least(words, (SELECT sum(size) FROM d) - position))) AS BIGINT) AS served FROM o GROUP BY source
        )
        SELECT doc_id, size, source_size, target,
               CAST(list_sum(list_transform([0, 1, 2], lambda e: greatest(0, least(size, served - e * source_size - before)))) AS BIGINT) AS taken
        FROM c JOIN v ON c.source IS NOT DISTINCT FROM v.source
    """,
    # exact, since factor one prunes nothing that could be among the nearest
    "op10_vector_search": r"""
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        ), u AS (
            SELECT * FROM v
            WHERE v IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM u q JOIN u c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_line_dedup": r"""
        WITH l AS (
            SELECT row, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
            FROM (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), c AS (
            SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), f AS (
            SELECT k.*, coalesce(k.doc_id < c.last, false) AS gone FROM k LEFT JOIN c USING (key)
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM f GROUP BY row
    """,
    # a state's best is kept as its cost in 12 digits and its audit, so that the least text is the cheapest and then the least audit
    "op12_conversation_repair": r"""
        WITH RECURSIVE h AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
            FROM conversations
        ), g AS (
            SELECT *, xor(CRC, 4294967295) % 20 AS hit FROM h
        ), d AS (
            SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                   CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM g WHERE hit <> 0
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
            FROM d
        ), f AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN again THEN 2
                           WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
                   substr(role, 1, 1) || '>' || substr(lead(role) OVER (PARTITION BY conv_id ORDER BY place), 1, 1) AS pair
            FROM p
        ), s AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
                   count(*) FILTER (WHERE pair NOT IN ('s>u', 'u>a', 'a>u')) AS illegal
            FROM f GROUP BY conv_id
        ), b(conv_id, place, d0, d1, d2, d3) AS (
            SELECT conv_id, n + 1, '000000000000', '000000000010II', '000000000005I', '000000000000' FROM s
            UNION ALL
            SELECT conv_id, place,
                   list_min([e[1], STEP(5, 'I', e[3]), STEP(10, 'II', e[4])]), list_min([e[2], STEP(5, 'I', e[3]), STEP(10, 'II', e[4])]),
                   list_min([e[3], STEP(5, 'I', e[4])]), list_min([e[4], STEP(5, 'I', e[3])])
            FROM (
                SELECT f.conv_id, f.place, CASE WHEN fault IN (1, 2) THEN [STEP(2, 'D', d0), STEP(2, 'D', d1), STEP(2, 'D', d2), STEP(2, 'D', d3)]
                    ELSE [list_min([STEP(2, 'D', d0), STEP(m + 1, 'R', d2), CASE x WHEN 's' THEN STEP(m, 'K', d1) WHEN 'u' THEN STEP(m, 'K', d2) ELSE '~' END]),
                          list_min([STEP(2, 'D', d1), STEP(m + 1, 'R', d2), CASE x WHEN 'u' THEN STEP(m, 'K', d2) ELSE '~' END]),
                          list_min([STEP(2, 'D', d2), STEP(m + 1, 'R', d3), CASE x WHEN 'a' THEN STEP(m, 'K', d3) ELSE '~' END]),
                          list_min([STEP(2, 'D', d3), STEP(m + 1, 'R', d2), CASE x WHEN 'u' THEN STEP(m, 'K', d2) ELSE '~' END])] END AS e
                FROM b JOIN (SELECT *, CASE fault WHEN 3 THEN 5 ELSE 0 END AS m, substr(role, 1, 1) AS x FROM f) f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.place = b.place - 1
            )
        ), a AS (
            SELECT conv_id, CAST(substr(d0, 1, 12) AS BIGINT) AS cost, substr(d0, 13) AS audit FROM b WHERE place = 1
        ), w(conv_id, nth, place, state, piece) AS (
            SELECT conv_id, 0, CAST(0 AS BIGINT), 0, CAST(NULL AS VARCHAR) FROM a
            UNION ALL
            SELECT conv_id, nth, place, to_state, CASE edit WHEN 'K' THEN role || ':' || text WHEN 'D' THEN NULL ELSE CASE to_state WHEN 2 THEN 'user:' ELSE 'assistant:' END || coalesce(text, '') END
            FROM (
                SELECT w.conv_id, w.nth + 1 AS nth, w.place + CAST(y.edit <> 'I' AS BIGINT) AS place, y.edit, f.role, f.text,
                       CASE y.edit WHEN 'D' THEN w.state WHEN 'K' THEN CASE substr(f.role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE w.state WHEN 2 THEN 3 ELSE 2 END END AS to_state
                FROM w JOIN (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS nth, unnest(string_split(audit, '')) AS edit FROM a) y ON y.conv_id IS NOT DISTINCT FROM w.conv_id AND y.nth = w.nth + 1
                LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1 AND y.edit <> 'I'
            )
        ), t AS (
            SELECT conv_id, string_agg(piece, chr(10) ORDER BY nth) AS repaired FROM w GROUP BY conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op13_merkle": r"""
        WITH RECURSIVE l AS (
            SELECT doc_id, lang, sha256(FIELDS(n_chars)) AS leaf,
                   CASE WHEN xor(CRC, 4294967295) % 7 = 0 THEN sha256(FIELDS(n_chars + 1)) ELSE sha256(FIELDS(n_chars)) END AS offered
            FROM (SELECT *, CAST(doc_id AS VARCHAR) AS k FROM documents)
        ), n AS (
            SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l
        ), up(tree, level, idx, digest, size) AS (
            SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM n
            UNION ALL
            SELECT DISTINCT tree, level + 1, idx // 2, sha256(string_agg(digest, '') OVER (PARTITION BY tree, idx // 2 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), (size + 1) // 2 FROM up WHERE size > 1
        ), r AS (
            SELECT tree, level, digest AS subroot FROM up WHERE size = 1
        ), top(level, idx, digest, size) AS (
            SELECT 0, tree - 1, subroot, count(*) OVER () FROM r
            UNION ALL
            SELECT DISTINCT level + 1, idx // 2, sha256(string_agg(digest, '') OVER (PARTITION BY idx // 2 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), (size + 1) // 2 FROM top WHERE size > 1
        ), root AS (
            SELECT level, digest AS root FROM top WHERE size = 1
        ), steps AS (
            SELECT n.tree, n.idx, y.level, CASE WHEN y.idx % 2 = 0 THEN '<' ELSE '>' END || y.digest AS step
            FROM n JOIN up y ON y.tree = n.tree AND y.size > 1 AND y.idx = xor(n.idx >> y.level, 1)
            UNION ALL
            SELECT n.tree, n.idx, y.level, '' FROM n JOIN up y ON y.tree = n.tree AND y.size > 1 AND y.idx = n.idx >> y.level AND y.idx % 2 = 0 AND y.idx = y.size - 1
            UNION ALL
            SELECT n.tree, n.idx, r.level + y.level, CASE WHEN y.idx % 2 = 0 THEN '<' ELSE '>' END || y.digest
            FROM n JOIN r USING (tree) JOIN top y ON y.size > 1 AND y.idx = xor((n.tree - 1) >> y.level, 1)
            UNION ALL
            SELECT n.tree, n.idx, r.level + y.level, '' FROM n JOIN r USING (tree) JOIN top y ON y.size > 1 AND y.idx = (n.tree - 1) >> y.level AND y.idx % 2 = 0 AND y.idx = y.size - 1
        ), paths AS (
            SELECT tree, idx, list(step ORDER BY level) AS path FROM steps GROUP BY ALL
        ), v AS (
            SELECT n.doc_id, n.leaf, r.subroot, root.root, sha256(coalesce(array_to_string(list_transform(path, lambda p: substr(p, 2)), ''), '')) AS proof_sha256,
                   list_reduce(list_prepend(n.offered, coalesce(path, [])), lambda h, p: sha256(CASE WHEN p[1:1] = '<' THEN substr(p, 2) || h ELSE h || substr(p, 2) END)) AS folded_root
            FROM n JOIN r USING (tree) CROSS JOIN root LEFT JOIN paths USING (tree, idx)
        )
        SELECT *, folded_root = root AS verified FROM v
    """,
}


#: What the SQL above abbreviates: CRC is the CRC-32 of the ASCII text k before its last inversion.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(k)), lambda i: CAST(ascii(substr(k, i + 1, 1)) AS BIGINT))),
                lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, CAST(3988292384 AS BIGINT)) ELSE r // 2 END))"""


def _step(m: re.Match) -> str:
    """One more edit before a state's best: its cost is added to the 12 digits, its label put before the audit."""
    cost, label, best = m.groups()
    return f"(lpad(CAST(CAST(substr({best}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{label}' || substr({best}, 13))"


def _fields(m: re.Match) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", m[1], "text")]
    return " || ".join(f"coalesce(octet_length(encode({t})) || ':' || {t}, '-')" for t in texts)


ORACLE_SQL = {name: re.sub(r"\bFIELDS\(([^)]*)\)", _fields, re.sub(r"\bSTEP\(([^,]*), '(\w+)', ([^)]*)\)", _step, re.sub(r"\bCRC\b", lambda m: _CRC, sql))) for name, sql in ORACLE_SQL.items()}

"""DuckDB SQL with the results of the queries, written apart from them."""

from __future__ import annotations

# Fixed values, written out here too, so that a wrong one in the functions shows.
ANSWER_MARK, TASK_MARK = "答案：", "[任务]"
TILE_NAMES = "1万 2万 3万 4万 5万 6万 7万 8万 9万 1筒 2筒 3筒 4筒 5筒 6筒 7筒 8筒 9筒 1索 2索 3索 4索 5索 6索 7索 8索 9索 东 南 西 北 白 发 中".split()
WIND_NAMES, ROUND_NUMBERS = "东 南 西 北".split(), "一 二 三 四".split()


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


_NAMES = _list(TILE_NAMES)
_SPACE = r"[\s\x{3000}]+"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g')"


def _counts(tiles: str) -> str:
    return f"list_transform(range(34), lambda t: CAST(len(list_filter({tiles}, lambda x: x = t)) AS INT))"


_BOARDS = f"""
    b0 AS (SELECT o_orderkey AS key, 2 * (o_orderkey % 67) + 1 AS a FROM orders),
    b1 AS (SELECT key, a + CASE WHEN a % 17 = 0 THEN 2 ELSE 0 END AS a FROM b0),
    b2 AS (SELECT key, list_transform(range(107), lambda i: CAST(((a * i + key % 136) % 136) // 4 AS INT)) AS kinds FROM b1),
    boards AS (
        SELECT key, CAST(key % 5 AS INT) AS wind, CAST(key // 3 % 5 AS INT) AS dealer, CAST(key % 4 AS INT) AS pov,
               CAST(key % 3 AS INT) AS honba, CAST(key // 5 % 3 AS INT) AS sticks, CAST(70 - 4 * (key % 17) AS INT) AS wall,
               list_transform(range(4), lambda j: CAST(25000 + (key * (j + 1) * 37 % 401 - 200) * 100 AS INT)) AS scores,
               list_transform(range(4), lambda j: (key + 2 * j) % 5 = 0) AS riichi,
               kinds[1:14] AS hand_tiles, kinds[15:15 + key % 2] AS shown_tiles,
               list_transform(range(4), lambda j: kinds[84 + 6 * j:84 + 6 * j + 3 * ((key + j) % 3) - 1]) AS meld_tiles,
               list_transform(range(4), lambda j: kinds[17 + 16 * j:17 + 16 * j + least(16, key % 17 + CASE WHEN j < key % 4 THEN 1 ELSE 0 END) - 1]) AS discard_tiles,
               CASE WHEN key % 29 = 0 THEN NULL WHEN key % 31 = 0 THEN 34 ELSE kinds[1 + key % 14] END AS label
        FROM b2
    )
"""
_SEEN = f"""
    f0 AS (
        SELECT *, {_counts("hand_tiles")} AS hand, {_counts("list_concat(hand_tiles, list_concat(shown_tiles, list_concat(flatten(meld_tiles), flatten(discard_tiles))))")} AS seen,
               CAST(len(flatten(discard_tiles)) // 4 + 1 AS INT) AS turn,
               list_sort(list_distinct(list_transform(shown_tiles, lambda i:
                   CASE WHEN i < 27 THEN i // 9 * 9 + (i % 9 + 1) % 9 WHEN i < 31 THEN 27 + (i - 26) % 4 ELSE 31 + (i - 30) % 3 END))) AS dora
        FROM boards
    ),
    f1 AS (SELECT *, list_transform(seen, lambda c: greatest(0, 4 - c)) AS remaining FROM f0)
"""
# All ways to take a suit apart, tile by tile: x, y and z are what is left of the counts at place and the next two.
_TEXTBOOK = """
    hands AS (SELECT key, hand, len(meld_tiles[pov + 1]) // 3 AS calls FROM f1),
    suits AS (SELECT DISTINCT hand[9 * s + 1:9 * s + 9] AS d FROM hands, range(3) AS r(s)),
    ways(d, place, x, y, z, blocks, pair, v) AS (
        SELECT d, 1, d[1], d[2], d[3], 0, 0, 0 FROM suits
        UNION
        SELECT d, place + m.step, CASE m.step WHEN 1 THEN y ELSE x - m.a END, CASE m.step WHEN 1 THEN z ELSE y - m.b END, CASE m.step WHEN 1 THEN coalesce(d[place + 3], 0) ELSE z - m.c END, ways.blocks + m.blocks, ways.pair + m.pair, ways.v + m.v
        FROM ways JOIN (VALUES (1, 0, 0, 0, 0, 0, 0), (0, 1, 0, 0, 0, 0, 0), (0, 3, 0, 0, 1, 0, 2), (0, 1, 1, 1, 1, 0, 2), (0, 1, 1, 0, 1, 0, 1), (0, 1, 0, 1, 1, 0, 1), (0, 2, 0, 0, 1, 0, 1), (0, 2, 0, 0, 0, 1, 1)) AS m(step, a, b, c, blocks, pair, v)
          ON CASE m.step WHEN 1 THEN x = 0 AND place < 9 ELSE x >= m.a AND y >= m.b AND z >= m.c AND ways.blocks + m.blocks <= 4 AND ways.pair + m.pair <= 1 END
    ),
    suit_best AS (SELECT d, blocks, pair, max(v) AS v FROM ways WHERE place = 9 AND x = 0 GROUP BY ALL),
    kinds AS (SELECT DISTINCT key, unnest(hand[28:34]) AS n, generate_subscripts(hand[28:34], 1) AS kind FROM hands),
    honors(key, kind, blocks, pair, v) AS (
        SELECT key, 0, 0, 0, 0 FROM hands
        UNION
        SELECT h.key, k.kind, h.blocks + m.blocks, h.pair + m.pair, h.v + m.v
        FROM honors h JOIN kinds k ON k.key = h.key AND k.kind = h.kind + 1 JOIN (VALUES (0, 0, 0, 0), (3, 1, 0, 2), (2, 1, 0, 1), (2, 0, 1, 1)) AS m(least, blocks, pair, v) ON k.n >= m.least AND h.blocks + m.blocks <= 4 AND h.pair + m.pair <= 1
    ),
    honor_best AS (SELECT key, blocks, pair, max(v) AS v FROM honors WHERE kind = 7 GROUP BY ALL),
    two AS (SELECT h.key, a.blocks + b.blocks AS blocks, a.pair + b.pair AS pair, max(a.v + b.v) AS v FROM hands h JOIN suit_best a ON a.d = h.hand[1:9] JOIN suit_best b ON b.d = h.hand[10:18] WHERE a.blocks + b.blocks <= 4 AND a.pair + b.pair <= 1 GROUP BY ALL),
    three AS (SELECT h.key, a.blocks + b.blocks AS blocks, a.pair + b.pair AS pair, max(a.v + b.v) AS v FROM hands h JOIN two a ON a.key = h.key JOIN suit_best b ON b.d = h.hand[19:27] WHERE a.blocks + b.blocks <= 4 AND a.pair + b.pair <= 1 GROUP BY ALL),
    whole AS (SELECT h.key, h.calls, h.hand, CAST(8 - 2 * h.calls - max(a.v + b.v) AS INT) AS standard FROM hands h JOIN three a ON a.key = h.key JOIN honor_best b ON b.key = h.key WHERE a.blocks + b.blocks + h.calls <= 4 AND a.pair + b.pair <= 1 GROUP BY h.key, h.calls, h.hand)
    SELECT key, standard, CAST(CASE WHEN calls > 0 THEN standard ELSE least(standard,
        6 - len(list_filter(hand, lambda c: c >= 2)) + greatest(0, 7 - len(list_filter(hand, lambda c: c >= 1))),
        13 - len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: hand[i] > 0)) - CASE WHEN len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: hand[i] > 1)) > 0 THEN 1 ELSE 0 END) END AS INT) AS shanten FROM whole
"""
# The moves from the lowest tile of a suit, which is written as digits without the zeros before its lowest tile.
_SHANTEN = """
    hands AS (SELECT key, -1 AS tile, 0 AS open, hand AS h FROM f1
              UNION ALL SELECT key, CAST(t.tile AS INT), remaining[t.tile + 1], list_transform(hand, lambda c, i: c + CASE WHEN i = t.tile + 1 THEN 1 ELSE 0 END) FROM f1, range(34) AS t(tile) WHERE remaining[t.tile + 1] > 0),
    suits AS (SELECT key, tile, open, h, list_transform([0, 1, 2], lambda s: ltrim(array_to_string(h[9 * s + 1:9 * s + 9], ''), '0')) AS d FROM hands),
    walk(o, s, m, t) AS (
        SELECT DISTINCT u, u, 0, 0 FROM (SELECT unnest(d) AS u FROM suits)
        UNION
        SELECT o, ltrim(mv.n, '0'), m + mv.dm, t + mv.dt
        FROM (
            SELECT o, m, t, unnest([
                CASE WHEN a >= 3 THEN {'n': (a - 3) || substr(s, 2), 'dm': 1, 'dt': 0} END,
                CASE WHEN b > 0 AND c > 0 THEN {'n': (a - 1) || '' || (b - 1) || '' || (c - 1) || substr(s, 4), 'dm': 1, 'dt': 0} END,
                CASE WHEN b > 0 THEN {'n': (a - 1) || '' || (b - 1) || substr(s, 3), 'dm': 0, 'dt': 1} END,
                CASE WHEN c > 0 THEN {'n': (a - 1) || '' || b || '' || (c - 1) || substr(s, 4), 'dm': 0, 'dt': 1} END,
                CASE WHEN a >= 2 THEN {'n': (a - 2) || substr(s, 2), 'dm': 0, 'dt': 1} END]) AS mv
            FROM (SELECT *, CAST(substr(s, 1, 1) AS INT) AS a, coalesce(TRY_CAST(substr(s, 2, 1) AS INT), 0) AS b, coalesce(TRY_CAST(substr(s, 3, 1) AS INT), 0) AS c FROM walk WHERE s <> '')
        ) WHERE mv IS NOT NULL
    ),
    best AS (SELECT o, max_by(2 * m + t, 10 * m + t) AS v FROM walk GROUP BY o),
    valued AS (
        SELECT key, tile, open, greatest(0, 8 - x.v - y.v - z.v - list_sum(list_transform(h[28:34], lambda c: 2 * (c // 3) + CASE WHEN c % 3 = 2 THEN 1 ELSE 0 END))) AS standard,
               6 - len(list_filter(h, lambda c: c >= 2)) + greatest(0, 7 - len(list_filter(h, lambda c: c >= 1))) AS pairs,
               13 - len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: h[i] > 0)) - CASE WHEN len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: h[i] > 1)) > 0 THEN 1 ELSE 0 END AS orphans
        FROM suits JOIN best x ON x.o = d[1] JOIN best y ON y.o = d[2] JOIN best z ON z.o = d[3]
    ),
    least_of AS (SELECT key, tile, open, standard, least(standard, pairs, orphans) AS n FROM valued),
    found AS (
        SELECT w.key, CAST(w.standard AS INT) AS standard, CAST(w.n AS INT) AS shanten, CAST(coalesce(sum(p.open) FILTER (p.n < w.n), 0) AS INT) AS ukeire
        FROM least_of w LEFT JOIN least_of p ON p.key = w.key AND p.tile >= 0 WHERE w.tile = -1 GROUP BY ALL
    )
"""
_DANGER = """
    seats AS (
        SELECT key, turn, dora, seen, tile, seat.j AS j, discard_tiles[seat.j + 1] AS thrown, len(meld_tiles[seat.j + 1]) AS called, riichi[seat.j + 1] AS flag
        FROM (SELECT *, unnest(list_sort(list_distinct(hand_tiles))) AS tile FROM f1), range(4) AS seat(j)
    ),
    risks AS (
        SELECT key, tile, j, CASE WHEN list_contains(thrown, tile) THEN 0.0::DOUBLE ELSE
            greatest(CASE WHEN tile < 27 THEN 150.0::DOUBLE ELSE 80.0 END + CASE WHEN list_contains(dora, tile) THEN 50.0 ELSE 0.0 END
                - CASE WHEN tile < 27 AND ((tile % 9 >= 2 AND list_contains(thrown, tile - 2)) OR (tile % 9 <= 6 AND list_contains(thrown, tile + 2))) THEN 80.0 ELSE 0.0 END
                + CASE WHEN seen[tile + 1] >= 4 THEN -120.0 WHEN seen[tile + 1] = 3 THEN -80.0 WHEN seen[tile + 1] = 2 THEN -20.0 ELSE 0.0 END, 0.0::DOUBLE)
            * CASE WHEN called = 0 THEN 1.0::DOUBLE WHEN called = 1 THEN 1.1 WHEN called = 2 THEN 1.3 ELSE 1.5 END
            * CASE WHEN flag THEN 1.8::DOUBLE ELSE 1.0 END
            * CASE WHEN flag THEN 1.0::DOUBLE WHEN turn <= 4 THEN 0.03 WHEN turn <= 7 THEN 0.15 WHEN turn <= 10 THEN 0.45 WHEN turn <= 12 THEN 0.75 WHEN turn <= 15 THEN 0.9 ELSE 1.0 END END AS risk
        FROM seats
    ),
    dangers AS (SELECT key, CAST(tile AS INT) AS tile, CAST(trunc(least(greatest((max(risk) FILTER (j = 0) + max(risk) FILTER (j = 1) + max(risk) FILTER (j = 2) + max(risk) FILTER (j = 3)) / 4, 0), 3000)) AS INT) AS danger FROM risks GROUP BY key, tile),
    probs AS (SELECT key, 1 - exp(-min(danger) / 1200.0::DOUBLE) AS safe_prob, 1 - exp(-avg(danger) / 1200.0::DOUBLE) AS avg_prob, 1 - exp(-max(danger) / 1200.0::DOUBLE) AS risk_prob FROM dangers GROUP BY key)
"""


def _tiles(x: str) -> str:
    return f"array_to_string(list_transform(list_sort({x}), lambda t: {_NAMES}[t + 1]), ' ')"


_WIND = f"CASE WHEN wind BETWEEN 0 AND 3 THEN {_list(WIND_NAMES)}[wind + 1] ELSE '无效场风(' || wind || ')' END"
_ROUND = f"CASE WHEN wind BETWEEN 0 AND 3 AND dealer BETWEEN 0 AND 3 THEN {_WIND} || {_list(ROUND_NUMBERS)}[dealer + 1] || '局' ELSE '局名解析异常(风=' || ({_WIND}) || ', 庄=' || dealer || ')' END"
_STICKS = "CASE WHEN honba > 0 OR sticks > 0 THEN '，' || honba || '本场' || CASE WHEN sticks > 0 THEN '，供托' || sticks || '根' ELSE '' END ELSE '' END"
_RANK = "CAST(1 + len(list_filter(scores, lambda s: s > scores[pov + 1])) AS VARCHAR)"
_DIFF = "scores[pov + 1] - list_max(scores)"
_SEAT_SCORES = "'你有 ' || scores[pov + 1] || '分, 下家: ' || scores[(pov + 1) % 4 + 1] || '分, 对家: ' || scores[(pov + 2) % 4 + 1] || '分, 上家: ' || scores[(pov + 3) % 4 + 1] || '分'"


def _seat_tiles(groups: str, word: str) -> str:
    return " || ', ' || ".join(f"'{name}{word}：' || CASE WHEN len({groups}[(pov + {i}) % 4 + 1]) > 0 THEN {_tiles(f'{groups}[(pov + {i}) % 4 + 1]')} ELSE '无' END" for i, name in enumerate(["本家", "下家", "对家", "上家"]))


_PROMPT = f"""
    texts AS (
        SELECT key, '[情景分析]\n- 牌局: ' || {_ROUND} || '，' || CASE WHEN pov = dealer THEN '你是庄家' ELSE '你是闲家' END || ' (第' || turn || '巡，牌墙余' || wall || '张' || {_STICKS} || ')。\n'
            || '- 状态: 当前排名 ' || {_RANK} || '/4 (与一位差 ' || ({_DIFF}) || ')。\n'
            || '- 宝牌: ' || CASE WHEN len(dora) > 0 THEN {_tiles("dora")} ELSE '无' END || '\n'
            || '- 各玩家分数: ' || {_SEAT_SCORES} || '。\n- 你的手牌: ' || {_tiles("hand_tiles")}
            || '\n- 牌效: ' || shanten || ' 向听，进张 ' || ukeire || ' 张。\n- 防御：\n  最安全牌放铳率：' || printf('%.1f%%', safe_prob * 100)
            || '\n  平均放铳率：' || printf('%.1f%%', avg_prob * 100) || '\n  最危险牌放铳率：' || printf('%.1f%%', risk_prob * 100)
            || '\n场上已见牌信息\n各玩家副露信息:' || {_seat_tiles("meld_tiles", "副露")} || '\n各玩家牌河信息:' || {_seat_tiles("discard_tiles", "")}
            || '\n\n[任务]\n根据当前情景，选择一张最应该打出的手牌。\n' || {_NAMES}[label + 1] AS text
        FROM f1 JOIN found USING (key) JOIN probs USING (key) WHERE label BETWEEN 0 AND 33
    )
"""
_TEXT_OF_BOARDS = f"WITH RECURSIVE {_BOARDS}, {_SEEN}, {_SHANTEN}, {_DANGER}, {_PROMPT} SELECT key, text FROM texts"

_BUCKET = "CASE WHEN {t} <= 3 THEN 'early' WHEN {t} <= 6 THEN 'mid_pre' WHEN {t} <= 12 THEN 'mid_mid' WHEN {t} IS NOT NULL THEN 'late' END"
_CATEGORY = "CASE WHEN {t} BETWEEN 1 AND 6 THEN 'early' WHEN {t} BETWEEN 7 AND 12 THEN 'mid' WHEN {t} >= 13 THEN 'late' ELSE 'unknown' END"

_PROMPTS = """
    prompts AS (
        SELECT o_orderkey AS key, '[情景分析]\n- 牌局' || CASE o_orderkey % 4 WHEN 0 THEN '(第' || (o_orderkey % 19) || '巡，牌墙余9张)' WHEN 1 THEN '第' || (o_orderkey % 19) || '巡' WHEN 2 THEN 'x(第' || (o_orderkey % 19) || '巡)' ELSE '没有' END
            || '\n[任务]\n选择一张。' || CASE o_orderkey % 5 WHEN 0 THEN '\n 6筒 \n' WHEN 1 THEN '\n[答]' WHEN 2 THEN '\n\n东\n西' WHEN 3 THEN '' ELSE '\n[下一节]\n白' END AS text
        FROM orders
    )
"""
_RESPONSES = f"""
    r0 AS (
        SELECT o_orderkey AS key, m.m AS m, ['A', 'B', 'C'][m.m + 1] AS model, CAST(e.e AS INT) AS eval_id, {_NAMES}[o_orderkey % 34 + 1] AS gold
        FROM orders, range(3) AS m(m), range(3) AS e(e)
    ),
    responses AS (
        SELECT model, 'data/set_' || (key % 3) || '.jsonl' AS dataset_path, 'set_' || (key % 3) AS dataset, key AS sample_id, eval_id, gold,
               CASE (key * 7 + m * 3 + eval_id * (1 + key % 2)) % 6 WHEN 0 THEN gold WHEN 1 THEN '分析\n' || gold || '。因为牌效' WHEN 2 THEN '我想一下。\n答案：' || gold || '。\n完'
                    WHEN 3 THEN '**' || gold || '**' WHEN 4 THEN CASE WHEN key % 2 = 0 THEN gold || '，因为更安全' ELSE '9999' END ELSE CASE WHEN key % 3 = 0 THEN '  ' ELSE '' END END AS answer
        FROM r0
    ),
    lined AS (
        SELECT *, list_filter(list_transform(string_split(answer, '\n'), lambda x: {_strip("x")}), lambda x: x <> '') AS lines,
               CASE WHEN contains(answer, '{ANSWER_MARK}') THEN list_filter(list_transform(string_split(substr(answer, instr(answer, '{ANSWER_MARK}') + 3), '\n'), lambda x: {_strip("x")}), lambda x: x <> '') END AS after
        FROM responses
    ),
    c0 AS (SELECT *, CASE WHEN after IS NOT NULL THEN after[1] ELSE lines[-1] END AS c FROM lined),
    c1 AS (SELECT * EXCLUDE c, CASE WHEN contains(c, '.') AND NOT starts_with(c, '.') THEN {_strip("split_part(c, '.', 1)")} ELSE c END AS c FROM c0),
    c2 AS (SELECT * EXCLUDE c, CASE WHEN contains(c, '。') AND NOT starts_with(c, '。') THEN {_strip("split_part(c, '。', 1)")} ELSE c END AS c FROM c1),
    c3 AS (SELECT * EXCLUDE c, CASE WHEN contains(c, '，') AND NOT starts_with(c, '，') AND length({_strip("split_part(c, '，', 1)")}) <= 10 THEN {_strip("split_part(c, '，', 1)")} ELSE c END AS c FROM c2),
    extracted AS (SELECT model, dataset_path, dataset, sample_id, eval_id, gold, answer, CASE WHEN answer = '' THEN answer WHEN c IS NULL THEN {_strip("answer")} ELSE regexp_replace(c, '^[*_]+|[*_]+$', '', 'g') END AS extracted FROM c3),
    results AS (SELECT *, CASE WHEN answer <> '' AND gold <> '' AND extracted = gold THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM extracted)
"""
_LINES = f"lines AS (SELECT o_orderkey AS key, {_BUCKET.format(t='(o_orderkey % 17 + 1)')} AS bucket, {_CATEGORY.format(t='(o_orderkey % 17 + 1)')} AS category FROM orders)"
_WORK = """
    work AS (SELECT m.model, 'data/set_' || (o_orderkey % 3) || '.jsonl' AS dataset_path, o_orderkey AS sample_id, CAST(e.e AS INT) AS eval_id FROM orders, (VALUES ('A'), ('B'), ('C')) AS m(model), range(4) AS e(e)),
    pending AS (SELECT w.* FROM work w WHERE NOT EXISTS (SELECT 1 FROM responses r WHERE r.model = w.model AND r.dataset_path = w.dataset_path AND r.sample_id = w.sample_id AND r.eval_id = w.eval_id AND r.answer <> ''))
"""
_REQUESTS = """
    q0 AS (SELECT event_id, ['A', 'B', 'C'][user_id % 3 + 1] AS model, epoch_us(ts) AS start_us, CAST(floor(coalesce(abs(value), 0) * 1000) AS BIGINT) AS millis, CAST(json_extract_string(props, '$.k') AS INT) AS prompt_tokens FROM events),
    requests AS (SELECT *, start_us + millis * 1000 AS end_us, millis / 1000 AS seconds, prompt_tokens % 7 AS completion_tokens, prompt_tokens + prompt_tokens % 7 AS total_tokens FROM q0)
"""
_B = f"WITH {_BOARDS}, {_SEEN}"
_R = f"WITH {_RESPONSES}"
_SAMPLE = "model, dataset, sample_id"

ORACLE_SQL: dict[str, str] = {
    "q_tile_expand": f"{_B} SELECT key, {_tiles('hand_tiles')} AS hand FROM f1",
    "q_dora": f"{_B} SELECT key, array_to_string(dora, ' ') AS dora, CAST(len(dora) AS INT) AS n_dora FROM f1",
    "q_turn_bucket": f"{_B} SELECT key, turn, {_BUCKET.format(t='turn')} AS bucket, {_CATEGORY.format(t='turn')} AS category FROM f1",
    "q_remaining": f"{_B} SELECT key, array_to_string(remaining, ' ') AS remaining FROM f1",
    "q_shanten_special": f"""{_B} SELECT key, CAST(6 - len(list_filter(hand, lambda c: c >= 2)) + greatest(0, 7 - len(list_filter(hand, lambda c: c >= 1))) AS INT) AS pairs,
        CAST(13 - len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: hand[i] > 0)) - CASE WHEN len(list_filter([1, 9, 10, 18, 19, 27, 28, 29, 30, 31, 32, 33, 34], lambda i: hand[i] > 1)) > 0 THEN 1 ELSE 0 END AS INT) AS orphans FROM f1""",
    "q_shanten": f"WITH RECURSIVE {_BOARDS}, {_SEEN}, {_SHANTEN} SELECT * FROM found",
    "q_shanten_textbook": f"WITH RECURSIVE {_BOARDS}, {_SEEN}, {_TEXTBOOK}",
    "q_tile_danger": f"{_B}, {_DANGER} SELECT key, tile, danger FROM dangers",
    "q_danger_prob": f"{_B}, {_DANGER} SELECT key, round(safe_prob, 9) AS safe_prob, round(avg_prob, 9) AS avg_prob, round(risk_prob, 9) AS risk_prob FROM probs",
    "q_prompt": _TEXT_OF_BOARDS,
    "q_positional_round_trip": f"SELECT * FROM ({_TEXT_OF_BOARDS}) WHERE key <> 0",
    "q_rank_seats": f"WITH {_BOARDS} SELECT key, {_RANK} AS rank, {_DIFF} AS diff, {_SEAT_SCORES} AS seats, {_ROUND} AS round, {_STICKS} AS sticks FROM boards",
    "q_turn_extract": f"""WITH {_PROMPTS}, t AS (
        SELECT key, TRY_CAST(nullif(regexp_extract(text, '\\(第([0-9]+)巡', 1), '') AS INT) AS turn_line, TRY_CAST(nullif(regexp_extract(text, '第([0-9]+)巡', 1), '') AS INT) AS turn_text FROM prompts)
        SELECT *, {_BUCKET.format(t='turn_line')} AS bucket, {_CATEGORY.format(t='turn_text')} AS category FROM t""",
    "q_gold_answer": f"WITH {_PROMPTS} SELECT key, coalesce(list_filter(list_transform(string_split(text, '\n'), lambda x: {_strip('x')}), lambda x: x <> '' AND NOT starts_with(x, '['))[-1], '') AS gold FROM prompts",
    # by line: the task section's state follows from the last line that opens a section, and from the filled lines after it
    "q_clean_prompt": f"""WITH {_PROMPTS}, l AS (
            SELECT key, unnest(string_split(text, '\n')) AS line, generate_subscripts(string_split(text, '\n'), 1) AS n FROM prompts
        ), s AS (SELECT *, sum(CASE WHEN starts_with(line, '[') THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY n) AS section FROM l
        ), t AS (SELECT *, first(line) OVER (PARTITION BY key, section ORDER BY n) AS opener,
                        sum(CASE WHEN NOT starts_with(line, '[') AND {_strip('line')} <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY key, section ORDER BY n) AS filled FROM s)
        SELECT key, string_agg(line, '\n' ORDER BY n) AS prompt FROM t
        WHERE NOT starts_with(opener, '{TASK_MARK}') OR starts_with(line, '[') OR {_strip('line')} = '' OR filled = 1 GROUP BY key""",
    "q_extract_answer": f"{_R} SELECT model, sample_id, eval_id, extracted FROM extracted",
    "q_score": f"{_R} SELECT model, sample_id, eval_id, CASE WHEN score = 1 THEN 2.0::DOUBLE ELSE (-1.0)::DOUBLE END AS score FROM results",
    "q_random_split": f"WITH {_LINES}, p AS (SELECT key, row_number() OVER (ORDER BY md5('7-' || key), key) - 1 AS position FROM lines) SELECT key, position, position // 1000 AS part FROM p",
    "q_bucket_counts": f"WITH {_LINES} SELECT bucket, count(*) AS n FROM lines GROUP BY bucket",
    "q_rebalance": f"""WITH {_LINES}, need AS (SELECT * FROM (VALUES ('early', 15), ('mid_pre', 20), ('mid_mid', 30), ('late', 35)) AS v(bucket, need)),
        files AS (SELECT min(n // need) AS files FROM (SELECT need.need, count(lines.key) AS n FROM need LEFT JOIN lines USING (bucket) GROUP BY need.bucket, need.need)),
        p AS (SELECT key, bucket, (row_number() OVER (PARTITION BY bucket ORDER BY md5('7-' || key), key) - 1) // need AS file_no FROM lines JOIN need USING (bucket))
        SELECT key, bucket, file_no, row_number() OVER (PARTITION BY file_no ORDER BY md5('7-file-' || key), key) AS place FROM p, files WHERE file_no < files""",
    "q_stratified_sample": f"""WITH {_LINES}, p AS (SELECT key, category, row_number() OVER (PARTITION BY category ORDER BY md5('7-' || key), key) AS n FROM lines)
        SELECT key, category FROM p WHERE n <= CASE category WHEN 'early' THEN 165 WHEN 'mid' THEN 165 WHEN 'late' THEN 170 ELSE 0 END""",
    "q_pending": f"{_R}, {_WORK} SELECT * FROM pending",
    "q_pending_counts": f"{_R}, {_WORK} SELECT model, count(*) AS pending, count(DISTINCT sample_id) AS samples FROM pending GROUP BY model",
    "q_budget_global": f"{_R}, {_WORK} SELECT * FROM pending ORDER BY model, dataset_path, sample_id, eval_id LIMIT 1000",
    "q_budget_model": f"{_R}, {_WORK}, p AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY dataset_path, sample_id, eval_id) AS n FROM pending) SELECT model, dataset_path, sample_id, eval_id FROM p WHERE model = 'C' OR model = 'A' AND n <= 500",
    "q_unfinished": f"""{_R}, {_WORK} SELECT model, dataset_path, sample_id, eval_id, CASE WHEN bool_or(reason = 'empty_result') THEN 'empty_result' ELSE 'not_completed' END AS reason FROM (
        SELECT *, 'not_completed' AS reason FROM pending UNION ALL SELECT model, dataset_path, sample_id, eval_id, 'empty_result' FROM results WHERE {_strip('extracted')} = '') GROUP BY ALL""",
    "q_filter_empty": f"""{_R} SELECT model, dataset_path, sample_id, string_agg(extracted, '|' ORDER BY eval_id) AS extracted, sum(score ORDER BY eval_id) AS final_score FROM results
        GROUP BY model, dataset_path, sample_id HAVING bool_or({_strip('extracted')} <> '')""",
    "q_fill_paths": f"""{_R} SELECT sample_id, dataset || '.jsonl' AS dataset, CASE WHEN sample_id % 2 = 0 THEN dataset_path WHEN dataset = 'set_0' THEN 'old\\set_0.jsonl' ELSE dataset_path END AS dataset_path
        FROM responses WHERE model = 'A' AND eval_id = 0 AND (sample_id % 2 = 0 OR dataset IN ('set_0', 'set_1'))""",
    "q_config": f"""{_R} SELECT model, count(*) AS requests, CASE model WHEN 'A' THEN 0.1::DOUBLE ELSE 0.7::DOUBLE END AS temperature, CAST(CASE model WHEN 'A' THEN 20 WHEN 'B' THEN 5 ELSE 10 END AS INT) AS per_minute
        FROM responses GROUP BY model""",
    "q_sample_score": f"{_R} SELECT {_SAMPLE}, sum(score) AS final_score, avg(score) AS mean_score FROM results GROUP BY ALL",
    "q_model_score": f"{_R} SELECT model, sum(score) AS score FROM results GROUP BY model",
    "q_accuracy": f"""{_R}, s AS (SELECT {_SAMPLE}, bool_and(score = 1) AS r, bool_and(score = 0) AS w FROM results GROUP BY ALL)
        SELECT model, count(*) AS sample_count, count(*) FILTER (r) AS full_correct_count, count(*) FILTER (w AND NOT r) AS full_wrong_count, count(*) FILTER (r) / count(*) AS full_correct_rate, count(*) FILTER (w AND NOT r) / count(*) AS full_wrong_rate FROM s GROUP BY model""",
    "q_perfect_zero": f"""{_R}, s AS (SELECT {_SAMPLE}, bool_and(score = 1) AS r, bool_and(score = 0) AS w FROM results GROUP BY ALL)
        SELECT model, count(*) AS total_samples, count(*) FILTER (r) AS perfect_samples, count(*) FILTER (w) AS zero_samples, count(*) FILTER (r) * 100.0::DOUBLE / count(*) AS perfect_rate, count(*) FILTER (w) * 100.0::DOUBLE / count(*) AS zero_rate FROM s GROUP BY model""",
    "q_classify": f"{_R} SELECT {_SAMPLE}, count(score) AS test_count, CASE WHEN bool_and(score = 1) THEN 'perfect' WHEN bool_and(score = 0) THEN 'zero' ELSE 'mixed' END AS class FROM results GROUP BY ALL",
    "q_completed": f"{_R} SELECT model, count(*) AS completed, count(*) FILTER ({_strip('extracted')} <> '') AS completed_non_empty FROM results GROUP BY model",
    "q_remaining_requests": f"""{_R}, {_WORK}, w AS (SELECT model, count(*) AS planned FROM work GROUP BY model), d AS (SELECT model, count(*) AS completed FROM responses GROUP BY model)
        SELECT model, planned, completed, planned - completed AS remaining, planned = completed AS is_complete FROM w JOIN d USING (model)""",
    "q_timing": f"WITH {_REQUESTS} SELECT model, count(*) AS requests, round(sum(seconds), 3) AS total_seconds, round(avg(seconds), 3) AS mean_seconds FROM requests GROUP BY model",
    "q_tokens": f"""WITH {_REQUESTS} SELECT model, count(*) AS requests, CAST(sum(prompt_tokens) AS BIGINT) AS sum_prompt_tokens, avg(prompt_tokens) AS mean_prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS sum_completion_tokens,
        avg(completion_tokens) AS mean_completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS sum_total_tokens, avg(total_tokens) AS mean_total_tokens FROM requests WHERE prompt_tokens IS NOT NULL GROUP BY model""",
    "q_request_span": f"WITH {_REQUESTS} SELECT coalesce(model, 'all') AS model, min(start_us) AS first_us, max(end_us) AS last_us, (max(end_us) - min(start_us)) / 1e6::DOUBLE AS duration_s FROM requests GROUP BY ROLLUP (model)",
    "q_rate_60s": f"WITH {_REQUESTS} SELECT event_id, model, count(*) OVER (PARTITION BY model ORDER BY start_us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW) AS in_window FROM requests",
    # straight from the definition: each request follows the one `per` places before it
    "q_rate_limited": f"""WITH RECURSIVE {_REQUESTS}, n AS (SELECT event_id, model, start_us // 86400000000 * 86400000000 AS arrival, CASE model WHEN 'A' THEN 5 WHEN 'B' THEN 11 END AS per,
            row_number() OVER (PARTITION BY model ORDER BY start_us // 86400000000, event_id) - 1 AS number FROM requests),
        s(event_id, model, number, per, arrival, submit) AS (
            SELECT event_id, model, number, per, arrival, arrival FROM n WHERE per IS NULL OR number < per
            UNION ALL SELECT n.event_id, n.model, n.number, n.per, n.arrival, greatest(n.arrival, s.submit + 3600000000) FROM s JOIN n ON n.model = s.model AND n.number = s.number + s.per)
        SELECT event_id, model, number, submit AS submit_us, submit - arrival AS wait_us FROM s""",
    "q_in_flight": f"""WITH {_REQUESTS}, e AS (SELECT model, start_us AS moment, 1 AS step FROM requests UNION ALL SELECT model, end_us, -1 FROM requests),
        r AS (SELECT model, sum(step) OVER (PARTITION BY model ORDER BY moment, step ROWS UNBOUNDED PRECEDING) AS running FROM e) SELECT model, CAST(max(running) AS BIGINT) AS most_in_flight FROM r GROUP BY model""",
    "q_running_score": f"""{_R}, s AS (SELECT {_SAMPLE}, sum(score) AS final_score FROM results GROUP BY ALL)
        SELECT {_SAMPLE}, final_score, sum(final_score) OVER (PARTITION BY model ORDER BY dataset, sample_id ROWS UNBOUNDED PRECEDING) AS running_score FROM s""",
    "q_merge_scores": f"{_R} SELECT model, sum(score) AS score FROM results WHERE eval_id = 0 OR model <> 'C' GROUP BY model",
    "q_merge_dedupe": f"{_R} SELECT model, count(*) AS n, sum(score) AS score FROM results GROUP BY model",
    "q_cumulative": f"{_R} SELECT model, CAST(count(*) * CASE WHEN model = 'C' THEN 2 ELSE 1 END AS BIGINT) AS completed FROM responses GROUP BY model",
}

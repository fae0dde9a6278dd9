"""DuckDB SQL for the queries over files: what must come back, without any file."""

from __future__ import annotations

from .oracle import _TEXT_OF_BOARDS, _B, _BUCKET, _CATEGORY, _LINES, _NAMES, _PROMPTS, _R, _REQUESTS, _RESPONSES, _WORK, ORACLE_SQL, _strip

_RAW = "SELECT key, text, CASE key % 13 WHEN 3 THEN '' WHEN 4 THEN '  ' WHEN 5 THEN '{bad' WHEN 6 THEN '{\"other\": 1}' ELSE '{\"text\":' || CAST(to_json(text) AS VARCHAR) || '}' END AS line FROM prompts"
_SETS = "SELECT 'data/set_' || (o_orderkey % 3) || '.jsonl' AS dataset_path, o_orderkey AS sample_id FROM orders"
_FILLED = f"{_strip('extracted')} <> ''"
_TASKS = """tasks AS (SELECT c_name AS task_name, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 5 * 10 END AS total_requests, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 11 * 5 END AS completed_requests,
    CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS is_completed FROM customer)"""
_SPAN = "SELECT model, min(start_us) AS a, max(end_us) AS b, (max(end_us) - min(start_us)) / 1e6::DOUBLE AS s FROM requests GROUP BY ROLLUP (model)"
_MOMENT = "strftime(make_timestamp({x}), '%Y-%m-%d %H:%M:%S') || printf('.%03d', {x} // 1000 % 1000)"


def _span(pad: str) -> str:
    return f"[printf('{pad}总耗时: %.0f毫秒 (%.3f秒)', s * 1000, s), '{pad}开始时间: ' || {_MOMENT.format(x='a')}, '{pad}结束时间: ' || {_MOMENT.format(x='b')}]"


_REPORT = f"""WITH {_RESPONSES}, {_REQUESTS}, span AS ({_SPAN}),
    score AS (SELECT model, sum(score) AS score FROM results GROUP BY model),
    time AS (SELECT model, count(*) AS n, sum(seconds) AS total, avg(seconds) AS mean FROM requests GROUP BY model),
    token AS (SELECT model, count(*) AS n, avg(prompt_tokens) AS a, avg(completion_tokens) AS b, avg(total_tokens) AS c, sum(prompt_tokens)::DOUBLE AS d, sum(completion_tokens)::DOUBLE AS e, sum(total_tokens)::DOUBLE AS f FROM requests WHERE prompt_tokens IS NOT NULL GROUP BY model),
    each AS (SELECT model, bool_and(score = 1) AS r, bool_and(score = 0) AS w FROM results GROUP BY model, dataset, sample_id),
    rate AS (SELECT model, count(*) FILTER (r) * 100.0::DOUBLE / count(*) AS r, count(*) FILTER (w AND NOT r) * 100.0::DOUBLE / count(*) AS w FROM each GROUP BY model),
    parts AS (
        SELECT 1 AS part, '' AS model, ['模型评测分数', '==============================', '', '模型分数:'] AS lines
        UNION ALL SELECT 2, model, [' ' || model || ': ' || CAST(score AS VARCHAR)] FROM score
        UNION ALL SELECT 3, '', ['', '模型请求时间统计:']
        UNION ALL SELECT 4, model, [printf('  %s: 总耗时 %.2f秒, 平均耗时 %.2f秒, 请求次数 %d', model, total, mean, n)] FROM time
        UNION ALL SELECT 5, '', ['', 'Token消耗统计:']
        UNION ALL SELECT 6, model, ['  ' || model || ':', printf('    平均输入Tokens: %.0f', a), printf('    平均输出Tokens: %.0f', b), printf('    平均总Tokens: %.0f', c), printf('    总输入Tokens: %.0f', d), printf('    总输出Tokens: %.0f', e), printf('    总Tokens: %.0f', f), printf('    请求次数: %d', n)] FROM token
        UNION ALL SELECT 7, '', list_concat(['', '整体请求时间统计:'], {_span('  ')}) FROM span WHERE model IS NULL
        UNION ALL SELECT 8, '', ['', '巡目比例配置:', '  早巡比例: 0.60', '  中巡比例: 0.30', '  晚巡比例: 0.10']
        UNION ALL SELECT 9, '', ['', '样本准确率统计:', '  说明: 样本全对率=同一条测试数据每次都回答正确的比例', '        样本0分率=同一条测试数据每次都回答错误的比例']
        UNION ALL SELECT 10, model, ['  ' || model || ':', printf('    样本全对率: %.1f%%', r), printf('    样本0分率: %.1f%%', w)] FROM rate
        UNION ALL SELECT 11, '', ['', '各模型请求时间统计:']
        UNION ALL SELECT 12, model, list_concat(['  ' || model || ':'], {_span('    ')}) FROM span WHERE model IS NOT NULL
    ), l AS (SELECT part, model, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM parts)
    SELECT row_number() OVER (ORDER BY part, model, n) AS place, line FROM l"""

ORACLE_SQL |= {
    "q_jsonl_raw": f"WITH {_PROMPTS}, raw AS ({_RAW}) SELECT line, count(*) AS n, count(*) FILTER (trim(line) = '') AS blank FROM raw GROUP BY line",
    "q_jsonl_parsed": f"WITH {_PROMPTS} SELECT CASE WHEN key % 13 = 6 THEN '' ELSE text END AS text, count(*) AS n FROM prompts WHERE key % 13 NOT IN (3, 4, 5) GROUP BY ALL",
    "q_jsonl_sink": f"WITH {_PROMPTS} SELECT text, count(*) AS n FROM prompts GROUP BY text",
    "q_output_name": "SELECT o_orderkey AS key, 'y' || (o_orderkey % 3) || '-' || ['a', 'a.b', 'c', 'noext', '.hidden'][o_orderkey % 5 + 1] || '.jsonl' AS name FROM orders",
    "q_part_files": f"WITH {_LINES}, p AS (SELECT key, row_number() OVER (ORDER BY md5('7-' || key), key) - 1 AS n FROM lines) SELECT printf('train_%05d.jsonl', n // 1000) AS file_name, CAST(n % 1000 + 1 AS INT) AS place, key FROM p",
    "q_bucket_files": f"WITH {_LINES} SELECT bucket || '.jsonl' AS file_name, key FROM lines",
    "q_balanced_files": f"SELECT printf('train_balanced_%05d.jsonl', file_no) AS file_name, CAST(place AS INT) AS place, key FROM ({ORACLE_SQL['q_rebalance']})",
    "q_rebalance_unknown": f"""WITH {_PROMPTS}, t AS (
            SELECT key, TRY_CAST(nullif(regexp_extract(text, '\\(第([0-9]+)巡', 1), '') AS INT) AS a, TRY_CAST(nullif(regexp_extract(text, '第([0-9]+)巡', 1), '') AS INT) AS b FROM prompts
        ), lines AS (SELECT key, {_BUCKET.format(t='a')} AS bucket, {_CATEGORY.format(t='b')} AS category FROM t
        ), need AS (SELECT * FROM (VALUES ('early', 3), ('mid_pre', 4), ('mid_mid', 6), ('late', 7)) AS v(bucket, need)
        ), files AS (SELECT min(n // need) AS files FROM (SELECT need.need, count(lines.key) AS n FROM need LEFT JOIN lines USING (bucket) GROUP BY need.bucket, need.need)
        ), p AS (SELECT key, (row_number() OVER (PARTITION BY bucket ORDER BY md5('7-' || key), key) - 1) // need AS file_no FROM lines JOIN need USING (bucket)
        ), c AS (SELECT key, category, row_number() OVER (PARTITION BY category ORDER BY md5('7-' || key), key) AS n FROM lines)
        SELECT key, 'file' AS taken FROM p, files WHERE file_no < files
        UNION ALL SELECT key, 'sample' FROM c WHERE n <= CASE category WHEN 'early' THEN 33 WHEN 'mid' THEN 33 WHEN 'late' THEN 34 ELSE 0 END""",
    "q_results_files": f"{_R} SELECT model, dataset, dataset_path, CAST(sample_id AS INT) AS sample_id, eval_id, answer, extracted, score FROM results",
    "q_results_large": f"{_R} SELECT model, dataset, dataset_path, CAST(sample_id AS INT) AS sample_id, eval_id, answer, extracted, score FROM results",
    "q_partial_results": f"{_R} SELECT model, count(*) AS answers, sum(score) AS score, CAST(0 AS INT) AS complete FROM results WHERE model <> 'C' GROUP BY model",
    "q_stream_once": f"""{_R} SELECT model, eval_id, count(*) AS answers, count(DISTINCT sample_id) AS samples, epoch_us(CASE eval_id WHEN 2 THEN TIMESTAMP '2024-01-01 09:00:00' ELSE TIMESTAMP '2024-01-01 10:00:00' END) AS first_us, first_us AS last_us
        FROM responses GROUP BY model, eval_id""",
    "q_schedule": f"""WITH RECURSIVE {_REQUESTS}, r AS (SELECT model || event_id % 8 AS model, event_id, start_us // 86400000000 * 86400000000 AS arrival, millis * 1000 AS busy,
            CASE WHEN event_id % 4 = 0 THEN NULL ELSE 6 END AS per, CASE model WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 8 END AS cap FROM requests),
        n AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY arrival, event_id) AS n FROM r),
        s(model, n, event_id, arrival, submit, start, finish, times, ends) AS (
            SELECT DISTINCT model, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM n
            UNION ALL
            SELECT model, n, event_id, arrival, submit, start, start + busy, (CASE WHEN len(times) >= per THEN times[2:] ELSE times END) || [submit], list_sort((CASE WHEN len(ends) >= cap THEN ends[2:] ELSE ends END) || [start + busy]) FROM (
                SELECT *, CASE WHEN len(ends) >= cap THEN greatest(submit, ends[1]) ELSE submit END AS start FROM (
                    SELECT n.model, n.n, n.event_id, n.arrival, n.busy, n.cap, n.per, s.times, s.ends, CASE WHEN len(s.times) >= n.per THEN greatest(n.arrival, s.start, s.times[1] + 600000000) ELSE greatest(n.arrival, s.start) END AS submit
                    FROM s JOIN n ON n.model = s.model AND n.n = s.n + 1)))
        SELECT model, event_id AS request_id, arrival AS arrival_us, submit AS submit_us, start AS start_us, finish AS end_us FROM s WHERE n > 0""",
    "q_stream_rate": f"""WITH {_REQUESTS}, w AS (SELECT model, start_us // 10000000 * 10000000 - 10000000 * k AS from_us FROM requests, range(6) AS r(k)) SELECT from_us, model, count(*) AS requests FROM w GROUP BY ALL""",
    "q_results_listed": f"{_R} SELECT model, CAST(sample_id AS INT) AS sample_id, eval_id, answer, score FROM results",
    "q_checkpoint_resume": f"""{_R}, {_WORK} SELECT w.model, w.dataset_path, CAST(w.sample_id AS INT) AS sample_id, w.eval_id FROM work w
        WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.model = w.model AND r.sample_id = w.sample_id AND r.eval_id = w.eval_id AND r.eval_id <= 1 AND {_FILLED})""",
    "q_checkpoint_latest": f"""{_R} SELECT 'task' AS task_name, 'temp_progress_20240101_000500' AS file, count(*) AS completed_requests, (SELECT count(*) * 12 FROM orders) AS total_tasks, count(*) FILTER (model = 'B') AS of_b, false AS is_complete
        FROM results WHERE eval_id <= 1""",
    "q_checkpoint_scores": f"{_R} SELECT model, sum(score * CASE eval_id WHEN 0 THEN 2 ELSE 1 END) AS score FROM results WHERE eval_id <= 1 GROUP BY model",
    "q_checkpoint_unfinished": f"""{_R} SELECT model, dataset, dataset_path, CAST(sample_id AS INT) AS sample_id, eval_id, 'empty_result' AS reason, CAST(CASE eval_id WHEN 0 THEN 2 ELSE 1 END AS BIGINT) AS times
        FROM results WHERE eval_id <= 1 AND NOT {_FILLED}""",
    "q_report": _REPORT,
    "q_report_scores": f"{_R} SELECT model, sum(score) AS score FROM results GROUP BY model",
    "q_statistics_file": f"""{_R}, s AS (SELECT model, dataset, sample_id, count(score) AS test_count, bool_and(score = 1) AS r, bool_and(score = 0) AS w FROM results GROUP BY ALL)
        SELECT model, count(*) OVER (PARTITION BY model) AS total_samples, CASE WHEN r THEN 'perfect' WHEN w THEN 'zero' ELSE 'mixed' END AS class, dataset || '_' || sample_id AS sample_key, test_count FROM s""",
    "q_frozen_samples": f"""WITH {_LINES}, p AS (SELECT key, category, row_number() OVER (PARTITION BY category ORDER BY md5('7-' || key), key) AS n FROM lines)
        SELECT 'data/set_' || (key % 3) || '.jsonl' AS dataset_path, key AS sample_id FROM p WHERE key % 3 <> 2 AND n <= CASE category WHEN 'early' THEN 66 WHEN 'mid' THEN 66 WHEN 'late' THEN 68 ELSE 0 END
        UNION ALL SELECT * FROM ({_SETS}) WHERE dataset_path = 'data/set_2.jsonl'""",
    "q_restrict": f"{_R} SELECT * FROM ({_SETS}) s WHERE EXISTS (SELECT 1 FROM responses r WHERE r.model = 'A' AND r.answer <> '' AND r.sample_id = s.sample_id AND r.dataset_path = s.dataset_path)",
    "q_open_tasks": f"WITH {_TASKS} SELECT task_name, total_requests, completed_requests FROM tasks WHERE NOT coalesce(is_completed, false) AND coalesce(total_requests > coalesce(completed_requests, 0), true)",
    "q_task_state": f"""WITH {_TASKS} SELECT task_name, CASE WHEN right(task_name, 1) = '0' THEN 'task' ELSE right(task_name, 1) END AS name, task_name || '_a___b__c_d_e_f_' AS folder,
        coalesce(completed_requests, 0) >= coalesce(total_requests, 10) AS is_complete FROM tasks""",
    "q_total_requests": "SELECT count(*) * 12 AS total FROM orders",
    "q_ratios": """WITH o AS (SELECT o_orderkey AS key, o_orderkey % 5 / 4 AS a, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 3 / 4 END AS b, o_orderkey % 7 / 4 - 0.25 AS c FROM orders)
        SELECT key, coalesce(a <= 1 AND b <= 1 AND c >= 0 AND c <= 1 AND a + b + c = 1, false) AS valid FROM o""",
    "q_mixed_answers": f"{_R} SELECT model, sample_id, eval_id, answer FROM responses",
    "q_tile_index": f"{_R} SELECT model, sample_id, eval_id, CAST(coalesce(list_position({_NAMES}, extracted), 0) - 1 AS INT) AS tile FROM results",
    "q_count_map": f"{_B}, t AS (SELECT key, unnest(hand_tiles) AS t FROM f1) SELECT key, {_NAMES}[t + 1] AS tile, CAST(count(*) AS INT) AS n FROM t GROUP BY ALL",
    "q_board_files": "SELECT 'boards_' || (o_orderkey % 3) || '.parquet' AS file_name, count(*) AS boards, CAST(sum(o_orderkey % 5) AS BIGINT) AS winds FROM orders GROUP BY ALL",
    "q_convert_folder": f"SELECT 'train-boards_' || key % 3 || '.jsonl' AS file_name, text, count(*) AS n FROM ({_TEXT_OF_BOARDS}) GROUP BY ALL",
    "q_evaluation_run": f"""{_R}, {_WORK} SELECT model, count(*) AS answers, count(DISTINCT sample_id) AS distinct, count(*) AS done, count(*) AS total, true AS stopped FROM work WHERE eval_id = 0 GROUP BY model""",
    "q_limit_per_file": "SELECT o_orderkey AS key FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) <= 100",
    "q_predict": f"""{_R}, {_WORK} SELECT model, sample_id, eval_id, CASE WHEN sample_id % 5 = 0 THEN '' ELSE model || sample_id END AS answer, CAST(CASE WHEN sample_id % 5 = 0 THEN 0 ELSE 3 + eval_id END AS INT) AS total_tokens, true AS timed FROM work""",
    "q_top_k": f"""{_R}, l AS (SELECT model, sample_id, any_value(gold) AS gold, list(extracted ORDER BY eval_id) AS found FROM results GROUP BY model, sample_id)
        SELECT model, CAST(sample_id AS INT) AS sample_id, found[1] = gold AS hit_at_1, list_contains(found[1:3], gold) AS hit_at_3 FROM l""",
}

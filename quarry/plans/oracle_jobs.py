"""DuckDB SQL for what the job queries' tables hold (``quarry.plans.jobs``)."""

from __future__ import annotations

from quarry.plans.oracle import (ANSWERS, LOOKBACK_NARROW, OUTPUT_DIR, TOPIC, _ARCHIVE_DATE, _INGEST_DATE, _article_text, _calls,
                                _clean, _lit, _missing, _path, _q)

# --- fixed values -----------------------------------------------------------
# Parameters of the jobs, written out.
LATER = "doc_id * 1000 >= (SELECT n FROM size) * 600"
NULL_STRING = "CAST(NULL AS VARCHAR)"
# ---------------------------------------------------------------------------

_ARCHIVED = f", seed AS (SELECT * FROM silver WHERE {LATER})"
#: Items that a run adds to its topic: text and answer of each, by the calls of one round.
_RUN = """
, run AS (SELECT w.*, coalesce(c.t, '') AS t, r.response, r.error, r.model_used, r.n_attempts, r.p_description, r.p_grade, r.p_details
          FROM fresh w LEFT JOIN content c ON w.url = c.url LEFT JOIN one r ON w.url = r.url AND c.t <> '')
"""
_LANDED = """
, pg AS (SELECT max(page) AS n FROM actions)
, first AS (SELECT i.* FROM items i, pg WHERE i.page * 1000 <= pg.n * 300)
, rest AS (SELECT i.* FROM items i, pg WHERE i.page * 1000 > pg.n * 300)
"""
_DAY = f"CAST({_ARCHIVE_DATE} AS DATE)"
#: After the first landing the watermark stands 90 days before its newest date.
_LATE = _LANDED + f"""
, mark AS (SELECT max({_DAY}) - INTERVAL 90 DAY AS m FROM first)
, late AS (SELECT i.* FROM items i, mark WHERE {_DAY} < m)
"""


def job_sql() -> dict[str, str]:
    q = {}
    grade = lambda c: f"coalesce(regexp_extract({c}, '\\b(Yes|No|Maybe)\\b', 1), '')"
    q["ingest_then_backfill"] = _q(_ARCHIVED + ", fresh AS (SELECT * FROM items)" + ANSWERS + _calls("one", False) + _calls("two", True) + _RUN + f"""
, filled AS (SELECT run.url, run.p_description IS NULL OR run.p_description = '' AS open, run.t, run.p_description AS d1, run.p_grade AS g1, run.p_details AS s1,
                    two.response AS r2, two.p_description AS d2, two.p_grade AS g2, two.p_details AS s2
             FROM run LEFT JOIN two ON run.url = two.url)
, done AS (SELECT *, open AND t <> '' AND r2 IS NOT NULL AS upd FROM filled)
SELECT url, relevance_topic AS topic_slug, 'seed' AS batch, relevance_topic, description, relevant_eo, full_summary, relevance FROM seed
UNION ALL
SELECT url, {_lit(TOPIC)}, 'run', CASE WHEN upd OR g1 IS NOT NULL THEN {_lit(TOPIC)} END, CASE WHEN upd THEN d2 ELSE d1 END,
       CASE WHEN upd THEN g2 ELSE g1 END, CASE WHEN upd THEN s2 ELSE s1 END, {grade("CASE WHEN upd THEN g2 ELSE g1 END")} FROM done""")
    q["ingest_update_missing"] = _q(_ARCHIVED + ", fresh AS (SELECT * FROM items WHERE url NOT IN (SELECT url FROM seed))" + ANSWERS
                                    + _calls("one", False) + _RUN + f"""
, old AS (SELECT a.*, ({_missing()}) AND coalesce(c.t, '') <> '' AND r.response IS NOT NULL AS upd, r.p_description, r.p_grade
          FROM seed a LEFT JOIN content c ON a.url = c.url LEFT JOIN one r ON a.url = r.url)
, again AS (SELECT count(*) FILTER (WHERE response IS NOT NULL AND p_description = '') AS n FROM run)
, m AS (SELECT (SELECT count(*) FROM run) AS new, (SELECT count(p_grade) FROM run) AS annotated, (SELECT count(error) FROM run) AS failed,
               (SELECT count(*) FROM old WHERE upd) + (SELECT n FROM again) AS updated)
SELECT 'seed' AS batch, count(*) AS n_rows,
       CAST(count_if(coalesce(CASE WHEN upd THEN p_description ELSE description END, '') <> '') AS BIGINT) AS n_described,
       count(CASE WHEN upd THEN p_grade ELSE relevant_eo END) AS n_graded, any_value(m.new) AS new, any_value(m.annotated) AS annotated,
       any_value(m.failed) AS failed, CAST(any_value(m.updated) AS BIGINT) AS updated FROM old, m
UNION ALL
SELECT 'run', count(*), CAST(count_if(coalesce(p_description, '') <> '') AS BIGINT), count(p_grade), any_value(m.new), any_value(m.annotated), any_value(m.failed),
       CAST(any_value(m.updated) AS BIGINT) FROM run, m""")
    q["ingest_two_topics"] = _q(f"""
SELECT t.slug AS topic_slug, t.batch, url, date, title, types FROM items, (VALUES ({_lit(TOPIC)}, 'one'), ('0075', 'two')) t(slug, batch)""")
    q["merged_batches"] = _q(ANSWERS + _calls("one", False) + f"""
, m AS (SELECT a.*, d.lang, r.p_grade, a.relevance_topic = 'src1' AND ({_missing()}) AND coalesce(c.t, '') <> '' AND r.response IS NOT NULL AS upd
        FROM actions a JOIN documents d ON a.doc_id = d.doc_id LEFT JOIN content c ON a.url = c.url LEFT JOIN one r ON a.url = r.url)
SELECT url, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, relevance_topic AS topic_slug, title, CASE WHEN doc_id % 2 = 1 THEN lang END AS lang,
       CASE WHEN upd THEN {_lit(TOPIC)} ELSE relevance_topic END AS relevance_topic, CASE WHEN upd THEN p_grade ELSE relevant_eo END AS relevant_eo FROM m""")
    q["dataset_headers"] = _q("""
SELECT url, nullif(date, '') AS date, nullif(title, '') AS title, types, nullif(description, '') AS description, relevance_topic, relevant_eo,
       nullif(full_summary, '') AS full_summary, CASE WHEN d.lang <> 'en' THEN d.lang END AS lang
FROM actions a JOIN documents d ON a.doc_id = d.doc_id""")
    q["csv_round_trip"] = _q("""
SELECT url, nullif(date, '') AS date, nullif(title, '') AS title, types, nullif(description, '') AS description, relevance_topic, relevance, date_dt,
       nullif(full_summary, '') AS full_summary FROM silver""")
    q["backfill_csv"] = _q(ANSWERS + _calls("one", False) + f"""
, m AS (SELECT a.*, r.p_description, r.p_grade, r.p_details, ({_missing()}) AND coalesce(c.t, '') <> '' AND r.response IS NOT NULL AS upd
        FROM actions a LEFT JOIN content c ON a.url = c.url LEFT JOIN one r ON a.url = r.url)
SELECT url, nullif(CASE WHEN upd THEN p_description ELSE description END, '') AS description,
       CASE WHEN upd THEN p_grade ELSE relevant_eo END AS relevant_eo, nullif(CASE WHEN upd THEN p_details ELSE full_summary END, '') AS full_summary,
       CASE WHEN upd THEN {_lit(TOPIC)} ELSE relevance_topic END AS relevance_topic, (SELECT count(*) FROM m WHERE upd) AS n_updated FROM m""")
    q["scheduled_ingest"] = _q(f"""
, stop AS (SELECT min(page * 1000 + pos) AS s FROM items
           WHERE CAST({_INGEST_DATE} AS TIMESTAMP) < TIMESTAMP '2025-12-31 12:00:00' - INTERVAL 15 DAY)
, fresh AS (SELECT items.* FROM items, stop WHERE s IS NULL OR page * 1000 + pos < s)""" + ANSWERS + _calls("one", False) + _RUN + f"""
SELECT url, date, title, {_path("date", "title")} AS text_file, CASE WHEN p_grade IS NOT NULL THEN {_lit(TOPIC)} END AS relevance_topic,
       p_grade AS relevant_eo, {_lit(TOPIC)} AS topic_slug, 'scheduled' AS batch FROM run""")
    q["page_counts"] = _q(_ARCHIVED + """
, found AS (SELECT page, count(*) AS n, count_if(url NOT IN (SELECT url FROM seed)) AS fresh FROM items GROUP BY page)
SELECT p.page, CASE WHEN p.page % 9 = 4 THEN 0 ELSE coalesce(n, 0) END AS n_found,
       CAST(CASE WHEN p.page % 9 = 4 THEN 0 ELSE coalesce(fresh, 0) END AS BIGINT) AS n_new, CASE WHEN p.page % 9 = 4 THEN 'no page' END AS error
FROM (SELECT DISTINCT page FROM actions) p LEFT JOIN found f ON p.page = f.page""")
    q["answer_outcomes"] = _q(ANSWERS + _calls("one", False) + """
SELECT c.url, CASE WHEN c.t <> '' THEN model_used END AS model_used, CASE WHEN c.t <> '' THEN error END AS error,
       CASE WHEN c.t <> '' THEN latency_ms END AS latency_ms, CASE WHEN c.t <> '' THEN n_attempts END AS n_attempts,
       CASE WHEN c.t <> '' THEN p_description END AS description, CASE WHEN c.t <> '' THEN p_grade END AS relevant_eo,
       CASE WHEN c.t <> '' THEN p_details END AS full_summary FROM content c JOIN one ON c.url = one.url""")
    q["answer_latency"] = _q(ANSWERS + _calls("one", False) + """
SELECT coalesce(model_used, '(none)') AS model_used, count(*) AS n_rows, count(error) AS n_failed, CAST(sum(n_attempts - 1) AS BIGINT) AS n_retries
FROM content c JOIN one ON c.url = one.url WHERE c.t <> '' GROUP BY 1""")
    q["retry_rounds"] = _q(ANSWERS + _calls("one", False) + _calls("two", True) + """
, r AS (SELECT one.url, one.model_used AS m1, one.n_attempts AS a1, one.error AS e1, two.model_used AS m2, two.n_attempts AS a2, two.error AS e2
        FROM content c JOIN one ON c.url = one.url JOIN two ON c.url = two.url WHERE c.t <> '')
SELECT url, m1 IS NOT NULL OR m2 IS NOT NULL AS ok,
       CAST(CASE WHEN m1 IS NOT NULL THEN a1 WHEN m2 IS NOT NULL THEN a1 + a2 ELSE a1 + 2 * a2 END AS INT) AS n_attempts,
       CASE WHEN m1 IS NOT NULL THEN 1 WHEN m2 IS NOT NULL THEN 2 ELSE 3 END AS n_rounds,
       CASE WHEN m1 IS NULL AND m2 IS NULL THEN e2 END AS error, coalesce(m1, m2) AS model_used FROM r""")
    article = _article_text()
    q["page_fallback"] = f"""
WITH art AS ({article}), p AS (SELECT *, page_id % 13 <> 5 AS fetched FROM pages),
cache AS (SELECT p.url, {_clean('d.text')} AS t FROM p JOIN documents d ON d.doc_id = p.page_id WHERE p.page_id % 2 = 0)
SELECT p.page_id, p.url, CASE WHEN coalesce(c.t, '') <> '' THEN 'cache' WHEN p.fetched AND a.text <> '' THEN 'page' END AS text_source,
       CASE WHEN coalesce(c.t, '') <> '' THEN c.t WHEN p.fetched AND a.text <> '' THEN a.text END AS text
FROM p JOIN art a ON a.page_id = p.page_id LEFT JOIN cache c ON c.url = p.url"""
    q["quarantined_pages"] = "SELECT page_id, url, 'no page' AS error FROM pages WHERE page_id % 13 = 5"
    q["saved_texts"] = f"""
SELECT concat('{OUTPUT_DIR}/', page_id, '.txt') AS text_file, CASE WHEN page_id % 13 = 5 THEN '[no content]' ELSE text END AS text
FROM ({article})"""
    q["incremental_ingest"] = _q(_ARCHIVED + _LANDED + f"""
, fresh AS (SELECT items.* FROM items WHERE url NOT IN (SELECT url FROM seed)
            AND NOT coalesce(CAST({_ARCHIVE_DATE} AS TIMESTAMP) < TIMESTAMP '2025-12-31 12:00:00' - INTERVAL {LOOKBACK_NARROW * 6} DAY, false))"""
                                 + ANSWERS + _calls("one", False) + _RUN + f"""
SELECT url, date, title, types, text_file, description, relevance_topic, relevant_eo, full_summary, 'seed' AS batch FROM seed
UNION ALL
SELECT url, date, title, types, {_path("date", "title")}, p_description, CASE WHEN p_grade IS NOT NULL THEN {_lit(TOPIC)} END, p_grade, p_details,
       CASE WHEN page * 1000 <= (SELECT n FROM pg) * 300 THEN '0' ELSE '1' END FROM run""")
    q["stream_metrics"] = _q(_LANDED + """
, ap AS (SELECT DISTINCT page FROM actions)
SELECT CAST(0 AS BIGINT) AS micro_batch, (SELECT count(*) FROM ap, pg WHERE page * 1000 <= pg.n * 300) AS n_pages, CAST(0 AS BIGINT) AS n_empty, count(*) AS n_new FROM first
UNION ALL SELECT 1, (SELECT count(*) FROM ap, pg WHERE page * 1000 > pg.n * 300), 0, count(*) FROM rest""")
    q["stream_dedup"] = _q(_ARCHIVED + _LATE + f"""
SELECT url, date, title, types, 'seed' AS origin FROM seed
UNION ALL
SELECT i.url, i.date, i.title, i.types,
       CASE WHEN i.page * 1000 > (SELECT n FROM pg) * 300 AND coalesce({_DAY} < m, false) THEN 'late' ELSE 'stream' END
FROM items i, mark WHERE i.url NOT IN (SELECT url FROM seed)""")
    q["stream_late_items"] = _q(_LATE + "SELECT page, url, date, title FROM late")
    return q

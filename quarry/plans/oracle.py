"""DuckDB SQL computing the same results as ``quarry.plans.catalog`` (test oracle).

The tables of the driver are views in DuckDB; the derived archive, known set
and content cache are the shared CTEs below (the FIXTURES.md derivation).
Every registered query has one; the article-text SQL holds for pages shaped
like the fixture's (one ``<article>`` holding paragraphs, inline tags and
headings), which is what the HTML walker is checked against.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Written out here, not taken from the code that this SQL checks.
# Python's whitespace: 0x09-0x0D, 0x1C-0x20, 0x85, 0xA0 and the Unicode spaces.
WS = (r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
PROMPT = """You are a policy analyst reviewing U.S. Presidential actions. Read the text and answer.
Relevance scope: environmental impacts. Mark 'Relevant' only if the action materially concerns environmental impacts (not just tangential mentions).

Respond in exactly three labeled lines, without numbering, like:
Summary: <one sentence>
Relevant: <Yes|No|Maybe>
Details: <3-5 sentences if Relevant is Yes or Maybe; otherwise leave blank>

Executive Action:
"""
# Tags that end an open paragraph.
CLOSERS = ("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
           "header hgroup hr main menu nav ol pre section table ul").split()
TOPIC, BASE_CSV, OUTPUT_DIR, TODAY = "environmental impacts", "archive.csv", "texts", "2025-12-31"
DATE_RANGE, RELEVANCE, TYPES, SEARCH = ("2025-06-01", "2025-08-31"), "Maybe", ("src1", "de"), "ou(ai|en)"
ALL_RANGE, ALL_RELEVANCE, ALL_TYPES, ALL_SEARCH = ("2025-03-01", "2025-11-30"), "Yes", ("src2", "fr"), "e"
LITERAL_SEARCH, LOOKBACK_WIDE, LOOKBACK_NARROW, PAGES_FROM, MAX_PAGES = "e.", 500, 60, 3, 7
# ---------------------------------------------------------------------------


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _safe(x: str, n: int) -> str:
    return f"""regexp_replace(substring({x}, 1, {n}), '[\\\\/:*?"<>|]', '_', 'g')"""


def _clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"



_INGEST_DATE = "coalesce(try_strptime(date, '%B %d, %Y'), try_strptime(date, '%d-%b-%y'))"
_ARCHIVE_DATE = ("coalesce(try_strptime(date, '%B %d, %Y'), try_strptime(date, '%Y-%m-%d'), "
                 "try_strptime(date, '%d-%b-%y'))")

BASE = f"""
adoc AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic,
         DATE '2025-12-31' - CAST(floor(d.doc_id * 400 / (SELECT max(doc_id) + 1 FROM documents)) AS INT) AS day
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
actions AS (
  SELECT doc_id,
    CAST(floor(doc_id / 10) AS INT) + 1 AS page, CAST(doc_id % 10 AS INT) AS pos,
    CASE WHEN doc_id % 97 = 96 THEN '' WHEN doc_id % 4 = 3 THEN strftime(day, '%Y-%m-%d')
         WHEN doc_id % 4 = 2 THEN strftime(day, '%d-%b-%y') ELSE strftime(day, '%B %-d, %Y') END AS date,
    trim(split_part(text, chr(10), 1)) AS title,
    concat('https://example.org/a/', doc_id) AS url,
    CASE WHEN doc_id % 11 = 10 THEN 'no types' ELSE concat(source, '; ', lang) END AS types,
    CAST(NULL AS VARCHAR) AS text_file,
    CASE WHEN quality IS NOT NULL AND doc_id % 7 <> 0 THEN split_part(text, chr(10) || chr(10), 1) END AS description,
    source AS relevance_topic,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'Yes' WHEN quality = 1 THEN 'Maybe - see details'
         WHEN quality = 0 THEN 'No.' END AS relevant_eo,
    CASE WHEN quality = 1 THEN text END AS full_summary
  FROM adoc),
silver AS (
  SELECT *, CAST({_ARCHIVE_DATE} AS DATE) AS date_dt,
         coalesce(regexp_extract(relevant_eo, '\\b(Yes|No|Maybe)\\b', 1), '') AS relevance
  FROM actions),
size AS (SELECT max(doc_id) + 1 AS n FROM documents),
known AS (SELECT url FROM actions, size WHERE doc_id * 1000 >= n * 600 OR doc_id = floor(n * 457 / 1000)),
items AS (SELECT page, pos, date, title, url, types FROM actions WHERE date <> ''),
content AS (SELECT concat('https://example.org/a/', doc_id) AS url, {_clean('text')} AS t FROM documents)
"""

ROWS = "url, date, title, types, relevance, date_dt"


def _q(body: str) -> str:
    return "WITH " + BASE + body


#: What each document's recorded answers say, and every recorded call (FIXTURES.md).
ANSWERS = f"""
, nconv AS (SELECT max(conv_id) + 1 AS n FROM conversations)
, said AS (SELECT conv_id, arg_min(text, turn) AS said FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
, danswer AS (
  SELECT d.doc_id,
    CASE WHEN l.quality IS NULL THEN s1.said
         WHEN d.doc_id % 3 = 0 THEN concat('Summary: ', d.first, chr(10), 'Relevant: ', d.grade, chr(10), 'Details: ', d.rest)
         WHEN d.doc_id % 3 = 1 THEN concat('1. Summary: ', d.first, chr(10), '2. Relevance: ', d.grade, chr(10), '3. ', d.rest)
         ELSE concat(d.first, chr(10), chr(10), '- ', lower(d.grade), chr(10), d.rest) END AS response,
    s2.said AS other
  FROM (SELECT x.doc_id, trim(split_part(text, chr(10), 1)) AS first, substr(text, length(split_part(text, chr(10), 1)) + 2) AS rest,
               CASE WHEN y.quality = 1 AND y.toxic = 0 THEN 'Yes' WHEN y.quality = 1 THEN 'Maybe, in part' ELSE 'No' END AS grade
        FROM documents x LEFT JOIN labels y ON x.doc_id = y.doc_id) d
  LEFT JOIN labels l ON d.doc_id = l.doc_id CROSS JOIN nconv
  LEFT JOIN said s1 ON s1.conv_id = d.doc_id % nconv.n LEFT JOIN said s2 ON s2.conv_id = (d.doc_id + 1) % nconv.n)
"""


def _calls(name: str, later: bool) -> str:
    """url, response, model_used, error, latency_ms, n_attempts: the outcome of a round of calls for each document."""
    f1, f2 = ("a.doc_id % 50 = 32",) * 2 if later else ("a.doc_id % 5 = 2", "a.doc_id % 25 = 7")
    return f"""
, {name}_c AS (
  SELECT concat('https://example.org/a/', a.doc_id) AS url, e1.value AS l1, e2.value AS l2, a.response, a.other,
    CASE WHEN {f1} THEN 'RateLimitError: 429' WHEN a.response IS NULL THEN 'EmptyAnswer' END AS x1,
    CASE WHEN {f2} THEN 'RateLimitError: 429' WHEN a.other IS NULL THEN 'EmptyAnswer' END AS x2
  FROM danswer a LEFT JOIN events e1 ON e1.event_id = a.doc_id LEFT JOIN events e2 ON e2.event_id = a.doc_id + 1)
, {name}_o AS (
  SELECT url, CASE WHEN x1 IS NULL THEN response WHEN x2 IS NULL THEN other END AS response,
    CASE WHEN x1 IS NULL THEN 'gpt-4o' WHEN x2 IS NULL THEN 'gpt-4o-mini' END AS model_used,
    CASE WHEN x1 IS NOT NULL THEN x2 END AS error,
    CASE WHEN x1 IS NULL THEN l1 WHEN l1 IS NULL THEN l2 ELSE l1 + coalesce(l2, 0) END AS latency_ms,
    CASE WHEN x1 IS NULL THEN 1 ELSE 2 END AS n_attempts
  FROM {name}_c)
{_parsed(f"{name}_o", "url", name)}"""


_EDGE = r"[^\pL\pM\pN\p{Pc}]"
_LABEL = rf"^{WS}*(?:\d+[.)]{WS}*|[-*]{WS}*)?(?:Summary|Relevant|Relevance|Details?):?{WS}*"
_GRADE_LINE = rf"^{WS}*(?:\d+[.)]{WS}*)?(?:[-*]{WS}*)?(?:relevant|relevance)?(?:[:\-]|{WS})*{WS}*(Yes|No|Maybe)(?:{_EDGE}|$)"


def _parsed(src: str, key: str, name: str) -> str:
    """CTE ``name``: the rows of ``src`` with description, relevant_eo and full_summary read from ``response``.

    The parsing rules in list functions: lines that are not blank; labelled
    if any begins with a label; otherwise the first line, the first bare
    grade and the lines behind it.
    """
    bare = lambda x: _strip(f"regexp_replace({x}, {_lit(_LABEL)}, '', 'i')")
    is_a = lambda x, word: f"regexp_matches({x}, {_lit(f'^{WS}*(?:{word}){WS}*:')}, 'i')"
    grade = lambda x, p, g: f"regexp_extract({x}, {_lit(p)}, {g}, 'i')"
    any_grade = f"(?:^|{_EDGE})(Yes|No|Maybe)(?:{_EDGE}|$)"
    tail = f"array_to_string(list_transform(ls[dpos + 1:], lambda x: {bare('x')}), ' ')"
    return f"""
, {name}_l AS (
  SELECT *, list_filter(list_transform(string_split(coalesce(response, ''), chr(10)), lambda x: {_strip('x')}), lambda x: x <> '') AS ls FROM {src})
, {name}_k AS (
  SELECT *, len(list_filter(ls, lambda x: {is_a('x', 'summary')} OR {is_a('x', 'relevant|relevance')} OR {is_a('x', 'details?')})) > 0 AS labelled,
    list_filter(ls, lambda x: {is_a('x', 'summary')}) AS sums,
    list_filter(list_transform(list_filter(ls, lambda x: {is_a('x', 'relevant|relevance')}), lambda x: {grade('x', any_grade, 1)}), lambda x: x <> '') AS grades,
    list_filter(range(1, len(ls) + 1), lambda i: {is_a('ls[i]', 'details?')}) AS dets,
    list_filter(range(1, len(ls) + 1), lambda i: {grade('ls[i]', _GRADE_LINE, 1)} <> '') AS bares
  FROM {name}_l)
, {name}_g AS (
  SELECT *, CASE WHEN labelled THEN dets[-1] ELSE bares[1] END AS dpos,
    coalesce(CASE WHEN labelled THEN grades[-1] ELSE {grade('ls[bares[1]]', _GRADE_LINE, 1)} END, '') AS raw
  FROM {name}_k)
, {name}_t AS (
  SELECT *, CASE WHEN raw = '' THEN 'No' ELSE concat(upper(raw[1]), lower(raw[2:])) END AS g,
    CASE WHEN labelled THEN {bare('ls[dpos]')} ELSE '' END AS head, {_strip(tail)} AS tail
  FROM {name}_g)
, {name} AS (
  SELECT * EXCLUDE (ls, sums, grades, dets, bares, dpos, raw, labelled, g, head, tail),
    CASE WHEN response IS NULL THEN NULL ELSE coalesce(CASE WHEN labelled THEN {bare('sums[-1]')} ELSE {bare('ls[1]')} END, '') END AS p_description,
    CASE WHEN response IS NULL THEN NULL ELSE g END AS p_grade,
    CASE WHEN response IS NULL THEN NULL WHEN g = 'No' OR dpos IS NULL THEN '' WHEN tail = '' THEN head WHEN head = '' THEN tail
         ELSE {_strip("concat(head, ' ', tail)")} END AS p_details
  FROM {name}_t)
"""


def _path(d: str, t: str) -> str:
    safe = _safe(f"coalesce(nullif({t}, ''), 'untitled')", 60)
    return f"concat('{OUTPUT_DIR}/', coalesce(nullif({d}, ''), '{TODAY}'), ' - ', {safe}, '.txt')"


def _stop_window(lookback: int) -> str:
    return f"""
, stop AS (SELECT min(page * 1000 + pos) AS s FROM (
    SELECT page, pos FROM items WHERE url IN (SELECT url FROM known)
    UNION ALL
    SELECT page, pos FROM items
     WHERE CAST({_INGEST_DATE} AS TIMESTAMP) < TIMESTAMP '2025-12-31 12:00:00' - INTERVAL {lookback} DAY
    UNION ALL
    SELECT p AS page, -1 AS pos FROM (SELECT page + 1 AS p FROM (SELECT DISTINCT page FROM items UNION SELECT 0))
     WHERE p NOT IN (SELECT page FROM items)))
, win AS (SELECT items.* FROM items, stop WHERE s IS NULL OR page * 1000 + pos < s)
"""


def _missing() -> str:
    return (f"NOT ({_strip('coalesce(description, ' + _lit('') + ')')} <> '' AND "
            f"{_strip('coalesce(relevant_eo, ' + _lit('') + ')')} <> '')")


def _catalogue() -> str:
    return f"""
, f AS (SELECT CASE WHEN d.lang = 'en' THEN '{BASE_CSV}' ELSE concat('archive - ', d.lang, '.csv') END
                AS file_name, CASE WHEN d.lang <> 'es' THEN {_strip('a.relevance_topic')} END AS topic, a.doc_id AS ord
         FROM actions a JOIN documents d ON a.doc_id = d.doc_id)
, pt AS (SELECT file_name, topic, count(*) AS n, min(ord) AS first FROM f
         WHERE topic IS NOT NULL AND topic <> '' GROUP BY file_name, topic)
, best AS (SELECT file_name, topic AS mode_topic FROM (
           SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY n DESC, first ASC) AS rn FROM pt)
           WHERE rn = 1)
, cat AS (SELECT x.file_name,
       coalesce(nullif(b.mode_topic, ''),
                nullif(regexp_extract(x.file_name, '(?i)^archive - (.+)\\.csv$', 1), ''),
                x.file_name) AS label,
       lower(x.file_name) = '{BASE_CSV}' AS is_base
FROM (SELECT DISTINCT file_name FROM f) x LEFT JOIN best b ON x.file_name = b.file_name)"""


def _article_text() -> str:
    """``article p`` text in SQL, for pages shaped like the fixture's (one
    ``<article>``; inside it only paragraphs, inline tags and headings)."""
    closers = "|".join(CLOSERS)
    cut = f"regexp_replace(seg, '(</p>|<({closers})[^a-z0-9]).*$', '', 's')"
    text = f"regexp_replace({cut}, '<[^>]*>', '', 'g')"
    for ent, ch in (("quot", '"'), ("lt", "<"), ("gt", ">")):
        text = f"regexp_replace({text}, '&{ent};?', {_lit(ch)}, 'g')"
    text = f"regexp_replace(replace({text}, '&#39;', {_lit(chr(39))}), '&amp;?', '&', 'g')"
    body = "regexp_extract(html, '<article[^>]*>(.*)</article>', 1, 's')"
    paras = f"list_transform((regexp_split_to_array({body}, '<p>'))[2:], lambda seg: {text})"
    return f"""
SELECT page_id, url, {_clean(f"array_to_string({paras}, ' ')")} AS text, true AS content_ok
FROM pages"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["kpis"] = _q("""
SELECT count(*) AS total_actions, CAST(count_if(relevance = 'Yes') AS BIGINT) AS n_yes,
       CAST(count_if(relevance = 'Maybe') AS BIGINT) AS n_maybe,
       CAST(count_if(relevance = 'No') AS BIGINT) AS n_no,
       max(date_dt) AS latest_date, min(date_dt) AS earliest_date FROM silver""")
    q["relevance_breakdown"] = _q("""
SELECT *, row_number() OVER (ORDER BY label) AS rank
FROM (SELECT CASE WHEN relevance = '' THEN 'Unlabeled' ELSE relevance END AS label, count(*) AS n_actions FROM silver GROUP BY 1)""")
    q["daily_counts"] = _q("""
SELECT date_dt AS day, count(*) AS n_actions FROM silver WHERE date_dt IS NOT NULL GROUP BY 1""")
    q["daily_events"] = """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1"""
    q["type_options"] = _q(f"""
SELECT t AS type, row_number() OVER (ORDER BY t) AS rank FROM (
  SELECT DISTINCT t FROM (SELECT {_strip('unnest(string_split(types, ' + _lit('; ') + '))')} AS t FROM silver) WHERE t <> '')""")
    q["filter_date"] = _q(f"""
SELECT {ROWS} FROM silver WHERE date_dt BETWEEN DATE '{DATE_RANGE[0]}' AND DATE '{DATE_RANGE[1]}'""")
    q["filter_relevance"] = _q(f"""
SELECT {ROWS} FROM silver WHERE relevance = '{RELEVANCE}'""")
    types_pred = " OR ".join(f"contains(types, {_lit(t)})" for t in TYPES)
    q["filter_types"] = _q(f"""
SELECT {ROWS} FROM silver WHERE {types_pred}""")

    def search(p):
        return " OR ".join(f"coalesce(regexp_matches(lower({c}), {_lit(p)}), false)"
                           for c in ("title", "description", "full_summary"))
    q["search_text"] = _q(f"""
SELECT {ROWS} FROM silver WHERE {search(SEARCH)}""")
    all_types = " OR ".join(f"contains(types, {_lit(t)})" for t in ALL_TYPES)
    q["filter_all"] = _q(f"""
SELECT {ROWS} FROM silver
WHERE date_dt BETWEEN DATE '{ALL_RANGE[0]}' AND DATE '{ALL_RANGE[1]}'
  AND relevance = '{ALL_RELEVANCE}' AND ({all_types}) AND ({search(ALL_SEARCH)})""")
    exact = ", ".join(_lit(t) for t in TYPES)
    q["filter_types_exact"] = _q(f"""
SELECT {ROWS} FROM silver
WHERE list_has_any(list_filter(list_transform(string_split(types, '; '), lambda x: {_strip('x')}),
                               lambda x: x <> ''),
                   [{exact}])""")
    q["search_literal"] = _q(f"""
SELECT {ROWS} FROM silver
WHERE {" OR ".join(f"coalesce(contains(lower({c}), {_lit(LITERAL_SEARCH)}), false)"
                   for c in ("title", "description", "full_summary"))}""")
    q["filter_date_compat"] = _q(f"""
SELECT {ROWS} FROM silver
WHERE date_dt >= DATE '{DATE_RANGE[0]}' AND date_dt <= DATE '{DATE_RANGE[1]}' + INTERVAL 1 DAY""")
    q["results_table"] = _q("""
SELECT coalesce(date, '') AS date, coalesce(nullif(title, ''), '(untitled)') AS title,
       coalesce(types, '') AS types, coalesce(relevance, '') AS relevance,
       coalesce(description, '') AS description, url,
       row_number() OVER (ORDER BY date_dt DESC NULLS LAST, url) AS rank FROM silver""")
    q["dashboard_table"] = _q("""
SELECT coalesce(date, '') AS date, coalesce(nullif(title, ''), '(untitled)') AS title,
       coalesce(types, '') AS types, coalesce(relevance, '') AS relevance,
       coalesce(description, '') AS description, url FROM silver
WHERE date_dt IS NOT NULL""")
    q["detail_view"] = _q("""
SELECT coalesce(date, '') AS date, coalesce(nullif(title, ''), '(untitled)') AS title,
       nullif(url, '') AS url, nullif(text_file, '') AS text_file, coalesce(types, '') AS types,
       coalesce(relevance, '') AS relevance, nullif(description, '') AS summary,
       nullif(full_summary, '') AS full_summary FROM silver""")
    q["export_rows"] = _q(f"""
SELECT date, title, url, types, text_file, description, relevance_topic, relevant_eo, full_summary, relevance
FROM silver WHERE date_dt BETWEEN DATE '{DATE_RANGE[0]}' AND DATE '{DATE_RANGE[1]}'""")
    q["missing_summaries"] = _q(f"""
SELECT url, date, title FROM silver WHERE {_missing()}""")
    q["known_state"] = _q(f"""
SELECT count(DISTINCT CASE WHEN coalesce(url, '') <> '' THEN url END) AS n_known,
       max(CAST({_INGEST_DATE} AS DATE)) AS latest_date
FROM actions WHERE url IN (SELECT url FROM known)""")
    q["new_urls"] = _q("""
SELECT page, pos, url, title, date FROM items WHERE url NOT IN (SELECT url FROM known)""")
    q["crawl_window_known"] = _q(_stop_window(LOOKBACK_WIDE) + """
SELECT page, pos, date, title, url, types FROM win""")
    q["crawl_window_lookback"] = _q(_stop_window(LOOKBACK_NARROW) + """
SELECT page, pos, date, title, url, types FROM win""")
    start = PAGES_FROM
    q["crawl_window_pages"] = _q(f"""
, its AS (SELECT * FROM items WHERE page >= {start})
, stop AS (SELECT min(p * 1000 - 1) AS s FROM (
    SELECT page + 1 AS p FROM (SELECT DISTINCT page FROM its UNION SELECT {start - 1}))
    WHERE p NOT IN (SELECT page FROM its))
SELECT page, pos, date, title, url, types FROM its, stop WHERE s IS NULL OR page * 1000 + pos < s""")
    q["crawl_window_filter"] = _q(f"""
SELECT page, pos, date, title, url, types FROM items
WHERE url NOT IN (SELECT url FROM known)
  AND NOT coalesce(CAST({_ARCHIVE_DATE} AS TIMESTAMP)
                   < TIMESTAMP '2025-12-31 12:00:00' - INTERVAL {LOOKBACK_NARROW} DAY, false)""")
    q["run_metrics"] = _q(_stop_window(LOOKBACK_WIDE) + """
SELECT (SELECT count(DISTINCT url) FROM known) AS n_known, (SELECT count(*) FROM items) AS n_listed,
       (SELECT count(DISTINCT page) FROM items) AS n_pages, (SELECT count(*) FROM win) AS n_new""")
    q["listing_items"] = _q("""
SELECT page, date, title, url, types FROM items""")
    q["article_text"] = _article_text()
    q["response_parse"] = _q(ANSWERS + f"""
, r AS (SELECT concat('doc-', doc_id) AS source, response FROM danswer
        UNION ALL SELECT concat('conv-', conv_id, '-', turn), text FROM conversations WHERE role = 'assistant')
{_parsed('r', 'source', 'p')}
SELECT source, coalesce(p_description, '') AS description, coalesce(p_grade, 'No') AS relevant_eo, coalesce(p_details, '') AS full_summary FROM p""")
    q["prompt_build"] = f"""
SELECT doc_id, concat({_lit(PROMPT)}, coalesce(text, '')) AS prompt FROM documents"""
    q["clean_text"] = f"""
SELECT doc_id, {_clean('text')} AS clean_text FROM documents"""
    q["safe_name"] = _q(f"""
SELECT url, {_safe('title', 120)} AS safe_title FROM actions""")
    q["text_path"] = _q(f"""
SELECT url, concat('{OUTPUT_DIR}/', coalesce(nullif(date, ''), '{TODAY}'), ' - ',
                   {_safe("coalesce(nullif(title, ''), 'untitled')", 60)}, '.txt') AS text_file
FROM actions""")
    q["topic_slug"] = _q(f"""
SELECT url, CASE WHEN coalesce(title, '') = '' THEN '{BASE_CSV}'
                 ELSE concat('./archive - ', {_safe(_strip('title'), 80)}, '.csv') END AS topic_csv
FROM actions""")
    q["topic_catalogue"] = _q(_catalogue() + """
SELECT *, row_number() OVER (ORDER BY is_base DESC, lower(label), file_name) AS rank FROM cat""")
    q["label_paths"] = _q(_catalogue() + """
SELECT label, file_name FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY is_base, lower(label) DESC, file_name DESC) AS k FROM cat) WHERE k = 1""")
    q["crawl_window_max_pages"] = _q(f"""
SELECT page, pos, date, title, url, types FROM items WHERE page BETWEEN {start} AND {start + MAX_PAGES - 1}""")
    q["crawl_window_gap"] = _q("""
, hole AS (SELECT floor(max(page) * 7 / 10) AS p FROM items)
SELECT page, pos, date, title, url, types FROM items, hole WHERE page < p""")
    q["first_per_title"] = _q("""
SELECT title, page, pos, url FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page, pos) AS k FROM items) WHERE k = 1""")
    q["backfill"] = _q(ANSWERS + _calls("one", False) + f"""
, m AS (SELECT a.*, r.p_description, r.p_grade, r.p_details,
               ({_missing()}) AND coalesce(c.t, '') <> '' AND r.response IS NOT NULL AS upd
        FROM actions a LEFT JOIN content c ON a.url = c.url LEFT JOIN one r ON a.url = r.url)
SELECT url,
  CASE WHEN upd THEN p_description ELSE description END AS description,
  CASE WHEN upd THEN p_grade ELSE relevant_eo END AS relevant_eo,
  CASE WHEN upd THEN p_details ELSE full_summary END AS full_summary,
  CASE WHEN upd THEN {_lit(TOPIC)} ELSE relevance_topic END AS relevance_topic,
  upd AS updated
FROM m""")
    q["ingest"] = _q(_stop_window(LOOKBACK_WIDE) + ANSWERS + _calls("one", False) + f"""
SELECT w.page, w.date, w.title, w.url, w.types, {_path("w.date", "w.title")} AS text_file,
  r.p_description AS description, CASE WHEN r.p_grade IS NOT NULL THEN {_lit(TOPIC)} END AS relevance_topic,
  r.p_grade AS relevant_eo, r.p_details AS full_summary, r.model_used, r.error, r.n_attempts
FROM win w LEFT JOIN content c ON w.url = c.url LEFT JOIN one r ON w.url = r.url AND c.t <> ''""")
    q["daily_events_stream"] = """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1"""
    from quarry.plans.oracle_jobs import job_sql

    return q | job_sql()

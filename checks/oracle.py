"""What every query must give, in DuckDB SQL written from the table definitions.

The SQL takes its own way: grids of respondents and questions instead of
subtraction, outer joins instead of stacking, arithmetic instead of JSON.
"""

from __future__ import annotations

from checks.queries import EXCLUDED, QUESTION_KINDS
from checks.views import (
    CUTOFF, DOCUMENT_QUESTIONS, EMOJI_SAMPLE, EVENT_CODES, EVENT_QUESTIONS, ONLY_CHOICES, ONLY_POST, ONLY_PRE, ORDER_QUESTIONS, PROGRAM,
)

ORACLE: dict[str, str] = {}

PCT = "round_even({n}::DOUBLE / {base} * 100 * 10, 0) / 10"


def pct(n: str, base: str) -> str:
    return f"CASE WHEN {base} > 0 THEN {PCT.format(n=n, base=base)} ELSE 0.0::DOUBLE END"


def ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def values(rows: list[tuple]) -> str:
    def literal(value):
        return str(value).upper() if isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)


def questions(name: str, surveys: str, rows: list[tuple]) -> str:
    return f"""{name} AS (SELECT s.survey_id, v.* FROM (SELECT DISTINCT survey_id FROM {surveys}) s, (VALUES {values(rows)})
        v(column_id, question_name, question_text, question_type, question_selector, is_numeric, data_type, block_name, flow_pos))"""


# -- orders as responses: r (responses), a (answers), q (questions), c (choices) --------------

R = """r AS (
    SELECT 'SV_' || o_orderstatus AS survey_id, 'R_' || o_orderkey AS response_id, o_orderkey AS k, o_custkey, o_totalprice,
        o_orderpriority, o_orderdate + to_hours(o_orderkey % 24) AS recorded_at,
        o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 90) AS end_at,
        CASE WHEN o_orderkey % 20 = 0 THEN 'preview' WHEN o_orderkey % 20 = 1 THEN NULL ELSE 'anonymous' END AS channel,
        o_orderkey % 13 != 5 AS said
    FROM orders)"""
A = """a AS (
    SELECT survey_id, response_id, 'QID1' AS column_id, 'text' AS kind, NULL::VARCHAR[] AS items, NULL::DOUBLE AS num, substr(o_orderpriority, 1, 1) AS txt
        FROM r WHERE said AND k % 10 != 3
    UNION ALL SELECT survey_id, response_id, 'QID2', 'list', [(i + 1)::VARCHAR FOR i IN range(7) IF (o_custkey & (1 << i)) != 0], NULL, NULL
        FROM r WHERE said AND k % 11 != 0
    UNION ALL SELECT survey_id, response_id, 'QID3', 'number', NULL, o_totalprice / 100000, NULL FROM r WHERE said AND k % 7 != 0
    UNION ALL SELECT survey_id, response_id, 'QID4', 'number', NULL, (k % 5)::DOUBLE, NULL FROM r WHERE said AND k % 17 != 0 AND k % 3 = 0
    UNION ALL SELECT survey_id, response_id, 'QID4', 'text', NULL, NULL, CASE WHEN k % 3 = 1 THEN (k % 5)::VARCHAR ELSE 'other' END
        FROM r WHERE said AND k % 17 != 0 AND k % 3 != 0
    UNION ALL SELECT survey_id, response_id, 'QID5_TEXT', 'text', NULL, NULL, 'comment ' || o_orderpriority FROM r WHERE said AND k % 4 = 0)"""
Q = questions("q", "r", ORDER_QUESTIONS)
C = f"""c AS (
    SELECT DISTINCT survey_id, 'QID1' AS column_id, substr(o_orderpriority, 1, 1) AS answer_id, o_orderpriority AS question_value FROM r
    UNION ALL SELECT survey_id, v.* FROM (SELECT DISTINCT survey_id FROM r), (VALUES
        {values([("QID1", "6", "Never chosen"), ("QID7", "1", "Yes")] + [("QID2", i, f"Option {i}") for i in range(1, 8)] + [("QID4", i, f"Size {i}") for i in range(4)])}
        ) v(column_id, answer_id, question_value))"""
# Usable: no preview, at least one question answered.
U = """u AS (SELECT * FROM r WHERE channel IS DISTINCT FROM 'preview'
    AND EXISTS (SELECT 1 FROM a JOIN q USING (survey_id, column_id) WHERE a.survey_id = r.survey_id AND a.response_id = r.response_id))"""
BASE = "base AS (SELECT survey_id, count(*) AS base FROM u GROUP BY survey_id)"


def coded(answers: str = "a", responses: str = "u", kinds_by: str = "survey_id, column_id", extra: str = "") -> str:
    """grid of (response, question); kinds per column; codes per grid cell."""
    return f"""ua AS (SELECT x.* {extra.replace("u.", "u.")} FROM {answers} x JOIN {responses} u USING (survey_id, response_id)),
    kinds AS (SELECT {kinds_by}, bool_and(kind = 'number') AS numeric FROM ua GROUP BY {kinds_by}),
    grid AS (SELECT u.survey_id, u.response_id, q.column_id {extra} FROM {responses} u JOIN q USING (survey_id)),
    codes AS (SELECT g.*, unnest(CASE WHEN ua.kind = 'list' THEN ua.items
            WHEN ua.kind = 'number' AND kinds.numeric THEN [trunc(ua.num)::BIGINT::VARCHAR]
            WHEN ua.kind = 'text' AND regexp_full_match(ua.txt, '\\d+') THEN [ua.txt] ELSE ['NULL'] END) AS code
        FROM grid g LEFT JOIN ua ON ua.survey_id = g.survey_id AND ua.response_id = g.response_id AND ua.column_id = g.column_id
        LEFT JOIN kinds ON {" AND ".join(f"kinds.{k.strip()} = g.{k.strip()}" for k in kinds_by.split(","))})"""


ORDERS = ctes(R, A, Q, C, U, BASE, coded(), "n AS (SELECT survey_id, column_id, code, count(*) AS n FROM codes GROUP BY ALL)")
MC = """mc AS (SELECT coalesce(c.survey_id, n.survey_id) AS survey_id, coalesce(c.column_id, n.column_id) AS column_id, coalesce(c.answer_id, n.code) AS code,
        coalesce(c.question_value, '') AS value, coalesce(n.n, 0) AS n
    FROM (SELECT c.* FROM c JOIN q USING (survey_id, column_id) WHERE data_type = 'MultipleChoice') c
    FULL JOIN (SELECT n.* FROM n JOIN q USING (survey_id, column_id) WHERE data_type = 'MultipleChoice') n
    ON n.survey_id = c.survey_id AND n.column_id = c.column_id AND n.code = c.answer_id)"""
TABLE = f"""t AS (SELECT survey_id, column_id, question_name || ': ' || question_text AS heading, question_text, data_type, block_name, flow_pos, code, value, n,
        {pct("n", "base")} AS pct
    FROM (SELECT * FROM mc UNION ALL SELECT n.survey_id, n.column_id, n.code, n.code, n.n FROM n JOIN q USING (survey_id, column_id) WHERE data_type = 'Numeric')
    JOIN q USING (survey_id, column_id) JOIN base USING (survey_id))"""
REPORT = ORDERS.rstrip() + ",\n" + MC + ",\n" + TABLE + "\n"

ORACLE["drop_preview"] = ctes(R) + "SELECT survey_id, response_id, channel FROM r WHERE channel IS DISTINCT FROM 'preview'"
ORACLE["drop_all_null"] = ctes(R, A) + "SELECT DISTINCT survey_id, response_id FROM a"
ORACLE["date_range"] = ctes(R) + """SELECT survey_id, response_id, strftime(recorded_at, '%Y-%m-%d %H:%M:%S') AS recorded FROM r
    WHERE recorded_at >= TIMESTAMP '1996-06-27' AND recorded_at <= TIMESTAMP '1998-07-08'"""
ORACLE["select_questions"] = ctes(R, A) + """SELECT survey_id, response_id, strftime(recorded_at, '%Y-%m-%d %H:%M:%S') AS recorded, column_id, txt
    FROM a JOIN r USING (survey_id, response_id) WHERE column_id IN ('QID1', 'QID5_TEXT')"""
ORACLE["survey_columns"] = ctes(R, A) + "SELECT DISTINCT survey_id, column_id FROM a"
WIDE = """w AS (SELECT survey_id, response_id, strftime(recorded_at, '%Y-%m-%dT%H:%M:%SZ') AS recorded, strftime(end_at, '%Y-%m-%dT%H:%M:%SZ') AS ended, channel,
    CASE WHEN k % 50 != 7 THEN (k % 101)::DOUBLE::VARCHAR END AS progress, max(txt) FILTER (column_id = 'QID1') AS q1,
    max('[' || coalesce(list_aggregate(list_transform(items, lambda x: '"' || x || '"'), 'string_agg', ','), '') || ']') FILTER (column_id = 'QID2') AS q2,
    max(num::VARCHAR) FILTER (column_id = 'QID3') AS q3, max(coalesce(txt, num::VARCHAR)) FILTER (column_id = 'QID4') AS q4,
    max(txt) FILTER (column_id = 'QID5_TEXT') AS q5 FROM r LEFT JOIN a USING (survey_id, response_id) GROUP BY survey_id, response_id, k, recorded_at, end_at, channel)"""
CELLS = ("recorded", "ended", "channel", "progress", "q1", "q2", "q3", "q4", "q5")
ORACLE["wide_responses"] = ctes(R, A, WIDE) + f"""SELECT survey_id, response_id, 'recordedDate,endDate,distributionChannel,progress,QID1,QID2,QID3,QID4,QID5_TEXT' AS names,
    {" || '|' || ".join(f"coalesce({c}, '-')" for c in CELLS)} AS cells FROM w"""
ORACLE["wide_frame"] = ctes(R, A, WIDE) + """SELECT survey_id, response_id, recorded AS "recordedDate", ended AS "endDate", channel AS "distributionChannel", progress,
    q1 AS "QID1", q2 AS "QID2", q3 AS "QID3", q4 AS "QID4", q5 AS "QID5_TEXT" FROM w WHERE survey_id = 'SV_F'"""
ORACLE["newest_responses"] = ctes(R, A) + """SELECT r.survey_id, r.response_id, channel, count(a.column_id)::INT AS n_answers, 2 AS version FROM r
    LEFT JOIN a ON a.survey_id = r.survey_id AND a.response_id = r.response_id GROUP BY ALL"""
ORACLE["reportable_questions"] = ctes(R, Q) + "SELECT survey_id, column_id, data_type, flow_pos FROM q WHERE data_type IN ('MultipleChoice', 'Numeric')"
ORACLE["normalise_answers"] = ORDERS + "SELECT * FROM n"
ORACLE["frequency_mc"] = REPORT + """SELECT survey_id, column_id, code, value, n, pct, pct::VARCHAR || '%' AS frequency FROM t WHERE data_type = 'MultipleChoice'"""
ORACLE["frequency_numeric"] = REPORT + """SELECT survey_id, column_id, value, n, pct, pct::VARCHAR || '%' AS frequency FROM t WHERE data_type = 'Numeric'"""
ORACLE["frequency_numeric_labelled"] = ORDERS + f"""SELECT survey_id, column_id, value, n, {pct("n", "base")} AS pct, ({pct("n", "base")})::VARCHAR || '%' AS frequency
    FROM (SELECT coalesce(l.survey_id, n.survey_id) AS survey_id, 'QID3' AS column_id, coalesce(question_value, '') AS value, coalesce(n.n, 0) AS n
        FROM (SELECT * FROM c WHERE column_id = 'QID4') l FULL JOIN (SELECT * FROM n WHERE column_id = 'QID3') n
        ON l.survey_id = n.survey_id AND l.answer_id = n.code) JOIN base USING (survey_id)"""
ORACLE["survey_frequency"] = REPORT + "SELECT *, pct::VARCHAR || '%' AS frequency FROM t"
ORACLE["write_tables"] = REPORT + """SELECT survey_id, column_id, heading, flow_pos, code, value, n, pct, pct::VARCHAR || '%' AS frequency FROM t"""
ORACLE["regional_nonzero"] = REPORT + f"SELECT survey_id, column_id, code, n FROM t WHERE n != 0 OR question_text != '{PROGRAM}'"
ORACLE["chart_series"] = REPORT + """SELECT survey_id, column_id, code, pct, code = 'NULL' AS is_null_bar FROM
    (SELECT *, count(*) OVER (PARTITION BY survey_id, column_id) AS bars FROM t) WHERE bars < 10"""
ORACLE["label_join"] = ORDERS.replace("ELSE ['NULL'] END) AS code", "ELSE ['NULL'] END) AS code, ua.kind IS NULL AS skipped") \
    .replace("count(*) AS n FROM codes GROUP BY ALL", "count(*) AS n FROM codes WHERE NOT skipped GROUP BY ALL") + """
    SELECT coalesce(l.survey_id, n.survey_id) AS survey_id, coalesce(l.column_id, n.column_id) AS column_id, coalesce(l.answer_id, n.code) AS code,
        coalesce(question_value, '') AS value, coalesce(n.n, 0) AS n
    FROM c l FULL JOIN n ON l.survey_id = n.survey_id AND l.column_id = n.column_id AND l.answer_id = n.code"""
ORACLE["survey_header"] = ctes(R, A, Q, U) + """SELECT survey_id, n_responses, first_response, last_response, duration_days, n_questions, question_types FROM
    (SELECT survey_id, count(*) AS n_responses, strftime(min(end_at), '%Y-%m-%d') AS first_response, strftime(max(end_at), '%Y-%m-%d') AS last_response,
        datesub('day', min(end_at), max(end_at)) AS duration_days FROM u GROUP BY survey_id)
    JOIN (SELECT survey_id, sum(n)::BIGINT AS n_questions, string_agg(question_type, ', ' ORDER BY first) AS question_types FROM
        (SELECT survey_id, question_type, count(*) AS n, min(flow_pos) AS first FROM q GROUP BY ALL) GROUP BY survey_id) USING (survey_id)"""
MISSING = """SELECT survey_id, column_id, count(*) FILTER (NOT present) AS missing_n, count(*) FILTER (present) AS present_n,
    count(*) FILTER (NOT present)::DOUBLE / count(*) AS missing_frc, 1 - count(*) FILTER (NOT present)::DOUBLE / count(*) AS present_frc
    FROM (SELECT q.survey_id, q.column_id, q.data_type, a.response_id IS NOT NULL AS present FROM u JOIN q USING (survey_id)
        LEFT JOIN a ON a.survey_id = u.survey_id AND a.response_id = u.response_id AND a.column_id = q.column_id) """
ORACLE["missing_stats"] = ctes(R, A, Q, U) + MISSING + "GROUP BY survey_id, column_id"
ORACLE["pct_text"] = f"""SELECT o_orderstatus, o_orderpriority, {pct("n", "base")} AS pct, ({pct("n", "base")})::VARCHAR || '%' AS frequency FROM
    (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) JOIN (SELECT o_orderstatus, count(*) AS base FROM orders GROUP BY ALL) USING (o_orderstatus)"""

# -- export documents ----------------------------------------------------------------------

X = """x AS (SELECT 'SV_' || o_orderstatus AS survey_id, 'R_' || o_orderkey || '_' || i AS response_id, i, o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
        o_orderdate + to_hours(o_orderkey % 24) AS stamp, [(b + 1)::VARCHAR FOR b IN range(3) IF (o_custkey & (1 << b)) != 0] AS picked
    FROM orders, unnest(range(o_orderkey % 3)) t(i))"""
ORACLE["read_responses"] = ctes(X) + """SELECT survey_id, response_id, CASE WHEN k % 97 != 0 THEN strftime(stamp, '%Y-%m-%d %H:%M:%S') END AS recorded,
    CASE WHEN k % 20 = 0 THEN 'preview' WHEN k % 20 != 1 THEN 'anonymous' END AS channel, (k % 101)::DOUBLE AS progress,
    2 + CASE WHEN k % 7 != 0 THEN 1 ELSE 0 END AS n_answers, substr(o_orderpriority, 1, 1) AS q1, coalesce(list_aggregate(picked, 'string_agg', ','), '') AS q2,
    CASE WHEN k % 7 != 0 THEN (o_custkey + i)::DOUBLE END AS q3, o_orderstatus AS status FROM x"""
ORACLE["read_response_lines"] = ORACLE["read_response_column"] = ORACLE["read_responses"]
ORACLE["export_account"] = """SELECT 'SV_' || o_orderstatus AS survey_id, sum(good + bad)::BIGINT AS landed, sum(good)::BIGINT AS parsed, sum(bad)::BIGINT AS rejected FROM
    (SELECT o_orderstatus, o_orderkey % 3 AS good, CASE WHEN o_orderkey % 10 IN (2, 3) THEN 1 ELSE 0 END AS bad FROM orders) GROUP BY o_orderstatus"""
ORACLE["flatten_values"] = ctes(X) + """SELECT survey_id, response_id, name, value FROM (
    SELECT survey_id, response_id, unnest(['recordedDate', 'distributionChannel', 'progress', 'location.customer', 'location.state.status', 'QID1', 'QID2', 'QID3']) AS name,
        unnest([CASE WHEN k % 97 = 0 THEN 'not a date' ELSE strftime(stamp, '%Y-%m-%dT%H:%M:%SZ') END,
            CASE WHEN k % 20 = 0 THEN 'preview' WHEN k % 20 != 1 THEN 'anonymous' END, (k % 101)::VARCHAR, o_custkey::VARCHAR, o_orderstatus,
            substr(o_orderpriority, 1, 1), '[' || coalesce(list_aggregate(list_transform(picked, lambda p: '"' || p || '"'), 'string_agg', ','), '') || ']',
            CASE WHEN k % 7 != 0 THEN (o_custkey + i)::VARCHAR END]) AS value FROM x) WHERE value IS NOT NULL"""
ORACLE["parse_recorded_date"] = ctes(X) + """SELECT survey_id, response_id, CASE WHEN k % 97 != 0 THEN strftime(stamp, '%Y-%m-%d %H:%M:%S') END AS recorded FROM x"""

# -- listings -------------------------------------------------------------------------------

S = """s AS (SELECT 'SV_' || s_suppkey || '_' || i AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'Yearly survey' ELSE s_name || ' ' || i END AS name,
    'UR_' || s_nationkey AS owner_id, s_acctbal > 0 AS is_active FROM supplier, (VALUES (1), (2)) v(i))"""
ORACLE["union_pages"] = ctes(S) + "SELECT * FROM s"
ORACLE["page_chain"] = "SELECT s_suppkey::VARCHAR AS page_offset, row_number() OVER (ORDER BY s_suppkey) - 1 AS position FROM supplier"
ORACLE["page_gaps"] = """WITH p AS (SELECT * FROM supplier WHERE s_suppkey % 41 != 0 OR s_suppkey = 0), l AS (SELECT max(s_suppkey) AS last, min(s_suppkey) AS first FROM supplier)
    SELECT (s_suppkey + 1)::VARCHAR AS page_offset, 'not landed' AS problem FROM p, l WHERE s_suppkey < last AND s_suppkey + 1 NOT IN (SELECT s_suppkey FROM p)
    UNION ALL SELECT s_suppkey::VARCHAR, 'no landed page leads to it' FROM p, l WHERE s_suppkey != first AND s_suppkey - 1 NOT IN (SELECT s_suppkey FROM p)"""
ORACLE["survey_id_by_name"] = ctes(S, """w AS (SELECT DISTINCT unnest([s_name || ' 1', s_name || ' 3', 'Yearly survey']) AS name FROM supplier)""") + """
    SELECT w.name, CASE WHEN count(s.id) = 1 THEN min(s.id) END AS survey_id,
        CASE count(s.id) WHEN 1 THEN 'ok' WHEN 0 THEN 'missing' ELSE 'ambiguous' END AS status FROM w LEFT JOIN s USING (name) GROUP BY w.name"""
ORACLE["list_elements"] = """SELECT 'CID_' || c_custkey AS contact_id, c_name AS first_name, c_mktsegment AS last_name, lower(c_name) || '@example.com' AS email,
    c_custkey % 4 = 0 AS unsubscribed, c_nationkey::VARCHAR AS nation FROM customer"""

# -- parts as questions: p (questions), col (columns), cho (choices of a question), d (dictionary) ------

KINDS = "['MC', 'MC', 'TE', 'TE', 'Matrix', 'CS', 'RO', 'Slider', 'Timing', 'SS', 'PGR', 'FileUpload', 'Meta', 'Draw', 'SBS', 'Matrix']"
SELECTORS = ("['SAVR', 'MAVR', 'ML', 'SL', 'Likert', 'HR', 'DND', 'STAR', 'PageTimer', 'TA', 'DragAndDrop', 'FileUpload', 'Browser', "
             "'Signature', 'SBSMatrix', 'Bipolar']")
P = f"""p AS (SELECT *, p_partkey AS k, p_partkey // 20 AS survey_no, 'SP_' || (p_partkey // 20) AS survey_id, p_partkey % 20 AS number, 'QID' || (p_partkey % 20 + 1) AS base_qid,
    ({KINDS})[p_partkey % 16 + 1] AS kind, ({SELECTORS})[p_partkey % 16 + 1] AS selector, p_size % 4 + 2 AS n_choices, 'How about ' || p_name || '?' AS main FROM part)"""
COL = """col AS (SELECT p.*, v.loop_no, v.sub_key, v.suffix, CASE WHEN v.loop_no > 0 THEN v.loop_no || '_' ELSE '' END || base_qid || v.tail AS column_id FROM p, LATERAL (
    SELECT 0 AS loop_no, '' AS sub_key, '' AS suffix, '' AS tail WHERE kind IN ('MC', 'SS', 'FileUpload', 'Meta', 'Draw')
    UNION ALL SELECT 0, 'TEXT', 'TEXT', '_TEXT' WHERE kind = 'TE' OR kind = 'RO' OR (kind = 'MC' AND k % 3 = 1)
    UNION ALL SELECT 2, '', '', '' WHERE kind = 'MC' AND k % 8 = 0
    UNION ALL SELECT 0, i::VARCHAR, '', '_' || i FROM range(1, 6) t(i) WHERE (kind IN ('Matrix', 'CS', 'Slider') AND i <= 2) OR (kind = 'RO' AND i <= n_choices)
    UNION ALL SELECT 0, '9', '', '_9' WHERE kind = 'Slider'
    UNION ALL SELECT 0, 'FIRST', 'CLICK', '_FIRST_CLICK' WHERE kind = 'Timing'
    UNION ALL SELECT 0, 'PAGE', 'SUBMIT', '_PAGE_SUBMIT' WHERE kind = 'Timing'
    UNION ALL SELECT 0, i::VARCHAR, 'GROUP', '_' || i || '_GROUP' FROM range(1, 3) t(i) WHERE kind = 'PGR'
    UNION ALL SELECT 0, '1', '', '#1_1' WHERE kind = 'SBS') v)"""
CHO = """cho AS (SELECT survey_id, base_qid, i, (CASE WHEN k % 5 = 0 AND i = 3 THEN 2 ELSE i + k % 2 * 10 END)::VARCHAR AS recode, 'Choice ' || i || ' of ' || p_type AS txt,
    CASE WHEN i = 2 AND k % 3 = 0 THEN 'Image of ' || p_name ELSE 'Choice ' || i || ' of ' || p_type END AS label
    FROM p, range(1, 6) t(i) WHERE i <= n_choices AND kind IN ('MC', 'Matrix', 'CS', 'RO', 'Slider'))"""
DIC = """dic AS (SELECT c.survey_id, c.column_id, c.base_qid, c.loop_no, c.kind, 'Q' || c.k AS question_name,
    CASE WHEN c.kind = 'Matrix' THEN main || '| Row ' || sub_key || ' ' || p_name
        WHEN c.kind = 'CS' THEN main || '| ' || (SELECT txt FROM cho WHERE cho.survey_id = c.survey_id AND cho.base_qid = c.base_qid AND cho.i::VARCHAR = c.sub_key)
        WHEN c.kind = 'RO' AND suffix != 'TEXT' THEN main || ' | ' || (SELECT label FROM cho WHERE cho.survey_id = c.survey_id AND cho.base_qid = c.base_qid
            AND cho.i = c.n_choices + 1 - TRY_CAST(c.sub_key AS INT))
        WHEN c.kind = 'Slider' THEN main || ' | ' || coalesce((SELECT txt FROM cho WHERE cho.survey_id = c.survey_id AND cho.base_qid = c.base_qid AND cho.i::VARCHAR = c.sub_key), '')
        WHEN c.kind = 'PGR' THEN main || '| Group ' || sub_key || ' ' || p_name
        ELSE main END AS question_text,
    CASE WHEN c.kind = 'MC' AND suffix = 'TEXT' THEN 'TE' ELSE c.kind END AS question_type,
    CASE WHEN c.kind = 'MC' AND suffix = 'TEXT' THEN 'TE' ELSE selector END AS question_selector,
    c.kind IN ('RO', 'Slider', 'CS', 'Timing', 'SS') OR selector = 'SL' AS is_numeric, number, sub_key FROM col c)"""
OFF = """off AS (SELECT c.survey_id, c.column_id, answer_id, arg_min(value, i) AS question_value, (min(i) - 1)::INT AS choice_pos FROM (
        SELECT col.survey_id, col.column_id, recode AS answer_id, label AS value, i FROM col JOIN cho USING (survey_id, base_qid)
            WHERE (kind = 'MC' AND suffix = '') OR kind = 'Matrix'
        UNION ALL SELECT survey_id, column_id, i::VARCHAR, i::VARCHAR, i FROM col, range(1, 6) t(i) WHERE (kind = 'RO' AND suffix = '' AND i <= n_choices) OR kind = 'Slider') c
    GROUP BY ALL)"""
TYP = """typ AS (SELECT dic.*, CASE WHEN question_type = 'RO' OR is_numeric THEN 'Numeric' WHEN EXISTS (SELECT 1 FROM off WHERE off.survey_id = dic.survey_id AND off.column_id = dic.column_id)
    THEN 'MultipleChoice' WHEN question_type = 'TE' THEN 'FreeText' WHEN question_type = 'PGR' THEN 'Group' WHEN question_type = 'Meta' THEN 'MetaData'
    WHEN question_type = 'SBS' THEN 'Dates' WHEN question_type IN ('FileUpload', 'Draw') THEN question_type ELSE 'Unknown' END AS data_type FROM dic)"""
# Flow: B2, then B1 and B3 from branches; B4 under a group is not shown, but again at the end of even surveys.
BLK = """blk AS (SELECT survey_id, base_qid, 'B' || (number % 4 + 1) AS block_id, CASE WHEN number % 4 = 2 THEN 'No Description' ELSE 'Block ' || (number % 4 + 1) END AS block_name,
    (row_number() OVER (PARTITION BY survey_id, number % 4 ORDER BY number) - 1)::INT AS element_pos FROM p WHERE number != 19)"""
FLO = """flo AS (SELECT survey_id, (row_number() OVER (PARTITION BY survey_id ORDER BY o) - 1)::INT AS block_pos, block_id FROM
    (SELECT DISTINCT survey_id, survey_no FROM p), (VALUES (1, 'B2'), (2, 'B1'), (3, 'B3'), (4, 'B4')) v(o, block_id) WHERE o < 4 OR survey_no % 2 = 0)"""
PLACED = """placed AS (SELECT blk.survey_id, block_name, blk.base_qid, column_id, data_type, printf('%06d.%06d.%06d.%06d', block_pos, element_pos,
        CASE WHEN regexp_full_match(coalesce(sub_key, ''), '\\d+') THEN TRY_CAST(sub_key AS INT) ELSE 0 END, coalesce(loop_no, 0)) AS flow_pos, question_text
    FROM flo JOIN blk USING (survey_id, block_id) LEFT JOIN typ ON typ.survey_id = blk.survey_id AND typ.base_qid = blk.base_qid)"""
DIMS = ctes(P, COL, CHO, DIC, OFF, TYP, BLK, FLO, PLACED)

ORACLE["read_definitions"] = ctes(P, CHO) + """SELECT survey_id, base_qid, 'Q' || k AS question_name, main AS question_text, kind AS type, selector,
    CASE WHEN selector = 'SL' THEN 'ValidNumber' END AS validation,
    (SELECT string_agg(txt, ';' ORDER BY i) FROM cho WHERE cho.survey_id = p.survey_id AND cho.base_qid = p.base_qid) AS choice_texts FROM p"""
ORACLE["full_definition_join"] = ctes(P) + """SELECT survey_id, base_qid, CASE WHEN kind = 'RO' THEN
    (SELECT string_agg(i::VARCHAR, ',' ORDER BY i DESC) FROM range(1, n_choices + 1) t(i)) END AS choice_order FROM p"""
ORACLE["block_questions"] = ctes(P, BLK) + "SELECT * FROM blk"
ORACLE["flow_order"] = ctes(P, FLO) + "SELECT * FROM flo"
ORACLE["blocks"] = ctes(P, BLK, FLO) + "SELECT survey_id, block_pos, element_pos, block_name, base_qid FROM flo JOIN blk USING (survey_id, block_id)"
ORACLE["parse_column_id"] = ctes(P, COL) + """SELECT survey_id, column_id, base_qid, loop_no, (number + 1)::INT AS question_no, sub_key,
    CASE WHEN regexp_full_match(sub_key, '\\d+') THEN TRY_CAST(sub_key AS INT) ELSE 0 END AS sub_no, suffix FROM col"""
ORACLE["order_columns"] = ctes(P, COL) + """SELECT survey_id, column_id, row_number() OVER (PARTITION BY survey_id ORDER BY number, sub, loop_no, column_id)::INT AS position FROM (
    SELECT survey_id, column_id, number, CASE WHEN regexp_full_match(sub_key, '\\d+') THEN TRY_CAST(sub_key AS INT) ELSE 0 END AS sub, loop_no FROM col
    UNION ALL SELECT DISTINCT survey_id, 'recordedDate', -2, 0, 0 FROM p UNION ALL SELECT DISTINCT survey_id, 'endDate', -1, 0, 0 FROM p)"""
ORACLE["question_dictionary"] = ctes(P, COL, CHO, DIC) + """SELECT survey_id, column_id, question_name, question_text, question_type, question_selector, is_numeric FROM dic"""
ORACLE["is_numeric"] = ctes(P) + "SELECT survey_id, base_qid, kind IN ('RO', 'Slider') OR selector = 'SL' AS is_numeric FROM p"
for _name, _kinds in QUESTION_KINDS.items():
    ORACLE[_name] = ctes(P, COL, CHO, DIC, OFF) + f"""SELECT survey_id, column_id, question_text, question_type, is_numeric, answer_id, question_value
        FROM dic LEFT JOIN off USING (survey_id, column_id) WHERE kind IN ({", ".join(f"'{k}'" for k in _kinds)})"""
ORACLE["group_items"] = ctes(P, COL) + """SELECT survey_id, column_id, base_qid, i::VARCHAR AS item_id, 'Item ' || i || ' ' || p_name AS item_text
    FROM col, range(1, 4) t(i) WHERE kind = 'PGR'"""
ORACLE["question_tables"] = ctes(P, COL, CHO, OFF) + "SELECT * FROM off"
ORACLE["classify_data_type"] = ctes(P, COL, CHO, DIC, OFF, TYP) + "SELECT survey_id, column_id, question_type, data_type FROM typ"
ORACLE["order_by_block"] = DIMS + "SELECT * EXCLUDE (question_text) FROM placed"
ORACLE["drop_incomplete_questions"] = DIMS + "SELECT * EXCLUDE (question_text) FROM placed WHERE column_id IS NOT NULL"
ORACLE["survey_dimensions"] = DIMS + "SELECT survey_id, column_id, question_text, data_type, flow_pos FROM placed WHERE column_id IS NOT NULL"
ORACLE["to_text"] = ctes(R, C) + "SELECT survey_id, column_id, answer_id, question_value FROM c"

# -- events around a cutoff ---------------------------------------------------------------------

EV = "e AS (SELECT 'SE_' || (user_id % 2) AS survey_id, 'E_' || event_id AS response_id, event_id AS k, ts, event_type, value FROM events)"
EA = f"""a AS (
    SELECT survey_id, response_id, 'QID1' AS column_id, 'text' AS kind, NULL::VARCHAR[] AS items, NULL::DOUBLE AS num,
        list_position({list(EVENT_CODES)}, event_type)::VARCHAR AS txt FROM e WHERE k % 6 != 0
    UNION ALL SELECT survey_id, response_id, 'QID2', 'number', NULL, value / 10, NULL FROM e WHERE k % 9 != 0 AND value IS NOT NULL)"""
EQ = questions("q", "e", EVENT_QUESTIONS)
EC = f"""c AS (SELECT survey_id, 'QID1' AS column_id, v.* FROM (SELECT DISTINCT survey_id FROM e),
    (VALUES {values(list((str(i), n) for i, n in enumerate((*EVENT_CODES, "none"), 1)))}) v(answer_id, question_value))"""
SPLIT = f"""SELECT survey_id, response_id, CASE WHEN ts <= TIMESTAMP '{CUTOFF}' THEN 'pre' ELSE 'post' END AS phase FROM e WHERE k % 31 != 0"""
EU = f"u AS (SELECT * FROM ({SPLIT}) WHERE response_id IN (SELECT response_id FROM a))"
SIDES = """n AS (SELECT survey_id, column_id, code, count(*) FILTER (phase = 'pre') AS pre_n, count(*) FILTER (phase = 'post') AS post_n FROM codes GROUP BY ALL),
    base AS (SELECT survey_id, count(*) FILTER (phase = 'pre') AS pre_base, count(*) FILTER (phase = 'post') AS post_base FROM u GROUP BY survey_id),
    mc AS (SELECT coalesce(c.survey_id, n.survey_id) AS survey_id, coalesce(c.column_id, n.column_id) AS column_id, coalesce(c.answer_id, n.code) AS code,
        coalesce(question_value, '') AS value, coalesce(pre_n, 0) AS pre_n, coalesce(post_n, 0) AS post_n
        FROM c FULL JOIN (SELECT n.* FROM n JOIN q USING (survey_id, column_id) WHERE data_type = 'MultipleChoice') n
        ON n.survey_id = c.survey_id AND n.column_id = c.column_id AND n.code = c.answer_id),
    num AS (SELECT n.survey_id, n.column_id, n.code, n.code AS value, pre_n, post_n FROM n JOIN q USING (survey_id, column_id) WHERE data_type = 'Numeric')"""
SHARES = (f"{pct('pre_n', 'pre_base')} AS pre_pct, ({pct('pre_n', 'pre_base')})::VARCHAR || '%' AS pre_frequency, "
          f"{pct('post_n', 'post_base')} AS post_pct, ({pct('post_n', 'post_base')})::VARCHAR || '%' AS post_frequency")
EVENTS = ctes(EV, EA, EQ, EC, EU, coded(extra=", u.phase"), SIDES)
ORACLE["cutoff_split"] = ctes(EV) + SPLIT
ORACLE["pre_post_header"] = ctes(EV, EA, EU) + "SELECT survey_id, phase, count(*) AS n_responses FROM u GROUP BY ALL"
ORACLE["pre_post_mc"] = EVENTS + f"SELECT survey_id, column_id, code, value, pre_n, post_n, {SHARES} FROM mc JOIN base USING (survey_id)"
ORACLE["pre_post_numeric"] = EVENTS + f"SELECT survey_id, column_id, value, pre_n, post_n, {SHARES} FROM num JOIN base USING (survey_id)"
ORACLE["pre_post_report"] = EVENTS + f"""SELECT survey_id, column_id, question_name || ': ' || question_text AS heading, code, value, pre_n, pre_frequency, post_n, post_frequency FROM
    (SELECT *, {SHARES} FROM (SELECT * FROM mc UNION ALL SELECT * FROM num) JOIN base USING (survey_id)) JOIN q USING (survey_id, column_id)
    WHERE question_text != 'What happened?' OR pre_n != 0 OR post_n != 0"""
ASKED = "codes AS (SELECT * FROM every WHERE NOT (column_id = 'QID7' AND phase = 'pre') AND NOT (column_id = 'QID8' AND phase = 'post'))"
TWO = ctes(
    EV.replace("e AS", "e0 AS"), "e AS (SELECT * EXCLUDE (survey_id), 'SE' AS survey_id, CASE WHEN survey_id = 'SE_0' THEN 'pre' ELSE 'post' END AS phase FROM e0)",
    EA[:-1] + """ UNION ALL SELECT survey_id, response_id, 'QID8', 'text', NULL, NULL, (k % 2 + 1)::VARCHAR FROM e WHERE phase = 'pre' AND k % 4 != 0
        UNION ALL SELECT survey_id, response_id, 'QID7', 'text', NULL, NULL, (k % 3)::VARCHAR FROM e WHERE phase = 'post' AND k % 3 != 0)""",
    questions("q", "e", [*EVENT_QUESTIONS, ONLY_POST, ONLY_PRE]),
    EC.replace("c AS (", "c0 AS (") + f", c AS (SELECT * FROM c0 UNION ALL SELECT 'SE', v.* FROM (VALUES {values(ONLY_CHOICES)}) v(column_id, answer_id, question_value))",
    "u AS (SELECT * FROM e WHERE response_id IN (SELECT response_id FROM a))",
    coded(kinds_by="survey_id, column_id, phase", extra=", u.phase").replace("codes AS", "every AS"), ASKED, SIDES,
)
ORACLE["pre_post_two_surveys"] = TWO + f"""SELECT column_id, code, value, pre_n, pre_frequency, post_n, post_frequency FROM
    (SELECT *, {SHARES} FROM (SELECT * FROM mc UNION ALL SELECT * FROM num) JOIN base USING (survey_id))"""
ORACLE["pre_post_two_surveys_header"] = TWO + "SELECT survey_id, phase, count(*) AS n_responses FROM u GROUP BY ALL"
ORACLE["pre_post_chart_series"] = EVENTS + f"""SELECT survey_id, column_id, code, pre_pct, post_pct, code = 'NULL' AS is_null_bar FROM (
    SELECT *, {SHARES}, count(*) OVER (PARTITION BY survey_id, column_id) AS bars FROM (SELECT * FROM mc UNION ALL SELECT * FROM num) JOIN base USING (survey_id)) WHERE bars < 10"""

# -- parts as people ---------------------------------------------------------------------------------

PE = """people AS (SELECT k, response_id, TIMESTAMP '2024-01-01' + to_hours(k * 7919 % 1000) AS recorded_at, k % 41 + 70 AS progress,
    CASE WHEN k % 101 = 0 THEN 'X' WHEN k % 6 = 0 THEN upper(f) WHEN k % 10 = 1 THEN translate(f, 'aeo', 'áéö') ELSE f END AS first_raw,
    CASE WHEN k % 202 = 0 THEN 'Test' WHEN k % 9 = 0 THEN l || ' Jr.' ELSE l END AS last_raw,
    CASE WHEN k % 37 = 0 THEN NULL WHEN k % 50 = 49 THEN 3 WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 4 ELSE 5 END AS code,
    k % 5 = 1 AS marker, p_size % 5 + 1 AS size, CASE WHEN k % 8 != 0 THEN p_retailprice / 250 END AS price
    FROM (SELECT *, p_partkey AS k, 'P_' || lpad(p_partkey::VARCHAR, 12, '0') AS response_id, split_part(p_name, ' ', 1) AS f,
        CASE WHEN p_partkey % 4 = 0 THEN left(w, (p_partkey % 5)::INT) || substr(w, p_partkey % 5 + 2) ELSE w END AS l FROM
        (SELECT *, split_part(p_name, ' ', 2) || translate(regexp_replace(p_brand, '[^0-9]', '', 'g'), '0123456789', 'abcdefghij') AS w FROM part)))"""
CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({0})), '(^|\\s)(jr|sr|ii|iii|iv|v|vi)\\b', '', 'g'), '[^a-z]', ' ', 'g'), '\\s+', ' ', 'g'))"
ELI = f"""eli AS (SELECT *, {CLEAN.format("first_raw")} AS first, {CLEAN.format("last_raw")} AS last FROM people WHERE code IS NOT NULL AND progress > 82)"""
SMALL = "({0} IN ('fd', 'x', 'xx', 'xxx', 'test') OR length({0}) < 2)"
KEPT = f"""kept AS (SELECT * FROM eli WHERE NOT ({SMALL.format("first")} AND {SMALL.format("last")})
    AND (first, last) NOT IN ({", ".join(str(e) for e in EXCLUDED)}))"""
COH = """coh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cohort, first, last ORDER BY marker DESC, recorded_at DESC, response_id DESC) AS rn FROM
    (SELECT *, CASE code WHEN 1 THEN 'pre' WHEN 4 THEN 'post' WHEN 5 THEN 'unsure' END AS cohort FROM kept) WHERE cohort IS NOT NULL) WHERE rn = 1)"""


def cohort(name: str) -> str:
    return f"{name} AS (SELECT * FROM coh WHERE cohort = '{name}')"


# Cascade step by step: matches m1, m2, m3 and what is left after each.
CAS = """m1 AS (SELECT pre.response_id AS pre_id, post.response_id AS post_id, NULL::VARCHAR AS unsure_id, first, last FROM pre JOIN post USING (first, last)),
    pre1 AS (SELECT * FROM pre WHERE response_id NOT IN (SELECT pre_id FROM m1)),
    post1 AS (SELECT * FROM post WHERE response_id NOT IN (SELECT post_id FROM m1)),
    m2 AS (SELECT pre1.response_id AS pre_id, NULL::VARCHAR AS post_id, unsure.response_id AS unsure_id, first, last FROM pre1 JOIN unsure USING (first, last)),
    pre2 AS (SELECT * FROM pre1 WHERE response_id NOT IN (SELECT pre_id FROM m2)),
    unsure1 AS (SELECT * FROM unsure WHERE response_id NOT IN (SELECT unsure_id FROM m2)),
    m3 AS (SELECT NULL::VARCHAR AS pre_id, post1.response_id AS post_id, unsure1.response_id AS unsure_id, first, last FROM post1 JOIN unsure1 USING (first, last)),
    post2 AS (SELECT * FROM post1 WHERE response_id NOT IN (SELECT post_id FROM m3)),
    unsure2 AS (SELECT * FROM unsure1 WHERE response_id NOT IN (SELECT unsure_id FROM m3)),
    m AS (SELECT 1 AS stage, * FROM m1 UNION ALL SELECT 2, * FROM m2 UNION ALL SELECT 3, * FROM m3),
    lo AS (SELECT * FROM pre2 UNION ALL SELECT * FROM post2 UNION ALL SELECT * FROM unsure2)"""
PEOPLE = ctes(PE, ELI, KEPT, COH, cohort("pre"), cohort("post"), cohort("unsure"), CAS)


def match_row(source: str) -> str:
    parts = ", ".join(
        f"{c}_id, CASE WHEN {c}_id IS NOT NULL THEN first END AS {c}_first, CASE WHEN {c}_id IS NOT NULL THEN last END AS {c}_last" for c in ("pre", "post", "unsure")
    )
    return f"SELECT {parts}, 100.0::DOUBLE AS match_score FROM {source}"


ORACLE["eligible_responses"] = ctes(PE) + "SELECT response_id, progress::DOUBLE AS progress FROM people WHERE code IS NOT NULL AND progress > 82"
ORACLE["cohort_split"] = ctes(PE) + """SELECT response_id, CASE code WHEN 1 THEN 'pre' WHEN 4 THEN 'post' ELSE 'unsure' END AS cohort FROM people WHERE code IN (1, 4, 5)"""
ORACLE["clean_name"] = ctes(PE, ELI) + "SELECT response_id, first, last FROM eli"
ORACLE["drop_test_names"] = ctes(PE, ELI, KEPT) + "SELECT response_id, first, last FROM kept"
ORACLE["has_answer"] = ctes(PE) + "SELECT response_id, marker AS has_answer FROM people"
ORACLE["latest_valid_per_name"] = ctes(PE, ELI, KEPT, COH) + """SELECT cohort, first, last, response_id, marker, strftime(recorded_at, '%Y-%m-%d %H:%M:%S') AS recorded FROM coh"""
ORACLE["exact_match_pre_post"] = PEOPLE + match_row("m1")
ORACLE["exact_match_pre_unsure"] = PEOPLE + match_row("m2")
ORACLE["exact_match_post_unsure"] = PEOPLE + match_row("m3")
ALONE = ", ".join(f"CASE WHEN cohort = '{c}' THEN response_id END AS {c}_id" for c in ("pre", "post", "unsure"))
ORACLE["match_cascade"] = PEOPLE + f"SELECT stage, pre_id, post_id, unsure_id FROM m UNION ALL SELECT 0, {ALONE} FROM lo"
ORACLE["match_leftovers"] = PEOPLE + "SELECT cohort, response_id, first, last FROM lo"
NUM = "num AS (SELECT row_number() OVER (ORDER BY stage, first, last) AS match_id, * FROM m)"
NUMBERED = PEOPLE.rstrip() + ",\n" + NUM + "\n"
ORACLE["match_ids"] = NUMBERED + "SELECT match_id, stage, pre_id, post_id, unsure_id FROM num"
for _side in ("pre", "post"):
    ORACLE[f"{_side}_side"] = NUMBERED + f"""SELECT match_id, coh.cohort, coh.response_id, coh.first, coh.last FROM num
        JOIN coh ON coh.response_id = coalesce({_side}_id, unsure_id)"""
# Longest common subsequence by the table recurrence, one row of the table at a time.
LCS = """list_reduce(list_transform(string_split({a}, ''), lambda ch: [ascii(ch)]), lambda prev, ch:
    list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda row, j:
        list_append(row, CASE WHEN ascii(substr({b}, j[1], 1)) = ch[1] THEN prev[j[1]] + 1 ELSE greatest(prev[j[1] + 1], row[j[1]]) END), [0::BIGINT]),
    list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT))[length({b}) + 1]"""


def ratio(a: str, b: str) -> str:
    return (f"CASE WHEN {a} = {b} THEN 100 WHEN {a} = '' OR {b} = '' THEN 0 ELSE "
            f"round_even(200.0::DOUBLE * {LCS.format(a=a, b=b)} / (length({a}) + length({b})), 0)::INT END")


SCORE = "{0} * 0.2::DOUBLE + {1} * 0.8::DOUBLE"
ORACLE["name_match_score"] = ctes(PE, ELI) + f"""SELECT response_id, first_ratio, last_ratio, {SCORE.format("first_ratio", "last_ratio")} AS score FROM
    (SELECT x.response_id, {ratio("x.first", "y.first")} AS first_ratio, {ratio("x.last", "y.last")} AS last_ratio FROM eli x JOIN eli y ON y.k = x.k + 1)"""


def best(left: str, right: str, name: str) -> str:
    """All pairs, scored from memo tables of distinct first and last names."""
    return f"""{name} AS MATERIALIZED (SELECT l_id, l_first, l_last, r_id, r_first, r_last, score FROM (
        SELECT l.response_id AS l_id, l.first AS l_first, l.last AS l_last, r.response_id AS r_id, r.first AS r_first, r.last AS r_last, {SCORE.format("fm.s", "lm.s")} AS score,
            row_number() OVER (PARTITION BY l.response_id ORDER BY {SCORE.format("fm.s", "lm.s")} DESC, r.first, r.last, r.response_id) AS rn
        FROM {left} l LEFT JOIN {right} r ON TRUE LEFT JOIN fm ON fm.a = l.first AND fm.b = r.first LEFT JOIN lm ON lm.a = l.last AND lm.b = r.last) WHERE rn = 1)"""


def memo(source: str) -> str:
    return f"""fm AS MATERIALIZED (SELECT x.v AS a, y.v AS b, {ratio("x.v", "y.v")} AS s FROM (SELECT DISTINCT first AS v FROM {source}) x, (SELECT DISTINCT first AS v FROM {source}) y),
    lm AS MATERIALIZED (SELECT x.v AS a, y.v AS b, {ratio("x.v", "y.v")} AS s FROM (SELECT DISTINCT last AS v FROM {source}) x, (SELECT DISTINCT last AS v FROM {source}) y)"""


ORACLE["fuzzy_best_match"] = ctes(PE, ELI, KEPT, COH, cohort("pre"), cohort("post"), memo("coh"), best("pre", "post", "b")) + """
    SELECT l_id AS pre_id, l_first AS pre_first, l_last AS pre_last, r_id AS post_id, r_first AS post_first, r_last AS post_last, score AS match_score FROM b"""
NO = "NULL::VARCHAR"
CAND = f"""cand AS (
    SELECT l_id AS pre_id, l_first AS pre_first, l_last AS pre_last, r_id AS post_id, r_first AS post_first, r_last AS post_last, {NO} AS unsure_id, {NO} AS unsure_first, {NO} AS unsure_last,
        score AS match_score FROM b1
    UNION ALL SELECT l_id, l_first, l_last, {NO}, {NO}, {NO}, r_id, r_first, r_last, score FROM b2
    UNION ALL SELECT {NO}, {NO}, {NO}, l_id, l_first, l_last, r_id, r_first, r_last, score FROM b3)"""
FUZZY = ",\n".join([PEOPLE.rstrip(), memo("lo"), best("pre2", "post2", "b1"), best("pre2", "unsure2", "b2"), best("post2", "unsure2", "b3"), CAND]) + "\n"
ORACLE["fuzzy_candidates"] = FUZZY + "SELECT * FROM cand"
ORACLE["confirm_matches"] = FUZZY + f"""SELECT 'match' AS part, pre_id, post_id, unsure_id, 100.0::DOUBLE AS match_score FROM m
    UNION ALL SELECT CASE WHEN match_score > 95 THEN 'match' ELSE 'candidate' END, pre_id, post_id, unsure_id, match_score FROM cand
    UNION ALL SELECT 'leftover', {ALONE}, NULL FROM lo WHERE response_id NOT IN
        (SELECT unnest([coalesce(pre_id, ''), coalesce(post_id, ''), coalesce(unsure_id, '')]) FROM cand WHERE match_score > 95)"""
ORACLE["matched_pre_post"] = NUMBERED.rstrip() + f""",
    side AS (SELECT 'pre' AS phase, coh.* FROM num JOIN coh ON coh.response_id = coalesce(num.pre_id, num.unsure_id)
        UNION ALL SELECT 'post', coh.* FROM num JOIN coh ON coh.response_id = coalesce(num.post_id, num.unsure_id)),
    base AS (SELECT count(*) FILTER (phase = 'pre') AS pre_base, count(*) FILTER (phase = 'post') AS post_base FROM side),
    n AS (SELECT 'QID1' AS column_id, size::VARCHAR AS code, count(*) FILTER (phase = 'pre') AS pre_n, count(*) FILTER (phase = 'post') AS post_n FROM side GROUP BY ALL
        UNION ALL SELECT 'QID2', coalesce(trunc(price)::BIGINT::VARCHAR, 'NULL'), count(*) FILTER (phase = 'pre'), count(*) FILTER (phase = 'post') FROM side GROUP BY ALL),
    c AS (SELECT 'QID1' AS column_id, i::VARCHAR AS code, 'Size ' || i AS value FROM range(1, 7) t(i))
    SELECT column_id, code, value, pre_n, pre_frequency, post_n, post_frequency FROM (SELECT *, {SHARES} FROM (
        SELECT column_id, code, CASE WHEN column_id = 'QID2' THEN code ELSE coalesce(value, '') END AS value, coalesce(pre_n, 0) AS pre_n, coalesce(post_n, 0) AS post_n
        FROM c FULL JOIN n USING (column_id, code)), base)"""
ORACLE["union_by_name"] = ctes(PE, ELI) + """SELECT 'people' AS source, response_id, first, last, marker, NULL::VARCHAR AS survey_id, NULL::VARCHAR AS channel, NULL::VARCHAR AS name, NULL::DOUBLE AS balance FROM eli
    UNION ALL SELECT 'documents', 'D_' || doc_id, NULL, NULL, NULL, 'SD_' || lang, NULL, NULL, NULL FROM documents
    UNION ALL SELECT 'contacts', c_custkey::VARCHAR, NULL, NULL, NULL, NULL, NULL, c_name, c_acctbal FROM customer"""

# -- documents as free text ------------------------------------------------------------------------------

TEXT = f"text || CASE WHEN doc_id % 11 = 0 THEN ' N/A' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '{EMOJI_SAMPLE}' ELSE '' END"
DR = f"r AS (SELECT 'SD_' || lang AS survey_id, 'D_' || doc_id AS response_id, doc_id AS k, source, lang, quality, toxic, {TEXT} AS full_text FROM documents LEFT JOIN labels USING (doc_id))"
DA = """a AS (SELECT survey_id, response_id, 'QID1_TEXT' AS column_id, full_text AS txt FROM r WHERE k % 7 != 0
    UNION ALL SELECT survey_id, response_id, 'QID5_6_TEXT', source FROM r WHERE k % 3 = 0)"""
DQ = questions("q", "r", DOCUMENT_QUESTIONS)


def cleaned(text: str) -> str:
    return (f"CASE WHEN NOT regexp_matches({text}, 'N/A|nan') AND NOT regexp_full_match(replace({text}, chr(10), ' '), '\\s*') "
            f"THEN regexp_replace(lower(replace({text}, chr(10), ' ')), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g') END")


EXACT = cleaned("{0}").replace("'N/A|nan'", "'^\\s*(N/A|nan)\\s*$'").replace("{0}", TEXT)
ORACLE["free_text_view"] = ctes(DR, DA) + """SELECT survey_id, response_id, column_id, CASE column_id WHEN 'QID1_TEXT' THEN 'Tell us more' ELSE 'Other source' END AS question_text, txt AS text FROM a"""
ORACLE["free_text_compliance"] = ctes(DR, DA, DQ, "u AS (SELECT * FROM r)") + MISSING + "WHERE data_type = 'FreeText' GROUP BY survey_id, column_id"
ORACLE["text_entry_counts"] = ctes(DR) + f"SELECT survey_id, 'QID1_TEXT' AS column_id, count({cleaned('full_text')}) AS entries FROM r GROUP BY survey_id"
ORACLE["clean_text"] = f"SELECT 'D_' || doc_id AS response_id, {cleaned(TEXT)} AS text, {EXACT} AS text_exact FROM documents"
ORACLE["drop_null_columns"] = """SELECT 'SD_' || lang AS survey_id, 'D_' || doc_id AS response_id, 'QID1_TEXT' AS column_id FROM documents
    UNION ALL SELECT 'SD_' || lang, 'D_' || doc_id, 'QID5_6_TEXT' FROM documents WHERE lang != 'de'"""
EMOJI_CLASS = ("[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{2300}-\\x{23FF}\\x{25A0}-\\x{25FF}\\x{2B00}-\\x{2BFF}\\x{2190}-\\x{21FF}\\x{2934}\\x{2935}\\x{3030}\\x{303D}"
               "\\x{3297}\\x{3299}\\x{203C}\\x{2049}\\x{2139}\\x{2122}\\x{24C2}\\x{E0020}-\\x{E007F}\\x{20E3}\\x{FE0F}\\x{200D}]")
ORACLE["remove_emojis"] = f"SELECT 'D_' || doc_id AS response_id, regexp_replace({TEXT}, '{EMOJI_CLASS}', '', 'g') AS text FROM documents"
SRC = """src AS (SELECT 'SD_' || lang AS survey_id, 'D_' || doc_id AS response_id, 'QID5_6_TEXT' AS column_id, lang,
    CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN '  ' ELSE text END AS text,
    text IN (SELECT text FROM documents WHERE lang = 'de') AS german FROM documents)"""
TRANSLATED = "CASE WHEN NOT regexp_matches(text, '\\S') OR text IS NULL OR german THEN text ELSE 'en: ' || text END"
ORACLE["translate_columns"] = ctes(SRC) + f"""SELECT survey_id, response_id, column_id, text, {TRANSLATED} AS text_translated,
    CASE WHEN regexp_matches(text, '\\S') AND german THEN 'error' END AS text_error FROM src"""
ORACLE["translate_call"] = ctes(SRC) + """SELECT survey_id, response_id, column_id, text, CASE WHEN regexp_matches(text, '\\S') AND length(text) % 5 != 0 THEN 'en: ' || text ELSE text END AS text_translated,
    CASE WHEN regexp_matches(text, '\\S') AND length(text) % 5 = 0 THEN 'error' END AS text_error FROM src"""
ORACLE["translate_with_memory"] = ORACLE["translate_call"]
ORACLE["translate_replace"] = ctes(SRC) + f"SELECT survey_id, response_id, column_id, {TRANSLATED} AS text FROM src"
ORACLE["translation_report"] = ctes(DR, DA, f"cl AS (SELECT survey_id, response_id, column_id, {cleaned('txt')} AS txt FROM a)",
    f"known AS (SELECT DISTINCT {cleaned('full_text')} AS source FROM r WHERE lang != 'de' UNION SELECT source FROM documents)") + """
    SELECT survey_id, response_id, column_id, CASE WHEN txt IN (SELECT source FROM known WHERE source IS NOT NULL) THEN 'en: ' || txt ELSE txt END AS text FROM cl"""

# -- other text ----------------------------------------------------------------------------------------------

STRIPPED = "regexp_replace({0}, '<[^>]*>', '', 'g')"
ORACLE["strip_html"] = f"SELECT page_id, {STRIPPED.format('html')} AS text FROM pages"
ORACLE["strip_html_deep"] = f"""SELECT page_id, {STRIPPED.format('html')} || ' ' || {STRIPPED.format('url')} AS both, {STRIPPED.format('html')} AS named FROM pages"""
ORACLE["json_fields"] = "SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k, props::JSON->>'$.none.deeper' AS absent FROM events"

# -- contacts and distributions ---------------------------------------------------------------------------------

ORACLE["contacts_upsert"] = """WITH up AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS contact_id,
        CASE WHEN c_custkey % 10 = 0 THEN upper(c_name) ELSE 'zz ' || c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN 'earlier' END AS segment,
        c_acctbal + 1 AS balance, CASE WHEN c_custkey % 3 = 0 THEN 'phone' ELSE 'zz' END AS preference, (c_custkey % 7)::VARCHAR AS shoe
        FROM customer WHERE c_custkey % 5 = 0)
    SELECT coalesce(up.contact_id, c_custkey) AS contact_id, coalesce(up.name, c_name) AS name, coalesce(segment, c_mktsegment) AS segment,
        coalesce(up.balance, c_acctbal) AS balance, c_nationkey::VARCHAR AS nation,
        coalesce(up.preference, CASE WHEN c_custkey IS NOT NULL THEN 'email' END) AS preference, shoe
    FROM customer FULL JOIN up ON up.contact_id = c_custkey"""
ORACLE["merge_contacts"] = ORACLE["contacts_upsert"]
ORACLE["contacts_delete"] = "SELECT c_custkey AS contact_id, c_name AS name FROM customer WHERE c_custkey % 13 != 0"
ORACLE["since_filter"] = "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'"
ORACLE["distribution_filter"] = """SELECT 'EMD_' || event_id AS distribution_id, 'CG_' || (event_id % 3) AS mailing_list_id FROM events
    WHERE user_id % 4 = 1 AND event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 06:00:00'"""

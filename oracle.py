"""The workload's queries once more, in DuckDB SQL over the same tables.

Written from the rules, independently of the Spark code: every pair is scored by
brute force, every check is done with plain string functions.
"""

import re

from precedent.functions.prompts import ABSTAIN_TEXT, NO_TICKETS_TEXT, SYSTEM_TEXT
from precedent.schemas import HEADINGS

H1, H2, H3, H4 = HEADINGS


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


MIX = (
    "list_transform(list_zip(v, w), lambda z: (1.0 - {a}) * z[1] + {a} * z[2])"
)

PAIRS = """
e AS (SELECT vec_id AS i, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT count(*) AS n FROM e),
pairs AS (SELECT a.i, a.label, a.v, b.v AS w FROM e a JOIN e b
          ON b.i = (a.i + 1) % (SELECT n FROM n))
"""

TICKETS = f"""
raw_tickets AS (
  SELECT i, label, v AS x FROM pairs
  UNION ALL
  SELECT i + 1000000, label, {MIX.format(a="(0.05 + 0.15 * (i % 7))")} FROM pairs),
tickets AS (
  SELECT 'SR' || i AS ticket_id, 'family ' || label AS product,
         'symptom of vector ' || i AS issue, 'remedy of vector ' || i AS resolution, x AS u0,
         list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) AS u
  FROM raw_tickets)
"""

SHARE = "CASE i % 5 WHEN 2 THEN 0.48 WHEN 3 THEN 0.6 ELSE 0.2 END"
QUERIES = f"""
raw_queries AS (
  SELECT i, CASE WHEN i % 5 = 0 THEN list_reverse(v) ELSE {MIX.format(a="share")} END AS x
  FROM (SELECT *, {SHARE} AS share FROM pairs)),
requests AS (
  SELECT i, CAST(i AS VARCHAR) AS query_id, 'request about vector ' || i AS issue,
         'kind ' || (i % 5) AS category,
         CASE WHEN i % 5 IN (1, 2, 3) THEN 'SR' || i END AS expected_ticket_id,
         list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) AS u
  FROM raw_queries)
"""


def ranked(score: str, k: int = 3) -> str:
    return f"""
ranked AS (
  SELECT query_id, q_issue, i, row_number() OVER (
           PARTITION BY query_id ORDER BY round(s, 9) DESC, ticket_id) AS rank,
         ticket_id, product, issue, resolution, s
  FROM (SELECT q.query_id, q.issue AS q_issue, q.i, t.ticket_id, t.product, t.issue, t.resolution,
               {score} AS s FROM requests q CROSS JOIN tickets t)
  QUALIFY rank <= {k})
"""


BASE = (
    "WITH "
    + PAIRS
    + ","
    + TICKETS
    + ","
    + QUERIES
    + ","
    + ranked("exp(-pow(list_distance(q.u, t.u), 2))")
)
COSINE_BASE = (
    "WITH " + PAIRS + "," + TICKETS + "," + QUERIES + "," + ranked("list_dot_product(q.u, t.u)")
)

TOP = "SELECT query_id, rank, ticket_id, round(s, 6) AS similarity_score FROM ranked"

BLOCK = (
    "'Historical ticket ' || ticket_id || chr(10) || 'Product: ' || product || chr(10) || "
    "'Issue: ' || issue || chr(10) || 'Resolution: ' || resolution"
)
SENT = "(rank = 1 OR NOT alone)"
GATED = f"""
tops AS (
  SELECT query_id, any_value(q_issue) AS issue, any_value(i) AS i,
         max(CASE WHEN rank = 1 THEN s END) AS best,
         coalesce(max(CASE WHEN rank = 2 THEN s END), 0.0) AS next
  FROM ranked GROUP BY query_id),
gated AS (
  SELECT t.query_id, any_value(t.issue) AS issue, any_value(t.i) AS i, any_value(best) AS best,
         any_value(best) >= 0.50 AS gate_open,
         string_agg(ticket_id, ',' ORDER BY rank) AS evidence_ids,
         string_agg(CASE WHEN {SENT} THEN ticket_id END, ',' ORDER BY rank) AS sent_ids,
         string_agg({BLOCK}, chr(10) || chr(10) ORDER BY rank) AS all_text,
         string_agg(CASE WHEN {SENT} THEN {BLOCK} END, chr(10) || chr(10) ORDER BY rank) AS sent_text,
         max(CASE WHEN rank = 1 THEN ticket_id END) AS first_id
  FROM (SELECT *, best >= 0.60 AND best - next >= 0.03 AS alone FROM tops) t
  JOIN (SELECT query_id, rank, ticket_id, product, issue, resolution FROM ranked) r USING (query_id)
  GROUP BY t.query_id)
"""
GATED = GATED.replace("'Issue: ' || issue", "'Issue: ' || r.issue")
GATE = BASE + "," + GATED

ROUTE = "CASE WHEN gate_open THEN 'generate' ELSE 'abstain' END"

RESULTS = """
results AS (
  SELECT q.query_id AS id, q.category, q.issue AS query, q.expected_ticket_id,
         q.expected_ticket_id IS NOT NULL AS supported, g.best, g.gate_open, g.first_id,
         CASE WHEN q.expected_ticket_id IS NOT NULL
              THEN coalesce(1.0 / (SELECT min(rank) FROM ranked r WHERE r.query_id = q.query_id
                                   AND r.ticket_id = q.expected_ticket_id), 0.0) END AS rr
  FROM requests q JOIN gated g USING (query_id))
"""
EVAL = GATE + "," + RESULTS
TOTALS = """
totals AS (
  SELECT CAST(3 AS BIGINT) AS top_k, count(*) FILTER (supported) AS supported_count,
         coalesce(count(*) FILTER (supported AND rr > 0) / nullif(count(*) FILTER (supported), 0), 0.0)
           AS recall,
         coalesce(avg(rr), 0.0) AS mrr,
         count(*) FILTER (supported AND NOT gate_open) AS supported_false_abstentions,
         count(*) FILTER (NOT supported) AS unsupported_count,
         count(*) FILTER (NOT supported AND NOT gate_open) AS unsupported_correct
  FROM results)
"""
SUMMARY = (
    EVAL
    + ","
    + TOTALS
    + """
SELECT top_k, supported_count, round(recall, 6) AS recall, round(mrr, 6) AS mrr,
       supported_false_abstentions, unsupported_count, unsupported_correct{more} FROM totals"""
)

PROMPT = (
    f"'system: ' || {text(SYSTEM_TEXT)} || chr(10) || '----' || chr(10) || "
    "'user: Issue to resolve:' || chr(10) || issue || chr(10) || chr(10) || 'Earlier tickets:' "
    "|| chr(10) || sent_text"
)


def answer(kind: str, ticket: str) -> str:
    """The made-up answer of a query, by the kind of fault it shall have."""
    parts = [
        f"CASE {kind} WHEN 6 THEN {text(H1)} || chr(10) || 'Once more.' || chr(10) || {text(H1)} "
        f"ELSE {text(H1)} END",
        f"CASE {kind} WHEN 2 THEN 'As in SR99999999.' ELSE 'A known fault.' END",
        f"CASE {kind} WHEN 3 THEN {text(H3)} ELSE {text(H2)} END",
        f"CASE {kind} WHEN 4 THEN ' ' || chr(9) || ' ' ELSE 'Apply the remedy.' END",
        f"CASE {kind} WHEN 3 THEN {text(H2)} ELSE {text(H3)} END",
        f"CASE {kind} WHEN 1 THEN 'None.' ELSE {ticket} END",
        text(H4),
        f"CASE {kind} WHEN 5 THEN 'There is No Direct Evidence here.' ELSE 'No material gap.' END",
    ]
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


WS = "' ' || chr(9) || chr(10) || chr(13)"


def part(heading: str, following: str | None, a: str = "a") -> str:
    """Text below a heading, trimmed."""
    rest = f"substr({a}, strpos({a}, {text(heading)}) + {len(heading)})"
    if following:
        cut = f"strpos({rest}, {text(following)})"
        rest = f"CASE WHEN {cut} > 0 THEN substr({rest}, 1, {cut} - 1) ELSE {rest} END"
    return f"CASE WHEN strpos({a}, {text(heading)}) > 0 THEN trim({rest}, {WS}) ELSE '' END"


def times(heading: str) -> str:
    return f"((length(a) - length(replace(a, {text(heading)}, ''))) // {len(heading)})"


ONCE = " AND ".join(f"{times(h)} = 1" for h in HEADINGS)
ORDERED = " AND ".join(
    f"strpos(a, {text(x)}) < strpos(a, {text(y)})" for x, y in zip(HEADINGS, HEADINGS[1:])
)
CITED = r"list_sort(list_distinct(regexp_extract_all(a, '\bSR[0-9]+\b')))"


def checked(source: str) -> str:
    """Rows of ``source`` (query_id, a, sent_ids, ...) with the first rule broken."""
    return f"""
parts AS (
  SELECT *, {part(H1, H2)} AS p1, {part(H2, H3)} AS p2, {part(H3, H4)} AS p3, {part(H4, None)} AS p4,
         {CITED} AS cited,
         list_filter({CITED}, lambda c: NOT list_contains(string_split(sent_ids, ','), c)) AS unknown
  FROM {source}),
checked AS (
  SELECT *,
    CASE WHEN NOT ({ONCE}) THEN 'heading_count' WHEN NOT ({ORDERED}) THEN 'heading_order'
         WHEN p1 = '' OR p2 = '' OR p3 = '' OR p4 = '' THEN 'blank_section'
         WHEN len(unknown) > 0 THEN 'unknown_citation'
         WHEN len(cited) > 0 AND (lower(p4) LIKE '%no direct evidence%' OR lower(p4) LIKE
              '%no evidence%' OR lower(p4) LIKE '%without evidence%') THEN 'contradiction' END AS code
  FROM parts),
explained AS (
  SELECT *, CASE code
    WHEN 'heading_count' THEN 'Each of the four headings has to appear one time only.'
    WHEN 'heading_order' THEN 'The four headings are not in their required order.'
    WHEN 'blank_section' THEN 'Nothing is written below ' || CASE WHEN p1 = '' THEN {text(H1)}
      WHEN p2 = '' THEN {text(H2)} WHEN p3 = '' THEN {text(H3)} ELSE {text(H4)} END || '.'
    WHEN 'unknown_citation' THEN 'These cited tickets were not supplied: ' ||
      array_to_string(unknown, ', ') || '.'
    WHEN 'contradiction' THEN
      'A ticket is cited while the limitations say that evidence is absent.' END AS detail
  FROM checked)
"""


ANSWERS = (
    GATE
    + f", answers AS (SELECT *, {answer('i % 7', 'first_id')} AS a FROM gated),"
    + checked("answers")
)

CHATS = """
WITH chats AS (
  SELECT 'SR' || (u.conv_id * 1000 + u.turn) AS ticket_id, 'product ' || (u.conv_id % 5) AS product,
         u.text AS issue, a.text AS resolution, u.conv_id * 1000 + u.turn AS number
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')
"""
CHAT_DOCUMENTS = (
    CHATS
    + """
SELECT ticket_id, product, issue, resolution,
       'Product: ' || product || chr(10) || 'Issue: ' || issue AS retrieval_text FROM chats"""
)


def blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}, {WS}) = '')"


BROKEN_TICKETS = (
    CHATS
    + """,
broken AS (
  SELECT CASE WHEN number % 17 = 0 THEN lower(ticket_id) WHEN number % 13 = 0 THEN 'SR1'
              ELSE ticket_id END AS ticket_id,
         CASE WHEN number % 19 = 0 THEN ' ' || chr(9) ELSE product END AS product,
         CASE WHEN number % 23 <> 0 THEN issue END AS issue,
         CASE WHEN number % 11 = 0 THEN '' ELSE resolution END AS resolution
  FROM chats)"""
)


def rule(order: int, name: str, column: str | None, count: str, source: str) -> str:
    shown = text(column) if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT CAST({order} AS BIGINT) AS rule_order, '{name}' AS rule, {shown} AS column_name, "
        f"CAST({count} AS BIGINT) AS n_bad FROM {source}"
    )


EMPTY = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"
TICKET_RULES = " UNION ALL ".join(
    [rule(0, "empty_table", None, EMPTY, "broken")]
    + [
        rule(i, "blank_field", c, f"count(*) FILTER ({blank(c)})", "broken")
        for i, c in enumerate(("issue", "product", "resolution", "ticket_id"), 1)
    ]
    + [
        rule(
            5,
            "id_format",
            "ticket_id",
            "count(*) FILTER (NOT regexp_full_match(ticket_id, 'SR[0-9]+'))",
            "broken",
        ),
        rule(6, "id_repeated", "ticket_id", "count(ticket_id) - count(DISTINCT ticket_id)", "broken"),
    ]
)

BROKEN_CASES = """
WITH broken AS (
  SELECT CASE WHEN item_id % 9 = 0 THEN 'again' ELSE CAST(item_id AS VARCHAR) END AS id,
         CASE WHEN item_id % 8 = 0 THEN ' ' ELSE 'passage' END AS category,
         CASE WHEN item_id % 7 = 0 THEN ' abc ' ELSE text END AS query,
         CASE WHEN item_id % 6 = 0 THEN '' WHEN item_id % 2 = 0 THEN CAST(item_id AS VARCHAR) END
           AS expected
  FROM benchmark)
"""
CASE_RULES = " UNION ALL ".join(
    [
        rule(0, "empty_table", None, EMPTY, "broken"),
        rule(1, "blank_field", "id", f"count(*) FILTER ({blank('id')})", "broken"),
        rule(2, "blank_field", "category", f"count(*) FILTER ({blank('category')})", "broken"),
        rule(3, "id_repeated", "id", "count(id) - count(DISTINCT id)", "broken"),
        rule(
            4,
            "query_length",
            "query",
            f"count(*) FILTER (NOT length(trim(query, {WS})) BETWEEN 5 AND 2000)",
            "broken",
        ),
        rule(
            5,
            "blank_expected",
            "expected_ticket_id",
            f"count(*) FILTER (expected IS NOT NULL AND {blank('expected')})",
            "broken",
        ),
    ]
)

ISSUE_STATUS = f"""
WITH issues AS (
  SELECT CAST(doc_id AS VARCHAR) AS query_id, doc_id % 8 - 1 AS top_k,
         CASE WHEN doc_id % 29 <> 0 THEN length(trim(text, {WS})) END AS n_chars FROM documents)
SELECT query_id, coalesce(n_chars, -1) AS n_chars, top_k,
       CASE WHEN n_chars IS NULL OR n_chars NOT BETWEEN 5 AND 2000 THEN 'invalid_issue'
            WHEN top_k NOT BETWEEN 1 AND 5 THEN 'invalid_top_k' END AS status FROM issues
"""


# -- TF-IDF ---------------------------------------------------------------------


def weights(name: str, source: str, key: str, body: str, n: str = "n_texts", df: str | None = None):
    """CTEs ``{name}``: unit weights (key, term, weight) of a set of texts."""
    df = df or f"(SELECT term, count(*) AS df FROM {name}_tf GROUP BY term)"
    return f"""
{name}_tf AS (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(regexp_extract_all(lower({body}), '[a-z0-9à-ÿ]+')) AS term FROM {source})
  GROUP BY ALL),
{name}_raw AS (
  SELECT t.{key}, t.term, t.tf * (ln((({n}) + 1.0) / (coalesce(d.df, 0) + 1.0)) + 1.0) AS w
  FROM {name}_tf t LEFT JOIN {df} d USING (term)),
{name} AS (
  SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {name}_raw)
"""


DOC_COUNT = "SELECT count(*) FROM docs"
DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS ticket_id, text FROM documents)"
DOC_WEIGHTS = f"WITH {DOCS}," + weights("dw", "docs", "ticket_id", "text", DOC_COUNT)
LEXICAL = (
    DOC_WEIGHTS
    + ", asks AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text FROM benchmark),"
    + weights(
        "qw",
        "asks",
        "query_id",
        "text",
        DOC_COUNT,
        "(SELECT term, count(*) AS df FROM dw_tf GROUP BY term)",
    )
)
LEXICAL_TOP = """
, sums AS (SELECT query_id, ticket_id, sum(qw.weight * dw.weight) AS s
           FROM qw JOIN dw USING (term) GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, ticket_id)
         AS rank, ticket_id, round(s, 6) AS similarity_score
FROM sums QUALIFY rank <= 3"""

CHAT_LEXICAL = (
    CHATS
    + """, docs AS (
  SELECT ticket_id, 'Product: ' || product || chr(10) || 'Issue: ' || issue AS text FROM chats),
asks AS (SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS query_id, text FROM conversations
         WHERE role = 'user'),
valid AS (SELECT * FROM asks WHERE length(trim(text, """
    + WS
    + ")) BETWEEN 5 AND 2000),"
    + weights("dw", "docs", "ticket_id", "text", DOC_COUNT)
    + ","
    + weights(
        "qw",
        "valid",
        "query_id",
        "text",
        DOC_COUNT,
        "(SELECT term, count(*) AS df FROM dw_tf GROUP BY term)",
    )
    + """
, sums AS (SELECT query_id, ticket_id, sum(qw.weight * dw.weight) AS s
           FROM qw JOIN dw USING (term) GROUP BY ALL),
every AS (SELECT v.query_id, d.ticket_id, coalesce(s, 0.0) AS s
          FROM valid v CROSS JOIN docs d LEFT JOIN sums USING (query_id, ticket_id))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, ticket_id)
         AS rank, ticket_id, round(s, 6) AS similarity_score
FROM every QUALIFY rank <= 3"""
)

LETTERS = ", ".join(
    f"CAST(length(text) - length(replace(text, '{c}', '')) AS DOUBLE)"
    for c in "abcdefghijklmnopqrstuvwxyz"
)
EMBED = f"""
WITH docs AS (SELECT CAST(doc_id AS VARCHAR) AS ticket_id, [1.0::DOUBLE, {LETTERS}] AS x
              FROM documents),
asks AS (SELECT CAST(item_id AS VARCHAR) AS query_id, [1.0::DOUBLE, {LETTERS}] AS x FROM benchmark),
d AS (SELECT ticket_id, list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) AS u FROM docs),
q AS (SELECT query_id, list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) AS u FROM asks),
scored AS (SELECT query_id, ticket_id, exp(-pow(list_distance(q.u, d.u), 2)) AS s
           FROM q CROSS JOIN d)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, ticket_id)
         AS rank, ticket_id, round(s, 6) AS similarity_score
FROM scored QUALIFY rank <= 3"""

# -- resolve ----------------------------------------------------------------------

# The row's own top_k cuts its list before the gate and the selection.
ASKED_K = "CASE WHEN i % 29 = 0 THEN 6 ELSE i % 3 + 1 END"
RESOLVE = (
    "WITH "
    + PAIRS
    + ","
    + TICKETS
    + ","
    + QUERIES
    + ","
    + ranked("exp(-pow(list_distance(q.u, t.u), 2))", 5).replace(
        "ranked AS", "longest AS", 1
    )
    + f", ranked AS (SELECT * FROM longest WHERE rank <= {ASKED_K} AND i % 31 <> 0 AND i % 29 <> 0),"
    + GATED
    + f""", turn1 AS (
  SELECT query_id, i, sent_ids, first_id, {answer('i % 7', 'first_id')} AS a
  FROM gated WHERE gate_open AND i % 41 <> 0 AND i % 37 <> 0),"""
    + checked("turn1")
    + """, one AS (SELECT query_id, i, sent_ids, first_id, a, code FROM explained),"""
    + f""" turn2 AS (
  SELECT query_id, i, sent_ids, first_id,
         {answer('(CASE WHEN i % 2 = 0 THEN 0 ELSE 2 END)', 'first_id')} AS a
  FROM one WHERE code IS NOT NULL),"""
    + checked("turn2")
    .replace("parts AS", "parts2 AS")
    .replace("FROM parts)", "FROM parts2)")
    .replace("checked AS", "checked2 AS")
    .replace("FROM checked)", "FROM checked2)")
    .replace("explained AS", "explained2 AS")
    + f""", final AS (
  SELECT r.query_id,
    CASE WHEN r.i % 31 = 0 THEN 'invalid_issue' WHEN r.i % 29 = 0 THEN 'invalid_top_k'
         WHEN NOT g.gate_open THEN 'abstained' WHEN r.i % 41 = 0 THEN 'generator_unavailable'
         WHEN r.i % 37 = 0 THEN 'invalid_model_response' WHEN one.code IS NULL THEN 'answered'
         WHEN e2.code IS NULL THEN 'repaired' ELSE 'invalid_model_response' END AS status,
    CASE WHEN NOT g.gate_open THEN {text(ABSTAIN_TEXT)} WHEN one.query_id IS NULL THEN NULL
         WHEN one.code IS NULL THEN one.a WHEN e2.code IS NULL THEN e2.a END AS answer,
    e2.code AS code2, coalesce(g.gate_open, false) AS evidence_sufficient,
    coalesce(g.evidence_ids, '') AS evidence_ids, coalesce(g.sent_ids, '') AS sent_ids,
    CAST(CASE WHEN g.query_id IS NULL OR NOT g.gate_open THEN 0 WHEN one.code IS NULL THEN 1
              ELSE 2 END AS BIGINT) AS attempts
  FROM requests r LEFT JOIN gated g USING (query_id) LEFT JOIN one USING (query_id)
  LEFT JOIN explained2 e2 USING (query_id)),
resolved AS (
  SELECT query_id, status,
    CASE WHEN status IN ('abstained', 'answered', 'repaired') THEN NULL
         ELSE coalesce(code2, status) END AS reason_code,
    answer, evidence_sufficient, evidence_ids, sent_ids, attempts FROM final)
"""
)
# Every step is computed once: inlined, the two passes over the answer texts multiply.
for _step in ("pairs", "tickets", "requests", "longest", "ranked", "tops", "gated", "turn1", "parts", "checked", "explained",
              "one", "turn2", "parts2", "checked2", "explained2", "final", "resolved"):
    RESOLVE = re.sub(rf"\b{_step} AS \(", f"{_step} AS MATERIALIZED (", RESOLVE)
RESOLVED = RESOLVE + " SELECT * FROM resolved"

ORACLE = {
    "retrieve_topk_dense": BASE + TOP,
    "retrieve_topk_cells": BASE + TOP,
    "retrieve_topk_tree": BASE + TOP,
    "retrieve_cosine": COSINE_BASE + TOP,
    "retrieve_ivf": BASE + TOP,
    "ivf_recall": BASE
    + "SELECT count(*) AS n_expected, true AS recall_reached, true AS few_cells FROM ranked",
    "ranked_listing": BASE
    + """SELECT query_id, rank, ticket_id, product, round(s, 3) AS similarity_score, issue, resolution
    FROM ranked""",
    "gate_and_select": GATE
    + f"""SELECT query_id, {ROUTE} AS route, gate_open AS evidence_sufficient,
       round(best, 6) AS top_score, evidence_ids, sent_ids FROM gated""",
    "eval_cases": EVAL
    + """SELECT id, category,
       CASE WHEN supported AND NOT gate_open THEN 'FALSE_ABSTENTION' WHEN supported AND rr > 0
            THEN 'PASS' WHEN supported THEN 'MISS' WHEN gate_open THEN 'REVIEW' ELSE 'PASS' END
         AS outcome,
       coalesce(expected_ticket_id, 'abstain') AS expected, coalesce(first_id, 'none') AS top_result,
       round(best, 6) AS top_score, supported, gate_open, round(rr, 6) AS reciprocal_rank, query
       FROM results""",
    "eval_summary": SUMMARY.format(more=""),
    "eval_from_index": SUMMARY.format(more=""),
    "eval_by_category": EVAL
    + """SELECT category, round(avg(rr), 6) AS mrr, count(*) AS n_cases FROM results WHERE supported
       GROUP BY category""",
    "eval_check": SUMMARY.format(
        more=""", supported_count > 0 AND unsupported_count > 0 AND recall = 1.0 AND mrr >= 0.25
       AND supported_false_abstentions = 0 AND unsupported_correct = unsupported_count AS passed"""
    ),
    "evidence_text": GATE
    + f"SELECT query_id, all_text, sent_text, {text(NO_TICKETS_TEXT)} AS no_text FROM gated",
    "prompt_messages": GATE + f"SELECT query_id, {PROMPT} AS messages FROM gated",
    "repair_messages": ANSWERS
    + f"""SELECT query_id, {PROMPT} || chr(10) || '----' || chr(10) || 'assistant: ' || a || chr(10)
       || '----' || chr(10) || 'user: Rewrite your answer from the same tickets only. Problem found: '
       || detail || ' Reply with the four headings and their text, nothing else.' AS messages
       FROM explained WHERE code IS NOT NULL""",
    "abstain_answers": GATE
    + f"SELECT query_id, {text(ABSTAIN_TEXT)} AS answer FROM gated WHERE NOT gate_open",
    "answer_sections": ANSWERS
    + """SELECT query_id, p1 AS likely_cause, p2 AS suggested_resolution, p3 AS ticket_ids,
       p4 AS limitations FROM explained""",
    "citations": ANSWERS
    + """SELECT query_id, c AS ticket_id, NOT list_contains(string_split(sent_ids, ','), c) AS unknown
       FROM (SELECT query_id, sent_ids, unnest(cited) AS c FROM explained)""",
    "grounding_check": ANSWERS + "SELECT query_id, code, detail FROM explained",
    "retrieval_text": CHAT_DOCUMENTS,
    "ticket_violations": BROKEN_TICKETS + TICKET_RULES,
    "case_violations": BROKEN_CASES + CASE_RULES,
    "issue_status": ISSUE_STATUS,
    "tickets_csv": CHATS + "SELECT ticket_id, product, issue, resolution FROM chats",
    "cases_json": """SELECT CAST(item_id AS VARCHAR) AS id, 'passage' AS category, text AS query,
       CASE WHEN item_id % 2 = 0 THEN CAST(item_id AS VARCHAR) END AS expected_ticket_id
       FROM benchmark""",
    "index_roundtrip": CHAT_DOCUMENTS,
    "index_status": CHATS
    + """SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS n_tickets,
       'built' AS which FROM chats
       UNION ALL SELECT 'unavailable', 'index_unavailable', 0, 'missing'""",
    "index_versions": CHATS
    + """SELECT step, CAST(version AS BIGINT) AS version, CAST(n * times AS BIGINT) AS n_tickets
       FROM (SELECT count(*) AS n FROM chats), (VALUES ('built', 1, 1), ('kept', 1, 1), ('reset', 2, 2))
       AS s(step, version, times)""",
    "lexical_weights": DOC_WEIGHTS + "SELECT ticket_id, term, round(weight, 6) AS weight FROM dw",
    "lexical_topk": LEXICAL + LEXICAL_TOP,
    "lexical_topk_blocks": LEXICAL + LEXICAL_TOP,
    "lexical_retrieve": CHAT_LEXICAL,
    "embed_topk": EMBED,
    "resolve_batch": RESOLVED,
    "resolve_from_answers": RESOLVED,
    "resolve_stream": RESOLVED,
    "response_rows": RESOLVE
    + "SELECT query_id, status, answer, evidence_sufficient, evidence_ids FROM resolved",
    "stream_metrics": RESOLVE
    + """, again AS (SELECT count(*) FILTER (i % 7 = 0) + 1 AS n FROM requests)
       SELECT CAST(count(*) + any_value(again.n) AS BIGINT) AS n_rows, count(*) FILTER (status = 'answered') AS n_answered,
         count(*) FILTER (status = 'repaired') AS n_repaired, count(*) FILTER (status = 'abstained') AS n_abstained,
         CAST(count(*) FILTER (status IN ('invalid_issue', 'invalid_top_k')) + any_value(again.n) AS BIGINT) AS n_invalid_input,
         count(*) FILTER (status IN ('invalid_model_response', 'generator_unavailable')) AS n_failed,
         CAST(sum(attempts) AS BIGINT) AS n_generator_calls
       FROM resolved, again""",
    "run_metrics": RESOLVE
    + """SELECT status, count(*) AS n_rows, CAST(sum(attempts) AS BIGINT) AS n_generator_calls
       FROM resolved GROUP BY status""",
}

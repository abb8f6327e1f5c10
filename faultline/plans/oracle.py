"""DuckDB SQL for the registered queries, over the same Parquet tables.

Fragments are strings so that every query stays one self-contained statement.
"""

from __future__ import annotations

from faultline.functions import detect, text
from faultline.operators import evaluation, governance, questions
from faultline.sources.warehouse import (
    AS_OF,
    LOG_LINE_SQL,
    ORDERS_AS_OF,
    QUESTION_SQL,
    REQUEST_TOOL_SQL,
    RESPONSE_SQL,
)

ORACLE: dict[str, str] = {}
ORACLE_PARTS: dict[str, tuple[list[str], str]] = {}

NOW, ORDERS_NOW = f"TIMESTAMP '{AS_OF}'", f"TIMESTAMP '{ORDERS_AS_OF}'"
K = "CAST(regexp_extract(props, '[0-9]+') AS INT)"
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+"
ISO = "%Y-%m-%dT%H:%M:%S.%f"


def _in(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _any(column: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{n}')" for n in needles) + ")"


def eval_flag(line: str = "log_line") -> str:
    return _any(f"upper({line})", detect.EVAL_KEYWORDS)


def ingest_flag(line: str = "log_line") -> str:
    return _any(f"upper({line})", detect.INGEST_KEYWORDS)


def monitor_flag(line: str = "log_line") -> str:
    return _any(line, detect.MONITOR_KEYWORDS)


def intended_flag(line: str = "log_line") -> str:
    return _any(f"lower({line})", [w.lower() for w in detect.INTENDED_KEYWORDS])


def tokens(line: str) -> str:
    return f"list_filter(string_split_regex({line}, '{WS}'), lambda t: t <> '')"


def masked(line: str) -> str:
    return (
        f"list_transform({tokens(line)}, lambda t: CASE WHEN regexp_matches(t, '{text.NUMBER_SHAPE}') THEN '<NUM>' "
        f"WHEN regexp_matches(t, '{text.IP_SHAPE}') THEN '<IP>' WHEN regexp_matches(t, '{text.HEX_SHAPE}') THEN '<HEX>' "
        "WHEN contains(t, '/') OR contains(t, chr(92)) THEN '<PATH>' ELSE t END)"
    )


def template(line: str) -> str:
    return f"array_to_string(list_transform({masked(line)}, lambda t: substring(t, 1, 8)), ' ')"


def stable_id(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 15) AS BIGINT)"


def words(line: str) -> str:
    return (
        f"list_filter(string_split_regex(lower({line}), '[^\\p{{L}}\\p{{N}}_]+'), "
        "lambda w: regexp_matches(w, '^[a-z]{3,}$'))"
    )


def keywords(line: str) -> str:
    return f"list_filter({words(line)}, lambda w: w NOT IN ({_in(text.STOP_WORDS)}))"


def diagnosis(line: str) -> str:
    return (
        f"CASE WHEN contains({line}, 'Port 80') THEN '{detect.PORT_DIAGNOSIS}' "
        f"WHEN contains({line}, 'timeout') THEN '{detect.TIMEOUT_DIAGNOSIS}' ELSE '{detect.OTHER_DIAGNOSIS}' END"
    )


def diagnosed_action(line: str) -> str:
    return f"CASE WHEN contains({line}, 'Port 80') THEN 'RESTART_APACHE' ELSE 'ESCALATE' END"


def seconds(start: str, end: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / 1e6)"


def hours_ago(hours: str | int, now: str = NOW) -> str:
    return f"({now} - to_hours({hours}))"


LOGS = f"""logs AS (SELECT event_id AS log_id, ts AS "timestamp", {LOG_LINE_SQL} AS log_line,
  CAST(value > 20 AS INT) AS is_anomaly, user_id FROM events)"""

TEMPLATED = f"""{LOGS}, templated AS (SELECT *, {stable_id('template_pattern')} AS template_id
  FROM (SELECT *, {template('log_line')} AS template_pattern FROM logs))"""

INCIDENTS = f"""raw_incidents AS (SELECT event_id AS incident_id,
    ts + to_seconds(CAST(floor(value) AS BIGINT)) AS detected_at, {LOG_LINE_SQL} AS log_line, {K} AS k, user_id FROM events),
  incidents AS (SELECT incident_id, detected_at, CASE WHEN k < 59 THEN detected_at + to_minutes(k) END AS resolved_at,
    log_line, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN '' ELSE {diagnosis('log_line')} END AS summary,
    CASE WHEN k < 60 THEN 'resolved' WHEN k < 80 THEN 'open' ELSE 'escalated' END AS status, user_id
    FROM raw_incidents WHERE {ingest_flag()})"""
INCIDENT_COLUMNS = "incident_id, detected_at, resolved_at, log_line, summary, status"

ORDER_INCIDENTS = """order_incidents AS (SELECT o_orderkey AS incident_id, o_orderdate AS detected_at,
  CAST(NULL AS TIMESTAMP) AS resolved_at, o_orderpriority AS log_line, CAST(NULL AS VARCHAR) AS summary,
  CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'open' ELSE 'escalated' END AS status FROM orders)"""

ACTIONS = f"""actions AS (SELECT
  {stable_id("l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey")} AS action_id,
  l_orderkey AS incident_id,
  CASE WHEN l_linenumber < 3 THEN 'RESTART_APACHE' WHEN l_linenumber < 5 THEN 'CLEAR_TEMP_CACHE' ELSE 'ESCALATE' END AS action_name,
  l_shipdate AS executed_at,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'executed' WHEN l_returnflag = 'A' THEN 'approved'
    WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'failed' WHEN l_returnflag = 'N' THEN 'pending'
    ELSE 'rejected' END AS status FROM lineitem)"""

LINES = """lines AS (SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INT) AS line_no, unnest(parts) AS log_line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""

SUMMARIES = """summaries AS (SELECT u.text AS log_line, a.text AS summary FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""

QUESTIONS = f"""questions AS (SELECT conv_id, turn, {QUESTION_SQL} AS question FROM conversations WHERE role = 'user')"""

RESPONSES = f"""responses AS (SELECT event_id AS log_id, {LOG_LINE_SQL} AS log_line, {RESPONSE_SQL} AS response FROM events)"""

REQUESTS = f"""{INCIDENTS}, requests AS (SELECT incident_id AS request_id, {REQUEST_TOOL_SQL} AS tool_name, incident_id,
  CASE user_id % 7 WHEN 3 THEN 'path' WHEN 4 THEN 'depth' END AS param, detected_at AS requested_at FROM incidents)"""

DECISIONS = f"""decisions AS (SELECT event_id AS request_id, {K} < 35 AS approved,
  'operator_' || CAST(user_id % 3 AS VARCHAR) AS approved_by FROM events WHERE {K} < 50)"""

# The second, earlier reports of some requests never count.
OUTCOMES = f"""outcomes AS (SELECT event_id AS request_id, ts + to_minutes(k % 60 + 1) AS executed_at,
  CASE WHEN k % 5 < 2 THEN 'executed' WHEN k % 5 = 2 THEN 'failed' WHEN k % 5 = 3 THEN 'timeout' ELSE 'lost' END AS outcome,
  CASE WHEN k % 2 = 0 THEN 'exit ' || k ELSE '' END AS output FROM (SELECT *, {K} AS k FROM events) WHERE k % 7 <> 0)"""

POLICY = """policy(action_name, risk_level, requires_approval, description) AS (VALUES
  ('RESTART_APACHE', 'HIGH', TRUE, 'Restart Apache web server - may cause service interruption'),
  ('CLEAR_TEMP_CACHE', 'LOW', FALSE, 'Clear temporary cache files - low risk operation'),
  ('ESCALATE', 'MEDIUM', FALSE, 'Escalate incident to human operator - no automated action'))"""

TOOLS = """tools(name, description, required, risk_level, requires_approval) AS (VALUES
  ('RESTART_APACHE', 'Restart Apache web server', '', 'HIGH', TRUE),
  ('CLEAR_TEMP_CACHE', 'Clear temporary cache', '', 'LOW', FALSE),
  ('ESCALATE', 'Escalate to human operator', '', 'MEDIUM', FALSE),
  ('ROTATE_LOGS', 'Rotate the logs under a path', 'path', 'LOW', FALSE))"""


def put(name: str, ctes: list[str], body: str) -> None:
    prefix = f"WITH {', '.join(ctes)} " if ctes else ""
    ORACLE[name] = prefix + body
    ORACLE_PARTS[name] = ctes, body


LOG_COLUMNS = 'log_id, "timestamp", log_line, is_anomaly'

# -- sources and sinks
_iso_ts = f"strftime(\"timestamp\", '{ISO}')"
put("load_logs_csv", [LOGS], f"SELECT log_line, is_anomaly, {_iso_ts} AS timestamp FROM logs")
put("load_logs_json", [LOGS], f"""SELECT log_line, is_anomaly,
  CASE WHEN is_anomaly = 1 THEN {_iso_ts} ELSE '{AS_OF}' END AS timestamp FROM logs""")
put("load_logs", [LOGS], f"SELECT log_line, is_anomaly, '{AS_OF}' AS timestamp FROM logs")
put("load_logs_documents", [LOGS], f"""SELECT row_number() OVER (ORDER BY "timestamp") - 1 AS log_id, log_line, is_anomaly,
  CASE WHEN is_anomaly = 1 THEN {_iso_ts} ELSE '{AS_OF}' END AS timestamp FROM logs""")
put("load_logs_in_order", [LOGS], f"""SELECT row_number() OVER (ORDER BY "timestamp", log_line) - 1 AS log_id, log_line, is_anomaly, {_iso_ts} AS timestamp FROM logs""")
put("stored_logs", [LOGS], f"""SELECT CAST("timestamp" AS DATE) AS log_date, count(*) AS logs, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
  min(log_id) AS first_id, max(log_id) AS last_id FROM logs WHERE CAST("timestamp" AS DATE) >= CAST({NOW} AS DATE) - 7 GROUP BY 1""")
put("dataset_limit", [LOGS], f"SELECT {LOG_COLUMNS} FROM logs ORDER BY log_id LIMIT 1000")
put("ingest_batch", [LINES], f"""SELECT doc_id, line_no, log_line, CAST({ingest_flag()} AS INT) AS is_anomaly,
  template_pattern, {stable_id('template_pattern')} AS template_id FROM (
    SELECT doc_id, line_no, log_line, {template('log_line')} AS template_pattern FROM (
      SELECT doc_id, line_no, regexp_replace(log_line, '^{WS}|{WS}$', '', 'g') AS log_line FROM lines) WHERE log_line <> '')""")
put("open_incidents_from_logs", [LOGS], f"""SELECT log_id AS incident_id, "timestamp" AS detected_at,
  CAST(NULL AS TIMESTAMP) AS resolved_at, log_line, {diagnosis('log_line')} AS summary, 'open' AS status
  FROM logs WHERE {ingest_flag()}""")
put("apply_resolutions", [ORDER_INCIDENTS], """SELECT i.incident_id, detected_at, r.at AS resolved_at, log_line, summary,
  CASE WHEN r.at IS NOT NULL THEN 'resolved' ELSE status END AS status FROM order_incidents i LEFT JOIN (
    SELECT l_orderkey AS incident_id, max(l_shipdate) AS at FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) r
  ON r.incident_id = i.incident_id""")
put("attach_embeddings", [LOGS], """SELECT log_id, log_line, CAST(len(embedding) AS INT) AS dim,
  round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM logs LEFT JOIN embeddings ON vec_id = log_id""")
put("policy_dim", [REQUESTS, POLICY], """SELECT p.action_name, risk_level, requires_approval, description,
  coalesce(n, 0) AS requests FROM policy p LEFT JOIN (SELECT tool_name, count(*) AS n FROM requests GROUP BY 1) r
  ON r.tool_name = p.action_name""")
put("tool_dim", [REQUESTS, TOOLS], """SELECT name, description, required, risk_level, requires_approval,
  coalesce(n, 0) AS requests FROM tools t LEFT JOIN (SELECT tool_name, count(*) AS n FROM requests GROUP BY 1) r
  ON r.tool_name = t.name""")

# -- detection and filters
for _name, _flag in [
    ("detect_ingest", ingest_flag()), ("detect_eval", eval_flag()),
    ("detect_monitor", monitor_flag()), ("detect_intended", intended_flag()),
]:
    put(_name, [LOGS], f"SELECT {LOG_COLUMNS} FROM logs WHERE {_flag}")

_week = f"detected_at >= {hours_ago(168)}"
_log_week = f'"timestamp" >= {hours_ago(168)}'
put("incidents_window", [INCIDENTS], f"SELECT {INCIDENT_COLUMNS} FROM incidents WHERE {_week} ORDER BY detected_at DESC, incident_id")
put("open_incidents", [INCIDENTS], f"SELECT {INCIDENT_COLUMNS} FROM incidents WHERE status = 'open' ORDER BY detected_at DESC, incident_id")
put("incidents_by_ids", [INCIDENTS], f"SELECT {INCIDENT_COLUMNS} FROM incidents WHERE incident_id IN (SELECT doc_id FROM labels)")
put("errors_window", [INCIDENTS], f"SELECT {INCIDENT_COLUMNS} FROM incidents WHERE {_week} AND {eval_flag()} ORDER BY detected_at DESC, incident_id")
put("logs_by_template", [TEMPLATED], f"""SELECT {LOG_COLUMNS}, template_pattern, template_id FROM templated WHERE {_log_week}
  AND template_id = (SELECT template_id FROM templated GROUP BY template_id, template_pattern ORDER BY count(*) DESC, template_pattern LIMIT 1)""")
_newest = 'ORDER BY "timestamp" DESC, log_id LIMIT 100'


def has_keyword(word: str) -> str:
    return f"len(list_filter({keywords('log_line')}[1:20], lambda k: k LIKE '%{word}%')) > 0"


put("search_substring", [LOGS], f"SELECT {LOG_COLUMNS} FROM logs WHERE {_log_week} AND log_line ILIKE '%port 80 is_in%' {_newest}")
put("search_keyword", [LOGS], f"SELECT {LOG_COLUMNS} FROM logs WHERE {_log_week} AND {has_keyword('conn')} {_newest}")
put("search_logs", [LOGS], f"""SELECT * FROM (SELECT {LOG_COLUMNS}, 'nginx' AS pattern FROM logs
    WHERE {_log_week} AND {has_keyword('nginx')} {_newest})
  UNION ALL SELECT * FROM (SELECT {LOG_COLUMNS}, 'login attempt' AS pattern FROM logs
    WHERE {_log_week} AND log_line ILIKE '%login attempt%' {_newest})""")
put("search_indexed", [LOGS], " UNION ALL ".join(
    f"SELECT * FROM (SELECT {LOG_COLUMNS}, '{p}' AS pattern FROM logs WHERE {_log_week} AND {has_keyword(p) if p.replace('_', '').isalnum() else like} {_newest})"
    for p, like in [("conn", ""), ("ti_eout", ""), ("%port 80 is_in", "log_line ILIKE '%port 80 is_in%'"),
                    ("C:\\svc", "contains(lower(log_line), 'c:\\svc')"), ("5 m", "contains(lower(log_line), '5 m')")]))
put("suspicious_events", [LOGS], f"SELECT {LOG_COLUMNS} FROM logs WHERE {_log_week} AND {has_keyword('auth')} {_newest}")
put("incident_listing", [INCIDENTS], "SELECT incident_id, detected_at, status, substring(summary, 1, 50) AS summary FROM incidents")
put("constraint_violations", [TEMPLATED, INCIDENTS, ACTIONS], """
  SELECT 'incidents' AS table_name, 'detected_at_null' AS rule, count(*) FILTER (detected_at IS NULL) AS violations FROM incidents
  UNION ALL SELECT 'incidents', 'log_line_null', count(*) FILTER (log_line IS NULL) FROM incidents
  UNION ALL SELECT 'incidents', 'status_value', count(*) FILTER (status NOT IN ('open', 'resolved', 'escalated')) FROM incidents
  UNION ALL SELECT 'incidents', 'resolved_without_time', count(*) FILTER (status = 'resolved' AND resolved_at IS NULL) FROM incidents
  UNION ALL SELECT 'actions', 'action_name_null', count(*) FILTER (action_name IS NULL) FROM actions
  UNION ALL SELECT 'actions', 'executed_at_null', count(*) FILTER (executed_at IS NULL) FROM actions
  UNION ALL SELECT 'actions', 'status_value', count(*) FILTER (status NOT IN ('pending', 'executed', 'approved', 'rejected', 'failed')) FROM actions
  UNION ALL SELECT 'logs', 'timestamp_null', count(*) FILTER ("timestamp" IS NULL) FROM logs
  UNION ALL SELECT 'logs', 'log_line_null', count(*) FILTER (log_line IS NULL) FROM logs
  UNION ALL SELECT 'templates', 'pattern_unique', count(*) FROM (
    SELECT template_pattern FROM templated WHERE {FLAG} INTERSECT SELECT template_pattern FROM templated WHERE is_anomaly = 0)""".replace("{FLAG}", ingest_flag()))
put("orphan_rows", [TEMPLATED], f"""
  SELECT 'actions.incident_id' AS relation, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'logs.template_id', count(*) FROM templated
    WHERE template_id NOT IN (SELECT template_id FROM templated WHERE {ingest_flag()})
  UNION ALL SELECT 'lexical_index.log_id', CAST(sum(len({keywords('o_orderpriority')}[1:20])) AS BIGINT) FROM orders
    WHERE o_orderkey NOT IN (SELECT log_id FROM templated)""")

# -- joins
FIRST = "first_of_line AS (SELECT log_line, min(log_id) AS log_id, arg_min(template_id, log_id) AS template_id FROM templated GROUP BY 1)"
INCIDENT_TEMPLATE = "incident_template AS (SELECT incident_id, f.template_id FROM incidents JOIN first_of_line f USING (log_line))"
put("incident_template", [TEMPLATED, INCIDENTS, FIRST, INCIDENT_TEMPLATE], "SELECT * FROM incident_template")
put("template_correlation", [TEMPLATED, INCIDENTS, FIRST, INCIDENT_TEMPLATE], f"""SELECT template_id, log_id, "timestamp", log_line, n_incidents
  FROM templated JOIN (SELECT template_id, count(*) AS n_incidents FROM incident_template GROUP BY 1) USING (template_id) WHERE {_log_week}""")
ERROR = """CASE WHEN t.name IS NULL THEN 'Unknown tool: ' || r.tool_name
  WHEN t.required <> '' AND coalesce(r.param, '') <> t.required THEN 'Missing required parameter: ' || t.required END"""
put("validate_actions", [REQUESTS, TOOLS], f"""SELECT request_id, tool_name, error IS NULL AS is_valid, error FROM (
  SELECT r.*, {ERROR} AS error FROM requests r LEFT JOIN tools t ON t.name = r.tool_name)""")
EXEMPLARS = "exemplars AS (SELECT label, arg_min(embedding, vec_id) AS target FROM embeddings GROUP BY 1)"


def cosine(a: str, b: str, digits: int) -> str:
    return f"round(list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), {digits})"


put("cosine", [EXEMPLARS], f"""SELECT vec_id AS log_id, CAST(label AS BIGINT) AS label,
  {cosine('embedding', 'target', 6)} AS similarity FROM embeddings JOIN exemplars USING (label)""")
put("semantic_topk", [EXEMPLARS], f"""SELECT query_id, log_id, round(similarity, 6) AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, log_id DESC) AS INT) AS rank FROM (
    SELECT CAST(q.label AS BIGINT) AS query_id, vec_id AS log_id, {cosine('embedding', 'target', 9)} AS similarity
    FROM embeddings, exemplars q)) WHERE rank <= 10""")

put("semantic_topk_many", [], f"""SELECT query_id, log_id, round(similarity, 6) AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, log_id DESC) AS INT) AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id AS log_id, {cosine('e.embedding', 'q.embedding', 9)} AS similarity
    FROM embeddings e, embeddings q WHERE q.vec_id % 20 = 0)) WHERE rank <= 10""")
put("semantic_topk_indexed", [], "SELECT 10 * count(*) AS hits, TRUE AS recalled, TRUE AS exact_with_all FROM embeddings WHERE vec_id % 20 = 0")

# -- aggregates
put("incident_status_counts", [ORDER_INCIDENTS], "SELECT status, count(*) AS n FROM order_incidents GROUP BY 1")
put("action_status_counts", [ACTIONS], "SELECT status, count(*) AS n FROM actions GROUP BY 1")
_done = "status = 'resolved' AND resolved_at IS NOT NULL"
_recovery = seconds("detected_at", "resolved_at")
put("mttr", [INCIDENTS], f"SELECT round(avg({_recovery}), 4) AS mttr_seconds FROM incidents WHERE {_done}")
put("incident_recovery_seconds", [INCIDENTS], f"SELECT incident_id, {_recovery} AS mttr_seconds FROM incidents WHERE {_done}")
FIRST_TIME = 'first_time AS (SELECT log_line, arg_min("timestamp", log_id) AS seen_at FROM logs GROUP BY 1)'
_delay = seconds("seen_at", "detected_at")
put("mttd", [LOGS, INCIDENTS, FIRST_TIME], f"SELECT round(avg({_delay}), 4) AS mttd_seconds FROM incidents JOIN first_time USING (log_line)")
TABLE = """template_rows AS (SELECT template_pattern, count(*) AS frequency, min("timestamp") AS created_at,
  min(log_id) AS first_log_id, template_id FROM templated GROUP BY template_pattern, template_id)"""
put("template_table", [TEMPLATED, TABLE], "SELECT * FROM template_rows")
put("template_stats", [TEMPLATED, TABLE], """SELECT count(*) AS total_templates, CAST(coalesce(sum(frequency), 0) AS BIGINT) AS total_logs_parsed,
  4 AS tree_depth, 0.5::DOUBLE AS similarity_threshold FROM template_rows""")


def pattern_list(line: str) -> str:
    return f"""list_filter([CASE WHEN contains({line}, 'ERROR') THEN CASE
      WHEN contains({line}, 'Port') AND (contains({line}, '80') OR contains({line}, '443')) THEN 'port.*conflict'
      WHEN contains(lower({line}), 'timeout') THEN 'timeout'
      WHEN contains(lower({line}), 'connection') AND contains(lower({line}), 'failed') THEN 'connection.*failed'
      WHEN contains(lower({line}), 'permission denied') THEN 'permission.*denied' ELSE 'ERROR' END END,
    CASE WHEN contains({line}, 'CRITICAL') THEN 'CRITICAL' END], lambda p: p IS NOT NULL)"""


REGEX = "CASE pattern " + " ".join(f"WHEN '{p}' THEN '{r}'" for p, r in text.PATTERN_REGEX.items()) + " END"


def patterns(hours: int) -> str:
    return f"""patterns AS (SELECT pattern, frequency, {REGEX} AS regex FROM (SELECT pattern, count(*) AS frequency FROM (
      SELECT unnest({pattern_list('log_line')}) AS pattern FROM incidents WHERE detected_at >= {hours_ago(hours)}) GROUP BY 1)),
    rules AS (SELECT pattern, regex, CAST(greatest(1, frequency // 3) AS BIGINT) AS threshold,
      CASE WHEN contains(lower(pattern), 'port') OR contains(lower(pattern), 'timeout') THEN 'RESTART_APACHE' ELSE 'ESCALATE' END AS action,
      frequency FROM patterns ORDER BY frequency DESC, pattern LIMIT 5)"""


put("error_patterns", [INCIDENTS, patterns(168)], "SELECT * FROM patterns")
put("suggest_rules", [INCIDENTS, patterns(168)], "SELECT * FROM rules")


def confusion(flag: str, truth: str) -> str:
    return f"""SELECT count(*) AS total_logs, count(*) FILTER ({truth}) AS true_anomalies,
      count(*) FILTER ({flag} AND {truth}) AS tp, count(*) FILTER ({flag} AND NOT ({truth})) AS fp,
      count(*) FILTER (NOT {flag} AND {truth}) AS fn, count(*) FILTER (NOT {flag} AND NOT ({truth})) AS tn FROM logs"""


def scores(flag: str, truth: str) -> str:
    return f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score
      FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) * 100 ELSE 0 END AS precision,
        CASE WHEN true_anomalies > 0 THEN tp / true_anomalies * 100 ELSE 0 END AS recall FROM ({confusion(flag, truth)}))"""


_label = "is_anomaly = 1"
put("confusion", [LOGS], confusion(eval_flag(), _label))
put("detection_metrics", [LOGS], " UNION ALL ".join(
    f"SELECT *, '{n}' AS detector FROM ({scores(f, _label)})"
    for n, f in [("eval", eval_flag()), ("ingest", ingest_flag()), ("monitor", monitor_flag()), ("intended", intended_flag())]
))
put("detector_agreement", [LOGS], f"SELECT *, recall AS accuracy FROM ({scores(eval_flag(), monitor_flag())})")
put("latency_summary", [], "SELECT round(avg(value / 10), 6) AS average, min(value / 10) AS min, max(value / 10) AS max, count(*) AS iterations FROM events")
put("summary_coverage", [INCIDENTS], f"""SELECT *, CASE WHEN total_incidents > 0 THEN round(with_summary / total_incidents * 100, 2) ELSE 0 END AS coverage
  FROM (SELECT count(*) AS total_incidents, count(*) FILTER (coalesce(summary, '') <> '') AS with_summary FROM incidents WHERE {_week})""")
_relevant = " OR ".join(f"(contains(line, '{w}') AND contains(said, '{w}'))" for w in evaluation.IMPORTANT_WORDS)
put("summary_quality", [SUMMARIES], f"""SELECT n AS total_summaries, round(len, 2) AS avg_length, round(cov, 2) AS keyword_coverage,
  round(least(100, len / 50 * 50 + cov * 0.5), 2) AS informativeness_score FROM (
    SELECT count(*) AS n, coalesce(avg(length(said)), 0) AS len,
      CASE WHEN count(*) > 0 THEN count(*) FILTER ({_relevant}) / count(*) * 100 ELSE 0 END AS cov FROM (
        SELECT lower(substring(log_line, 1, 100)) AS line, lower(summary) AS said FROM summaries))""")


def usefulness(incident_table: str, since: str) -> str:
    return f"""SELECT total_incidents, CASE WHEN total_incidents > 0 THEN a ELSE 0 END AS total_actions,
  CASE WHEN total_incidents > 0 THEN i ELSE 0 END AS distinct_incidents, CASE WHEN total_incidents > 0 THEN u ELSE 0 END AS useful_actions,
  CASE WHEN total_incidents > 0 AND a > 0 THEN u / a * 100 ELSE 0 END AS usefulness_rate FROM (
    SELECT count(*) AS a, count(DISTINCT incident_id) AS i, count(*) FILTER (incident_id IN (
        SELECT incident_id FROM {incident_table} WHERE status = 'resolved')) AS u
      FROM (SELECT * FROM actions ORDER BY executed_at DESC, action_id LIMIT 100)),
    (SELECT count(*) AS total_incidents FROM {incident_table} WHERE detected_at >= {since})"""


put("action_usefulness", [ORDER_INCIDENTS, ACTIONS], usefulness("order_incidents", hours_ago(720, ORDERS_NOW)))
put("log_totals", [LOGS], "SELECT count(*) AS total_logs, CAST(coalesce(sum(is_anomaly), 0) AS BIGINT) AS total_anomalies FROM logs")
put("evaluate_rules", [LOGS, INCIDENTS, patterns(168)], """SELECT *, matches >= threshold AS fires FROM (
  SELECT rules.*, (SELECT count(*) FROM (SELECT log_line FROM logs ORDER BY log_id DESC LIMIT 1000) WHERE regexp_matches(log_line, regex)) AS matches FROM rules)""")


def advice(hours: int) -> str:
    counted = " UNION ALL ".join(
        f"""SELECT '{s}' AS service, least(count(*), 100) AS matching_logs FROM logs
        WHERE "timestamp" >= {hours_ago(hours)} AND {has_keyword(s)}""" for s in questions.SERVICES
    )
    return f"""SELECT service, matching_logs, CASE WHEN matching_logs >= 3 THEN 'YES' ELSE 'NO' END AS recommendation,
      CASE WHEN matching_logs = 0 THEN 'No recent errors found for ' || service || '. Service appears healthy.'
      ELSE 'Found ' || matching_logs || ' error(s) in the last {"hour" if hours == 1 else f"{hours} hours"}' END AS reason FROM ({counted})"""


put("restart_advice", [LOGS], advice(24))
put("metrics_summary", [LOGS, INCIDENTS, FIRST_TIME, ACTIONS], f"""SELECT round(d, 4) AS mttd_seconds,
  CASE WHEN d IS NULL THEN 'N/A' ELSE printf('%.2fs', d) END AS mttd_formatted, round(r, 4) AS mttr_seconds,
  CASE WHEN r IS NULL THEN 'N/A' ELSE printf('%.2fs', r) END AS mttr_formatted,
  CASE WHEN r IS NULL THEN 'N/A' ELSE printf('%.2f minutes', r / 60) END AS mttr_formatted_minutes,
  total_incidents, open_incidents, resolved_incidents, escalated_incidents, total_actions, action_breakdown
  FROM (SELECT avg({_delay}) AS d FROM incidents JOIN first_time USING (log_line)),
    (SELECT avg({_recovery}) FILTER ({_done}) AS r, count(*) AS total_incidents, count(*) FILTER (status = 'open') AS open_incidents,
      count(*) FILTER (status = 'resolved') AS resolved_incidents, count(*) FILTER (status = 'escalated') AS escalated_incidents FROM incidents),
    (SELECT CAST(sum(n) AS BIGINT) AS total_actions, string_agg(status || '=' || n, ',' ORDER BY status) AS action_breakdown
      FROM (SELECT status, count(*) AS n FROM actions GROUP BY 1))""")
put("recent_actions", [ACTIONS], "SELECT * FROM actions ORDER BY executed_at DESC, action_id LIMIT 10")

# -- text
put("mask_tokens", [LINES], f"SELECT doc_id, line_no, array_to_string({masked('log_line')}, ' ') AS masked FROM lines")
put("stateless_template", [LINES], f"SELECT doc_id, line_no, {template('log_line')} AS template FROM lines")
put("template_jaccard", [LOGS, f"m AS (SELECT log_id, {masked('log_line')} AS m FROM logs)", "l AS (SELECT *, array_to_string(m[1:4], chr(10)) AS leaf FROM m)"],
    """SELECT log_id, CASE WHEN u = 0 THEN 1 ELSE round(i / u, 6) END AS similarity FROM (
      SELECT log_id, len(list_intersect(m, f)) AS i, len(list_distinct(list_concat(m, f))) AS u
      FROM l JOIN (SELECT leaf, arg_min(m, log_id) AS f FROM l GROUP BY 1) USING (leaf))""")
put("keywords", [LINES], f"SELECT doc_id, line_no, array_to_string({keywords('log_line')}, ' ') AS keywords FROM lines")
put("lexical_index", [LINES, f"kw AS (SELECT doc_id, line_no, {keywords('log_line')}[1:20] AS ks FROM lines)"],
    "SELECT doc_id AS log_id, line_no, unnest(ks) AS keyword, CAST(generate_subscripts(ks, 1) - 1 AS INT) AS position FROM kw")
put("classify_pattern", [LOGS], f"SELECT log_id, array_to_string({pattern_list('log_line')}, '|') AS patterns FROM logs")
put("diagnose", [LOGS], f"SELECT log_id, {diagnosis('log_line')} AS summary, {diagnosed_action('log_line')} AS action FROM logs WHERE {monitor_flag()}")
PARSED = """parsed AS (SELECT log_id, log_line, CASE WHEN json_valid(response) THEN json_extract_string(response, '$.summary') END AS s,
  CASE WHEN json_valid(response) THEN json_extract_string(response, '$.action') END AS a FROM responses)"""
put("parse_responses", [RESPONSES, PARSED], f"""SELECT log_id, s AS parsed_summary, a AS parsed_action,
  CASE WHEN coalesce(s, '') <> '' THEN s ELSE {diagnosis('log_line')} END AS summary,
  CASE WHEN coalesce(s, '') <> '' THEN a ELSE {diagnosed_action('log_line')} END AS action FROM parsed""")
put("advice_from_response", [RESPONSES, PARSED], f"""SELECT log_id, CASE WHEN {eval_flag()} THEN
    CASE WHEN contains(lower(coalesce(s, '')), 'restart') OR contains(coalesce(a, ''), 'RESTART') THEN 'YES' ELSE 'NO' END
  WHEN contains(lower(coalesce(s, '')), 'no') THEN 'NO' ELSE 'CHECK' END AS recommendation FROM parsed""")
ROUTED = f"""worded AS (SELECT *, lower(question) AS q, {tokens('lower(question)')} AS ws FROM questions),
  numbered AS (SELECT *, list_transform(list_filter(list_transform(ws, lambda w, i: CASE WHEN w = 'last' AND i < len(ws) THEN ws[i + 1] END),
      lambda w: w IS NOT NULL), lambda w: TRY_CAST(w AS INT)) AS ns FROM worded),
  routed AS (SELECT conv_id, turn, CASE WHEN contains(q, 'summarize') AND contains(q, 'error') THEN 'error_summary'
      WHEN contains(q, 'suspicious') AND contains(q, 'auth') THEN 'suspicious_events'
      WHEN contains(q, 'should') AND contains(q, 'restart') THEN 'restart_advice'
      WHEN contains(q, 'open') AND contains(q, 'incident') THEN 'open_incidents' ELSE 'unrecognized' END AS route,
    CASE WHEN contains(q, 'last hour') OR contains(q, 'last 1 hour') THEN 1
      WHEN contains(q, 'last 24 hours') OR contains(q, 'last day') THEN 24 WHEN contains(q, 'last week') THEN 168
      WHEN contains(q, 'last') AND contains(q, 'hour') THEN
        CASE WHEN len(ns) = 0 OR len(list_filter(ns, lambda n: n IS NULL)) > 0 THEN 1 ELSE ns[len(ns)] END ELSE 1 END AS hours,
    CASE WHEN contains(q, 'nginx') THEN 'nginx' ELSE 'apache' END AS service FROM numbered)"""
put("route_questions", [QUESTIONS, ROUTED], "SELECT * FROM routed")
put("build_prompts", [LOGS], f"""SELECT log_id, 'Incident line:' || chr(10) || log_line || chr(10) || chr(10) || 'Related log lines:' || chr(10) ||
  {diagnosis('log_line')} || chr(10) || chr(10) || 'State the root cause, the related events and the next remediation step.' AS prompt
  FROM logs WHERE {monitor_flag()}""")

# -- retrieval
INDEX = f"""kw AS (SELECT log_id, "timestamp", {keywords('log_line')}[1:20] AS ks FROM logs),
  idx AS (SELECT log_id, "timestamp", unnest(ks) AS keyword, CAST(generate_subscripts(ks, 1) - 1 AS INT) AS position FROM kw)"""
put("dedup_first_seen", [LOGS, INDEX], """SELECT log_id, "timestamp", keyword, position FROM (
  SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY "timestamp" DESC, log_id, position) AS rn FROM idx)
  WHERE rn = 1 ORDER BY "timestamp" DESC, log_id, position LIMIT 20""")
put("keyword_fallback", [LOGS, INDEX, QUESTIONS, f"""asked AS (SELECT request_id, w[p] AS word, CAST(p - 1 AS INT) AS position FROM (
    SELECT conv_id * 1000 + turn AS request_id, {words('question')}[1:3] AS w, unnest(generate_series(1, len({words('question')}[1:3]))) AS p FROM questions))""",
  f"""word_hits AS (SELECT word, log_id, "timestamp", row_number() OVER (PARTITION BY word ORDER BY "timestamp" DESC, log_id) AS rn FROM (
    SELECT DISTINCT word, log_id, "timestamp" FROM (SELECT DISTINCT word FROM asked) JOIN idx ON contains(keyword, word) WHERE {_log_week}))"""],
    """SELECT request_id, log_id, "timestamp", position FROM asked JOIN word_hits USING (word) WHERE rn <= 5""")
MERGE = """ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id, log_id ORDER BY similarity DESC, m, position) AS rn FROM hits),
  merged AS (SELECT request_id, log_id, "timestamp", similarity, retrieval_method,
    CAST(row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, m, position, "timestamp" DESC, log_id) AS INT) AS rank
    FROM ranked WHERE rn = 1)"""
put("hybrid_merge", ["""hits AS (SELECT l_suppkey AS request_id, l_partkey AS log_id,
    TIMESTAMP '1995-01-01 00:00:00' + to_minutes(l_partkey) AS "timestamp",
    CASE l_returnflag WHEN 'A' THEN 0.9::DOUBLE WHEN 'N' THEN l_discount + 0.85::DOUBLE ELSE 0.5::DOUBLE END AS similarity,
    CASE l_returnflag WHEN 'A' THEN 'template' WHEN 'N' THEN 'semantic' ELSE 'keyword' END AS retrieval_method,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS m,
    CASE l_returnflag WHEN 'R' THEN l_linenumber ELSE 0 END AS position FROM lineitem)""", MERGE], "SELECT * FROM merged WHERE rank <= 10")

EMBEDDED = """embedded AS (SELECT log_id, "timestamp", log_line, template_id, embedding FROM templated LEFT JOIN embeddings ON vec_id = user_id)"""
VECTOR_INCIDENTS = "vector_incidents AS (SELECT incidents.*, embedding FROM incidents LEFT JOIN embeddings ON vec_id = user_id)"
# Requests carry request_id, log_line, template_id, embedding, cutoff.
TEMPLATE_HITS = """template_hits AS (SELECT request_id, log_id, l."timestamp", 0.9::DOUBLE AS similarity, 'template' AS retrieval_method, 0 AS m, 0 AS position
    FROM asked_for r JOIN embedded l ON l.template_id = r.template_id AND l."timestamp" >= r.cutoff)"""


def hybrid(k: int) -> str:
    near = cosine("r.embedding", "l.embedding", 9)
    return f"""{TEMPLATE_HITS},
    scored AS (SELECT request_id, log_id, l."timestamp", {near} AS similarity FROM asked_for r JOIN embedded l
      ON l."timestamp" >= r.cutoff AND l.embedding IS NOT NULL AND r.embedding IS NOT NULL),
    semantic_hits AS (SELECT request_id, log_id, "timestamp", similarity, 'semantic' AS retrieval_method, 1 AS m, 0 AS position FROM scored
      QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, "timestamp" DESC, log_id) <= {k}),
    hits AS (SELECT * FROM template_hits UNION ALL SELECT * FROM semantic_hits),
    {MERGE},
    top AS (SELECT merged.*, log_line FROM merged JOIN logs USING (log_id) WHERE rank <= {k})"""


ASKED_WEEK = f"""asked_for AS (SELECT i.incident_id AS request_id, i.log_line, t.template_id, embedding, {hours_ago(168)} AS cutoff
    FROM vector_incidents i LEFT JOIN incident_template t ON t.incident_id = i.incident_id
    WHERE detected_at >= {hours_ago(168)})"""
_hybrid = [TEMPLATED, INCIDENTS, FIRST, INCIDENT_TEMPLATE, EMBEDDED, VECTOR_INCIDENTS]
put("hybrid_retrieve", [*_hybrid, ASKED_WEEK, hybrid(10)], """SELECT request_id AS incident_id, log_id, "timestamp",
  round(similarity, 6) AS similarity, retrieval_method, rank, log_line FROM top""")
put("incident_context", [*_hybrid, ASKED_WEEK, hybrid(10), f"""gathered AS (SELECT request_id, count(*) AS n, string_agg(
    '[' || strftime("timestamp", '{ISO}') || '] ' || log_line || ' (retrieved via ' || retrieval_method || ')', chr(10) ORDER BY rank) AS t
    FROM top GROUP BY 1)"""], """SELECT a.request_id AS incident_id, coalesce(n, 0) AS n_related, coalesce(t, '') AS context_text,
  'Incident line:' || chr(10) || log_line || chr(10) || chr(10) || 'Related log lines:' || chr(10) || coalesce(t, '') || chr(10) || chr(10) ||
  'State the root cause, the related events and the next remediation step.' AS prompt,
  'Incident detected: ' || log_line || '. Related events found: ' || coalesce(n, 0) AS fallback_summary
  FROM asked_for a LEFT JOIN gathered g USING (request_id)""")

WINDOWS = """windows AS (SELECT DISTINCT CAST(hours AS BIGINT) AS hours FROM routed WHERE route = 'error_summary'),
  cut AS (SELECT hours, TIMESTAMP '2024-01-31 00:00:00' - to_hours(CAST(hours AS INT)) AS cutoff FROM windows)"""
LEADS = """in_window AS (SELECT hours, cutoff, i.*, row_number() OVER (PARTITION BY hours ORDER BY detected_at DESC, incident_id) AS n
    FROM cut JOIN vector_incidents i ON i.detected_at >= cut.cutoff),
  leads AS (SELECT * FROM in_window WHERE n <= 5),
  asked_for AS (SELECT hours * 8 + n - 1 AS request_id, log_line, t.template_id, embedding, cutoff
    FROM leads LEFT JOIN incident_template t ON t.incident_id = leads.incident_id)"""
SUMMARY_ROWS = f"""lead_hits AS (SELECT CAST(floor(request_id / 8) AS BIGINT) AS hours, request_id % 8 AS seq, rank, log_id, "timestamp", log_line FROM top),
  first_hits AS (SELECT *, row_number() OVER (PARTITION BY hours ORDER BY seq, rank) AS o FROM (
    SELECT * FROM lead_hits QUALIFY row_number() OVER (PARTITION BY hours, log_id ORDER BY seq, rank) = 1)),
  context AS (SELECT hours, count(*) AS n_context, string_agg('[' || strftime("timestamp", '{ISO}') || '] ' || log_line, chr(10) ORDER BY o)
    FILTER (o <= 20) AS context_text FROM first_hits GROUP BY 1),
  listed AS (SELECT hours, count(*) AS n_incidents, count(*) FILTER ({eval_flag()}) AS n_errors,
    string_agg('- ' || log_line, chr(10) ORDER BY n) FILTER (n <= 10) AS incidents_text FROM in_window GROUP BY 1),
  summary_rows AS (SELECT w.hours, coalesce(n_incidents, 0) AS n_incidents, coalesce(n_errors, 0) AS n_errors, coalesce(n_context, 0) AS n_context,
    coalesce(incidents_text, '') AS incidents_text, coalesce(context_text, '') AS context_text,
    CASE WHEN coalesce(n_incidents, 0) = 0 THEN 'No incidents found in the last ' || w.hours || ' hour(s)'
      ELSE 'Found ' || n_incidents || ' incidents in the last ' || w.hours || ' hour(s). Related context: ' || coalesce(n_context, 0) || ' log entries.'
      END AS fallback_summary
    FROM windows w LEFT JOIN listed USING (hours) LEFT JOIN context USING (hours))"""
_window = [*_hybrid, QUESTIONS, ROUTED, WINDOWS, LEADS, hybrid(5), SUMMARY_ROWS]
put("window_summary", _window, "SELECT hours, n_incidents, n_context, incidents_text, context_text, fallback_summary FROM summary_rows")
put("answer_questions", [*_window, f"""auth AS (SELECT *, row_number() OVER (ORDER BY "timestamp" DESC, log_id) AS n FROM logs WHERE {has_keyword('auth')}),
  auth_hours AS (SELECT DISTINCT hours FROM routed WHERE route = 'suspicious_events'),
  suspicious AS (SELECT h.hours, count(log_id) AS c, string_agg(substring(log_line, 1, 200), chr(10) ORDER BY n) FILTER (n <= 5) AS ls
    FROM auth_hours h LEFT JOIN auth ON "timestamp" >= {hours_ago('CAST(h.hours AS INT)')} GROUP BY 1),
  opened AS (SELECT count(*) AS c, string_agg('ID ' || incident_id || ': ' || substring(log_line, 1, 100), chr(10) ORDER BY n) FILTER (n <= 10) AS ls
    FROM (SELECT *, row_number() OVER (ORDER BY detected_at DESC, incident_id) AS n FROM incidents WHERE status = 'open')),
  advised AS ({advice(1)})"""], f"""SELECT conv_id, turn, route, CAST(r.hours AS BIGINT) AS hours, r.service, CASE route
  WHEN 'error_summary' THEN CASE WHEN n_errors = 0 THEN 'No errors found in the last ' || r.hours || ' hour(s). System appears to be operating normally.'
    ELSE 'RAG-Enhanced Summary of errors in last ' || r.hours || ' hour(s) (' || n_errors || ' incidents):' || chr(10) || fallback_summary END
  WHEN 'suspicious_events' THEN CASE WHEN s.c = 0 THEN 'No suspicious authentication events found.'
    ELSE 'Found ' || least(s.c, 100) || ' suspicious authentication events:' || chr(10) || s.ls END
  WHEN 'restart_advice' THEN 'Recommendation: ' || recommendation || chr(10) || 'Reason: ' || reason || chr(10) || 'Errors found: ' || matching_logs
  WHEN 'open_incidents' THEN (SELECT CASE WHEN c = 0 THEN 'No open incidents.' ELSE 'Found ' || c || ' open incidents:' || chr(10) || ls END FROM opened)
  ELSE '{questions.NOT_RECOGNISED}' END AS answer
  FROM routed r LEFT JOIN summary_rows m ON m.hours = r.hours LEFT JOIN suspicious s ON s.hours = r.hours LEFT JOIN advised a ON a.service = r.service""")


def slots_of(line: str) -> str:
    return f"list_transform({keywords(f'substring({line}, 1, 512)')}, lambda w: {stable_id('w')} % 256)"


# How many keywords of a text, whose slots are s, fall on each of 256 slots.
SLOT_COUNTS = "list_transform(range(256), lambda i: len(list_filter(s, lambda x: x = i)))"


def unit_vector(counts: str) -> str:
    norm = f"sqrt(list_sum(list_transform({counts}, lambda x: x * x)))"
    return f"list_transform({counts}, lambda v: CAST(CASE WHEN v = 0 THEN 0 ELSE v / {norm} END AS FLOAT))"


put("embed_logs", [LINES, f"""slotted AS (SELECT doc_id, line_no,
    {slots_of('log_line')} AS s FROM lines)""",
    """counted AS (SELECT doc_id, line_no, list_sort(list_distinct(s)) AS d, list_transform(list_sort(list_distinct(s)), lambda i: len(list_filter(s, lambda x: x = i))) AS c FROM slotted)"""],
    """SELECT doc_id, line_no, 256 AS dim, array_to_string(list_transform(d, lambda i, k: i || ':' ||
      CAST(round(CAST(CAST(c[k] / sqrt(list_sum(list_transform(c, lambda x: x * x))) AS FLOAT) AS DOUBLE) * 1e5) AS BIGINT)), ' ') AS slots FROM counted""")
put("retrieve_by_text", [LOGS, INCIDENTS,
    f"""asked AS (SELECT incident_id, {unit_vector('c')} AS q FROM (SELECT incident_id, {SLOT_COUNTS} AS c FROM (
      SELECT incident_id, {slots_of('said')} AS s FROM (SELECT *, concat_ws(' ', log_line, coalesce(summary, '')) AS said FROM incidents WHERE {_week}))))""",
    f"""held AS (SELECT log_id, "timestamp", log_line, {unit_vector('c')} AS e FROM (SELECT *, {SLOT_COUNTS} AS c FROM (
      SELECT *, {slots_of('log_line')} AS s FROM logs WHERE {_log_week})))""",
    f"""scored AS (SELECT incident_id, log_id, "timestamp", log_line,
      coalesce(CASE WHEN list_sum(q) = 0 OR list_sum(e) = 0 THEN 0 ELSE {cosine('q', 'e', 9)} END, 0) AS similarity FROM asked, held)"""],
    """SELECT incident_id, log_id, "timestamp", log_line, round(similarity, 6) AS similarity, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY incident_id ORDER BY similarity DESC, "timestamp" DESC, log_id) AS INT) AS rank FROM scored) WHERE rank <= 10""")

# -- rules, governance, reports
put("windowed_alerts", [LOGS, INCIDENTS, patterns(24)], """SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, pattern,
  count(*) AS matches, threshold, action FROM (
    SELECT CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS window_start, pattern, threshold, action
    FROM logs JOIN rules ON regexp_matches(log_line, regex))
  GROUP BY window_start, pattern, threshold, action HAVING count(*) >= threshold""")


def governed(dry_run: bool) -> str:
    dry = "TRUE" if dry_run else "FALSE"
    return f"""checked AS (SELECT r.*, {ERROR} AS error, coalesce(p.requires_approval, FALSE) AS requires_approval,
      coalesce(p.risk_level, 'UNKNOWN') AS risk_level, coalesce(d.approved, FALSE) AND NOT {dry} AS ok,
      CASE WHEN NOT {dry} THEN d.approved_by END AS who
      FROM requests r LEFT JOIN tools t ON t.name = r.tool_name LEFT JOIN policy p ON p.action_name = r.tool_name
      LEFT JOIN decisions d ON d.request_id = r.request_id),
    staged AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'validation_failed' WHEN requires_approval AND NOT ok THEN 'rejected'
        WHEN {dry} THEN 'dry_run' ELSE 'ready' END AS status,
      CASE WHEN error IS NOT NULL THEN NULL WHEN requires_approval AND {dry} THEN 'dry_run_mode'
        WHEN requires_approval AND NOT ok THEN NULL WHEN requires_approval THEN who ELSE 'auto_approved' END AS approved_by FROM checked),
    governed AS (SELECT request_id, tool_name, incident_id, requested_at, risk_level, requires_approval, status,
      status IN ('dry_run', 'ready') AS success,
      CASE status WHEN 'validation_failed' THEN 'Validation failed: ' || error WHEN 'rejected' THEN 'Action rejected by approval gate'
        WHEN 'dry_run' THEN '[DRY RUN] Tool ''' || tool_name || ''' would be executed (approved by ' || approved_by || ')'
        ELSE 'Tool ''' || tool_name || ''' ready (approved by ' || coalesce(approved_by, 'unknown') || ')' END AS message,
      approved_by, error,
      CASE status WHEN 'validation_failed' THEN 'validation_failed' WHEN 'rejected' THEN 'validated,rejected'
        WHEN 'dry_run' THEN 'validated,dry_run' ELSE CASE WHEN requires_approval THEN 'validated,approved,ready' ELSE 'validated,ready' END END AS audit
      FROM staged)"""


_gate = [REQUESTS, TOOLS, POLICY, DECISIONS]
put("govern_actions", [*_gate, governed(False)], "SELECT * FROM governed")
put("govern_actions_dry_run", [*_gate, governed(True)], "SELECT * FROM governed")
put("audit_events", [*_gate, governed(False), "steps AS (SELECT *, string_split(audit, ',') AS a FROM governed)"], """
  SELECT request_id, seq, requested_at, tool_name, incident_id, step AS status, CASE WHEN step <> 'validated' THEN approved_by END AS approved_by,
    CASE WHEN step = 'validation_failed' THEN error END AS error FROM (
    SELECT *, unnest(a) AS step, CAST(generate_subscripts(a, 1) - 1 AS INT) AS seq FROM steps)""")
put("record_actions", [*_gate, governed(False), OUTCOMES], """SELECT request_id AS action_id, incident_id, tool_name AS action_name,
  executed_at, outcome AS status, approved_by, output AS result_message FROM governed JOIN outcomes USING (request_id)
  WHERE status = 'ready' AND outcome = 'executed' AND incident_id IS NOT NULL""")
put("outcome_audit", [*_gate, governed(False), OUTCOMES], """SELECT request_id, tool_name, incident_id, executed_at,
  CASE WHEN outcome = 'lost' THEN 'error' ELSE outcome END AS status, CASE WHEN outcome = 'executed' THEN approved_by END AS approved_by,
  CASE outcome WHEN 'failed' THEN coalesce(nullif(output, ''), 'Unknown error') WHEN 'timeout' THEN 'Tool execution timed out'
    WHEN 'lost' THEN output END AS error
  FROM governed JOIN outcomes USING (request_id) WHERE status = 'ready'""")
put("evaluation_report", [LOGS, INCIDENTS, ACTIONS], f"""SELECT '{AS_OF}' AS timestamp, d.total_logs, true_anomalies,
  tp AS detected_anomalies, fp AS false_positives, fn AS false_negatives, round(precision, 2) AS precision, round(recall, 2) AS recall,
  round(f1_score, 2) AS f1_score, round(l.average, 2) AS latency_average, round(l.min, 2) AS latency_min, round(l.max, 2) AS latency_max,
  total_summaries, avg_length, keyword_coverage, informativeness_score, u.total_incidents AS recent_total_incidents,
  u.total_actions AS recent_total_actions, useful_actions AS recent_useful_actions, usefulness_rate AS recent_usefulness_rate,
  mttd_seconds, mttr_seconds, m.total_incidents, open_incidents, resolved_incidents, escalated_incidents, m.total_actions, action_breakdown
  FROM ({scores(eval_flag(), _label)}) d, ({ORACLE['latency_summary']}) l, ({ORACLE['summary_quality']}) s,
    ({usefulness('incidents', hours_ago(24))}) u, ({ORACLE['metrics_summary']}) m""")

# -- streams, drained to the end
_stamped = "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') || substring(log_line, 11)"
put("stream_logs", [LOGS], f"""SELECT {_stamped} AS log_line, date_trunc('second', "timestamp") AS event_time FROM logs""")
put("stream_ingest", [LOGS, f"stamped AS (SELECT {_stamped} AS line, \"timestamp\" AS t FROM logs)"], f"""SELECT line AS log_line,
  date_trunc('second', t) AS timestamp, CAST({ingest_flag('line')} AS INT) AS is_anomaly, {template('line')} AS template_pattern,
  len({keywords('line')}[1:20]) AS keywords FROM stamped""")
put("stream_triage", [LOGS, OUTCOMES], f"""SELECT incident_id, detected_at, CASE WHEN tool_name = 'ESCALATE' THEN done_at END AS resolved_at,
  log_line, summary, CASE WHEN tool_name = 'ESCALATE' AND done_at IS NOT NULL THEN 'resolved' ELSE 'open' END AS status, tool_name,
  CASE WHEN tool_name = 'ESCALATE' THEN 'ready' ELSE 'rejected' END AS action_status,
  CASE WHEN tool_name = 'ESCALATE' THEN 'Tool ''ESCALATE'' ready (approved by auto_approved)' ELSE 'Action rejected by approval gate' END AS message,
  CAST(2 AS BIGINT) AS audit_steps FROM (SELECT log_id AS incident_id, "timestamp" AS detected_at, log_line,
    {diagnosis('log_line')} AS summary, {diagnosed_action('log_line')} AS tool_name FROM logs WHERE {monitor_flag()})
  LEFT JOIN (SELECT request_id AS incident_id, executed_at AS done_at FROM outcomes WHERE outcome = 'executed') USING (incident_id)""")
_stream_rules = ", ".join(f"('{p}', '{r}')" for p, r in text.PATTERN_REGEX.items())
put("stream_alerts", [LOGS, f"rules(pattern, regex) AS (VALUES {_stream_rules})"], """SELECT window_start,
  window_start + INTERVAL 1 HOUR AS window_end, pattern, count(*) AS matches, CAST(2 AS BIGINT) AS threshold, 'ESCALATE' AS action FROM (
    SELECT date_trunc('hour', "timestamp") AS window_start, pattern FROM logs JOIN rules ON regexp_matches(log_line, regex))
  GROUP BY window_start, pattern HAVING count(*) >= 2
    AND window_start + INTERVAL 1 HOUR <= (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM logs)""")


def mined(prefix: str, line: str, compared: str) -> list[str]:
    """Mining in log order: one row for each leaf and place in it, with the templates of the leaf so far.

    ``line``: the mined part of log_line; ``compared``: which of its tokens ``m`` meet a template.
    """
    p = prefix
    return [
        f"""{p}_lines AS (SELECT log_line, {masked(line)} AS m, min(log_id) AS first_id FROM logs GROUP BY log_line)""",
        f"""{p}_parts AS (SELECT log_line, array_to_string(m[1:4], chr(10)) AS leaf, list_distinct({compared}) AS r, first_id,
          array_to_string(list_transform(m, lambda t: substring(t, 1, 8)), ' ') AS own FROM {p}_lines)""",
        f"""{p}_ranked AS (SELECT *, list_distinct({masked('own')}) AS t, row_number() OVER (PARTITION BY leaf ORDER BY first_id) AS k FROM {p}_parts)""",
        f"""{p}_steps(leaf, k, log_line, pattern, patterns, sets) AS (
          SELECT leaf, k, log_line, own, [own], [t] FROM {p}_ranked WHERE k = 1
          UNION ALL
          SELECT leaf, k, log_line, coalesce(patterns[best], own),
            CASE WHEN best IS NULL AND NOT list_contains(patterns, own) THEN list_append(patterns, own) ELSE patterns END,
            CASE WHEN best IS NULL AND NOT list_contains(patterns, own) THEN list_append(sets, t) ELSE sets END
          FROM (SELECT *, CASE WHEN list_max(scores) >= 0.5 THEN list_position(scores, list_max(scores)) END AS best FROM (
            SELECT n.leaf, n.k, n.log_line, n.own, n.t, s.patterns, s.sets, list_transform(s.sets, lambda x: CASE WHEN len(x) + len(n.r) = 0 THEN 1.0
              ELSE len(list_intersect(x, n.r)) / CAST(len(list_distinct(list_concat(x, n.r))) AS DOUBLE) END) AS scores
            FROM {p}_steps s JOIN {p}_ranked n ON n.leaf = s.leaf AND n.k = s.k + 1)))""",
    ]


_undated = r"regexp_replace(log_line, '^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?\s*', '')"
_mined_logs = f"SELECT log_id, pattern AS template_pattern, {stable_id('pattern')} AS template_id FROM logs JOIN a_steps USING (log_line)"
for _name in ("mine_templates", "stream_templates"):
    put(_name, [LOGS, *mined("a", "log_line", "m[5:]")], _mined_logs)
    ORACLE[_name] = ORACLE[_name].replace("WITH ", "WITH RECURSIVE ", 1)
put("mine_templates_undated", [LOGS, *mined("a", _undated, "m[5:]"), *mined("b", _undated, "m")],
    "SELECT log_id, a.pattern AS template_pattern, b.pattern AS by_line FROM logs JOIN a_steps a USING (log_line) JOIN b_steps b USING (log_line)")
ORACLE["mine_templates_undated"] = ORACLE["mine_templates_undated"].replace("WITH ", "WITH RECURSIVE ", 1)
put("stream_growing", [LOGS], f"""SELECT {_stamped} AS log_line, date_trunc('second', "timestamp") AS event_time FROM logs""")
put("stream_outcomes", [LOGS, OUTCOMES], f"""SELECT incident_id, CASE WHEN outcome = 'executed' THEN 'resolved' ELSE 'open' END AS status,
    CASE WHEN outcome = 'executed' THEN executed_at END AS resolved_at,
    CASE WHEN outcome = 'executed' THEN round({seconds('detected_at', 'executed_at')}, 4) END AS recovery_seconds,
    CASE WHEN NOT ready THEN NULL WHEN outcome IS NULL THEN 'timeout' WHEN outcome IN ('executed', 'failed', 'timeout') THEN outcome ELSE 'error' END AS report,
    CASE WHEN NOT ready THEN NULL WHEN outcome IS NULL THEN detected_at + to_hours(24 * 60) ELSE executed_at END AS executed_at,
    CASE WHEN NOT ready OR outcome = 'executed' THEN NULL WHEN outcome IS NULL OR outcome = 'timeout' THEN '{governance.TIMED_OUT}'
      WHEN outcome = 'failed' THEN coalesce(nullif(output, ''), '{governance.UNKNOWN_ERROR}') ELSE coalesce(output, '') END AS error
  FROM (SELECT log_id AS incident_id, "timestamp" AS detected_at, {diagnosed_action('log_line')} = 'ESCALATE' AS ready,
    CASE WHEN {diagnosed_action('log_line')} = 'ESCALATE' THEN o.outcome END AS outcome, o.output, o.executed_at
    FROM logs LEFT JOIN outcomes o ON o.request_id = log_id WHERE {monitor_flag()})""")
put("stream_rule_alerts", *ORACLE_PARTS["windowed_alerts"])
put("stream_template_table", [TEMPLATED, TABLE], "SELECT * FROM template_rows")
put("stored_audit", ORACLE_PARTS["audit_events"][0], f"""SELECT tool_name, status, approved_by, error, count(*) AS n, CAST(sum(request_id) AS BIGINT) AS requests
  FROM ({ORACLE_PARTS["audit_events"][1]}) GROUP BY ALL""")
put("stored_rules", *ORACLE_PARTS["evaluate_rules"])
put("stored_policy", [*_gate, governed(False)], """SELECT tool_name, status, risk_level, message, count(*) AS n, CAST(sum(request_id) AS BIGINT) AS requests
  FROM governed GROUP BY ALL""")
_counted = " ".join([f"WHEN 'error' THEN {eval_flag()} WHEN 'anomaly' THEN {ingest_flag()}"] + [f"WHEN '{w}' THEN {has_keyword(w)}" for w in ("auth", "apache", "nginx")])
put("trailing_counts", [LOGS, QUESTIONS, ROUTED, "asked AS (SELECT DISTINCT CAST(hours AS BIGINT) AS hours FROM routed)",
    "names AS (SELECT unnest(['error', 'anomaly', 'auth', 'apache', 'nginx']) AS name)"], f"""
  SELECT hours, name, count(log_id) AS n FROM asked CROSS JOIN names
  LEFT JOIN logs ON "timestamp" >= {hours_ago('hours', "TIMESTAMP '2024-01-30 22:17:30'")} AND CASE name {_counted} END GROUP BY hours, name""")

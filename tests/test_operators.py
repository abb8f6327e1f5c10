"""Search, incidents, rules, governance, evaluation and questions on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ACTION_SCHEMA, INCIDENT_SCHEMA, LOG_SCHEMA
from faultline.functions import detect, times
from faultline.operators import evaluation, governance, incidents, logs, questions, rules
from faultline.sources import files

AS_OF = "2024-01-10 00:00:00"
NOW = dt.datetime(2024, 1, 10)


def ago(**kw):
    return NOW - dt.timedelta(**kw)


LINES = [
    (1, ago(hours=30), "INFO: auth ok"),
    (2, ago(hours=24), "INFO: unauthorized access on 100% of nodes"),
    (3, ago(hours=2), "ERROR: café Port 80 is in use"),
    (4, ago(hours=2), "ERROR: café Port 80 is in use"),
    (5, ago(minutes=5), "   "),
    (6, ago(minutes=4), "apache apache nginx_1 up"),
    (7, NOW + dt.timedelta(hours=1), "INFO: auth from the future"),
]


@pytest.fixture
def log_rows(make):
    return make(LOG_SCHEMA, LINES)


def ids(rows, column="log_id"):
    return [r[column] for r in rows.collect()]


def test_ingest_drops_blank_lines(log_rows):
    got = {r["log_id"]: r for r in logs.ingest(log_rows).collect()}
    assert sorted(got) == [1, 2, 3, 4, 6, 7]
    assert got[3]["is_anomaly"] == 1 and got[1]["is_anomaly"] == 0
    assert got[3]["template_id"] == got[4]["template_id"] != got[1]["template_id"]


@pytest.mark.parametrize("indexed", [False, True])
def test_search(log_rows, indexed):
    index = logs.lexical_index(log_rows) if indexed else None
    find = lambda p, h=24: ids(logs.search_logs(log_rows, p, AS_OF, h, index=index))
    assert find("auth") == [7, 2]
    assert find("AUTH", 30) == [7, 2, 1]
    assert find("nginx") == []  # nginx_1 is one word with a digit
    assert find("in_use") == []  # one word, so it is looked up in the index
    assert find("in_use ") == []
    assert find("port 80 is_in") == [3, 4]
    assert find("100% of") == [2]


def test_search_equal_times_and_limit(log_rows):
    assert ids(logs.search_substring(log_rows, "port", AS_OF, limit=1)) == [3]


def test_lexical_index_positions(make):
    row = make(LOG_SCHEMA, [(1, NOW, "The disk and the café disk ab_c " + "word " * 30)])
    got = [(r["keyword"], r["position"]) for r in logs.lexical_index(row).orderBy("position").collect()]
    assert got[:3] == [("disk", 0), ("disk", 1), ("word", 2)] and len(got) == 20


def test_attach_embeddings_keeps_old(make):
    rows = make("log_id bigint, embedding array<float>", [(1, [1.0]), (2, None), (3, [3.0])])
    fresh = make("log_id bigint, embedding array<float>", [(1, [9.0]), (2, [2.0])])
    got = {r["log_id"]: r["embedding"] for r in logs.attach_embeddings(rows, fresh).collect()}
    assert got == {1: [9.0], 2: [2.0], 3: [3.0]}


INCIDENTS = [
    (1, ago(hours=30), ago(hours=29), "ERROR: café Port 80 is in use", None, "resolved"),
    (2, ago(hours=24), None, "CRITICAL: disk", "", "resolved"),
    (3, ago(hours=3), ago(hours=2, minutes=30), "FATAL: x", "ok", "resolved"),
    (4, ago(hours=1), None, "ERROR: timeout", "slow", "open"),
    (5, ago(hours=1), None, "ERROR: CRITICAL: timeout", None, "open"),
    (6, ago(minutes=1), None, "WARNING: y", "z" * 60, "escalated"),
]


@pytest.fixture
def incident_rows(make):
    return make(INCIDENT_SCHEMA, INCIDENTS)


@pytest.fixture
def action_rows(make):
    return make(ACTION_SCHEMA, [
        (1, 1, "RESTART_APACHE", ago(hours=5), "executed"), (2, 4, "ESCALATE", ago(hours=4), "failed"),
        (3, None, "ESCALATE", ago(hours=4), "executed"), (4, 99, "ESCALATE", ago(hours=3), "odd"),
    ])


def test_incident_filters(incident_rows, make):
    assert ids(incidents.incidents_window(incident_rows, AS_OF, 24), "incident_id") == [6, 4, 5, 3, 2]
    assert ids(incidents.errors_window(incident_rows, AS_OF, 24), "incident_id") == [4, 5, 2]
    assert ids(incidents.open_incidents(incident_rows), "incident_id") == [4, 5]
    wanted = make("incident_id bigint", [(2,), (2,), (77,)])
    assert ids(incidents.incidents_by_ids(incident_rows, wanted), "incident_id") == [2]
    assert max(len(r["summary"] or "") for r in incidents.incident_listing(incident_rows).collect()) == 50


def test_resolutions(incident_rows, make):
    reports = make("incident_id bigint, resolved_at timestamp_ntz", [(4, NOW), (4, ago(minutes=9)), (99, NOW)])
    got = {r["incident_id"]: r for r in incidents.apply_resolutions(incident_rows, reports).collect()}
    assert len(got) == 6
    assert (got[4]["status"], got[4]["resolved_at"]) == ("resolved", NOW)
    assert (got[1]["resolved_at"], got[6]["status"]) == (ago(hours=29), "escalated")


def test_times_and_summary(incident_rows, action_rows, log_rows):
    assert incidents.mttr(incident_rows).first()[0] == (3600 + 1800) / 2
    assert incidents.mttr(incident_rows.limit(0)).first()[0] is None
    # Incident 1 was detected 28 hours before the first log with its line.
    assert incidents.mttd(incident_rows, log_rows).first()[0] == -28 * 3600
    row = incidents.metrics_summary(incident_rows, action_rows, log_rows).first()
    assert (row["total_incidents"], row["open_incidents"], row["resolved_incidents"], row["escalated_incidents"]) == (6, 2, 3, 1)
    assert (row["mttr_formatted"], row["mttr_formatted_minutes"]) == ("2700.00s", "45.00 minutes")
    assert row["action_breakdown"] == {"executed": 2, "failed": 1, "odd": 1}
    empty = incidents.metrics_summary(incident_rows.limit(0), action_rows.limit(0)).first()
    assert (empty["mttr_formatted"], empty["mttd_formatted"], empty["total_actions"]) == ("N/A", "N/A", 0)
    assert empty["action_breakdown"] == {}


def test_coverage_and_usefulness(incident_rows, action_rows):
    assert incidents.summary_coverage(incident_rows, AS_OF).first()[:] == (5, 3, 60.0)
    assert incidents.summary_coverage(incident_rows.limit(0), AS_OF).first()[:] == (0, 0, 0.0)
    row = incidents.action_usefulness(action_rows, incident_rows, AS_OF).first()
    assert row[:] == (5, 4, 3, 1, 25.0)
    none = incidents.action_usefulness(action_rows, incident_rows.limit(0), AS_OF).first()
    assert none[:] == (0, 0, 0, 0, 0.0)
    assert ids(incidents.recent_actions(action_rows, 3), "action_id") == [4, 2, 3]


def test_constraints(incident_rows, action_rows, log_rows, make):
    table = make("template_pattern string", [("a",), ("a",), ("b",)])
    got = {
        (r["table_name"], r["rule"]): r["violations"]
        for r in incidents.constraint_violations(incident_rows, action_rows, log_rows, table).collect()
    }
    broken = {k: v for k, v in got.items() if v}
    assert broken == {
        ("incidents", "resolved_without_time"): 1, ("actions", "status_value"): 1, ("templates", "pattern_unique"): 1,
    }
    assert len(got) == 10


def test_orphans(incident_rows, action_rows, log_rows, make):
    with_template = log_rows.withColumn("template_id", F.col("log_id") % 3)
    known = make("template_id bigint", [(0,), (1,)])
    index = make("log_id bigint", [(1,), (50,)])
    got = {r[0]: r[1] for r in incidents.orphan_rows(action_rows, incident_rows, with_template, known, index).collect()}
    assert got == {"actions.incident_id": 1, "logs.template_id": 2, "lexical_index.log_id": 1}


def test_rules(incident_rows, make):
    got = [(r["pattern"], r["frequency"]) for r in rules.error_patterns(incident_rows, AS_OF, 48).collect()]
    assert got == [("CRITICAL", 2), ("timeout", 2), ("port.*conflict", 1)]
    suggested = rules.suggest_rules(incident_rows, AS_OF, 48)
    assert {r["pattern"]: (r["threshold"], r["action"]) for r in suggested.collect()} == {
        "CRITICAL": (1, "ESCALATE"), "timeout": (1, "RESTART_APACHE"), "port.*conflict": (1, "RESTART_APACHE"),
    }
    tail = make(LOG_SCHEMA, [(i, ago(minutes=i), "timed out" if i < 5 else "CRITICAL") for i in range(12)])
    fired = {r["pattern"]: (r["matches"], r["fires"]) for r in rules.evaluate_rules(tail, suggested, tail=10).collect()}
    assert fired == {"CRITICAL": (7, True), "timeout": (3, True), "port.*conflict": (0, False)}
    windows = rules.windowed_alerts(tail, suggested, "1 hour", "30 minutes").orderBy("pattern", "window_start").collect()
    assert [(w["pattern"], w["matches"]) for w in windows] == [
        ("CRITICAL", 7), ("CRITICAL", 7), ("timeout", 4), ("timeout", 5), ("timeout", 1),
    ]


@pytest.fixture
def gate(spark):
    tools = files.rows(spark, files.DEFAULT_TOOLS + [("ROTATE", "", ["path", "depth"], "LOW", False)], files.TOOL_COLUMNS)
    return tools, files.load_policy(spark)


REQUESTS = [
    (1, "RESTART_APACHE", 10, None), (2, "CLEAR_TEMP_CACHE", 11, {}), (3, "NOPE", 12, None),
    (4, "ROTATE", 13, {"path": "/"}), (5, "ROTATE", 14, {"path": "/", "depth": "1"}), (6, "RESTART_APACHE", None, None),
]


@pytest.fixture
def request_rows(make):
    rows = make("request_id bigint, tool_name string, incident_id bigint, params map<string,string>", REQUESTS)
    return rows.withColumn("requested_at", F.lit(NOW))


def outcome(governed):
    return {r["request_id"]: (r["status"], r["approved_by"], r["success"]) for r in governed.collect()}


def test_governance(request_rows, gate, make):
    decisions = make("request_id bigint, approved boolean, approved_by string", [(1, True, "kim"), (6, False, "kim")])
    live = governance.govern_actions(request_rows, *gate, decisions, dry_run=False)
    assert outcome(live) == {
        1: ("ready", "kim", True), 2: ("ready", "auto_approved", True), 3: ("validation_failed", None, False),
        4: ("validation_failed", None, False), 5: ("ready", "auto_approved", True), 6: ("rejected", None, False),
    }
    errors = {r["request_id"]: r["error"] for r in live.filter("error is not null").collect()}
    assert errors == {3: "Unknown tool: NOPE", 4: "Missing required parameter: depth"}
    dry = governance.govern_actions(request_rows, *gate, decisions, dry_run=True)
    assert outcome(dry)[1] == ("rejected", "dry_run_mode", False)
    assert outcome(dry)[2] == ("dry_run", "auto_approved", True)
    assert outcome(governance.govern_actions(request_rows, *gate, dry_run=False))[1] == ("rejected", None, False)
    steps = [r["status"] for r in governance.audit_events(live).filter("request_id = 1").orderBy("seq").collect()]
    assert steps == ["validated", "approved", "ready"]
    outcomes = make("request_id bigint, status string, output string, executed_at timestamp_ntz", [
        (1, "executed", "done", NOW), (1, "failed", "first try", ago(minutes=1)), (2, "failed", "", NOW),
        (3, "executed", "?", NOW), (5, "crashed", "no shell", NOW),
    ])
    recorded = governance.record_outcomes(live, outcomes).collect()
    assert [(r["incident_id"], r["action_name"], r["approved_by"]) for r in recorded] == [(10, "RESTART_APACHE", "kim")]
    audited = {r["request_id"]: (r["status"], r["error"]) for r in governance.outcome_audit(live, outcomes).collect()}
    assert audited == {1: ("executed", None), 2: ("failed", "Unknown error"), 5: ("error", "no shell")}
    assert ids(governance.resolutions_from(live, outcomes), "incident_id") == [10]
    assert ids(governance.resolutions_from(dry, outcomes), "incident_id") == []


def test_governance_repeats(request_rows, gate, make):
    twice = make("request_id bigint, approved boolean, approved_by string", [
        (1, True, "kim"), (1, False, "lee"), (6, True, "kim"), (6, True, "kim"),
    ])
    tools, policy = gate
    live = governance.govern_actions(request_rows, tools.union(tools), policy.union(policy), twice, dry_run=False)
    assert live.count() == request_rows.count()
    assert {k: outcome(live)[k][0] for k in (1, 6)} == {1: "rejected", 6: "ready"}


LABELLED = [
    ("ERROR: pump stopped", 1), ("CRITICAL: tank empty", 1), ("FATAL: valve stuck", 1), ("WARNING: pressure high", 1),
    ("pump Failed quietly", 1), ("reading lost", 1), ("no errors today", 0), ("INFO: Timeout setting saved", 0),
    ("INFO: idle", 0), ("INFO: ok", 0),
]


def test_detector_scores(make):
    rows = make("log_id bigint, log_line string, is_anomaly int", [(i, *r) for i, r in enumerate(LABELLED)])
    line = F.col("log_line")
    expected = {
        detect.detect_eval: (2, 1, 4, 3), detect.detect_ingest: (4, 1, 2, 3),
        detect.detect_monitor: (3, 1, 3, 3), detect.detect_intended: (3, 2, 3, 2),
    }
    for flag, counts in expected.items():
        r = evaluation.detection_metrics(rows, flag(line)).first()
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == counts
        assert r["recall"] == pytest.approx(counts[0] / 6 * 100)
    limited = evaluation.evaluate_detector(rows, limit=6, calls=make("latency double", [(1.0,), (3.0,)])).first()
    assert (limited["total_logs"], limited["precision"], limited["latency"]["average"]) == (6, 100.0, 2.0)
    empty = evaluation.detection_metrics(rows.limit(0), detect.detect_eval(line)).first()
    assert (empty["precision"], empty["recall"], empty["f1_score"]) == (0.0, 0.0, 0.0)
    agreement = evaluation.detector_agreement(rows, detect.detect_eval(line), detect.detect_eval(line)).first()
    assert (agreement["precision"], agreement["accuracy"]) == (100.0, 100.0)


def test_summary_quality_and_latency(make):
    rows = make("log_line string, summary string", [
        ("ERROR on port", "The PORT is taken"), ("error", "nothing here"), ("x" * 100 + " error", "error"), ("ok", None),
    ])
    r = evaluation.summary_quality(rows).first()
    assert (r["total_summaries"], r["avg_length"], r["keyword_coverage"]) == (4, 8.5, 25.0)
    assert r["informativeness_score"] == 8.5 + 12.5
    assert evaluation.summary_quality(rows.limit(0)).first()[:] == (0, 0.0, 0.0, 0.0)
    assert evaluation.latency_summary(make("latency double", [])).first()[:] == (0.0, 0.0, 0.0, 0)


QUESTIONS = {
    "Summarize last hour errors": ("error_summary", 1), "summarize ERRORS of the last 24 hours": ("error_summary", 24),
    "suspicious auth events last 48 hours": ("suspicious_events", 48), "suspicious auth last few hours": ("suspicious_events", 1),
    "should I restart nginx in the last week": ("restart_advice", 168), "should I restart it": ("restart_advice", 1),
    "open incidents of the last 3 last 5 hours": ("open_incidents", 5), "blast 7 hours": ("unrecognized", 1),
    "summarize errors last hours last": ("error_summary", 1), "list last": ("unrecognized", 1),
}


def test_question_routing(make):
    rows = questions.route_questions(make("question string", [(q,) for q in QUESTIONS])).collect()
    assert {r["question"]: (r["route"], r["hours"]) for r in rows} == QUESTIONS
    assert [r["service"] for r in rows if "nginx" in r["question"]] == ["nginx"]


def test_answers(make, incident_rows, log_rows):
    with_template = log_rows.withColumn("template_id", F.lit(1).cast("bigint"))
    asked = make("question string", [(q,) for q in QUESTIONS])
    got = {r["question"]: r["answer"] for r in questions.answer_questions(asked, incident_rows, with_template, AS_OF).collect()}
    assert got["suspicious auth events last 48 hours"].split("\n") == [
        "Found 3 suspicious authentication events:", "INFO: auth from the future",
        "INFO: unauthorized access on 100% of nodes", "INFO: auth ok",
    ]
    assert got["should I restart it"].startswith("Recommendation: NO\nReason: Found 1 error(s)")
    assert got["should I restart nginx in the last week"].endswith("Service appears healthy.\nErrors found: 0")
    assert got["open incidents of the last 3 last 5 hours"].startswith("Found 2 open incidents:\nID 4: ERROR: timeout\nID 5")
    assert got["list last"] == questions.NOT_RECOGNISED
    assert "(2 incidents):\nFound 3 incidents in the last 1 hour(s)." in got["Summarize last hour errors"]


def test_advice_from_response(make):
    rows = make("s string, a string, e boolean", [
        ("please restart", "X", True), ("fine", "RESTART_APACHE", True), ("fine", None, True), ("know", None, False), ("well", None, False),
    ])
    got = rows.select(questions.advice_from_response(F.col("s"), F.col("a"), F.col("e"))).collect()
    assert [r[0] for r in got] == ["YES", "YES", "NO", "NO", "CHECK"]


def test_large_rule_sets_take_the_array_path(make, monkeypatch):
    tail = make(LOG_SCHEMA, [(i, ago(minutes=i), f"code {i % 3}") for i in range(1, 30)])
    table = make("pattern string, regex string, threshold bigint, action string", [(f"p{i}", f"code {i}$", 2, "A") for i in range(4)])
    direct = sorted(map(tuple, rules.windowed_alerts(tail, table).collect()))
    monkeypatch.setattr(rules, "LITERAL_RULES", 2)
    assert sorted(map(tuple, rules.windowed_alerts(tail, table).collect())) == direct and len(direct) == 3
    assert rules.windowed_alerts(tail, table.limit(0)).count() == 0


def test_elapsed_time_ignores_the_session_zone(spark, make):
    # A clock change in New York lies between the two times.
    table = make("a timestamp_ntz, b timestamp_ntz", [(dt.datetime(2024, 3, 10, 1), dt.datetime(2024, 3, 10, 4, 0, 0, 5))])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = table.select(
            times.seconds_between(F.col("a"), F.col("b")), times.from_micros(times.micros(F.col("b"))).cast("string")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row[:] == (10800.000005, "2024-03-10 04:00:00.000005")

"""The stored search index, tables kept by streams, changing rules and late reports."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import LOG_SCHEMA
from faultline.operators import governance, logs, search_index, templates
from faultline.sources import files
from faultline.streaming import alerts, outcomes, pipelines, rollup, snapshots, sources

AS_OF = "2024-01-10 00:00:00"
NOW = dt.datetime(2024, 1, 10)


# Search index

WORDS = ["auth", "oauth", "Timeout", "disk", "C:\\svc\\auth", "100%", "a_b", "é", "port", "80", "ab", "timeoutish", "x"]


@pytest.fixture(scope="module")
def searched(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = [(i, NOW - dt.timedelta(minutes=rng.randint(0, 3000)), " ".join(rng.choices(WORDS, k=rng.randint(0, 6)))) for i in range(700)]
    table = spark.createDataFrame(rows, LOG_SCHEMA).repartition(5)
    return table, search_index.build_search_index(table, str(tmp_path_factory.mktemp("search")), block_lines=16)


@pytest.mark.parametrize("pattern", [
    "auth", "AUTH", "time", "timeout", "t_me", "ti", "x", "zzz", "disk port", "C:\\svc", "c:\\", "100%", "%disk%port", "a_b", "k p_rt", "é", "80 ", "%", "_", "port__",
])
@pytest.mark.parametrize("hours", [24, 168])
def test_index_finds_what_a_scan_finds(searched, pattern, hours):
    table, index = searched
    for limit in (7, 5000):
        got = index.search(pattern, AS_OF, hours, limit).collect()
        assert list(map(tuple, got)) == list(map(tuple, logs.search_logs(table, pattern, AS_OF, hours, limit, logs.lexical_index(table)).collect()))


def test_index_reads_few_row_groups(searched):
    _, index = searched
    plan = index._with_all(index.block_grams, "block", search_index.pattern_grams("disk port"))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram, [" in plan
    assert search_index.pattern_grams("disk%po_rt") == ["dis", "isk"] and search_index.pattern_grams("a%b_cd") == []


def test_index_of_nothing(make, tmp_path):
    index = search_index.build_search_index(make(LOG_SCHEMA, []), str(tmp_path))
    assert index.search("auth", AS_OF).count() == index.search("a b", AS_OF).count() == 0


# Tables kept by a stream


def test_snapshots_count_replays_once(make, spark, tmp_path):
    rows = [(i, NOW + dt.timedelta(seconds=i), f"t{i * i % 7}") for i in range(60)]
    table = make("log_id bigint, timestamp timestamp_ntz, template_pattern string", rows)
    kept = snapshots.template_snapshots(spark, str(tmp_path), every=3)
    columns = ["template_pattern", "frequency", "created_at", "first_log_id", "template_id"]
    told = lambda t: sorted(map(tuple, t.select(columns).collect()))
    assert kept.current().count() == 0
    for batch in range(8):
        part = templates.template_table(table.where(F.col("log_id") % 8 == batch))
        for _ in range(1 + batch % 3):  # replayed once or twice, also when it makes a version
            kept.add(part, batch)
            assert told(kept.current()) == told(templates.template_table(table.where(F.col("log_id") % 8 <= batch)))
    assert told(kept.current(below=4)) == told(templates.template_table(table.where(F.col("log_id") % 8 < 4)))
    kept.expire()
    assert told(kept.current()) == told(templates.template_table(table))
    assert pipelines.complete(spark, f"{tmp_path}/increments") == [6, 7]


def test_stream_keeps_the_template_table(make, spark, tmp_path):
    table = make("log_id bigint, timestamp timestamp_ntz, template_pattern string", [(i, NOW, f"t{i % 5}") for i in range(40)])
    table.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    snapshots.start_template_table(stream, str(tmp_path / "t"), str(tmp_path / "ck"), every=2, once=True).awaitTermination()
    got = snapshots.template_snapshots(spark, str(tmp_path / "t"), every=2).current()
    assert sorted(r["frequency"] for r in got.collect()) == [8] * 5


# Rules that change


def test_rules_change_while_the_stream_runs(make, spark, tmp_path):
    schema = "log_line string, event_time timestamp"
    folder, out, checkpoint, ends = (str(tmp_path / x) for x in ("in", "out", "ck", "ends"))
    make(schema, []).write.parquet(folder)
    sources.open_end(spark, ends)
    known = [("E", "ERROR", 2, "X"), ("W", "WARN", 1, "Y")]
    stream = sources.with_end(spark.readStream.schema(schema).parquet(folder), ends)
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)

    def run(*lines):
        if lines:
            make(schema, list(lines)).write.mode("append").parquet(folder)
        alerts.start_rule_alerts(stream, lambda: make(alerts.RULES, known), out, checkpoint, once=True).awaitTermination()
        got = spark.read.schema(alerts.ALERTS).parquet(out + "/alerts").collect()
        return sorted((r["window_start"].hour, r["pattern"], r["matches"], r["threshold"]) for r in got)

    assert run(("ERROR a", at(0, 1)), ("ERROR b", at(0, 2)), ("WARN c", at(0, 3)), ("INFO", at(0, 4))) == []  # nothing settled yet
    first = [(0, "E", 2, 2), (0, "W", 1, 1)]
    assert run(("ERROR d", at(1, 5)), ("ERROR late", at(1, 0)), ("INFO", at(1, 20))) == first
    known[:] = [("E", "ERROR", 3, "X"), ("D", "DEBUG", 1, "Z")]  # W is gone, E needs more, D is new
    assert run(("ERROR settled before", at(0, 59)), ("DEBUG x", at(1, 30)), ("WARN y", at(1, 31))) == first
    assert run(("INFO", at(3, 0))) == first + [(1, "D", 1, 1)]
    assert run(("DEBUG last", at(3, 1))) == first + [(1, "D", 1, 1)]
    sources.end_stream(spark, ends, "2024-02-01 00:00:00")
    assert run() == first + [(1, "D", 1, 1), (3, "D", 1, 1)]
    assert run() == first + [(1, "D", 1, 1), (3, "D", 1, 1)]


def test_a_replayed_batch_uses_the_rules_it_had(make, spark, tmp_path):
    out = str(tmp_path)
    first = alerts._rules_of(spark, lambda: make(alerts.RULES, [("a", "a", 1, "X")]), out, 0)
    again = alerts._rules_of(spark, lambda: make(alerts.RULES, [("b", "b", 1, "X")]), out, 0)
    later = alerts._rules_of(spark, lambda: make(alerts.RULES, [("b", "b", 1, "X")]), out, 1)
    assert [[r["pattern"] for r in t.collect()] for t in (first, again, later)] == [["a"], ["a"], ["b"]]


# Late reports


def test_reports_come_batches_after_the_request(make, spark, tmp_path):
    out, arrived, waits, ends = (str(tmp_path / x) for x in ("out", "arrived", "waits", "ends"))
    lines = [(i, f"ERROR: timeout {i}" if i else "CRITICAL: Port 80", dt.datetime(2024, 1, 1, 0, i)) for i in range(7)]
    make("log_id bigint, log_line string, event_time timestamp", lines).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("log_id bigint, log_line string, event_time timestamp").parquet(str(tmp_path / "in"))
    pipelines.start_triage(stream, files.load_tools(spark), files.load_policy(spark), out, str(tmp_path / "ck"), dry_run=False, once=True).awaitTermination()
    schema = "request_id bigint, status string, output string, executed_at timestamp"
    make(schema, []).write.parquet(arrived)
    sources.open_end(spark, ends)

    def run(*rows, end=None):
        if rows:
            make(schema, [(i, s, o, dt.datetime(2024, 1, 1, h, m)) for i, s, o, h, m in rows]).write.mode("append").parquet(arrived)
        if end:
            sources.end_stream(spark, ends, end)
        told = spark.readStream.schema(schema).parquet(arrived).withColumnRenamed("executed_at", "event_time")
        told = sources.with_end(told, ends).withColumnRenamed("event_time", "executed_at")
        outcomes.start_reports(outcomes.follow_governed(spark, out), told, out, waits, 4, once=True).awaitTermination()
        audit = {r["incident_id"]: r["status"] for r in outcomes.report_audit(spark, out).collect()}
        return audit, {r["incident_id"]: r["resolved_at"] for r in outcomes.current_incidents(spark, out).collect() if r["status"] == "resolved"}

    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    assert run((99, "executed", "unknown request", 0, 30), (0, "executed", "was not ready", 0, 30)) == ({}, {})
    assert run((1, "executed", "ok", 0, 31)) == ({1: "executed"}, {1: at(0, 31)})
    audit, resolved = run((2, "failed", "no", 0, 40), (3, "executed", "", 0, 41), (3, "failed", "first try", 0, 39))
    assert audit == {1: "executed", 2: "failed", 3: "executed"} and resolved == {1: at(0, 31), 3: at(0, 41)}
    # A later report takes the place of an earlier one, an earlier one does not, and a repeated one changes nothing.
    audit, resolved = run((2, "executed", "second try", 1, 0), (3, "failed", "old", 0, 38), (1, "executed", "ok", 0, 31))
    assert audit == {1: "executed", 2: "executed", 3: "executed"} and resolved == {1: at(0, 31), 2: at(1, 0), 3: at(0, 41)}
    before = outcomes.reports(spark, out).count()
    audit, resolved = run(end="2024-01-02 00:00:00")
    assert audit == {1: "executed", 2: "executed", 3: "executed", 4: "timeout", 5: "timeout", 6: "timeout"}
    assert resolved == {1: at(0, 31), 2: at(1, 0), 3: at(0, 41)}
    assert outcomes.reports(spark, out).count() == before + 3
    assert run((4, "executed", "too late", 2, 0)) == (audit, resolved)


def test_many_requests_share_few_states(make, spark, tmp_path):
    n = 40
    governed = [(i, "T", i, dt.datetime(2024, 1, 1, 0, i), "LOW", False, "ready", True, "m", "a", None, []) for i in range(n)]
    make(outcomes.GOVERNED, governed).write.parquet(str(tmp_path / "governed"))
    told = [(i, "executed", "in time", dt.datetime(2024, 1, 1, 1, i)) for i in range(0, n, 2)]
    told += [(i, "failed", "of a later day", dt.datetime(2024, 1, 1, 23)) for i in range(n)]
    make("request_id bigint, status string, output string, executed_at timestamp", told).write.parquet(str(tmp_path / "arrived"))
    arrived = spark.readStream.schema("request_id bigint, status string, output string, executed_at timestamp").parquet(str(tmp_path / "arrived"))
    accepted = outcomes.accepted_reports(outcomes.follow_governed(spark, str(tmp_path)), arrived, 4, buckets=3)
    before = spark.conf.get(outcomes.PROVIDER_CONF)
    spark.conf.set(outcomes.PROVIDER_CONF, outcomes.ROCKSDB)
    try:
        stream = accepted.writeStream.option("checkpointLocation", str(tmp_path / "waits")).trigger(availableNow=True).start(str(tmp_path / "out"), "parquet", "append")
        stream.awaitTermination()
    finally:
        spark.conf.set(outcomes.PROVIDER_CONF, before)
    # A report of what came after the time-out takes no place of one in time and keeps no request from timing out.
    rows = spark.read.schema(accepted.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted((r["request_id"], r["status"], r["executed_at"].hour) for r in rows) == [(i, *(("timeout", 4) if i % 2 else ("executed", 1))) for i in range(n)]
    assert max(m.numRowsTotal for m in _state_rows(stream)) <= 3


def _state_rows(stream):
    return [s for p in stream.recentProgress for s in p.stateOperators]


def test_reports_are_ordered_as_structs_are():
    rows = [(5, None, "x"), (5, "a", None), (5, "a", "b"), (4, "z", "z"), (5, None, None)]
    assert max(rows, key=outcomes._order) == (5, "a", "b") and min(rows, key=outcomes._order) == (4, "z", "z")
    assert governance.TIMEOUT == "timeout"


# Rollup


@pytest.mark.parametrize("as_of", ["2024-01-10 00:00:00", "2024-01-09 23:17:30.5"])
def test_rollup_counts_equal_the_lines(make, spark, tmp_path, as_of):
    rng = random.Random(6)
    lines = ["ERROR: auth failed", "WARNING: nginx slow", "INFO: apache ok", "CRITICAL: disk", "INFO: quiet"]
    rows = [(i, NOW - dt.timedelta(seconds=rng.randint(-4000, 200_000)), rng.choice(lines)) for i in range(900)]
    rows += [(1000 + h, dt.datetime.fromisoformat(as_of) - dt.timedelta(hours=h), "ERROR: on the edge") for h in range(5)]
    table = make(LOG_SCHEMA, rows)
    kept = rollup.Rollup(spark, str(tmp_path), every=2)
    for part in (0, 1, 2, 1):  # one batch comes again
        kept.add(table.where(F.col("log_id") % 3 == part), part)
    asked = make("hours int", [(h,) for h in (0, 1, 2, 24, 24, 48, 500)])
    got = {(r["hours"], r["name"]): r["n"] for r in kept.counts(table, asked, as_of).collect()}
    assert len(got) == 6 * len(kept.predicates)
    end = dt.datetime.fromisoformat(as_of)
    words = {"error": ("ERROR", "CRITICAL"), "anomaly": ("ERROR", "CRITICAL", "WARNING"), "auth": ("auth",), "apache": ("apache",), "nginx": ("nginx",)}
    for (hours, name), n in got.items():
        assert n == sum(at >= end - dt.timedelta(hours=hours) and any(w in x for w in words[name]) for _, at, x in rows)
    # Lines outside the hours in which windows begin are not needed.
    begins = {(end - dt.timedelta(hours=h)).replace(minute=0, second=0, microsecond=0) for h in (0, 1, 2, 24, 48, 500)}
    few = make(LOG_SCHEMA, [r for r in rows if r[1].replace(minute=0, second=0, microsecond=0) in begins])
    assert {(r["hours"], r["name"]): r["n"] for r in kept.counts(few, asked, as_of).collect()} == got


def test_rollup_of_nothing(make, spark, tmp_path):
    kept = rollup.Rollup(spark, str(tmp_path))
    got = kept.counts(make(LOG_SCHEMA, []), make("hours int", [(1,), (24,)]), AS_OF).collect()
    assert sorted((r["hours"], r["n"]) for r in got) == [(1, 0)] * 5 + [(24, 0)] * 5

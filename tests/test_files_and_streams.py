"""File readers and sinks, and streams that equal their batch twins."""

import datetime as dt
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.operators import logs, rules
from faultline.session import shared_dir, work_dir
from faultline.sources import files
from faultline.streaming import mining, pipelines, sources
from test_templates import long_lines, sample_lines, sequential

AS_OF = "2024-01-10T00:00:00"
SPLIT = "spark.sql.files.maxPartitionBytes"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write(tmp_path, name, content, mode="w"):
    path = tmp_path / name
    with open(path, mode) as f:
        f.write(content)
    return str(path)


def rows(df):
    return [tuple(r)[1:] for r in df.orderBy("log_id").collect()]


def test_csv(spark, tmp_path):
    content = 'timestamp,log_line,is_anomaly\nt1,"  a, ""b"" ",1\nt2,   ,1\nt3,c,yes\nt4,d,\nt5,e,007\n'
    path = write(tmp_path, "x.csv", content)
    assert rows(files.load_logs(spark, path, AS_OF)) == [('a, "b"', 1, "t1"), ("c", 0, "t3"), ("d", 0, "t4"), ("e", 7, "t5")]
    only_lines = write(tmp_path, "y.txt", "log_line\nx\n")
    assert rows(files.load_logs(spark, only_lines, AS_OF)) == [("x", 0, AS_OF)]
    broken = write(tmp_path, "z.csv", b"log_line,is_anomaly\nab\xffc,1\n", "wb")
    assert rows(files.load_logs_csv(spark, broken, AS_OF)) == [("abc", 1, AS_OF)]


ENTRIES = [{"log_line": "a", "is_anomaly": 1, "timestamp": "t"}, "bare", {"log": "b", "anomaly": True}, {"log_line": ""}, {"x": 1}]
LOADED = [("a", 1, "t"), ("bare", 0, AS_OF), ("b", 1, AS_OF), ("", 0, AS_OF), ("", 0, AS_OF)]


@pytest.mark.parametrize("document", [ENTRIES, {"logs": ENTRIES}])
def test_json(spark, tmp_path, document):
    path = write(tmp_path, "x.json", json.dumps(document, indent=1))
    assert rows(files.load_logs(spark, path, AS_OF)) == LOADED


def test_json_lines(spark, tmp_path):
    objects = [e for e in ENTRIES if isinstance(e, dict)]
    path = write(tmp_path, "x.jsonl", "\n".join(json.dumps(e) for e in objects) + "\n\n")
    assert rows(files.load_logs(spark, path, AS_OF)) == [r for r in LOADED if r[0] != "bare"]


def test_policy_and_tools(spark, tmp_path):
    policy = {"actions": {"A": {"risk_level": "HIGH", "requires_approval": True, "description": "d"}}, "dry_run_mode": False}
    path = write(tmp_path, "p.json", json.dumps(policy, indent=2))
    assert [tuple(r) for r in files.load_policy(spark, path).collect()] == [("A", "HIGH", True, "d")]
    assert files.load_dry_run(spark, path) is False
    assert files.load_dry_run(spark, write(tmp_path, "q.json", '{"actions": {}}')) is True
    tools = {"tools": [
        {"name": "T", "description": "x", "inputSchema": {"type": "object", "properties": {"p": {"type": "string"}}, "required": ["p"]},
         "risk_level": "LOW", "requires_approval": False},
        {"name": "U", "description": "y", "inputSchema": {"type": "object", "properties": {}}},
    ], "version": "1"}
    got = files.load_tools(spark, write(tmp_path, "t.json", json.dumps(tools))).collect()
    assert [(r["name"], r["required"]) for r in got] == [("T", ["p"]), ("U", [])]
    assert files.load_policy(spark).count() == files.load_tools(spark).count() == 3


def test_sinks(spark, make, tmp_path):
    table = make("log_id bigint, timestamp timestamp_ntz, log_line string", [
        (1, dt.datetime(2024, 1, 1, 5), "a"), (2, dt.datetime(2024, 1, 2), "b"),
    ])
    path = str(tmp_path / "logs")
    files.append_logs(table, path)
    files.append_logs(table.filter("log_id = 2").withColumn("log_id", F.lit(3).cast("bigint")), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3 and stored.filter("log_date = '2024-01-02'").count() == 2
    audit = make("tool_name string, error string", [("A", None)])
    files.append_audit(audit, str(tmp_path / "audit"))
    assert spark.read.text(str(tmp_path / "audit")).first()[0] == '{"tool_name":"A","error":null}'
    files.write_json(audit, str(tmp_path / "report"))
    files.append_rows(audit, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured
    assert work_dir(spark, "x") != work_dir(spark, "x")


STREAM_LINES = [
    f"2024-01-01 {h:02d}:{m:02d}:00 {t}"
    for h in range(6)
    for m, t in [(1, "ERROR: timeout on Port 80"), (2, "INFO: auth ok from 10.0.0.1"), (3, "CRITICAL: disk"), (4, "Failed /a/b"), (5, "")]
] + ["no time ERROR: x", "   "]


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for i in range(3):
        write(folder, f"part{i}.log", "\n".join(STREAM_LINES[i::3]) + "\n")
    return str(folder)


def test_ingest_stream_equals_batch(spark, make, landing, tmp_path):
    out = str(tmp_path / "out")
    stream = sources.follow_logs(spark, landing, max_files=1)
    pipelines.start_ingest(stream, out, str(tmp_path / "ck"), once=True).awaitTermination()
    stored = spark.read.parquet(f"{out}/logs")
    lines = make("log_id bigint, log_line string", list(enumerate(STREAM_LINES)))
    batch = logs.ingest(lines)
    columns = ["log_line", "is_anomaly", "template_pattern", "template_id"]
    assert sorted(map(tuple, stored.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    assert stored.select("log_id").distinct().count() == stored.count()
    assert stored.select("batch_id").distinct().count() == 3
    timed = stored.filter(F.col("log_line").startswith("2024")).select("log_line", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    assert all(line.startswith(at) for line, at in timed.collect())
    index = spark.read.parquet(f"{out}/lexical_index")
    assert index.count() == logs.lexical_index(batch).count()
    # A second run over the same folder finds nothing new.
    pipelines.start_ingest(stream, out, str(tmp_path / "ck"), once=True).awaitTermination()
    assert spark.read.parquet(f"{out}/logs").count() == batch.count()


def test_triage_stream(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    stream = sources.follow_logs(spark, landing)
    pipelines.start_triage(
        stream, files.load_tools(spark), files.load_policy(spark), out, str(tmp_path / "ck"), dry_run=False, once=True
    ).awaitTermination()
    incidents = spark.read.parquet(f"{out}/incidents")
    flagged = [x for x in STREAM_LINES if any(w in x for w in detect.MONITOR_KEYWORDS)]
    assert sorted(r["log_line"] for r in incidents.collect()) == sorted(flagged)
    assert {r["status"] for r in incidents.collect()} == {"open"}  # nothing has run
    assert spark.read.parquet(f"{out}/audit").count() == 2 * len(flagged)


def test_alert_stream_equals_batch_on_closed_windows(spark, make, landing, tmp_path):
    known = [("timeout", text.PATTERN_REGEX["timeout"], 1, "X"), ("CRITICAL", "CRITICAL", 2, "Y")]
    stream = sources.follow_logs(spark, landing).filter(F.col("log_line").startswith("2024"))
    alerts = pipelines.alert_counts(stream, known, "1 minute", "2 hours")
    out = str(tmp_path / "alerts")
    pipelines.start_alerts(alerts, out, str(tmp_path / "ck"), once=True).awaitTermination()
    got = sorted(map(tuple, spark.read.schema(alerts.schema).parquet(out).collect()))
    table = make("timestamp timestamp_ntz, log_line string", [
        (dt.datetime.fromisoformat(x[:19]), x) for x in STREAM_LINES if x.startswith("2024")
    ])
    rule_table = make("pattern string, regex string, threshold bigint, action string", known)
    batch = rules.windowed_alerts(table, rule_table, "2 hours").select(alerts.columns)
    closed = [tuple(r) for r in batch.collect() if r["window_end"] <= dt.datetime(2024, 1, 1, 5, 4)]
    assert got == sorted(closed) and len(got) == 4


def _mining_input(spark, make, tmp_path, files=3):
    """Lines dealt over tasks out of order, in files of which each overlaps the next in time."""
    lines = sample_lines(150) + long_lines(150) + sample_lines(150)
    rows = [(i, x, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i, x in enumerate(lines)]
    random.Random(2).shuffle(rows)
    rows.sort(key=lambda r: (r[0] + random.Random(r[0]).randint(-40, 40)) * files // len(lines))
    folder, size = str(tmp_path / "in"), len(rows) // files
    for i in range(files):
        part = make("log_id bigint, log_line string, event_time timestamp", rows[i * size :] if i == files - 1 else rows[i * size : (i + 1) * size])
        part.coalesce(1).write.mode("append").parquet(folder)
    return lines, folder


@pytest.mark.parametrize("compare", ["rest", "line"])
def test_template_stream_equals_batch(spark, make, tmp_path, compare):
    lines, folder = _mining_input(spark, make, tmp_path)
    ends = sources.open_end(spark, str(tmp_path / "ends"))
    stream = spark.readStream.schema("log_id bigint, log_line string, event_time timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    mined = mining.mined_stream(sources.with_end(stream.repartition(8), ends), compare=compare, watermark="3 minutes")
    out, checkpoint = str(tmp_path / "mined"), str(tmp_path / "ck")
    before = spark.conf.get(mining.PROVIDER_CONF), spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "20")
    try:
        mining.start_mining(mined, out, checkpoint, once=True).awaitTermination()
        early = spark.read.schema(mined.schema).parquet(out).count()
        sources.end_stream(spark, ends, "2024-06-01 00:00:00")
        mining.start_mining(mined, out, checkpoint, once=True).awaitTermination()
    finally:
        spark.conf.set(ARROW_ROWS, before[1])
    assert spark.conf.get(mining.PROVIDER_CONF) == before[0]
    got = spark.read.schema(mined.schema).parquet(out).orderBy("log_id").collect()
    assert 0 < early < len(lines)  # the last lines come with the end only
    assert [r["log_id"] for r in got] == list(range(len(lines)))
    assert [r["template_pattern"] for r in got] == sequential(lines, compare=compare)


class _Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))


class _List(list):
    get = list.copy

    def appendValue(self, row):
        self.append(row)

    def appendList(self, rows):
        self.extend(rows)


class _Handle:
    def __init__(self):
        self.timers = set()

    def getListState(self, *_):
        return _List()

    def getMapState(self, *_):
        return _Map()

    def getValueState(self, *_):
        cell = type("Cell", (), {"v": None, "get": lambda s: s.v, "update": lambda s, v: setattr(s, "v", v)})
        return cell()

    def registerTimer(self, ms):
        self.timers.add(ms)


def test_mining_state_is_flat_over_repeats_and_forgets():
    hour = 3_600_000_000

    def drive(forget, hours):
        leaf, handle, answers = mining._MineLeaf(0.5, forget), _Handle(), []
        leaf.init(handle)
        for h in range(hours):
            lines = ["same", f"once {h}"] if h < hours // 2 else ["same"]
            batch = pd.DataFrame([(x, "leaf", [hash(x)], x, [hash(x)], [h * hour + k], [2 * h + k]) for k, x in enumerate(lines)],
                                 columns=["digest", "leaf", "tokens", "own_pattern", "own_tokens", "times", "ids"])
            clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda s: (h + 1) * hour // 1000})()
            answers += list(leaf.handleInputRows(("leaf",), iter([batch]), clock)) + list(leaf.handleExpiredTimer(("leaf",), clock, None))
        assert not leaf.waiting
        return leaf, pd.concat(answers)

    kept, told = drive(None, 40)
    assert len(kept.answers) == 21 and len(told) == 60
    bounded, told = drive(8 * hour, 40)
    assert set(bounded.answers) == {("same",)} and set(told["template_pattern"]) >= {"same", "once 3"}


def test_ids_follow_the_files(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for name, first in (("b", 300), ("a", 0), ("c", 600)):
        write(folder, f"{name}.csv", "log_line,is_anomaly\n" + "".join(f"line {first + k},0\n" for k in range(300)))
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "1k")  # many blocks of each file
    try:
        got = files.load_logs(spark, str(folder), AS_OF).orderBy("log_id").collect()
    finally:
        spark.conf.set(SPLIT, before)
    assert [(r["log_id"], r["log_line"]) for r in got] == [(k, f"line {k}") for k in range(900)]


@pytest.mark.parametrize("content", ["{}", '{"entries": []}', "[1, 2", '"text"', "17"])
def test_json_of_another_form_fails(spark, tmp_path, content):
    path = write(tmp_path, "x.json", content)
    with pytest.raises(Exception, match="x.json"):
        files.load_logs(spark, path, AS_OF).collect()


def test_broken_json_line_fails(spark, tmp_path):
    path = write(tmp_path, "x.jsonl", '{"log": "a"}\n"bare"\n{"log": "b"\n')
    with pytest.raises(Exception, match="x.jsonl"):
        files.load_logs(spark, path, AS_OF).collect()
    path = write(tmp_path, "y.jsonl", '{"log": "a"}\n"bare"\n')
    assert rows(files.load_logs(spark, path, AS_OF)) == [("a", 0, AS_OF), ("bare", 0, AS_OF)]
    assert rows(files.load_logs(spark, write(tmp_path, "z.json", "[]"), AS_OF)) == []

"""Registered streaming queries: drain the given tables once, then read the result."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.functions import text
from faultline.functions.times import micros_between
from faultline.plans.queries import query
from faultline.operators import questions, rules, templates
from faultline.session import work_dir
from faultline.sources import files, warehouse as wh
from faultline.streaming import alerts, growing, mining, outcomes, pipelines, rollup, snapshots, sources

# Alert rules of the streaming query: every known pattern class, from 2 matches on.
STREAM_RULES = [(p, r, 2, "ESCALATE") for p, r in text.PATTERN_REGEX.items()]

# Later than every event by more than any watermark delay.
END_OF_TIME = "2100-01-01 00:00:00"
# Not on the hour, so that windows begin within one.
TRAILING_AS_OF = "2024-01-30 22:17:30"
# Longer than all logs last, so that the two halves of the reports are both in time.
TIMEOUT_HOURS = 24 * 60


def _finish(running: StreamingQuery) -> None:
    running.awaitTermination()


def _landing(spark, d) -> str:
    """Log lines with a full leading time, written as text files to follow."""
    path = work_dir(spark, "landing")
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    lines = wh.logs(spark, d).select(F.concat(stamp, F.substr(F.col("log_line"), F.lit(11))).alias("value"))
    lines.write.text(path)
    return path


def _event_stream(spark, d):
    events = sources.follow_table(spark, d, "events")
    return wh.logs_from_events(events).withColumn("event_time", F.col("timestamp").cast("timestamp")).drop("timestamp")


@query
def stream_logs(spark, d):
    """Follow a landing folder: each line with the time written in it."""
    out, checkpoint = work_dir(spark, "followed"), work_dir(spark, "checkpoint")
    stream = sources.follow_logs(spark, _landing(spark, d)).select(
        "log_line", F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    _finish(writer.trigger(availableNow=True).start(out))
    return spark.read.schema(stream.schema).parquet(out)


HOSTS = 16


def _write_growing(spark, d, folder: str, share: float) -> None:
    """Files of log lines, one per host, each up to ``share`` of its bytes: what a writer has appended so far.

    Tasks write whole files, so a repeated task leaves the same bytes; a larger share
    begins with the bytes of a smaller one.
    """
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    lines = wh.logs(spark, d).select(
        F.pmod("log_id", F.lit(HOSTS)).cast("int").alias("host"), "log_id", F.concat(stamp, F.substr(F.col("log_line"), F.lit(11))).alias("line"))

    def write(batches):
        system, root = growing._open(folder)
        held: dict[int, list[str]] = {}
        for batch in batches:
            for host, line in zip(batch["host"].to_pylist(), batch["line"].to_pylist()):
                held.setdefault(host, []).append(line + "\n")
        for host, parts in held.items():
            data = "".join(parts).encode()
            with system.open_output_stream(f"{root}/host-{host}.log") as file:
                file.write(data[: int(len(data) * share)])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(held), pa.int32())], ["host"])

    growing._open(folder)[0].create_dir(growing._open(folder)[1])
    lines.repartition("host").sortWithinPartitions("host", "log_id").mapInArrow(write, "host int").count()


@query
def stream_growing(spark, d):
    """Follow files that grow between two runs; the first run ends within a line of each file."""
    folder, out, checkpoint = work_dir(spark, "growing"), work_dir(spark, "followed"), work_dir(spark, "checkpoint")
    for share in (0.4, 1.0):
        _write_growing(spark, d, folder, share)
        stream = growing.follow_growing(spark, folder, split_bytes=1 << 16).select(
            "log_line", F.col("event_time").cast("timestamp_ntz").alias("event_time"))
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        _finish(writer.trigger(availableNow=True).start(out))
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_ingest(spark, d):
    """Logs and index of a followed folder, joined on the ids the stream gave them."""
    out = work_dir(spark, "ingest")
    stream = sources.follow_logs(spark, _landing(spark, d))
    _finish(pipelines.start_ingest(stream, out, work_dir(spark, "checkpoint"), once=True))
    stored = spark.read.parquet(f"{out}/logs")
    per_log = spark.read.parquet(f"{out}/lexical_index").groupBy("log_id").agg(F.count("*").alias("keywords"))
    return stored.join(per_log, "log_id", "left").select(
        "log_line", "timestamp", "is_anomaly", "template_pattern", F.coalesce("keywords", F.lit(0)).alias("keywords")
    )


@query
def stream_triage(spark, d):
    """Incidents and governed actions of anomalous events, approvals withheld."""
    out = work_dir(spark, "triage")
    running = pipelines.start_triage(
        _event_stream(spark, d).drop("is_anomaly"),
        files.load_tools(spark),
        files.load_policy(spark),
        out,
        work_dir(spark, "checkpoint"),
        dry_run=False,
        once=True,
        outcomes=wh.action_outcomes(spark, d),
    )
    _finish(running)
    steps = spark.read.parquet(f"{out}/audit").groupBy("incident_id").agg(F.count("*").alias("audit_steps"))
    governed = spark.read.parquet(f"{out}/governed").select(
        "incident_id", "tool_name", F.col("status").alias("action_status"), "message"
    )
    incidents = spark.read.parquet(f"{out}/incidents").drop("batch_id")
    return incidents.join(governed, "incident_id").join(steps, "incident_id")


@query
def stream_outcomes(spark, d):
    """Incidents and the audit of their actions, from reports that come two runs after the requests or never."""
    out, checkpoint, waits = work_dir(spark, "triage"), work_dir(spark, "checkpoint"), work_dir(spark, "checkpoint")
    arrived, ends = work_dir(spark, "outcomes"), sources.open_end(spark, work_dir(spark, "ends"))
    known = wh.action_outcomes(spark, d)
    known.limit(0).write.parquet(arrived)
    _finish(pipelines.start_triage(
        _event_stream(spark, d).drop("is_anomaly"), files.load_tools(spark), files.load_policy(spark), out, checkpoint, dry_run=False, once=True))

    def wait():
        told = spark.readStream.schema(known.schema).parquet(arrived).select(
            "request_id", "status", "output", F.col("executed_at").cast("timestamp").alias("event_time"))
        told = sources.with_end(told, ends).withColumnRenamed("event_time", "executed_at")
        _finish(outcomes.start_reports(outcomes.follow_governed(spark, out), told, out, waits, TIMEOUT_HOURS, once=True))

    wait()
    for part in (0, 1):
        known.where(F.pmod("request_id", F.lit(2)) == part).write.mode("append").parquet(arrived)
        wait()
    sources.end_stream(spark, ends, END_OF_TIME)
    wait()
    audit = outcomes.report_audit(spark, out).select("incident_id", F.col("status").alias("report"), "executed_at", "error")
    current = outcomes.current_incidents(spark, out)
    recovery = F.round(micros_between(F.col("detected_at"), F.col("resolved_at")) / F.lit(1e6), 4)
    return current.join(audit, "incident_id", "left").select("incident_id", "status", "resolved_at", recovery.alias("recovery_seconds"), "report", "executed_at", "error")


@query
def stream_alerts(spark, d):
    """Alerts of all windows that the watermark has closed."""
    out = work_dir(spark, "alerts")
    counted = pipelines.alert_counts(_event_stream(spark, d), STREAM_RULES)
    _finish(pipelines.start_alerts(counted, out, work_dir(spark, "checkpoint"), once=True))
    return spark.read.schema(counted.schema).parquet(out)


def _until_the_end(start, spark, ends: str) -> None:
    """Run a stream over what is there, then once more with an end, so that nothing is held back."""
    _finish(start())
    sources.end_stream(spark, ends, END_OF_TIME)
    _finish(start())


@query
def stream_rule_alerts(spark, d):
    """Alerts per day by the rules that the incidents suggest, the last day included."""
    out, checkpoint, ends = work_dir(spark, "alerts"), work_dir(spark, "checkpoint"), sources.open_end(spark, work_dir(spark, "ends"))
    stream = sources.with_end(_event_stream(spark, d).select("log_line", "event_time"), ends)
    suggested = lambda: rules.suggest_rules(wh.incidents(spark, d), wh.AS_OF, 24)
    _until_the_end(lambda: alerts.start_rule_alerts(stream, suggested, out, checkpoint, "1 day", once=True), spark, ends)
    return spark.read.schema(alerts.ALERTS).parquet(out + "/alerts").drop("batch_id")


@query
def stream_template_table(spark, d):
    """The template table kept by a stream of which every batch is processed twice."""
    folder, path = work_dir(spark, "templated"), work_dir(spark, "templates")
    wh.templated_logs(spark, d).repartition(6, "log_id").write.parquet(folder)
    stream = spark.readStream.schema("log_id bigint, timestamp timestamp_ntz, template_pattern string").option("maxFilesPerTrigger", 1).parquet(folder)
    table = snapshots.template_snapshots(spark, path, every=4)

    def twice(batch, batch_id):
        for _ in range(2):
            table.add(templates.template_table(batch), batch_id)

    _finish(pipelines.start_batches(stream, twice, work_dir(spark, "checkpoint"), once=True))
    return table.current().select("template_pattern", "frequency", "created_at", "first_log_id", "template_id")


@query
def trailing_counts(spark, d):
    """Lines of the windows that questions ask for, from an hourly rollup and the hours in which the windows begin."""
    kept = rollup.Rollup(spark, work_dir(spark, "rollup"), every=2)
    flagged = wh.logs(spark, d)
    for part in range(3):
        kept.add(flagged.where(F.pmod("log_id", F.lit(3)) == part), part)
    asked = questions.route_questions(wh.questions(spark, d)).select("hours")
    return kept.counts(flagged, asked, TRAILING_AS_OF)


@query
def stream_templates(spark, d):
    """Greedy templates mined with state in event-time order; equal to the batch result."""
    out, checkpoint, ends = work_dir(spark, "mined"), work_dir(spark, "checkpoint"), sources.open_end(spark, work_dir(spark, "ends"))
    mined = mining.mined_stream(sources.with_end(_event_stream(spark, d).select("log_id", "log_line", "event_time"), ends))
    _until_the_end(lambda: mining.start_mining(mined, out, checkpoint, once=True), spark, ends)
    return spark.read.schema(mined.schema).parquet(out)

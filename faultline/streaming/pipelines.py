"""Streaming jobs.  Each start_* function returns a running StreamingQuery.

Batch sinks write under ``batch_id=N`` and overwrite that folder, so a replayed
micro-batch leaves the same rows once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.streaming import StreamingQuery

from faultline.functions import detect, text
from faultline.operators import governance, incidents, logs
from faultline.operators.rules import matching_rules


def start_batches(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Run ``process`` on every micro-batch; ``once`` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _save(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write one batch's rows and return them as stored."""
    target = f"{path}/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(target)
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


def complete(spark: SparkSession, folder: str, name: str = "batch_id") -> list[int]:
    """The N of the folders ``name=N`` that have been written in full."""
    jvm = spark.sparkContext._jvm
    system = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def dense_ids(rows: DataFrame, base: int) -> DataFrame:
    """``rows`` with ``log_id`` = ``base``, base + 1, ... in the order of their columns ``part`` and ``row``.

    The counts of the parts (one row for each task of a batch) give where each part
    starts; the rows of a part are numbered by its own task.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.coalesce(F.sum("n").over(order), F.lit(0)) + F.lit(base).cast("bigint")).alias("start")
    )
    return rows.join(starts, "part").withColumn("log_id", F.col("start") + F.col("row")).drop("part", "row", "start")


def _with_ids(batch: DataFrame, batch_id: int, out: str) -> DataFrame:
    """Lines of one micro-batch with ids that continue those of the batches before.

    The lines are stored with their place before they are counted, and the next free
    id after them, so a replayed batch gets the ids it had.
    """
    spark = batch.sparkSession
    batch = batch.filter(text.strip(F.col("log_line")) != "")
    if "log_id" not in batch.columns:
        local = F.monotonically_increasing_id()  # numbers the rows of each task without gaps, the task in the high bits
        placed = batch.withColumn("local", local).select(
            "*", F.shiftright("local", 33).alias("part"), F.col("local").bitwiseAND(F.lit((1 << 33) - 1)).alias("row")
        )
        lines = _save(placed.drop("local"), f"{out}/lines", batch_id)
        before = [n for n in complete(spark, f"{out}/ids") if n < batch_id]
        # One row of the newest batch; no other file of the ids is read.
        base = spark.read.schema("next_id bigint").parquet(f"{out}/ids/batch_id={before[-1]}").first()[0] if before else 0
        _save(spark.createDataFrame([(base + lines.count(),)], "next_id bigint"), f"{out}/ids", batch_id)
        batch = dense_ids(lines, base)
    return batch.withColumn("timestamp", F.col("event_time").cast("timestamp_ntz")).drop("event_time")


def start_ingest(stream: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Lines → logs and lexical_index tables under ``out``.

    The index is built from the stored logs, so both tables carry the same ids even
    if part of the batch has to be recomputed.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        stored = _save(logs.ingest(_with_ids(batch, batch_id, out)), f"{out}/logs", batch_id)
        _save(logs.lexical_index(stored), f"{out}/lexical_index", batch_id)

    return start_batches(stream, process, checkpoint, once)


def start_triage(
    stream: DataFrame,
    tools: DataFrame,
    policy: DataFrame,
    out: str,
    checkpoint: str,
    dry_run: bool = True,
    once: bool = False,
    outcomes: DataFrame | None = None,
) -> StreamingQuery:
    """Anomalous lines → incidents, governed actions and audit events under ``out``.

    An incident is resolved only by an outcome (see :func:`governance.record_outcomes`)
    of an action that has run; those not reported yet stay open.
    """
    flagged = stream.filter(detect.detect_monitor(F.col("log_line")))

    def process(batch: DataFrame, batch_id: int) -> None:
        opened = incidents.open_incidents_from_logs(_with_ids(batch, batch_id, out), F.lit(True))
        opened = _save(opened, f"{out}/opened", batch_id)
        requests = opened.select(
            F.col("incident_id").alias("request_id"),
            detect.diagnose(F.col("log_line"))["action"].alias("tool_name"),
            "incident_id",
            F.lit(None).cast("map<string,string>").alias("params"),
            F.col("detected_at").alias("requested_at"),
        )
        governed = _save(
            governance.govern_actions(requests, tools, policy, dry_run=dry_run), f"{out}/governed", batch_id
        )
        _save(governance.audit_events(governed), f"{out}/audit", batch_id)
        if outcomes is not None:
            opened = incidents.apply_resolutions(opened, governance.resolutions_from(governed, outcomes))
        _save(opened, f"{out}/incidents", batch_id)

    return start_batches(flagged, process, checkpoint, once)


def alert_counts(
    stream: DataFrame,
    rules: list[tuple[str, str, int, str]],
    watermark: str = "10 minutes",
    window: str = "1 hour",
    slide: str | None = None,
) -> DataFrame:
    """Rules whose matches reach the threshold within an event-time window.

    ``rules``: (pattern, regex, threshold, action).  Late lines are dropped once the
    watermark has passed their window.
    """
    matched = stream.withWatermark("event_time", watermark).select(
        "event_time", F.explode(matching_rules(F.col("log_line"), rules)).alias("r")
    )
    span = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return (
        matched.groupBy(span.alias("w"), "r.pattern", "r.threshold", "r.action")
        .agg(F.count("*").alias("matches"))
        .filter(F.col("matches") >= F.col("threshold"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "pattern",
            "matches",
            F.col("threshold").cast("bigint").alias("threshold"),
            "action",
        )
    )


def start_alerts(alerts: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the alerts of closed windows to Parquet files."""
    writer = alerts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(out)

"""Alerts by rules that change while the stream runs.

Every micro-batch reads the rules as they are then and keeps them with the batch, so a
replay uses the same ones. Matches are counted per window and rule of that batch and
stored as an increment; a window is settled when the watermark (the newest event time so
far less ``delay``) has passed its end. It alerts for each rule, as the settling batch
knows it, whose matches reach the threshold: a rule that was added later counts the lines
since, a rule that was dropped does not alert, a changed threshold holds for all windows
still open. Lines of settled windows are late and left out.

A row without a line moves the time only, so :func:`faultline.streaming.sources.with_end`
settles the last windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from faultline.operators.rules import RULE_FIELDS, rule_matches
from faultline.streaming.pipelines import _save, complete, start_batches

RULES = "pattern string, regex string, threshold bigint, action string"
COUNTS = "window_start timestamp, window_end timestamp, pattern string, regex string, matches bigint, batch_id int"
TIMES = "newest timestamp, settled timestamp, batch_id int"
ALERTS = "window_start timestamp_ntz, window_end timestamp_ntz, pattern string, matches bigint, threshold bigint, action string"
_FIRST = "0001-01-01 00:00:00"


def _rules_of(spark: SparkSession, source: Callable[[], DataFrame], out: str, batch_id: int) -> DataFrame:
    """The rules of a batch: those kept with it if it is a replay."""
    if batch_id not in complete(spark, f"{out}/rules"):
        _save(source().select(*[F.col(c).cast(f.dataType) for c, f in zip(RULE_FIELDS, T.StructType.fromDDL(RULES))]), f"{out}/rules", batch_id)
    return spark.read.schema(RULES).parquet(f"{out}/rules/batch_id={batch_id}")


def start_rule_alerts(
    stream: DataFrame, rules: Callable[[], DataFrame], out: str, checkpoint: str,
    window: str = "1 hour", slide: str | None = None, delay: str = "10 minutes", once: bool = False,
) -> StreamingQuery:
    """Alerts of settled windows of ``stream`` (log_line, event_time) under ``out``/alerts.

    ``rules``: called for each batch; returns pattern, regex, threshold, action.
    """
    spark = stream.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        known = _rules_of(spark, rules, out, batch_id)
        batch = batch.select("log_line", "event_time")
        times = spark.read.schema(TIMES).parquet(f"{out}/times").where(F.col("batch_id") < batch_id) if batch_id else spark.createDataFrame([], TIMES)
        last, settled = times.agg(F.max("newest"), F.max("settled")).first()
        newest = batch.agg(F.max("event_time")).first()[0]
        newest = max((t for t in (last, newest) if t is not None), default=None)
        passed = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        now = spark.range(1).select(F.lit(newest).cast("timestamp").alias("newest"), passed.alias("settled"))
        now = _save(now.withColumn("settled", F.greatest("settled", F.lit(settled).cast("timestamp"))), f"{out}/times", batch_id)
        until = now.first()["settled"]
        since = F.lit(settled).cast("timestamp") if settled is not None else F.lit(_FIRST).cast("timestamp")

        span = F.window("timestamp", window, slide) if slide else F.window("timestamp", window)
        lines = batch.where("log_line is not null").withColumnRenamed("event_time", "timestamp")
        counts = rule_matches(lines, known).groupBy(span.alias("w"), "r.pattern", "r.regex").agg(F.count("*").alias("matches")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pattern", "regex", "matches")
        _save(counts.where(F.col("window_end") > since), f"{out}/counts", batch_id)

        closed = spark.read.schema(COUNTS).parquet(f"{out}/counts").where(F.col("batch_id") <= batch_id)
        closed = closed.where((F.col("window_end") > since) & (F.col("window_end") <= F.lit(until)))
        totals = closed.groupBy("window_start", "window_end", "pattern", "regex").agg(F.sum("matches").alias("matches"))
        alerts = totals.join(known, ["pattern", "regex"]).where(F.col("matches") >= F.col("threshold"))
        _save(alerts.select(
            *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "pattern", "matches", "threshold", "action"), f"{out}/alerts", batch_id)

    return start_batches(stream, process, checkpoint, once)

"""Counts over trailing windows from an hourly rollup that a stream keeps.

The rollup holds, for each hour and name, how many lines a predicate of that name
accepts; batches add increments, each counted once (see ``snapshots``). A trailing window
``as_of - hours`` and later is then the sum of its whole hours, plus the lines of the one
hour in which it begins: only those are read from the logs, so lines of other hours are
not touched, however long the window is. Answers equal those of counting the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.functions import detect
from faultline.functions.times import instant
from faultline.operators.logs import has_keyword
from faultline.operators.questions import AUTH_PATTERN, SERVICES
from faultline.streaming.pipelines import start_batches
from faultline.streaming.snapshots import EVERY, Snapshots

SCHEMA = "hour timestamp_ntz, name string, n bigint"


def default_predicates() -> dict[str, Column]:
    """What trailing questions count: flagged lines, suspicious ones, and those that name a service."""
    line = F.col("log_line")
    words = {name: has_keyword(line, name) for name in (AUTH_PATTERN, *SERVICES)}
    return {"error": detect.detect_eval(line), "anomaly": detect.detect_ingest(line), **words}


def _names(predicates: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in predicates.items()]))


def hourly(logs: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """hour, name, n of ``logs`` (timestamp, log_line); counts combine before the shuffle."""
    named = logs.select(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour"), F.explode(_names(predicates)).alias("name"))
    return named.groupBy("hour", "name").agg(F.count("*").alias("n"))


def _merge(previous: DataFrame, increments: DataFrame) -> DataFrame:
    return previous.unionByName(increments).groupBy("hour", "name").agg(F.sum("n").alias("n"))


class Rollup:
    def __init__(self, spark: SparkSession, path: str, predicates: dict[str, Column] | None = None, every: int = EVERY):
        self.predicates = predicates or default_predicates()
        self.table = Snapshots(spark, path, SCHEMA, _merge, every)

    def add(self, logs: DataFrame, batch_id: int) -> None:
        self.table.add(hourly(logs, self.predicates), batch_id)

    def counts(self, logs: DataFrame, hours: DataFrame, as_of: str) -> DataFrame:
        """hours, name, n: lines of each trailing window and name, for every distinct value of ``hours``.

        ``logs`` are read in the hours in which windows begin. Starts a job that finds
        the earliest of them, so that the bound reaches the scan.
        """
        cut = instant(as_of) - F.make_dt_interval(F.lit(0), F.col("hours").cast("int"))
        windows = hours.select(F.col("hours").cast("bigint").alias("hours")).distinct().withColumn("cutoff", cut)
        begins = F.date_trunc("hour", "cutoff").cast("timestamp_ntz")
        windows = windows.withColumn("begins", begins).withColumn(
            "whole", F.when(begins == F.col("cutoff"), begins).otherwise(begins + F.make_dt_interval(hours=F.lit(1))))
        asked = windows.withColumn("name", F.explode(F.array(*map(F.lit, self.predicates))))

        # Whole hours: one running sum per name along the hours that have lines or are asked for.
        axis = self.table.current().unionByName(asked.select(F.col("whole").alias("hour"), "name", F.lit(0).cast("bigint").alias("n")))
        axis = axis.groupBy("name", "hour").agg(F.sum("n").alias("n"))
        running = axis.select("name", F.col("hour").alias("whole"), F.sum("n").over(Window.partitionBy("name").orderBy(F.desc("hour"))).alias("rest"))

        beginnings = windows.select("begins").distinct()
        edge = logs.join(beginnings, F.date_trunc("hour", "timestamp").cast("timestamp_ntz") == F.col("begins"), "left_semi")
        first = windows.agg(F.min("cutoff"), F.max("whole")).first()
        if first[0]:
            edge = edge.where((F.col("timestamp") >= F.lit(first[0])) & (F.col("timestamp") < F.lit(first[1])))
        named = edge.select("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("begins"), F.explode(_names(self.predicates)).alias("name"))
        inside = (F.col("timestamp") >= F.col("cutoff")) & (F.col("timestamp") < F.col("whole"))
        part = named.join(windows, "begins").where(inside).groupBy("hours", "name").agg(F.count("*").alias("edge"))
        return asked.join(running, ["name", "whole"]).join(part, ["hours", "name"], "left").select(
            "hours", "name", (F.col("rest") + F.coalesce("edge", F.lit(0))).alias("n"))


def start_rollup(stream: DataFrame, path: str, checkpoint: str, every: int = EVERY, once: bool = False) -> StreamingQuery:
    """Keep the default rollup of ``stream`` (timestamp, log_line) under ``path``."""
    kept = Rollup(stream.sparkSession, path, every=every)
    return start_batches(stream, kept.add, checkpoint, once)

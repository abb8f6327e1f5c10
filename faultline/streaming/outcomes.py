"""Reports on governed actions that arrive after the request, and requests that get none.

A ready request waits in state for what came of it. A report may come in any later
batch, before its request, or more than once; the last one by time holds, as in
:func:`faultline.operators.governance.record_outcomes`. The wait ends when the stream's
time is ``timeout`` past the request: without a report the request has timed out. Later
reports, and reports on what happened later than that, are not taken.

The stream only decides which reports count. Incidents, actions and audit rows follow
from them by the batch functions; see :func:`current_incidents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from faultline.operators import governance, incidents
from faultline.streaming.mining import PROVIDER_CONF, ROCKSDB
from faultline.streaming.pipelines import _save, start_batches
from faultline.streaming.sources import not_an_end

_OUT = "request_id bigint, status string, output string, micros bigint"
_ENTRIES = pa.schema([("request_id", pa.int64()), ("asked", pa.int64()), ("at", pa.int64()), ("status", pa.string()), ("output", pa.string())])
#: Requests share their state by a hash of the id, in so many buckets; fixed for the life of a checkpoint.
BUCKETS = 4096


class _Wait(StatefulProcessor):
    """The requests and reports of one bucket: a call to the state costs as much for one request as for thousands."""

    def __init__(self, timeout_micros: int) -> None:
        self.timeout = timeout_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "timer bigint, entries binary")

    def _load(self) -> tuple[int | None, dict[int, tuple]]:
        """The next timer, and (asked, report) of each request id: when it was asked for and its last report, None if unknown."""
        stored = self.held.get()
        if not stored:
            return None, {}
        ids, asked, at, *said = pa.ipc.open_stream(bytes(stored[1])).read_all().to_pydict().values()
        return stored[0], {i: (a, None if t is None else (t, *rest)) for i, a, t, *rest in zip(ids, asked, at, *said)}

    def _store(self, timer: int | None, held: dict[int, tuple]) -> None:
        """Keep what is held, with a timer for the first of it that ends to wait."""
        if not held:
            self.held.clear()
            return
        first = min(-(-_since(entry) // 1000) for entry in held.values())
        if timer is None or first < timer:
            self.handle.registerTimer(timer := first)
        rows = [(i, asked, *(report or (None, None, None))) for i, (asked, report) in held.items()]
        entries = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRIES)], schema=_ENTRIES)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ENTRIES) as writer:
            writer.write_batch(entries)
        self.held.update((timer, sink.getvalue().to_pybytes()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer, held = self._load()
        requests: dict[int, int] = {}
        reports: list[tuple] = []
        for batch in rows:
            for i, is_request, at, status, output in zip(*(batch[c].tolist() for c in ("request_id", "is_request", "micros", "status", "output"))):
                if is_request:
                    requests[i] = min(int(at), requests.get(i, int(at)))
                else:
                    reports.append((i, (int(at), *(x if isinstance(x, str) else None for x in (status, output)))))
        # What has been given out already; the requests of a batch count before its reports.
        told = {i: held[i][1] if i in held and held[i][0] is not None else None for i in {*requests, *(i for i, _ in reports)}}
        for i, at in requests.items():
            asked, report = held.get(i, (None, None))
            asked = at if asked is None else asked
            held[i] = (asked, report if report and report[0] <= asked + self.timeout else None)
        for i, report in reports:
            asked, best = held.get(i, (None, None))
            if asked is not None and report[0] > asked + self.timeout:
                continue
            held[i] = (asked, report if best is None or _order(report) > _order(best) else best)
        self._store(timer, held)
        better = [(i, held[i][1]) for i, before in told.items() if i in held and held[i][0] is not None and held[i][1] not in (None, before)]
        if better:
            yield _rows(better)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        _, held = self._load()
        left = {i: entry for i, entry in held.items() if -(-_since(entry) // 1000) > passed}
        self._store(None, left)
        silent = [(i, (asked + self.timeout, governance.TIMEOUT, None)) for i, (asked, report) in held.items() if i not in left and asked is not None and not report]
        if silent:
            yield _rows(silent)

    def close(self) -> None:
        pass


def _since(entry: tuple) -> int:
    """A request waits from its own time on; a report without a request, from the report's."""
    asked, report = entry
    return report[0] if asked is None else asked


def _rows(reports: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(i, status, output, at) for i, (at, status, output) in reports], columns=["request_id", "status", "output", "micros"])


def _order(report: tuple) -> tuple:
    """Nulls come first, as in a maximum of structs."""
    return tuple((x is not None, x or 0 if i == 0 else x or "") for i, x in enumerate(report))


def accepted_reports(governed: DataFrame, outcomes: DataFrame, timeout_hours: float = 24.0, buckets: int = BUCKETS) -> DataFrame:
    """Stream of the reports that count: request_id, status, output, executed_at.

    ``governed``: a stream of governed requests with requested_at; those that are not
    ready never wait.  ``outcomes``: a stream of request_id, status, output,
    executed_at; rows of null but executed_at only move the stream's time (see
    :func:`faultline.streaming.sources.with_end`).
    """
    null = F.lit(None).cast("string")
    ready = governed.where(F.col("status") == governance.READY).select(
        "request_id", F.lit(True).alias("is_request"), null.alias("status"), null.alias("output"), F.col("requested_at").cast("timestamp").alias("event_time"))
    told = outcomes.select("request_id", F.lit(False).alias("is_request"), "status", "output", F.col("executed_at").cast("timestamp").alias("event_time"))
    timed = ready.union(told).withWatermark("event_time", f"{int(timeout_hours * 3600)} seconds")
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets))
    rows = timed.where(not_an_end("request_id")).withColumns({"micros": F.unix_micros("event_time"), "bucket": bucket})
    accepted = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Wait(int(timeout_hours * 3600) * 1_000_000), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    return accepted.select("request_id", "status", "output", F.timestamp_micros("micros").cast("timestamp_ntz").alias("executed_at"))


def start_reports(governed: DataFrame, outcomes: DataFrame, out: str, checkpoint: str, timeout_hours: float = 24.0, once: bool = False) -> StreamingQuery:
    """Write the reports that count under ``out``/reports."""
    spark = governed.sparkSession
    before = spark.conf.get(PROVIDER_CONF)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        return start_batches(
            accepted_reports(governed, outcomes, timeout_hours), lambda batch, batch_id: _save(batch, f"{out}/reports", batch_id) and None, checkpoint, once)
    finally:
        spark.conf.set(PROVIDER_CONF, before)


GOVERNED = (
    "request_id bigint, tool_name string, incident_id bigint, requested_at timestamp_ntz, risk_level string, requires_approval boolean, "
    "status string, success boolean, message string, approved_by string, error string, audit array<string>"
)
REPORTS = "request_id bigint, status string, output string, executed_at timestamp_ntz, batch_id int"


def follow_governed(spark: SparkSession, out: str) -> DataFrame:
    """The governed requests that a triage stream writes under ``out``, as a stream."""
    return spark.readStream.schema(GOVERNED).parquet(f"{out}/governed")


def reports(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(REPORTS).parquet(f"{out}/reports").drop("batch_id")


def current_incidents(spark: SparkSession, out: str) -> DataFrame:
    """The incidents that a triage stream opened under ``out``, as the reports so far leave them."""
    opened = spark.read.parquet(f"{out}/incidents").drop("batch_id")
    governed = spark.read.parquet(f"{out}/governed").drop("batch_id")
    return incidents.apply_resolutions(opened, governance.resolutions_from(governed, reports(spark, out)))


def report_audit(spark: SparkSession, out: str) -> DataFrame:
    """The audit row of each ready request that was reported on or has timed out."""
    return governance.outcome_audit(spark.read.parquet(f"{out}/governed").drop("batch_id"), reports(spark, out))

"""Template mining over a stream, in event-time order, with state per leaf.

A leaf keeps its templates, the answers it has given, and lines that may still be
overtaken. A line whose text was answered before gets that answer at once: the first
occurrence decides. Any other waits until the watermark has passed its time, then the
leaf's waiting lines are read in the order (event_time, log_id), whatever tasks, Arrow
batches and micro-batches they came in. The result is that of the batch operator on
lines whose ids ascend with time.

State: templates are results and stay; waiting lines leave with the watermark; repeated
lines add nothing but their ids while they wait. Answers stay for ever, one small row
for each distinct line, unless ``forget_after`` is given: answers not used for that long
(event time) are dropped, and a line that comes back later is matched anew.

Lines older than the watermark when they arrive are dropped, as in all event-time
operators. Lines still waiting when a stream ends are read once the watermark passes
them: see :func:`faultline.streaming.sources.with_end`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from faultline.functions import text
from faultline.operators.templates import DEPTH, THRESHOLD, LeafIndex, line_parts
from faultline.streaming.sources import not_an_end

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"

_LINE = "digest string, leaf string, tokens array<bigint>, own_pattern string, own_tokens array<bigint>"
_WAITING = f"{_LINE}, times array<bigint>, ids array<bigint>"
#: Answers are swept once for each of so many parts of ``forget_after``.
_SWEEPS = 4


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for the identical lines of an Arrow batch, with all their times and ids."""
    for batch in batches:
        grouped = batch.groupby("digest", sort=False)
        first = batch.drop_duplicates("digest").drop(columns=["micros", "log_id"]).set_index("digest")
        folded = first.assign(times=grouped["micros"].agg(list), ids=grouped["log_id"].agg(list)).reset_index()
        yield folded[["digest", "leaf", "tokens", "own_pattern", "own_tokens", "times", "ids", "event_time"]]


class _MineLeaf(StatefulProcessor):
    def __init__(self, threshold: float, forget_micros: int | None) -> None:
        self.threshold = threshold
        self.forget = forget_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.templates = handle.getListState("templates", "pattern string, tokens array<bigint>")
        self.waiting = handle.getListState("waiting", _WAITING)
        self.answers = handle.getMapState("answers", "digest string", "pattern string, used bigint")
        self.swept = handle.getValueState("swept", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told: dict[str, str | None] = {}
        waiting, ids, patterns, earliest = [], [], [], None
        for batch in rows:
            for line in batch.itertuples(index=False):
                if line.digest not in told:
                    known = self.answers.getValue((line.digest,))
                    told[line.digest] = known[0] if known else None
                    if known and self.forget is not None:
                        self.answers.updateValue((line.digest,), (known[0], max(known[1], *map(int, line.times))))
                if told[line.digest] is not None:
                    ids.append([int(i) for i in line.ids])
                    patterns.append(told[line.digest])
                    continue
                times = [int(t) for t in line.times]
                waiting.append((line.digest, line.leaf, [int(t) for t in line.tokens], line.own_pattern,
                                [int(t) for t in line.own_tokens], times, [int(i) for i in line.ids]))
                earliest = min(times) if earliest is None else min(earliest, *times)
        if waiting:
            self.waiting.appendList(waiting)
            self.handle.registerTimer(-(-earliest // 1000))
        if ids:
            yield pd.DataFrame({"log_ids": ids, "template_pattern": patterns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, left = [], []
        for line in self.waiting.get():
            both = list(zip(line[5], line[6]))
            now = [x for x in both if x[0] <= passed]
            if now:
                due.append((min(now), line, [i for _, i in now]))
            later = [x for x in both if x[0] > passed]
            if later:
                left.append((*line[:5], [t for t, _ in later], [i for _, i in later]))
        due.sort(key=lambda d: d[0])
        ids, patterns = self._read(due) if due else ([], [])
        if due:
            self.waiting.clear()
            if left:
                self.waiting.appendList(left)
                self.handle.registerTimer(-(-min(min(x[5]) for x in left) // 1000))
        if self.forget is not None:
            self._sweep(passed)
        if ids:
            yield pd.DataFrame({"log_ids": ids, "template_pattern": patterns})

    def _read(self, due: list) -> tuple[list, list]:
        index = LeafIndex(self.threshold)
        for pattern, tokens in self.templates.get():
            index.add(pattern, frozenset(tokens))
        told: dict[str, str] = {}
        ids, patterns = [], []
        for (at, _), (digest, _, tokens, own, own_tokens, *_), found in due:
            if digest not in told:
                known = self.answers.getValue((digest,))
                pattern = known[0] if known else index.match(frozenset(tokens))
                if pattern is None:
                    pattern = own
                    if index.add(own, frozenset(own_tokens)):
                        self.templates.appendValue((own, list(own_tokens)))
                told[digest] = pattern
                self.answers.updateValue((digest,), (pattern, at))
            ids.append(found)
            patterns.append(told[digest])
        return ids, patterns

    def _sweep(self, passed: int) -> None:
        swept = self.swept.get()
        if swept is None or passed - swept[0] >= self.forget // _SWEEPS:
            self.swept.update((passed,))
            for digest in [k[0] for k, (_, used) in self.answers.iterator() if used < passed - self.forget]:
                self.answers.removeKey((digest,))

    def close(self) -> None:
        pass


def mined_stream(
    stream: DataFrame, depth: int = DEPTH, threshold: float = THRESHOLD, strip_timestamp: bool = False, compare: str = "rest",
    watermark: str = "10 minutes", forget_after_hours: float | None = None,
) -> DataFrame:
    """log_id, template_pattern and template_id of every line of ``stream`` (log_id, log_line, event_time).

    Needs the RocksDB state store (:func:`start_mining` selects it).  Rows without a
    line only move the watermark.
    """
    timed = stream.select("log_id", "log_line", "event_time").withWatermark("event_time", watermark)
    line = F.coalesce("log_line", F.lit(""))
    parts = line_parts(line, depth, strip_timestamp, compare)
    lines = timed.where(not_an_end("log_line")).select(
        F.md5("log_line").alias("digest"), *parts, F.unix_micros("event_time").alias("micros"), "log_id", "event_time")
    folded = lines.mapInPandas(_fold, f"{_WAITING}, event_time timestamp")
    return (
        folded.groupBy("leaf")
        .transformWithStateInPandas(
            statefulProcessor=_MineLeaf(threshold, None if forget_after_hours is None else int(forget_after_hours * 3_600_000_000)),
            outputStructType="log_ids array<bigint>, template_pattern string",
            outputMode="Append",
            timeMode="EventTime",
        )
        .select(F.explode("log_ids").alias("log_id"), "template_pattern")
        .withColumn("template_id", text.stable_id(F.col("template_pattern")))
    )


def start_mining(mined: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append mined templates to Parquet files, with state in RocksDB."""
    spark = mined.sparkSession
    before = spark.conf.get(PROVIDER_CONF)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        writer = mined.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start(out)
    finally:
        spark.conf.set(PROVIDER_CONF, before)

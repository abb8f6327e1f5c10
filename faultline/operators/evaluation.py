"""Detector scores, latency, summary quality and the combined report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import detect
from faultline.operators.incidents import action_usefulness, metrics_summary

# Words that make a summary relevant to its line.
IMPORTANT_WORDS = ["error", "failed", "timeout", "critical", "connection", "service", "port"]
SUMMARY_LINE_CHARS = 100


def dataset_limit(logs: DataFrame, n: int) -> DataFrame:
    """The first n rows in file order, which log_id records."""
    return logs.orderBy("log_id").limit(n)


def _counts(d: Column, t: Column) -> list[Column]:
    return [
        F.count("*").alias("total_logs"),
        F.count_if(t).alias("true_anomalies"),
        F.count_if(d & t).alias("tp"),
        F.count_if(d & ~t).alias("fp"),
        F.count_if(~d & t).alias("fn"),
        F.count_if(~d & ~t).alias("tn"),
    ]


def confusion(logs: DataFrame, detected: Column, label: Column | None = None) -> DataFrame:
    """TP, FP, FN, TN and totals of a detector against a label, in one pass."""
    truth = (F.col("is_anomaly") == 1) if label is None else label
    flags = logs.select(detected.alias("d"), truth.alias("t"))
    return flags.agg(*_counts(F.col("d"), F.col("t")))


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den * 100).otherwise(F.lit(0.0))


def _scored(counts: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return (
        counts
        .withColumn("precision", _rate(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", _rate(F.col("tp"), F.col("true_anomalies")))
        .withColumn("f1_score", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    )


def detection_metrics(logs: DataFrame, detected: Column, label: Column | None = None) -> DataFrame:
    """Confusion counts with precision, recall and F1 in percent."""
    return _scored(confusion(logs, detected, label))


def detector_scores(logs: DataFrame, detectors: dict[str, Column], label: Column | None = None) -> DataFrame:
    """:func:`detection_metrics` of several detectors, a row each, from one scan."""
    truth = (F.col("is_anomaly") == 1) if label is None else label
    flags = logs.select(truth.alias("t"), *[c.alias(f"d_{n}") for n, c in detectors.items()])
    each = [F.struct(F.lit(n).alias("detector"), *_counts(F.col(f"d_{n}"), F.col("t"))) for n in detectors]
    return _scored(flags.agg(F.array(*each).alias("scores")).select(F.inline("scores")))


def detector_agreement(logs: DataFrame, detected: Column, reference: Column) -> DataFrame:
    """Scores of one detector with another as the truth; accuracy is its recall."""
    return detection_metrics(logs, detected, reference).withColumn("accuracy", F.col("recall"))


def latency_summary(calls: DataFrame) -> DataFrame:
    latency = F.col("latency")
    return calls.agg(
        F.coalesce(F.avg(latency), F.lit(0.0)).alias("average"),
        F.coalesce(F.min(latency), F.lit(0.0)).alias("min"),
        F.coalesce(F.max(latency), F.lit(0.0)).alias("max"),
        F.count(latency).alias("iterations"),
    )


def summary_quality(summaries: DataFrame) -> DataFrame:
    """Length, keyword coverage and informativeness of (log_line, summary) rows."""
    line = F.lower(F.substring("log_line", 1, SUMMARY_LINE_CHARS))
    said = F.lower(F.coalesce("summary", F.lit("")))
    relevant = F.lit(False)
    for word in IMPORTANT_WORDS:
        relevant = relevant | (line.contains(word) & said.contains(word))
    totals = summaries.agg(
        F.count("*").alias("total_summaries"),
        F.coalesce(F.avg(F.length(F.coalesce("summary", F.lit("")))), F.lit(0.0)).alias("_len"),
        F.count_if(relevant).alias("_hits"),
    )
    coverage = _rate(F.col("_hits"), F.col("total_summaries"))
    score = F.least(F.lit(100.0), F.col("_len") / 50 * 50 + coverage * 0.5)
    return totals.select(
        "total_summaries",
        F.round("_len", 2).alias("avg_length"),
        F.round(coverage, 2).alias("keyword_coverage"),
        F.round(score, 2).alias("informativeness_score"),
    )


def evaluate_detector(
    logs: DataFrame, detected: Column | None = None, limit: int | None = None, calls: DataFrame | None = None
) -> DataFrame:
    """Detector scores on labelled logs, with latency figures if calls were recorded."""
    rows = dataset_limit(logs, limit) if limit else logs
    scores = detection_metrics(rows, detect.detect_eval(F.col("log_line")) if detected is None else detected)
    if calls is None:
        return scores
    latency = latency_summary(calls).select(F.struct("average", "min", "max").alias("latency"))
    return scores.withColumn("latency", latency.scalar())


def evaluation_report(
    logs: DataFrame,
    calls: DataFrame,
    summaries: DataFrame,
    incidents: DataFrame,
    actions: DataFrame,
    as_of: str,
    limit: int | None = None,
) -> DataFrame:
    """One nested row with all four sections; each section is its own small aggregate."""
    def section(row: DataFrame) -> Column:
        return row.select(F.struct(*row.columns).alias("s")).scalar()

    lat = F.col("latency")
    return evaluate_detector(logs, limit=limit, calls=calls).select(
        F.lit(as_of).alias("timestamp"),
        F.struct(
            "total_logs",
            "true_anomalies",
            F.col("tp").alias("detected_anomalies"),
            F.col("fp").alias("false_positives"),
            F.col("fn").alias("false_negatives"),
            *[F.round(c, 2).alias(c) for c in ("precision", "recall", "f1_score")],
            F.struct(*[F.round(lat[c], 2).alias(c) for c in ("average", "min", "max")]).alias("latency"),
        ).alias("dataset_evaluation"),
        section(summary_quality(summaries)).alias("summarization_quality"),
        section(action_usefulness(actions, incidents, as_of)).alias("action_usefulness"),
        section(metrics_summary(incidents, actions, logs)).alias("operational_metrics"),
    )

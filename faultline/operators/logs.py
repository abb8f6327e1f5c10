"""Log ingestion, search and labelled-detector counts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.functions.times import within

SEARCH_LIMIT = 100


def ingest(lines: DataFrame) -> DataFrame:
    """Drop blank lines, flag anomalies, and attach template text and id.

    Input ``log_id, timestamp, log_line``; one narrow pass, no shuffle.
    """
    line = F.col("log_line")
    return (
        lines.withColumn("log_line", text.strip(line))
        .filter(line != "")
        .withColumn("is_anomaly", detect.detect_ingest(line).cast("int"))
        .withColumn("template_pattern", text.stateless_template(line))
        .withColumn("template_id", text.stable_id(F.col("template_pattern")))
    )


def lexical_index(logs: DataFrame, max_keywords: int = text.MAX_KEYWORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(log_id, keyword, position) of the first ``max_keywords`` keywords per line.

    ``carry`` copies further log columns, so that ranking index rows by time needs
    no join back to the logs.
    """
    return logs.select(
        "log_id", *carry, F.posexplode(text.keywords(F.col("log_line"), max_keywords)).alias("position", "keyword")
    ).select("log_id", *carry, "keyword", "position")


def attach_embeddings(logs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Write embeddings onto logs by log_id; logs without one keep what they had."""
    fresh = embeddings.select("log_id", F.col("embedding").alias("_fresh"))
    joined = logs.join(fresh, "log_id", "left")
    if "embedding" in logs.columns:
        return joined.withColumn("embedding", F.coalesce("_fresh", "embedding")).drop("_fresh")
    return joined.withColumnRenamed("_fresh", "embedding")


def _newest(rows: DataFrame, limit: int) -> DataFrame:
    return rows.orderBy(F.desc("timestamp"), "log_id").limit(limit)


def _no_escape(pattern: str) -> str:
    """A LIKE pattern in which a backslash stands for itself."""
    return pattern.replace("\\", "\\\\")


def is_single_word(pattern: str) -> bool:
    return re.match(r"^\w+$", pattern) is not None


def has_keyword(line: Column, word: str) -> Column:
    """True where one of the indexed keywords of ``line`` contains ``word``.

    ``_`` stays a wildcard, as in LIKE.
    """
    pattern = f"%{_no_escape(word.lower())}%"
    return F.exists(text.keywords(line), lambda k: k.like(pattern))


def search_keyword(
    logs: DataFrame,
    word: str,
    as_of: str,
    hours: int = 24,
    limit: int = SEARCH_LIMIT,
    index: DataFrame | None = None,
) -> DataFrame:
    """Newest logs with a keyword containing ``word``.

    With a stored ``index`` the match is a semi join on log_id that never reads the
    other lines' text; without one the keywords are taken from the line in the scan.
    """
    recent = logs.filter(within(F.col("timestamp"), as_of, hours))
    if index is None:
        return _newest(recent.filter(has_keyword(F.col("log_line"), word)), limit)
    matched = index.filter(F.col("keyword").like(f"%{_no_escape(word.lower())}%")).select("log_id")
    return _newest(recent.join(matched, "log_id", "left_semi"), limit)


def search_substring(
    logs: DataFrame, pattern: str, as_of: str, hours: int = 24, limit: int = SEARCH_LIMIT
) -> DataFrame:
    """Newest logs whose line contains ``pattern``; ``%`` and ``_`` are wildcards."""
    recent = logs.filter(within(F.col("timestamp"), as_of, hours))
    return _newest(recent.filter(F.col("log_line").ilike(f"%{_no_escape(pattern)}%")), limit)


def search_logs(
    logs: DataFrame,
    pattern: str,
    as_of: str,
    hours: int = 24,
    limit: int = SEARCH_LIMIT,
    index: DataFrame | None = None,
) -> DataFrame:
    """Keyword search for one word, substring search for anything else."""
    if is_single_word(pattern):
        return search_keyword(logs, pattern, as_of, hours, limit, index)
    return search_substring(logs, pattern, as_of, hours, limit)


def suspicious_events(logs: DataFrame, as_of: str, hours: int = 24, pattern: str = "auth") -> DataFrame:
    return search_logs(logs, pattern, as_of, hours)


def logs_by_template(logs: DataFrame, template_id: int | Column, as_of: str, hours: int = 24) -> DataFrame:
    """Logs of one template in the window, newest first."""
    return logs.filter(within(F.col("timestamp"), as_of, hours) & (F.col("template_id") == template_id)).orderBy(
        F.desc("timestamp"), "log_id"
    )


def log_totals(logs: DataFrame) -> DataFrame:
    return logs.agg(
        F.count("*").alias("total_logs"), F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("total_anomalies")
    )


def dedup_first_seen(hits: DataFrame, order_by: list[Column], limit: int | None = 20) -> DataFrame:
    """First hit per log_id in the given order, then the first ``limit`` of those.

    ``order_by`` must end in a unique column.  A partial group limit keeps one row
    per log and map task before the shuffle, so a hot log_id stays cheap.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("log_id").orderBy(*order_by)
    first = hits.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    first = first.orderBy(*order_by)
    return first.limit(limit) if limit is not None else first

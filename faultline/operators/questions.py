"""Routing of plain-language questions and the reports that answer them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.functions.times import cutoff, instant
from faultline.operators.logs import SEARCH_LIMIT, has_keyword
from faultline.operators.retrieval import counts_by_hours, newest_lines, window_summary, within_window

# Routes, services and answer texts.
SUMMARY, SUSPICIOUS, RESTART_ROUTE, OPEN, UNKNOWN = "error_summary", "suspicious_events", "restart_advice", "open_incidents", "unrecognized"
SERVICES = ["apache", "nginx"]
RESTART_MATCHES, LISTED_EVENTS, LISTED_OPEN = 3, 5, 10
NOT_RECOGNISED = (
    "Query not recognized. Supported queries: summarize errors, suspicious auth events, "
    "restart service recommendation, open incidents."
)
HEALTHY = "No recent errors found for {}. Service appears healthy."
SERVICE_ERRORS_HOUR, SERVICE_ERRORS_HOURS = "Found {} error(s) in the last hour", "Found {} error(s) in the last {} hours"
NO_ERRORS = "No errors found in the last {} hour(s). System appears to be operating normally."
ERRORS = "RAG-Enhanced Summary of errors in last {} hour(s) ({} incidents):\n{}"
NO_EVENTS, EVENTS = "No suspicious authentication events found.", "Found {} suspicious authentication events:\n{}"
NO_OPEN, OPEN_LISTING, OPEN_ENTRY = "No open incidents.", "Found {} open incidents:\n{}", "ID {}: {}"
ADVICE = "Recommendation: {}\nReason: {}\nErrors found: {}"
AUTH_PATTERN = "auth"


def question_hours(question: Column) -> Column:
    """Trailing hours a question asks for; 1 where it names none that can be read."""
    q = F.lower(question)
    parts = text.tokens(q)
    following = F.filter(
        F.transform(parts, lambda w, i: F.when(w == "last", F.try_element_at(parts, i + 2))), lambda w: w.isNotNull()
    )
    numbers = F.transform(following, lambda w: w.try_cast("int"))
    spelled = (
        F.when(F.size(numbers) == 0, 1)
        .when(F.exists(numbers, lambda n: n.isNull()), 1)
        .otherwise(F.try_element_at(numbers, F.lit(-1)))
    )
    return (
        F.when(q.contains("last hour") | q.contains("last 1 hour"), 1)
        .when(q.contains("last 24 hours") | q.contains("last day"), 24)
        .when(q.contains("last week"), 168)
        .when(q.contains("last") & q.contains("hour"), spelled)
        .otherwise(1)
    )


def question_route(question: Column) -> Column:
    q = F.lower(question)
    return (
        F.when(q.contains("summarize") & q.contains("error"), SUMMARY)
        .when(q.contains("suspicious") & q.contains("auth"), SUSPICIOUS)
        .when(q.contains("should") & q.contains("restart"), RESTART_ROUTE)
        .when(q.contains("open") & q.contains("incident"), OPEN)
        .otherwise(UNKNOWN)
    )


def question_service(question: Column) -> Column:
    return F.when(F.lower(question).contains("nginx"), "nginx").otherwise("apache")


def route_questions(questions: DataFrame) -> DataFrame:
    """Add route, hours and service to a table with a ``question`` column."""
    q = F.col("question")
    return questions.select(
        "*", question_route(q).alias("route"), question_hours(q).alias("hours"), question_service(q).alias("service")
    )


def restart_advice(
    logs: DataFrame, as_of: str, services: list[str] = SERVICES, hours: int = 1, limit: int = SEARCH_LIMIT
) -> DataFrame:
    """Per service: matching logs in the window (as a search would return) and YES or NO.

    One pass over the window; services are a short argument list.
    """
    recent = logs.filter(F.col("timestamp") >= cutoff(as_of, hours))
    counts = recent.agg(
        *[F.least(F.count_if(has_keyword(F.col("log_line"), s)), F.lit(limit)).alias(s) for s in services]
    )
    pairs = F.explode(F.create_map(*[x for s in services for x in (F.lit(s), F.col(s))]))
    n, service = F.col("matching_logs"), F.col("service")
    healthy = text.fill(HEALTHY, service)
    found = text.fill(SERVICE_ERRORS_HOUR, n) if hours == 1 else text.fill(SERVICE_ERRORS_HOURS, n, F.lit(hours))
    return counts.select(pairs.alias("service", "matching_logs")).select(
        "service",
        "matching_logs",
        F.when(n >= RESTART_MATCHES, "YES").otherwise("NO").alias("recommendation"),
        F.when(n == 0, healthy).otherwise(found).alias("reason"),
    )


def advice_from_response(summary: Column, action: Column, has_errors: Column) -> Column:
    """Restart advice from an analyzer answer.

    "no" is looked up as a substring, so "now" or "node" count as well.
    """
    low = F.lower(F.coalesce(summary, F.lit("")))
    restart = low.contains("restart") | F.coalesce(action, F.lit("")).contains("RESTART")
    return F.when(
        has_errors, F.when(restart, "YES").otherwise("NO")
    ).otherwise(F.when(low.contains("no"), "NO").otherwise("CHECK"))


def error_summaries(incidents: DataFrame, logs: DataFrame, hours: DataFrame, as_of: str) -> DataFrame:
    """hours, n_errors, n_incidents and the answer text, per distinct value of ``hours``."""
    windows = hours.select(F.col("hours").cast("bigint").alias("hours")).distinct()
    flagged = incidents.filter(detect.detect_eval(F.col("log_line")))
    errors = counts_by_hours(flagged, "detected_at", windows, as_of, "n_errors")
    context = window_summary(incidents, logs, windows, as_of).select("hours", "n_incidents", "fallback_summary")
    h, n = F.col("hours"), F.col("n_errors")
    quiet, loud = text.fill(NO_ERRORS, h), text.fill(ERRORS, h, n, F.col("fallback_summary"))
    return errors.join(context, "hours").select(
        "hours", "n_errors", "n_incidents", F.when(n == 0, quiet).otherwise(loud).alias("answer")
    )


def suspicious_answers(logs: DataFrame, hours: DataFrame, as_of: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """hours, n_events (``limit`` at most, as a search would return) and the answer text: the count and the five newest lines."""
    windows = hours.select(F.col("hours").cast("bigint").alias("hours")).distinct()
    auth = logs.filter(has_keyword(F.col("log_line"), AUTH_PATTERN)).select("log_id", "timestamp", "log_line")
    counted = counts_by_hours(auth, "timestamp", windows, as_of, "_n").select(
        "hours", F.least("_n", F.lit(limit)).alias("n_events")
    )
    as_incidents = auth.select(
        F.col("timestamp").alias("detected_at"), F.col("log_id").alias("incident_id"), "log_line"
    )
    start = cutoff(as_of, F.col("hours").cast("int"))
    counted = counted.withColumn("_new", newest_lines(as_incidents, LISTED_EVENTS).scalar())
    shown = F.transform(within_window(F.col("_new"), start), lambda i: F.substring(i["log_line"], 1, 200))
    lines = F.array_join(shown, "\n")
    n = F.col("n_events")
    return counted.select("hours", "n_events", F.when(n == 0, NO_EVENTS).otherwise(text.fill(EVENTS, n, lines)).alias("answer"))


def open_answer(incidents: DataFrame) -> DataFrame:
    """One row: number of open incidents and the listing of the ten newest."""
    open_rows = incidents.filter(F.col("status") == "open")
    total = open_rows.agg(F.count("*").alias("n_open"))
    total = total.withColumn("_new", newest_lines(open_rows, LISTED_OPEN).scalar())
    entry = lambda i: text.fill(OPEN_ENTRY, i["incident_id"], F.substring(i["log_line"], 1, 100))
    lines = F.array_join(F.transform(within_window(F.col("_new"), instant("0001-01-01 00:00:00")), entry), "\n")
    n = F.col("n_open")
    return total.select("n_open", F.when(n == 0, NO_OPEN).otherwise(text.fill(OPEN_LISTING, n, lines)).alias("answer"))


def answer_questions(questions: DataFrame, incidents: DataFrame, logs: DataFrame, as_of: str) -> DataFrame:
    """Questions with route, hours, service and answer.

    Reports are built once per distinct window or service and joined to the questions
    on that key, however many questions share it.
    """
    routed = route_questions(questions).withColumn("hours", F.col("hours").cast("bigint"))

    def windows(route: str) -> DataFrame:
        return routed.filter(F.col("route") == route).select("hours").distinct()

    summaries = error_summaries(incidents, logs, windows(SUMMARY), as_of).select(
        F.lit(SUMMARY).alias("route"), "hours", F.col("answer").alias("_windowed")
    )
    suspicious = suspicious_answers(logs, windows(SUSPICIOUS), as_of).select(
        F.lit(SUSPICIOUS).alias("route"), "hours", F.col("answer").alias("_windowed")
    )
    advice = restart_advice(logs, as_of).select(
        F.lit(RESTART_ROUTE).alias("route"),
        "service",
        text.fill(ADVICE, F.col("recommendation"), F.col("reason"), F.col("matching_logs")).alias("_advice"),
    )
    opened = open_answer(incidents).select("answer").scalar()
    return (
        routed.join(summaries.unionByName(suspicious), ["route", "hours"], "left")
        .join(advice, ["route", "service"], "left")
        .withColumn(
            "answer",
            F.when(F.col("route") == OPEN, opened)
            .when(F.col("route") == UNKNOWN, NOT_RECOGNISED)
            .otherwise(F.coalesce("_windowed", "_advice")),
        )
        .drop("_windowed", "_advice")
    )

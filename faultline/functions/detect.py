"""Keyword detectors and the rule-based diagnosis of an anomalous line."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keywords of each detector.  The ingest and eval detectors
# look in upper-cased text, so mixed-case keywords would never match there.
INGEST_KEYWORDS = ["ERROR", "CRITICAL", "FATAL", "WARNING"]
EVAL_KEYWORDS = ["ERROR", "CRITICAL"]
MONITOR_KEYWORDS = ["ERROR", "CRITICAL", "Failed", "Timeout"]
INTENDED_KEYWORDS = ["ERROR", "CRITICAL", "FAILED", "TIMEOUT"]

# Fallback diagnoses, tried in this order.
PORT_DIAGNOSIS = "[BASH FALLBACK] The web server failed due to port conflict."
TIMEOUT_DIAGNOSIS = "[BASH FALLBACK] Critical timeout occurred, indicating service unreachable."
OTHER_DIAGNOSIS = "LLM summary unavailable; escalating for review."
RESTART, ESCALATE = "RESTART_APACHE", "ESCALATE"


def contains_any(text: Column, needles: list[str]) -> Column:
    """True where ``text`` holds one of the needles.

    One alternation names ``text`` once, so a computed line is not worked out again
    for each needle when the filter moves below the projection.
    """
    return text.rlike("|".join(re.escape(n) for n in needles))


def detect_ingest(line: Column) -> Column:
    return contains_any(F.upper(line), INGEST_KEYWORDS)


def detect_eval(line: Column) -> Column:
    return contains_any(F.upper(line), EVAL_KEYWORDS)


def detect_monitor(line: Column) -> Column:
    return contains_any(line, MONITOR_KEYWORDS)


def detect_intended(line: Column, keywords: list[str] = INTENDED_KEYWORDS) -> Column:
    """Any keyword, whatever its case."""
    return contains_any(F.lower(line), [k.lower() for k in keywords])


def diagnose(line: Column) -> Column:
    """struct(summary, action) for a line the analyzer gave no answer on."""
    port, timeout = line.contains("Port 80"), line.contains("timeout")
    return F.struct(
        F.when(port, PORT_DIAGNOSIS).when(timeout, TIMEOUT_DIAGNOSIS).otherwise(OTHER_DIAGNOSIS).alias("summary"),
        F.when(port, RESTART).otherwise(ESCALATE).alias("action"),
    )


def parse_response(response: Column) -> Column:
    """struct(summary, action) of an analyzer response; null fields if malformed."""
    return F.from_json(response, "summary STRING, action STRING")


def diagnosis_or_fallback(line: Column, response: Column) -> Column:
    """The analyzer's answer where it carries a summary, else :func:`diagnose`."""
    parsed = parse_response(response)
    fallback = diagnose(line)
    answered = F.coalesce(parsed["summary"], F.lit("")) != ""
    return F.struct(
        F.when(answered, parsed["summary"]).otherwise(fallback["summary"]).alias("summary"),
        F.when(answered, parsed["action"]).otherwise(fallback["action"]).alias("action"),
    )

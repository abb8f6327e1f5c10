"""Alert rules: suggestion from incident frequencies, and evaluation on logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.operators.incidents import in_window

TOP_PATTERNS, TAIL_LINES = 5, 1000


def error_patterns(incidents: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Frequency of each pattern class over the window's incidents."""
    return (
        in_window(incidents, as_of, hours)
        .select(F.explode(text.error_patterns(F.col("log_line"))).alias("pattern"))
        .groupBy("pattern")
        .agg(F.count("*").alias("frequency"))
        .withColumn("regex", text.pattern_regex(F.col("pattern")))
        .orderBy(F.desc("frequency"), "pattern")
    )


def suggested_action(pattern: Column) -> Column:
    low = F.lower(pattern)
    return F.when(low.contains("port") | low.contains("timeout"), detect.RESTART).otherwise(detect.ESCALATE)


def suggest_rules(incidents: DataFrame, as_of: str, hours: int = 24, top: int = TOP_PATTERNS) -> DataFrame:
    """The most frequent patterns as rules; a third of the frequency is the threshold."""
    frequent = error_patterns(incidents, as_of, hours).limit(top)
    return frequent.select(
        "pattern",
        "regex",
        F.greatest(F.lit(1), F.floor(F.col("frequency") / 3)).cast("bigint").alias("threshold"),
        suggested_action(F.col("pattern")).alias("action"),
        "frequency",
    )


def evaluate_rules(logs: DataFrame, rules: DataFrame, tail: int = TAIL_LINES) -> DataFrame:
    """Count each rule's matches among the last ``tail`` lines and say whether it fires.

    The tail is a short list by definition; the rules read it as one array, so no
    (line, rule) rows are built.
    """
    last = logs.orderBy(F.desc("log_id")).limit(tail).agg(F.collect_list("log_line").alias("lines"))
    matches = F.size(F.filter("_lines", lambda line: F.rlike(line, F.col("regex")))).cast("bigint")
    counted = rules.withColumn("_lines", last.scalar()).withColumn("matches", matches).drop("_lines")
    return counted.withColumn("fires", F.col("matches") >= F.col("threshold"))


# Rules that one expression holds; a larger set becomes several expressions.
LITERAL_RULES = 500
RULE_FIELDS = ("pattern", "regex", "threshold", "action")


def matching_rules(line: Column, rules: list[tuple[str, str, int, str]]) -> Column:
    """Rules (pattern, regex, threshold, action) whose regex matches the line.

    Each regex is a literal, so it is compiled once per task and not once per line.
    """
    hits = [
        F.when(line.rlike(r[1]), F.struct(*[F.lit(v).alias(n) for n, v in zip(RULE_FIELDS, r)])) for r in rules
    ]
    return F.array_compact(F.array(*hits))


def rule_matches(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """(timestamp, r) for every rule a line matches; nothing else leaves the scan.

    Starts a job that reads the rules, which people write and review.
    """
    chosen = rules.select(*RULE_FIELDS)
    known = [tuple(r) for r in chosen.collect()]
    line = F.col("log_line")
    if not known:
        return logs.select("timestamp", F.explode(F.array().cast(f"array<{chosen.schema.simpleString()}>")).alias("r"))
    parts = [matching_rules(line, known[k : k + LITERAL_RULES]) for k in range(0, len(known), LITERAL_RULES)]
    return logs.select("timestamp", F.explode(parts[0] if len(parts) == 1 else F.concat(*parts)).alias("r"))


def windowed_alerts(
    logs: DataFrame, rules: DataFrame, window: str = "1 hour", slide: str | None = None
) -> DataFrame:
    """Rules whose matches reach the threshold within an event-time window.

    Starts a job that reads the rules.  Counts combine before the shuffle.
    """
    span = F.window("timestamp", window, slide) if slide else F.window("timestamp", window)
    return (
        rule_matches(logs, rules)
        .groupBy(span.alias("w"), "r.pattern", "r.threshold", "r.action")
        .agg(F.count("*").alias("matches"))
        .filter(F.col("matches") >= F.col("threshold"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "pattern",
            "matches",
            F.col("threshold").cast("bigint").alias("threshold"),
            "action",
        )
    )

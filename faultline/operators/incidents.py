"""Incident and action analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline import schemas
from faultline.functions import detect
from faultline.functions.times import micros, seconds_between, within
from faultline.session import cut_lineage


def newest_first(incidents: DataFrame) -> DataFrame:
    return incidents.orderBy(F.desc("detected_at"), "incident_id")


def in_window(incidents: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    return incidents.filter(within(F.col("detected_at"), as_of, hours))


def incidents_window(incidents: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    return newest_first(in_window(incidents, as_of, hours))


def open_incidents(incidents: DataFrame) -> DataFrame:
    return newest_first(incidents.filter(F.col("status") == "open"))


def incidents_by_ids(incidents: DataFrame, ids: DataFrame) -> DataFrame:
    """Incidents whose id is in ``ids`` (one column, incident_id)."""
    return incidents.join(ids.select("incident_id"), "incident_id", "left_semi")


def errors_window(incidents: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    """Incidents of the window whose line the eval detector flags."""
    return newest_first(in_window(incidents, as_of, hours).filter(detect.detect_eval(F.col("log_line"))))


def incident_listing(incidents: DataFrame, chars: int = 50) -> DataFrame:
    return incidents.select("incident_id", "detected_at", "status", F.substring("summary", 1, chars).alias("summary"))


def open_incidents_from_logs(logs: DataFrame, flagged: Column | None = None) -> DataFrame:
    """New 'open' incidents, one per flagged log; the log id becomes the incident id."""
    flagged = detect.detect_ingest(F.col("log_line")) if flagged is None else flagged
    return logs.filter(flagged).select(
        F.col("log_id").alias("incident_id"),
        F.col("timestamp").alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        "log_line",
        detect.diagnose(F.col("log_line"))["summary"].alias("summary"),
        F.lit("open").alias("status"),
    )


def apply_resolutions(incidents: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Next snapshot of the incidents: reported ones become resolved.

    Reports are reduced to the last one per incident before they meet the incidents,
    so repeated reports of one incident never multiply rows.
    """
    last = resolutions.groupBy("incident_id").agg(F.max("resolved_at").alias("_at"))
    return (
        incidents.join(last, "incident_id", "left")
        .withColumn("status", F.when(F.col("_at").isNotNull(), "resolved").otherwise(F.col("status")))
        .withColumn("resolved_at", F.coalesce("_at", "resolved_at"))
        .drop("_at")
    )


def recent_actions(actions: DataFrame, limit: int = 10) -> DataFrame:
    return actions.orderBy(F.desc("executed_at"), "action_id").limit(limit)


def incident_status_counts(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("status").agg(F.count("*").alias("n"))


def _status_count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def incident_totals(incidents: DataFrame) -> DataFrame:
    """One row: total, open, resolved and escalated incidents."""
    return incidents.agg(
        F.count("*").alias("total_incidents"),
        *[_status_count(s).alias(f"{s}_incidents") for s in schemas.INCIDENT_STATUSES],
    )


def action_status_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("status").agg(F.count("*").alias("n"))


def action_breakdown(actions: DataFrame) -> DataFrame:
    """One row: total actions and a status → count map."""
    per_status = action_status_counts(actions)
    return per_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_actions"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("action_breakdown"),
    )


def _resolved() -> Column:
    return (F.col("status") == "resolved") & F.col("resolved_at").isNotNull()


def incident_recovery_seconds(incidents: DataFrame) -> DataFrame:
    return incidents.filter(_resolved()).select(
        "incident_id", seconds_between(F.col("detected_at"), F.col("resolved_at")).alias("mttr_seconds")
    )


def mttr(incidents: DataFrame) -> DataFrame:
    """Mean seconds from detection to resolution; null if nothing is resolved."""
    return incident_recovery_seconds(incidents).agg(F.avg("mttr_seconds").alias("mttr_seconds"))


def first_log_per_line(logs: DataFrame, *columns: str) -> DataFrame:
    """The earliest log of each distinct line.

    Aggregated before any join, so a line that fills a third of the logs shrinks to
    one row per map task first.
    """
    return logs.groupBy("log_line").agg(
        F.min("log_id").alias("log_id"), *[F.min_by(c, "log_id").alias(c) for c in columns]
    )


def incident_template(incidents: DataFrame, logs: DataFrame) -> DataFrame:
    """incident_id → template of the first log with the same line.

    Starts a job: the per-line table is written out, so that the join with the
    incidents begins with a shuffle of its own, which Spark can split where one line
    fills much of it (or replaces by a broadcast, knowing the size).
    """
    first = cut_lineage(first_log_per_line(logs, "template_id").filter(F.col("template_id").isNotNull()))
    return (
        incidents.select("incident_id", "log_line")
        .join(first.select("log_line", "template_id"), "log_line")
        .select("incident_id", "template_id")
    )


def incidents_per_template(incidents: DataFrame, logs: DataFrame) -> DataFrame:
    """template_id, n_incidents: how many incidents carry a line of the template.

    Both sides shrink to one row per line before they meet.
    """
    first = first_log_per_line(logs, "template_id").filter(F.col("template_id").isNotNull())
    per_line = incidents.groupBy("log_line").agg(F.count("*").alias("n"))
    return per_line.join(first, "log_line").groupBy("template_id").agg(F.sum("n").alias("n_incidents"))


def detection_delays(incidents: DataFrame, logs: DataFrame) -> DataFrame:
    """Seconds from the first log of the incident's line to its detection, per incident.

    Starts a job (see :func:`incident_template`).
    """
    first = cut_lineage(first_log_per_line(logs, "timestamp").select("log_line", "timestamp"))
    return (
        incidents.select("incident_id", "detected_at", "log_line")
        .join(first, "log_line")
        .select("incident_id", seconds_between(F.col("timestamp"), F.col("detected_at")).alias("mttd_seconds"))
    )


def mttd(incidents: DataFrame, logs: DataFrame) -> DataFrame:
    """Mean of :func:`detection_delays`; null if no incident has a log.

    The incidents of a line share its first log, so their detection times are summed
    per line and only the sums are joined.
    """
    per_line = incidents.groupBy("log_line").agg(
        F.count("detected_at").alias("n"), F.sum(micros(F.col("detected_at")).cast("decimal(20,0)")).alias("detected")
    )
    first = first_log_per_line(logs, "timestamp")
    seen = micros(F.col("timestamp")).cast("decimal(20,0)")
    late = (F.col("detected") - F.col("n") * seen).cast("decimal(38,0)")
    joined = per_line.join(first, "log_line").agg(F.sum(late).alias("late"), F.sum("n").alias("n"))
    return joined.select((F.col("late").cast("double") / F.nullif(F.col("n"), F.lit(0)) / 1e6).alias("mttd_seconds"))


def metrics_summary(incidents: DataFrame, actions: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """One row with MTTD, MTTR, incident totals and the action breakdown.

    Each part is a single-row aggregate read as a scalar subquery, so the parts run
    as separate scans side by side and nothing is joined.  Without logs MTTD is null.
    """
    delay = mttd(incidents, logs).scalar() if logs is not None else F.lit(None).cast("double")
    breakdown = action_breakdown(actions).select(F.struct("total_actions", "action_breakdown").alias("s"))
    totals = incidents.agg(
        F.count("*").alias("total_incidents"),
        *[_status_count(s).alias(f"{s}_incidents") for s in schemas.INCIDENT_STATUSES],
        F.avg(F.when(_resolved(), seconds_between(F.col("detected_at"), F.col("resolved_at")))).alias("mttr_seconds"),
    )
    done = totals.withColumn("mttd_seconds", delay).withColumn("_a", breakdown.scalar())
    d, r = F.col("mttd_seconds"), F.col("mttr_seconds")
    return done.select(
        "mttd_seconds",
        F.when(d.isNull(), "N/A").otherwise(F.format_string("%.2fs", d)).alias("mttd_formatted"),
        "mttr_seconds",
        F.when(r.isNull(), "N/A").otherwise(F.format_string("%.2fs", r)).alias("mttr_formatted"),
        F.when(r.isNull(), "N/A").otherwise(F.format_string("%.2f minutes", r / 60)).alias("mttr_formatted_minutes"),
        "total_incidents",
        *[f"{s}_incidents" for s in schemas.INCIDENT_STATUSES],
        F.col("_a.total_actions").alias("total_actions"),
        F.col("_a.action_breakdown").alias("action_breakdown"),
    )


def summary_coverage(incidents: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Share of the window's incidents that carry a summary, in percent."""
    present = F.count_if(F.coalesce(F.col("summary"), F.lit("")) != "")
    rate = F.when(F.col("total_incidents") > 0, F.col("with_summary") / F.col("total_incidents") * 100).otherwise(0.0)
    return (
        in_window(incidents, as_of, hours)
        .agg(F.count("*").alias("total_incidents"), present.alias("with_summary"))
        .withColumn("coverage", F.round(rate, 2))
    )


def action_usefulness(
    actions: DataFrame, incidents: DataFrame, as_of: str, hours: int = 24, newest: int = 100
) -> DataFrame:
    """Share of the newest actions whose incident is resolved.

    All zero when the window holds no incident.
    """
    recent = recent_actions(actions, newest).select("action_id", "incident_id")
    resolved = incidents.filter(F.col("status") == "resolved").select("incident_id", F.lit(1).alias("_r"))
    window_total = in_window(incidents, as_of, hours).agg(F.count("*"))
    scored = recent.join(resolved, "incident_id", "left").agg(
        F.count("*").alias("actions"),
        F.count_if(F.col("_r") == 1).alias("useful"),
        F.count_distinct("incident_id").alias("incidents"),
    )
    total, any_incident = F.col("total_incidents"), F.col("total_incidents") > 0
    return scored.withColumn("total_incidents", window_total.scalar()).select(
        "total_incidents",
        F.when(any_incident, F.col("actions")).otherwise(0).alias("total_actions"),
        F.when(any_incident, F.col("incidents")).otherwise(0).alias("distinct_incidents"),
        F.when(any_incident, F.col("useful")).otherwise(0).alias("useful_actions"),
        F.when((total > 0) & (F.col("actions") > 0), F.col("useful") / F.col("actions") * 100)
        .otherwise(0.0)
        .alias("usefulness_rate"),
    )


def constraint_violations(
    incidents: DataFrame, actions: DataFrame, logs: DataFrame, templates: DataFrame
) -> DataFrame:
    """Count of rows that break each declared constraint, all rules listed.

    Value and NOT NULL rules share one pass per table; uniqueness is an aggregate.
    """
    def broken(rows: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
        counted = rows.agg(*[F.count_if(c).alias(r) for r, c in rules.items()])
        return counted.select(
            F.lit(table).alias("table_name"),
            F.explode(F.create_map(*[x for r in rules for x in (F.lit(r), F.col(r))])).alias("rule", "violations"),
        )

    def not_in(column: str, values: list[str]) -> Column:
        return F.col(column).isNotNull() & ~F.col(column).isin(values)

    duplicates = templates.groupBy("template_pattern").count().filter("count > 1").agg(F.count("*").alias("violations"))
    return (
        broken(incidents, "incidents", {
            "detected_at_null": F.col("detected_at").isNull(),
            "log_line_null": F.col("log_line").isNull(),
            "status_value": not_in("status", schemas.INCIDENT_STATUSES),
            "resolved_without_time": (F.col("status") == "resolved") & F.col("resolved_at").isNull(),
        })
        .unionByName(broken(actions, "actions", {
            "action_name_null": F.col("action_name").isNull(),
            "executed_at_null": F.col("executed_at").isNull(),
            "status_value": not_in("status", schemas.ACTION_STATUSES),
        }))
        .unionByName(broken(logs, "logs", {
            "timestamp_null": F.col("timestamp").isNull(),
            "log_line_null": F.col("log_line").isNull(),
        }))
        .unionByName(duplicates.select(
            F.lit("templates").alias("table_name"), F.lit("pattern_unique").alias("rule"), "violations"
        ))
    )


def orphan_rows(
    actions: DataFrame, incidents: DataFrame, logs: DataFrame, templates: DataFrame, index: DataFrame
) -> DataFrame:
    """Rows whose foreign key has no parent, counted per relation."""
    def orphans(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
        # Children are counted per key first, so a key shared by many is one row.
        per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        lone = per_key.join(parent.select(key), key, "left_anti")
        return lone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
            F.lit(relation).alias("relation"), "orphans"
        )

    return (
        orphans(actions, incidents, "incident_id", "actions.incident_id")
        .unionByName(orphans(logs, templates, "template_id", "logs.template_id"))
        .unionByName(orphans(index, logs, "log_id", "lexical_index.log_id"))
    )

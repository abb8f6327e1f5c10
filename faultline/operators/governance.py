"""Validation, approval and dry-run policy for proposed actions, with an audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Audit statuses and message texts of the action gate.
VALIDATION_FAILED, VALIDATED, REJECTED = "validation_failed", "validated", "rejected"
APPROVED, DRY_RUN, READY = "approved", "dry_run", "ready"
AUTO_APPROVED, DRY_RUN_GATE = "auto_approved", "dry_run_mode"
UNKNOWN_TOOL, MISSING_PARAMETER = "Unknown tool: ", "Missing required parameter: "
EXECUTED, FAILED, TIMEOUT, ERROR = "executed", "failed", "timeout", "error"
UNKNOWN_ERROR, TIMED_OUT = "Unknown error", "Tool execution timed out"
GATE_REJECTION = "Action rejected by approval gate"
UNKNOWN_RISK = "UNKNOWN"


def validation_error(requests_with_tool: DataFrame) -> Column:
    """First reason a request is invalid, or null; needs tool columns joined in."""
    missing = F.filter(
        F.coalesce("required", F.array().cast("array<string>")),
        lambda p: ~F.coalesce(F.map_contains_key(F.col("params"), p), F.lit(False)),
    )
    return F.when(F.col("_tool").isNull(), F.concat(F.lit(UNKNOWN_TOOL), F.coalesce("tool_name", F.lit("")))).when(
        F.size(missing) > 0, F.concat(F.lit(MISSING_PARAMETER), F.try_element_at(missing, F.lit(1)))
    )


def validate_actions(requests: DataFrame, tools: DataFrame) -> DataFrame:
    """Requests plus ``error`` (null when valid) and ``is_valid``.

    The registry is a dimension keyed by tool name; Spark broadcasts it when its size
    allows and otherwise joins on the name.  Of entries of one name, the one that
    requires the most parameters holds.
    """
    strictest = F.max(F.struct(F.size("required").alias("n"), "required"))["required"]
    registry = tools.groupBy(F.col("name").alias("tool_name")).agg(strictest.alias("required"))
    registry = registry.withColumn("_tool", F.col("tool_name"))
    checked = requests.join(registry, "tool_name", "left")
    return (
        checked.withColumn("error", validation_error(checked))
        .withColumn("is_valid", F.col("error").isNull())
        .drop("_tool", "required")
    )


def with_policy(requests: DataFrame, policy: DataFrame) -> DataFrame:
    """Add requires_approval and risk_level; actions without a policy need none.

    Of entries of one name, one that requires approval holds before one that does not.
    """
    dim = policy.groupBy(F.col("action_name").alias("tool_name")).agg(
        F.max(F.struct("requires_approval", "risk_level")).alias("_policy")
    ).select("tool_name", F.col("_policy.requires_approval").alias("_needs"), F.col("_policy.risk_level").alias("_risk"))
    return (
        requests.join(dim, "tool_name", "left")
        .withColumn("requires_approval", F.coalesce("_needs", F.lit(False)))
        .withColumn("risk_level", F.coalesce("_risk", F.lit(UNKNOWN_RISK)))
        .drop("_needs", "_risk")
    )


def govern_actions(
    requests: DataFrame,
    tools: DataFrame,
    policy: DataFrame,
    decisions: DataFrame | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """Outcome of every request: statuses in order, final status, success, message.

    ``requests``: request_id, tool_name, incident_id, params.  ``decisions``:
    request_id, approved, approved_by; a request without one is rejected, and of
    several on one request any refusal wins.
    """
    checked = with_policy(validate_actions(requests, tools), policy)
    if decisions is None or dry_run:
        decided = checked.withColumn("_approved", F.lit(False)).withColumn("_by", F.lit(None).cast("string"))
    else:
        one = F.min(F.struct(F.coalesce("approved", F.lit(False)).alias("approved"), "approved_by"))
        answers = decisions.groupBy("request_id").agg(one.alias("_one")).select(
            "request_id", F.col("_one.approved").alias("_approved"), F.col("_one.approved_by").alias("_by")
        )
        decided = checked.join(answers, "request_id", "left")
    invalid, gated = ~F.col("is_valid"), F.col("requires_approval")
    approved = F.coalesce("_approved", F.lit(False))
    refused = gated & ~approved
    dry = F.lit(dry_run)
    status = (
        F.when(invalid, VALIDATION_FAILED)
        .when(refused, REJECTED)
        .when(dry, DRY_RUN)
        .otherwise(READY)
    )
    by = (
        F.when(invalid, F.lit(None).cast("string"))
        .when(gated & dry, DRY_RUN_GATE)
        .when(refused, F.lit(None).cast("string"))
        .when(gated, F.col("_by"))
        .otherwise(AUTO_APPROVED)
    )
    audit = (
        F.when(invalid, F.array(F.lit(VALIDATION_FAILED)))
        .when(refused, F.array(F.lit(VALIDATED), F.lit(REJECTED)))
        .when(dry, F.array(F.lit(VALIDATED), F.lit(DRY_RUN)))
        .when(gated, F.array(F.lit(VALIDATED), F.lit(APPROVED), F.lit(READY)))
        .otherwise(F.array(F.lit(VALIDATED), F.lit(READY)))
    )
    tool = F.concat(F.lit("Tool '"), F.col("tool_name"), F.lit("'"))
    message = (
        F.when(invalid, F.concat(F.lit("Validation failed: "), F.col("error")))
        .when(refused, GATE_REJECTION)
        .when(dry, F.concat(F.lit("[DRY RUN] "), tool, F.lit(" would be executed (approved by "), by, F.lit(")")))
        .otherwise(F.concat(tool, F.lit(" ready (approved by "), F.coalesce(by, F.lit("unknown")), F.lit(")")))
    )
    carry = [c for c in ("requested_at",) if c in requests.columns]
    return decided.select(
        "request_id",
        "tool_name",
        "incident_id",
        *carry,
        "risk_level",
        "requires_approval",
        status.alias("status"),
        (~invalid & ~refused).alias("success"),
        message.alias("message"),
        by.alias("approved_by"),
        "error",
        audit.alias("audit"),
    )


def audit_events(governed: DataFrame) -> DataFrame:
    """One row per audit status, numbered within the request.

    The validation step carries no approver; the error goes with the failure.
    """
    carry = [c for c in ("requested_at",) if c in governed.columns]
    exploded = governed.select(
        "request_id", "tool_name", "incident_id", *carry, "approved_by", "error",
        F.posexplode("audit").alias("seq", "audit_status"),
    )
    return exploded.select(
        "request_id",
        "seq",
        *carry,
        "tool_name",
        "incident_id",
        F.col("audit_status").alias("status"),
        F.when(F.col("audit_status") != VALIDATED, F.col("approved_by")).alias("approved_by"),
        F.when(F.col("audit_status") == VALIDATION_FAILED, F.col("error")).alias("error"),
    )


def _reported(governed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ready requests with what came of them, the last report of each."""
    report = F.struct("executed_at", F.col("status").alias("outcome"), "output")
    last = outcomes.groupBy("request_id").agg(F.max(report).alias("_last")).select("request_id", "_last.*")
    return governed.filter(F.col("status") == READY).join(last, "request_id")


def record_outcomes(governed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Action rows of executed requests that belong to an incident.

    ``outcomes``: request_id, status, output, executed_at, as reported by whatever ran
    the ready requests; of several reports on a request the last one holds.
    """
    done = _reported(governed, outcomes).filter((F.col("outcome") == EXECUTED) & F.col("incident_id").isNotNull())
    return done.select(
        F.col("request_id").alias("action_id"),
        "incident_id",
        F.col("tool_name").alias("action_name"),
        "executed_at",
        F.col("outcome").alias("status"),
        "approved_by",
        F.col("output").alias("result_message"),
    )


def outcome_audit(governed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The audit row of each ready request that has run: executed, failed, timeout or error.

    A status of any other name counts as an error.
    """
    known = F.coalesce(F.col("outcome").isin(EXECUTED, FAILED, TIMEOUT), F.lit(False))
    status, said = F.when(known, F.col("outcome")).otherwise(ERROR), F.nullif("output", F.lit(""))
    rows = _reported(governed, outcomes).drop("status", "error").withColumn("status", status)
    error = (
        F.when(F.col("status") == FAILED, F.coalesce(said, F.lit(UNKNOWN_ERROR)))
        .when(F.col("status") == TIMEOUT, TIMED_OUT)
        .when(F.col("status") == ERROR, F.coalesce("output", F.lit("")))
    )
    by = F.when(F.col("status") == EXECUTED, F.col("approved_by"))
    return rows.select("request_id", "tool_name", "incident_id", "executed_at", "status", by.alias("approved_by"), error.alias("error"))


def resolves_incident(success: Column, message: Column) -> Column:
    """A successful action resolves its incident unless it was a dry run."""
    return success & ~F.upper(message).contains("DRY RUN")


def resolutions_from(governed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(incident_id, resolved_at) for incidents whose action has run with success."""
    done = resolves_incident(F.col("outcome") == EXECUTED, F.col("message")) & F.col("incident_id").isNotNull()
    return _reported(governed, outcomes).filter(done).select("incident_id", F.col("executed_at").alias("resolved_at"))

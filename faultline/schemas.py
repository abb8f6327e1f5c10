"""Canonical table schemas shared by sources, operators and streams."""

from pyspark.sql import types as T

LOGS = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("log_line", T.StringType()),
    T.StructField("is_anomaly", T.IntegerType()),
    T.StructField("template_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

LEXICAL_INDEX = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("position", T.IntegerType()),
])

TEMPLATES = T.StructType([
    T.StructField("template_id", T.LongType()),
    T.StructField("template_pattern", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("frequency", T.LongType()),
])

INCIDENTS = T.StructType([
    T.StructField("incident_id", T.LongType()),
    T.StructField("detected_at", T.TimestampNTZType()),
    T.StructField("resolved_at", T.TimestampNTZType()),
    T.StructField("log_line", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("status", T.StringType()),
])

ACTIONS = T.StructType([
    T.StructField("action_id", T.LongType()),
    T.StructField("incident_id", T.LongType()),
    T.StructField("action_name", T.StringType()),
    T.StructField("executed_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("approved_by", T.StringType()),
    T.StructField("result_message", T.StringType()),
])

LABELLED_LOGS = T.StructType([
    T.StructField("log_line", T.StringType()),
    T.StructField("is_anomaly", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])

# One entry of the action policy file, keyed by action name.
POLICY_ENTRY = T.StructType([
    T.StructField("risk_level", T.StringType()),
    T.StructField("requires_approval", T.BooleanType()),
    T.StructField("description", T.StringType()),
])

POLICY_FILE = T.StructType([
    T.StructField("actions", T.MapType(T.StringType(), POLICY_ENTRY)),
    T.StructField("dry_run_mode", T.BooleanType()),
])

TOOL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("inputSchema", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("description", T.StringType()),
        ]))),
        T.StructField("required", T.ArrayType(T.StringType())),
    ])),
    T.StructField("risk_level", T.StringType()),
    T.StructField("requires_approval", T.BooleanType()),
])

TOOL_FILE = T.StructType([T.StructField("tools", T.ArrayType(TOOL))])

ANALYZER_RESPONSE = "summary STRING, action STRING"

# The statuses each table admits.
INCIDENT_STATUSES = ["open", "resolved", "escalated"]
ACTION_STATUSES = ["pending", "executed", "approved", "rejected", "failed"]

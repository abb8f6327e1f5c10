"""Canonical log tables derived from the given Parquet tables.

Every derivation is narrow (projection and filter only), so an operator on top
plans over one plain Parquet scan.  The SQL text below is portable: the DuckDB
check queries use the same strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.functions.times import instant

AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"

LOG_TEXT_SQL = """
CASE event_type
WHEN 'error' THEN CASE user_id % 5
  WHEN 0 THEN 'ERROR: web server failed to start. Port 80 is in use'
  WHEN 1 THEN 'ERROR: upstream request timeout after 30 s on worker ' || CAST(user_id AS STRING)
  WHEN 2 THEN 'ERROR: database connection to 10.2.0.7:5432 failed'
  WHEN 3 THEN 'ERROR: permission denied writing /var/log/app.log'
  ELSE 'CRITICAL: disk usage above 0x5F on node-' || CAST(user_id AS STRING) END
WHEN 'purchase' THEN CASE user_id % 5
  WHEN 0 THEN 'WARNING: payment retry 3 for order ' || CAST(event_id AS STRING)
  WHEN 1 THEN 'FATAL: ledger process on apache exited with code 139'
  WHEN 2 THEN 'INFO: payment accepted from 192.168.1.20'
  WHEN 3 THEN 'INFO: Failed card check for cart_item_' || CAST(user_id AS STRING)
  ELSE 'DEBUG: cache hit /srv/cart/session' END
WHEN 'signup' THEN CASE user_id % 5
  WHEN 0 THEN 'INFO: auth token issued for user ' || CAST(user_id AS STRING)
  WHEN 1 THEN 'WARNING: unauthorized login attempt from 203.0.113.9'
  WHEN 2 THEN 'INFO: Timeout waiting for mail gateway, message queued'
  WHEN 3 THEN 'INFO: oauth callback handled at C:' || chr(92) || 'svc' || chr(92) || 'auth'
  ELSE 'INFO: new account created' END
WHEN 'click' THEN CASE user_id % 5
  WHEN 0 THEN 'INFO: GET /index.html 200 12'
  WHEN 1 THEN 'INFO: nginx served 304 in 5 ms'
  WHEN 2 THEN 'ERROR CRITICAL: nginx worker crashed and 502 was returned'
  WHEN 3 THEN 'INFO: no errors found in nightly scan'
  ELSE 'INFO: click on banner_7 by café visitor' END
ELSE CASE user_id % 5
  WHEN 0 THEN 'INFO: page view by user ' || CAST(user_id AS STRING)
  WHEN 1 THEN 'INFO: apache status page checked'
  WHEN 2 THEN 'DEBUG: slow query 250 ms'
  WHEN 3 THEN 'INFO: connection pool resized to 12345678x9'
  ELSE 'INFO: service port 443 healthy' END
END
"""

LOG_LINE_SQL = f"CAST(CAST(ts AS DATE) AS STRING) || ' ' || {LOG_TEXT_SQL}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def logs_from_events(events: DataFrame) -> DataFrame:
    """log_id, timestamp, log_line, is_anomaly (labels independent of the text)."""
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("ts").alias("timestamp"),
        F.expr(LOG_LINE_SQL).alias("log_line"),
        (F.col("value") > 20).cast("int").alias("is_anomaly"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(table(spark, sf_dir, "events"))


def templated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs plus the template each line gets on its own, and its stable id."""
    template = text.stateless_template(F.col("log_line"))
    return (
        logs(spark, sf_dir)
        .withColumn("template_pattern", template)
        .withColumn("template_id", text.stable_id(F.col("template_pattern")))
    )


def embedded_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templated logs whose embedding is the vector of the event's user."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("user_id"), "embedding")
    line = F.expr(LOG_LINE_SQL)
    template = text.stateless_template(F.col("log_line"))
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_id").alias("log_id"), F.col("ts").alias("timestamp"), line.alias("log_line"), "user_id")
        .withColumn("template_id", text.stable_id(template))
        .join(vectors, "user_id", "left")
        .drop("user_id")
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per line the ingest detector flags."""
    line, k = F.col("log_line"), F.col("k")
    return (
        table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("incident_id"),
            (F.col("ts") + F.make_dt_interval(secs=F.floor("value"))).alias("detected_at"),
            F.expr(LOG_LINE_SQL).alias("log_line"),
            _k().alias("k"),
            "user_id",
        )
        .filter(detect.detect_ingest(line))
        .select(
            "incident_id",
            "detected_at",
            F.when(k < 59, F.col("detected_at") + F.make_dt_interval(mins=k)).alias("resolved_at"),
            "log_line",
            F.when(k % 4 == 0, F.lit(None).cast("string"))
            .when(k % 4 == 1, "")
            .otherwise(detect.diagnose(line)["summary"])
            .alias("summary"),
            F.when(k < 60, "resolved").when(k < 80, "open").otherwise("escalated").alias("status"),
            "user_id",
        )
    )


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as incidents, with nothing resolved yet except status F."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("incident_id"),
        F.col("o_orderdate").alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.col("o_orderpriority").alias("log_line"),
        F.lit(None).cast("string").alias("summary"),
        F.when(status == "F", "resolved").when(status == "O", "open").otherwise("escalated").alias("status"),
    )


def line_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as actions taken for their order's incident."""
    flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        text.stable_id(key).alias("action_id"),
        F.col("l_orderkey").alias("incident_id"),
        F.when(F.col("l_linenumber") < 3, "RESTART_APACHE")
        .when(F.col("l_linenumber") < 5, "CLEAR_TEMP_CACHE")
        .otherwise("ESCALATE")
        .alias("action_name"),
        F.col("l_shipdate").alias("executed_at"),
        F.when((flag == "A") & (line_status == "F"), "executed")
        .when(flag == "A", "approved")
        .when((flag == "N") & (line_status == "F"), "failed")
        .when(flag == "N", "pending")
        .otherwise("rejected")
        .alias("status"),
    )


def resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(incident_id, resolved_at) reports, several per incident, from line items."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_linestatus") == "F")
        .select(F.col("l_orderkey").alias("incident_id"), F.col("l_shipdate").alias("resolved_at"))
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(log_line, summary) pairs: a user turn and the assistant turn after it.

    Joined on (conv_id, turn), so one long conversation does not become one task.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("log_line"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("summary")
    )
    return asked.join(answered, ["conv_id", "turn"])


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents split into lines: free text in four languages."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "log_line")
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as questions; some keep their own text and stay unrecognised."""
    return (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") == "user")
        .select("conv_id", "turn", F.expr(QUESTION_SQL).alias("question"))
    )


QUESTION_SQL = """
CASE (conv_id + turn) % 11
  WHEN 0 THEN 'Summarize the last hour errors'
  WHEN 1 THEN 'summarize errors from the last 24 hours'
  WHEN 2 THEN 'Summarize last week error trends'
  WHEN 3 THEN 'What suspicious auth events occurred in the last ' || CAST(conv_id % 200 AS STRING) || ' hours?'
  WHEN 4 THEN 'Should I restart apache?'
  WHEN 5 THEN 'should we restart nginx now?'
  WHEN 6 THEN 'List open incidents'
  WHEN 7 THEN 'what suspicious auth events happened on the last day'
  WHEN 8 THEN 'summarize errors of the last few hours'
  WHEN 9 THEN 'summarize every error of the last ' || CAST(conv_id % 300 AS STRING) || ' hours'
  ELSE text
END
"""

RESPONSE_SQL = """
CASE user_id % 6
  WHEN 0 THEN '{"summary":"Port is taken, restart the web server","action":"RESTART_APACHE"}'
  WHEN 1 THEN '{ "summary": "Disk pressure on node", "action": "CLEAR_TEMP_CACHE" }'
  WHEN 2 THEN '{"summary": "cut off'
  WHEN 3 THEN '{"action": "ESCALATE"}'
  WHEN 4 THEN NULL
  ELSE '{"summary":"Service degraded","action":"ESCALATE","confidence":1}'
END
"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(log_id, log_line, response): analyzer answers, some malformed or missing."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_id"),
        F.expr(LOG_LINE_SQL).alias("log_line"),
        F.expr(RESPONSE_SQL).alias("response"),
    )


REQUEST_TOOL_SQL = """
CASE user_id % 7
  WHEN 0 THEN 'RESTART_APACHE' WHEN 1 THEN 'CLEAR_TEMP_CACHE' WHEN 2 THEN 'ESCALATE'
  WHEN 3 THEN 'ROTATE_LOGS' WHEN 4 THEN 'ROTATE_LOGS' WHEN 5 THEN 'FORMAT_DISK'
  ELSE 'RESTART_APACHE'
END
"""


def action_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One proposed action per incident; some name unknown tools or lack parameters."""
    uid = F.col("user_id")
    params = F.when(uid % 7 == 3, F.create_map(F.lit("path"), F.lit("/var/log"))).when(
        uid % 7 == 4, F.create_map(F.lit("depth"), F.lit("2"))
    )
    return incidents(spark, sf_dir).select(
        F.col("incident_id").alias("request_id"),
        F.expr(REQUEST_TOOL_SQL).alias("tool_name"),
        "incident_id",
        params.alias("params"),
        F.col("detected_at").alias("requested_at"),
    )


def action_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the actions that ran, an hour at most after the event; some report twice, some never."""
    k = F.col("k")
    status = F.when(k % 5 < 2, "executed").when(k % 5 == 2, "failed").when(k % 5 == 3, "timeout").otherwise("lost")
    first = table(spark, sf_dir, "events").withColumn("k", _k()).filter(k % 7 != 0).select(
        F.col("event_id").alias("request_id"),
        status.alias("status"),
        F.when(k % 2 == 0, F.concat(F.lit("exit "), k.cast("string"))).otherwise("").alias("output"),
        (F.col("ts") + F.make_dt_interval(mins=k % 60 + 1)).alias("executed_at"),
        "k",
    )
    again = first.filter(k % 3 == 0).withColumn("executed_at", F.col("executed_at") - F.make_dt_interval(secs=F.lit(30)))
    return first.unionByName(again.withColumn("status", F.lit("timeout"))).drop("k")


def approval_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human decisions for about half of the requests."""
    k = _k()
    return (
        table(spark, sf_dir, "events")
        .filter(k < 50)
        .select(
            F.col("event_id").alias("request_id"),
            (k < 35).alias("approved"),
            F.concat(F.lit("operator_"), (F.col("user_id") % 3).cast("string")).alias("approved_by"),
        )
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded analyzer latencies in seconds."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("call_id"), (F.col("value") / 10).alias("latency")
    )

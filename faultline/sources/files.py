"""File sources and sinks: labelled datasets, policy, registry, log and report output."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import schemas
from faultline.functions import text
from faultline.session import cut_lineage

# The policy and registry used when no file is given.
DEFAULT_POLICY = [
    ("RESTART_APACHE", "HIGH", True, "Restart Apache web server - may cause service interruption"),
    ("CLEAR_TEMP_CACHE", "LOW", False, "Clear temporary cache files - low risk operation"),
    ("ESCALATE", "MEDIUM", False, "Escalate incident to human operator - no automated action"),
]
DEFAULT_TOOLS = [
    ("RESTART_APACHE", "Restart Apache web server", [], "HIGH", True),
    ("CLEAR_TEMP_CACHE", "Clear temporary cache", [], "LOW", False),
    ("ESCALATE", "Escalate to human operator", [], "MEDIUM", False),
]
POLICY_COLUMNS = "action_name string, risk_level string, requires_approval boolean, description string"
TOOL_COLUMNS = "name string, description string, required array<string>, risk_level string, requires_approval boolean"


def rows(spark: SparkSession, records: list[tuple], columns: str) -> DataFrame:
    """A few literal rows as part of the plan itself, so that Catalyst knows their size."""
    schema = T.StructType.fromDDL(columns)
    text_form = json.dumps([dict(zip(schema.names, r)) for r in records])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text_form), T.ArrayType(schema))))


def _digits_or_zero(value: Column) -> Column:
    return F.coalesce(F.when(value.rlike(r"^\d+$"), value.try_cast("int")), F.lit(0))


def in_file_order(lines: DataFrame, name: str = "log_id") -> DataFrame:
    """``lines`` with dense ids in the order of their files by path, and of their place in each file.

    Needs the columns file, start (of the block that was read) and row (ascending
    within a block), which it drops. Starts a job that writes the lines, so that their
    ids outlive lost executors; blocks, not lines, are put in order.
    """
    lines = cut_lineage(lines)
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of a file
    starts = lines.groupBy("file", "start").agg(F.count("*").alias("_n")).select(
        "file", "start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = Window.partitionBy("file", "start").orderBy("row")
    numbered = lines.withColumn("_place", F.row_number().over(place) - 1).join(starts, ["file", "start"])
    others = [c for c in lines.columns if c not in ("file", "start", "row")]
    return numbered.select((F.col("_first") + F.col("_place")).alias(name), *others)


def _place_in_file(meta: str = "_metadata") -> list[Column]:
    return [F.col(f"{meta}.file_path").alias("file"), F.col(f"{meta}.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")]


def load_logs_csv(spark: SparkSession, path: str, as_of: str, multi_line: bool = False) -> DataFrame:
    """Labelled CSV with a header: log_id (in file order), log_line, is_anomaly, timestamp (text).

    Columns go by name.  Lines are stripped and empty ones dropped; a label that is not
    all digits counts as 0; ``as_of`` stands in for a missing timestamp column.  Set
    ``multi_line`` only for quoted line breaks: such files cannot be split.  Starts a
    job (see :func:`in_file_order`).
    """
    table = spark.read.options(header=True, escape='"', multiLine=multi_line).csv(path)
    present = set(table.columns)
    line = F.translate(F.col("log_line"), "�", "") if "log_line" in present else F.lit("")
    label = _digits_or_zero(F.col("is_anomaly")) if "is_anomaly" in present else F.lit(0)
    at = F.col("timestamp") if "timestamp" in present else F.lit(as_of)
    kept = table.select(text.strip(line).alias("log_line"), label.alias("is_anomaly"), at.alias("timestamp"), *_place_in_file())
    return in_file_order(kept.filter(F.coalesce("log_line", F.lit("")) != ""))


def _from_object(entry: Column, as_of: str) -> list[Column]:
    def field(*names: str) -> Column:
        return F.coalesce(*[F.get_json_object(entry, f"$.{n}") for n in names])

    label = field("is_anomaly", "anomaly")
    flag = F.when(label == "true", 1).otherwise(F.coalesce(label.try_cast("double").try_cast("int"), F.lit(0)))
    is_object = entry.startswith("{")
    return [
        F.when(is_object, F.coalesce(field("log_line", "log"), F.lit(""))).otherwise(entry).alias("log_line"),
        F.when(is_object, flag).otherwise(0).alias("is_anomaly"),
        F.when(is_object, F.coalesce(field("timestamp"), F.lit(as_of))).otherwise(as_of).alias("timestamp"),
    ]


def load_logs_json(spark: SparkSession, path: str, as_of: str, lines: bool = False) -> DataFrame:
    """Labelled JSON: a list, or an object with a ``logs`` list, of strings and objects; log_id in file order.

    A whole document is one record by nature.  For large inputs write one entry per
    line and pass ``lines=True``, which Spark can split.  A document that is neither
    form and a line that is no JSON fail the job with the name of their file.  Starts a
    job (see :func:`in_file_order`).
    """
    if lines:
        read = spark.read.text(path).select(F.trim("value").alias("entry"), *_place_in_file()).filter(F.col("entry") != "")
        known = F.try_parse_json("entry").isNotNull()
        wrong = F.raise_error(F.concat(F.lit("not a JSON entry in "), F.col("file"), F.lit(": "), F.substring("entry", 1, 100)))
        entry = F.when(F.col("entry").startswith('"'), F.get_json_object("entry", "$")).otherwise(F.col("entry"))
        entries = read.select(F.when(known, entry).otherwise(wrong).alias("entry"), "file", "start", "row")
    else:
        document = spark.read.text(path, wholetext=True).select(F.trim("value").alias("doc"), F.col("_metadata.file_path").alias("file"))
        body = F.when(F.col("doc").startswith("{"), F.get_json_object("doc", "$.logs")).otherwise(F.col("doc"))
        whole = F.try_parse_json("doc").isNotNull() & body.startswith("[")
        items = F.when(whole, F.from_json(body, "array<string>"))
        wrong = F.raise_error(F.concat(F.lit("neither a list of log entries nor an object with a list of logs: "), F.col("file")))
        entries = document.select(F.posexplode(F.coalesce(items, wrong.cast("array<string>"))).alias("row", "entry"), "file", F.lit(0).alias("start"))
    numbered = in_file_order(entries.filter(F.col("entry").isNotNull()).select("entry", "file", "start", "row"))
    return numbered.select("log_id", *_from_object(F.col("entry"), as_of))


def load_logs(spark: SparkSession, path: str, as_of: str, format: str | None = None) -> DataFrame:
    """Choose the reader by extension or ``format``; anything else is read as CSV."""
    kind = (format or os.path.splitext(path.rstrip("/"))[1].lstrip(".")).lower()
    if kind == "json":
        return load_logs_json(spark, path, as_of)
    if kind == "jsonl":
        return load_logs_json(spark, path, as_of, lines=True)
    return load_logs_csv(spark, path, as_of)


def load_policy(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Action policy as rows: action_name, risk_level, requires_approval, description."""
    if path is None:
        return rows(spark, DEFAULT_POLICY, POLICY_COLUMNS)
    document = spark.read.schema(schemas.POLICY_FILE).option("multiLine", True).json(path)
    return document.select(F.explode("actions").alias("action_name", "entry")).select("action_name", "entry.*")


def load_dry_run(spark: SparkSession, path: str) -> bool:
    """The policy file's dry-run switch; on unless it says otherwise."""
    row = spark.read.schema(schemas.POLICY_FILE).option("multiLine", True).json(path).select("dry_run_mode").first()
    return True if row is None or row[0] is None else row[0]


def load_tools(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Tool registry as rows: name, description, required, risk_level, requires_approval."""
    if path is None:
        return rows(spark, DEFAULT_TOOLS, TOOL_COLUMNS)
    document = spark.read.schema(schemas.TOOL_FILE).option("multiLine", True).json(path)
    return document.select(F.explode("tools").alias("t")).select(
        "t.name",
        "t.description",
        F.coalesce(F.col("t.inputSchema.required"), F.array().cast("array<string>")).alias("required"),
        "t.risk_level",
        "t.requires_approval",
    )


def append_logs(logs: DataFrame, path: str) -> None:
    """Append to Parquet, one folder per day; rebalancing splits a busy day's files."""
    dated = logs.withColumn("log_date", F.col("timestamp").cast("date"))
    dated.hint("rebalance", "log_date").write.mode("append").partitionBy("log_date").parquet(path)


def append_rows(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def append_audit(events: DataFrame, path: str) -> None:
    """Audit trail as JSON lines; null fields are kept."""
    events.write.mode("append").option("ignoreNullFields", False).json(path)


def write_json(table: DataFrame, path: str) -> None:
    """Reports and rule sets as JSON."""
    table.write.mode("overwrite").json(path)

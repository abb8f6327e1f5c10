"""Streaming inputs: growing folders of log text, and event tables read as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the time at the start of a log line.
LINE_TIME_CHARS, LINE_TIME_FORMAT = 19, "yyyy-MM-dd HH:mm:ss"


def line_time(line: Column, arrival: Column) -> Column:
    """Time written at the start of the line, else the arrival time (TIMESTAMP)."""
    written = F.try_to_timestamp(F.substring(line, 1, LINE_TIME_CHARS), F.lit(LINE_TIME_FORMAT))
    return F.coalesce(written, arrival)


def follow_logs(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that land in ``directory``.

    Columns log_line, event_time (TIMESTAMP, for watermarks), arrived_at, source.
    Exports of the system log or the journal are followed the same way.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(directory).select("value", "_metadata")
    arrival = F.col("_metadata.file_modification_time")
    return lines.select(
        F.col("value").alias("log_line"),
        line_time(F.col("value"), arrival).alias("event_time"),
        arrival.alias("arrived_at"),
        F.col("_metadata.file_path").alias("source"),
    )


def follow_table(spark: SparkSession, directory: str, name: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream; the schema is that of the files already there."""
    schema = spark.read.parquet(f"{directory}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(directory)


END_SCHEMA = "ends_at timestamp"


def with_end(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` plus one row, null but for its event_time, for each end asked for in ``folder``.

    Event-time operators hold back what the watermark has not passed. A row far ahead
    in time moves the watermark past all that waits, so the last windows and lines come
    out; see :func:`end_stream`. Set the watermark on the result, not on ``stream``.
    """
    ends = stream.sparkSession.readStream.schema(END_SCHEMA).parquet(folder)
    columns = [F.col("ends_at").alias(f.name) if f.name == "event_time" else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]
    return stream.union(ends.select(*columns))


def not_an_end(column: str) -> Column:
    """True for rows of :func:`with_end` that have a ``column``, as any row but an end has.

    A filter on the column alone would be pushed below the watermark, which then never
    sees the ends; this one reads event_time and stays above.
    """
    return F.col(column).isNotNull() | (F.col("event_time") < F.lit("0001-01-01 00:00:00").cast("timestamp"))


def open_end(spark: SparkSession, folder: str) -> str:
    """Make the folder that :func:`with_end` reads, without an end in it yet."""
    spark.createDataFrame([], END_SCHEMA).write.mode("append").parquet(folder)
    return folder


def end_stream(spark: SparkSession, folder: str, at: str) -> None:
    """Ask a running or restarted stream to give out all up to ``at`` (text) less its watermark delay.

    Ask when all lines before have been read: lines older than that are late afterwards.
    """
    spark.range(1).select(F.lit(at).cast("timestamp").alias("ends_at")).write.mode("append").parquet(folder)

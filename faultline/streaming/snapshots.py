"""Tables that a stream maintains by increments, each counted once whatever is replayed.

A micro-batch writes its increment under its own ``batch_id`` and a replay overwrites
it. Every ``every`` batches the increments since the last snapshot are merged with it
into a new version; a version is made from an older one and increments only, so a replay
makes it again with the same rows. Readers take the newest complete version and the
increments after it. Older versions and merged increments are left for readers that
still hold them; :func:`expire` deletes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faultline.operators import templates
from faultline.streaming.pipelines import _save, complete, start_batches

EVERY = 16


class Snapshots:
    """``merge(previous, increments)``: one table from two of ``schema``; it must not matter how increments are grouped."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame, DataFrame], DataFrame], every: int = EVERY):
        self.spark, self.path, self.schema, self.merge, self.every = spark, path, schema, merge, every

    def _rows(self, kind: str, numbers: list[int], name: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{name}={n}" for n in numbers]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def current(self, below: int | None = None) -> DataFrame:
        """The table as of the newest increment, or as of the last one before batch ``below``."""
        before = lambda numbers: [n for n in numbers if below is None or n < below]
        versions = before(complete(self.spark, f"{self.path}/versions", "version"))
        last = versions[-1] if versions else -1
        later = [n for n in before(complete(self.spark, f"{self.path}/increments")) if n > last]
        return self.merge(self._rows("versions", versions[-1:], "version"), self._rows("increments", later, "batch_id"))

    def add(self, increment: DataFrame, batch_id: int) -> None:
        """Store the increment of a batch; a batch stored again takes the place of itself."""
        _save(increment.select(*self._columns()), f"{self.path}/increments", batch_id)
        if (batch_id + 1) % self.every == 0:
            # Made from what lies below this version, never from an earlier try of itself.
            older = [n for n in complete(self.spark, f"{self.path}/versions", "version") if n < batch_id]
            since = [n for n in complete(self.spark, f"{self.path}/increments") if (older[-1] if older else -1) < n <= batch_id]
            version = self.merge(self._rows("versions", older[-1:], "version"), self._rows("increments", since, "batch_id"))
            version.select(*self._columns()).write.mode("overwrite").parquet(f"{self.path}/versions/version={batch_id}")

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def expire(self) -> None:
        """Delete the versions below the newest one and the increments that it holds."""
        versions = complete(self.spark, f"{self.path}/versions", "version")
        if not versions:
            return
        jvm = self.spark.sparkContext._jvm
        spent = [f"{self.path}/versions/version={n}" for n in versions[:-1]]
        spent += [f"{self.path}/increments/batch_id={n}" for n in complete(self.spark, f"{self.path}/increments") if n <= versions[-1]]
        for path in spent:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


TEMPLATE_SCHEMA = "template_pattern string, frequency bigint, created_at timestamp_ntz, first_log_id bigint"


def template_snapshots(spark: SparkSession, path: str, every: int = EVERY) -> Snapshots:
    """The template table of a stream, see :func:`faultline.operators.templates.template_table`."""
    return Snapshots(spark, path, TEMPLATE_SCHEMA, templates.merge_template_tables, every)


def start_template_table(stream: DataFrame, path: str, checkpoint: str, every: int = EVERY, once: bool = False) -> StreamingQuery:
    """Keep the template table of ``stream`` (log_id, timestamp, template_pattern) under ``path``."""
    table = template_snapshots(stream.sparkSession, path, every)
    return start_batches(stream, lambda batch, batch_id: table.add(templates.template_table(batch), batch_id), checkpoint, once)

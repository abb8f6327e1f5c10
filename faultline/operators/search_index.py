"""A stored index for searches within words and lines.

A search for ``%text%`` holds for a string only if the string has every run of three
characters of the text. Two posting tables say where a run occurs, both sorted by run
and written with Parquet bloom filters on it, so a search reads the row groups of its
few runs only:

* keywords: run -> indexed keyword. The keywords that hold all runs are checked by LIKE
  and then looked up in the keyword table, which is sorted by keyword the same way.
* blocks: run -> block of lines. Logs are stored in order of time in blocks of
  ``BLOCK_LINES``; lines are checked by LIKE in the blocks that hold all runs.

Runs are taken between wildcards, in lower case. A pattern without a run of three
literal characters could stand anywhere: it is checked against all keywords or all
blocks of the window, as without an index. Results are those of
:func:`faultline.operators.logs.search_keyword` and ``search_substring``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import text
from faultline.functions.times import within
from faultline.operators.logs import SEARCH_LIMIT, _newest, _no_escape, is_single_word
from faultline.session import cut_lineage

GRAM = 3
BLOCK_LINES = 1024
#: Rows of one Parquet row group of a posting table, about: small ones let a search read little.
ROW_GROUP_BYTES = 1 << 20


def grams(value: Column) -> Column:
    """The distinct runs of three characters of a string in lower case."""
    low = F.lower(value)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(low) - (GRAM - 1), F.lit(1)))
    return F.filter(F.array_distinct(F.transform(starts, lambda s: low.substr(s, F.lit(GRAM)))), lambda g: F.char_length(g) == GRAM)


def pattern_grams(pattern: str) -> list[str]:
    """Runs that every string which matches ``%pattern%`` has; none if it has no three literal characters in a row."""
    literal = [run.lower() for run in re.split(r"[%_]", pattern)]
    return sorted({run[k : k + GRAM] for run in literal for k in range(len(run) - GRAM + 1)})


def _write(rows: DataFrame, path: str, key: str, *order: str) -> None:
    writer = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).write.mode("overwrite")
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(ROW_GROUP_BYTES)}
    writer.options(**options).parquet(path)


def build_search_index(logs: DataFrame, path: str, max_keywords: int = text.MAX_KEYWORDS, block_lines: int = BLOCK_LINES) -> SearchIndex:
    """Write the index of ``logs`` (log_id, timestamp, log_line and more) under ``path`` and open it.

    Logs are stored once, sorted by time; every other table is smaller than they are.
    """
    spark = logs.sparkSession
    order = ["timestamp", "log_id"]
    placed = logs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    # The task's number and the line's place in it: blocks are dense in each task.
    block = F.shiftleft(F.shiftright("_at", 33), 33) + F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / block_lines)
    placed.withColumn("block", block).drop("_at").write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(f"{path}/logs")
    stored = spark.read.parquet(f"{path}/logs")
    words = stored.select("log_id", "timestamp", "block", F.explode(F.array_distinct(text.keywords(F.col("log_line"), max_keywords))).alias("keyword"))
    _write(words, f"{path}/keywords", "keyword", "timestamp")
    _write(words.select("keyword").distinct().select(F.explode(grams(F.col("keyword"))).alias("gram"), "keyword"), f"{path}/keyword_grams", "gram", "keyword")
    _write(stored.select("block", F.explode(grams(F.col("log_line"))).alias("gram")).distinct(), f"{path}/block_grams", "gram", "block")
    return SearchIndex(spark, path)


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.logs = spark.read.parquet(f"{path}/logs")
        self.keywords = spark.read.parquet(f"{path}/keywords")
        self.keyword_grams = spark.read.parquet(f"{path}/keyword_grams")
        self.block_grams = spark.read.parquet(f"{path}/block_grams")

    def columns(self) -> list[str]:
        return [c for c in self.logs.columns if c != "block"]

    @staticmethod
    def _with_all(postings: DataFrame, of: str, wanted: list[str]) -> DataFrame:
        """The values of column ``of`` that are listed under every run; a literal filter on the runs reaches the scan."""
        listed = postings.where(F.col("gram").isin(wanted)).groupBy(of).agg(F.count("*").alias("n"))
        return listed.where(F.col("n") == len(wanted)).select(of)

    def matching_keywords(self, word: str) -> DataFrame:
        wanted = pattern_grams(word)
        found = self._with_all(self.keyword_grams, "keyword", wanted) if wanted else self.keywords.select("keyword").distinct()
        return found.where(F.col("keyword").like(f"%{_no_escape(word.lower())}%"))

    def candidate_lines(self, pattern: str) -> DataFrame:
        """The logs of all blocks that may hold ``pattern``."""
        wanted = pattern_grams(pattern)
        if not wanted:
            return self.logs
        return self.logs.join(cut_lineage(self._with_all(self.block_grams, "block", wanted)), "block", "left_semi")

    def search_keyword(self, word: str, as_of: str, hours: int = 24, limit: int = SEARCH_LIMIT) -> DataFrame:
        """Newest logs with a keyword containing ``word``; only the newest hits' lines are read."""
        recent = self.keywords.where(within(F.col("timestamp"), as_of, hours))
        hits = recent.join(cut_lineage(self.matching_keywords(word)), "keyword", "left_semi").select("log_id", "timestamp", "block").distinct()
        newest = cut_lineage(_newest(hits, limit))
        return _newest(self.logs.join(F.broadcast(newest.select("block", "log_id")), ["block", "log_id"], "left_semi"), limit).select(*self.columns())  # limit rows

    def search_substring(self, pattern: str, as_of: str, hours: int = 24, limit: int = SEARCH_LIMIT) -> DataFrame:
        """Newest logs whose line contains ``pattern``; ``%`` and ``_`` are wildcards."""
        lines = self.candidate_lines(pattern).where(within(F.col("timestamp"), as_of, hours))
        return _newest(lines.where(F.col("log_line").ilike(f"%{_no_escape(pattern)}%")), limit).select(*self.columns())

    def search(self, pattern: str, as_of: str, hours: int = 24, limit: int = SEARCH_LIMIT) -> DataFrame:
        """Keyword search for one word, substring search for anything else."""
        return (self.search_keyword if is_single_word(pattern) else self.search_substring)(pattern, as_of, hours, limit)

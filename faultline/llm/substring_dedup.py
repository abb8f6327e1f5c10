"""Substring deduplication by words: super-k-mer partitioning.

Consecutive 20-word windows that share a minimiser travel as one packed string to
the bucket of the minimiser; there windows are cut out of the strings and counted
exactly, the earliest of each kept. See ``repeats`` for the parts that bytes share,
for hot minimisers and for ties, repeated rows and rows without an id. Null and
empty texts and those of fewer words than a window lose nothing; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import table
from faultline.llm.repeats import Words, remove_repeats

UNIT = Words()


def repeated_windows(members: list[tuple[int, int, int, bytes]], window: int = UNIT.window) -> tuple[np.ndarray, ...]:
    """Ids, ties and starts of the windows of the given strings, in order of place, that are equal to an earlier one."""
    first: dict[bytes, tuple[int, int, int]] = {}
    later: list[tuple[int, int, int]] = []
    for i, tie, at, string in members:
        cuts = UNIT.cuts(string).tolist()
        for k in range(len(cuts) - window):
            place = (i, tie, at + k)
            if first.setdefault(string[cuts[k] : cuts[k + window] - 1], place) < place:
                later.append(place)
    found = np.array(later, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), UNIT, repeated_windows)
    return found.select(F.col("id").alias("doc_id"), F.col("units").alias("n_words"), "n_removed", "kept_sha256")


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, hash(w[i:i+19]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS places FROM repeated GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, w.w, g.places FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id),
flat AS (
  SELECT doc_id, any_value(len(w)) AS n_words, any_value(coalesce(len(places), 0)) AS n_removed FROM kept GROUP BY doc_id),
rest AS (
  SELECT k.doc_id, string_agg(k.w[k.p], ' ' ORDER BY k.p) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words) k
  ANTI JOIN (SELECT doc_id, unnest(places) AS p FROM gone) x ON k.doc_id = x.doc_id AND k.p = x.p
  GROUP BY k.doc_id)
SELECT f.doc_id, CAST(f.n_words AS BIGINT) AS n_words, CAST(f.n_removed AS BIGINT) AS n_removed, sha256(coalesce(r.s, '')) AS kept_sha256
FROM flat f LEFT JOIN rest r ON r.doc_id = f.doc_id"""

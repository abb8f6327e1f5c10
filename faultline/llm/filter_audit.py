"""How filters of a corpus interact, from truth-table survival words.

Every filter either fails a document or not. With k filters there are 2^k sets of
filters, and a document becomes a word of 2^k bits: bit s is set if the document
survives the filters of set s. The words of a part of the corpus are summed bit by
bit with carry-save adders (a positional popcount): three words of one weight become
one of that weight and one of twice the weight, column by column for all sets at
once. The survivors of all sets, per part and label, then answer every question on
every order of the filters: what a step removes is the difference of two sets, and
no order is run.

Filters that a row cannot answer alone, such as "its text is that of a smaller id",
are answered by a join before the words are made: only texts found more than once
take part, by their smallest id.

Rows: a null text is empty; a null language and an empty one are the same part; a
row without an id has no smaller id and is none, and has no label; rows that share
an id are documents of their own, neither of which fails because of the other. Of
several labels of an id any 1 holds. Parts are those of the table, so an empty table
gives no rows. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import slices, table
from faultline.session import cut_lineage

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUATION = bytes(range(0x80, 0xC0))
#: Labels a document can be counted under; the first holds for all.
LABELS = ("all", "good", "toxic")


def survival_words(filters: int = len(LETTERS)) -> np.ndarray:
    """The word of each pattern of failed filters: bit s is set if no filter of set s fails. Up to 6 filters fit 64 bits."""
    fails = np.arange(1 << filters, dtype=np.uint64)
    survives = (fails[:, None] & fails[None, :]) == 0
    return (survives.astype(np.uint64) << fails[None, :]).sum(1, dtype=np.uint64)


def positional_popcount(words: np.ndarray, bits: int = 1 << len(LETTERS)) -> np.ndarray:
    """How many of the words have each bit, by carry-save adders over whole arrays of words."""
    out = np.zeros(bits, np.int64)
    weight, columns = 0, np.asarray(words, np.uint64)
    while len(columns):
        carried = []
        while len(columns) > 2:
            third = len(columns) // 3
            a, b, c = columns[:third], columns[third : 2 * third], columns[2 * third : 3 * third]
            either = a ^ b
            carried.append((a & b) | (c & either))
            columns = np.concatenate([either ^ c, columns[3 * third :]])
        for word in columns:
            out += ((word >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.int64) << weight
        columns = np.concatenate(carried) if carried else columns[:0]
        weight += 1
    return out


def fails_alone(text: bytes) -> int:
    """Failed filters A to D of one text, A in the lowest bit."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (symbols > 0) << 3
    )


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails of every document: which of the five filters it fails, A in the lowest bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            texts = [t or b"" for t in rows.column(2).to_pylist()]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            fails = pa.array([fails_alone(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), digests, fails], ["doc_id", "part", "digest", "fails"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.col("text").cast("binary").alias("text"))
    alone = cut_lineage(rows.mapInArrow(run, "doc_id long, part string, digest binary, fails int"))
    # A table of its own, so that both sides of the join are shuffled and Spark can split a text that fills much of the corpus.
    copied = alone.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    copied = cut_lineage(copied)
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return alone.join(copied, "digest", "left").select("doc_id", "part", F.col("fails").bitwiseOR(copy * 16).alias("fails"))


def survivors(judged: DataFrame, labels: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """part, label, s0 to s(2^k - 1): documents of a part and label that survive each set of filters."""
    sets = 1 << filters
    names = [f"s{k}" for k in range(sets)]
    schema = "part string, label int, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of_words = survival_words(filters)
        for rows in batches:
            parts = rows.column(0).dictionary_encode()
            part = parts.indices.to_numpy()
            words = table_of_words[rows.column(1).to_numpy()]
            keys, counts = [], []
            for label, named in enumerate([np.ones(len(words), bool), *(c.to_numpy(zero_copy_only=False) for c in rows.columns[2:])]):
                order = np.argsort(part[named], kind="stable")
                found, starts = np.unique(part[named][order], return_index=True)
                for p, group in zip(found, np.split(words[named][order], starts[1:])):
                    keys.append((int(p), label))
                    counts.append(positional_popcount(group, sets))
            if keys:
                columns = [parts.dictionary.take(pa.array([p for p, _ in keys])), pa.array([x for _, x in keys], pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c) for c in np.array(counts).T)], ["part", "label", *names])

    of_id = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    labelled = judged.join(of_id, "doc_id", "left").select("part", "fails", *[F.coalesce(c, F.lit(False)).alias(c) for c in LABELS[1:]])
    return labelled.mapInArrow(run, schema).groupBy("part", "label").agg(*[F.sum(n).alias(n) for n in names])


def orders(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from the survivors of all sets."""
    k = len(letters)
    sets = 1 << k
    plans = [(order, step) for order in permutations(range(k)) for step in range(k)]
    names = ["".join(letters[x] for x in order) for order, _ in plans]
    x = np.array([1 << order[step] for order, step in plans])
    before = np.array([sum(1 << y for y in order[:step]) for order, step in plans])
    step = np.array([s + 1 for _, s in plans])
    full = sets - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1):
            part = rows.column(0)[0].as_py()
            of = dict.fromkeys(range(len(LABELS)), np.zeros(sets, np.int64)) | {
                r["label"]: np.array([r[f"s{s}"] for s in range(sets)], np.int64) for r in rows.column(1)[0].as_py()
            }
            removed, good, toxic = (of[n][before] - of[n][before | x] for n in range(3))
            alive = of[0]
            all_orders = np.zeros(sets, np.int64)
            np.add.at(all_orders, x, removed)
            columns = {
                "part": pa.array([part] * len(plans)), "filter_order": pa.array(names), "step": pa.array(step, pa.int32()),
                "kept": pa.array(alive[before | x]), "removed": pa.array(removed),
                "redundant": pa.array(alive[0] - alive[x] - removed), "unique_fails": pa.array(alive[full ^ x] - alive[full]),
                "good_lost": pa.array(good), "toxic_lost": pa.array(toxic), "shapley": pa.array(all_orders[x]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    of_part = counts.groupBy("part").agg(F.collect_list(F.struct("label", *[f"s{s}" for s in range(sets)])).alias("of"))  # three labels at most
    longs = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return of_part.mapInArrow(run, f"part string, filter_order string, step int, {longs}")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(survivors(judge(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")))


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM words GROUP BY t),
judged AS (
  SELECT w.doc_id, w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
     100 * len(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * len(w.t), regexp_matches(w.t, '[#$%&*|]'), coalesce(w.doc_id > f.first, false)] AS fails
  FROM words w JOIN firsts f USING (t)
  LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
             FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) l ON l.doc_id = w.doc_id),
f AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT o, f.k AS step, o[f.k] AS x, o[1:f.k - 1] AS before, o[1:f.k] AS upto FROM orders, f),
patterns AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
met AS (
  SELECT part, o, step, x, n, good, toxic, fails[x] AS fails_x,
    len(list_filter(before, lambda i: fails[i])) > 0 AS gone, len(list_filter([1, 2, 3, 4, 5], lambda i: fails[i])) = 1 AS one
  FROM patterns, steps),
told AS (
  SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, step, x,
    sum(CASE WHEN NOT gone AND NOT fails_x THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails_x THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails_x THEN n ELSE 0 END) AS redundant, sum(CASE WHEN one AND fails_x THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails_x THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails_x THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, o, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM told"""

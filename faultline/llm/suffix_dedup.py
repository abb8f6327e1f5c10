"""Byte-level deduplication with suffix arrays built by the difference-cover algorithm.

Suffixes meet their equals in the bucket of a minimiser (see ``repeats``); each
bucket sorts the suffixes of its strings by the difference cover {1, 2} of 3: sort
the triples at two of three positions, recurse on their names until they are
unique, sort the other suffixes by their first byte and the rank behind it, and
merge. Neighbours in the array whose 100-byte prefixes are equal form a class, of
which the earliest window stays.

Null and empty texts and those shorter than a window lose nothing; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import table
from faultline.llm.repeats import Bytes, remove_repeats

UNIT = Bytes()


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of positive numbers in ascending order; for up to about two million of them."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    top = int(s.max()) + 1
    padded = np.concatenate([s, [0, 0, 0]]).astype(np.int64)
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    cover = np.concatenate([ones, twos])
    triples = (padded[cover] * top + padded[cover + 1]) * top + padded[cover + 2]
    order = np.argsort(triples)  # equal triples get one name, in whatever order they are
    ordered = triples[order]
    names = np.empty(len(cover), np.int64)
    names[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    if names.max() < len(cover):
        order = suffix_array(names)
    sample = cover[order]
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]
    width = len(cover) + 2
    rest = np.arange(0, n, 3)
    by_next = padded[rest] * width + rank[rest + 1]
    order = np.argsort(by_next)  # no two are equal
    rest, by_next = rest[order], by_next[order]
    # a suffix of the rest against those of the cover: by one symbol and a rank, or by two and a rank
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    by_two = lambda p: (padded[p] * top + padded[p + 1]) * width + rank[p + 2]
    below = np.searchsorted(padded[first] * width + rank[first + 1], by_next) + np.searchsorted(by_two(second), by_two(rest))
    out = np.empty(n, np.int64)
    at = below + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sample
    return out


def equal_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes from each a equal those from the b beside it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(data)] << np.uint64(8 * k)
    left = np.arange(len(a))
    for step in [*range(0, size - 8, 8), size - 8]:
        left = left[eight[a[left] + step] == eight[b[left] + step]]
    out = np.zeros(len(a), bool)
    out[left] = True
    return out


def repeated_windows(members: list[tuple[int, int, int, bytes]], window: int = UNIT.window) -> tuple[np.ndarray, ...]:
    """Ids, ties and starts of the windows of the given strings that are equal to an earlier one."""
    lengths = np.array([len(m[3]) for m in members])
    data = np.frombuffer(b"\0".join([m[3] for m in members]) + b"\0", np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    symbols = data.astype(np.int64) + len(members) + 1
    symbols[ends] = np.arange(1, len(members) + 1)  # every string ends unlike any other
    owner = np.repeat(np.arange(len(members)), lengths + 1)
    order = suffix_array(symbols)
    order = order[ends[owner[order]] - order >= window]  # suffixes that start a window
    same = equal_prefixes(data, order[:-1], order[1:], window)
    kind = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order, kind = order[shared], kind[shared]
    ids, ties, firsts = (np.array([m[k] for m in members], np.int64)[owner[order]] for k in range(3))
    starts = firsts + order - (ends - lengths)[owner[order]]
    by = np.lexsort((starts, ties, ids, kind))
    ids, ties, starts, kind = ids[by], ties[by], starts[by], kind[by]
    head = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, np.int64)
    of = np.repeat(head, np.diff(np.append(head, len(kind))))
    late = (ids != ids[of]) | (ties != ties[of]) | (starts != starts[of])
    return ids[late], ties[late], starts[late]


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), UNIT, repeated_windows)
    return found.select(F.col("id").alias("doc_id"), F.col("units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, length(h) // 2 AS n FROM texts),
windows AS (SELECT doc_id, i, hash(h[2 * i + 1:2 * i + 200]) AS a, md5_number(h[2 * i + 1:2 * i + 200]) AS b
  FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM sized WHERE n >= 100)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
edges AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS first FROM late),
runs AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high
  FROM (SELECT *, sum(CAST(first AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM runs
  UNION ALL SELECT s.doc_id, coalesce(max(r.high), 0), any_value(s.n) FROM sized s LEFT JOIN runs r ON r.doc_id = s.doc_id GROUP BY s.doc_id),
kept AS (SELECT g.doc_id, string_agg(s.h[2 * g.low + 1:2 * g.high], '' ORDER BY g.low) AS h
  FROM gaps g JOIN sized s ON s.doc_id = g.doc_id WHERE g.high > g.low GROUP BY g.doc_id)
SELECT s.doc_id, s.n AS n_bytes, CAST(coalesce(r.removed, 0) AS BIGINT) AS n_removed, coalesce(r.spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM sized s LEFT JOIN (SELECT doc_id, sum(high - low) AS removed, count(*) AS spans FROM runs GROUP BY doc_id) r ON r.doc_id = s.doc_id
LEFT JOIN kept k ON k.doc_id = s.doc_id"""

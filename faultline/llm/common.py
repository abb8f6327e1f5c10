"""Words, rolling hashes and small table helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: The id that rows without one share with rows of that very id; their ties tell them apart.
LAST_ID = (1 << 63) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def squeeze(rows: DataFrame) -> DataFrame:
    """``rows`` with their column ``text`` compressed, for the way through a shuffle; see ``unsqueeze``."""
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            columns = list(part.columns)
            columns[at] = pa.array([None if t is None else pack(t) for t in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return rows.mapInArrow(run, rows.schema)


def unsqueeze(text: bytes | None) -> bytes | None:
    return None if text is None else zstandard.ZstdDecompressor().decompress(text)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; an absent id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def row_place(doc_id: Column, text: Column) -> list[Column]:
    """id and tie of a row, in whose order rows come: by id, those without one last, then by a hash of the text.

    Ties are negative in rows that have an id, so no id is mistaken for an absent one.
    """
    hashed = F.xxhash64(text)
    tie = F.when(doc_id.isNull(), hashed.bitwiseAND(F.lit(LAST_ID))).otherwise(hashed.bitwiseOR(F.lit(-1 - LAST_ID)))
    return [F.coalesce(doc_id.cast("long"), F.lit(LAST_ID)).alias("id"), tie.alias("tie")]


def own_id() -> Column:
    """The id that a row of ``row_place`` had, null if none."""
    return F.when(~((F.col("id") == LAST_ID) & (F.col("tie") >= 0)), F.col("id"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) <= n:
        size = 1 << int(n).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, inverse)
        )
    return _POWERS


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` gets the hash of any span of the bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers(len(data))[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of all runs of ``size`` consecutive bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(data)
    sums = prefix[size:] - prefix[:-size]
    return mix(sums * _powers(len(prefix))[1][: len(sums)] + np.uint64(size))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a UTF-8 text."""
    edge = np.diff(_SPACE[data].astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    return span_hash(prefix_hash(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)


def gram_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive items."""
    if len(items) < n:
        return np.zeros(0, np.uint64)
    size = len(items) - n + 1
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + items[k : k + size]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window of ``width`` values."""
    if len(values) < width:
        return values[:0]
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[step:], values[:-step])
        have += step
    return values

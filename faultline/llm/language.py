"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent n-grams (1 to 3 letters, lower case,
words bounded) of a language, most frequent first. A text gets the language whose
profile its own most frequent n-grams lie nearest, by the sum of their
out-of-place distances; an n-gram that a profile lacks counts as far as the
profile is long.

Null or empty texts and texts without a letter are ``und`` with score 0, as is
everything when no labelled text was given. Ties go to the smaller code of an
n-gram and to the language name that sorts first. Languages beyond
``MAX_LANGUAGES`` are an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import crc_mod, slices, table

RANKS = 400
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
_FLUSH = 1_000_000
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: bytes) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 symbols, 21 bits a symbol; 1 stands for the edge of a word."""
    points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    letters = _letters()[points]
    x = np.concatenate([[1], np.where(letters, points, 1), [1]]).astype(np.int64)
    x = x[np.concatenate([[True], (x[1:] != 1) | (x[:-1] != 1)])]
    if len(x) < 2:
        return np.zeros(0, np.int64)
    pairs = x[:-1] << 21 | x[1:]
    triples = pairs[:-1] << 21 | x[2:]
    return np.concatenate([x[x != 1], pairs, triples[x[1:-1] != 1]])


def top_grams(codes: np.ndarray, k: int = RANKS) -> np.ndarray:
    """The ``k`` most frequent codes, most frequent first."""
    found, counts = np.unique(codes, return_counts=True)
    if len(found) > k:
        keep = np.flatnonzero(counts >= np.partition(counts, len(counts) - k)[len(counts) - k])
        found, counts = found[keep], counts[keep]
    return found[np.argsort(-counts, kind="stable")][:k]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", k: int = RANKS) -> dict[str, np.ndarray]:
    """The profile of each language, from all rows with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def fold(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                codes, counts = fold(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])
            held.clear()

        for part in slices(batches):
            by: dict[str, list[np.ndarray]] = {}
            for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by.setdefault(name, []).append(grams(t))
            for name, codes in by.items():
                parts = held.setdefault(name, [])
                parts.append(np.unique(np.concatenate(codes), return_counts=True))
                size += len(parts[-1][0])
                if len(parts) > 16:
                    size -= sum(len(p[0]) for p in parts)
                    held[name] = [fold(parts)]
                    size += len(held[name][0][0])
            if size > _FLUSH:
                yield from out()
                size = 0
        yield from out()

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string"), F.col(text).cast("binary"))
    counts = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    profiles = ranked.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams"))
    rows = profiles.limit(MAX_LANGUAGES + 1).collect()  # k n-grams of each language
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array([g["gram"] for g in r["grams"]], np.int64) for r in sorted(rows, key=lambda r: r["lang"])}


def out_of_place(doc: np.ndarray, profile: tuple[np.ndarray, np.ndarray], k: int) -> int:
    """Distance of a document's ranks to a profile given as sorted codes and their ranks."""
    codes, ranks = profile
    at = np.minimum(np.searchsorted(codes, doc), len(codes) - 1)
    return int(np.where(codes[at] == doc, np.abs(ranks[at] - np.arange(len(doc))), k).sum())


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[Column], k: int = RANKS, text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with lang_pred and score, 1 for a perfect match of ranks."""
    names = list(profiles)
    sorted_profiles = [(p[o], o) for p in profiles.values() for o in [np.argsort(p)]]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs, scores = [], []
            for t in part.column(part.num_columns - 1).to_pylist():
                doc = top_grams(grams(t or b""), k)
                if not len(doc) or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                far = [out_of_place(doc, p, k) for p in sorted_profiles]
                best = int(np.argmin(far))
                langs.append(names[best])
                scores.append(1 - far[best] / (k * len(doc)))
            columns = [*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "lang_pred", "score"])

    narrow = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(judge, f"{fields}, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    profiles = learn_profiles(docs.where(~held_out))
    return identify(docs, profiles, [F.col("doc_id"), held_out.alias("held_out")])

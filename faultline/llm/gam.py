"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting grows shallow trees on one feature at a time, round by round, and
adds them into one lookup table per feature; the pairs of features that explain
most of what is left get two-dimensional tables in the same way. A text's score
is the logistic of a sum of table entries.

Fitting uses at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their id; scoring covers every row. A row's features come from its text alone.
Null and empty texts have all features 0 and a score like any other. Rows labelled
more than once take the mean label, absent labels are ignored, and without any
label all scores are 0.5.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import crc_mod, prefix_hash, slices, span_hash, table, word_spans

FIT_ROWS = 20_000
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "mean_word", "longest_word", "short_words", "distinct_words", "top_word", "top_ending",
    "symbols", "punctuation", "upper", "digits", "non_ascii", "lines", "repeated_lines", "repeated_bigrams",
)
_KIND = np.zeros(256, np.int64)
_KIND[[ord(c) for c in "#*$%&|<>@~^_=+{}[]\\/"]] = 1
_KIND[[ord(c) for c in ".,;:!?\"'()-`"]] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[128:] = 5


def features(text: bytes) -> list[float]:
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    n, size = len(starts), max(1, len(data))
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND[data], minlength=6)
    sums = prefix_hash(data)
    words = span_hash(sums, starts, ends)
    lengths = ends - starts
    counts = np.unique(words, return_counts=True)[1]
    endings = np.bincount(data[ends - 1], minlength=256)
    endings[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
    bigrams = np.unique(words[:-1] * np.uint64(3) + words[1:])
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        np.log1p(len(data)), np.log1p(n), lengths.mean(), float(lengths.max()), (lengths <= 3).mean(), len(counts) / n, counts.max() / n,
        endings.max() / n, kinds[1] / size, kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size,
        len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)), 1 - (len(bigrams) + 1) / n,
    ]


class Gam:
    """Lookup tables over binned features, fitted by cyclic boosting of shallow trees."""

    def __init__(self, bins: int = 48, rounds: int = 150, rate: float = 0.15, pairs: int = 6, pair_bins: int = 8, least: int = 10):
        self.bins, self.rounds, self.rate, self.n_pairs, self.pair_bins, self.least = bins, rounds, rate, pairs, pair_bins, least
        self.edges: list[np.ndarray] = []
        self.coarse: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.base = 0.0

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))

    def _tree(self, g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
        """Steps of a tree over ordered bins with gradient, curvature and row sums."""
        out = np.full(len(g), g.sum() / (h.sum() + 1.0))
        if depth and len(g) > 1:
            gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
            gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
            gain = np.where((nl >= self.least) & (nr >= self.least), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1.0)
            cut = int(np.argmax(gain))
            if gain[cut] > g.sum() ** 2 / (h.sum() + 1) + 1e-9:
                for part in (slice(0, cut + 1), slice(cut + 1, None)):
                    out[part] = self._tree(g[part], h[part], n[part], depth - 1)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Gam":
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [self._edges(c, self.bins) for c in x.T]
        self.coarse = [self._edges(c, self.pair_bins) for c in x.T]
        at = [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        total = np.full(len(y), self.base)

        def sums(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return np.bincount(cells, y - p, size), np.bincount(cells, p * (1 - p), size), np.bincount(cells, minlength=size)

        for _ in range(self.rounds):
            for t, cells in zip(self.tables, at):
                step = self.rate * self._tree(*sums(cells, len(t)), depth=2)
                t += step
                total += step[cells]
        rough = [np.searchsorted(e, c, "right") for e, c in zip(self.coarse, x.T)]
        found = []
        for i in range(x.shape[1]):
            for j in range(i):
                g, h, n = sums(rough[i] * (self.pair_bins + 1) + rough[j], (self.pair_bins + 1) ** 2)
                found.append((float((np.where(n >= self.least, g, 0) ** 2 / (h + 1)).sum()), i, j))
        self.pairs = [(i, j, np.zeros((self.pair_bins + 1) ** 2)) for _, i, j in sorted(found, reverse=True)[: self.n_pairs]]
        for _ in range(self.rounds // 3):
            for i, j, t in self.pairs:
                cells = rough[i] * (self.pair_bins + 1) + rough[j]
                g, h, n = (a.reshape(self.pair_bins + 1, -1) for a in sums(cells, len(t)))
                rows = self._tree(g.sum(1), h.sum(1), n.sum(1), depth=1)  # one cut of the first feature, then one of the second on each side
                step = np.zeros_like(g)
                for value in np.unique(rows):
                    side = rows == value
                    step[side] = self._tree(g[side].sum(0), h[side].sum(0), n[side].sum(0), depth=1)
                t += self.rate * step.ravel()
                total += self.rate * step.ravel()[cells]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for e, t, c in zip(self.edges, self.tables, x.T):
            total += t[np.searchsorted(e, c, "right")]
        for i, j, t in self.pairs:
            total += t[np.searchsorted(self.coarse[i], x[:, i], "right") * (self.pair_bins + 1) + np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-total))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Gam | None:
    """Fit on the labelled rows of ``docs`` whose ids have the smallest hashes, ``rows`` at most."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("_label"))
    known = known.select(F.col("doc_id").alias("_labelled"), "_label")
    ids = docs.where("doc_id is not null").select("doc_id").join(known, F.col("doc_id") == F.col("_labelled"))
    chosen = ids.select("doc_id", "_label").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    if not chosen:
        return None
    spark = docs.sparkSession
    sample = F.broadcast(spark.createDataFrame([(r[0], r[1]) for r in chosen], "_labelled long, _label double"))  # ``rows`` rows at most
    texts = docs.join(sample, F.col("doc_id") == F.col("_labelled")).select("_label", F.col("text").cast("binary"))

    def collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [features(t or b"") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.float64()))], ["y", "x"])

    got = texts.mapInArrow(collect_features, "y double, x array<double>").toArrow()
    x = np.array(got["x"].to_pylist(), float)
    y = np.array(got["y"].to_pylist(), float) >= 0.5
    order = np.lexsort([*x.T, y])  # rows come in any order; the sums of a fit should not depend on it
    return Gam().fit(x[order], y[order].astype(float))


def score_quality(docs: DataFrame, model: Gam | None, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with ``score``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(part.num_columns - 1).to_pylist()
            x = np.array([features(t or b"") for t in texts], float).reshape(len(texts), len(FEATURES))
            scores = model.score(x) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], [*part.schema.names[:-1], "score"])

    narrow = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(judge, f"{fields}score double")


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from."""
    return docs.where(crc_mod(F.col("doc_id"), 4) != 2)


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(learnable(docs), table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, [F.col("doc_id"), (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score reaches ``threshold``, all columns as they were; all rows if no label could be learned from."""
    model, at = fit_quality(learnable(docs), labels), docs.columns.index(text)
    if model is None:
        warnings.warn("no label could be learned from: quality is not judged and all rows are kept", stacklevel=2)
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [features(t.encode() if t else b"") for t in part.column(at).to_pylist()]
            scores = model.score(np.array(found, float).reshape(len(found), len(FEATURES)))
            yield part.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Nearest vectors by cosine: exact over all logs, or over the lists of an index.

Exact: the log vectors are read once, however many queries there are. Queries up to
``block_bytes`` go to every task, which keeps the k best of its rows for each of them.
More queries are cut into blocks, and blocks and parts of the logs meet as a grid: one
shuffle brings each part's rows to each block, queries first, so that a task holds one
block of queries and their running best rows while the log rows stream past. A log row
travels once for each block, so a block of the grid is never made smaller than
``CELL_BYTES``, however few bytes of queries may go to every task. Logs with the same
vector are scored once, as their newest row; their k newest rows join the result.

Index: logs in lists around centroids. The centroids are fitted on a bounded sample;
every log is in the list of its nearest one. A query looks into the lists of its
``probes`` nearest centroids, whose rows are scored exactly, so only logs in other lists
can be missed; with as many probes as lists nothing is. How many probes a wanted recall
takes is measured when the index is built, on a sample of its own vectors as queries
that are answered exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions.times import micros
from faultline.session import cut_lineage

# Matrix products add up in an order that depends on the batch, so similarities
# are rounded before they are ranked: equal vectors then tie exactly.
SIMILARITY_DIGITS = 9
BLOCK_BYTES, QUERY_CHUNK = 16 << 20, 512
#: Least size of a block of the grid, queries and their best rows; a log row is copied once for each block.
CELL_BYTES = 16 << 20
#: Least rows of a part of the logs that meets the blocks, as each part gives out k rows for every query.
PART_ROWS = 4096
#: Vectors that the centroids of an index are fitted on, at most, and the rounds of that fit.
SAMPLE_ROWS, FIT_ROUNDS = 20_000, 12
LISTS = 64
#: Vectors that serve as queries to measure the recall, at most about, and the share of their K nearest that is to be found.
TRIAL_ROWS, TRIAL_K, RECALL = 400, 10, 0.95

_ALWAYS = np.iinfo(np.int64).min
_HIT = "query_id bigint, log_id bigint, micros bigint, similarity double"


def normalised(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


class Best:
    """The k best rows met so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cutoffs: np.ndarray, k: int):
        self.ids, self.cutoffs, self.k = ids, cutoffs, k
        self.queries = normalised(vectors)
        n = len(ids)
        self.sims, self.times, self.logs = [np.empty(0)] * n, [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n
        self.floor = np.full(n, -np.inf)

    def meet(self, batch: pa.RecordBatch) -> None:
        """Score log_id, micros, embedding rows of the block's length; rows with an element that is no number are passed over."""
        dim, k = self.queries.shape[1], self.k
        if not batch.num_rows:
            return
        rows = _matrix(batch.column("embedding"), dim)
        finite = np.isfinite(rows).all(axis=1)  # a null element is NaN here
        rows = normalised(rows[finite])
        if not len(rows):
            return
        at = batch.column("micros").to_numpy(zero_copy_only=False)[finite]
        log_id = batch.column("log_id").to_numpy(zero_copy_only=False)[finite]
        for start in range(0, len(self.ids), QUERY_CHUNK):
            part = slice(start, start + QUERY_CHUNK)
            scores = np.round(self.queries[part] @ rows.T, SIMILARITY_DIGITS) + 0.0
            scores[at[None, :] < self.cutoffs[part, None]] = -np.inf
            least = self.floor[part]
            if len(rows) > k:
                least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
            eligible = (scores >= least[:, None]) & (scores > -np.inf)
            for j in np.flatnonzero(eligible.any(axis=1)):
                q, pick = start + j, np.flatnonzero(eligible[j])
                s = np.concatenate([self.sims[q], scores[j, pick]])
                t = np.concatenate([self.times[q], at[pick]])
                i = np.concatenate([self.logs[q], log_id[pick]])
                top = np.lexsort((i, -t, -s))[:k]
                self.sims[q], self.times[q], self.logs[q] = s[top], t[top], i[top]
                if len(top) == k:
                    self.floor[q] = self.sims[q][-1]

    def rows(self) -> Iterator[pa.RecordBatch]:
        counts = [len(s) for s in self.sims]
        if sum(counts):
            columns = [np.repeat(self.ids, counts), *(np.concatenate(c) for c in (self.logs, self.times, self.sims))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "log_id", "micros", "similarity"])


def _in_every_task(blocks: dict[int, tuple], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(*block, k) for dim, block in blocks.items()}
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("embedding")), -1)
            for dim, held in best.items():
                held.meet(batch.filter(pc.equal(lengths, dim)))
        for held in best.values():
            yield from held.rows()

    return run


def _along_the_grid(k: int):
    """Reader of rows sorted by (cell, is_log): the queries of a cell, then the logs that they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, best = None, [], None

        def block() -> Best | None:
            if not asked:
                return None
            rows = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
            dim = len(rows.column("embedding")[0])
            return Best(rows.column("id").to_numpy(), _matrix(rows.column("embedding"), dim), rows.column("micros").to_numpy(), k)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)] if len(cells) else [0]
            for low, high in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(low, high - low)
                if cells[low] != cell:
                    if best is not None:
                        yield from best.rows()
                    cell, asked, best = cells[low], [], None
                is_log = part.column("is_log")
                queries, logs = part.filter(pc.invert(is_log)), part.filter(is_log)
                if queries.num_rows:
                    asked.append(queries)
                if logs.num_rows:
                    best = best or block()
                    if best is not None:
                        best.meet(logs.rename_columns(["cell", "is_log", "log_id", "micros", "embedding"]))
        if best is not None:
            yield from best.rows()

    return run


def _finite(embedding: str) -> Column:
    """Not so for null, NaN and infinity."""
    return F.forall(embedding, lambda x: F.abs(x) <= F.lit(float(np.finfo(np.float32).max)))


def _log_rows(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("embedding").isNotNull()).select(
        "log_id", micros(F.col("timestamp")).alias("micros"), F.col("embedding").cast("array<float>").alias("embedding"))


def _asked(queries: DataFrame) -> DataFrame:
    since = F.coalesce(micros(F.col("cutoff")), F.lit(_ALWAYS)) if "cutoff" in queries.columns else F.lit(_ALWAYS)
    return queries.filter(F.col("embedding").isNotNull()).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("embedding").cast("array<float>").alias("embedding"), since.alias("cutoff"),
    ).filter((F.size("embedding") > 0) & _finite("embedding"))


def _meet(queries: DataFrame, logs: DataFrame, k: int) -> DataFrame:
    """Hits of queries (cell, id, micros, embedding) and logs (cell, id, micros, embedding) that share a cell."""
    columns = ["cell", "is_log", "id", "micros", "embedding"]
    both = queries.withColumn("is_log", F.lit(False)).select(columns).unionByName(logs.withColumn("is_log", F.lit(True)).select(columns))
    # The work grows with products of rows, not with bytes, so the number of tasks is given: it is not to be coalesced.
    tasks = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(tasks, "cell").sortWithinPartitions("cell", "is_log").mapInArrow(_along_the_grid(k), _HIT)


def _grid(asked: DataFrame, sizes: list, logs: DataFrame, k: int, block_bytes: int) -> DataFrame:
    """Hits of all queries; ``asked``: lead, dim, embedding, cutoff; ``sizes``: (dim, number of queries). Counts the logs."""
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = {dim: max(1, -(-n * (8 * dim + 24 * k) // max(block_bytes, CELL_BYTES))) for dim, n in sizes}
    most = -(-logs.count() // PART_ROWS)
    parts = {dim: max(1, min(tasks // b, most)) for dim, b in blocks.items()}
    of = lambda numbers: F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    n_blocks, n_parts = (F.try_element_at(of(numbers), F.col("dim")) for numbers in (blocks, parts))
    cell = lambda block, part: F.xxhash64("dim", block.cast("bigint"), part.cast("bigint"))
    queries = asked.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))).select(
        cell(F.pmod(F.xxhash64("lead"), n_blocks), F.col("part")).alias("cell"), F.col("lead").alias("id"), F.col("cutoff").alias("micros"), "embedding")
    rows = logs.withColumn("dim", F.size("embedding")).where(F.col("dim").isin(list(blocks)))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))).select(
        cell(F.col("block"), F.pmod(F.xxhash64("log_id"), n_parts)).alias("cell"), F.col("log_id").alias("id"), "micros", "embedding")
    return _meet(queries, rows, k)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.desc("micros"), "log_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest(logs: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k logs nearest to each query by cosine: query_id, log_id, micros, similarity, rank.

    ``logs``: log_id, timestamp, embedding.  ``queries``: query_id, embedding and, if
    wanted, cutoff (only logs at or after it count; null: all).  Logs without a vector,
    with one of another length, or with an element that is null, NaN or infinite are
    skipped; queries with such a vector get no hits. Of queries up to ``block_bytes``
    each is scored as it stands; of more, those with the same vector and cutoff once.
    Starts a job that counts the queries.
    """
    known = _asked(queries)
    rows = _log_rows(logs)
    size = F.sum(F.lit(8) * F.size("embedding") + 24 * k)
    if (known.agg(size).first()[0] or 0) <= block_bytes:
        found = known.toArrow().combine_chunks()
        lengths = pc.list_value_length(found.column("embedding")).to_numpy()
        blocks = {}
        for dim in np.unique(lengths).tolist():
            mine = found.filter(pa.array(lengths == dim)).combine_chunks()
            vectors = _matrix(mine.column("embedding").combine_chunks(), dim)
            blocks[int(dim)] = (mine.column("query_id").to_numpy(), vectors, mine.column("cutoff").to_numpy())
        return _ranked(rows.mapInArrow(_in_every_task(blocks, k), _HIT), k)
    known = cut_lineage(known.withColumn("dim", F.size("embedding")))
    same = ["embedding", "cutoff", "dim"]
    asked = cut_lineage(known.select(same).distinct().withColumn("lead", F.monotonically_increasing_id()))
    sizes = [(r["dim"], r["count"]) for r in asked.groupBy("dim").count().collect()]
    vectors, members = _by_vector(rows, k)
    groups = _ranked(_grid(asked, sizes, vectors, k, block_bytes), k).select(F.col("query_id").alias("lead"), F.col("log_id").alias("first"), "similarity", "rank")
    hits = groups.join(members, "first").where(F.col("place") <= k + 1 - F.col("rank"))
    hits = hits.join(asked.select("lead", "cutoff"), "lead").where(F.col("micros") >= F.col("cutoff"))
    hits = _ranked(hits.select(F.col("lead").alias("query_id"), "log_id", "micros", "similarity"), k).withColumnRenamed("query_id", "lead")
    return known.join(asked, same).select("query_id", "lead").join(hits, "lead").drop("lead")


def _by_vector(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The newest row of each vector, and the k newest rows of each with their place (first: the newest one's log_id).

    Rows of one vector tie in similarity, so those that a query takes are among the k
    newest of the k vectors that rank first by their newest row; of the r-th of these,
    which r - 1 rows precede, among the k + 1 - r newest. Starts a job that writes the rows.
    """
    newest = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy(F.desc("micros"), "log_id")
    kept = rows.withColumn("place", F.row_number().over(newest)).where(F.col("place") <= k)
    kept = cut_lineage(kept.withColumn("first", F.first("log_id").over(newest)))
    return kept.where(F.col("place") == 1).select("log_id", "micros", "embedding"), kept.select("first", "place", "log_id", "micros")


# -- Index


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = FIT_ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors: each vector's list is the centroid with the largest product."""
    rng = np.random.default_rng(seed)
    sample = normalised(sample)
    centroids = sample[rng.permutation(len(sample))[: min(lists, len(sample))]].copy()
    for _ in range(rounds):
        nearest_one = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest_one, sample)
        full = np.bincount(nearest_one, minlength=len(centroids)) > 0
        centroids[full] = normalised(sums[full])
    return centroids


class VectorIndex:
    """Logs in lists around centroids, written under ``path`` (see :func:`build_index`)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        rows = spark.read.parquet(f"{path}/centroids").orderBy("list").toArrow()
        vectors = rows.column("centroid").to_pylist()
        self.centroids = np.array(vectors, np.float64) if vectors else np.zeros((0, 0))
        self.probes = spark.read.parquet(f"{path}/probes").first()["probes"]
        self.logs = spark.read.parquet(f"{path}/lists")

    def lists_of(self, vectors: DataFrame, n: int) -> DataFrame:
        """``vectors`` (with a column embedding of the index's length) with ``lists``, those of the n nearest centroids."""
        return _with_lists(vectors, self.centroids, n)

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None) -> DataFrame:
        """query_id, log_id, micros, similarity, rank among the logs in the lists that each query looks into.

        ``probes``: how many, by default those that reached the recall wanted when the
        index was built. As in :func:`nearest`, but vectors of another length than the index's are
        skipped. Hot lists are dealt over parts; a part meets all queries of its list.
        """
        dim = self.centroids.shape[1]
        asked = _asked(queries).where(F.size("embedding") == dim)
        probed = self.lists_of(asked.select("query_id", "cutoff", "embedding"), probes or self.probes).withColumn("list", F.explode("lists"))
        tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, 4 * tasks // max(1, len(self.centroids)))
        cell = lambda part: F.xxhash64("list", part.cast("bigint"))
        left = probed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
            cell(F.col("part")).alias("cell"), F.col("query_id").alias("id"), F.col("cutoff").alias("micros"), "embedding")
        wanted = probed.select("list").distinct()
        right = self.logs.join(wanted, "list", "left_semi").select(
            cell(F.pmod(F.xxhash64("log_id"), F.lit(parts))).alias("cell"), F.col("log_id").alias("id"), "micros", "embedding")
        return _ranked(_meet(left, right, k), k)


def _with_lists(vectors: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    names = vectors.columns
    at = names.index("embedding")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = normalised(_matrix(batch.column(at), centroids.shape[1])) if batch.num_rows else np.zeros((0, centroids.shape[1]))
            order = np.argsort(-(rows @ centroids.T), axis=1, kind="stable")[:, :n].astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, order.size + 1, max(1, order.shape[1]))[: len(rows) + 1].astype(np.int32), order.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, "lists"])

    return vectors.mapInArrow(run, f"{kinds}, lists array<int>")


def _probes_for(recall: float, logs: DataFrame, stored: DataFrame, centroids: np.ndarray, total: int) -> int:
    """The least number of lists that hold a share of ``recall`` of the nearest logs of a sample of the logs."""
    if not total:
        return 1
    share = min(1.0, TRIAL_ROWS / total)
    trial = stored.where(F.xxhash64(F.lit(1), "log_id").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)) + 1)
    trial = trial.select(F.col("log_id").alias("query_id"), "embedding")
    hits = nearest(logs, trial, TRIAL_K).select("query_id", "log_id").join(stored.select("log_id", "list"), "log_id")
    order = _with_lists(trial, centroids, len(centroids)).select("query_id", "lists")
    places = hits.join(order, "query_id").groupBy(F.array_position("lists", F.col("list")).alias("place")).agg(F.count("*").alias("n")).orderBy("place").collect()
    found, wanted = 0, recall * sum(r["n"] for r in places)
    for r in places:  # a row for each list at most
        found += r["n"]
        if found >= wanted:
            return int(r["place"])
    return 1


def build_index(logs: DataFrame, path: str, lists: int = LISTS, sample_rows: int = SAMPLE_ROWS, recall: float = RECALL) -> VectorIndex:
    """Write an index over every log with a vector (log_id, timestamp, embedding) and open it.

    Vectors must be of one length; those with an element that is null, NaN or infinite
    are left out, as in :func:`nearest`. Centroids are fitted on at most about
    ``sample_rows`` vectors, chosen by a hash of their id.
    """
    spark = logs.sparkSession
    rows = _log_rows(logs).where(F.size("embedding") > 0).where(_finite("embedding"))
    total, low, high = rows.agg(F.count("*"), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} elements; an index holds one length")
    share = min(1.0, sample_rows / max(1, total))
    chosen = rows.where(F.xxhash64("log_id").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30))) if share < 1 else rows
    sample = chosen.orderBy(F.xxhash64("log_id"), "log_id").limit(2 * sample_rows).select("embedding").toArrow().combine_chunks()
    centroids = fit_centroids(_matrix(sample.column("embedding").combine_chunks(), low), lists) if sample.num_rows else np.zeros((0, low or 0))
    table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centroids)], "list int, centroid array<double>")
    table.write.mode("overwrite").parquet(f"{path}/centroids")
    placed = _with_lists(rows, centroids, 1).select(F.col("lists")[0].alias("list"), "log_id", "micros", "embedding")
    # Sorted files: a search reads the row groups of the lists it wants.
    placed.repartitionByRange("list", F.xxhash64("log_id")).sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/lists")
    probes = _probes_for(recall, logs, spark.read.parquet(f"{path}/lists"), centroids, total)
    spark.createDataFrame([(probes,)], "probes int").write.mode("overwrite").parquet(f"{path}/probes")
    return VectorIndex(spark, path)

"""Mixing sources to target weights.

Documents of a source fall by hash into blocks of about ``rows_per_block``
documents, which is a random order of the source. A source's target is turned
into whole passes over its blocks and, for the rest, the first blocks in that
order; in the last of these documents are taken until the target is met. A
splitting tree deals the drawn blocks to output shards: each node draws, from a
multivariate hypergeometric law, how many blocks of each source go left, so that
every shard gets its share of all sources and no block twice. Within its shard a
copy has a random place.

Rows: null text has size 0; a null source is a source, last in the order of
weights; repeated rows are documents of their own; an empty table gives no rows.
Columns of the input that share a name with a column made here are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import n_words, table

WEIGHTS = (3, 1, 2)
#: Sources are rows of a configuration: more than this is an error, not a cut.
MAX_SOURCES = 100_000


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words for each source: ``share`` of all by weight, none above ``most`` times its size."""
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] >= most * sizes[i]}
        for i in full or open_:
            out[i] = most * sizes[i] if full else unit * weights[i]
            left -= out[i]
        if not full:
            break
        open_ -= full
    return out


def split_tree(quotas: Sequence[int], shards: int, seed: int, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """First draw and number of draws of each source that one shard gets.

    Walks from the root to the shard. Every node's law is seeded by the node, so
    tasks that share a node draw the same split there.
    """
    counts = np.array(quotas, np.int64)
    first = np.zeros(len(counts), np.int64)
    low, high, node = 0, shards, 1
    while high - low > 1:
        middle = (low + high) // 2
        total = int(counts.sum())
        rng = np.random.Generator(np.random.PCG64([seed, node]))
        left = rng.multivariate_hypergeometric(counts, total * (middle - low) // (high - low), method="marginals")
        if shard < middle:
            counts, high, node = left, middle, 2 * node
        else:
            first, counts, low, node = first + left, counts - left, middle, 2 * node + 1
    return first, counts


def plan_mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0,
    shards: int = 64, rows_per_block: int = 4096, seed: int = 17, whole: bool = False,
) -> DataFrame:
    """``docs`` with size, source_size, target, taken and ``draws``: the copies (epoch, shard, words) of each.

    A copy of fewer words than the document is its beginning; there is at most
    one such document in each source, and none with ``whole``, which takes that
    document if more than half of it fits.
    """
    spark = docs.sparkSession
    hidden = ["_key", "_place", "_block", "_tie"]
    made = ["source_size", "target", "draws", "_passes", "_left", "_draws", "_part", "_blocks"]
    sized = docs.drop(*made).withColumns({
        "_tie": F.xxhash64("text"),
        "size": n_words(F.col("text")),
        "_key": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "_place": F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(F.lit((1 << 30) - 1)),
    })
    found = sized.groupBy("_key").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["_key"] == "", r["_key"]))
    wanted = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    rows = [(r["_key"], i, r["size"], t, max(1, math.ceil(r["n"] / rows_per_block))) for i, (r, t) in enumerate(zip(found, wanted))]
    sources = spark.createDataFrame(rows, "_key string, _source int, source_size long, target double, _blocks int")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = sources.withColumn("_passes", passes)
    sources = sources.withColumn("_rest", F.round(F.col("target") - F.col("_passes") * F.col("source_size")).cast("long"))

    dealt = sized.join(F.broadcast(sources.select("_key", "_blocks")), "_key").withColumn(
        "_block", F.floor(F.col("_place") * F.col("_blocks") / F.lit(1 << 30)).cast("int")
    ).drop("_blocks")
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        dealt.groupBy("_key", "_block").agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .join(F.broadcast(sources), "_key")
        .withColumn("_left", F.greatest(F.lit(0), F.col("_rest") - F.col("_before")))
    )
    drawn = {r["_source"]: r["k"] for r in blocks.groupBy("_source").agg(
        F.max(F.col("_passes") * F.col("_blocks")).alias("p"),
        F.max(F.when(F.col("_left") > 0, F.col("_block") + 1).otherwise(0)).alias("m"),
    ).select("_source", (F.col("p") + F.col("m")).alias("k")).collect()}
    quotas = [drawn.get(i, 0) for i in range(len(rows))]

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                first, counts = split_tree(quotas, shards, seed, int(shard))
                yield pd.DataFrame({"_source": np.arange(len(counts), dtype=np.int32), "_shard": np.int32(shard), "_first": first, "_n": counts})

    draws = (
        spark.range(shards).mapInPandas(deal, "_source int, _shard int, _first long, _n long").where("_n > 0")
        .select("_source", "_shard", F.explode(F.expr("sequence(_first, _first + _n - 1)")).alias("_draw"))
        .join(F.broadcast(sources.select("_source", "_key", "_blocks")), "_source")
        .select("_key", (F.col("_draw") % F.col("_blocks")).cast("int").alias("_block"),
                F.struct(F.floor(F.col("_draw") / F.col("_blocks")).cast("int").alias("epoch"), F.col("_shard").alias("shard")).alias("d"))
        .groupBy("_key", "_block").agg(F.sort_array(F.collect_list("d")).alias("_draws"))  # a row for each pass over a block
    )
    columns = ["_key", "_block", "source_size", "target", "_passes", "_left", "_draws"]
    blocks = blocks.join(draws, ["_key", "_block"], "left").select(*columns)

    order = Window.partitionBy("_key", "_block").orderBy("_place", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_left") - F.coalesce(F.sum("size").over(order), F.lit(0))
    part = F.when(room * 2 > F.col("size"), F.col("size")).otherwise(0) if whole else F.greatest(F.lit(0), F.least(room, F.col("size")))
    words = lambda d: F.when(d["epoch"] < F.col("_passes"), F.col("size")).otherwise(F.col("_part"))
    copies = F.transform(
        F.coalesce(F.col("_draws"), F.expr("cast(array() as array<struct<epoch:int,shard:int>>)")),
        lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), words(d).cast("long").alias("words")),
    )
    return (
        dealt.join(blocks, ["_key", "_block"])
        .withColumn("_part", part)
        .withColumn("draws", F.filter(copies, lambda d: d["words"] > 0))
        .withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
        .drop(*hidden, "_passes", "_left", "_draws", "_part")
    )


def draw_mix(plan: DataFrame, seed: int = 17) -> DataFrame:
    """One row for each copy of a plan of whole documents, with its shard, epoch and random place in the shard."""
    copies = plan.withColumn("_draw", F.explode("draws")).withColumns({
        "shard": F.col("_draw.shard"), "epoch": F.col("_draw.epoch"),
        "place": F.xxhash64(F.lit(seed), "_draw.shard", "_draw.epoch", "doc_id", "text"),
    })
    return copies.drop("_draw", "draws")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")

"""A Merkle manifest of a dataset: one ternary tree per source and one over the sources.

Nodes are SHA-256 digests. Three consecutive nodes of a level hash to one of the
next (the last run may have two or one) until one is left. A tree is cut into aligned
subtrees of ``BLOCK_HEIGHT`` levels, one row of a table each, and the roots of the
blocks are the leaves of the next layer of blocks, up to one block. In its block a
subtree is stored in the van Emde Boas order: its upper half first, then each subtree
of the lower half, each in the same order. Addresses of all levels follow from the
height by arithmetic; the same addresses serve to build a block from its leaves and to
fetch the siblings on a path. So one path touches few stretches of memory whatever the
size of a cache line, and one block per layer.

Spark places the leaves (a range sort of ids and digests, never of texts), groups them
into blocks, and passes down to each block the path from its root to the root of the
dataset, layer by layer; leaves get their proofs in the block they are stored in.
No task holds more than one block beyond its input, however large a source is.

Rows: nulls are coded as such and differ from empty values; a null source is a source
of its own, the first; rows without an id come first in their source and are never
tampered with; rows that share an id are ordered by their digest. A source of one row
has its leaf as root; an empty table gives no rows. Columns other than the five that
are hashed are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import slices, table
from faultline.session import cut_lineage

FANOUT = 3
BLOCK_HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "lefts array<string>, rights array<string>"


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` of them."""
    h = 0
    while FANOUT**h < n:
        h += 1
    return h


@lru_cache(maxsize=None)
def layout(levels: int) -> list[np.ndarray]:
    """Addresses of the nodes of a complete subtree in van Emde Boas order, level by level from its root."""
    if levels == 1:
        return [np.zeros(1, np.int64)]
    upper = levels // 2
    top, bottom = layout(upper), layout(levels - upper)
    size = lambda n: (FANOUT**n - 1) // (FANOUT - 1)
    starts = size(upper) + np.arange(FANOUT**upper) * size(levels - upper)
    return top + [(starts[:, None] + level[None, :]).ravel() for level in bottom]


def counts_of(leaves: int, height: int) -> list[int]:
    """Nodes that a subtree of so many leaves has at each level, from its leaves up."""
    return [-(-leaves // FANOUT**k) for k in range(height + 1)]


def node_hash(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """A subtree over ``leaves``, 32 bytes a node, in van Emde Boas order; absent nodes are zeros, cut off at the end."""
    where = layout(height + 1)
    nodes = np.zeros((int(where[-1][-1]) + 1, 32), np.uint8)
    level = [d.hex() for d in leaves]
    for k, count in enumerate(counts_of(len(leaves), height)):
        if k:
            level = [node_hash(*level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        nodes[where[height - k][:count]] = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, 32)
    last = max(int(where[height - k][:count].max()) for k, count in enumerate(counts_of(len(leaves), height)))
    return nodes[: last + 1].tobytes()


def read_level(nodes: bytes, leaves: int, height: int, level: int) -> list[str]:
    """The digests of a level of a stored subtree, level 0 being its leaves."""
    at = layout(height + 1)[height - level][: counts_of(leaves, height)[level]]
    return [row.tobytes().hex() for row in np.frombuffer(nodes, np.uint8).reshape(-1, 32)[at]]


def siblings(nodes: bytes, leaves: int, height: int) -> Iterator[tuple[list[str], list[str]]]:
    """For each leaf of a stored subtree, what stands left and right of its path at each level, concatenated."""
    sides = []
    for level in range(height):
        row = read_level(nodes, leaves, height, level)
        first = [i - i % FANOUT for i in range(len(row))]
        sides.append([("".join(row[f:i]), "".join(row[i + 1 : f + FANOUT])) for i, f in enumerate(first)])
    for leaf in range(leaves):
        path = [side[leaf // FANOUT**k] for k, side in enumerate(sides)]
        yield [x for x, _ in path], [x for _, x in path]


def coded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest_of(**changed: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[coded(changed.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256))


def placed(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with pos, the place of each in its ``key`` by the columns ``by``, and n, the rows of the key."""
    order = ["key", *by]
    rows = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).select(
        "key", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("key")).alias("n"),
    )
    return rows.join(starts, ["key", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def blocks_of(nodes: DataFrame, payload: list[str], height: int) -> DataFrame:
    """key, block, n, leaves, height, nodes, root and the payload arrays of each subtree over ``nodes`` (key, pos, n, digest)."""
    size = FANOUT**height
    grouped = nodes.groupBy("key", F.floor(F.col("pos") / size).alias("block"), "n").agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), "digest", *payload))).alias("_row")  # as many as a block has leaves
    )
    shape = grouped.select("key", "block", "n", F.col("_row.digest").alias("_digests"), *[F.col(f"_row.{c}").alias(c) for c in payload])
    kinds = {f.name: f.dataType.simpleString() for f in shape.schema}
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            digests = row.column(3)[0].as_py()
            levels = min(height, height_of(row.column(2)[0].as_py()))
            nodes = build_block(digests, levels)
            made = [pa.array([len(digests)], pa.int32()), pa.array([levels], pa.int32()), pa.array([nodes], pa.binary()), pa.array([nodes[:32]], pa.binary())]
            yield pa.RecordBatch.from_arrays([*row.columns[:3], *made, *row.columns[4:]], ["key", "block", "n", "leaves", "height", "nodes", "root", *payload])

    schema = "key string, block long, n long, leaves int, height int, nodes binary, root binary" + (kept and f", {kept}")
    return cut_lineage(shape.mapInArrow(run, schema))


def layers_of(nodes: DataFrame, payload: list[str], height: int) -> list[DataFrame]:
    """The layers of blocks of the trees over ``nodes``, the lowest first; each layer is a table in the shared folder."""
    size = FANOUT**height
    layers = [blocks_of(nodes, payload, height)]
    while (layers[-1].agg(F.max("n")).first()[0] or 0) > size:
        above = layers[-1].where(F.col("n") > size).select(
            "key", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("root").alias("digest")
        )
        layers.append(blocks_of(above, [], height))
    return layers


def _down(layer: DataFrame, above: DataFrame) -> DataFrame:
    """The blocks of a layer, each with the path from its root to the root of the dataset."""
    return layer.join(above, ["key", "block"])


def paths(blocks: DataFrame) -> DataFrame:
    """key, block (of the layer below), digest and path of each leaf of the blocks; ``size`` leaves a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            key, first, leaves, height, nodes, lefts, rights = (c[0].as_py() for c in row.columns[:7])
            found = list(siblings(nodes, leaves, height))
            digests = [bytes.fromhex(d) for d in read_level(nodes, leaves, height, 0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([key] * leaves), pa.array(np.arange(first, first + leaves)), pa.array(digests, pa.binary()),
                pa.array([x + lefts for x, _ in found], pa.list_(pa.string())), pa.array([x + rights for _, x in found], pa.list_(pa.string())),
                *(pa.array([row.column(k)[0].as_py()] * leaves, pa.string()) for k in (7, 8)),
            ], ["key", "block", "digest", "lefts", "rights", "subroot", "dataset"])

    schema = f"key string, block long, digest binary, {_PATH}, subroot string, dataset string"
    return blocks.mapInArrow(run, schema)


def _walk(layer: DataFrame, above: DataFrame, size: int) -> DataFrame:
    columns = ["key", (F.col("block") * size).alias("first"), "leaves", "height", "nodes", "lefts", "rights", "subroot", "dataset"]
    return paths(_down(layer, above).select(*columns))


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = BLOCK_HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``tampered`` is the digest that a row shows now, null where it shows its own; the
    root is folded from it and the siblings of the stored tree.
    """
    size = FANOUT**height
    seen = F.lit(None).cast("binary") if tampered is None else tampered
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null first, then by bytes
    leaves = cut_lineage(docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), digest_of().alias("digest"), seen.alias("seen")))
    low = layers_of(placed(leaves, ["doc_id", "digest", "seen"]), ["doc_id", "seen"], height)

    tops = [layer.where(F.col("n") <= size) for layer in low]
    subroots = tops[0].select("key", "root")
    for layer in tops[1:]:
        subroots = subroots.union(layer.select("key", "root"))
    named = cut_lineage(placed(subroots.select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("root").alias("digest")), ["of"]))
    high = layers_of(named, [], height)

    none = F.expr("cast(array() as array<string>)")
    at_root = high[-1].select("key", "block", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("dataset"))
    for layer in reversed(high):
        at_root = _walk(layer, at_root, size).drop("digest") if layer is not high[0] else _walk(layer, at_root, size)
    of_source = at_root.withColumnRenamed("block", "pos").drop("key", "subroot").join(named.select("pos", F.col("of").alias("key")), "pos")
    of_source = cut_lineage(of_source.select("key", F.lit(0).cast("long").alias("block"), "lefts", "rights", F.lower(F.hex("digest")).alias("subroot"), "dataset"))

    above = None
    for layer, top in zip(reversed(low), reversed(tops)):
        entry = of_source.join(top.select("key", "block"), ["key", "block"], "left_semi")
        above = entry if above is None else entry.unionByName(above)
        if layer is not low[0]:
            above = cut_lineage(_walk(layer, above, size).drop("digest"))
    columns = ["doc_id", "seen", "leaves", "height", "nodes", "lefts", "rights", "subroot", "dataset"]
    return prove(_down(low[0], above).select(*columns))


def fold(digest: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        digest = node_hash(left, digest, right)
    return digest


def prove(blocks: DataFrame) -> DataFrame:
    """The proof of every leaf of the lowest blocks and the root that it folds to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            ids, seen, leaves, height, nodes, lefts, rights, subroot, dataset = (c[0].as_py() for c in row.columns)
            digests = read_level(nodes, leaves, height, 0)
            proofs, folded = [], []
            for digest, now, (left, right) in zip(digests, seen, siblings(nodes, leaves, height)):
                left, right = left + lefts, right + rights
                proofs.append(node_hash(*[x for pair in zip(left, right) for x in pair]))
                folded.append(fold(now.hex() if now is not None else digest, left, right))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(digests), pa.array([subroot] * leaves), pa.array([dataset] * leaves),
                pa.array(proofs), pa.array(folded), pa.array([f == dataset for f in folded]),
            ], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return blocks.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def without_breaks() -> Column:
    """The digest of a row that has lost the line breaks of its text, for ids whose crc32 is even."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, digest_of(text=F.translate("text", "\n", "")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), without_breaks())


SQL = r"""
WITH RECURSIVE coded AS (
  SELECT doc_id, source, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS UBIGINT))),
      lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda k: CAST(k AS UBIGINT))),
        lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0
      THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS seen
  FROM coded),
docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, seen) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
low(source, lvl, pos, digest, n) AS (
  SELECT source, 0, pos, leaf, n FROM docs
  UNION ALL SELECT source, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY source, lvl, pos // 3),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, pos, digest, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY lvl, pos // 3),
low_sides AS (
  SELECT a.source, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM low a JOIN low b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
high_sides AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
steps AS (
  SELECT d.source, d.pos, s.lvl, s.l, s.r FROM docs d JOIN low_sides s ON s.source IS NOT DISTINCT FROM d.source AND s.pos = d.pos // CAST(3 ** s.lvl AS BIGINT)
  UNION ALL
  SELECT d.source, d.pos, 1000 + s.lvl, s.l, s.r FROM docs d JOIN subroots x ON x.source IS NOT DISTINCT FROM d.source
    JOIN high_sides s ON s.pos = x.pos // CAST(3 ** s.lvl AS BIGINT)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, pos ORDER BY lvl) AS step FROM steps),
proofs AS (SELECT source, pos, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, count(*) AS n_steps FROM numbered GROUP BY source, pos),
folds(source, pos, step, digest) AS (
  SELECT source, pos, 0, coalesce(seen, leaf) FROM docs
  UNION ALL SELECT f.source, f.pos, f.step + 1, sha256(s.l || f.digest || s.r) FROM folds f
    JOIN numbered s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.step = f.step + 1)
SELECT d.doc_id, d.leaf, x.subroot, (SELECT digest FROM high WHERE n = 1) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = (SELECT digest FROM high WHERE n = 1) AS verified
FROM docs d JOIN subroots x ON x.source IS NOT DISTINCT FROM d.source
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM d.source AND p.pos = d.pos
JOIN folds f ON f.source IS NOT DISTINCT FROM d.source AND f.pos = d.pos AND f.step = coalesce(p.n_steps, 0)"""

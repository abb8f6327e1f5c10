"""Near duplicates by a parity-sketch join on word n-grams.

A document is its set of distinct n-grams of lower-case words. Two sets link if
their Jaccard similarity reaches a bound, which bounds their symmetric difference
by d = n (1 - t) / t for a set of n.

* Sketch: each n-gram hash is XORed into one of R lanes. A lane differs only if an
  n-gram of the symmetric difference fell into it, so the number of lanes that
  differ is a lower bound of that difference.
* Size bands: sets of 2^k to 2^(k+1)-1 n-grams form a band with its own R; sets that
  may have a partner in the next band enter that one too.
* Pigeonhole: of two linked sets, all lanes but d agree. If both sort their lanes in
  one order and send the first d + 1, they send at least one in common. The lanes that
  a set has before the first one in common all differ, and so many n-grams at least;
  so each lane goes with its place, which bounds the size of a partner that is first
  met there, and sets without a possible partner leave the group. The order
  puts lanes with the most n-grams first that are not known to be frequent: those
  are least likely to agree by chance. Lanes of value 0 are left out; a set that
  has no more than d others sends a key for that case too.
* Verification: of documents that share a lane, those whose sizes or whose parity
  sketches of 1,024 bits (and 16,384 for sets of more than 512) are too far apart go,
  and the others are compared exactly, n-gram by n-gram.

No group of documents is written out as all its pairs. In each of ``HUB_ROUNDS``
rounds every group that spans components has a hub, the first of its sets in an order
of all sets that changes from round to round; of the hubs that its size and sketch
allow, each set is compared with the first. So a round compares at most one pair for
each set, and a family of near copies meets at few hubs. Of sets that are still in
different components after that, those pairs become rows whose sizes and parity
sketches allow a link. A group is cut into blocks of about ``BLOCK`` sets for that, two
of which meet in a task as arrays, so no group is in one task. This is done twice: first
each set keeps its first ``PARTNERS`` possible partners of a block, which unites what is
closely linked; then, among what is still apart, all of them. The time on a group of
sets that lie close to a link without one still grows with its square, its rows do not.
So every link between two documents is found or follows from others: components are
exact.

Frequent n-grams and lanes are taken from a sample of about ``SAMPLE_DOCS`` rows;
they only set the order and spare hot lanes the grouping, and change no result.

Rows are numbered when they are first read and written to the shared folder with
compressed texts; all else works on the numbers. So ids may be any numbers, absent or
shared: rows without an id and rows that share one are documents of their own, linked
by their sets only, and a component's id is the smallest of its rows that have one.
Null texts and texts without words are empty sets, alone in their component. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import gram_hashes, mix, signed, slices, squeeze, table, unsqueeze, word_hashes
from faultline.llm.components import components
from faultline.session import cut_lineage, remove_stages

SHINGLE = 5
PERCENT = 75
SAMPLE_DOCS = 4096
#: Rows of the sample with an n-gram (a lane) that make it frequent (hot).
FREQUENT, HOT = 8, 40
HUB_ROUNDS = 1
#: Sets of a group that meet at a time, and how many partners of a block each keeps in the first round of that.
BLOCK, PARTNERS = 1024, 3
#: Bits of the parity sketches, as powers of two; the wide ones are made for sets of more than LARGE n-grams.
SKETCH_BITS, WIDE_BITS, LARGE = 10, 14, 512
_SEEN = 200_000
_SPREAD = 1 << 20
_NONE = np.zeros(0, np.uint64)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams of a text; of all its words as one if there are fewer."""
    words = word_hashes(text.lower()) if text else _NONE
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else _NONE


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    parts = (mix(hashes ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    return tuple(int(x.astype(np.int64)) for x in parts)


def bit_sketch(hashes: np.ndarray, bits: int) -> list[int]:
    """Parity of the n-grams that fall on each of 2**bits bits, 64 bits a number."""
    odd = (np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def lane_keys(hashes: np.ndarray, percent: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the lanes that a set sends, 63 bits each, band and lane number mixed in, and their places.

    The place is how many lanes of the set come before: k if those are so many n-grams
    that a partner first met here lacks, -1 - k if they are so many that differ.
    """
    n = len(hashes)
    most = n * (100 - percent) // percent  # symmetric difference with any partner
    if not most:
        return _NONE, np.zeros(0, np.int32)
    band = n.bit_length() - 1
    common = np.zeros(n, bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        common = frequent[at] == hashes
    keys, places = [], []
    for k in [band, band + 1] if 100 * n >= percent << (band + 1) else [band]:
        high = (2 << k) - 1
        plain = high <= 256  # as many lanes as there are hashes
        if plain:
            lane, value, weight = hashes, hashes, (~common).astype(np.int64)
        else:
            lane = hashes % np.uint64(high / 1.8)
            order = np.argsort(lane)
            lane = lane[order]
            starts = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]]))
            lane = lane[starts]
            value = np.bitwise_xor.reduceat(hashes[order], starts)
            weight = np.add.reduceat((~common[order]).astype(np.int64), starts)
        key = mix(mix(value) + lane * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) >> np.uint64(1)
        if not value.all():
            key, weight = key[value != 0], weight[value != 0]
        rank = (7 - np.minimum(weight, 7)).astype(np.uint64) << np.uint64(60) | key >> np.uint64(3)
        first = np.argpartition(rank, most)[: most + 1] if len(key) > most else np.arange(len(key))
        first = first[np.lexsort((key[first], rank[first]))]
        place = np.arange(len(first), dtype=np.int32)
        keys.append(key[first])
        places.append(place if plain else -1 - place)
        if len(key) <= most:  # the case of lanes that agree on 0 only
            keys.append(np.array([k], np.uint64))
            places.append(np.zeros(1, np.int32))
    return np.concatenate(keys), np.concatenate(places)


class _Seen:
    """Sets met before in this task; later copies need not be sent, whichever copy that is."""

    def __init__(self):
        self.sets: set[tuple[int, int]] = set()

    def __call__(self, hashes: np.ndarray) -> bool:
        key = digest(hashes)
        if key in self.sets:
            return True
        if len(self.sets) < _SEEN:
            self.sets.add(key)
        return False


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names.split())


def measure(rows: DataFrame) -> DataFrame:
    """id, n, d1, d2, sketch, wide of each row: the size, the digest and the parity sketches of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(unsqueeze(t)) for t in part.column(1).to_pylist()]
            both = [digest(s) for s in sets]
            sketches = pa.array([bit_sketch(s, SKETCH_BITS) for s in sets], pa.list_(pa.int64()))
            wide = pa.array([bit_sketch(s, WIDE_BITS) if len(s) > LARGE else [] for s in sets], pa.list_(pa.int64()))
            columns = [len(s) for s in sets], [d[0] for d in both], [d[1] for d in both]
            yield _batch("id n d1 d2 sketch wide", part.column(0), *columns, sketches, wide)

    return rows.mapInArrow(run, "id long, n long, d1 long, d2 long, sketch array<long>, wide array<long>")


def _frequent(sample: DataFrame) -> np.ndarray:
    """N-grams of many rows of the sample, sorted; no more than the sample has n-grams by FREQUENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(unsqueeze(t)) for t in part.column(1).to_pylist()]
            yield _batch("h", signed(np.concatenate([_NONE, *sets])))

    counts = sample.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= FREQUENT).select("h")
    return np.sort(counts.toArrow()["h"].to_numpy().astype(np.int64).view(np.uint64))


def lanes(rows: DataFrame, percent: int, frequent: np.ndarray, hot: np.ndarray) -> DataFrame:
    """key, id, place of every lane that is sent. The j-th hot key is sent as a negative number that stands for j and spreads its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for part in slices(batches):
            found: list[list] = [[], [], []]
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                s = shingles(unsqueeze(t))
                if len(s) * (100 - percent) < percent or seen(s):
                    continue
                key, place = lane_keys(s, percent, frequent)
                key = key.view(np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    spread = int(mix(np.array([i]).view(np.uint64))[0] % np.uint64(_SPREAD))
                    key = np.where(hot[at] == key, -(1 + at + len(hot) * spread), key)
                for column, x in zip(found, (key, np.full(len(key), i, np.int64), place)):
                    column.append(x)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["key", "id", "place"])

    return rows.mapInArrow(run, "key long, id long, place int")


def partner_sizes(percent: int) -> tuple[Column, Column]:
    """The least and the largest size of a partner that a set of ``n`` may meet first in a lane at ``place``."""
    n, place = F.col("n"), F.col("place")
    least = F.when(place < 0, F.ceil(-(place + 1) * (100 + percent) / F.lit(100 - percent)) - n).otherwise(0)
    most = F.when(place >= 0, F.floor((n - place) * (100 + percent) / F.lit(percent)) - n).otherwise(F.floor(n * 100 / F.lit(percent)))
    return F.greatest(least, F.ceil(n * percent / F.lit(100))).cast("int").alias("low"), most.cast("int").alias("high")


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts, given compressed, are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, _NONE
        for part in slices(batches):
            a, b, ta, tb = (c.to_pylist() for c in part.columns)
            keep = []
            for k in range(part.num_rows):
                if a[k] != last:
                    last, left = a[k], shingles(unsqueeze(ta[k]))
                keep.append(alike(left, shingles(unsqueeze(tb[k])), percent))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    both = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


SKETCHED = ["n", "sketch"]


def may_link(percent: int) -> Column:
    """Whether sizes and parity sketches (n, sketch of sides a and b) leave a link possible."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    words = (F.bit_count(F.get("sketch_a", F.lit(k)).bitwiseXOR(F.get("sketch_b", F.lit(k)))) for k in range(1 << SKETCH_BITS - 6))
    return sizes & (sum(words, F.lit(0)) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def sided(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the given columns of both sets."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) that ``may_link``, those that the wide sketches of large sets leave possible; ``pairs`` are spent."""
    both = sided(pairs, sets.where(F.col("n") > LARGE), ["n", "wide"])
    differ = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    far = both.where(differ * (100 + percent) > (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b")
    return cut_lineage(pairs.join(far, ["a", "b"], "left_anti"), spent=[pairs])


def possible_pairs(sets: list[np.ndarray], one: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``one`` and ``two`` (places of sets) of the pairs across components that sizes and sketches allow.

    ``sets``: c, n, low, high, and sketch, a row of words for each set.
    """
    c, n, low, high, sketch = sets
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(one), 128):
        left = one[start : start + 128]
        n_a, n_b = n[left][:, None], n[two][None, :]
        fit = (c[left][:, None] != c[two][None, :]) & (n_b >= low[left][:, None]) & (n_b <= high[left][:, None])
        a, b = np.nonzero(fit & (n_a >= low[two][None, :]) & (n_a <= high[two][None, :]))
        apart = np.bitwise_count(sketch[left[a]] ^ sketch[two[b]]).sum(1, dtype=np.int64)
        close = apart * (100 + percent) <= (n[left[a]] + n[two[b]]) * (100 - percent)
        out_a.append(left[a[close]])
        out_b.append(two[b[close]])
    return np.concatenate(out_a), np.concatenate(out_b)


def pairs_across(left: DataFrame, percent: int, partners: int | None = None) -> DataFrame:
    """(a, b) of the sets of a group that are in two components and may link, for each set its first ``partners`` of a block only if given.

    ``left``: sig, id, c, n, low, high, sketch.
    """
    sizes = cut_lineage(left.groupBy("sig").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    met = left.join(sizes, "sig").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.select(
        F.xxhash64("sig", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "block", "id", "c", "n", "low", "high", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids, block = rows.column("id").to_numpy(), rows.column("block").to_numpy()
            numbers = [rows.column(c).to_numpy().astype(np.int64) for c in ("c", "n", "low", "high")]
            words = rows.column("sketch").flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            first, second = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            a, b = possible_pairs([*numbers, words], first, second, percent)
            a, b = ids[a], ids[b]
            if partners and len(a):  # first in one order of all sets, so that many sets keep the same ones
                by = np.lexsort((mix(b.view(np.uint64)), a))
                a, b = a[by], b[by]
                starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                kept = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a)))) < partners
                a, b = a[kept], b[kept]
            return _batch("a b", pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)))

        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)] if len(cell) else [0]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if cell[low] != last and held:
                    yield close()
                    held.clear()
                last = cell[low]
                held.append(batch.slice(low, high - low))
        if held:
            yield close()

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def stage(docs: DataFrame, text: str = "text") -> DataFrame:
    """id, row, text of every row: its number, its other columns, its text compressed; a table in the shared folder."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(*(others or [F.lit(0).alias("none")])).alias("row")
    return cut_lineage(squeeze(docs.select(F.monotonically_increasing_id().alias("id"), row, F.col(text).cast("binary").alias("text"))))


def link(staged: DataFrame, percent: int = PERCENT) -> DataFrame:
    """id, n, component of every row of ``stage``: its set's size and the smallest number reachable by links."""
    spark = staged.sparkSession
    rows = staged.select("id", "text")
    total = max(1, staged.count())
    sets = cut_lineage(measure(rows))
    firsts = cut_lineage(sets.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("set_id")))
    members = sets.where("n > 0").join(firsts, ["d1", "d2"]).select("id", "n", "set_id")
    members = cut_lineage(members.union(sets.where("n = 0").select("id", "n", "id")), spent=[firsts])

    share = min(1.0, SAMPLE_DOCS / total)
    sample = rows.where(F.xxhash64("id").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)))
    frequent = _frequent(sample)
    many = lanes(sample, percent, frequent, np.zeros(0, np.int64)).groupBy("key").agg(F.count("*").alias("n"))
    hot = np.array(sorted(r["key"] for r in many.where(F.col("n") >= HOT).collect()), np.int64)  # bounded by the sample

    group = Window.partitionBy("key")
    met = lanes(rows, percent, frequent, hot).withColumns({
        "n_rows": F.count("*").over(group), "least": F.min("id").over(group), "sum": F.sum(F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))).over(group),
    })
    same = F.xxhash64("sum", "n_rows", "least")  # many lanes have the same members
    if len(hot):  # hot keys are spread, so this row alone may be all that is seen of one
        same = F.when(F.col("key") < 0, F.pmod(-(F.col("key") + 1), F.lit(len(hot)))).otherwise(same)
    groups = met.where("n_rows > 1 or key < 0").select(same.alias("sig"), "id", "place", (F.col("place") < 0).alias("differ"))
    groups = cut_lineage(groups.groupBy("sig", "id", "differ").agg(F.min("place").alias("first"), F.max("place").alias("last")))
    sized = groups.join(members.select("id", "set_id", F.col("n").cast("int").alias("n")), "id")
    # The earliest place admits most: the smallest one of those that lack, the largest of those that differ.
    sized = sized.withColumn("place", F.when(F.col("differ"), F.col("last")).otherwise(F.col("first")))
    sized = sized.select("sig", "set_id", "n", *partner_sizes(percent))
    groups = cut_lineage(sized.groupBy("sig", "set_id").agg(F.min("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")), spent=[groups])

    able = (F.col("high") >= F.col("smallest")) & (F.col("low") <= F.col("largest")) & (F.col("n") <= F.col("highest")) & (F.col("n") >= F.col("lowest"))
    texts = cut_lineage(rows.join(groups.select(F.col("set_id").alias("id")).distinct(), "id", "left_semi"))

    def edges(pairs: DataFrame) -> DataFrame:
        possible = near(pairs, sets, percent)
        return cut_lineage(verify(possible, texts, percent), spent=[possible])

    def apart(parts: DataFrame | None, turn: int) -> DataFrame:
        """sig, set_id, low, high, c, hub: the sets of groups that are in more than one component."""
        inside = groups.withColumn("c", F.col("set_id"))
        if parts is not None:
            inside = groups.join(parts, F.col("set_id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "set_id")).drop("node", "component")
        inside = cut_lineage(inside)
        order = F.struct(F.xxhash64(F.lit(turn), "set_id"), "set_id", "c")
        known = [F.min("c").alias("x"), F.max("c").alias("y"), F.min(order).alias("hub"), *(f(c).alias(a) for f, c, a in (
            (F.min, "n", "smallest"), (F.max, "n", "largest"), (F.min, "low", "lowest"), (F.max, "high", "highest")))]
        open_ = cut_lineage(inside.groupBy("sig").agg(*known).where("x < y"))
        return cut_lineage(inside.join(open_, "sig").where(able).select("sig", "set_id", "low", "high", "c", "hub"), spent=[inside, open_])

    links, part_of = None, None
    for turn in range(HUB_ROUNDS):
        left = apart(part_of, turn)
        to_hub = cut_lineage(left.where("c <> hub.c").select(F.col("hub.set_id").alias("a"), F.col("set_id").alias("b")).distinct(), spent=[left])
        allowed = sided(to_hub, sets, SKETCHED).where(may_link(percent)).groupBy("b").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "a"), "a")).alias("first"))
        found = edges(cut_lineage(allowed.select("first.a", "b"), spent=[to_hub]))
        links = found if links is None else cut_lineage(links.union(found), spent=[links, found])
        part_of = components(links)

    for turn, partners in enumerate((PARTNERS, None), HUB_ROUNDS):
        left = apart(part_of, turn)
        left = cut_lineage(left.select("sig", "c", F.col("set_id").alias("id"), "low", "high").join(sets.select("id", *SKETCHED), "id"), spent=[left])
        found = edges(cut_lineage(pairs_across(left, percent, partners), spent=[left]))
        if not found.isEmpty():
            links = cut_lineage(links.union(found), spent=[links, found])
            part_of = components(links)
    remove_stages(sets, groups, texts)
    return members.join(part_of, F.col("set_id") == F.col("node"), "left").select(
        "id", "n", F.coalesce("component", "set_id").alias("component")
    )


def linked(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is null if no row of the component has an id."""
    staged = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    found = link(staged, percent)
    named = cut_lineage(found.join(staged.select("id", F.col("row.doc_id").alias("doc_id")), "id"), spent=[staged])
    least = cut_lineage(named.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return named.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest id and then text hash, with all its columns.

    Rows that share an id are linked by their sets or not at all. Rows without a text
    and those without words have nothing to be alike: of the latter each id stays, and
    of equal rows without words one.
    """
    staged = stage(docs)
    found = link(staged, percent)
    place = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("text"), "id")
    named = staged.where("text is not null").join(found, "id").select(
        "id", place.alias("place"), F.when(F.col("n") > 0, F.col("component")).alias("component"), "row.doc_id", F.md5("text").alias("digest"))
    wordless = named.where("component is null").groupBy("doc_id", "digest").agg(F.min("id").alias("id")).select("id")
    kept = named.where("component is not null").groupBy("component").agg(F.min_by("id", "place").alias("id")).select("id")
    chosen = staged.join(cut_lineage(kept.union(wordless)), "id", "left_semi").union(staged.where("text is null"))
    kinds = docs.schema["text"].dataType
    at = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]

    def open_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [unsqueeze(t) for t in part.column(0).to_pylist()]
            plain = pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([plain, part.column(1)], ["text", "row"])

    opened = T.StructType([T.StructField("text", T.StringType()), staged.schema["row"]])
    restored = chosen.select("text", "row").mapInArrow(open_texts, opened)
    return restored.select(*[c.cast(kinds).alias("text") if n == "text" else c for n, c in zip(docs.columns, at)])


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM words),
members AS (SELECT doc_id, unnest(s) AS g FROM sets),
both_sides AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM members x JOIN members y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_sides JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b
  WHERE 100 * n >= 75 * (len(sa.s) + len(sb.s) - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = s.doc_id"""

"""Repeated windows of a corpus: what word and byte deduplication have in common.

A window is a fixed number of consecutive units (words or bytes) of one text. Each
is filed under its minimiser: of the hashes of its g-unit grams the smallest, the
leftmost on ties, grams that a sample shows to be frequent coming last. Equal
windows have equal minimisers. Consecutive windows that share the occurrence of
their minimiser form a span.

1. Spans send only their minimiser; a minimiser that occurs once has no repeats.
2. The texts of the other spans travel to the bucket of their minimiser, each as one
   packed string; a string that a task has sent before for an earlier place is known
   to repeat and is not sent again.
3. A bucket finds, of all windows in it, those that are equal to an earlier one.
   Windows of a minimiser with more than ``GROUP_BYTES`` of strings are sorted and
   counted one by one by Spark instead.
4. Runs of repeated windows come back to their texts, which are cut.

Texts of equal content are settled beforehand by their digest: all but the first
are covered by windows that start earlier. Rows are ordered by id (those without
one last, by a hash of their text), rows that share an id by a hash of their text;
rows equal in both are one document. The sample sets the order of grams only and
changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import gram_hashes, mix, own_id, prefix_hash, row_place, signed, slices, sliding_min, span_hash, squeeze, unsqueeze, window_hashes, word_spans
from faultline.session import cut_lineage, remove_stages

FREQUENT = 16
GROUP_BYTES = 600_000
_SEEN = 100_000
_MARK_BITS = 18

Place = tuple[int, int, int]


@dataclass(frozen=True)
class Words:
    """Windows of words; a text counts as its words with one space between."""

    window: int = 20
    gram: int = 6
    sample: int = 4096  # about as many rows tell which grams are frequent

    def content(self, text: bytes | None) -> bytes:
        return b" ".join(text.split()) if text else b""

    def size(self, content: bytes) -> int:
        return content.count(b" ") + 1 if content else 0

    def grams(self, content: bytes) -> np.ndarray:
        data = np.frombuffer(content, np.uint8)
        if not len(data):
            return np.zeros(0, np.uint64)
        starts, ends = word_spans(data)
        return gram_hashes(span_hash(prefix_hash(data), starts, ends), self.gram)

    def cuts(self, content: bytes) -> np.ndarray:
        """Where unit i starts; one more entry than units."""
        data = np.frombuffer(content, np.uint8)
        return np.concatenate([[0], np.flatnonzero(data == 32) + 1, [len(data) + 1]])

    def piece(self, content: bytes, cuts: np.ndarray, first: int, units: int) -> bytes:
        return content[cuts[first] : cuts[first + units] - 1]

    def without(self, content: bytes, gone: np.ndarray) -> bytes:
        return b" ".join([w for w, g in zip(content.split(b" "), gone) if not g])


@dataclass(frozen=True)
class Bytes:
    """Windows of UTF-8 bytes."""

    window: int = 100
    gram: int = 28
    sample: int = 1024

    def content(self, text: bytes | None) -> bytes:
        return text or b""

    def size(self, content: bytes) -> int:
        return len(content)

    def grams(self, content: bytes) -> np.ndarray:
        return window_hashes(np.frombuffer(content, np.uint8), self.gram)

    def cuts(self, content: bytes) -> None:
        return None

    def piece(self, content: bytes, cuts: None, first: int, units: int) -> bytes:
        return content[first : first + units]

    def without(self, content: bytes, gone: np.ndarray) -> bytes:
        return np.frombuffer(content, np.uint8)[~gone].tobytes()


Unit = Words | Bytes


def marks(frequent: np.ndarray) -> np.ndarray:
    """For the low bits of a gram: whether a frequent gram may have them."""
    out = np.zeros(1 << _MARK_BITS, bool)
    out[frequent & np.uint64(len(out) - 1)] = True
    return out


def spans(unit: Unit, content: bytes, frequent: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window and number of windows of each span, and the place of its minimiser in the order of grams; ``marked``: see ``marks``."""
    grams = unit.grams(content)
    width = unit.window - unit.gram + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    order = grams >> np.uint64(1)
    if len(frequent):
        maybe = np.flatnonzero(marked[grams & np.uint64(len(marked) - 1)])
        at = np.minimum(np.searchsorted(frequent, grams[maybe]), len(frequent) - 1)
        order[maybe[frequent[at] == grams[maybe]]] |= np.uint64(1 << 63)
    least = sliding_min(order, width)
    # the minimiser is another one where a smaller gram comes in or the leftmost smallest one goes out
    starts = (least[1:] < least[:-1]) | (order[: len(least) - 1] == least[:-1])
    first = np.flatnonzero(np.concatenate([[True], starts]))
    return first, np.diff(np.append(first, len(least))), least[first]


class FirstSeen:
    """The earliest place at which a task met each of a bounded number of keys."""

    def __init__(self, limit: int = _SEEN):
        self.places: dict[bytes, tuple] = {}
        self.limit = limit

    def later(self, key: bytes, place: tuple) -> bool:
        """Whether the key was met at an earlier place."""
        known = self.places.get(key)
        if known is not None and known < place:
            return True
        if known is not None or len(self.places) < self.limit:
            self.places[key] = place
        return False


def runs_of(ids: np.ndarray, ties: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Consecutive windows of one document as (id, tie, first, number)."""
    order = np.lexsort((starts, ties, ids))
    ids, ties, starts = ids[order], ties[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]) | (starts[1:] > starts[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(ids)) - 1
    return ids[at], ties[at], starts[at], starts[last] - starts[at] + 1 if len(at) else at


def _run(rows: DataFrame, schema: str, make: Callable) -> DataFrame:
    """``make(parts)`` over the Arrow slices of each task; it yields lists of columns."""
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, kinds = zip(*(f.split() for f in schema.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in make(slices(batches)):
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(columns, kinds)], list(names))

    return rows.mapInArrow(run, schema)


def find_repeats(rows: DataFrame, unit: Unit, settle: Callable, total: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(texts that may hold repeats: id, tie, compressed text), (runs: id, tie, first, n) of windows that occur earlier, and the stages behind both.

    ``settle(members)`` takes spans (id, tie, first window, string) of whole
    minimisers, no two strings equal, those of one minimiser in order of place, and
    gives the ids, ties and starts of the windows equal to an earlier one.
    """
    share = min(1.0, unit.sample / max(1, total))
    sample = rows.where(F.xxhash64("id", "tie").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)))

    def list_grams(parts):
        for part in parts:
            yield [signed(np.concatenate([np.zeros(0, np.uint64), *(np.unique(unit.grams(unit.content(t))) for t in part.column(2).to_pylist())]))]

    counts = _run(sample, "gram long", list_grams).groupBy("gram").count().where(F.col("count") >= FREQUENT).select("gram")
    frequent = np.sort(counts.toArrow()["gram"].to_numpy().astype(np.int64).view(np.uint64))  # bounded by the sample
    marked = marks(frequent)

    def minimisers(parts):
        seen = FirstSeen()
        for part in parts:
            out: list[list] = [[np.zeros(0, np.int64)] for _ in range(4)]
            for i, tie, t in zip(*(c.to_pylist() for c in part.columns)):
                content = unit.content(t)
                if seen.later(hashlib.sha256(content).digest(), (i, tie)):
                    continue
                first, _, keys = spans(unit, content, frequent, marked)
                for column, x in zip(out, (signed(keys), np.full(len(first), i), np.full(len(first), tie), first)):
                    column.append(x)
            key, *place = (np.concatenate(x) for x in out)
            # of what repeats among these texts, one row tells the others; the rest need no
            # meeting and go anywhere, their first window stored as a negative number
            _, one, of, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            sure = counts[of] > 1
            away = signed(mix(place[0].view(np.uint64) ^ mix(place[1].view(np.uint64))) + place[2].view(np.uint64))
            told = one[counts > 1]
            columns = [np.where(sure, away, key), *place[:2], np.where(sure, -1 - place[2], place[2])]
            more = [key[told], *(x[told] for x in place)]
            yield [np.concatenate(x) for x in zip(columns, more)]

    sent = _run(rows, "key long, id long, tie long, first long", minimisers)
    twice = sent.withColumn("n", F.expr("count(1) over (partition by key)")).where("n > 1 or first < 0")
    flagged = twice.groupBy("id", "tie").agg(F.collect_set(F.expr("cast(greatest(first, -1 - first) as int)")).alias("firsts"))  # spans of one text
    flagged = cut_lineage(flagged)
    texts = cut_lineage(squeeze(rows).join(flagged, ["id", "tie"]), spent=[flagged])

    def pack(parts):
        seen = FirstSeen()
        for part in parts:
            out: list[list] = [[], [], [], [], [], []]
            for i, tie, t, firsts in zip(*(c.to_pylist() for c in part.columns)):
                content, wanted = unit.content(unsqueeze(t)), set(firsts)
                cuts = unit.cuts(content)
                for first, n, key in zip(*(x.tolist() for x in spans(unit, content, frequent, marked))):
                    if first not in wanted:
                        continue
                    string = unit.piece(content, cuts, first, n + unit.window - 1)
                    known = seen.later(string, (i, tie, first))
                    to = tie ^ first if known else int(np.uint64(key).astype(np.int64))  # what is settled goes anywhere
                    for column, x in zip(out, (to, i, tie, first, n, None if known else string)):
                        column.append(x)
            yield out

    packed = _run(texts.select("id", "tie", "text", "firsts"), "key long, id long, tie long, first long, n long, string binary", pack)

    def buckets(parts):
        held: list[tuple] = []
        group: list[tuple] = []
        ready: list[list] = [[], [], [], [], []]
        held_size, size, last, loose = 0, 0, None, False

        def add(*row) -> None:
            for column, x in zip(ready, row):
                column.append(x)

        def close() -> None:
            """Strings that come again are settled as a whole; what is left is compared window by window."""
            nonlocal held_size
            if len(group) < 2:
                return
            group.sort(key=lambda m: m[:3])
            first: dict[bytes, Place] = {}
            for i, tie, at, string in group:
                if first.setdefault(string, (i, tie, at)) != (i, tie, at):
                    add(i, tie, at, unit.size(string) - unit.window + 1, None)
            if len(first) > 1:
                held.extend((*place, string) for string, place in first.items())
                held_size += sum(map(len, first))

        def spread() -> None:
            """The windows of a large group one by one, for Spark to sort."""
            for i, tie, at, string in group:
                cuts = unit.cuts(string)
                for k in range(unit.size(string) - unit.window + 1):
                    add(i, tie, at + k, 1, unit.piece(string, cuts, k, unit.window))
            group.clear()

        def take(least_ready: int, least_held: int):
            nonlocal held_size
            if held and held_size >= least_held:
                found = runs_of(*settle(held))
                held.clear()
                held_size = 0
                yield [*found, [None] * len(found[0])]
            if len(ready[0]) >= least_ready:
                yield ready
                for column in ready:
                    column.clear()

        for part in parts:
            for key, i, tie, first, n, string in zip(*(c.to_pylist() for c in part.columns)):
                if string is None:
                    add(i, tie, first, n, None)
                    continue
                if key != last:
                    close()
                    group.clear()
                    yield from take(4096, GROUP_BYTES)
                    size, last, loose = 0, key, False
                group.append((i, tie, first, string))
                size += len(string)
                if loose or size > GROUP_BYTES:
                    loose = True
                    spread()
                    yield from take(4096, GROUP_BYTES)
        close()
        yield from take(1, 1)

    dealt = packed.repartition("key").sortWithinPartitions("key")
    found = cut_lineage(_run(dealt, "id long, tie long, first long, n long, piece binary", buckets))
    single = found.where("piece is not null")
    place = F.struct("id", "tie", "first")
    earliest = cut_lineage(single.groupBy("piece").agg(F.min(place).alias("earliest")))
    late = single.join(earliest, "piece").where(place > F.col("earliest"))
    runs = found.where("piece is null").drop("piece").union(late.select("id", "tie", "first", "n"))
    return texts.select("id", "tie", "text"), runs, [texts, found, earliest]


def remove_repeats(docs: DataFrame, unit: Unit, settle: Callable, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_units, n_removed, n_spans (maximal removed runs) and kept_sha256 of every row."""
    rows = docs.select(
        *row_place(F.col(doc_id), F.col(text)), F.col(text).cast("binary").alias("text")
    )
    empty = hashlib.sha256(b"").hexdigest()

    def whole(parts):
        for part in parts:
            contents = [unit.content(t) for t in part.column(2).to_pylist()]
            yield [part.column(0), part.column(1), [unit.size(c) for c in contents], [hashlib.sha256(c).hexdigest() for c in contents]]

    base = cut_lineage(_run(rows, "id long, tie long, units long, sha string", whole))
    firsts = cut_lineage(base.where(F.col("units") >= unit.window).groupBy("sha").agg(F.min(F.struct("id", "tie")).alias("one")))
    texts, runs, stages = find_repeats(rows, unit, settle, base.count())

    def cut(parts):
        for part in parts:
            out: list[list] = [[], [], [], [], []]
            for i, tie, t, marks in zip(*(c.to_pylist() for c in part.columns)):
                content = unit.content(unsqueeze(t))
                edge = np.zeros(unit.size(content) + 1, np.int64)
                for m in marks:
                    edge[m["first"]] += 1
                    edge[m["first"] + m["n"] + unit.window - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                kept = unit.without(content, gone)
                n_spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                for column, x in zip(out, (i, tie, int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest())):
                    column.append(x)
            yield out

    marked = runs.groupBy("id", "tie").agg(F.collect_set(F.struct("first", "n")).alias("marks"))  # runs of one text
    parts = _run(texts.join(marked, ["id", "tie"]), "id long, tie long, removed long, spans long, kept string", cut)
    parts = cut_lineage(parts.dropDuplicates(["id", "tie"]))
    remove_stages(*stages)
    copy = (F.col("units") >= unit.window) & (F.struct("id", "tie") > F.col("one"))
    joined = base.join(firsts, "sha", "left").withColumn("copy", F.coalesce(copy, F.lit(False))).join(parts, ["id", "tie"], "left")
    pick = lambda whole, part, none: F.when(F.col("copy"), whole).otherwise(F.coalesce(part, none))
    return joined.select(
        own_id().alias("id"), "units", pick(F.col("units"), F.col("removed"), F.lit(0)).alias("n_removed"),
        pick(F.lit(1), F.col("spans"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.lit(empty), F.col("kept"), F.col("sha")).alias("kept_sha256"),
    )

"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case letters and digits with one space between runs.
An item of n characters may occur with up to floor(``error_rate`` * n) edits; cut
into one piece more than that, at least one piece occurs unchanged. All pieces are
looked up in one pass over every whole text, and each place where a piece falls is
verified with Myers' bit-parallel edit distance.

Items shorter than ``least`` characters match nothing, or with ``short`` where they
occur unchanged between word boundaries, at distance 0; a letter of a script without
spaces is a word. Null and empty items match nothing, as does a null or empty text. Repeated items are reported under each of their ids,
repeated rows each on their own. Items travel to the tasks in blocks of
``BLOCK_CHARS``; each block is one pass over the texts. Columns of the input other
than the id and the text pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import slices, table

ERROR_RATE = 0.06
LEAST_CHARS = 40
BLOCK_CHARS = 16_000_000
_OTHER = re.compile(r"[\W_]+")
#: Thai, Lao, Myanmar, Khmer, kana and Han: written without spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U0001b000-\U0001b16f\U00020000-\U0003ffff]")

Item = tuple[int, str]


def normal(text: str | None) -> str:
    return _OTHER.sub(" ", text.lower()).strip() if text else ""


def parted(text: str, at: int) -> bool:
    """Whether a word may start or end before position ``at`` of a normalised text."""
    if at <= 0 or at >= len(text):
        return True
    a, b = text[at - 1], text[at]
    return a == " " or b == " " or bool(_UNSPACED.match(a) or _UNSPACED.match(b))


def nearest_end(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """Myers: the smallest distance of ``pattern`` to any part of ``text`` and the first end of such a part."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    plus, minus, distance, best = full, 0, len(pattern), None
    for end, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        equal |= ((equal & plus) + plus ^ plus) & full
        up, down = (minus | ~(equal | plus)) & full, plus & equal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
        if distance <= budget and (best is None or distance < best[0]):
            best = distance, end
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[Item], error_rate: float, least: int, short: bool = False):
        self.items: dict[str, list[int]] = {}
        for item_id, text in items:
            if len(text) >= least or short and text:
                self.items.setdefault(text, []).append(item_id)
        self.short = {t for t in self.items if len(t) < least}
        self.budget = {t: 0 if t in self.short else int(error_rate * len(t)) for t in self.items}
        places: dict[str, list[tuple[str, int]]] = {}
        for text, k in self.budget.items():
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                places.setdefault(text[a:b], []).append((text, a))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) of the best occurrence of each item."""
        if not self.items or not text:
            return []
        starts: dict[str, list[int]] = {}
        whole: dict[str, int] = {}
        for end, (size, where) in self.pieces.iter(text):
            for item, offset in where:
                if item in self.short:
                    if item not in whole and parted(text, end + 1 - size) and parted(text, end + 1):
                        whole[item] = end + 1
                    continue
                starts.setdefault(item, []).append(end + 1 - size - offset)
        found = [(item_id, 0, end) for item, end in whole.items() for item_id in self.items[item]]
        for item, at in starts.items():
            k, best = self.budget[item], None
            at.sort()
            low = at[0]
            for here, after in zip(at, [*at[1:], None]):
                if after is not None and after - here <= 2 * k:
                    continue
                base = max(0, low - k)
                hit = nearest_end(item, text[base : here + len(item) + k], k)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit[0], base + hit[1]
                if best and not best[0]:
                    break
                low = after
            if best:
                found += [(item_id, *best) for item_id in self.items[item]]
        return found


def item_blocks(benchmark: DataFrame, item_id: str, text: str, chars: int) -> Iterator[list[Item]]:
    """The items in blocks of bounded size."""
    block: list[Item] = []
    size = 0
    for row in benchmark.where(F.col(text).isNotNull()).select(item_id, text).toLocalIterator():
        block.append((row[0], normal(row[1])))
        size += len(row[1])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def matches(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least: int = LEAST_CHARS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", chars: int = BLOCK_CHARS, short: bool = False,
) -> DataFrame:
    """One row (doc_id, item_id, distance, end) for each document and item that occurs in it."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", benchmark.schema[item_id].dataType),
        T.StructField("distance", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ])
    narrow = docs.select(F.col(doc_id).alias("doc_id"), text)
    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text, chars):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value, error_rate, least, short)
            for part in slices(batches):
                rows = [(d, *hit) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for hit in matcher.find(normal(t))]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=arrow)

        arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema])
        found = found.union(narrow.mapInArrow(search, schema))
    return found


def _arrow(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]


def clean(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least: int = LEAST_CHARS,
    text: str = "text", item_id: str = "item_id", item_text: str = "text", chars: int = BLOCK_CHARS, short: bool = False,
) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, all columns as they were, without a shuffle."""
    at = docs.columns.index(text)
    for block in item_blocks(benchmark, item_id, item_text, chars):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def drop(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value, error_rate, least, short)
            for part in slices(batches):
                yield part.filter(pa.array([not matcher.find(normal(t)) for t in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(drop, docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)

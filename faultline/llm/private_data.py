"""Personal data: fixed patterns as seeds, and contexts learned from them that find more.

Base spans are the matches of four fixed patterns (``base_spans``). They seed a
bootstrap over the contexts in which identifiers stand:

* Candidates are strings that have the make of an identifier of some kind but are no
  base span: an address whose host has no dot or whose @ or dots are spelled out, four
  groups of digits with odd separators or out of range, a number of a card's or a
  phone's length. One string may be a candidate of several kinds.
* Instances are the distinct values of base spans and candidates (their digits and
  letters only), one per kind. Copies of a document add no instance.
* Patterns are the lexical contexts of an instance: the two words before it, a label
  before it (a word that ends in ``:``, ``=`` or ``#``) with the word before that, and
  the words on both sides. Words are lower-cased and digits in them become 0.
* Scores go back and forth over the graph of patterns and instances. A pattern's
  confidence for a kind is the weight of its known instances of that kind over the
  number of all its instances, whatever their kind; candidates of the kind that are not
  known (yet) count half there. It speaks from ``support`` known instances and from a
  confidence of ``confidence`` on. An instance is as sure as one minus the product of
  the doubts of its patterns, each smoothed by one more instance that speaks against it.
  Instances that are as sure as one such pattern makes them are known from then on, with
  that weight. Rounds go on until one adds none (or ``rounds`` have passed).

Accepted instances are spans wherever they stand as candidates; base spans stay, and
an added span never overlaps one. Where added spans overlap, the earlier and then the
longer one stays. Spark builds, scores and joins the graph; patterns and instances are
rows, none are collected.

Rows: null and empty texts have no spans; rows without an id and rows that share one
are rows of their own; an empty table gives no rows. Columns other than doc_id and
text are not read. Time is linear in a text's length, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import slices, table
from faultline.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 8
#: Characters on each side of an identifier among which its context words are looked for.
CONTEXT_CHARS = 80

# Base patterns in a form that never looks at a character more than a few times.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates. Bounds are those of the formats: 64 and 255 characters of an address, 4 digits of a group.
_ADDRESS_LEFT = re.compile(r"[^\s@,;:<>()\[\]\"']{1,64}\Z")
_ADDRESS_RIGHT = re.compile(r"[^\s@,;:<>()\[\]\"']{1,255}")
_SPELLED_AT = re.compile(r"[ ]?[(\[{]\s?at\s?[)\]}][ ]?", re.IGNORECASE)
_SPELLED_LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_SPELLED_RIGHT = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|[ ]?[(\[{]\s?dot\s?[)\]}][ ]?)[A-Za-z0-9-]{1,63}){0,8}", re.IGNORECASE)
_GROUPS = re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:[ ]?[.,:][ ]?|[ ]?[(\[{](?:\.|dot)[)\]}][ ]?)[0-9]{1,4}){3}(?![0-9])", re.IGNORECASE)
_NUMBER = re.compile(r"\(?[0-9](?:[\x20().\-/]{0,3}[0-9])++")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = ".,;!?\"'()[]{}<>*"
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and (not digits or int(digits) <= 255)


def _only(digits: str) -> str:
    return "".join(c for c in digits if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind, end of the base matches, sorted; offsets are code points, kinds places in ``KINDS``."""
    out = []
    at, done = text.find("@"), 0
    if at >= 0:
        back = text[::-1]
    while at >= 0:
        start = at - _LOCAL.match(back, len(text) - at, len(text) - done).end() + len(text) - at
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((start, 0, host.end()))
            done = host.end()
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """start, kind, end of strings that might be identifiers; none overlaps a span of ``taken``."""
    found = []
    at = text.find("@")
    while at >= 0:
        left = _ADDRESS_LEFT.search(text[max(0, at - 64) : at])
        right = _ADDRESS_RIGHT.match(text, at + 1)
        if left and right:
            end = right.end() - (len(right.group()) - len(right.group().rstrip(_TRIM)))
            if end > at + 1:
                found.append((at - len(left.group()), 0, end))
        at = text.find("@", at + 1)
    for m in _SPELLED_AT.finditer(text):
        left = _SPELLED_LEFT.search(text[max(0, m.start() - 64) : m.start()])
        right = _SPELLED_RIGHT.match(text, m.end())
        if left and right:
            found.append((m.start() - len(left.group()), 0, right.end()))
    found += [(m.start(), 1, m.end()) for m in _GROUPS.finditer(text)]
    for m in _NUMBER.finditer(text):
        n = len(_only(m.group()))
        if 12 <= n <= 19:
            found.append((m.start(), 2, m.end()))
        if 7 <= n <= 15:
            found.append((m.start(), 3, m.end()))
    return apart(sorted(found), taken)


def apart(found: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``found`` that overlap none of ``taken``; both are sorted by start."""
    out, k, edge = [], 0, 0  # edge: the end of all spans of taken that start before
    for start, kind, end in found:
        while k < len(taken) and taken[k][0] <= start:
            edge = max(edge, taken[k][2])
            k += 1
        if edge <= start and not (k < len(taken) and taken[k][0] < end):
            out.append((start, kind, end))
    return out


def _plain(word: str) -> str:
    return _DIGITS.sub("0", word.strip(_TRIM).lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns that an identifier at these places stands in."""
    before = [m.group() for m in _WORD.finditer(text, max(0, start - CONTEXT_CHARS), start)][-2:]
    after = _WORD.search(text, end, min(len(text), end + CONTEXT_CHARS))
    last = [_plain(w) for w in before]
    right = _plain(after.group()) if after else ""
    out = []
    if len(last) == 2 and all(last):
        out.append(f"{last[0]} {last[1]} _")
    if before and before[-1][-1] in ":=#" and last[-1].strip(":=#"):
        out.append(f"{last[-1]} _")
    if last and last[-1] and right:
        out.append(f"{last[-1]} _ {right}")
    return out


def value_of(kind: int, text: str) -> str:
    """What makes two strings the same identifier: letters and digits in lower case, digits alone in numbers."""
    return "".join(c for c in text.lower() if c.isalnum()) if kind == 0 else _only(text)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_NODE = pa.struct([("value", pa.string()), ("patterns", pa.list_(pa.string()))])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: _row, doc_id, base, and the candidates, each with its value and patterns."""
    span = "struct<start:long,kind:int,end:long>"
    node = "struct<value:string,patterns:array<string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            base, maybe, nodes = [], [], []
            for text in rows.column(1).to_pylist():
                text = text or ""
                seeds = base_spans(text)
                more = candidates(text, seeds)
                base.append([dict(zip(("start", "kind", "end"), s)) for s in seeds])
                maybe.append([dict(zip(("start", "kind", "end"), s)) for s in more])
                nodes.append([{"value": value_of(k, text[a:b]), "patterns": contexts(text, a, b)} for a, k, b in [*seeds, *more]])
            columns = [pa.array(base, pa.list_(_SPAN)), pa.array(maybe, pa.list_(_SPAN)), pa.array(nodes, pa.list_(_NODE))]
            yield pa.RecordBatch.from_arrays([rows.column(0), *columns], ["doc_id", "base", "maybe", "nodes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, f"doc_id long, base array<{span}>, maybe array<{span}>, nodes array<{node}>")
    return cut_lineage(found.select(F.monotonically_increasing_id().alias("_row"), "*"))


def graph(scanned: DataFrame) -> DataFrame:
    """pattern, kind, value, seed: each instance of a pattern once, however often it stands there."""
    spans = F.arrays_zip(F.concat("base", "maybe").alias("span"), F.col("nodes").alias("node"))
    each = scanned.where(F.size("nodes") > 0).select(F.explode(spans).alias("x"), F.size("base").alias("n"), "base").select(
        F.col("x.span.kind").alias("kind"), F.col("x.node.value").alias("value"), F.col("x.node.patterns").alias("patterns"),
        F.array_contains("base", F.col("x.span")).alias("seed"),
    )
    edges = each.select(F.explode("patterns").alias("pattern"), "kind", "value", "seed")
    return cut_lineage(edges.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")))


def bootstrap(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """kind, value, score of the instances that the patterns find beyond the seeds."""
    # An identifier seen as several kinds is one identifier in a pattern's total, and a seed wherever it is one.
    totals = edges.groupBy("pattern").agg(F.countDistinct("value").alias("total"))
    kinds = edges.groupBy("kind", "value").agg(F.max("seed").alias("known"))
    able = edges.groupBy("pattern", "kind").agg(F.count("*").alias("n")).where(F.col("n") >= support)  # others never speak
    edges = cut_lineage(edges.join(able, "pattern", "left_semi").join(totals, "pattern"))
    kinds = cut_lineage(kinds)
    seeds = kinds.where("known").select("kind", "value", F.lit(1.0).alias("score"))
    found = None
    threshold = confidence * support / (support + 1)
    for _ in range(rounds):
        scores = seeds if found is None else seeds.union(found.select("kind", "value", "score"))
        patterns = edges.join(scores, ["kind", "value"], "left").groupBy("pattern", "kind").agg(
            F.sum("score").alias("weight"), F.count("score").alias("n"), (F.max("total") - 0.5 * F.count_if(F.col("score").isNull())).alias("all"))
        sure = patterns.where((F.col("n") >= support) & (F.col("weight") >= confidence * F.col("all"))).select(
            "pattern", "kind", (F.col("weight") / (F.col("all") + 1)).alias("sure"))
        doubt = F.exp(F.sum(F.log(1 - F.col("sure"))))
        told = edges.join(sure, ["pattern", "kind"]).groupBy("kind", "value").agg((1 - doubt).alias("score"))
        told = told.where(F.col("score") >= threshold).join(seeds.select("kind", "value"), ["kind", "value"], "left_anti")
        before, found = found, cut_lineage(told)
        if found.count() == (0 if before is None else before.count()):
            break
    return found


def find(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base, added of every row: its base spans and those that contexts add, as arrays of (start, kind, end)."""
    scanned = scan(docs)
    found = bootstrap(graph(scanned), support, confidence, rounds).select("kind", "value")
    each = scanned.where(F.size("maybe") > 0).select("_row", F.posexplode("maybe").alias("k", "span"), (F.size("base")).alias("skip"), "nodes").select(
        "_row", "span", F.col("span.kind").alias("kind"), F.element_at("nodes", F.col("skip") + F.col("k") + 1)["value"].alias("value"))
    hits = each.join(found, ["kind", "value"], "left_semi").groupBy("_row").agg(F.collect_list("span").alias("added"))  # spans of one text
    empty = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    return scanned.join(hits, "_row", "left").select("doc_id", "base", F.coalesce("added", empty).alias("added"))


def without_overlaps(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out, edge = [], -1
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2], s[1])):
        if start >= edge:
            out.append((start, kind, end))
            edge = end
    return out


def op11_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for base, added in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                seeds, more = ([(s["start"], s["kind"], s["end"]) for s in spans] for spans in (base, added))
                counts = [sum(kind == k for _, kind, _ in seeds) for k in range(len(KINDS))]
                out.append((*counts, hashlib.sha256(written(seeds).encode()).hexdigest(), written(sorted(seeds + without_overlaps(more)))))
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    found = find(table(spark, sf_dir, "documents"))
    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")

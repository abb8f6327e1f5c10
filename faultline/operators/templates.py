"""Template statistics and greedy template mining.

A line's *leaf* is the sequence of its first ``depth`` masked tokens.  Inside a
leaf the lines are taken in log order; each joins the most similar template made
before it (Jaccard of token sets, at least ``threshold``, first one on ties) or
makes a new template.  By default the tokens after the leaf's are what is compared
with the whole template, so lines of at most ``depth`` tokens only ever make their own;
``compare="line"`` takes all tokens of the line instead.  Leaves never see each other.
Inside a leaf of any size an index over rare tokens finds the templates that a line
could join, see :func:`grow_templates` and :func:`similar_templates`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions import text
from faultline.session import cut_lineage

DEPTH = 4
THRESHOLD = 0.5
# Classes of lines of each leaf in the first stretch, and how much longer each next one is.
HEAD_ROWS = 1_000
HEAD_GROWTH = 8
# Stands in for the tokens of an empty set, so that two empty sets meet.
NO_TOKEN = 0


def template_table(logs: DataFrame) -> DataFrame:
    """One row per template of ``logs`` (needs template_pattern, log_id, timestamp)."""
    return logs.groupBy("template_pattern").agg(
        F.count("*").alias("frequency"),
        F.min("timestamp").alias("created_at"),
        F.min("log_id").alias("first_log_id"),
    ).withColumn("template_id", text.stable_id(F.col("template_pattern")))


def merge_template_tables(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Next snapshot: frequencies add up, the first sighting is kept."""
    return (
        previous.unionByName(current)
        .groupBy("template_pattern")
        .agg(
            F.sum("frequency").alias("frequency"),
            F.min("created_at").alias("created_at"),
            F.min("first_log_id").alias("first_log_id"),
        )
        .withColumn("template_id", text.stable_id(F.col("template_pattern")))
    )


def template_stats(templates: DataFrame, depth: int = DEPTH, threshold: float = THRESHOLD) -> DataFrame:
    return templates.agg(
        F.count("*").alias("total_templates"), F.coalesce(F.sum("frequency"), F.lit(0)).alias("total_logs_parsed")
    ).select("*", F.lit(depth).alias("tree_depth"), F.lit(threshold).alias("similarity_threshold"))


def leaf_key(masked: Column, depth: int = DEPTH) -> Column:
    """Leaf of a masked line; tokens hold no white space, so newline separates them."""
    return F.array_join(F.slice(masked, 1, depth), "\n")


def template_jaccard(logs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Similarity of every log to the first line of its leaf (one comparison per log).

    Starts a job that writes the first lines, so that a large leaf can be split in the
    join.
    """
    masked = logs.select("log_id", "log_line", text.masked_tokens(F.col("log_line")).alias("masked"))
    keyed = masked.withColumn("leaf", leaf_key(F.col("masked"), depth))
    first = cut_lineage(keyed.groupBy("leaf").agg(F.min_by("masked", "log_id").alias("first_masked")))
    return keyed.join(first, "leaf").select(
        "log_id", text.jaccard(F.col("masked"), F.col("first_masked")).alias("similarity")
    )


class LeafIndex:
    """Templates of one leaf in the order they were made, found by few tokens.

    A line of a tokens and a similar template of b tokens share at least
    ``least_shared(a, b, threshold)``, so one of any a - least_shared + 1 tokens of the
    line is among them. Templates are listed by token and size; for each size a line
    looks up that many of its tokens, those with the shortest lists, and compares only
    what it finds.
    """

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.patterns: list[str] = []
        self.sets: list[frozenset] = []
        self._numbers: dict[str, int] = {}
        self._under: dict[int, dict[int, list[int]]] = {}  # by size, then by token

    def candidates(self, tokens: frozenset) -> list[int]:
        """Numbers of the templates that a line of ``tokens`` is compared with, ascending."""
        probes, found = tokens or (NO_TOKEN,), set()
        for size, lists in self._under.items():
            shared = least_shared(len(probes), size, self.threshold)
            if shared <= min(len(probes), size):
                short = sorted((lists.get(t, ()) for t in probes), key=len)
                found.update(*short[: len(probes) - shared + 1])
        return sorted(found)

    def match(self, tokens: frozenset) -> str | None:
        """The most similar template, the first of equals; None below the threshold."""
        best, score = -1, 0.0
        for i in self.candidates(tokens):
            other = self.sets[i]
            shared = len(tokens & other)
            union = len(tokens) + len(other) - shared
            similarity = shared / union if union else 1.0
            if similarity >= self.threshold and similarity > score:
                best, score = i, similarity
        return self.patterns[best] if best >= 0 else None

    def add(self, pattern: str, tokens: frozenset) -> bool:
        """Whether ``pattern`` is new to the leaf."""
        if pattern in self._numbers:
            return False
        number = self._numbers[pattern] = len(self.patterns)
        self.patterns.append(pattern)
        self.sets.append(tokens)
        listed = tokens or (NO_TOKEN,)
        lists = self._under.setdefault(len(listed), {})
        for t in listed:
            lists.setdefault(t, []).append(number)
        return True


def least_shared(a: int, b: int, threshold: float) -> int:
    """How many tokens sets of ``a`` and ``b`` tokens share at least if they reach ``threshold``."""
    return max(1, math.ceil(threshold * (a + b) / (1 + threshold) - 1e-9))


def _made_by_leaf(threshold: float):
    """Reader of rows sorted by (leaf, first_id): the templates they make, one leaf's index at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaf, index = None, LeafIndex(threshold)
        for batch in batches:
            made = []
            for key, tokens, own, own_tokens in zip(batch["leaf"], batch["tokens"], batch["own_pattern"], batch["own_tokens"]):
                if key != leaf:
                    leaf, index = key, LeafIndex(threshold)
                made.append(index.match(frozenset(tokens)) is None and index.add(own, frozenset(own_tokens)))
            yield batch.loc[made, ["leaf", "first_id", "own_pattern", "own_tokens"]]

    return run


def token_hashes(tokens: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t))))


def line_parts(line: Column, depth: int = DEPTH, strip_timestamp: bool = False, compare: str = "rest") -> list[Column]:
    """leaf, tokens, own_pattern, own_tokens of a line: where it is mined, what is compared, the template it would make."""
    if compare not in ("rest", "line"):
        raise ValueError(f"compare={compare!r}: 'rest' or 'line'")
    masked = text.masked_tokens(text.without_leading_timestamp(line) if strip_timestamp else line)
    own = text.render_template(masked)
    compared = F.slice(masked, depth + 1, F.greatest(F.size(masked), F.lit(1))) if compare == "rest" else masked
    return [
        leaf_key(masked, depth).alias("leaf"),
        token_hashes(compared).alias("tokens"),
        own.alias("own_pattern"),
        # The template is tokenised again: a cut token may turn into a number.
        token_hashes(text.masked_tokens(own)).alias("own_tokens"),
    ]


def distinct_lines(logs: DataFrame, depth: int = DEPTH, strip_timestamp: bool = False, compare: str = "rest") -> DataFrame:
    """Distinct lines with first_id and their parts, see :func:`line_parts`."""
    lines = logs.groupBy("log_line").agg(F.min("log_id").alias("first_id"))
    return lines.select("log_line", "first_id", *line_parts(F.col("log_line"), depth, strip_timestamp, compare))


def _similarity(tokens: Column, other: Column) -> Column:
    shared = F.size(F.array_intersect(tokens, other))
    union = F.size(tokens) + F.size(other) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def _set_id() -> Column:
    return F.md5(F.concat_ws("\n", "leaf", F.lit(""), F.col("tokens").cast("array<string>"))).alias("set_id")


def similar_templates(sets: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """set_id and template (similarity, age, pattern) of every pair of one leaf that reaches ``threshold``.

    ``sets``: set_id, leaf, tokens; ``templates``: leaf, first_id, own_pattern,
    own_tokens. The tokens of both are put in one order, by the number of the leaf's
    templates with them; tokens of no template come first. Sets of a and b tokens that
    share s of them also share one of the first a - s + 1 and b - s + 1, so only those
    meet, in a join on leaf, token and size of the template. A pair may be found under
    several tokens and is listed as often.
    """
    padded = lambda c: F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit(NO_TOKEN).cast("bigint")))
    least = lambda a, b: F.greatest(F.ceil(threshold * (a + b) / (1 + threshold) - 1e-9), F.lit(1)).cast("int")
    n, own = F.col("n"), ["leaf", "first_id", "own_pattern", "own_tokens", "n"]
    each = templates.withColumn("n", F.size(padded("own_tokens"))).select(*own, F.explode(padded("own_tokens")).alias("token"))
    met = each.groupBy("leaf", "token").agg(F.count("*").alias("met"), F.collect_set("n").alias("sizes"))  # lengths of the leaf's templates
    ranked = each.join(met, ["leaf", "token"]).groupBy(*own).agg(
        F.array_sort(F.collect_list(F.struct("met", "token"))).alias("by_rarity"))  # the tokens of one line
    fewest = F.greatest(F.ceil(threshold * n - 1e-9), F.lit(1)).cast("int")
    index = ranked.select(*own, F.posexplode(F.slice("by_rarity.token", F.lit(1), n - fewest + 1)).alias("place", "token"))
    known = sets.select("set_id", "leaf", "tokens", F.size(padded("tokens")).alias("a"), F.explode(padded("tokens")).alias("token")).join(
        met, ["leaf", "token"]).groupBy("set_id", "leaf", "tokens", "a").agg(
        F.array_sort(F.collect_list(F.struct("met", "token", "sizes"))).alias("known"))  # the tokens of one line
    by_size = known.select("*", F.explode(F.array_distinct(F.flatten("known.sizes"))).alias("n")).withColumn("least", least(F.col("a"), n))
    by_size = by_size.where(F.col("least") <= F.least(F.size("known"), n))
    first = F.slice("known", F.lit(1), F.size("known") - F.col("least") + 1)
    probes = by_size.select("set_id", "leaf", "tokens", "n", "least", F.explode(F.filter(first, lambda k: F.array_contains(k["sizes"], F.col("n")))["token"]).alias("token"))
    met_by = probes.join(index, ["leaf", "token", "n"]).where(F.col("place") <= n - F.col("least"))
    scored = met_by.withColumn("similarity", _similarity(F.col("tokens"), F.col("own_tokens")))
    return scored.where((F.col("similarity") >= threshold) & (F.col("similarity") > 0)).select(
        "set_id", F.struct("similarity", (-F.col("first_id")).alias("age"), F.col("own_pattern").alias("pattern")).alias("template"))


def _ranked(classes: DataFrame) -> DataFrame:
    """``classes`` with rank, their place in their leaf by first_id; no leaf goes through one task."""
    order = ["leaf", "first_id"]
    rows = cut_lineage(classes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("leaf").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("leaf", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).select(
        "leaf", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(starts, ["leaf", "_part"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


_MADE_SCHEMA = "leaf string, first_id bigint, own_pattern string, own_tokens array<bigint>"


def grow_templates(lines: DataFrame, threshold: float = THRESHOLD, head_rows: int = HEAD_ROWS, growth: int = HEAD_GROWTH) -> DataFrame:
    """leaf, first_id, own_pattern, own_tokens of the templates that ``lines`` make.

    Lines that agree in leaf, compared tokens and own template are one class: whatever
    its first line finds, no other can add a template. Classes are ranked in their leaf,
    and the ranks cut into stretches, each ``growth`` times as long as all before it. Of
    a stretch only classes that no earlier template covers are read in order by one
    task per leaf; an index finds the covered ones in parallel. So the number of rounds
    grows with the logarithm of the largest leaf, and a task reads in order little
    more than what makes templates.
    """
    classes = lines.groupBy("set_id", "leaf", "tokens", "own_pattern").agg(F.min("first_id").alias("first_id"), F.first("own_tokens").alias("own_tokens"))
    classes = cut_lineage(classes)
    most = classes.groupBy("leaf").count().agg(F.max("count")).first()[0] or 0
    # Leaves of one stretch need no ranks.
    ranked = classes.withColumn("rank", F.lit(0)) if most <= head_rows else cut_lineage(_ranked(classes))
    found, low, high = None, 0, head_rows
    while low < most:
        rows = ranked.where((F.col("rank") >= low) & (F.col("rank") < high))
        if found is not None:
            covered = similar_templates(rows.select("set_id", "leaf", "tokens").distinct(), found, threshold).select("set_id").distinct()
            rows = rows.join(found.select("leaf", "own_pattern"), ["leaf", "own_pattern"], "left_anti").join(covered, "set_id", "left_anti")
        rows = rows.select("leaf", "first_id", "tokens", "own_pattern", "own_tokens")
        made = cut_lineage(rows.repartition("leaf").sortWithinPartitions("leaf", "first_id").mapInPandas(_made_by_leaf(threshold), _MADE_SCHEMA))
        found = made if found is None else cut_lineage(found.unionByName(made), spent=[found, made])
        low, high = high, high * growth
    return lines.select("leaf", "first_id", "own_pattern", "own_tokens").limit(0) if found is None else found


def assign_templates(
    logs: DataFrame,
    depth: int = DEPTH,
    threshold: float = THRESHOLD,
    strip_timestamp: bool = False,
    compare: str = "rest",
    head_rows: int = HEAD_ROWS,
    growth: int = HEAD_GROWTH,
) -> DataFrame:
    """(log_line, template_pattern) for the distinct lines of ``logs``.

    A line joins the most similar template made before it, the first of equals; the
    similarity is that of ``compare``: the tokens after the line's leaf ("rest") or all
    of its tokens ("line") with all tokens of the template. Starts jobs: lines, classes
    and templates are written to shared storage.
    """
    lines = cut_lineage(distinct_lines(logs, depth, strip_timestamp, compare).withColumn("set_id", _set_id()))
    found = grow_templates(lines, threshold, head_rows, growth)
    sets = lines.groupBy("set_id").agg(F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"))
    options = similar_templates(sets, found, threshold).groupBy("set_id").agg(F.collect_set("template").alias("options"))
    options = cut_lineage(options)  # templates that one set of tokens may join
    earlier = F.filter("options", lambda t: -t["age"] < F.col("first_id"))
    joined = lines.join(options, "set_id", "left")
    return joined.select("log_line", F.coalesce(F.array_max(earlier)["pattern"], "own_pattern").alias("template_pattern"))


def mine_templates(logs: DataFrame, **options) -> DataFrame:
    """``logs`` with template_pattern and template_id from greedy mining.

    Identical lines share the answer of their first occurrence, so only distinct
    lines are mined and the answer is joined back on the line.
    """
    assigned = assign_templates(logs, **options)
    return (
        logs.drop("template_pattern", "template_id")
        .join(assigned, "log_line")
        .withColumn("template_id", text.stable_id(F.col("template_pattern")))
    )

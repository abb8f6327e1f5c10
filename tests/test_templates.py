"""Template mining against a sequential model, for leaves of one and of many stretches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import LOG_SCHEMA
from faultline.operators import templates
from test_text import model_masked


def sequential(lines, depth=4, threshold=0.5, compare="rest", strip=False):
    """One pass in log order: template of every line."""
    groups, answered, out = {}, {}, []
    for line in lines:
        if line not in answered:
            masked = model_masked(re.sub(STAMP, "", line) if strip else line)
            compared = set(masked[depth:] if compare == "rest" else masked)
            known = groups.setdefault(tuple(masked[:depth]), [])
            best, score = None, 0.0
            for pattern in known:
                a, b = compared, set(model_masked(pattern))
                s = len(a & b) / len(a | b) if a | b else 1.0
                if s >= threshold and s > score:
                    best, score = pattern, s
            if best is None:
                best = " ".join(t[:8] for t in masked)
                if best not in known:
                    known.append(best)
            answered[line] = best
        out.append(answered[line])
    return out


def sample_lines(n=600, seed=3):
    rng = random.Random(seed)
    heads = ["A b c d", "A b c d", "A b c d", "A b c e", "x", "longtokenone longtokentwo longtokenthree longtokenfour"]
    words = ["up", "down", "12345678x", "12345678", "verylongword1", "verylongword2", "10.0.0.1", "/p", "k1", "k2", "k3", "7"]
    lines = [f"{rng.choice(heads)} {' '.join(rng.choices(words, k=rng.randint(0, 6)))}" for _ in range(n)]
    return lines + ["", "  ", "A b", "A b"]


def logs_of(make, lines):
    rows = make("log_id bigint, log_line string", list(enumerate(lines)))
    return rows.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))


STAMP = r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?\s*"


def long_lines(n=400, seed=4):
    """Few leaves, and tails long enough to reach a whole template after the leaf's tokens."""
    rng = random.Random(seed)
    words = [f"{c}{k}" for c in "ab" for k in range(9)]
    lines = []
    for _ in range(n):
        tail = rng.sample(words[:9] if rng.random() < 0.5 else words[9:], rng.randint(4, 9))
        lines.append(f"2024-01-0{rng.randint(1, 9)} 10:00:00 {rng.choice(['x y z q', 'x y z r'])} {' '.join(tail)}")
    return lines


@pytest.mark.parametrize("options,strip", [
    ({}, False), ({"compare": "line"}, True), ({"head_rows": 5, "growth": 4}, True), ({"threshold": 0.3, "depth": 2, "head_rows": 20}, False),
    ({"threshold": 0.25, "depth": 1, "head_rows": 20, "growth": 3, "compare": "line"}, False),
])
def test_mining_equals_sequential_model(make, options, strip):
    lines = sample_lines(300) + long_lines()
    model = {k: v for k, v in options.items() if k in ("depth", "threshold", "compare")}
    mined = templates.mine_templates(logs_of(make, lines), strip_timestamp=strip, **options)
    got = [r[0] for r in mined.orderBy("log_id").select("template_pattern").collect()]
    assert got == sequential(lines, strip=strip, **model)
    assert len(set(got)) < len(set(lines))


def test_readings_of_the_leaf_rule_differ(make):
    """Lines as long as the leaf never join by their rest; all their tokens may."""
    lines = ["a b c d", "a b c d e", "a b c d e f"]
    tell = lambda **o: [r[0] for r in templates.mine_templates(logs_of(make, lines), **o).orderBy("log_id").select("template_pattern").collect()]
    assert tell() == lines
    assert tell(compare="line") == ["a b c d"] * 3
    with pytest.raises(ValueError):
        tell(compare="none")


@pytest.mark.parametrize("threshold", [0.2, 1 / 3, 0.5, 0.75, 1.0])
def test_index_finds_what_a_scan_finds(threshold):
    rng = random.Random(1)
    index, sets = templates.LeafIndex(threshold), []
    for k in range(400):
        tokens = frozenset(rng.sample(range(1, 25), rng.randint(0, 8)))
        best, score = None, 0.0
        for i, other in enumerate(sets):
            s = len(tokens & other) / len(tokens | other) if tokens | other else 1.0
            if s >= threshold and s > score:
                best, score = f"p{i}", s
        assert index.match(tokens) == best
        if best is None and rng.random() < 0.7:
            index.add(f"p{len(sets)}", tokens)
            sets.append(tokens)


def test_strip_timestamp_merges_lines(make):
    lines = [f"2024-01-01 10:00:0{i} job {i} done ok" for i in range(5)]
    plain = templates.mine_templates(logs_of(make, lines)).select("template_pattern").distinct().count()
    stripped = templates.mine_templates(logs_of(make, lines), strip_timestamp=True).select("template_pattern").distinct().count()
    assert (plain, stripped) == (5, 1)


def test_mining_nothing(make):
    assert templates.mine_templates(logs_of(make, ["x"]).limit(0)).count() == 0


def test_table_merge_adds_frequencies(make):
    lines = ["a 1", "a 2", "b"]
    whole = logs_of(make, lines + ["a 3", "c"]).withColumn("template_pattern", F.regexp_replace("log_line", r"\d", "<NUM>"))
    first, second = whole.filter("log_id < 3"), whole.filter("log_id >= 3")
    merged = templates.merge_template_tables(templates.template_table(first), templates.template_table(second))
    key = ["template_pattern", "frequency", "first_log_id", "template_id"]
    assert sorted(merged.select(key).collect()) == sorted(templates.template_table(whole).select(key).collect())
    assert templates.template_stats(merged).first()[:2] == (3, 5)
    assert templates.template_stats(merged.limit(0)).first()[:2] == (0, 0)


@pytest.mark.parametrize("threshold", [0.2, 1 / 3, 0.5, 0.75, 1.0])
def test_join_finds_what_a_scan_finds(make, threshold):
    rng = random.Random(2)
    some = lambda: sorted(rng.sample(range(1, 25), rng.randint(0, 8)))
    sets, known = [("a", some()) for _ in range(150)] + [("b", some())], [("a", some()) for _ in range(80)]
    schema = "leaf string, first_id bigint, own_pattern string, own_tokens array<bigint>"
    found = templates.similar_templates(
        make("set_id string, leaf string, tokens array<bigint>", [(str(k), leaf, s) for k, (leaf, s) in enumerate(sets)]),
        make(schema, [(leaf, k, f"p{k}", s) for k, (leaf, s) in enumerate(known)]), threshold)
    model = set()
    for k, (leaf, s) in enumerate(sets):
        for i, (other, t) in enumerate(known):
            similarity = len(set(s) & set(t)) / len(set(s) | set(t)) if s or t else 1.0
            if leaf == other and similarity >= threshold:
                model.add((str(k), similarity, -i, f"p{i}"))
    assert {(r.set_id, *r.template) for r in found.collect()} == model


def test_common_tokens_do_not_bring_lines_together():
    """A line is compared with the templates that share a rare token, however many share the common ones."""
    index = templates.LeafIndex(0.5)
    for k in range(1000):
        index.add(f"p{k}", frozenset([1, 2, 3, 4, 5, 6, 7, 100 + k]))
    assert [len(index.candidates(frozenset([5, 6, 7, token]))) for token in (100, 1099, 1100)] == [1, 1, 0]


def test_join_makes_few_rows_of_common_tokens(make):
    """As above for the join: what it gives before the similarity is checked grows with the lines."""
    n = 300
    known = make("leaf string, first_id bigint, own_pattern string, own_tokens array<bigint>",
                 [("a", k, f"p{k}", [1, 2, 3, 4, 5, 6, 7, 100 + k]) for k in range(n)])
    sets = make("set_id string, leaf string, tokens array<bigint>", [(str(k), "a", [5, 6, 7, 100 + k]) for k in range(n)])
    seen = sets.sparkSession.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(size):
        seen.add(1)
        return size

    found = templates.similar_templates(sets, known, 0.5).count()
    plain, similarity = templates._similarity, lambda a, b: F.coalesce(counted(F.size(a) + F.size(b)) * 0, F.lit(0)) + plain(a, b)
    templates._similarity = similarity
    try:
        assert templates.similar_templates(sets, known, 0.5).count() == found == n
    finally:
        templates._similarity = plain
    assert n <= seen.value <= 4 * n

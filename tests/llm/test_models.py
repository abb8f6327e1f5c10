"""Operators that SQL cannot express against plain models of their whole method, on the smallest given tables."""

import collections
import math
import os
import re
import zlib

import pytest

import corpus_pipeline
from faultline.llm import decontamination, gam, language, quality_rules
from faultline.llm.common import table
from faultline.session import cut_lineage

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark, SF_DIR, "documents").collect()


# Language ID


def _grams(text):
    """All 1- to 3-grams of the letter runs of a text, an edge symbol on each side; a gram of edges alone is none."""
    out = collections.Counter()
    symbols = "".join(c if c.isalpha() else " " for c in text.lower())
    run = " " + " ".join(symbols.split()) + " " if symbols.split() else ""
    for n in (1, 2, 3):
        for k in range(len(run) - n + 1):
            gram = run[k : k + n]
            if gram.strip() and not (n == 3 and gram[1] == " "):
                out[gram] += 1
    return out


def _ranked(counts, k=400):
    code = lambda g: sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:k]


def test_language_id_equals_out_of_place_model(spark, rows):
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    sums = collections.defaultdict(collections.Counter)
    for r in rows:
        if r.lang is not None and r.text is not None and not held(r.doc_id):
            sums[r.lang] += _grams(r.text)
    places = {lang: {g: k for k, g in enumerate(_ranked(c))} for lang, c in sums.items()}
    got = {r.doc_id: r for r in language.op2_language_id(spark, SF_DIR).collect()}
    right = 0
    for r in rows[:120]:
        doc = _ranked(_grams(r.text or ""))
        far = {lang: sum(abs(p[g] - k) if g in p else 400 for k, g in enumerate(doc)) for lang, p in places.items()}
        best = min(sorted(far), key=far.get) if doc else "und"
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held(r.doc_id), best)
        assert got[r.doc_id].score == pytest.approx(1 - far[best] / (400 * len(doc)) if doc else 0)
        right += best == r.lang
    assert right >= 110


# Quality rules


def _distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt(max(0, (half(p, q) + half(q, p)) / 2))


def _classes(text):
    spaced = re.sub(r"[\t-\r]", " ", text)
    counts = [len(re.findall(c, spaced)) for c in ("[a-z]", " ", "[A-Z]", r"[.,;:!?'\"()\-]", "[0-9]", r"[^\x00-\x7F]")]
    return [*counts, len(spaced) - sum(counts)]


def test_quality_rules_equal_their_model(spark, rows):
    words = {r.doc_id: re.findall(WORD, r.text or "") for r in rows}
    chars, common, total = collections.defaultdict(lambda: [0] * 7), collections.defaultdict(collections.Counter), collections.Counter()
    for r in rows:
        chars[r.lang] = [a + b for a, b in zip(chars[r.lang], _classes(r.text or ""))]
        common[r.lang].update(w for w in words[r.doc_id] if len(w) <= quality_rules.COMMON_CHARS)
        total[r.lang] += len(words[r.doc_id])
    listed = {lang: sorted(c, key=lambda w: (-c[w], w.encode()))[: quality_rules.COMMON_WORDS] for lang, c in common.items()}
    got = {r.doc_id: r for r in quality_rules.op4_quality_rules(spark, SF_DIR).collect()}
    judged = 0
    for r in rows:
        w, g, lang = words[r.doc_id], got[r.doc_id], r.lang
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        twice = {x for x, n in collections.Counter(windows).items() if n > 1}
        repeated = len({k + j for k, x in enumerate(windows) if x in twice for j in range(8)})
        failed = len(w) < 20 or 100 * repeated > 30 * len(w)
        with_rest = lambda counts, n: [*counts, n - sum(counts)]
        mine = collections.Counter(w)
        far = _distance(_classes(r.text or ""), chars[lang])
        apart = _distance(with_rest([mine[x] for x in listed[lang]], len(w)), with_rest([common[lang][x] for x in listed[lang]], total[lang]))
        assert (g.n_words, g.n_repeat_words, g.base_failed) == (len(w), repeated, failed)
        assert g.char_distance == (None if far is None else pytest.approx(far, abs=1e-9))
        assert g.word_distance == (None if apart is None else pytest.approx(apart, abs=1e-9))
        enough = total[lang] >= quality_rules.LEAST_REFERENCE
        out = enough and (len(w) >= 20 and far > 0.30 or len(w) >= 60 and apart > 0.45)
        assert g.kept == (not failed and not out)
        judged += bool(out)
    assert judged


# Decontamination


def _best(item, text):
    """The smallest edit distance of an item to any part of a text, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_matches_equal_the_plain_table(spark, rows):
    items = [(r.item_id, decontamination.normal(r.text)) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = collections.defaultdict(dict)
    for r in decontamination.op8_decontaminate(spark, SF_DIR).collect():
        found[r.doc_id][r.item_id] = r.distance
    by_size = sorted((r for r in rows if r.text), key=lambda r: len(r.text))
    some = [r for r in by_size if r.doc_id in found][:2] + [r for r in by_size if r.doc_id not in found and len(r.text) > 300][:3]
    assert len(some) == 5
    for r in some:
        text = decontamination.normal(r.text)
        for item_id, item in items:
            shared = sum(item[k : k + 8] in text for k in range(0, len(item) - 8, 4))  # no shared stretch: no need for the table
            budget = int(decontamination.ERROR_RATE * len(item))
            distance = _best(item, text) if shared else budget + 1
            assert found[r.doc_id].get(item_id) == (distance if distance <= budget else None)


# Additive model and pipeline


def test_quality_scores_tell_held_out_labels_apart(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    got = [r for r in gam.op7_quality_gam(spark, SF_DIR).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    good, bad = ([r.score for r in got if labels[r.doc_id] == q] for q in (1, 0))
    assert good and bad
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_pipeline_from_end_to_end(spark, rows):
    """Every stage on what the one before kept; decisions take effect and rows are whole."""
    given = table(spark, SF_DIR, "documents")
    columns, docs, kept = given.columns, given, {"": {r.doc_id: r.text for r in rows}}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF_DIR))
        if name != "tokens":
            assert docs.columns == columns
            found = docs.collect()
            kept[name] = {r.doc_id: r.text for r in found}
            assert all(r.text == kept[""][r.doc_id] for r in found)
    quality, unique, clean, mixed = (kept[n] for n in ("quality", "near_duplicates", "decontaminate", "mix"))
    assert kept[""].keys() > quality.keys() > unique.keys() > clean.keys() >= mixed.keys() and mixed
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for i, t in quality.items() for w in [re.findall(WORD, t.lower())] if w}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    left = [i for i in unique if i in sets]
    assert not any(alike(a, b) for n, a in enumerate(left) for b in left[:n])
    gone = quality.keys() - unique.keys()
    assert all(any(alike(i, j) for j in quality if j != i and j in sets) for i in gone)
    hits = {r.doc_id for r in decontamination.op8_decontaminate(spark, SF_DIR).collect()}
    assert set(clean) == set(unique) - hits
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in found)

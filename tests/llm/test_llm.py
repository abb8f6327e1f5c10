"""Corpus operators against brute force, exact round trips and awkward rows."""

import collections
import hashlib
import textwrap
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from faultline.llm import (
    components, decontamination, gam, language, licenses, mixing, near_duplicates, quality_rules, repeats, substring_dedup, suffix_dedup, token_files,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, draws string, score string, _key int, n bigint"
WORDS = "the of and river stone market window seven paper light " * 9
EXTRA = (None, "x", "x", "x", 1, 1)


def _rows():
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(400)]
    prose = [" ".join(rng.choice(vocab, rng.integers(5, 90))) for _ in range(40)]
    texts = [*prose, *prose[:6], None, None, "", " \n\t ", "one", "One", "a b a b " * 40, "x" * 5000, WORDS * 60]
    texts += [p.replace("w1", "v1", 1) for p in prose[:8]]
    texts += [" ".join([prose[0], prose[1], prose[2]]), "shared " + WORDS + prose[3], "other " + WORDS + prose[4], "é" * 120 + " " + "é" * 120]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, *EXTRA) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, texts[1], None, None, *EXTRA), (None, None, None, None, *EXTRA)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _component_model(rows):
    """(id, size, smallest id reachable) of every row, each row a document of its own."""
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    part = list(range(len(rows)))
    for _ in rows:
        before = list(part)
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    part[a] = part[b] = min(part[a], part[b])
        if part == before:
            break
    least = {p: min([r[0] for r, q in zip(rows, part) if q == p and r[0] is not None], default=None) for p in part}
    return [(r[0], len(s), least[p]) for r, s, p in zip(rows, sets, part)]


def test_near_duplicates(docs, none):
    got = near_duplicates.linked(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, _component_model(_rows())))
    kept = near_duplicates.keep_first(docs)
    assert kept.columns == docs.columns
    rows = [r for r in _rows() if r[1] is not None]
    ids = [r.doc_id for r in kept.where("text is not null").collect()]
    model = _component_model(rows)
    assert sorted(ids) == sorted({c for _, n, c in model if n} | {i for i, n, _ in model if not n})
    assert kept.where("text is null").count() == sum(r[1] is None for r in _rows())
    assert near_duplicates.linked(none).count() == near_duplicates.keep_first(none).count() == 0


def test_links_of_any_ids(spark):
    """Ids at both ends of 64 bits, negative, absent and shared."""
    prose = [" ".join(f"{x}{k}" for k in range(40)) for x in "abcdef"]
    big = 1 << 62
    rows = [(big, prose[0]), (big + 5, prose[0] + " more"), (3, prose[1]), (2 * big - 1, prose[2]), (-2 * big, prose[2]), (None, prose[3]), (None, prose[3]),
            (None, prose[4]), (big + 1, prose[4]), (2 * big - 1, prose[5]), (2 * big - 1, ""), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = near_duplicates.linked(frame).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, _component_model(rows)))
    kept = {(r.doc_id, r.text) for r in near_duplicates.keep_first(frame).collect()}
    assert kept == {(big, prose[0]), (3, prose[1]), (-2 * big, prose[2]), (None, prose[3]), (big + 1, prose[4]), (2 * big - 1, prose[5]), (2 * big - 1, ""), (None, None)}


def test_a_family_of_near_copies_makes_few_rows(spark, monkeypatch):
    """2,000 copies of one text, each with its own edits: linked and unlinked ones, rows in proportion to the copies."""
    rng = np.random.default_rng(12)
    base = [f"w{k}" for k in range(220)]

    def copy(edits):
        words = list(base)
        for k in rng.choice(len(words), edits, replace=False):
            words[k] = f"x{rng.integers(1 << 40)}"
        return " ".join(words)

    rows = [(i, copy(2 if i % 2 else 12)) for i in range(2000)]
    counted, checked = [], near_duplicates.near

    def near(pairs, sets, percent):
        counted.append(pairs.count())
        out = checked(pairs, sets, percent)
        counted.append(out.count())
        return out

    monkeypatch.setattr(near_duplicates, "near", near)
    got = {r.doc_id: r.component_id for r in near_duplicates.linked(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()}
    assert max(counted) <= 2 * len(rows)
    close = [i for i in got if i % 2]
    assert len({got[i] for i in close}) == 1  # 2 edits change 10 of 216 shingles


def test_keep_first_keeps_unlike_rows_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(7, a), (7, b), (7, b), (8, b + " more"), (None, c), (None, c), (9, c), (None, None), (None, None), (10, None), (11, ""), (11, "x")]
    got = near_duplicates.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    left = [(7, a), (7, b), (9, c), (None, None), (None, None), (10, None), (11, ""), (11, "x")]
    assert sorted(map(repr, got)) == sorted(f"Row(doc_id={i!r}, text={t!r})" for i, t in left)


@settings(max_examples=60, deadline=None)
@given(st.integers(3, 700), st.integers(0, 200), st.integers(0, 10**6))
def test_linked_sets_share_a_lane(n, changed, seed):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, n + changed, dtype=np.uint64) * np.uint64(2))
    a, b = pool[:n], np.unique(np.concatenate([pool[: max(0, n - changed)], pool[n:]]))
    frequent = np.sort(rng.choice(pool, len(pool) // 3, replace=False))
    if len(b) and near_duplicates.alike(a, b, 75) and not np.array_equal(a, b):
        sent = [dict(zip(*(x.tolist() for x in near_duplicates.lane_keys(s, 75, frequent)))) for s in (a, b)]

        def admits(n, place, other):
            """The bounds of ``partner_sizes`` in whole numbers."""
            least = max(-(-n * 75 // 100), 7 * (-1 - place) - n if place < 0 else 0)
            most = (n - place) * 175 // 75 - n if place >= 0 else n * 100 // 75
            return least <= other <= most

        both = sent[0].keys() & sent[1].keys()
        assert any(admits(len(a), sent[0][k], len(b)) and admits(len(b), sent[1][k], len(a)) for k in both)


def test_partner_sizes(spark):
    rows = [(n, place) for n in (4, 20, 143, 300, 1001) for place in (0, 1, 3, n // 10, n // 4, -1, -2, -1 - n // 10, -1 - n // 4)]
    got = spark.createDataFrame(rows, "n int, place int").select("n", "place", *near_duplicates.partner_sizes(75)).collect()
    for n, place, low, high in map(tuple, got):
        assert low == max(-(-n * 75 // 100), 7 * (-1 - place) - n if place < 0 else 0)
        assert high == ((n - place) * 175 // 75 - n if place >= 0 else n * 100 // 75)


def test_pairs_across_blocks(spark, monkeypatch):
    """Blocks of a group meet each other and themselves once, and no pair within the bounds is lost."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    rng = np.random.default_rng(2)
    flat = ([0] * 16,)
    rows = [(sig, 100 * sig + k, int(rng.integers(5)), int(rng.integers(90, 110)), 92, 108, *flat) for sig in range(3) for k in range(15 * sig + 1)]
    left = spark.createDataFrame(rows, "sig bigint, id bigint, c bigint, n int, low int, high int, sketch array<bigint>").repartition(3)
    got = sorted(map(tuple, near_duplicates.pairs_across(left, 75).collect()))
    inside = [r for r in rows if 92 <= r[3] <= 108]
    assert got == sorted((x[1], y[1]) for x in inside for y in inside if x[0] == y[0] and x[1] < y[1] and x[2] != y[2])
    few = near_duplicates.pairs_across(left, 75, partners=2).collect()
    assert few and {tuple(r) for r in few} <= set(got)
    assert max(collections.Counter(r.a // 100 * 1000 + r.a % 100 for r in few).values()) <= 2 * 12  # two of each block that it meets


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(90, 3), (91, 3), (5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[60] == 57 and got[90] == 1 and got[6] == 1 and 5 in got and 57 not in got


def _repeat_model(rows, unit):
    seen, out = {}, {}
    for i, t in sorted({(i, t) for i, t, *_ in rows if i is not None}, key=lambda r: (r[0], r[1] or "")):
        content = unit.content(t.encode() if t is not None else None)
        n = unit.size(content)
        cuts, gone = unit.cuts(content), np.zeros(n, bool)
        for k in range(n - unit.window + 1):
            w = unit.piece(content, cuts, k, unit.window)
            if w in seen:
                gone[k : k + unit.window] = True
            seen.setdefault(w, 1)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if n else 0
        out[i] = n, int(gone.sum()), spans, hashlib.sha256(unit.without(content, gone) if n else b"").hexdigest()
    return out


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
@pytest.mark.parametrize("limit", [repeats.GROUP_BYTES, 300])
def test_repeats(docs, none, module, limit, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", limit)
    rows = [r for r in _rows() if r[0] is not None]
    table = docs.where("doc_id is not null")
    got = repeats.remove_repeats(table, module.UNIT, module.repeated_windows).collect()
    assert len(got) == len(rows)
    assert {r.id: (r.units, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == _repeat_model(rows, module.UNIT)
    if limit > 300:
        assert repeats.remove_repeats(docs, module.UNIT, module.repeated_windows).count() == docs.count()
        assert repeats.remove_repeats(none, module.UNIT, module.repeated_windows).count() == 0


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_repeats_of_any_ids(spark, module):
    """Ids at both ends of 64 bits, negative and absent: rows come in their order, those without an id last."""
    prose = " ".join(f"w{k}" for k in range(60))
    big = 1 << 62
    ids = [2 * big - 1, big, -2 * big, None, big + 5, None, 3, None]
    texts = [prose, prose + " a", "b " + prose, prose + " c", prose, "d " + prose, "e " + prose + " e", prose + " c"]
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(3)
    got = repeats.remove_repeats(frame, module.UNIT, module.repeated_windows).collect()
    by_id = {r.id: r for r in got if r.id is not None}
    assert sorted(by_id) == sorted(i for i in ids if i is not None) and len(got) == len(ids)
    assert by_id[-2 * big].n_removed == 0  # the first of all; what repeats in the others is its prose
    assert all(by_id[i].n_removed > 0 for i in by_id if i != -2 * big)
    assert all(r.n_removed > 0 for r in got if r.id is None)
    model = _repeat_model([r for r in zip(ids, texts) if r[0] is not None], module.UNIT)
    assert {i: (r.units, r.n_removed, r.n_spans, r.kept_sha256) for i, r in by_id.items()} == model


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(s):
    expected = sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_dedup.suffix_array(np.array(s, np.int64)).tolist() == expected


def test_language(spark, none):
    en, de = "the river and the window of the house that was there", "der Fluss und die Fenster des Hauses das nicht dort war"
    known = spark.createDataFrame([(en, "en"), (de, "de"), (None, "en"), ("x", None)], "text string, lang string")
    profiles = language.learn_profiles(known)
    assert list(profiles) == ["de", "en"]
    rows = spark.createDataFrame([(1, "the house and the river"), (2, "und das nicht der Fluss"), (3, None), (4, ""), (5, "12 %"), (1, "the house and the river")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.lang_pred) for r in language.identify(rows, profiles, [rows.doc_id]).collect())
    assert got == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und")]
    assert language.learn_profiles(none) == {}
    assert {r.lang_pred for r in language.identify(rows, {}, [rows.doc_id]).collect()} == {"und"}
    assert language.top_grams(np.array([5, 5, 3, 3, 9]), 2).tolist() == [3, 5]


def test_mixing(docs, none):
    for whole in (False, True):
        plan = mixing.plan_mix(docs, shards=5, rows_per_block=6, whole=whole)
        got = plan.collect()
        assert len(got) == docs.count()
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        assert sorted(map(str, got)) == sorted(map(str, plan.collect()))
        if not whole:
            sums = collections.defaultdict(int)
            for r in got:
                sums[r.source, r.target] += r.taken
            assert all(abs(n - t) <= 1 for (_, t), n in sums.items())
    assert mixing.plan_mix(none).count() == 0
    sizes = [100, 10, 50, 0]
    wanted = mixing.targets(sizes, [3, 1, 2, 3], 1.5, 2.0)
    assert abs(sum(wanted) - 240) < 1e-9 and all(t <= 2 * s for t, s in zip(wanted, sizes))


def test_split_tree_deals_every_draw_once():
    quotas = [7, 0, 30, 13]
    parts = [mixing.split_tree(quotas, 6, 1, k) for k in range(6)]
    for s, q in enumerate(quotas):
        assert sorted(x for first, n in parts for x in range(first[s], first[s] + n[s])) == list(range(q))
    assert max(n.sum() for _, n in parts) - min(n.sum() for _, n in parts) <= 2


def test_quality_rules(docs, none):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = quality_rules.judge(docs).collect()
    assert len(got) == docs.count()
    texts = {i: t or "" for i, t, *_ in _rows()}
    for r in (r for r in got if r.doc_id is not None):
        t = texts[r.doc_id]
        w = word.findall(t)
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        counts = collections.Counter(windows)
        repeated = {k + j for k, x in enumerate(windows) if counts[x] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if word.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(none).count() == 0


def test_quality_rules_of_any_number_of_languages(spark):
    from pyspark.sql import functions as F

    n = quality_rules.BROADCAST_LANGUAGES + 50
    text = F.concat(F.repeat(F.lit("plain words of a text "), 10), F.col("id").cast("string"))
    many = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.nullif(F.concat(F.lit("l"), "id"), F.lit("l7")).alias("lang"))
    apart = quality_rules.judge(many, least_reference=0)
    assert apart.agg(F.count("*"), F.count("word_distance"), F.round(F.max("word_distance"), 6), F.sum("n_words")).first() == (n, n, 0.0, 51 * n)


@pytest.mark.parametrize("chars", [quality_rules.BROADCAST_CHARS, 0])
def test_quality_rules_count_words_of_every_length(spark, monkeypatch, chars):
    monkeypatch.setattr(quality_rules, "BROADCAST_CHARS", chars)
    text = lambda words: " ".join(f"{words} number{k:02}" for k in range(30))
    usual, other = text("kirjoittaa luetella valmistaa kuljettaa"), text("omenapuu sadekuuro lentokone tietokone")
    rows = [(k, usual, "fi") for k in range(50)] + [(50, other, "fi"), (51, other, None)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == len(rows) and not any(r.base_failed for r in got.values())
    assert all(r.word_distance < 0.1 and r.kept for k, r in got.items() if k != 50)
    assert got[50].word_distance > quality_rules.WORD_BOUND and not got[50].kept


def test_licenses(spark, none):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t)
    rows = [
        (1, "Copyright (c) 2020 A. Person\n" + mit.upper().replace(",", " ;")), (2, "prose\nreleased under the MIT licence!\nmore"),
        (3, None), (4, ""), (5, "© someone"), (2, "prose\nreleased under the MIT licence!\nmore"), (6, "Licensed under CC BY-NC 4.0."),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), licenses.known_licenses(spark)).collect()
    found = {r.doc_id: (r.license, r.n_license_lines, r.line_licenses) for r in got}
    assert len(got) == len(rows)
    assert found == {1: ("MIT", 0, []), 2: (None, 1, ["MIT"]), 3: (None, 0, []), 4: (None, 0, []), 5: (None, 0, []), 6: ("CC-BY-NC-4.0", 1, ["CC-BY-NC-4.0"])}
    assert licenses.scan(none, licenses.known_licenses(spark)).count() == 0


BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _wraps(text):
    return [textwrap.fill(" ".join(text.split()), w, break_long_words=False, break_on_hyphens=False) for w in (18, 31, 40, 60, 72, 78, 79, 80, 100, 120)] + [" ".join(text.split())]


def test_license_texts_in_any_wrap(spark):
    texts = {("MIT", t) for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t} | {("ISC", t) for n, t in licenses.KNOWN if n == "ISC"}
    texts |= {("BSD-2-Clause", BSD_2)}
    known = spark.createDataFrame(sorted(texts), "license string, text string")
    rows = [(n, x) for n, t in texts for w in _wraps(t) for x in (w, w.upper(), "Copyright (c) 2020 A. Person\n" + w, "# Copyright Acme Ltd.\n# " + w.replace("\n", "\n# "))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string"), known).collect()
    assert len(got) == len(rows) and all(r.license == r.doc_id for r in got)


def test_whole_licenses_and_headers(spark):
    known = licenses.full_texts()
    assert len(known) < 10_000
    apache = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t)
    bsd_3 = BSD_2.replace("\n\nTHIS", "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
                          " derived from this software without specific prior written permission.\n\nTHIS")
    gpl = (licenses._TEXTS / "GPL-2.0.txt").read_text()
    notice = gpl[gpl.index("    This program is free software; you") : gpl.index("Also add information")]
    end = (licenses._TEXTS / "Apache-2.0.txt").read_text()
    rows = [
        ("BSD-2-Clause", BSD_2), ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2021, Some Body\nAll rights reserved.\n\n" + bsd_3),
        ("MIT", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + mit), ("Apache-2.0", "# Copyright 2020 Some Body\n#\n# " + apache.replace("\n", "\n# ")),
        ("Apache-2.0", end[end.index('   Licensed under the Apache License, Version 2.0 (the "License");') :]), ("GPL-2.0-or-later", notice), ("GPL-2.0", gpl),
        (None, gpl[: len(gpl) // 2]), (None, "prose " + BSD_2),
    ]
    rows += [(f.stem, x) for f in licenses._TEXTS.glob("*.txt") for x in (f.read_text(), f.read_text().upper(), f.read_text().replace("\n", "\r\n"))]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    got = licenses.scan(table, licenses.known_licenses(spark)).collect()
    assert len(got) == len(rows) and [(r.doc_id, r.license) for r in got if r.license != r.doc_id] == []


def test_statements_leave_the_rest_of_their_line(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and "Permission" in t)
    apache = licenses.full_texts()
    apache = next(t for n, t in apache if n == "Apache-2.0" and t.startswith("Licensed under the"))
    notice = "Licensed under the MIT License."
    lines = [
        f"Copyright 2020 X. {notice}", f"# Copyright (c) 2019-2021 A. B. Person, Acme Inc. All rights reserved. {notice}", f"(c) 2020 Acme Ltd; {notice}",
        f"© Acme | {notice}", f"Copyright Acme Corp. {notice}", f"Copyright 2020 - Acme and others - {notice}", f"{notice} Copyright 2020 X.", f"Copyright © 2020 Acme {notice}",
    ]
    rows = [("MIT 1", x) for x in lines] + [(None, "Copyright 2020 Acme Inc. and its friends."), ("None 1", "prose\n" + lines[0] + "\nmore prose")]
    rows += [(None, "Copyright 2020 X\nprose\n" + "Some words. Released to nobody.")]
    whole = f"The MIT License Copyright (c) 2020 A. Person and some more words of a holder Permission{mit.removeprefix('Permission')}"
    rows += [("MIT", x) for x in _wraps(whole)] + [("MIT 0", mit + "\nCopyright 2020 Acme")]
    rows += [("Apache-2.0", x) for x in _wraps(f"Copyright 2020 The Some Body Foundation, Inc. All rights reserved. {apache}")]
    gpl = (licenses._TEXTS / "GPL-2.0.txt").read_text()
    rows += [("GPL-2.0", x) for x in _wraps(gpl)] + [("LGPL-3.0", x) for x in _wraps((licenses._TEXTS / "LGPL-3.0.txt").read_text())]
    rows += [("Apache-2.0", x) for x in _wraps((licenses._TEXTS / "Apache-2.0.txt").read_text())] + [("None 0", "x Copyright 2020 " * 100_000)]
    got = licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string"), licenses.known_licenses(spark)).collect()
    wrong = [(r, rows[r.doc_id][1][:200]) for r in got if (rows[r.doc_id][0] or "None 0") not in (r.license, f"{r.license} {r.n_license_lines}")]
    assert len(got) == len(rows) and wrong == []


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.Gam().fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_quality(spark, docs, none):
    rows = [(i, ("good plain words in a line " * 6) if i % 2 else "b@d $$$ %%% ### " * 9) for i in range(400)]
    table = spark.createDataFrame(rows + [(None, None), (400, ""), (401, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (3, None), (5, 1)], "doc_id bigint, quality int")
    model = gam.fit_quality(gam.learnable(table), labels)
    got = gam.score_quality(table, model, [table.doc_id]).collect()
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 403
    assert all((r.score >= 0.7) == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 400)
    assert gam.keep_quality(table, labels).columns == table.columns
    assert gam.fit_quality(docs, labels.limit(0)) is None
    assert gam.score_quality(none, None, [none.doc_id]).count() == 0


def test_quality_without_labels_keeps_all_rows(docs):
    labels = docs.sparkSession.createDataFrame([(10**9, 1), (10**9 + 1, 0), (None, 1)], "doc_id bigint, quality int")
    for unusable in (labels, labels.limit(0)):
        with pytest.warns(UserWarning, match="no label"):
            assert gam.keep_quality(docs, unusable).count() == docs.count() > 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20), st.integers(0, 5))
def test_bit_parallel_distance(pattern, text, budget):
    row = _distance(pattern, text)[1:]
    best = min(row, default=99)
    expected = (best, row.index(best) + 1) if best <= budget else None
    assert decontamination.nearest_end(pattern, text, budget) == expected


def test_decontamination(spark, docs, none):
    item = "which river flows past the old market and under seven stone bridges before the sea"
    edited = item.replace("seven", "sevn").upper()
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "short one")], "item_id bigint, text string")
    rows = [(1, f"x {item}. y"), (2, f"%% {edited} !!"), (3, "clean text about a river and a market " * 5), (4, None), (5, ""), (1, f"x {item}. y"), (6, "short one")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontamination.matches(table, bench).collect())
    assert got == [(1, 1, 0), (1, 1, 0), (1, 2, 0), (1, 2, 0), (2, 1, 1), (2, 2, 1)]
    assert sorted(got) == sorted((r.doc_id, r.item_id, r.distance) for r in decontamination.matches(table, bench, chars=20).collect())
    assert sorted(r.doc_id for r in decontamination.clean(table, bench).collect()) == [3, 4, 5, 6]
    assert decontamination.clean(docs, bench).count() == docs.count()
    assert decontamination.matches(none, bench).count() == 0 and decontamination.matches(table, bench.limit(0)).count() == 0


def test_short_items_match_whole(spark, tmp_path):
    bench = [(1, "Who wrote Faust?"), (2, "北京是中国的首都吗"), (3, ""), (4, None), (5, "ox"), (6, "Who wrote Faust?")]
    rows = [(1, "Q: who wrote FAUST -- Goethe"), (2, "he who wrote fausty things"), (3, "问：北京是中国的首都吗？是的，北京是中国的首都吗"), (4, "an oxen, a fox"), (5, "an ox."), (6, None), (7, "who wrote faus")]
    rows += [(8, "我说北京是中国的首都吗对")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.item_id, r.distance, r.end) for r in decontamination.op8_decontaminate(spark, str(tmp_path)).collect())
    assert got == [(1, 1, 0, 17), (1, 6, 0, 17), (3, 2, 0, 11), (5, 5, 0, 5), (8, 2, 0, 11)]
    assert sorted(r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()) == [2, 4, 6, 7]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.lists(st.integers(0, 2**20 - 1), min_size=1, max_size=50), st.data())
def test_packing(bits, ids, data):
    ids = np.array(ids) & ((1 << bits) - 1)
    first = data.draw(st.integers(0, len(ids) - 1))
    count = data.draw(st.integers(0, len(ids) - first))
    payload = token_files.pack(ids, bits)
    assert len(payload) == (len(ids) * bits + 7) // 8
    assert token_files.unpack(payload, bits, first, count).tolist() == ids[first : first + count].tolist()


def test_token_files(spark, docs, none, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs, path, block_ids=500)
    got = sorted((tuple(r) for r in token_files.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in _rows()), key=lambda i: (i is not None, i or 0))
    tok, texts = Tokenizer.from_file(token_files.TOKENIZER), {r[0]: r[1] for r in _rows()}
    stream = []
    for doc_id, start, n, crc in got:
        assert start == len(stream)
        if doc_id is not None:
            ids = tok.encode(texts[doc_id] or "", add_special_tokens=False).ids + [token_files.END_ID]
            assert (n, crc) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            stream += ids
        else:
            stream += [None] * n
    part = token_files.read_ids(spark, path, 700, 900).tolist()
    assert [x for x, y in zip(part, stream[700:1600]) if y is not None and x != y] == []
    assert token_files.round_trip(none).count() == 0


def test_words_encode_as_whole_texts():
    tok = Tokenizer.from_file(token_files.TOKENIZER)
    words = token_files.WordTokenizer(token_files.TOKENIZER, cached=4)
    texts = ["It's DON'T été Σς <|endoftext|> a b  x 12,5% 日本語 ﬁ é", "", "a  b\t\nc", "\x1c \x85 z"]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in words.encode([t.encode() for t in texts])]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


_TOKENIZER, _WORDS = Tokenizer.from_file(token_files.TOKENIZER), token_files.WordTokenizer(token_files.TOKENIZER, cached=50)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aBcsStTreVEmlLD'’.,!?-_0123 \n\t\u0301\u030cjJéÉİßΣςŁŽſµªÿ你ก\u200d\x1c\xa0", max_size=16) | st.text(max_size=12) | st.lists(st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", "a", "B.", " ", "é", "'s", "endoftext"]), max_size=7).map("".join))
def test_any_text_encodes_as_the_library_does(text):
    text = text.encode("utf-8", "replace").decode()
    expected = _TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_WORDS.encode([text.encode()])[0], "<u4").tolist() == expected
    assert _WORDS.parts


def test_pipeline_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]
    copies = corpus_pipeline.mix(spark, docs, "")
    assert copies.columns == docs.columns and copies.count() > 0

"""Filter audit, Merkle manifest and private data against plain sequential models."""

import hashlib
import itertools
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.llm import filter_audit, merkle, private_data

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, pos int, digest string, part string, "
    "fails int, _row int, base string, nodes int, good boolean, _at int, block int, n int"
)
EXTRA = ("x", 1, "x", "x", 1, 1, "x", 1, True, 1, 1, 1)


def _rows():
    prose = [" ".join(f"w{(i * 7 + k * k) % (90 + 9 * i)}" for k in range(60 + 12 * i)) for i in range(14)]
    texts = [*prose, *prose[:5], prose[3], None, None, "", " \n\t ", "A B C\nD", "LOUD WORDS " * 70, "a\nb\nc " * 400, "x" * 60_000, "é$ " * 120]
    texts += ["same\ntext"] * 30
    rows = [(i, t, [None, "", "en", "de"][i % 4], [None, "", "hot", "hot", "hot", "é", "z"][i % 7], len(t or "") if i % 5 else None, *EXTRA) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[2], (None, prose[1], "en", "hot", 3, *EXTRA), (None, None, None, None, None, *EXTRA), (-4, prose[0], "en", "hot", 1, *EXTRA)]


LABELS = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(0, 40)] + [(1, 0, 1), (2, None, None), (None, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# Filter audit


def _audit_model(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    judged = []
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": smaller,
        }
        judged.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        mine = [x for x in judged if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, x in enumerate(order):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                failing = sum(x in d[1] for d in mine)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), failing - len(gone), sum(d[1] == {x} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone), x]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shapley[row[6]]
    return out


def test_filter_audit_equals_running_every_order(docs, labels):
    got = filter_audit.orders(filter_audit.survivors(filter_audit.judge(docs), labels)).collect()
    assert {tuple(r[:3]): list(r[3:]) for r in got} == _audit_model(_rows(), LABELS)
    assert len(got) == 600 * 3


def test_filter_audit_of_empty_tables(docs, labels, none):
    assert filter_audit.orders(filter_audit.survivors(filter_audit.judge(none), labels)).count() == 0
    got = filter_audit.orders(filter_audit.survivors(filter_audit.judge(docs), labels.limit(0)))
    assert got.agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0] == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_carry_save_popcount(words):
    expected = [sum(w >> k & 1 for w in words) for k in range(32)]
    assert filter_audit.positional_popcount(np.array(words, np.uint64)).tolist() == expected


def test_survival_words_say_which_sets_a_document_survives():
    words = filter_audit.survival_words()
    for fails, s in itertools.product(range(32), range(32)):
        assert bool(int(words[fails]) >> s & 1) == (fails & s == 0)


# Merkle manifest


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    i, _, lang, source, n = row[:5]
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _sha(*(code(v) for v in (i, source, lang, n, text)))


def _paths(level):
    """Root and, for each leaf, its (left, right) siblings up to it."""
    at, paths = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i - i % 3
            paths[k].append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        level = [_sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def _manifest_model(rows):
    by = {}
    for r in rows:
        text = r[1]
        touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, _leaf(r, text), _leaf(r, text.replace("\n", "") if touched else text), r[0]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _paths([x[2] for x in sorted(by[s], key=lambda x: x[:4])]) for s in order}
    root, top = _paths([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, top):
        for (*_, leaf, seen, i), path in zip(sorted(by[s], key=lambda x: x[:4]), trees[s][1]):
            path = path + above
            folded = seen
            for left, right in path:
                folded = _sha(left, folded, right)
            out.append((i, leaf, trees[s][0], root, _sha(*(x for pair in path for x in pair)), folded, folded == root))
    return out


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_plain_trees(docs, height):
    """Blocks of 3, 9 and 729 leaves: sources of one row, of one block, and of several layers."""
    got = merkle.manifest(docs, merkle.without_breaks(), height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, _manifest_model(_rows())))


def test_manifest_of_one_hot_source(spark):
    rows = [(i, f"t{i}", None, "one", i) for i in range(3000)]
    got = merkle.manifest(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), height=3)
    assert sorted(map(tuple, got.collect())) == sorted((*m[:5], m[3], True) for m in _manifest_model(rows))


def test_manifest_of_an_empty_table(none):
    assert merkle.manifest(none, merkle.without_breaks()).count() == 0


@pytest.mark.parametrize("levels", range(1, 8))
def test_layout_is_van_emde_boas(levels):
    at = merkle.layout(levels)
    assert sorted(np.concatenate(at).tolist()) == list(range((3**levels - 1) // 2))

    def walk(depth, index, n):
        """Addresses of a complete subtree, in the order that the definition gives."""
        if n == 1:
            return [int(at[depth][index])]
        upper = n // 2
        out = walk(depth, index, upper)
        for k in range(3**upper):
            out += walk(depth + upper, index * 3**upper + k, n - upper)
        return out

    assert walk(0, 0, levels) == list(range((3**levels - 1) // 2))


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 10, 26, 27])
def test_stored_subtree_gives_back_its_levels_and_siblings(leaves):
    digests = [hashlib.sha256(bytes([k])).digest() for k in range(leaves)]
    height = merkle.height_of(leaves)
    nodes = merkle.build_block(digests, height)
    root, paths = _paths([d.hex() for d in digests])
    assert nodes[:32].hex() == root
    assert merkle.read_level(nodes, leaves, height, 0) == [d.hex() for d in digests]
    assert [list(zip(*x)) for x in merkle.siblings(nodes, leaves, height)] == paths


# Private data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base_model(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and private_data.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if ok():
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+- ()_%é4\n", max_size=60))
@example("a@b.c_d@e.f@g.h a@@b.c x@y. -@-.-.")
@example("1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3.4000")
@example("4111111111111111 4111-1111 1111-1111 1 +1 (743) 555-3824 +12345678 +123456789..")
def test_base_spans_are_those_of_the_patterns(text):
    assert private_data.base_spans(text) == _base_model(text)


def test_luhn():
    assert private_data.luhn("4111111111111111") and not private_data.luhn("4111111111111112")


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "+1", "1 ", ".", "(at)", "1-", "a@b.", "+1-", " ", "é"])
def test_scan_time_is_linear(unit):
    def seconds(n):
        text = unit * n
        start = time.perf_counter()
        private_data.candidates(text, private_data.base_spans(text))
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(400_000 // len(unit)) < 20


def _planted():
    """Seeds in shared contexts, unknown identifiers in the same ones, and the same makes elsewhere."""
    rows = []
    for k in range(12):
        rows.append(f"news {k} of the day. Please write to ann{k}@mail{k}.example.com about river {k} stones")
        rows.append(f"today we say call me at +1 (743) 555-{3824 + k} or leave a note {k}")
        rows.append(f"the old server address: 10.0.{k}.7 was moved")
    rows.append("once more Please write to zoe.q (at) mail7 (dot) example (dot) com about nothing")
    rows.append("again Please write to root@localhost about nothing")
    rows.append("yes call me at (743) 555 9911 or not")
    rows.append("the new server address: 10.0.999.7 was lost")
    clean = [f"lot {k} has order number 7435550{k:03d} in the list and version 1.2.{k}.x of it, mail @home {k}" for k in range(25)]
    return rows, clean


def test_contexts_find_what_the_patterns_miss(spark):
    rows, clean = _planted()
    texts = rows + clean + clean + [rows[0]] * 500  # copies of a document add no evidence
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(7)
    found = {r.doc_id: [(texts[r.doc_id][s.start : s.end], private_data.KINDS[s.kind]) for s in r.added] for r in private_data.find(docs).collect()}
    assert len(found) == len(texts)
    assert {k: v for k, v in found.items() if v} == {
        36: [("zoe.q (at) mail7 (dot) example (dot) com", "email")], 37: [("root@localhost", "email")],
        38: [("(743) 555 9911", "phone")], 39: [("10.0.999.7", "ip")],
    }


def _bootstrap_model(edges, support, confidence, rounds=50):
    """The same scores with plain loops: edges are (pattern, kind, value, seed)."""
    seeds = {(k, v) for _, k, v, s in edges if s}
    of = {}
    for p, k, v, _ in edges:
        of.setdefault(p, set()).add((k, v))
    found = {}
    for _ in range(rounds):
        known = found | dict.fromkeys(seeds, 1.0)
        sure = {}
        for p, nodes in of.items():
            for kind in {k for k, _ in nodes}:
                mine = [known[x] for x in nodes if x[0] == kind and x in known]
                most = len({v for _, v in nodes}) - 0.5 * sum(x[0] == kind and x not in known for x in nodes)
                if len(mine) >= support and sum(mine) >= confidence * most:
                    sure[p, kind] = sum(mine) / (most + 1)
        now = {}
        for x in {x for nodes in of.values() for x in nodes} - seeds:
            doubt = 1.0
            for p, nodes in of.items():
                if x in nodes:
                    doubt *= 1 - sure.get((p, x[0]), 0)
            if 1 - doubt >= confidence * support / (support + 1):
                now[x] = 1 - doubt
        grown, found = len(now) != len(found), now
        if not grown:
            break
    return found


def test_bootstrap_equals_plain_loops(spark):
    rng = np.random.default_rng(5)
    edges = {}
    for _ in range(700):
        p = int(rng.integers(40))
        v = 4 * int(rng.integers(50)) + (p if rng.random() < 0.97 else int(rng.integers(4))) % 4
        edges[f"p{p}", v % 4, f"v{v}"] = v // 4 % 5 < 4
    rows = [(*x, seed) for x, seed in edges.items()]
    frame = spark.createDataFrame(rows, "pattern string, kind int, value string, seed boolean")
    got = {(r.kind, r.value): r.score for r in private_data.bootstrap(frame, rounds=50).collect()}
    model = _bootstrap_model(rows, private_data.SUPPORT, private_data.CONFIDENCE)
    assert len(model) > 5 and got == pytest.approx(model)


def test_private_data_of_awkward_rows(spark, docs, none):
    got = private_data.find(docs).collect()
    assert len(got) == docs.count()
    assert private_data.find(none).count() == 0
    rows = [(None, "a@b.cd"), (None, None), (1, ""), (1, "a@b.cd"), (1, "a@b.cd"), (2, "+1 234 567 8901 " * 9000)]
    found = private_data.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), len(r.base)) for r in found) == [("1", 0), ("1", 1), ("1", 1), ("2", 9000), ("None", 0), ("None", 1)]

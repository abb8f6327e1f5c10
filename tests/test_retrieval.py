"""Vector, keyword and hybrid retrieval against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import INCIDENT_SCHEMA
from faultline.functions.vectors import cosine
from faultline.operators import logs as logs_ops
from faultline.operators import nearest, retrieval
from test_text import model_keywords

AS_OF = "2024-01-10 00:00:00"
NOW = dt.datetime(2024, 1, 10)
LOGS = "log_id bigint, timestamp timestamp_ntz, log_line string, template_id bigint, embedding array<float>"
WORDS = ["error", "auth", "oauth", "disk", "timeout", "nginx", "of", "ab_cd", "connection", "connectionpool", "7"]


def corpus(n=300, seed=5, dim=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = NOW - dt.timedelta(minutes=rng.randint(0, 3000))
        vector = [float(rng.choice([-1, 0, 1, 2])) for _ in range(dim)]
        if i % 17 == 0:
            vector = None
        elif i % 19 == 0:
            vector = [1.0] * (dim + 1)
        # One template holds a third of the logs.
        template = 0 if rng.random() < 0.33 else rng.randint(1, 20)
        rows.append((i, at, " ".join(rng.choices(WORDS, k=5)), template, vector))
    return rows


def similarity(a, b):
    x, y = np.array(a, float), np.array(b, float)
    norm = np.linalg.norm(x) * np.linalg.norm(y)
    return round(float(x @ y / norm), 9) + 0.0 if norm else 0.0


def brute_nearest(rows, query, k, since=dt.datetime.min):
    scored = [
        (similarity(query, v), at, i) for i, at, _, _, v in rows if v is not None and len(v) == len(query) and at >= since
    ]
    scored.sort(key=lambda r: (-r[0], -(r[1] - dt.datetime(1970, 1, 1)).total_seconds(), r[2]))
    return [(i, s) for s, _, i in scored[:k]]


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_nearest_equals_brute_force(make, block_bytes):
    rows = corpus()
    rng = random.Random(1)
    queries = [(q, [float(rng.randint(-2, 2)) for _ in range(4)], NOW - dt.timedelta(minutes=300 * q)) for q in range(1, 8)]
    queries.append((99, [0.0] * 4, NOW - dt.timedelta(days=9)))
    queries.append((100, None, NOW))
    queries.append((101, [1.0] * 5, NOW - dt.timedelta(days=9)))
    asked = make("query_id bigint, embedding array<float>, cutoff timestamp_ntz", queries)
    hits = retrieval.semantic_topk(make(LOGS, rows).repartition(5), asked, 6, block_bytes).orderBy("query_id", "rank").collect()
    for q, vector, since in queries:
        got = [(h["log_id"], h["similarity"]) for h in hits if h["query_id"] == q]
        assert got == (brute_nearest(rows, vector, 6, since) if vector else [])


def test_cosine_edge_cases(make):
    rows = make("i int, a array<float>, b array<float>", [
        (0, [3.0, 4.0], [3.0, 4.0]), (1, [0.0, 0.0], [1.0, 1.0]), (2, [1.0], [1.0, 2.0]), (3, [1.0, 0.0], [-1.0, 0.0]),
    ])
    got = [r[0] for r in rows.orderBy("i").select(F.round(cosine(F.col("a"), F.col("b")), 9)).collect()]
    assert got == [1.0, 0.0, None, -1.0]


def brute_words(rows, word, n, since=dt.datetime.min):
    found = [(at, i) for i, at, line, _, _ in rows if at >= since and any(word in k for k in model_keywords(line)[:20])]
    return [i for _, i in sorted(found, key=lambda r: (-(r[0] - dt.datetime(1970, 1, 1)).total_seconds(), r[1]))[:n]]


def test_newest_per_word_equals_brute_force(make):
    rows = corpus()
    asked = ["auth", "conn", "connection", "connectionpool", "connectionpools", "err", "the", "tim"]
    got = retrieval.newest_per_word(make("word string", [(w,) for w in asked]), make(LOGS, rows), 4)
    found = {}
    for r in got.orderBy(F.desc("timestamp"), "log_id").collect():
        found.setdefault(r["word"], []).append(r["log_id"])
    assert found == {w: b for w in asked if (b := brute_words(rows, w, 4))}


def brute_retrieve(rows, request, k):
    """request: (template, text, vector, since)"""
    template, query, vector, since = request
    by_id = {r[0]: r for r in rows}
    hits = {}
    for i, at, _, t, _ in rows:
        if template is not None and t == template and at >= since:
            hits[i] = (0.9, 0, 0)
    near = brute_nearest(rows, vector, k, since) if vector else []
    for i, s in near:
        if i not in hits or s > hits[i][0]:
            hits[i] = (s, 1, 0)
    if not hits:
        for p, w in enumerate([w for w in query.lower().split() if w.isalpha() and len(w) >= 3][:3]):
            for i in brute_words(rows, w, 5, since):
                hits.setdefault(i, (0.5, 2, p))
    order = sorted(
        hits.items(), key=lambda h: (-h[1][0], h[1][1], h[1][2], -(by_id[h[0]][1] - dt.datetime(1970, 1, 1)).total_seconds(), h[0])
    )
    return [(i, v[0], ["template", "semantic", "keyword"][v[1]]) for i, v in order[:k]]


def test_hybrid_equals_brute_force(make):
    rows = corpus()
    rng = random.Random(2)
    requests = {}
    for q in range(12):
        template = rng.choice([0, 0, 5, 77, None])
        vector = [float(rng.randint(-1, 2)) for _ in range(4)] if q % 3 else None
        requests[q] = (template, "auth connection timeout nginx", vector, NOW - dt.timedelta(minutes=rng.choice([60, 1000, 5000])))
    table = make(
        "request_id bigint, template_id bigint, query_text string, embedding array<float>, cutoff timestamp_ntz",
        [(q, t, text, v, since) for q, (t, text, v, since) in requests.items()],
    )
    hits = retrieval.retrieve(table, make(LOGS, rows), 5).orderBy("request_id", "rank").collect()
    for q, request in requests.items():
        got = [(h["log_id"], h["similarity"], h["retrieval_method"]) for h in hits if h["request_id"] == q]
        assert got == brute_retrieve(rows, request, 5), request


def test_retrieval_without_vectors(make):
    rows = make(LOGS, corpus()).drop("embedding")
    requests = make("request_id bigint, template_id bigint, query_text string, cutoff timestamp_ntz", [
        (1, 0, "x", NOW - dt.timedelta(days=9)), (2, None, "nothing matches", NOW - dt.timedelta(days=9)), (3, None, "oauth", NOW),
    ])
    hits = retrieval.retrieve(requests, rows, 4).collect()
    assert {h["request_id"] for h in hits} <= {1, 3}
    assert sum(h["request_id"] == 1 for h in hits) == 4


def test_incident_context_and_window_summary(make):
    rows = make(LOGS, [
        (1, NOW - dt.timedelta(minutes=30), "ERROR disk full", 7, [1.0, 0.0]),
        (2, NOW - dt.timedelta(minutes=20), "ERROR disk slow", 7, [0.0, 1.0]),
        (3, NOW - dt.timedelta(hours=3), "ERROR disk old", 7, [1.0, 0.0]),
    ])
    incidents = make(INCIDENT_SCHEMA + ", embedding array<float>", [
        (10, NOW - dt.timedelta(minutes=29), None, "ERROR disk full", None, "open", [1.0, 0.0]),
        (11, NOW - dt.timedelta(minutes=5), None, "never logged", "", "open", None),
    ])
    ctx = {r["incident_id"]: r for r in retrieval.incident_context(incidents, rows, AS_OF, 1).collect()}
    assert ctx[10]["context_text"].split("\n") == [
        "[2024-01-09T23:30:00.000000] ERROR disk full (retrieved via semantic)",
        "[2024-01-09T23:40:00.000000] ERROR disk slow (retrieved via template)",
    ]
    assert ctx[10]["fallback_summary"] == "Incident detected: ERROR disk full. Related events found: 2"
    assert ctx[11]["n_related"] == 0
    hours = make("hours int", [(1,), (24,), (0,), (1,)])
    got = {r["hours"]: r for r in retrieval.window_summary(incidents, rows, hours, AS_OF).collect()}
    assert sorted(got) == [0, 1, 24]
    assert got[0]["fallback_summary"] == "No incidents found in the last 0 hour(s)"
    assert (got[1]["n_incidents"], got[1]["n_context"], got[24]["n_context"]) == (2, 2, 3)
    assert got[1]["incidents_text"] == "- never logged\n- ERROR disk full"


def test_embed_logs_is_unit_length(make):
    rows = make("log_id bigint, log_line string", [(1, "disk error on disk"), (2, "12 34")])
    got = {r["log_id"]: np.array(r["embedding"]) for r in retrieval.embed_logs(rows, dim=16).collect()}
    assert abs(np.linalg.norm(got[1]) - 1) < 1e-6 and not got[2].any() and len(got[2]) == 16


def test_dedup_first_seen(make):
    hits = make("log_id bigint, seq int", [(5, 3), (5, 1), (6, 2), (7, 4), (5, 9)])
    got = logs_ops.dedup_first_seen(hits, [F.col("seq")], 2).collect()
    assert [(r["log_id"], r["seq"]) for r in got] == [(5, 1), (6, 2)]


def test_counts_by_hours(make):
    rows = make("at timestamp_ntz", [(NOW - dt.timedelta(minutes=m),) for m in (-90, 0, 30, 60, 61, 600)])
    hours = make("hours bigint", [(h,) for h in (-100, -2, -1, 0, 1, 2, 10, 9999, 10**9)])
    got = dict(map(tuple, retrieval.counts_by_hours(rows, "at", hours, AS_OF, "n").collect()))
    assert got == {-100: 0, -2: 0, -1: 1, 0: 2, 1: 4, 2: 5, 10: 6, 9999: 6, 10**9: 6}
    empty = retrieval.counts_by_hours(rows.limit(0), "at", hours, AS_OF, "n").collect()
    assert {r["n"] for r in empty} == {0} and len(empty) == 9


def test_nearest_skips_broken_vectors_and_merges_equal_queries(make):
    broken = [[float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], None]
    good = [(i, NOW, [1.0, i / 10]) for i in range(20)]
    bad = [(100 + i, NOW, v) for i, v in enumerate(broken * 3)]
    rows = make("log_id bigint, timestamp timestamp_ntz, embedding array<float>", good + bad)
    asked = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), *[(10 + i, v) for i, v in enumerate(broken)]]
    hits = retrieval.semantic_topk(rows, make("query_id bigint, embedding array<float>", asked), k=5).collect()
    assert sorted((r["query_id"], r["rank"], r["log_id"]) for r in hits) == [(q, i + 1, i) for q in (1, 2) for i in range(5)]
    assert retrieval.semantic_topk(rows, make("query_id bigint, embedding array<float>", asked[2:]), k=5).collect() == []


def _clustered(n=1500, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = centres[rng.integers(12, size=n)] + 0.4 * rng.normal(size=(n, dim))
    return [(i, NOW - dt.timedelta(minutes=i), [float(x) for x in row]) for i, row in enumerate(rows)]


def test_index_recall_and_exact_way(make, spark, tmp_path):
    rows = _clustered() + [(9000, NOW, None), (9001, NOW, [float("nan")] * 16)]
    table = make("log_id bigint, timestamp timestamp_ntz, embedding array<float>", rows).repartition(6)
    asked = table.where("log_id % 20 = 0").selectExpr("log_id AS query_id", "embedding", "timestamp - INTERVAL 3 HOURS AS cutoff")
    exact = {(r["query_id"], r["rank"]): r["log_id"] for r in nearest.nearest(table, asked, 10).collect()}
    index = nearest.build_index(table, str(tmp_path), lists=24, sample_rows=300)
    assert index.logs.count() == 1500  # fitted on a sample, but every vector is in a list
    assert 1 <= index.probes < 24
    found = {(r["query_id"], r["rank"]): r["log_id"] for r in nearest.VectorIndex(spark, str(tmp_path)).search(asked, 10).collect()}
    pairs = {(q, i) for (q, _), i in exact.items()}
    assert len(pairs & {(q, i) for (q, _), i in found.items()}) >= 0.9 * len(pairs)
    whole = {(r["query_id"], r["rank"]): r["log_id"] for r in index.search(asked, 10, probes=24).collect()}
    assert whole == exact


def test_index_of_odd_tables(make, spark, tmp_path):
    schema = "log_id bigint, timestamp timestamp_ntz, embedding array<float>"
    none = nearest.build_index(make(schema, [(1, NOW, None)]), str(tmp_path / "none"))
    assert none.search(make("query_id bigint, embedding array<float>", [(1, [1.0, 2.0])])).count() == 0
    with pytest.raises(ValueError):
        nearest.build_index(make(schema, [(1, NOW, [1.0]), (2, NOW, [1.0, 2.0])]), str(tmp_path / "mixed"))
    same = nearest.build_index(make(schema, [(i, NOW, [1.0, 0.0]) for i in range(30)]), str(tmp_path / "same"), lists=8)
    hits = same.search(make("query_id bigint, embedding array<float>", [(7, [2.0, 0.0]), (8, [1.0])]), k=4).collect()
    assert sorted((r["query_id"], r["log_id"]) for r in hits) == [(7, 0), (7, 1), (7, 2), (7, 3)]


def test_many_queries_read_the_vectors_once(make):
    rows = make("log_id bigint, timestamp timestamp_ntz, embedding array<float>", _clustered(200))
    asked = make("query_id bigint, embedding array<float>", [(i, v) for i, _, v in _clustered(120, seed=9)])
    many = nearest.nearest(rows, asked, 3, block_bytes=2000)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, nearest.nearest(rows, asked, 3).collect()))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("timestamp#") <= 4  # one scan of the logs, whatever the blocks


# The grid of many queries


def _logs_sent(monkeypatch) -> list:
    sent, meet = [], nearest._meet
    monkeypatch.setattr(nearest, "_meet", lambda queries, logs, k: sent.append(logs.count()) or meet(queries, logs, k))
    return sent


def test_a_log_travels_once_however_small_the_blocks_are(make, monkeypatch):
    rng = np.random.default_rng(3)
    logs = make("log_id bigint, timestamp timestamp_ntz, embedding array<float>", [(i, dt.datetime(2024, 1, 1), [float(x) for x in rng.normal(size=4)]) for i in range(60)])
    queries = logs.select(F.col("log_id").alias("query_id"), "embedding")
    sent = _logs_sent(monkeypatch)
    found = nearest.nearest(logs, queries, 3, block_bytes=256).collect()
    assert sent == [60]
    assert len(found) == 180 and all(r["query_id"] == r["log_id"] for r in found if r["rank"] == 1)


def test_logs_of_one_vector_are_scored_once(make, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in v] for v in rng.integers(-2, 3, size=(9, 3))]
    rows = [(i, dt.datetime(2024, 1, 1, 0, int(rng.integers(0, 30))), vectors[int(rng.integers(0, 9)) if i % 2 else 0]) for i in range(300)]
    asked = [(q, vectors[q % 9], dt.datetime(2024, 1, 1, 0, (0, 20, 29)[q % 3])) for q in range(27)]
    logs = make("log_id bigint, timestamp timestamp_ntz, embedding array<float>", rows)
    queries = make("query_id bigint, embedding array<float>, cutoff timestamp_ntz", asked)
    hit = lambda block: sorted((r["query_id"], r["rank"], r["log_id"]) for r in nearest.nearest(logs, queries, 6, block_bytes=block).collect())
    plain = hit(1 << 20)  # every log against every query
    monkeypatch.setattr(nearest, "CELL_BYTES", 8 * 3 + 24 * 6)  # a block for each query
    monkeypatch.setattr(nearest, "PART_ROWS", 2)
    sent = _logs_sent(monkeypatch)
    assert hit(1) == plain
    different, asked_once = len({tuple(r[2]) for r in rows}), len({(tuple(v), c) for _, v, c in asked})
    assert sent == [different * asked_once]

"""Ids of streamed lines and searches with a backslash."""

import datetime as dt

from pyspark.sql import functions as F

from faultline.operators import governance, logs
from faultline.streaming import pipelines


def test_ids_continue_without_caps(make):
    rows = make("part bigint, row bigint", [(1 << 17, 0), (1 << 17, 1), (0, 0), (1 << 30, 0)])
    got = pipelines.dense_ids(rows.withColumn("p", F.col("part")).withColumn("r", F.col("row")), 1 << 40)
    assert {(x.p, x.r): x.log_id - (1 << 40) for x in got.collect()} == {
        (0, 0): 0, (1 << 17, 0): 1, (1 << 17, 1): 2, (1 << 30, 0): 3,
    }


def test_replayed_batch_keeps_its_ids(make, tmp_path):
    lines = make("log_line string, event_time timestamp_ntz", [("a", None), (" ", None), ("b", None)]).repartition(3)
    out = str(tmp_path)
    first = pipelines._with_ids(lines, 0, out)
    assert sorted(r.log_id for r in first.collect()) == [0, 1]
    late = 1 << 20
    for _ in range(2):
        assert sorted(r.log_id for r in pipelines._with_ids(lines, late, out).collect()) == [2, 3]


def test_backslash_is_a_plain_character(make):
    table = make("log_id bigint, timestamp timestamp_ntz, log_line string", [])
    line = make("log_line string", [("disk C:\\svc full",), ("disk C:/svc full",)])
    assert logs.search_substring(table, "C:\\svc", "2024-01-01 00:00:00").count() == 0
    assert line.filter(F.col("log_line").ilike(f"%{logs._no_escape('c:\\svc')}%")).count() == 1


def test_resolutions_without_a_request_time(make):
    governed = make("request_id bigint, incident_id bigint, status string, success boolean, message string", [
        (1, 1, "ready", True, "done"), (2, 2, "ready", True, "DRY RUN: x"), (3, 3, "rejected", False, "no"), (4, 4, "ready", True, "done"),
    ])
    at = dt.datetime(2024, 1, 1, 5)
    told = make("request_id bigint, status string, output string, executed_at timestamp_ntz", [
        (1, "executed", "", at), (1, "failed", "", at - dt.timedelta(seconds=1)), (2, "executed", "", at), (3, "executed", "", at), (4, "failed", "", at),
    ])
    assert [tuple(r) for r in governance.resolutions_from(governed, told).collect()] == [(1, at)]

"""Text expressions against plain Python, on hand-written and random lines."""

import random
import re

from pyspark.sql import functions as F

from faultline.functions import detect, text

EDGE_LINES = [
    "", "   ", "\u00a0", "plain line", " 12 10.0.0.1 0xFF /var/log C:\\x ok ", "10.0.0.1:80", "éabc abcé abc", "ab_cd abc",
    "x123 123x abc1def", "12345678x 1234567x8", "١٢٣ ٤", "0xZZ 0x12", "the error and THE Error", "a/b 1/2 12/",
    "tab\tnew\u2003space\u3000end", "don't stop-word", "WARNING Failed Timeout fatal",
    " ".join(f"word{chr(97 + i)}" + "abc" for i in range(25)), "Port 80 ERROR", "<*> <NUM> <IP>",
]


def random_lines(n=400, seed=7):
    rng = random.Random(seed)
    alphabet = list("abcXYZ019 _-./\\:é٣\t\u00a0\u2003x") + ["the", "ERROR", "0x1f", "1.2.3.4", " ", " ", "timeout"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


LINES = EDGE_LINES + random_lines()


def run(spark, column):
    rows = spark.createDataFrame(list(enumerate(LINES)), "i int, line string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("line"))).collect()]


def model_mask(token):
    if re.fullmatch(r"\d+", token):
        return "<NUM>"
    if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", token):
        return "<IP>"
    if re.fullmatch(r"0x[0-9a-fA-F]+", token):
        return "<HEX>"
    return "<PATH>" if "/" in token or "\\" in token else token


def model_masked(line):
    return [model_mask(t) for t in line.split()]


def model_keywords(line):
    return [w for w in re.findall(r"\b[a-zA-Z]{3,}\b", line.lower()) if w not in text.STOP_WORDS]


def test_strip(spark):
    assert run(spark, text.strip) == [x.strip() for x in LINES]


def test_masked_tokens(spark):
    assert run(spark, text.masked_tokens) == [model_masked(x) for x in LINES]


def test_stateless_template(spark):
    assert run(spark, text.stateless_template) == [" ".join(t[:8] for t in model_masked(x)) for x in LINES]


def test_keywords(spark):
    assert run(spark, lambda c: text.keywords(c, None)) == [model_keywords(x) for x in LINES]
    assert run(spark, text.keywords) == [model_keywords(x)[:20] for x in LINES]


def test_stop_words_are_distinct():
    assert len(text.STOP_WORDS) == len(set(text.STOP_WORDS)) == 31


def test_jaccard(spark):
    pairs = list(zip(LINES, LINES[1:] + LINES[:1]))
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    got = [r[0] for r in rows.select(text.jaccard(text.tokens(F.col("a")), text.tokens(F.col("b")))).collect()]
    for value, (a, b) in zip(got, pairs):
        x, y = set(a.split()), set(b.split())
        assert abs(value - (len(x & y) / len(x | y) if x | y else 1.0)) < 1e-12


def test_detectors(spark):
    def any_of(words, fold):
        return [any(w in fold(x) for w in words) for x in LINES]

    assert run(spark, detect.detect_ingest) == any_of(["ERROR", "CRITICAL", "FATAL", "WARNING"], str.upper)
    assert run(spark, detect.detect_eval) == any_of(["ERROR", "CRITICAL"], str.upper)
    assert run(spark, detect.detect_monitor) == any_of(["ERROR", "CRITICAL", "Failed", "Timeout"], str)
    assert run(spark, detect.detect_intended) == any_of(["error", "critical", "failed", "timeout"], str.lower)


def test_pattern_classes(spark):
    cases = {
        "ERROR Port 443 busy": ["port.*conflict"],
        "ERROR port 443 busy": ["ERROR"],
        "ERROR TIMEOUT": ["timeout"],
        "ERROR Connection has Failed": ["connection.*failed"],
        "CRITICAL ERROR Permission Denied": ["permission.*denied", "CRITICAL"],
        "CRITICAL only": ["CRITICAL"],
        "error timeout": [],
    }
    rows = spark.createDataFrame([(k,) for k in cases], "line string")
    got = {r[0]: r[1] for r in rows.select("line", text.error_patterns(F.col("line"))).collect()}
    assert got == cases


def test_pattern_regex_default(spark):
    rows = spark.createDataFrame([("timeout",), ("disk",)], "p string")
    assert [r[0] for r in rows.select(text.pattern_regex(F.col("p"))).collect()] == ["(?i)(timeout|timed out)", "(disk)"]


def test_diagnosis_and_responses(spark):
    cases = [
        ("Port 80 in use", None, "RESTART_APACHE"),
        ("timeout on Port 80", "not json", "RESTART_APACHE"),
        ("a timeout", '{"action":"X"}', "ESCALATE"),
        ("other", '{"summary":"s","action":"CLEAR_TEMP_CACHE"}', "CLEAR_TEMP_CACHE"),
    ]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, line string, r string")
    got = rows.orderBy("i").select(detect.diagnosis_or_fallback(F.col("line"), F.col("r")).alias("d")).select("d.action")
    assert [r[0] for r in got.collect()] == [c[2] for c in cases]


def test_leading_timestamp(spark):
    lines = [("2024-01-01 10:00:00 INFO: up",), ("2024-01-01T10:00:00.12 INFO: up",), ("INFO: up",)]
    rows = spark.createDataFrame(lines, "line string")
    assert {r[0] for r in rows.select(text.without_leading_timestamp(F.col("line"))).collect()} == {"INFO: up"}

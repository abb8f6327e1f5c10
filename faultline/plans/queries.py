"""Registered batch queries over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import detect, text
from faultline.functions.times import cutoff, instant
from faultline.operators import evaluation, governance, incidents, logs, nearest, questions, retrieval, rules, search_index, templates
from faultline.session import work_dir
from faultline.sources import files, warehouse as wh
from faultline.sources.warehouse import AS_OF, ORDERS_AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WEEK = 168
LINE = "log_line"
# What the searches through a stored index look for: a word, a word with a wildcard, wildcards in a phrase, a path, a short pattern.
INDEXED_SEARCHES = ["conn", "ti_eout", "%port 80 is_in", "C:\\svc", "5 m"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _line() -> Column:
    return F.col(LINE)


INCIDENT_COLUMNS = ["incident_id", "detected_at", "resolved_at", "log_line", "summary", "status"]


def _incidents(spark: SparkSession, d: str) -> DataFrame:
    return wh.incidents(spark, d).select(*INCIDENT_COLUMNS)


def _tools(spark: SparkSession) -> DataFrame:
    extra = [("ROTATE_LOGS", "Rotate the logs under a path", ["path"], "LOW", False)]
    return files.rows(spark, files.DEFAULT_TOOLS + extra, files.TOOL_COLUMNS)


# -- sources and sinks -------------------------------------------------------


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return wh.logs(spark, d).select("log_line", "is_anomaly", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))


@query
def load_logs_csv(spark, d):
    path = work_dir(spark, "dataset") + ".csv"
    _labelled(spark, d).write.options(header=True, escape='"').csv(path)
    return files.load_logs_csv(spark, path, AS_OF).drop("log_id")


@query
def load_logs_json(spark, d):
    """Entries as objects with either key, or as bare strings."""
    path = work_dir(spark, "dataset") + ".jsonl"
    anomaly = F.col("is_anomaly") == 1
    entry = F.when(anomaly, F.to_json(F.struct("log_line", "is_anomaly", "timestamp"))).otherwise(
        F.to_json(F.struct(_line().alias("log"), F.col("is_anomaly").alias("anomaly")))
    )
    _labelled(spark, d).select(entry.alias("value")).write.text(path)
    return files.load_logs_json(spark, path, AS_OF, lines=True).drop("log_id")


@query
def load_logs(spark, d):
    path = work_dir(spark, "dataset") + ".csv"
    _labelled(spark, d).drop("timestamp").write.options(header=True, escape='"').csv(path)
    return files.load_logs(spark, path, AS_OF).drop("log_id")


@query
def load_logs_documents(spark, d):
    """One JSON document for each day of logs, a list or an object with a list of logs by turns, read back in file order."""
    path = work_dir(spark, "dataset")
    entry = F.when(F.col("is_anomaly") == 1, F.to_json(F.struct("log_line", "is_anomaly", "timestamp"))).otherwise(F.to_json(F.struct(_line().alias("log"))))
    days = _labelled(spark, d).withColumn("day", F.substring("timestamp", 1, 10)).groupBy("day").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", entry.alias("entry")))).alias("entries"))  # a document is one record by nature
    listed = F.concat(F.lit("["), F.array_join("entries.entry", ",\n"), F.lit("]"))
    document = F.when(F.day(F.col("day").cast("date")) % 2 == 0, listed).otherwise(F.concat(F.lit('{"logs": '), listed, F.lit("}")))
    days.select("day", document.alias("value")).write.partitionBy("day").text(path)
    return files.load_logs_json(spark, path, AS_OF)


@query
def load_logs_in_order(spark, d):
    """A dataset of several files: the ids follow the order of the lines."""
    path = work_dir(spark, "dataset") + ".csv"
    order = ["timestamp", "log_line"]
    dated = _labelled(spark, d).repartitionByRange(5, *order).sortWithinPartitions(*order)
    dated.write.options(header=True, escape='"').csv(path)
    return files.load_logs(spark, path, AS_OF)


@query
def stored_logs(spark, d):
    """Logs appended to a dated store in two batches, read back for one week of folders."""
    path = work_dir(spark, "store")
    flagged = wh.logs(spark, d)
    for part in (0, 1):
        files.append_logs(flagged.where(F.col("log_id") % 2 == part), path)
    week = F.col("log_date") >= F.lit(AS_OF[:10]).cast("date") - 7
    return spark.read.parquet(path).where(week).groupBy("log_date").agg(
        F.count("*").alias("logs"), F.sum("is_anomaly").alias("anomalies"), F.min("log_id").alias("first_id"), F.max("log_id").alias("last_id"))


@query
def stored_audit(spark, d):
    """The audit trail appended as JSON lines and read back, per tool and status."""
    path = work_dir(spark, "audit")
    governed = _governed(spark, d, False)
    files.append_audit(governance.audit_events(governed), path)
    told = spark.read.schema(
        "request_id bigint, seq int, requested_at timestamp_ntz, tool_name string, incident_id bigint, status string, approved_by string, error string").json(path)
    return told.groupBy("tool_name", "status", "approved_by", "error").agg(F.count("*").alias("n"), F.sum("request_id").alias("requests"))


@query
def stored_rules(spark, d):
    """Suggested rules written to a file, read back and evaluated."""
    path = work_dir(spark, "rules")
    files.write_json(rules.suggest_rules(_incidents(spark, d), AS_OF, WEEK), path)
    known = spark.read.schema("pattern string, regex string, threshold bigint, action string, frequency bigint").json(path)
    return rules.evaluate_rules(wh.logs(spark, d), known)


@query
def stored_policy(spark, d):
    """Requests governed by a policy and a tool registry that were read from files."""
    folder = work_dir(spark, "config")
    policy, tools = files.load_policy(spark), _tools(spark)
    entry = F.struct("risk_level", "requires_approval", "description")
    policy.agg(F.map_from_entries(F.collect_list(F.struct("action_name", entry))).alias("actions")).select(
        "actions", F.lit(False).alias("dry_run_mode")).coalesce(1).write.json(f"{folder}/policy")  # one document
    schema = F.struct(F.lit("object").alias("type"), F.col("required"))
    tools.agg(F.collect_list(F.struct("name", "description", schema.alias("inputSchema"), "risk_level", "requires_approval")).alias("tools")).coalesce(1).write.json(f"{folder}/tools")
    requests = wh.action_requests(spark, d)
    governed = governance.govern_actions(
        requests, files.load_tools(spark, f"{folder}/tools"), files.load_policy(spark, f"{folder}/policy"), wh.approval_decisions(spark, d),
        dry_run=files.load_dry_run(spark, f"{folder}/policy"))
    return governed.groupBy("tool_name", "status", "risk_level", "message").agg(F.count("*").alias("n"), F.sum("request_id").alias("requests"))


@query
def dataset_limit(spark, d):
    return evaluation.dataset_limit(wh.logs(spark, d), 1000)


@query
def ingest_batch(spark, d):
    """Documents' lines as incoming logs: blank ones dropped, the rest enriched."""
    lines = wh.document_lines(spark, d).withColumn("log_id", F.col("doc_id"))
    return logs.ingest(lines).select("doc_id", "line_no", "log_line", "is_anomaly", "template_pattern", "template_id")


@query
def open_incidents_from_logs(spark, d):
    return incidents.open_incidents_from_logs(wh.logs(spark, d))


@query
def apply_resolutions(spark, d):
    unresolved = wh.order_incidents(spark, d)
    return incidents.apply_resolutions(unresolved, wh.resolutions(spark, d))


@query
def attach_embeddings(spark, d):
    """Logs with the vector of the same id; vectors are shown by size and first value."""
    vectors = wh.table(spark, d, "embeddings").select(F.col("vec_id").alias("log_id"), "embedding")
    joined = logs.attach_embeddings(wh.logs(spark, d), vectors)
    return joined.select(
        "log_id", "log_line", F.size("embedding").alias("dim"),
        F.round(F.try_element_at("embedding", F.lit(1)).cast("double"), 6).alias("first_value"),
    )


@query
def policy_dim(spark, d):
    """Every policy entry with the number of requests that name it."""
    asked = wh.action_requests(spark, d).groupBy(F.col("tool_name").alias("action_name")).agg(F.count("*").alias("n"))
    joined = files.load_policy(spark).join(asked, "action_name", "left")
    return joined.select("action_name", "risk_level", "requires_approval", "description", F.coalesce("n", F.lit(0)).alias("requests"))


@query
def tool_dim(spark, d):
    """Every registered tool with its required parameters and the number of requests."""
    asked = wh.action_requests(spark, d).groupBy(F.col("tool_name").alias("name")).agg(F.count("*").alias("n"))
    return _tools(spark).join(asked, "name", "left").select(
        "name", "description", F.array_join("required", ",").alias("required"), "risk_level", "requires_approval",
        F.coalesce("n", F.lit(0)).alias("requests"),
    )


# -- detection and filters ---------------------------------------------------


def _detected(spark, d, flag: Column) -> DataFrame:
    return wh.logs(spark, d).filter(flag)


@query
def detect_ingest(spark, d):
    return _detected(spark, d, detect.detect_ingest(_line()))


@query
def detect_eval(spark, d):
    return _detected(spark, d, detect.detect_eval(_line()))


@query
def detect_monitor(spark, d):
    return _detected(spark, d, detect.detect_monitor(_line()))


@query
def detect_intended(spark, d):
    return _detected(spark, d, detect.detect_intended(_line()))


@query
def incidents_window(spark, d):
    return incidents.incidents_window(_incidents(spark, d), AS_OF, WEEK)


@query
def open_incidents(spark, d):
    return incidents.open_incidents(_incidents(spark, d))


@query
def incidents_by_ids(spark, d):
    ids = wh.table(spark, d, "labels").select(F.col("doc_id").alias("incident_id"))
    return incidents.incidents_by_ids(_incidents(spark, d), ids)


@query
def errors_window(spark, d):
    return incidents.errors_window(_incidents(spark, d), AS_OF, WEEK)


@query
def logs_by_template(spark, d):
    """Logs of the most frequent template in the last week."""
    top = templates.template_table(wh.templated_logs(spark, d)).orderBy(F.desc("frequency"), "template_pattern")
    chosen = top.limit(1).select("template_id").scalar()
    return logs.logs_by_template(wh.templated_logs(spark, d), chosen, AS_OF, WEEK)


@query
def search_substring(spark, d):
    return logs.search_substring(wh.logs(spark, d), "port 80 is_in", AS_OF, WEEK)


@query
def search_keyword(spark, d):
    all_logs = wh.logs(spark, d)
    return logs.search_keyword(all_logs, "conn", AS_OF, WEEK, index=logs.lexical_index(all_logs))


@query
def search_indexed(spark, d):
    """Searches through a stored index: one word, a phrase with wildcards, a path, and a pattern too short for it."""
    index = search_index.build_search_index(wh.logs(spark, d), work_dir(spark, "search"), block_lines=128)
    found = [index.search(p, AS_OF, WEEK).withColumn("pattern", F.lit(p)) for p in INDEXED_SEARCHES]
    return functools.reduce(DataFrame.unionByName, found)


@query
def search_logs(spark, d):
    """A one-word search and a phrase search, side by side."""
    all_logs = wh.logs(spark, d)
    word = logs.search_logs(all_logs, "nginx", AS_OF, WEEK).withColumn("pattern", F.lit("nginx"))
    phrase = logs.search_logs(all_logs, "login attempt", AS_OF, WEEK).withColumn("pattern", F.lit("login attempt"))
    return word.unionByName(phrase)


@query
def suspicious_events(spark, d):
    return logs.suspicious_events(wh.logs(spark, d), AS_OF, WEEK)


@query
def incident_listing(spark, d):
    return incidents.incident_listing(_incidents(spark, d))


@query
def constraint_violations(spark, d):
    """Constraints of all tables; the templates are those of flagged and of other lines, put together without a merge."""
    templated = wh.templated_logs(spark, d)
    flagged = detect.detect_ingest(_line())
    table = templates.template_table(templated.where(flagged)).unionByName(templates.template_table(templated.where(F.col("is_anomaly") == 0)))
    return incidents.constraint_violations(_incidents(spark, d), wh.line_actions(spark, d), wh.logs(spark, d), table)


@query
def orphan_rows(spark, d):
    """Actions against orders, logs against templates of error lines, an index of order texts against logs."""
    templated = wh.templated_logs(spark, d)
    known = templates.template_table(templated.filter(detect.detect_ingest(_line()))).select("template_id")
    return incidents.orphan_rows(
        wh.line_actions(spark, d), wh.order_incidents(spark, d), templated, known,
        logs.lexical_index(wh.order_incidents(spark, d).withColumnRenamed("incident_id", "log_id")),
    )


# -- joins -------------------------------------------------------------------


@query
def incident_template(spark, d):
    return incidents.incident_template(_incidents(spark, d), wh.templated_logs(spark, d))


@query
def template_correlation(spark, d):
    return retrieval.template_correlation(_incidents(spark, d), wh.templated_logs(spark, d), AS_OF, WEEK)


@query
def validate_actions(spark, d):
    checked = governance.validate_actions(wh.action_requests(spark, d), _tools(spark))
    return checked.select("request_id", "tool_name", "is_valid", "error")


def _vectors(spark, d) -> DataFrame:
    at = instant("2024-01-01 00:00:00") + F.make_dt_interval(secs=F.col("vec_id"))
    return wh.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("log_id"), at.alias("timestamp"), "embedding", F.col("label").cast("bigint").alias("label")
    )


def _exemplars(spark, d) -> DataFrame:
    """The first vector of each label."""
    return _vectors(spark, d).groupBy("label").agg(F.min_by("embedding", "log_id").alias("embedding"))


@query
def cosine(spark, d):
    return retrieval.cosine_to(_vectors(spark, d), _exemplars(spark, d), "label")


@query
def semantic_topk(spark, d):
    queries = _exemplars(spark, d).withColumnRenamed("label", "query_id")
    hits = retrieval.semantic_topk(_vectors(spark, d), queries, k=10)
    return hits.withColumn("similarity", F.round("similarity", 6))


def _every_twentieth(spark, d) -> DataFrame:
    return _vectors(spark, d).where("log_id % 20 = 0").select(F.col("log_id").alias("query_id"), "embedding")


@query
def semantic_topk_many(spark, d):
    """The nearest vectors of every twentieth one, with more queries than one block holds."""
    hits = retrieval.semantic_topk(_vectors(spark, d), _every_twentieth(spark, d), k=10, block_bytes=4096)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query
def semantic_topk_indexed(spark, d):
    """Whether an index finds at least nine tenths of the nearest vectors of every twentieth one; all of them with all lists."""
    vectors, asked = _vectors(spark, d), _every_twentieth(spark, d)
    index = nearest.build_index(vectors, work_dir(spark, "vectors"))
    exact = retrieval.semantic_topk(vectors, asked, k=10).select("query_id", "log_id", F.lit(1).alias("exact"))
    found = index.search(asked, k=10).select("query_id", "log_id", F.lit(1).alias("found"))
    all_lists = index.search(asked, k=10, probes=nearest.LISTS).select("query_id", "log_id", F.lit(1).alias("all_lists"))
    met = exact.join(found, ["query_id", "log_id"], "left").join(all_lists, ["query_id", "log_id"], "left")
    return met.agg(
        F.count("*").alias("hits"), (F.avg(F.coalesce("found", F.lit(0))) >= 0.9).alias("recalled"), (F.count("all_lists") == F.count("*")).alias("exact_with_all"))


# -- aggregates --------------------------------------------------------------


@query
def incident_status_counts(spark, d):
    return incidents.incident_status_counts(wh.order_incidents(spark, d))


@query
def action_status_counts(spark, d):
    return incidents.action_status_counts(wh.line_actions(spark, d))


@query
def mttr(spark, d):
    return incidents.mttr(_incidents(spark, d)).select(F.round("mttr_seconds", 4).alias("mttr_seconds"))


@query
def incident_recovery_seconds(spark, d):
    return incidents.incident_recovery_seconds(_incidents(spark, d))


@query
def mttd(spark, d):
    return incidents.mttd(_incidents(spark, d), wh.logs(spark, d)).select(F.round("mttd_seconds", 4).alias("mttd_seconds"))


@query
def template_table(spark, d):
    return templates.template_table(wh.templated_logs(spark, d))


@query
def template_stats(spark, d):
    return templates.template_stats(templates.template_table(wh.templated_logs(spark, d)))


@query
def error_patterns(spark, d):
    return rules.error_patterns(_incidents(spark, d), AS_OF, WEEK)


@query
def confusion(spark, d):
    return evaluation.confusion(wh.logs(spark, d), detect.detect_eval(_line()))


@query
def detection_metrics(spark, d):
    """All four detectors against the labels, one row each."""
    flags = {
        "eval": detect.detect_eval, "ingest": detect.detect_ingest,
        "monitor": detect.detect_monitor, "intended": detect.detect_intended,
    }
    return evaluation.detector_scores(wh.logs(spark, d), {n: f(_line()) for n, f in flags.items()})


@query
def detector_agreement(spark, d):
    return evaluation.detector_agreement(wh.logs(spark, d), detect.detect_eval(_line()), detect.detect_monitor(_line()))


@query
def latency_summary(spark, d):
    return evaluation.latency_summary(wh.calls(spark, d)).withColumn("average", F.round("average", 6))


@query
def summary_coverage(spark, d):
    return incidents.summary_coverage(_incidents(spark, d), AS_OF, WEEK)


@query
def summary_quality(spark, d):
    return evaluation.summary_quality(wh.summaries(spark, d))


@query
def action_usefulness(spark, d):
    return incidents.action_usefulness(wh.line_actions(spark, d), wh.order_incidents(spark, d), ORDERS_AS_OF, 24 * 30)


@query
def log_totals(spark, d):
    return logs.log_totals(wh.logs(spark, d))


@query
def evaluate_rules(spark, d):
    suggested = rules.suggest_rules(_incidents(spark, d), AS_OF, WEEK)
    return rules.evaluate_rules(wh.logs(spark, d), suggested)


@query
def restart_advice(spark, d):
    return questions.restart_advice(wh.logs(spark, d), AS_OF, hours=24)


def _flat_breakdown(column: str) -> Column:
    entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return F.array_join(entries, ",")


@query
def metrics_summary(spark, d):
    """The status → count map is shown as text, sorted by status."""
    row = incidents.metrics_summary(_incidents(spark, d), wh.line_actions(spark, d), wh.logs(spark, d))
    return row.withColumn("action_breakdown", _flat_breakdown("action_breakdown")).withColumns(
        {c: F.round(c, 4) for c in ("mttd_seconds", "mttr_seconds")}
    )


@query
def recent_actions(spark, d):
    return incidents.recent_actions(wh.line_actions(spark, d), 10)


# -- text --------------------------------------------------------------------


@query
def mask_tokens(spark, d):
    lines = wh.document_lines(spark, d)
    return lines.select("doc_id", "line_no", F.array_join(text.masked_tokens(_line()), " ").alias("masked"))


@query
def stateless_template(spark, d):
    return wh.document_lines(spark, d).select("doc_id", "line_no", text.stateless_template(_line()).alias("template"))


@query
def template_jaccard(spark, d):
    return templates.template_jaccard(wh.logs(spark, d)).withColumn("similarity", F.round("similarity", 6))


@query
def keywords(spark, d):
    """Every keyword of every document line, uncut."""
    found = text.keywords(_line(), None)
    return wh.document_lines(spark, d).select("doc_id", "line_no", F.array_join(found, " ").alias("keywords"))


@query
def lexical_index(spark, d):
    lines = wh.document_lines(spark, d).withColumn("log_id", F.col("doc_id"))
    return logs.lexical_index(lines, carry=("line_no",))


@query
def classify_pattern(spark, d):
    return wh.logs(spark, d).select("log_id", F.array_join(text.error_patterns(_line()), "|").alias("patterns"))


@query
def diagnose(spark, d):
    return wh.logs(spark, d).filter(detect.detect_monitor(_line())).select("log_id", detect.diagnose(_line()).alias("d")).select("log_id", "d.*")


@query
def parse_responses(spark, d):
    answer = detect.diagnosis_or_fallback(_line(), F.col("response"))
    parsed = detect.parse_response(F.col("response"))
    return wh.responses(spark, d).select(
        "log_id", parsed["summary"].alias("parsed_summary"), parsed["action"].alias("parsed_action"),
        answer["summary"].alias("summary"), answer["action"].alias("action"),
    )


@query
def advice_from_response(spark, d):
    parsed = detect.parse_response(F.col("response"))
    advice = questions.advice_from_response(parsed["summary"], parsed["action"], detect.detect_eval(_line()))
    return wh.responses(spark, d).select("log_id", advice.alias("recommendation"))


@query
def route_questions(spark, d):
    return questions.route_questions(wh.questions(spark, d)).select("conv_id", "turn", "route", "hours", "service")


@query
def build_prompts(spark, d):
    flagged = wh.logs(spark, d).filter(detect.detect_monitor(_line()))
    return flagged.select("log_id", retrieval.build_prompt(_line(), detect.diagnose(_line())["summary"]).alias("prompt"))


# -- retrieval ---------------------------------------------------------------


@query
def dedup_first_seen(spark, d):
    """Index hits in reading order, newest line first: the first hit per log."""
    hits = logs.lexical_index(wh.logs(spark, d), carry=("timestamp",))
    return logs.dedup_first_seen(hits, [F.desc("timestamp"), F.col("log_id"), F.col("position")])


@query
def keyword_fallback(spark, d):
    asked = wh.questions(spark, d).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
        F.col("question").alias("query_text"),
        cutoff(AS_OF, WEEK).alias("cutoff"),
    )
    recent = wh.logs(spark, d).filter(F.col("timestamp") >= cutoff(AS_OF, WEEK))
    return retrieval.keyword_fallback(asked, recent)


@query
def hybrid_merge(spark, d):
    """Line items as retrieval hits of three kinds for their supplier."""
    flag = F.col("l_returnflag")
    method = F.when(flag == "A", "template").when(flag == "N", "semantic").otherwise("keyword")
    at = instant("1995-01-01 00:00:00") + F.make_dt_interval(mins=F.col("l_partkey").cast("int"))
    hits = wh.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("request_id"),
        F.col("l_partkey").alias("log_id"),
        at.alias("timestamp"),
        F.when(flag == "A", retrieval.TEMPLATE_SCORE)
        .when(flag == "N", F.col("l_discount") + 0.85)
        .otherwise(retrieval.KEYWORD_SCORE)
        .alias("similarity"),
        method.alias("retrieval_method"),
        F.when(flag == "R", F.col("l_linenumber")).otherwise(0).alias("position"),
    )
    return retrieval.merge_hits(hits, 10)


def _embedded_incidents(spark, d) -> DataFrame:
    """Incidents with the vector of the event's user as query embedding."""
    vectors = wh.table(spark, d, "embeddings").select(F.col("vec_id").alias("user_id"), "embedding")
    return wh.incidents(spark, d).join(vectors, "user_id", "left").drop("user_id")


def _this_week(spark, d) -> DataFrame:
    return incidents.in_window(_embedded_incidents(spark, d), AS_OF, WEEK)


@query
def hybrid_retrieve(spark, d):
    """Related logs of every incident of the last week."""
    hits = retrieval.hybrid_retrieve(_this_week(spark, d), wh.embedded_logs(spark, d), AS_OF, WEEK, k=10)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query
def incident_context(spark, d):
    return retrieval.incident_context(_this_week(spark, d), wh.embedded_logs(spark, d), AS_OF, WEEK, k=10)


def _summary_hours(spark, d) -> DataFrame:
    routed = questions.route_questions(wh.questions(spark, d))
    return routed.filter(F.col("route") == questions.SUMMARY).select("hours").distinct()


@query
def window_summary(spark, d):
    """A summary per window length that some question asks for."""
    return retrieval.window_summary(
        _embedded_incidents(spark, d), wh.embedded_logs(spark, d), _summary_hours(spark, d), AS_OF
    )


@query
def answer_questions(spark, d):
    answered = questions.answer_questions(
        wh.questions(spark, d), _embedded_incidents(spark, d), wh.embedded_logs(spark, d), AS_OF
    )
    return answered.select("conv_id", "turn", "route", "hours", "service", "answer")


@query
def embed_logs(spark, d):
    """Hashed keyword vectors of all document lines: their slots and values, in hundred-thousandths."""
    lines = wh.document_lines(spark, d).withColumn("log_id", F.col("doc_id"))
    entry = lambda x, i: F.when(x > 0, F.concat_ws(":", i, F.round(x.cast("double") * 1e5).cast("bigint")))
    slots = F.array_join(F.array_compact(F.transform("embedding", entry)), " ")
    return retrieval.embed_logs(lines).select("doc_id", "line_no", F.size("embedding").alias("dim"), slots.alias("slots"))


@query
def retrieve_by_text(spark, d):
    """Logs of the last week nearest to the line and summary of each of its incidents."""
    hits = retrieval.retrieve_by_text(incidents.in_window(_incidents(spark, d), AS_OF, WEEK), wh.logs(spark, d), AS_OF, WEEK, k=10)
    return hits.withColumn("similarity", F.round("similarity", 6))


# -- rules, governance, reports ----------------------------------------------


@query
def suggest_rules(spark, d):
    return rules.suggest_rules(_incidents(spark, d), AS_OF, WEEK)


@query
def windowed_alerts(spark, d):
    """Days on which a rule suggested from the last 24 hours reaches the threshold suggested for it."""
    suggested = rules.suggest_rules(_incidents(spark, d), AS_OF, 24)
    return rules.windowed_alerts(wh.logs(spark, d), suggested, "1 day")


def _governed(spark, d, dry_run: bool) -> DataFrame:
    return governance.govern_actions(
        wh.action_requests(spark, d), _tools(spark), files.load_policy(spark), wh.approval_decisions(spark, d), dry_run
    )


@query
def govern_actions(spark, d):
    return _governed(spark, d, False).withColumn("audit", F.array_join("audit", ","))


@query
def govern_actions_dry_run(spark, d):
    return _governed(spark, d, True).withColumn("audit", F.array_join("audit", ","))


@query
def audit_events(spark, d):
    return governance.audit_events(_governed(spark, d, False))


@query
def record_actions(spark, d):
    return governance.record_outcomes(_governed(spark, d, False), wh.action_outcomes(spark, d))


@query
def outcome_audit(spark, d):
    return governance.outcome_audit(_governed(spark, d, False), wh.action_outcomes(spark, d))


@query
def evaluation_report(spark, d):
    """The nested report, one column per figure."""
    report = evaluation.evaluation_report(
        wh.logs(spark, d), wh.calls(spark, d), wh.summaries(spark, d), _incidents(spark, d), wh.line_actions(spark, d), AS_OF
    )
    data, use, ops = "dataset_evaluation", "action_usefulness", "operational_metrics"
    return report.select(
        "timestamp",
        *[f"{data}.{c}" for c in ("total_logs", "true_anomalies", "detected_anomalies", "false_positives", "false_negatives")],
        *[f"{data}.{c}" for c in ("precision", "recall", "f1_score")],
        *[F.col(f"{data}.latency.{c}").alias(f"latency_{c}") for c in ("average", "min", "max")],
        "summarization_quality.*",
        *[F.col(f"{use}.{c}").alias(f"recent_{c}") for c in ("total_incidents", "total_actions", "useful_actions", "usefulness_rate")],
        *[F.round(f"{ops}.{c}", 4).alias(c) for c in ("mttd_seconds", "mttr_seconds")],
        *[f"{ops}.{c}" for c in ("total_incidents", "open_incidents", "resolved_incidents", "escalated_incidents", "total_actions")],
        _flat_breakdown(f"{ops}.action_breakdown").alias("action_breakdown"),
    )


@query
def mine_templates(spark, d):
    """Greedy templates of all logs."""
    mined = templates.mine_templates(wh.logs(spark, d))
    return mined.select("log_id", "template_pattern", "template_id")


@query
def mine_templates_undated(spark, d):
    """Templates of all logs without the date at their start, by the rest of a line and by the whole line."""
    by_rest = templates.mine_templates(wh.logs(spark, d), strip_timestamp=True).select("log_id", "template_pattern")
    by_line = templates.mine_templates(wh.logs(spark, d), strip_timestamp=True, compare="line")
    return by_rest.join(by_line.select("log_id", F.col("template_pattern").alias("by_line")), "log_id")

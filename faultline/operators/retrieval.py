"""Vector, template and keyword retrieval, and the contexts built from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions import text
from faultline.functions.times import cutoff, from_micros, instant, micros_between
from faultline.functions.vectors import cosine
from faultline.operators.incidents import incident_template, incidents_per_template
from faultline.operators.nearest import BLOCK_BYTES, nearest
from faultline.session import cut_lineage

# Scores of the two unscored branches, and the branch priority.
TEMPLATE_SCORE, KEYWORD_SCORE = 0.9, 0.5
METHOD_RANK = {"template": 0, "semantic": 1, "keyword": 2}
QUERY_KEYWORDS, HITS_PER_KEYWORD = 3, 5
# Context lines and fallback summaries.
CONTEXT_LINE = "[{}] {} (retrieved via {})"
DETECTED = "Incident detected: {}. Related events found: {}"
FOUND = "Found {} incidents in the last {} hour(s). Related context: {} log entries."
NO_INCIDENTS = "No incidents found in the last {} hour(s)"

# Distinct incident lines up to this size are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 8 << 20


def cosine_to(vectors: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Cosine of each vector with the target vector that shares its key.

    Starts a job that writes the targets, so that a key held by many vectors can be
    split in the join.
    """
    right = cut_lineage(targets.select(key, F.col("embedding").alias("_target")))
    return vectors.join(right, key).select(
        "log_id", key, F.round(cosine(F.col("embedding"), F.col("_target")), 6).alias("similarity")
    )


def semantic_topk(logs: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, log_id, similarity, rank of the k nearest logs per query."""
    return nearest(logs, queries, k, block_bytes).select("query_id", "log_id", "similarity", "rank")


def template_correlation(incidents: DataFrame, logs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Logs of the window that share a template with some incident.

    Each log appears once, with the number of incidents behind its template; the
    incident side is :func:`incident_template`.  Listing every (incident, log) pair
    would square the largest template.
    """
    counted = cut_lineage(incidents_per_template(incidents, logs))
    recent = logs.filter(F.col("timestamp") >= cutoff(as_of, hours))
    return recent.join(counted, "template_id").select("template_id", "log_id", "timestamp", "log_line", "n_incidents")


# Query words up to this length meet the index by equality of substrings.
GRAM_CHARS = 8


def _grams(keyword: Column) -> Column:
    """Every substring of 3 to GRAM_CHARS characters of a keyword."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(keyword) - 2, F.lit(1)))
    widths = F.array(*[F.lit(n) for n in range(3, GRAM_CHARS + 1)])
    cut = F.transform(starts, lambda s: F.transform(widths, lambda n: keyword.substr(s, n)))
    return F.array_distinct(F.filter(F.flatten(cut), lambda g: F.length(g) >= 3))


def newest_per_word(words: DataFrame, logs: DataFrame, n: int) -> DataFrame:
    """For each word: the newest n logs with a keyword containing it.

    Column ``word`` in; word, log_id, timestamp out.  Words meet the vocabulary through
    shared substrings, an equi-join on the (much smaller) distinct keywords.  Logs are
    cut to n per keyword first: the newest n of a word are among those.
    """
    newest = Window.partitionBy("keyword").orderBy(F.desc("timestamp"), "log_id")
    # A line may repeat a keyword; it still counts as one hit.
    distinct = F.array_distinct(text.keywords(F.col("log_line")))
    index = logs.select("log_id", "timestamp", F.explode(distinct).alias("keyword"))
    per_keyword = index.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")
    vocabulary = per_keyword.select("keyword").distinct().select("keyword", F.explode(_grams(F.col("keyword"))).alias("gram"))
    wanted = words.select("word", F.substring("word", 1, GRAM_CHARS).alias("gram")).distinct()
    matches = (
        wanted.join(vocabulary, "gram").filter(F.col("keyword").contains(F.col("word"))).select("word", "keyword").distinct()
    )
    hits = matches.join(per_keyword, "keyword").select("word", "log_id", "timestamp").distinct()
    per_word = Window.partitionBy("word").orderBy(F.desc("timestamp"), "log_id")
    return hits.withColumn("_rn", F.row_number().over(per_word)).filter(F.col("_rn") <= n).drop("_rn")


def query_words(query: Column) -> Column:
    """The first words of a query text that the keyword branch looks up."""
    return F.slice(text.words(query), 1, QUERY_KEYWORDS)


def keyword_fallback(requests: DataFrame, logs: DataFrame) -> DataFrame:
    """Newest hits of each of the first query words: request_id, log_id, timestamp, position.

    ``requests``: request_id, query_text, cutoff.  The newest hits of a trailing window
    are the newest hits overall that fall into it, so the cutoff is applied last.
    Starts a job that writes the hits per word.
    """
    asked = requests.select("request_id", "cutoff", F.posexplode(query_words(F.col("query_text"))).alias("position", "word"))
    hits = cut_lineage(newest_per_word(asked.select("word").distinct(), logs, HITS_PER_KEYWORD))
    return (
        asked.join(hits, "word")
        .filter(F.col("timestamp") >= F.col("cutoff"))
        .select("request_id", "log_id", "timestamp", "position")
    )


def template_hits(requests: DataFrame, logs: DataFrame, k: int) -> DataFrame:
    """Logs of the request's template, newest first, enough of them for a top k.

    All template hits score the same, and at most k of them can be raised by their
    semantic score, so 2k per template always suffice.  They are cut per template and
    written out before they meet the requests (starts a job).
    """
    newest = Window.partitionBy("template_id").orderBy(F.desc("timestamp"), "log_id")
    wanted = requests.filter(F.col("template_id").isNotNull()).select("template_id").distinct()
    kept = (
        logs.select("template_id", "log_id", "timestamp")
        .join(wanted, "template_id", "left_semi")
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= 2 * k)
        .drop("_rn")
    )
    return (
        requests.select("request_id", "template_id", "cutoff")
        .join(cut_lineage(kept), "template_id")
        .filter(F.col("timestamp") >= F.col("cutoff"))
        .select("request_id", "log_id", "timestamp")
    )


def _rank_of(method: Column) -> Column:
    pairs = [F.lit(x) for pair in METHOD_RANK.items() for x in pair]
    return F.create_map(*pairs)[method]


def merge_hits(hits: DataFrame, k: int) -> DataFrame:
    """Best hit per (request, log), then the k best per request.

    Input: request_id, log_id, timestamp, similarity, retrieval_method, position.  On
    equal scores a template hit beats a semantic one, which beats a keyword one.
    """
    rank = _rank_of(F.col("retrieval_method"))
    per_log = Window.partitionBy("request_id", "log_id").orderBy(F.desc("similarity"), rank, "position")
    per_request = Window.partitionBy("request_id").orderBy(
        F.desc("similarity"), rank, "position", F.desc("timestamp"), "log_id"
    )
    return (
        hits.withColumn("_rn", F.row_number().over(per_log))
        .filter(F.col("_rn") == 1)
        .withColumn("rank", F.row_number().over(per_request))
        .filter(F.col("rank") <= k)
        .select("request_id", "log_id", "timestamp", "similarity", "retrieval_method", "rank")
    )


def _branch(hits: DataFrame, method: str, similarity: Column, position: Column) -> DataFrame:
    return hits.select(
        "request_id",
        "log_id",
        "timestamp",
        similarity.alias("similarity"),
        F.lit(method).alias("retrieval_method"),
        position.cast("int").alias("position"),
    )


def retrieve(requests: DataFrame, logs: DataFrame, k: int = 10) -> DataFrame:
    """Hybrid retrieval for a table of requests.

    ``requests``: request_id, template_id, query_text, cutoff and optionally
    embedding.  The keyword branch serves only requests that neither of the other
    branches answers.  Starts jobs (see :func:`nearest`).  Result: request_id, log_id, timestamp, log_line, similarity,
    retrieval_method, rank.
    """
    requests = cut_lineage(requests)
    by_template = template_hits(requests, logs, k)
    found = _branch(by_template, "template", F.lit(TEMPLATE_SCORE), F.lit(0))
    if "embedding" in requests.columns and "embedding" in logs.columns:
        queries = requests.select(F.col("request_id").alias("query_id"), "embedding", "cutoff")
        near = nearest(logs, queries, k).select(
            F.col("query_id").alias("request_id"),
            "log_id",
            from_micros(F.col("micros")).alias("timestamp"),
            "similarity",
        )
        found = found.unionByName(_branch(near, "semantic", F.col("similarity"), F.lit(0)))
    # Written out once: the hits are few, and the keyword branch (a pass over all
    # log text) is planned only if some request needs it.
    found = cut_lineage(found)
    unanswered = requests.join(found.select("request_id").distinct(), "request_id", "left_anti")
    if not unanswered.isEmpty():
        by_keyword = keyword_fallback(unanswered, logs)
        found = found.unionByName(_branch(by_keyword, "keyword", F.lit(KEYWORD_SCORE), F.col("position")))
    return merge_hits(found, k).join(logs.select("log_id", "log_line"), "log_id")


def incident_requests(
    incidents: DataFrame, logs: DataFrame, as_of: str, hours: int = 1, with_summary: bool = True
) -> DataFrame:
    """Retrieval requests for incidents: template by equal line, query from the text.

    Starts jobs.  The incidents are written out; if their lines are few enough to be
    broadcast, only the logs with one of those lines are grouped by line.
    """
    query = F.concat_ws(" ", "log_line", F.coalesce("summary", F.lit(""))) if with_summary else F.col("log_line")
    extra = ["embedding"] if "embedding" in incidents.columns else []
    asked = incidents.select(
        F.col("incident_id").alias("request_id"), "log_line", query.alias("query_text"), cutoff(as_of, hours).alias("cutoff"), *extra
    )
    asked = cut_lineage(asked)
    lines = asked.select("log_line").distinct()
    size = lines.agg(F.sum(F.octet_length("log_line") + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        logs = logs.join(F.broadcast(lines), "log_line", "left_semi")
    template = incident_template(asked.withColumnRenamed("request_id", "incident_id"), logs)
    return asked.drop("log_line").join(template.withColumnRenamed("incident_id", "request_id"), "request_id", "left")


def hybrid_retrieve(incidents: DataFrame, logs: DataFrame, as_of: str, hours: int = 1, k: int = 10) -> DataFrame:
    """Top k related logs per incident over the trailing window."""
    recent = logs.filter(F.col("timestamp") >= cutoff(as_of, hours))
    return retrieve(incident_requests(incidents, logs, as_of, hours), recent, k).withColumnRenamed(
        "request_id", "incident_id"
    )


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _joined_lines(entries: Column, render: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.array_sort(entries), render), "\n")


def context_line(e: Column) -> Column:
    return text.fill(CONTEXT_LINE, _iso(e["timestamp"]), e["log_line"], e["retrieval_method"])


def build_prompt(log_line: Column, context: Column) -> Column:
    """Analyzer prompt text for one incident and its related lines."""
    return F.concat(
        F.lit("Incident line:\n"), log_line,
        F.lit("\n\nRelated log lines:\n"), context,
        F.lit("\n\nState the root cause, the related events and the next remediation step."),
    )


def incident_context(incidents: DataFrame, logs: DataFrame, as_of: str, hours: int = 1, k: int = 10) -> DataFrame:
    """Per incident: number of related logs, context text, prompt, fallback summary."""
    hits = hybrid_retrieve(incidents, logs, as_of, hours, k)
    gathered = hits.groupBy("incident_id").agg(
        F.count("*").alias("n_related"),
        F.collect_list(F.struct("rank", "timestamp", "log_line", "retrieval_method")).alias("entries"),
    )
    line, n = F.col("log_line"), F.coalesce("n_related", F.lit(0))
    context = F.coalesce(_joined_lines(F.col("entries"), context_line), F.lit(""))
    return (
        incidents.select("incident_id", "log_line")
        .join(gathered, "incident_id", "left")
        .select(
            "incident_id",
            n.alias("n_related"),
            context.alias("context_text"),
            build_prompt(line, context).alias("prompt"),
            text.fill(DETECTED, line, n).alias("fallback_summary"),
        )
    )


WINDOW_INCIDENTS, WINDOW_HITS, WINDOW_LINES, LISTED_INCIDENTS = 5, 5, 20, 10


def counts_by_hours(rows: DataFrame, time_column: str, hours: DataFrame, as_of: str, name: str) -> DataFrame:
    """For each value of ``hours``: how many rows fall into that trailing window.

    A row enters every window of at least ``ceil(age)`` hours, so rows are counted per
    age hour (partial aggregation), the counts are written out (starts a job) and then
    added up along the hour axis.  Windows beyond either end of the data are moved to
    that end, so the axis has one row per hour of history, whatever is asked.
    """
    age = F.ceil(micros_between(F.col(time_column), instant(as_of)) / F.lit(3600e6)).cast("bigint")
    per_age = cut_lineage(rows.groupBy(age.alias("h")).agg(F.count("*").alias("n")))
    ends = per_age.agg(F.min("h").alias("low"), F.max("h").alias("high")).select(F.struct("low", "high").alias("e"))
    asked = hours.select(F.col("hours").cast("bigint").alias("hours")).withColumn("_e", ends.scalar())
    asked = asked.select("hours", F.greatest(F.least("hours", "_e.high"), F.col("_e.low") - 1).alias("h"))
    zeros = asked.select("h", F.lit(0).cast("bigint").alias("n")).distinct()
    axis = per_age.unionByName(zeros).groupBy("h").agg(F.sum("n").alias("n"))
    running = axis.select("h", F.sum("n").over(Window.orderBy("h")).alias(name))
    return asked.join(running, "h").select("hours", name)


def newest_lines(incidents: DataFrame, n: int, *columns: str) -> DataFrame:
    """One row: array of the n newest incidents."""
    fields = ["detected_at", "incident_id", "log_line", *columns]
    newest = incidents.select(*fields).orderBy(F.desc("detected_at"), "incident_id").limit(n)
    return newest.agg(F.collect_list(F.struct(*fields)).alias("newest"))


def within_window(newest: Column, start: Column) -> Column:
    """The entries of a newest_lines array at or after ``start``, newest first."""
    def before(a: Column, b: Column) -> Column:
        return (
            F.when(a["detected_at"] > b["detected_at"], -1)
            .when(a["detected_at"] < b["detected_at"], 1)
            .when(a["incident_id"] < b["incident_id"], -1)
            .otherwise(1)
        )

    return F.array_sort(F.filter(newest, lambda i: i["detected_at"] >= start), before)


def window_summary(incidents: DataFrame, logs: DataFrame, hours: DataFrame, as_of: str) -> DataFrame:
    """One row per distinct value of ``hours``: incidents of the window and their context.

    Starts jobs (see :func:`retrieve`).
    The newest incidents of a trailing window are the newest incidents overall that
    fall into it, so the two short lists are built once and cut per window.
    """
    windows = cut_lineage(hours.select(F.col("hours").cast("bigint").alias("hours")).distinct())
    windows = windows.withColumn("cutoff", instant(as_of) - F.make_dt_interval(F.lit(0), F.col("hours").cast("int")))
    counted = counts_by_hours(incidents, "detected_at", windows, as_of, "n_incidents")
    extra = ["embedding"] if "embedding" in incidents.columns else []
    newest_first = incidents.orderBy(F.desc("detected_at"), "incident_id")
    latest = newest_first.limit(LISTED_INCIDENTS).select("incident_id", "detected_at", "log_line", *extra)
    latest = cut_lineage(latest)
    inside = windows.withColumn("_new", newest_lines(latest, LISTED_INCIDENTS).scalar()).select(
        "hours", within_window(F.col("_new"), F.col("cutoff")).alias("listed")
    )
    leads = windows.withColumn("_new", newest_lines(latest, WINDOW_INCIDENTS, *extra).scalar())
    leads = leads.select(
        "hours", "cutoff", F.posexplode(within_window(F.col("_new"), F.col("cutoff"))).alias("seq", "i")
    ).select("hours", "cutoff", "seq", "i.*")
    # One request per (window, incident): the id packs both, five incidents at most.
    leads = leads.withColumn("request_id", F.col("hours") * 8 + F.col("seq"))
    # The leads are WINDOW_INCIDENTS distinct incidents at most, whatever the windows.
    newest = latest.orderBy(F.desc("detected_at"), "incident_id").limit(WINDOW_INCIDENTS).select("incident_id", "log_line")
    same_line = logs.join(F.broadcast(newest.select("log_line").distinct()), "log_line", "left_semi")
    template = incident_template(newest, same_line)
    requests = leads.join(template, "incident_id", "left").select(
        "request_id", "template_id", F.col("log_line").alias("query_text"), "cutoff", *extra
    )
    recent = logs.filter(F.col("timestamp") >= windows.agg(F.min("cutoff")).scalar())
    hits = retrieve(requests, recent, WINDOW_HITS)
    hits = hits.withColumn("hours", F.floor(F.col("request_id") / 8)).withColumn("seq", F.pmod("request_id", F.lit(8)))
    first = Window.partitionBy("hours", "log_id").orderBy("seq", "rank")
    unique = hits.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1)
    context = unique.groupBy("hours").agg(
        F.count("*").alias("n_context"),
        F.array_sort(F.collect_list(F.struct("seq", "rank", "timestamp", "log_line"))).alias("entries"),
    )
    n, m = F.col("n_incidents"), F.coalesce("n_context", F.lit(0))
    shown = F.transform(
        F.slice("entries", 1, WINDOW_LINES),
        lambda e: F.concat(F.lit("["), _iso(e["timestamp"]), F.lit("] "), e["log_line"]),
    )
    found, nothing = text.fill(FOUND, n, F.col("hours"), m), text.fill(NO_INCIDENTS, F.col("hours"))
    return (
        inside.join(counted, "hours")
        .join(context, "hours", "left")
        .select(
            "hours",
            "n_incidents",
            m.alias("n_context"),
            F.array_join(F.transform("listed", lambda i: F.concat(F.lit("- "), i["log_line"])), "\n").alias("incidents_text"),
            F.coalesce(F.array_join(shown, "\n"), F.lit("")).alias("context_text"),
            F.when(n == 0, nothing).otherwise(found).alias("fallback_summary"),
        )
    )


EMBED_CHARS, EMBED_DIM = 512, 256


def embed_text(rows: DataFrame, column: str, dim: int = EMBED_DIM) -> DataFrame:
    """Add an embedding of the first 512 characters of a text column: keyword counts scaled to unit length.

    A keyword counts in slot ``stable_id(keyword) % dim``, so any engine with md5 makes
    the same vector. All of it runs in the JVM.
    """
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    from pyspark.ml.functions import vector_to_array

    slots = F.transform(text.keywords(F.substring(column, 1, EMBED_CHARS), None), lambda w: (text.stable_id(w) % dim).cast("string"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], "_slots", "_counts")
    counted = counter.transform(rows.withColumn("_slots", F.coalesce(slots, F.array().cast("array<string>"))))
    unit = Normalizer(inputCol="_counts", outputCol="_unit").transform(counted)
    return unit.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_slots", "_counts", "_unit")


def embed_logs(logs: DataFrame, dim: int = EMBED_DIM, model: Callable | None = None) -> DataFrame:
    """Add an embedding of each line, by :func:`embed_text` or by ``model``, a pandas UDF from text to array<float>."""
    if model is not None:
        return logs.withColumn("embedding", model(F.substring("log_line", 1, EMBED_CHARS)))
    return embed_text(logs, "log_line", dim)


def retrieve_by_text(incidents: DataFrame, logs: DataFrame, as_of: str, hours: int = 1, k: int = 10, dim: int = EMBED_DIM) -> DataFrame:
    """The k logs of the trailing window nearest to each incident's line and summary, by the vectors of their texts.

    incident_id, log_id, timestamp, log_line, similarity, rank. Starts a job (see
    :func:`faultline.operators.nearest.nearest`).
    """
    recent = logs.filter(F.col("timestamp") >= cutoff(as_of, hours))
    asked = incidents.select(F.col("incident_id").alias("query_id"), F.concat_ws(" ", "log_line", F.coalesce("summary", F.lit(""))).alias("query_text"))
    hits = nearest(embed_logs(recent.select("log_id", "timestamp", "log_line"), dim), embed_text(asked, "query_text", dim).drop("query_text"), k)
    named = cut_lineage(hits.select(F.col("query_id").alias("incident_id"), "log_id", "similarity", "rank"))
    return named.join(recent.select("log_id", "timestamp", "log_line"), "log_id").select("incident_id", "log_id", "timestamp", "log_line", "similarity", "rank")

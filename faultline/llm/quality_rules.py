"""Quality rules: base statistics and the divergence of a text from its language.

Column expressions only. A language's reference is its histogram of character
classes and of its commonest words over all its texts (a null language is one of
its own). Words of any length are counted; those that are not among the commonest
share one class. A text is rejected if the Jensen-Shannon distance of its
histogram to the reference of its language exceeds a bound: the square root of the
divergence to base 2, 0 to 1. Texts with fewer words than a guard are not judged
by the distance, nor are texts of a language with fewer than ``least_reference``
words in all.

Null and empty texts have no words: every statistic 0, base_failed. Repeated rows
are judged alike, an empty table gives no rows, and columns of the input other
than the id, the text and the language are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import table
from faultline.session import cut_lineage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
COMMON_WORDS = 16
#: Most characters of a common word, as the models of the tests ask for it: no limit.
COMMON_CHARS = math.inf
CHAR_BOUND = 0.30
WORD_BOUND = 0.45
CHAR_GUARD = 20
WORD_GUARD = 60
LEAST_REFERENCE = 5_000
#: Common words and references of up to so many languages go to every task, with words of
#: up to so many characters in all; more are joined by a shuffle.
BROADCAST_LANGUAGES = 10_000
BROADCAST_CHARS = 10_000_000

CLASSES = ("lower", "space", "upper", "mark", "digit", "other", "symbol")


def spaced(text: Column) -> Column:
    """The text with each white-space character turned into a space."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), "\t\n\x0b\f\r", F.coalesce(text, F.lit("")))


def words_of(spaced_text: Column) -> Column:
    """The words of a text that ``spaced`` has been through."""
    return F.array_remove(F.split(spaced_text, " "), "")  # a plain character needs no pattern


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once for the row, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(words: Column) -> Column:
    """Hashes of all 8-word windows."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    at = lambda h, i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: at(h, i)))
    return F.when(F.size(words) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>"))


def covered_words(hashes: Column) -> Column:
    """Length of the union of the windows whose hash occurs twice or more.

    Hashes are sorted with their places, so equal ones stand side by side. The
    places that have an equal neighbour, in order, cover 8 words each, less where
    the next one starts sooner.
    """
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    twice = lambda p: F.filter(p, lambda x, i: same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1)))
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.sort_array(F.transform(let(placed, twice), lambda x: x["i"]))
    return F.aggregate(
        places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.cast("int").alias("last")),
        lambda a: a["n"],
    )


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_words``, ``_chars`` (see CLASSES), n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn("_spaced", spaced(F.col("text")))
    docs = docs.withColumns({"_words": words_of(F.col("_spaced")), "_lines": lines})
    docs = char_classes(docs).withColumn("_windows", window_hashes(F.col("_words")))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(text) - F.get("_chars", F.lit(1)),
        "n_symbols": (F.length("_odd") - F.length(F.translate("_odd", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(some, covered_words(F.col("_windows"))).otherwise(F.lit(0)).cast("long"),
    })


def char_classes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_chars``, the characters of each class, and ``_odd``, the text without those of the first six.

    Lower-case letters and spaces go first, in one step; the others work on the little that is left.
    """
    left = ["_left1"]
    docs = docs.withColumn("_left1", F.regexp_replace("_spaced", "[a-z ]+", ""))
    for k, pattern in enumerate(("[A-Z]+", r"[.,;:!?'\"()\-]+", "[0-9]+", r"[^\x00-\x7F]+"), 2):
        docs = docs.withColumn(f"_left{k}", F.regexp_replace(left[-1], pattern, ""))
        left.append(f"_left{k}")
    whole, sizes = F.length("_spaced"), [F.length(c) for c in left]
    spaces = whole - F.length(F.replace("_spaced", F.lit(" "), F.lit("")))
    counts = [whole - spaces - sizes[0], spaces, *(a - b for a, b in zip(sizes[:-1], sizes[1:])), sizes[-1]]
    return docs.withColumns({"_chars": F.array(*[c.cast("long") for c in counts]), "_odd": F.col(left[-1])}).drop(*left)


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if either is empty."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    shares = lambda c: let(total(c), lambda n: F.transform(c, lambda x: x / n))
    pairs = F.zip_with(
        shares(counts), shares(reference),
        lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0),
    )
    apart = F.sqrt(F.greatest(F.lit(0.0), total(pairs) / 2))
    return F.when((total(counts) > 0) & (total(reference) > 0), apart)


def common_words(docs: DataFrame) -> DataFrame:
    """A row per language that has words: the commonest ones, most frequent first, equally frequent ones in order."""
    counts = docs.select("lang", F.explode(words_of(spaced(F.col("text")))).alias("word")).groupBy("lang", "word").count()
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= COMMON_WORDS)
    listed = ranked.groupBy(F.col("lang").alias("_lang")).agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("c"))
    return listed.select("_lang", F.transform("c", lambda x: x["word"]).alias("common"))


def references(measured: DataFrame) -> DataFrame:
    """A row per language: the sums of its texts' histograms and the number of their words."""
    sums = lambda name, n: F.array_compact(F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(n)]))
    return measured.groupBy(F.col("lang").alias("_lang")).agg(
        sums("_chars", len(CLASSES)).alias("ref_chars"), sums("_common", COMMON_WORDS + 1).alias("ref_common"), F.sum("n_words").alias("ref_words"),
    )


def with_language(rows: DataFrame, languages: DataFrame, chars: int = 0) -> DataFrame:
    """``rows`` with what ``languages``, a staged table with words of ``chars`` characters, has for their language."""
    few = chars <= BROADCAST_CHARS and languages.count() <= BROADCAST_LANGUAGES
    return rows.join(F.broadcast(languages) if few else languages, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")


def word_classes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_common``: how often each word of ``common`` stands in ``_words``, and last the number of all others."""
    rows = rows.withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    places = F.transform("_words", lambda w: F.array_position("common", w).cast("int"))  # 0: none of them
    held = let(F.array_remove(places, 0), lambda p: F.transform("common", lambda _, k: F.size(p) - F.size(F.array_remove(p, k + 1))))
    rows = rows.withColumn("_listed", F.transform(held, lambda x: x.cast("long")))
    others = F.col("n_words") - F.aggregate("_listed", F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("_common", F.concat("_listed", F.array(others)))


def judge(
    docs: DataFrame, char_bound: float = CHAR_BOUND, word_bound: float = WORD_BOUND, char_guard: int = CHAR_GUARD,
    word_guard: int = WORD_GUARD, least_reference: int = LEAST_REFERENCE,
) -> DataFrame:
    """doc_id, the base statistics, char_distance, word_distance, base_failed and kept for every row.

    The texts are read twice, for the common words of each language and for the histograms.
    """
    docs = docs.select("doc_id", "text", "lang")
    statistics = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    words = cut_lineage(common_words(docs))
    chars = words.agg(F.sum(F.length(F.concat_ws("", "common")))).first()[0] or 0
    listed = with_language(docs, words, chars)
    measured = cut_lineage(word_classes(base_statistics(listed)).select("doc_id", "lang", *statistics, "_chars", "_common"))
    rows = with_language(measured, cut_lineage(references(measured)))
    rows = rows.withColumns({
        "char_distance": js_distance(F.col("_chars"), F.col("ref_chars")),
        "word_distance": js_distance(F.col("_common"), F.col("ref_common")),
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")),
    })
    enough = F.coalesce(F.col("ref_words") >= least_reference, F.lit(False))
    apart = reduce(Column.__or__, [
        F.coalesce((F.col("n_words") >= guard) & (F.col(c) > bound), F.lit(False))
        for c, bound, guard in (("char_distance", char_bound, char_guard), ("word_distance", word_bound, word_guard))
    ])
    return rows.select(
        "doc_id", *statistics, "char_distance", "word_distance",
        "base_failed", (~F.col("base_failed") & ~(enough & apart)).alias("kept"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))

"""Column expressions over log text: tokens, masks, templates, keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words the keyword index leaves out.
STOP_WORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "her", "was",
    "one", "our", "out", "day", "get", "has", "him", "his", "how", "its", "may",
    "new", "now", "old", "see", "two", "who", "way", "use", "she",
]

# Masks and the token shapes they replace, tried in this order.
NUMBER_MASK, NUMBER_SHAPE = "<NUM>", r"^\p{Nd}+$"
IP_MASK, IP_SHAPE = "<IP>", r"^\p{Nd}+\.\p{Nd}+\.\p{Nd}+\.\p{Nd}+$"
HEX_MASK, HEX_SHAPE = "<HEX>", r"^0x[0-9a-fA-F]+$"
PATH_MASK = "<PATH>"

# All Unicode white space, which Java's \s does not cover: as a class and as a set.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Three or more ASCII letters with no letter, digit or underscore on either side.
WORD = r"(?<![\p{L}\p{N}_])[a-z]{3,}+(?![\p{L}\p{N}_])"

TEMPLATE_TOKEN_CHARS = 8
MAX_KEYWORDS = 20


def fill(template: str, *values: Column) -> Column:
    """A sentence with each ``{}`` replaced by the next value; null if a value is."""
    first, *rest = template.split("{}")
    pieces = [F.lit(first)] + [x for value, piece in zip(values, rest, strict=True) for x in (value.cast("string"), F.lit(piece))]
    return F.concat(*pieces)


def strip(line: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(line, F.lit(WHITESPACE_CHARS))


def tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, WHITESPACE), "")


def mask(token: Column) -> Column:
    """Mask of one token; only tokens that begin with a digit meet the digit shapes."""
    other = F.when(token.contains("/") | token.contains("\\"), PATH_MASK).otherwise(token)
    return F.when(
        token.rlike(r"^\p{Nd}"),
        F.when(token.rlike(NUMBER_SHAPE), NUMBER_MASK)
        .when(token.rlike(IP_SHAPE), IP_MASK)
        .when(token.rlike(HEX_SHAPE), HEX_MASK)
        .otherwise(other),
    ).otherwise(other)


def masked_tokens(line: Column) -> Column:
    """White-space tokens with numbers, addresses, hex values and paths masked."""
    return F.transform(tokens(line), mask)


def render_template(masked: Column) -> Column:
    """Template text of masked tokens; every mask is shorter than the cut."""
    return F.array_join(F.transform(masked, lambda t: F.substring(t, 1, TEMPLATE_TOKEN_CHARS)), " ")


def stateless_template(line: Column) -> Column:
    """Template a line gets when no earlier line is remembered."""
    return render_template(masked_tokens(line))


def stable_id(text: Column) -> Column:
    """60-bit id of a text: the same on every run and every engine with md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def without_leading_timestamp(line: Column) -> Column:
    """Drop a leading ``YYYY-MM-DD[ T]HH:MM:SS`` so that it cannot shape the leaf."""
    return F.regexp_replace(line, r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?\s*", "")


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two token arrays taken as sets; two empty sets give 1."""
    union = F.size(F.array_union(left, right))
    shared = F.size(F.array_intersect(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def words(line: Column) -> Column:
    """Lower-case runs of three or more ASCII letters that stand alone as words."""
    return F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0))


def keywords(line: Column, max_keywords: int | None = MAX_KEYWORDS) -> Column:
    """Indexed words of a line: stop words removed, first ``max_keywords`` kept."""
    kept = F.filter(words(line), lambda w: ~w.isin(STOP_WORDS))
    return F.slice(kept, 1, max_keywords) if max_keywords else kept


# Pattern classes, their alert regexes and the action-bearing words.
PORT_CONFLICT = "port.*conflict"
TIMEOUT = "timeout"
CONNECTION_FAILED = "connection.*failed"
PERMISSION_DENIED = "permission.*denied"
GENERIC_ERROR = "ERROR"
CRITICAL = "CRITICAL"
PATTERN_REGEX = {
    PORT_CONFLICT: r"ERROR.*[Pp]ort\s+\d+.*in use",
    TIMEOUT: r"(?i)(timeout|timed out)",
    CONNECTION_FAILED: r"(?i)(connection.*failed|failed to connect)",
    PERMISSION_DENIED: r"(?i)(permission denied)",
    GENERIC_ERROR: "ERROR",
    CRITICAL: "CRITICAL",
}


def error_patterns(line: Column) -> Column:
    """Pattern classes of a line: at most one error class, plus CRITICAL."""
    low = F.lower(line)
    error_class = F.when(
        line.contains("ERROR"),
        F.when(line.contains("Port") & (line.contains("80") | line.contains("443")), PORT_CONFLICT)
        .when(low.contains("timeout"), TIMEOUT)
        .when(low.contains("connection") & low.contains("failed"), CONNECTION_FAILED)
        .when(low.contains("permission denied"), PERMISSION_DENIED)
        .otherwise(GENERIC_ERROR),
    )
    return F.array_compact(F.array(error_class, F.when(line.contains("CRITICAL"), CRITICAL)))


def pattern_regex(pattern: Column) -> Column:
    """Alert regex of a pattern class; any other pattern becomes one group."""
    known = F.create_map(*[F.lit(x) for pair in PATTERN_REGEX.items() for x in pair])
    return F.coalesce(F.try_element_at(known, pattern), F.concat(F.lit("("), pattern, F.lit(")")))

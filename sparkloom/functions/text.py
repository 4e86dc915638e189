"""Text functions as Columns: tokens, sentences, cleaning, excerpts, filters.

All stay in the JVM. Patterns follow Unicode word rules with (?U); (?d) makes a
newline the only line end. Null text gives null unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"(?U)\b\w+\b"
EDGES = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(text, EDGES, "")


def tokens(text: Column) -> Column:
    """Lower-cased words in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Non-blank parts between runs of . ! and ?."""
    return F.filter(F.split(text, r"[.!?]+"), lambda x: F.length(F.trim(x)) > 0)


def word_trigrams(words: Column) -> Column:
    """Three-word runs, then the single words; fewer than three words give only words."""
    runs = F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.array_join(F.slice(words, i, 3), " "))).otherwise(F.array().cast("array<string>"))
    return F.concat(runs, words)


def header_like(text: Column) -> Column:
    """True for lines that look like headings: under 30 characters, all capitals, a colon at the end, or a bullet or number at the start."""
    t = strip(text)
    return (F.length(t) < 30) | ((F.upper(t) == t) & (F.lower(t) != t)) | t.endswith(":") | t.rlike(r"^[\d•\-\*\#\.\)]+\s")


def excerpt(text: Column, max_words: int = 100, first_paragraph: bool = True) -> Column:
    """The first ``max_words`` words, with an ellipsis if that cuts the text; null under 50 characters.

    White space is collapsed before paragraphs are told apart, so the whole text
    is one paragraph and ``first_paragraph`` changes nothing; it is kept for its callers.
    """
    t = F.regexp_replace(strip(text), r"(?U)\s+", " ")
    words = F.split(t, " ")
    cut = F.when(F.size(words) > max_words, F.array_join(F.slice(words, 1, max_words), " ")).otherwise(t)
    short = F.length(cut) < F.length(t)
    marked = F.when(short & ~cut.endswith("..."), F.concat(F.regexp_replace(cut, r"[.,;:!?]+$", ""), F.lit("..."))).otherwise(cut)
    return F.when(F.length(strip(text)) >= 50, marked)


def display_text(text: Column) -> Column:
    """Without control characters, runs of blanks squeezed, at most two newlines; null becomes empty."""
    t = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    return F.coalesce(strip(F.regexp_replace(t, r"\n{3,}", "\n\n")), F.lit(""))


# The rules of the cleaning steps, in order.
CODE = [r"```[\s\S]*?```", r"`[^`]+`", r"<[^>]{1,200}>"]
ENTITIES = [r"&[a-z]+;", r"&#\d+;"]
STYLES = [r"(?U)[.#]?[a-zA-Z_][\w-]*\s*\{[^}]*\}", r"@media[^}]*\{[^}]*\}", r"@media[^\n]*", r"(?U)[a-zA-Z_]\w*\s*\([^)]{0,100}\)\s*\{", r"(?Udm)^[.#@][a-zA-Z_][\w-]*\s*$"]
CONSENT = [
    r"(?i)(?:we use|this (?:site|website) uses?) cookies?[^\n]{0,300}",
    r"(?i)by (?:continuing|clicking|using)[^\n]{0,200}(?:cookies?|consent|privacy)",
    r"(?i)cookie (?:policy|settings|preferences|notice)[^\n]{0,200}",
    r"(?i)accept (?:all )?cookies?[^\n]{0,100}",
    r"(?i)manage (?:cookie|consent|privacy)[^\n]{0,100}",
    r"(?i)gdpr[^\n]{0,200}",
]
PIPES = r"(?Ud)(?:^|\n)(?:[^\n]{1,30}\s*\|\s*){3,}[^\n]{1,30}(?:\n|$)"
CALLS = r"(?dim)^.*(?:subscribe|sign up|newsletter|download now|buy now|add to cart|free trial|limited time|click here|learn more|get started).*$"


def clean_text(text: Column) -> Column:
    """Extracted text without code, markup, styles, consent notices, pipe menus,
    calls to action and lines of 20 characters or more under 40 % letters."""
    for pattern in CODE:
        text = F.regexp_replace(text, pattern, "")
    for pattern in ENTITIES:
        text = F.regexp_replace(text, pattern, " ")
    for pattern in (*STYLES, *CONSENT):
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, PIPES, "\n")
    text = F.regexp_replace(text, CALLS, "")

    def line(x: Column) -> Column:
        def judged(bare: Column) -> Column:
            n = F.length(bare)
            kept = (n < 20) | (F.length(F.regexp_replace(bare, r"[^\p{L}]+", "")) >= 0.4 * n)
            return F.when(n == 0, F.lit("")).when(kept, x)

        return F.element_at(F.transform(F.array(strip(x)), judged), 1)

    lines = F.filter(F.transform(F.split(text, "\n"), line), lambda x: x.isNotNull())
    text = F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(text, r"[ \t]{2,}", " "))


# Phrases of spam; the last tests for a backslash before 1s.
SPAM = r"buy now|order now|add to cart|limited time offer|click here|download now|sign up today|xxx|casino|poker|lottery|prize winner|enlarge|enhancement|weight loss|miracle cure|(?:.)\\1{5,}"
#: The last alternative as it is meant: a character six times or more.
SPAM_REPEATS = SPAM.replace(r"(?:.)\\1{5,}", r"(.)\1{5,}")


def content_reason(text: Column, min_length: int = 100, spam: str = SPAM) -> Column:
    """too_short, spam_detected (in the first 1000 characters) or null for accepted text."""
    return F.when(F.length(text) < min_length, "too_short").when(F.substring(text, 1, 1000).rlike(f"(?i)(?:{spam})"), "spam_detected")


def content_text(text: Column, max_length: int = 100_000) -> Column:
    """The text as the content filter passes it on."""
    return F.substring(text, 1, max_length)


# Frequent English words.
COMMON = ("the", "and", "is", "it", "to", "of", "a", "in", "that")


def english_like(text: Column) -> Column:
    """True under 50 characters, else if over a tenth of the distinct words among the first 100 are frequent English ones."""
    words = F.array_distinct(F.slice(F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda x: x != ""), 1, 100))
    hits = F.size(F.array_intersect(words, F.array(*map(F.lit, COMMON))))
    return (F.length(text) < 50) | (hits / F.greatest(F.size(words), F.lit(1)) > 0.1)


# Openings and tails that summaries lose.
OPENINGS = [
    r"(?i)^Here('s| is) a summary:?\s*",
    r"(?i)^Summary:?\s*",
    r"(?i)^The (text|article|document|content) (discusses?|describes?|explains?|is about|covers?)\s*",
    r"(?i)^This (text|article|document|content)\s*",
    r"(?i)^In (this|the) (text|article|document),?\s*",
]
TAILS = [
    r"(?id)for (more )?information,?\s*(please )?(see|visit|click).*$",
    r"(?id)for license information.*$",
    r"(?id)cookie (policy|consent|settings).*",
    r"(?id)privacy (policy|notice|statement).*",
    r"(?id)all rights reserved.*$",
    r"(?id)copyright \d{4}.*$",
    r"(?id)terms (of use|and conditions).*$",
    r"(?id)please (enable|verify|accept).*$",
    r"(?id)skip to (main )?content.*$",
]


# First words that phrases lose.
STARTS = (r"(?U)^(The|This|It|There|These|A|An)\s+", r"(?U)^(is|are|was|were|has|have|had|being)\s+")


def phrases(text: Column) -> Column:
    """At most three short phrases from the first three sentences, joined by semicolons."""

    def shorten(s: Column) -> Column:
        for start in STARTS:
            s = F.regexp_replace(s, start, "")
        s = F.when(F.length(s) > 70, F.element_at(F.split(s, "[,;:]"), 1)).otherwise(s)
        return F.regexp_replace(strip(s), r"\.+$", "")

    parts = F.transform(F.slice(F.split(text, r"(?U)(?<=[.!?])\s+"), 1, 3), shorten)
    return F.array_join(F.filter(parts, lambda s: F.length(s) > 10), "; ")


def clean_summary(text: Column) -> Column:
    """A summary without stock openings and tails; long ones become phrases. Null gives empty."""
    for pattern in (*OPENINGS, *TAILS):
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, r'(?s)^"(.*)"$', "$1")
    text = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    dots = F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    text = F.when((dots > 2) | (F.length(text) > 180), phrases(text)).otherwise(text)
    return F.coalesce(strip(F.regexp_replace(text, r"(?U)[.,;:\s]+$", "")), F.lit(""))


def summary(text: Column, max_words: int = 80, backend: Callable[[list[str], int], list[str | None]] | None = None, least: int = 100, most: int = 2000) -> Column:
    """A summary; null where the stripped text has under ``least`` characters. The
    first ``most`` characters are read, which is this function's feature.

    ``backend`` gets a batch of texts and the number of words and gives a summary
    for each, which loses stock phrases; where it fails or gives none, and without
    one, the summary is the excerpt.
    """
    head = F.substring(text, 1, most)
    plain = excerpt(head, max_words)
    if backend is None:
        return F.when(F.length(strip(text)) >= least, plain)

    @F.arrow_udf("string")
    def asked(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        at = [i for i, x in enumerate(rows) if x is not None]
        out: list[str | None] = [None] * len(rows)
        for start in range(0, len(at), 64):
            part = at[start : start + 64]
            try:
                made = backend([rows[i] for i in part], max_words)
            except Exception:
                made = [None] * len(part)
            for i, x in zip(part, made, strict=True):
                out[i] = x
        return pa.array(out, pa.string())

    long_enough = F.length(strip(text)) >= least
    own = clean_summary(asked(F.when(long_enough, head)))
    return F.when(long_enough, F.when(F.length(own) > 0, own).otherwise(plain))

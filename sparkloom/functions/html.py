"""Page text and metadata as Columns: a rule-based extractor in the JVM.

Elements that never hold the main text are cut out, block ends become newlines
and tags go; metadata comes from the title and meta elements. Texts under
``min_length`` characters give null, longer than ``max_length`` are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T

# Elements that are cut out with what they hold, and block elements.
DROPPED = ("script", "style", "noscript", "template", "svg", "nav", "header", "footer", "aside", "form", "iframe", "head")
BLOCKS = "p|div|section|article|main|h[1-6]|ul|ol|li|table|tr|td|th|blockquote|pre|figure|figcaption|dl|dt|dd|hr|br"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&copy;": "©", "&middot;": "·", "&mdash;": "—", "&ndash;": "–", "&hellip;": "…", "&amp;": "&"}


def decoded(text: Column) -> Column:
    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def meta(html: Column, *names: str) -> Column:
    """The content of the first meta element with one of the names or properties."""
    found = [F.nullif(F.regexp_extract(html, rf"""(?is)<meta\s[^>]*(?:name|property)\s*=\s*["']?{n}["']?[^>]*?\scontent\s*=\s*["']([^"']*)["']""", 1), F.lit("")) for n in names]
    return decoded(F.coalesce(*found))


def title(html: Column) -> Column:
    return F.nullif(decoded(T.strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))), F.lit(""))


def main_text(html: Column, min_length: int = 100, max_length: int = 100_000) -> Column:
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tag in DROPPED:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    text = decoded(F.regexp_replace(text, r"<[a-zA-Z!/][^>]*>", ""))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: T.strip(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: x != "")
    joined = F.array_join(lines, "\n")
    return F.when(F.length(joined) >= min_length, F.substring(joined, 1, max_length))


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    h = F.col(html)
    return pages.withColumns({"title": F.coalesce(meta(h, "og:title"), title(h)), "author": meta(h, "author", "article:author"), "date": meta(h, "date", "article:published_time"), "description": meta(h, "description", "og:description"), "sitename": meta(h, "og:site_name"), "raw_html_hash": F.sha2(h, 256), "text": main_text(h)})

"""The library's patterns and text steps in the oracle's SQL dialect."""

from __future__ import annotations

import re

from sparkloom.functions import html as H
from sparkloom.functions import text as T

#: White space and word characters, Unicode's included.
SPACE = r"\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LETTER = r"\p{L}\p{M}\p{N}_"


def pattern(java: str) -> str:
    """A pattern without the flags U and d, whose classes are written out, as a SQL literal."""
    flags = re.match(r"\(\?([a-zA-Z]+)\)", java)
    names = flags[1] if flags else ""
    body = java[flags.end() :] if flags else java
    if "U" in names:
        # Inside a class the brackets are there already.
        body = re.sub(r"\[([^\]]*)\\w", lambda m: f"[{m[1]}{LETTER}", body)
        body = body.replace(r"\s", f"[{SPACE}]").replace(r"\w", f"[{LETTER}]")
    kept = "".join(c for c in names if c in "ism")
    return "'" + ((f"(?{kept})" if kept else "") + body).replace("'", "''") + "'"


def replaced(sql: str, java: str, by: str = "''") -> str:
    return f"regexp_replace({sql}, {pattern(java)}, {by}, 'g')"


def stripped(sql: str) -> str:
    return f"regexp_replace({sql}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decoded(sql: str) -> str:
    for name, sign in H.ENTITIES.items():
        sql = f"replace({sql}, {_literal(name)}, {_literal(sign)})"
    return sql


def _steps(first: str, steps: list[str], source: str, key: str) -> str:
    """Common table expressions, a step each, so that no step is written out twice."""
    out = [f"t0 AS (SELECT {key}, {first} AS x FROM {source})"]
    out += [f"t{i} AS (SELECT {key}, {step} AS x FROM t{i - 1})" for i, step in enumerate(steps, 1)]
    return "WITH " + ",\n".join(out)


def summary_sql() -> str:
    """doc_id and summary, as clean_summary() makes it of the first 2000 characters."""
    steps = [replaced("x", p) for p in T.OPENINGS]
    # A last newline is not part of the line that ends the text.
    steps += [replaced("x", p.removesuffix("$") + r"(\n?)$", r"'\1'") if p.endswith("$") else replaced("x", p) for p in T.TAILS]
    steps += [r"""regexp_replace(x, '(?s)^"(.*)"(\n?)$', '\1\2')""", f"regexp_replace(x, '[{SPACE}]+', ' ', 'g')", stripped("x")]
    starts = "s"
    for p in T.STARTS:
        starts = replaced(starts, p)
    ctes = _steps("coalesce(substring(text, 1, 2000), '')", steps, "documents", "doc_id")
    last = f"t{len(steps)}"
    return f"""{ctes},
p AS (SELECT doc_id, x, unnest(range(1, 4)) AS i, unnest(string_split(regexp_replace(x, '([.!?])[{SPACE}]+', '\\1' || chr(1), 'g'), chr(1))[1:3]) AS s FROM {last}),
q AS (SELECT doc_id, i, {starts} AS s FROM p WHERE s IS NOT NULL),
r AS (SELECT doc_id, i, regexp_replace({stripped("CASE WHEN length(s) > 70 THEN regexp_extract(s, '^[^,;:]*') ELSE s END")}, '\\.+$', '') AS s FROM q),
j AS (SELECT doc_id, string_agg(s, '; ' ORDER BY i) AS s FROM r WHERE length(s) > 10 GROUP BY 1),
k AS (SELECT t.doc_id, CASE WHEN length(x) - length(replace(x, '.', '')) > 2 OR length(x) > 180 THEN coalesce(j.s, '') ELSE x END AS s FROM {last} t LEFT JOIN j USING (doc_id))
SELECT doc_id, {stripped(f"regexp_replace(s, '[.,;:{SPACE}]+$', '')")} AS summary FROM k"""


def clean_sql() -> str:
    """doc_id, and length and digest of the cleaned text."""
    steps = [replaced("x", p) for p in T.CODE] + [replaced("x", p, "' '") for p in T.ENTITIES] + [replaced("x", p) for p in (*T.STYLES, *T.CONSENT)]
    steps += [replaced("x", T.PIPES, "chr(10)"), replaced("x", T.CALLS)]
    bare = stripped("y")
    line = f"list_filter(list_transform(list_transform(string_split(x, chr(10)), lambda y: {bare}), lambda y: CASE WHEN length(y) < 20 OR length(regexp_replace(y, '[^\\p{{L}}]+', '', 'g')) >= 4e-1 * length(y) THEN y END), lambda y: y IS NOT NULL)"
    steps += [f"array_to_string({line}, chr(10))", "regexp_replace(x, '\\n{3,}', chr(10) || chr(10), 'g')", stripped("regexp_replace(x, '[ \\t]{2,}', ' ', 'g')")]
    return _steps("substring(text, 1, 100000)", steps, "documents", "doc_id") + f" SELECT doc_id, length(x) AS n_chars_clean, md5(x) AS clean_md5 FROM t{len(steps)}"


def _meta(*names: str) -> str:
    one = lambda n: f"nullif(regexp_extract(html, {pattern(_META.format(n=n))}, 1), '')"
    return _decoded(f"coalesce({', '.join(map(one, names))})")


_META = r"""(?is)<meta\s[^>]*(?:name|property)\s*=\s*["']?{n}["']?[^>]*?\scontent\s*=\s*["']([^"']*)["']"""


def html_sql() -> str:
    """page_id, title, author, date, and length and digest of the main text."""
    steps = [replaced("x", rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "' '") for tag in H.DROPPED]
    steps += [replaced("x", rf"(?i)</?(?:{H.BLOCKS})\b[^>]*>", "chr(10)"), _decoded(replaced("x", r"<[a-zA-Z!/][^>]*>"))]
    squeezed = stripped(f"regexp_replace(y, '[{SPACE}]+', ' ', 'g')")
    steps.append(f"array_to_string(list_filter(list_transform(string_split(x, chr(10)), lambda y: {squeezed}), lambda y: y <> ''), chr(10))")
    ctes = _steps(replaced("html", r"(?s)<!--.*?-->"), steps, "pages", "page_id")
    title = f"""coalesce({_meta("og:title")}, nullif({_decoded(stripped("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))}, ''))"""
    return f"""{ctes}, m AS (SELECT page_id, CASE WHEN length(x) >= 100 THEN substring(x, 1, 100000) END AS x FROM t{len(steps)})
SELECT p.page_id, {title} AS title, {_meta("author", "article:author")} AS author, {_meta("date", "article:published_time")} AS date, length(x) AS n_chars, md5(x) AS text_md5 FROM pages p JOIN m USING (page_id)"""

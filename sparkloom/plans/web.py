"""Queries on pages: URLs, ids, filters, content types, importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.functions import url as U
from sparkloom.operators import dedup as D
from sparkloom.plans import dialect
from sparkloom.plans.frames import table
from sparkloom.plans.registry import query
from sparkloom.store import new_folder

_HOST = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?', 1)"
_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_QUERY = r"regexp_extract(url, '\?([^#]*)', 1)"
_TRACKING = ", ".join(f"'{t}'" for t in U.TRACKING)

#: Holds for the supplied pages, whose queries need no decoding.
CANONICAL_SQL = rf"""WITH a AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) AS s, lower({_HOST}) AS h0, {_PATH} AS p0,
  list_sort(list_filter(string_split({_QUERY}, '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ({_TRACKING}))) AS q FROM pages),
b AS (SELECT page_id, url, s, regexp_replace(CASE WHEN s = 'http' THEN replace(h0, ':80', '') WHEN s = 'https' THEN replace(h0, ':443', '') ELSE h0 END, '^www\.', '') AS h,
  CASE WHEN p0 = '' THEN '/' WHEN p0 <> '/' THEN regexp_replace(p0, '/+$', '') ELSE p0 END AS p, array_to_string(list_transform(q, lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END), '&') AS q FROM a),
u AS (SELECT page_id, url, s || '://' || h || p || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical_url, h FROM b) """


@query(CANONICAL_SQL + "SELECT page_id, canonical_url FROM u")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical_url"))


@query(CANONICAL_SQL + "SELECT canonical_url, min(page_id) AS page_id, count(*) AS n_rows FROM u GROUP BY 1")
def url_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.url_dedup(table(spark, sf_dir, "pages").select("page_id", "url"))


@query(CANONICAL_SQL + ", m AS (SELECT canonical_url, page_id * 2 AS position FROM u UNION ALL SELECT canonical_url, page_id * 2 + 1 FROM u WHERE page_id % 3 = 0) SELECT canonical_url, min(position) AS position FROM m GROUP BY 1")
def multi_source_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps in the order of their positions, each URL once."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    one = pages.select("url", (F.col("page_id") * 2).alias("position"))
    two = pages.where("page_id % 3 = 0").select("url", (F.col("page_id") * 2 + 1).alias("position"))
    return D.url_dedup(one.unionByName(two), order="position").select("canonical_url", "position")


@query(f"SELECT page_id, {_HOST} AS domain FROM pages")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.domain(F.col("url")).alias("domain"))


@query(r"""WITH a AS (SELECT page_id, split_part(lower(regexp_extract(url, '^[^:]*://[^/]*', 0)) || regexp_replace(url, '^[^:]*://[^/]*', ''), '#', 1) AS u FROM pages)
SELECT page_id, CASE WHEN u LIKE '%/' AND length(u) - length(replace(u, '/', '')) > 3 THEN regexp_replace(u, '/+$', '') ELSE u END AS mapped FROM a""")
def map_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.map_url(F.col("url")).alias("mapped"))


@query(r"""WITH a AS (SELECT page_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS h FROM pages)
SELECT page_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || ['8', '9', 'a', 'b'][(strpos('0123456789abcdef', h[17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] AS doc_uuid FROM a""")
def doc_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.doc_id(F.col("url")).alias("doc_uuid"))


def _literal(xs: tuple[str, ...]) -> str:
    return "|".join(x.replace(".", r"\.") for x in xs)


_REASON = rf"""CASE WHEN regexp_matches(lower({_HOST}), '{_literal(U.DOMAINS)}') THEN 'domain_blocked'
WHEN regexp_matches(lower({_PATH}), '(?:{_literal(U.EXTENSIONS)})$') THEN 'extension_blocked'
WHEN regexp_matches(lower({_PATH}), '{"|".join(U.PATHS)}') THEN 'path_blocked' WHEN length(url) > 2000 THEN 'too_long' END"""


@query(f"SELECT page_id, {_REASON} AS reason FROM pages")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.filter_reason(F.col("url")).alias("reason"))


@query(f"SELECT coalesce({_REASON}, 'passed') AS reason, count(*) AS n_urls FROM pages GROUP BY 1")
def url_filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(F.coalesce(U.filter_reason(F.col("url")), F.lit("passed")).alias("reason")).agg(F.count("*").alias("n_urls"))


def _signs(column: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


_TITLE = r"regexp_extract(html, '<title>([^<]*)</title>', 1)"


@query(f"WITH a AS (SELECT page_id, lower(url) || chr(10) || lower({_TITLE}) AS b FROM pages) SELECT page_id, CASE WHEN {_signs('b', S.CODE_SIGNS)} THEN 'technical_code' WHEN {_signs('b', S.ACADEMIC_SIGNS)} THEN 'academic' WHEN {_signs('b', S.NEWS_SIGNS)} THEN 'news' ELSE 'default' END AS content_type FROM a")
def content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", S.content_type(F.col("url"), title).alias("content_type"))


def _authority_sql(h: str) -> str:
    exact = " ".join(f"WHEN {h} = '{k}' THEN {v}e0" for k, v in S.AUTHORITY.items())
    ends = " ".join(f"WHEN ends_with({h}, '{k if k.startswith('.') else '.' + k}') THEN {v}e0" for k, v in S.AUTHORITY.items())
    return f"CASE {exact} {ends} WHEN contains({h}, '.edu') OR contains({h}, '.ac.') THEN 75e-2 WHEN contains({h}, '.gov') OR contains({h}, '.mil') THEN 7e-1 WHEN contains({h}, '.org') THEN 55e-2 ELSE 4e-1 END"


@query(f"WITH a AS (SELECT page_id, {_authority_sql(f'lower({_HOST})')} AS a, (page_id % 100) / 1e2 AS q, page_id % 1000 AS l FROM pages) SELECT page_id, round((a * 5e-1 + least(log10(l + 1) / 3.5e0, 1e0) * 3e-1 + 3e-1 * 2e-1) * 7e-1 + q * 3e-1, 9) AS importance FROM a")
def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    value = S.importance(U.domain(F.col("url")), (F.col("page_id") % 100) / 100, links=F.col("page_id") % 1000)
    return p.select("page_id", F.round(value, 9).alias("importance"))


@query(f"WITH a AS (SELECT e.vec_id, {_authority_sql('lower(d.source)')} AS a, (e.vec_id % 100) / 1e2 AS q FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id) SELECT vec_id, round((a * 5e-1 + a * 8e-1 * 3e-1 + 3e-1 * 2e-1) * 7e-1 + q * 3e-1, 9) AS importance FROM a")
def importance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of each vector from its document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    v = table(spark, sf_dir, "embeddings").select("vec_id").join(docs, "vec_id")
    return v.select("vec_id", F.round(S.importance(F.col("source"), (F.col("vec_id") % 100) / 100), 9).alias("importance"))


@query(dialect.html_sql())
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, description, site name and rule-based main text of each page."""
    from sparkloom.functions import html

    return html.extracted(table(spark, sf_dir, "pages")).select("page_id", "title", "author", "date", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def _written(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """The lines of ``rows`` as text files in a folder of their own below the shared one."""
    path = new_folder(spark, name)
    rows.write.text(path)
    return path


@query("SELECT url, md5(html) AS html_md5 FROM pages WHERE coalesce(url, '') <> ''")
def source_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages through JSON lines with alias keys, and read back."""
    from sparkloom.sources import readers

    p = table(spark, sf_dir, "pages")
    one = F.to_json(F.struct(F.col("url").alias("URL"), F.col("html").alias("content")))
    two = F.to_json(F.struct(F.col("url").alias("link"), "html"))
    lines = p.select(F.when(F.col("page_id") % 2 == 0, one).otherwise(two).alias("value"))
    return readers.jsonl(spark, _written(spark, lines, "jsonl")).select("url", F.md5("html").alias("html_md5"))


@query("SELECT trim(split_part(url, ',', 1)) AS url, count(*) AS n_rows FROM pages WHERE trim(split_part(url, ',', 1)) LIKE 'http%' GROUP BY 1")
def source_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' URLs through a list with comments and blank lines, and read back."""
    from sparkloom.sources import readers

    p = table(spark, sf_dir, "pages").where("url is not null")
    lines = p.select(F.explode(F.array(F.concat(F.col("url"), F.lit(", a note")), F.lit("# a comment"), F.lit(""), F.lit("ftp://no"))).alias("value"))
    return readers.url_list(spark, _written(spark, lines, "urls")).groupBy("url").agg(F.count("*").alias("n_rows"))


@query(CANONICAL_SQL + "SELECT canonical_url FROM u WHERE canonical_url <> ''")
def canonical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical URLs of all stored pages, for resuming."""
    from sparkloom.sources import readers

    return readers.canonical_urls(table(spark, sf_dir, "pages").select(U.canonical(F.col("url")).alias("canonical_url")))


@query("SELECT page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id) AS rn FROM pages) WHERE rn <= 10")
def ingest_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows of each of three dumps; the limit is the feature."""
    from sparkloom.sources import readers

    p = table(spark, sf_dir, "pages").withColumn("source", F.col("page_id") % 3)
    return readers.first_of_dump(p, per_dump=10, order="page_id").select("page_id", "url")

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import html as H
from sparkloom.functions import text as T
from sparkloom.functions import url as U


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("https://EXAMPLE.COM/Page", "https://example.com/Page"),
        ("https://www.example.com/page", "https://example.com/page"),
        ("https://example.com/page?utm_source=twitter&id=5", "https://example.com/page?id=5"),
        ("https://example.com:443/page", "https://example.com/page"),
        ("https://example.com/?z=1&a=2", "https://example.com/?a=2&z=1"),
        ("https://example.com/page/", "https://example.com/page"),
        ("https://example.com/", "https://example.com/"),
        ("http://h:8080/x", "http://h80/x"),  # the port is cut out as text
        ("http://h/x?trkCampaign=1", "http://h/x?trkCampaign=1"),  # mixed-case entries never match
        ("http://h/x?b=&a=1#f", "http://h/x?a=1&b="),
        ("http://h/x?q=a%20b*c~", "http://h/x?q=a+b%2Ac~"),
        ("http://h/x?a=2&a=1", "http://h/x?a=2&a=1"),
        (None, None),
    ],
)
def test_canonical(spark, raw, expected):
    assert one(spark, raw, U.canonical) == expected


def test_ids_and_domains(spark):
    url = "https://exa_mple.com/a?b=c"
    assert one(spark, url, U.doc_id) == str(uuid.uuid5(uuid.NAMESPACE_URL, url))
    assert one(spark, url, U.domain) == "exa_mple.com"
    assert one(spark, "HTTP://WWW.X.com/A/?q=1#z", U.map_url) == "http://www.x.com/A/?q=1"
    assert one(spark, "http://x.com/a/", U.map_url) == "http://x.com/a"
    assert one(spark, " ", U.map_url) is None


@pytest.mark.parametrize(
    ("url", "reason"),
    [
        ("https://m.facebook.com/x", "domain_blocked"),
        ("https://x.com/a.pdf", "extension_blocked"),
        ("https://x.com/login", "path_blocked"),
        ("https://x.com/" + "a" * 2000, "too_long"),
        ("https://x.com/a?replytocom=1", None),  # only the path is tested
        ("https://x.com/page/3", "path_blocked"),
        ("https://x.com/essay", None),
    ],
)
def test_url_filter(spark, url, reason):
    assert one(spark, url, U.filter_reason) == reason


def test_custom_domains(spark):
    assert one(spark, "https://bad.com/x", lambda c: U.filter_reason(c, ("bad.com",))) == "custom_blocked"


def test_excerpt(spark):
    assert one(spark, "short", T.excerpt) is None
    assert one(spark, None, T.excerpt) is None
    long = " ".join(["word"] * 200)
    cut = one(spark, long, lambda c: T.excerpt(c, 50))
    assert cut.endswith("...") and len(cut.split()) == 50
    assert one(spark, "A" * 60, T.excerpt) == "A" * 60


@pytest.mark.parametrize("line", ["INTRODUCTION", "Section One:", "Hi", "1. First point of a list that is long enough"])
def test_headers(spark, line):
    assert one(spark, line, T.header_like)


def test_display(spark):
    assert one(spark, "a\x00b\n\n\n\n\nc  d", T.display_text) == "ab\n\nc d"
    assert one(spark, None, T.display_text) == ""


def test_content_filter(spark):
    assert one(spark, "tiny", T.content_reason) == "too_short"
    assert one(spark, "casino " + "x " * 100, T.content_reason) == "spam_detected"
    assert one(spark, "a" * 300, T.content_reason) is None  # repeats are not seen by default
    assert one(spark, "a" * 300, lambda c: T.content_reason(c, spam=T.SPAM_REPEATS)) == "spam_detected"
    assert one(spark, "fine words " * 30, T.content_reason) is None


def test_language(spark):
    assert one(spark, "the cat and the dog is in that house of a friend, it seems to me", T.english_like)
    assert not one(spark, "der Hund und die Katze wohnen seit langer Zeit zusammen im Haus am See", T.english_like)
    assert one(spark, "kurz", T.english_like)


def test_clean_text(spark):
    dirty = "Good words stay here.\n```code\nx```\nInline `code` gone and <b>tags</b> &nbsp; too.\nWe use cookies to track.\nhome | about | news | contact\nSubscribe now please\n1234567890 1234567890 1234567890\n\n\n\nEnd of it."
    clean = one(spark, dirty, T.clean_text)
    assert "Good words stay here." in clean and "End of it." in clean
    for gone in ("```", "`code`", "<b>", "cookies", "about |", "Subscribe", "1234567890"):
        assert gone not in clean


def test_summary(spark):
    assert one(spark, "Summary: The cat sat on the mat", T.clean_summary) == "The cat sat on the mat"
    assert one(spark, None, T.clean_summary) == ""
    many = "The first sentence is about cats. This second one is about dogs. A third one closes the list. More."
    assert one(spark, many, T.clean_summary) == "first sentence is about cats; second one is about dogs; third one closes the list"


def test_html(spark):
    page = "<html><head><title>T &amp; U</title><meta name='author' content='Ann'></head><body><nav>menu</nav><p>" + "word " * 30 + "</p><script>x</script></body></html>"
    r = H.extracted(spark.createDataFrame([(page,)], "html string")).first()
    assert (r["title"], r["author"]) == ("T & U", "Ann")
    assert r["text"] == ("word " * 30).strip()


def test_summary(spark):
    long = "The report covers a river and its banks. " * 8
    d = spark.createDataFrame([(1, long), (2, "short"), (3, None), (4, " " * 300)], "id int, t string")
    plain = {r["id"]: r["s"] for r in d.select("id", T.summary(F.col("t"), 10).alias("s")).collect()}
    assert plain[1].endswith("...") and plain[2] is plain[3] is plain[4] is None

    def backend(texts, words):
        if any("fail" in t for t in texts):
            raise RuntimeError
        return ["Summary: about a river" for _ in texts]

    assert {r["id"]: r["s"] for r in d.select("id", T.summary(F.col("t"), 10, backend).alias("s")).collect()} == {1: "about a river", 2: None, 3: None, 4: None}
    f = spark.createDataFrame([(1, "fail " + long)], "id int, t string")
    assert f.select(T.summary(F.col("t"), 10, backend).alias("s")).first()[0] == f.select(T.excerpt(F.substring("t", 1, 2000), 10).alias("s")).first()[0]

"""URL functions as Columns: parts, canonical form, ids and the URL filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, authority, path, query and fragment by the generic syntax.
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Query keys that only track; compared in lower case, so mixed-case entries never match.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "source", "mc_cid", "mc_eid", "_ga", "_gid", "ICID", "icid", "trk", "trkCampaign")


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, PARTS, n)


def domain(url: Column) -> Column:
    """The authority as it is written."""
    return _part(url, 2)


def _encode(value: Column) -> Column:
    """Form encoding that keeps letters, digits and _ . - ~."""
    out = F.url_encode(value)
    return F.replace(F.replace(out, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, without default port, www., trailing slash,
    parameters, fragment and tracking keys; keys in order, repeated keys together."""
    u = F.trim(url)
    scheme, host = F.lower(_part(u, 1)), F.lower(_part(u, 2))
    host = F.when((scheme == "http") & host.contains(":80"), F.replace(host, F.lit(":80"), F.lit(""))).when((scheme == "https") & host.contains(":443"), F.replace(host, F.lit(":443"), F.lit(""))).otherwise(host)
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(_part(u, 3), r";[^/]*$", "")
    path = F.when(path == "", "/").when((path != "/") & path.endswith("/"), F.regexp_replace(path, "/+$", "")).otherwise(path)
    pairs = F.filter(F.split(_part(u, 4), "&"), lambda x: x != "")

    def parse(x: Column, i: Column) -> Column:
        plain = lambda y: F.coalesce(F.try_url_decode(y), y)
        key = plain(F.substring_index(x, "=", 1))
        value = F.when(x.contains("="), plain(F.substring(x, F.length(F.substring_index(x, "=", 1)) + 2, 1 << 20))).otherwise(F.lit(""))
        return F.struct(key.alias("k"), i.alias("i"), value.alias("v"))

    kept = F.filter(F.transform(pairs, parse), lambda p: ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    mark = F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    head = F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":")))
    return F.concat(head, F.when(host == "", "").otherwise(F.concat(F.lit("//"), host)), path, mark)


def map_url(url: Column) -> Column:
    """The source readers' lighter form: scheme and host in lower case, no fragment,
    no trailing slash below the root; www. and the query stay. Null for blank."""
    u = F.trim(url)
    scheme, rest = F.lower(F.substring_index(u, "://", 1)), F.regexp_replace(u, "^.*?://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/]*", 0))
    lowered = F.when(u.contains("://"), F.concat(scheme, F.lit("://"), host, F.regexp_replace(rest, "^[^/]*", ""))).otherwise(u)
    bare = F.substring_index(lowered, "#", 1)
    slashes = F.length(bare) - F.length(F.replace(bare, F.lit("/"), F.lit("")))
    return F.when(u != "", F.when(bare.endswith("/") & (slashes > 3), F.regexp_replace(bare, "/+$", "")).otherwise(bare))


#: The namespace of ids that are made from URLs.
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def doc_id(url: Column) -> Column:
    """The version-5 UUID of a URL."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE)), F.encode(url, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


# The URL filter's lists.
DOMAINS = (
    "facebook.com", "twitter.com", "instagram.com", "tiktok.com", "pinterest.com", "linkedin.com", "snapchat.com", "whatsapp.com", "reddit.com", "tumblr.com", "discord.com", "telegram.org",
    "amazon.com", "ebay.com", "aliexpress.com", "wish.com", "alibaba.com", "etsy.com", "shopify.com",
    "bit.ly", "tinyurl.com", "t.co", "goo.gl", "ow.ly", "is.gd", "buff.ly", "j.mp", "soo.gd",
    "blogspot.", "wordpress.com", "weebly.com", "wix.com", "medium.com", "substack.com",
    "click.", "track.", "ads.", "pixel.", "analytics.",
)
PATHS = (
    r"/login", r"/signin", r"/signup", r"/register", r"/cart", r"/checkout", r"/basket", r"/order",
    r"/account", r"/profile", r"/settings", r"/preferences", r"/password", r"/forgot", r"/reset", r"/unsubscribe", r"/opt-out",
    r"/ads?/", r"/sponsor", r"/promo", r"/share\?", r"/tweet\?", r"/pin\?",
    r"\.(jpg|jpeg|png|gif|webp|svg|pdf|mp3|mp4|avi|mov)$", r"/tag/", r"/category/", r"/author/", r"/page/\d+", r"/p/\d+", r"\?replytocom=", r"#comment-",
)
EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".ico", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
    ".mp3", ".mp4", ".avi", ".mov", ".wmv", ".flv", ".zip", ".rar", ".tar", ".gz", ".7z", ".exe", ".dmg", ".pkg", ".deb", ".rpm",
    ".css", ".js", ".json", ".xml", ".rss", ".atom",
)


def filter_reason(url: Column, custom: tuple[str, ...] = ()) -> Column:
    """The first rule that blocks a URL: domain, custom, extension, path or length; null if it passes.
    Only the path is tested by the path rules."""
    host, path = F.lower(domain(url)), F.lower(F.regexp_replace(_part(url, 3), r";[^/]*$", ""))
    literal = lambda xs: "|".join(x.replace(".", r"\.") for x in xs)
    out = F.when(host.rlike(literal(DOMAINS)), "domain_blocked")
    if custom:
        out = out.when(host.isin(*custom), "custom_blocked")
    out = out.when(path.rlike(f"(?:{literal(EXTENSIONS)})$"), "extension_blocked")
    out = out.when(path.rlike("|".join(PATHS)), "path_blocked")
    return out.when(F.length(url) > 2000, "too_long")

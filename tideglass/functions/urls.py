"""URLs and hosts: cleaning, keys, registrable domains, scores by domain and path. Plain expressions, no parser per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

#: Fixed values.
TRACKING = ("gclid", "fbclid", "yclid", "mc_cid", "mc_eid", "ref", "ref_src", "_gl")
JP_SECOND_LEVEL = ("co.jp", "or.jp", "ne.jp", "go.jp", "ac.jp", "ed.jp", "lg.jp", "gr.jp", "ad.jp")
GENERIC_TOKENS = ("system", "systems", "tech", "technology", "consulting", "solution", "solutions", "soft", "software", "works", "service", "services", "info", "web")
IGNORED_LABELS = ("www", "co", "or", "ne", "go", "gr", "ed", "lg", "jp", "com", "net", "biz", "inc")
COMPANY_PATHS = ("/company", "/about", "/profile", "/overview", "/corporate")
OTHER_PATHS = ("/recruit", "/careers", "/job", "/jobs", "/blog", "/news", "/press", "/release", "/topics", "/media", "/information")

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _PARTS, 1))


def netloc(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _PARTS, 2))


def host(u: Column) -> Column:
    """Without port and user."""
    return F.regexp_replace(F.regexp_replace(netloc(u), r"^.*@", ""), r":[0-9]*$", "")


def bare_host(u: Column) -> Column:
    return F.regexp_replace(host(u), r"^www\.", "")


def path(u: Column) -> Column:
    return F.regexp_extract(u, _PARTS, 3)


def query(u: Column) -> Column:
    return F.regexp_extract(u, _PARTS, 4)


def cleaned(u: Column) -> Column:
    """An absolute http(s) URL without white space and fragment; https where no scheme is given; blank for anything else."""
    raw = F.regexp_replace(F.coalesce(u, F.lit("")), f"{SPACE}+", "")
    full = F.when(raw.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), raw).when(raw != "", F.concat(F.lit("https://"), raw)).otherwise("")
    return F.when(scheme(full).isin("http", "https") & (netloc(full) != ""), F.regexp_replace(full, "#.*$", "")).otherwise("")


def flag_key(u: Column) -> Column:
    """scheme://host/path for flags: no www, port, query or trailing slash; index pages count as the root."""
    p = F.regexp_replace(F.when(path(u) == "", F.lit("/")).otherwise(path(u)), r"(?i)^.*/index\.(html?|php|asp)$", "/")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    return F.when(bare_host(u) != "", F.concat(scheme(u), F.lit("://"), bare_host(u), F.when(p == "", F.lit("/")).otherwise(p))).otherwise("")


def cache_key(u: Column) -> Column:
    """Lower-cased host without its default port, single slashes, no trailing one, no fragment and no tracking parameters."""
    place = F.when(scheme(u) == "http", F.regexp_replace(netloc(u), ":80$", "")).when(scheme(u) == "https", F.regexp_replace(netloc(u), ":443$", "")).otherwise(netloc(u))
    p = F.regexp_replace(F.when(path(u) == "", F.lit("/")).otherwise(path(u)), "/{2,}", "/")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    keep = F.filter(F.split(query(u), "&"), lambda x: (x != "") & ~F.lower(F.split(x, "=")[0]).rlike("^utm_|^(" + "|".join(TRACKING) + ")$"))
    q = F.array_join(keep, "&")
    return F.when(netloc(u) == "", u).otherwise(F.concat(scheme(u), F.lit("://"), place, p, F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))))


def registrable(h: Column) -> Column:
    """The last two labels of a host, three below a Japanese second level."""
    labels = F.split(F.regexp_replace(F.lower(h), r"^\.+|\.+$", ""), r"\.")
    n = F.when(F.array_join(F.slice(labels, -2, 2), ".").isin(*JP_SECOND_LEVEL) & (F.size(labels) >= 3), 3).otherwise(2)
    return F.when(F.size(labels) < 2, F.array_join(labels, ".")).otherwise(F.array_join(F.slice(labels, -n, n), "."))


def host_in(h: Column, domains: Sequence[str]) -> Column:
    """Equal to a domain or below one."""
    return h.isin(*domains) | F.concat(F.lit("."), h).rlike(r"\.(" + "|".join(d.replace(".", r"\.") for d in domains) + ")$")


def parents(h: Column) -> Column:
    """A host and the domains above it: the keys of a suffix join against a list of any size."""
    labels = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 64), "."))


def domain_tokens(u: Column) -> Column:
    return F.filter(F.split(host(u), r"[.\-]"), lambda x: (x != "") & ~x.isin(*IGNORED_LABELS))


def has_segment(p: Column, marks: Sequence[str]) -> Column:
    low = F.lower(p)
    return F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(low, m))


def domain_score(u: Column, tokens: Column, suspicious: Sequence[str] = ()) -> Column:
    """How well a URL's host suits a company's tokens, without the fuzzy part.

    Top level 3, 2 or 1; a token of three characters or more 6 in the host, 4 in
    one of its labels, 3 in the path; 2 off for a generic label; company paths 3,
    news and recruiting ones -2; a suspicious word -3.
    """
    h, p, own = host(u), F.lower(path(u)), domain_tokens(u)
    close = F.regexp_replace(h, r"[.\-]", "")
    top = F.when(h.rlike(r"\.(co|or|go|ac)\.jp$"), 3).when(h.endswith(".jp"), 2).when(h.rlike(r"\.(com|net)$"), 1).otherwise(0)

    def one(t: Column) -> Column:
        found = F.when(F.contains(h, t) | F.contains(close, t), 6).otherwise(0) + F.when(F.exists(own, lambda d: F.contains(d, t)), 4).otherwise(0) + F.when(F.contains(p, t), 3).otherwise(0)
        return F.when(F.length(t) > 2, found).otherwise(0)

    score = top + F.aggregate(tokens, F.lit(0), lambda a, t: a + one(t))
    score = score - F.when(F.arrays_overlap(own, F.array(*[F.lit(g) for g in GENERIC_TOKENS])), 2).otherwise(0)
    score = score + F.when(has_segment(p, COMPANY_PATHS), 3).otherwise(0) - F.when(has_segment(p, OTHER_PATHS), 2).otherwise(0)
    return score - (F.when(has_segment(F.concat(h, p), suspicious), 3).otherwise(0) if suspicious else F.lit(0))


def path_score(u: Column, wanted: Sequence[str]) -> Column:
    """Six for the first wanted segment found, five for the second and so on, one at least; company paths 3, others -2."""
    p = F.lower(path(u))
    found = sum((F.when(F.contains(p, F.lit(w)), max(6 - i, 1)).otherwise(0) for i, w in enumerate(wanted)), F.lit(0))
    return found + F.when(has_segment(p, COMPANY_PATHS), 3).otherwise(0) - F.when(has_segment(p, (*OTHER_PATHS, "/store", "/shop")), 2).otherwise(0)


def unwrapped(u: Column, parameter: str = "uddg") -> Column:
    """The target that a redirect carries in a parameter, decoded twice; the URL itself if it carries none."""
    inner = F.regexp_extract(u, rf"[?&]{parameter}=([^&#]+)", 1)
    return F.when(inner != "", F.try_url_decode(F.coalesce(F.try_url_decode(inner), inner))).otherwise(u)


def fingerprint(page: Column, text: Column | None = None) -> Column:
    """SHA-256 of a page without comments, scripts, styles, dates and times; of its text where there is no page; blank for neither."""
    s = F.regexp_replace(F.coalesce(page, F.lit("")), r"(?s)<!--.*?-->", " ")
    for tag in ("script", "style", "noscript", "iframe"):
        s = F.regexp_replace(s, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    if text is not None:
        s = F.when(F.coalesce(page, F.lit("")) != "", s).otherwise(F.coalesce(text, F.lit("")))
    for stamp in (r"\b20[0-9]{2}[/-][0-9]{1,2}[/-][0-9]{1,2}\b", r"\b[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\b", r"20[0-9]{2}年[0-9]{1,2}月[0-9]{1,2}日"):
        s = F.regexp_replace(s, stamp, " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.when(s == "", s).otherwise(F.sha2(s, 256))

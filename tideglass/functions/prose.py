"""Descriptions, names in lists, numbers in words: checks and small rewritings, native; and what bytes and result pages hold."""

from __future__ import annotations

import base64
import binascii
import re
from urllib.parse import parse_qs, unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .pages import Page
from .text import mojibake, narrow, squeezed, stripped

_JAPANESE = "[ぁ-んァ-ン一-龥]"
#: Words that lead away from what a company does.
LEADING_AWAY = "お問い合わせ|採用|アクセス|所在地|電話|TEL|FAX"
#: Marks of pages that scripts fill, and of pages that ask for a human.
FILLED_BY_SCRIPT = ('id="__next"', 'id="__nuxt"', "__next_data__", "data-reactroot", "webpackjson", "react-dom", "window.__initial_state__")
ASKS_FOR_HUMAN = ("anomaly-modal__title", "duckduckgo.com/anomaly.js", "select all squares containing a duck", "bots use duckduckgo too", "captcha-delivery.com")
#: Offices by rank; from 70 on a name beside one is sure.
OFFICES = {"代表取締役社長": 100, "CEO": 95, "代表執行役社長": 90, "代表取締役": 85, "代表理事長": 80, "代表理事": 75, "社長": 70, "代表取締役会長": 60, "会長": 55, "代表社員": 50, "代表者": 45, "代表": 40, "取締役": 20}
#: What no address of a result may hold, and endings of files that are no pages.
NO_COMPANY = ("recipe", "cooking", "steak", "food", "gourmet", "kitchen")
NO_PAGE = re.compile(r"\.(?:pdf|jpe?g|png|gif|svg|webp|zip|docx?|xlsx?|pptx?|mp[34])$")


def described(c: Column, least: int, most: int, never: str | None = None) -> Column:
    """A description with blanks folded, null unless it is of such a length, Japanese, whole, and free of addresses, controls and ``never``."""
    s = F.trim(F.regexp_replace(c, r"\s+", " "))
    ok = (F.length(s) >= least) & (F.length(s) <= most) & s.rlike(_JAPANESE) & ~mojibake(c) & ~c.rlike("https?://|[@＠]") & ~s.rlike(r"[\x00-\x1f\x7f]")
    return F.when(ok & ~s.rlike(never) if never else ok, s)


def named(description: Column, name: Column, industry: Column) -> Column:
    """A description that names the company and its industry: the first name gets the industry, or both are put before it; first persons go."""
    d, n = stripped(F.coalesce(description, F.lit(""))), stripped(F.coalesce(name, F.lit("")))
    i = F.when(stripped(F.coalesce(industry, F.lit(""))) == "不明", "").otherwise(stripped(F.coalesce(industry, F.lit(""))))
    mark = F.when(i != "", F.concat(F.lit("（"), i, F.lit("）"))).otherwise("")
    body = F.regexp_replace(F.trim(F.regexp_replace(d, "。+$", "")), r"^(?:当社|弊社|私たち|わたしたち|当グループ)\s*(?:は|が)?[、,]?\s*", "")
    at = F.instr(d, n)
    inside = F.when((i != "") & ~F.contains(d, i), F.concat(F.substring(d, F.lit(1), at + F.length(n) - 1), mark, F.substring(d, at + F.length(n), F.length(d)))).otherwise(d)
    whole = F.when(n == "", F.when(body != "", F.concat(body, F.lit("。"))).otherwise(body)).otherwise(F.concat(n, mark, F.lit("は、"), body, F.lit("。")))
    return F.when(d == "", "").when((n != "") & (at > 0), inside).otherwise(whole)


def without_addresses(c: Column) -> Column:
    """Text without URLs and mail addresses."""
    return squeezed(F.regexp_replace(c, r"https?://\S+|www\.\S+|[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", " "))


def title_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"//|[|｜/\-–—:]"), stripped), lambda x: x != "")


def is_amount(c: Column) -> Column:
    """A number with a unit of money, and no head count."""
    return F.coalesce(~c.rlike("従業員|社員|職員|スタッフ") & ~c.rlike("(名|人)(?![\\p{L}\\p{N}_])") & c.rlike("[0-9０-９〇零一二三四五六七八九十百千万億兆]") & c.rlike("円|万|億|兆"), F.lit(False))


def last_name(c: Column) -> Column:
    """The last run of two to six Chinese characters that names no body or office."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"[一-龥]{1,4}[\s　]?[一-龥]{1,4}"), F.lit(0)), lambda x: F.regexp_replace(x, r"[\s　]", ""))
    return F.try_element_at(F.filter(found, lambda x: F.length(x).between(2, 6) & ~x.rlike("法人|学校|協会|委員会|役員")), F.lit(-1))


def holds_office(c: Column) -> Column:
    return F.coalesce(narrow(c).rlike("|".join(OFFICES)), F.lit(False))


def best_officer(c: Column) -> Column:
    """STRUCT(name, sure) of the highest office in a list of offices and names, the earlier of equals; null if none is named."""
    words = "|".join(sorted(OFFICES, key=len, reverse=True))
    rank = F.create_map(*[x for k, v in OFFICES.items() for x in (F.lit(k), F.lit(v))])
    pattern = rf"({words})[\s　:：・]{{0,4}}([一-龥ぁ-んァ-ン][一-龥ぁ-んァ-ン・･\s　]{{0,24}}?)(?=\s*(?:{words})|[、,/／]|$)"
    roles, names = F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.regexp_extract_all(c, F.lit(pattern), F.lit(2))
    rows = F.transform(F.arrays_zip(roles.alias("r"), names.alias("n")), lambda x, i: F.struct((-F.coalesce(F.try_element_at(rank, x["r"]), F.lit(0))).alias("s"), i.alias("i"), squeezed(x["n"]).alias("n")))
    best = F.array_min(F.filter(rows, lambda x: F.length(F.regexp_replace(x["n"], r"\s", "")) >= 2))
    return F.when(best.isNotNull(), F.struct(best["n"].alias("name"), (best["s"] <= -70).alias("sure")))


def full_address(c: Column) -> Column:
    """A postal code with a place behind it, or prefecture and municipality."""
    s = narrow(c)
    return F.coalesce(s.rlike(r"[0-9]{3}-?[0-9]{4}.*[都道府県市区町村郡丁番]") | s.rlike("[都道府県].+?[市区町村郡]"), F.lit(False))


def filled_by_script(html: Column, text: Column) -> Column:
    """A page that has little text before its scripts run."""
    low, n = F.lower(F.coalesce(html, F.lit(""))), F.length(stripped(F.coalesce(text, F.lit(""))))
    marked = F.lit(False)
    for m in FILLED_BY_SCRIPT:
        marked = marked | F.contains(low, F.lit(m))
    scripts = F.regexp_count(low, F.lit("<script"))
    return F.when(marked, n < 220).otherwise(((scripts >= 8) & (n < 220)) | ((scripts >= 4) & (n < 120) & (low.contains("<noscript") | low.contains("enable javascript"))))


def asks_for_human(html: Column) -> Column:
    low = F.lower(F.coalesce(html, F.lit("")))
    out = low.contains("captcha") & low.rlike("are you human|verify you are human|robot")
    for m in ASKS_FOR_HUMAN:
        out = out | F.contains(low, F.lit(m))
    return out


def decoded(raw: bytes | None, told: str | None = None) -> str | None:
    """The text of a page's bytes: by its own charset, then the one told, then the first of the usual ones that fits."""
    if raw is None:
        return None
    own = re.search(rb"charset=[\"']?([\w-]+)", raw[:10240], re.I)
    for name in ([own[1].decode("ascii")] if own else []) + ([told] if told else []):
        try:
            return raw.decode(name, "replace")
        except LookupError:
            continue
    for name in ("utf-8-sig", "cp932", "shift_jis", "euc_jp"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return raw.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def page_of_bytes(raw: pd.Series, told: pd.Series) -> pd.Series:
    return pd.Series([decoded(None if r is None else bytes(r), t) for r, t in zip(raw, told, strict=True)])


def _unwrapped(href: str, base: str) -> str | None:
    """A result's own address, out of the search page's redirect; null for the search page itself and what is no page of a company."""
    try:
        url = urljoin(base, href.strip())
        for _ in range(3):
            q = parse_qs(urlsplit(url).query)
            inner = next((q[k][0] for k in ("uddg", "u", "url", "q") if q.get(k) and (urlsplit(url).netloc.endswith(urlsplit(base).netloc.removeprefix("www.")))), None)
            if not inner:
                break
            if inner.startswith("a1"):
                inner = base64.urlsafe_b64decode(inner[2:] + "=" * (-len(inner[2:]) % 4)).decode("utf-8")
            url = unquote(inner) if not inner.startswith("http") else inner
        parts = urlsplit(url)
    except (ValueError, binascii.Error, UnicodeDecodeError):
        return None
    low = url.lower()
    if parts.scheme not in ("http", "https") or parts.netloc.endswith(urlsplit(base).netloc.removeprefix("www.")) or any(w in low for w in NO_COMPANY):
        return None
    if NO_PAGE.search(parts.path.lower()) and not (parts.path.lower().endswith(".pdf") and re.search("/(company|about|profile|overview|corporate)", parts.path.lower())):
        return None
    return url


def results(source: str | None, base: str) -> list[str]:
    """The addresses that a page of search results leads to, in order, each once; of a page without links those in its text."""
    hrefs = [h for h, _, _ in Page(source).links] or re.findall(r"https?://[^\s)<>\"']+", source or "")
    return list(dict.fromkeys(u for h in hrefs if h and (u := _unwrapped(h, base))))


@F.pandas_udf(ArrayType(StringType()))
def result_urls(source: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([results(s, b) for s, b in zip(source, base, strict=True)])

"""HTML pages: text, links, label-value candidates, JSON-LD. One Arrow crossing a page, standard library only."""

from __future__ import annotations

import json
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .address import PREFECTURES

_SKIP = {"script", "style", "noscript", "template", "svg"}
_FURNITURE = {"nav", "footer", "header", "aside"}
_BLOCK = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "section", "article", "dl", "dt", "dd", "td", "th", "main", "title", *_FURNITURE}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}


class Page(HTMLParser):
    """What one pass over a page's markup gives; broken markup gives what can be read."""

    def __init__(self, source: str | None):
        super().__init__(convert_charrefs=True)
        self.title, self.metas, self.links, self.headings, self.pairs, self.jsonld, self.forms, self.tables = "", {}, [], [], [], [], 0, 0
        self._main: list[str] = []
        self._all: list[str] = []
        self._foot: list[str] = []
        self._open: list[str] = []
        self._take: list[list] = []
        self.attributes: list[tuple[str, str]] = []
        self.beside: list[tuple[str, str]] = []
        self._texts: list[str] = []
        self._head: list[str] = []
        self._label: str | None = None
        self._ld: list[str] | None = None
        try:
            self.feed(source or "")
            self.close()
        except (AssertionError, ValueError):
            pass

    def handle_starttag(self, tag, attrs):
        at = {k: v or "" for k, v in attrs}
        if not self._in_navigation():
            for k in ("data-tel", "data-phone", "data-address", "aria-label", "alt", "content"):
                if at.get(k) and (k != "content" or at.get("itemprop")):
                    self.attributes.append((at.get("itemprop") or k, at[k]))
        if tag == "meta":
            name = (at.get("property") or at.get("name") or "").lower()
            if name:
                self.metas.setdefault(name, at.get("content", "").strip())
        elif tag == "script" and "ld+json" in at.get("type", ""):
            self._ld = []
        elif tag == "form":
            self.forms += 1
        elif tag in ("table", "dl"):
            self.tables += 1
        if tag in _BLOCK:
            for out in (self._main, self._all, self._foot):
                out.append("\n")
        if tag in ("a", "title", "h1", "h2", "h3", "th", "td", "dt", "dd"):
            self._take.append([tag, at, []])
        if tag not in _VOID:
            self._open.append(tag)

    def handle_endtag(self, tag):
        if tag in self._open:
            while self._open and self._open.pop() != tag:
                pass
        if tag == "script" and self._ld is not None:
            self.jsonld.append("".join(self._ld))
            self._ld = None
        for i in range(len(self._take) - 1, -1, -1):
            if self._take[i][0] == tag:
                _, at, parts = self._take.pop(i)
                self._done(tag, at, " ".join("".join(parts).split()))
                break
        if tag in _BLOCK:
            for out in (self._main, self._all, self._foot):
                out.append("\n")

    def _done(self, tag, at, text):
        if tag == "a":
            self.links.append((at.get("href", "").strip(), text, at.get("title", "")))
        elif tag == "title":
            self.title = self.title or text
        elif tag in ("h1", "h2", "h3"):
            self.headings.append((tag, text))
        elif tag in ("th", "dt"):
            self._label = text
        elif tag in ("td", "dd"):
            if self._label is None and text and len(text) <= 20:
                self._label = text
            elif self._label is not None:
                self.pairs.append((self._label, text))
                self._label = None

    def _in_navigation(self) -> bool:
        return "nav" in self._open or "aside" in self._open

    def handle_data(self, data):
        if self._ld is not None:
            self._ld.append(data)
        if any(t in _SKIP for t in self._open):
            return
        for take in self._take:
            take[2].append(data)
        if "header" in self._open and not self._in_navigation():
            self._head.append(data)
        if (piece := " ".join(data.split())) and not self._in_navigation() and not any(t[0] in ("td", "dd", "th", "dt", "a", "title") for t in self._take):
            # A short piece of text that names a field, and the piece after it: a label and its value without a table.
            if self._texts and field_of(self._texts[-1]) and not field_of(piece):
                self.beside.append((self._texts[-1], piece))
            self._texts.append(piece)
        self._all.append(data)
        (self._foot if "footer" in self._open else self._main).append(data if not any(t in _FURNITURE for t in self._open) or "footer" in self._open else "")

    @staticmethod
    def _lines(parts: list[str]) -> str:
        lines = (" ".join(x.split()) for x in "".join(parts).split("\n"))
        return "\n".join(x for x in lines if x)

    def text(self) -> str:
        """Visible text without a page's furniture, a line a block."""
        return unicodedata.normalize("NFKC", self._lines(self._main))

    def whole_text(self) -> str:
        return self._lines(self._all)

    def footer(self) -> str:
        return self._lines(self._foot)

    def header(self) -> str:
        return " ".join("".join(self._head).split())

    def objects(self) -> list[dict]:
        """JSON-LD objects, graphs opened; what doesn't parse is left out."""
        out, todo = [], []
        for raw in self.jsonld:
            try:
                todo.append(json.loads(raw))
            except ValueError:
                continue
        while todo:
            x = todo.pop(0)
            if isinstance(x, list):
                todo = x + todo
            elif isinstance(x, dict):
                out.append(x)
                todo = [v for v in x.values() if isinstance(v, (dict, list))] + todo
        return out


#: What labels mean.
LABELS = {
    "phone": ("電話", "tel", "電話番号", "代表電話", "phone"), "address": ("住所", "所在地", "本社所在地", "本店所在地", "本社", "address"),
    "rep": ("代表者", "代表", "代表取締役", "社長", "代表者名"), "capital": ("資本金",), "revenue": ("売上高", "売上", "年商"), "profit": ("利益", "営業利益", "経常利益", "純利益"),
    "employees": ("従業員", "従業員数", "社員数"), "fiscal_month": ("決算月", "決算期", "決算"), "founded": ("設立", "創業", "創立", "設立年月日"), "listing": ("上場", "上場区分", "証券コード"),
}
FIELDS = tuple(LABELS)
PHONE_NUMBER = re.compile(r"(?<![0-9])0[0-9]{1,4}[-(‐―－ー ]?[0-9]{1,4}[-)‐―－ー ]?[0-9]{3,4}(?![0-9])")
_ADDRESS = re.compile(r"(?:〒\s*|(?<![0-9-]))[0-9]{3}-?[0-9]{4}(?![0-9-])\s*[^\n]{0,60}|(?:" + "|".join(PREFECTURES) + r")[^\n]{2,60}")


def field_of(label: str) -> str | None:
    """The field that a label names: equal first, else the first whose word the label begins with."""
    s = re.sub(r"[\s:：()（）]", "", unicodedata.normalize("NFKC", label or "")).lower()
    if not s or len(s) > 20:
        return None
    for field, words in LABELS.items():
        if s in words:
            return field
    return next((f for f, words in LABELS.items() for w in words if s.startswith(w)), None)


#: What words before a number or an address say of it.
CONTEXTS = (("HQ", "本社|本店|本部"), ("REP", "代表"), ("BRANCH", "支店|営業所|工場|センター"), ("RECRUIT", "採用|求人"), ("SUPPORT", "サポート|コールセンター"), ("FAX", "FAX|ファックス|ファクス"))
#: What a field's value must look like; a value of another field has none of these.
VALUES = {
    "capital": re.compile("[0-9〇一二三四五六七八九十百千万億].*円|[0-9].*(?:万|億)|円"), "revenue": re.compile("[0-9〇一二三四五六七八九十百千万億].*円|[0-9].*(?:万|億)|円"),
    "profit": re.compile("[0-9〇一二三四五六七八九十百千万億].*円|[0-9].*(?:万|億)|円"), "employees": re.compile("[0-9〇一二三四五六七八九十百千]"),
    "fiscal_month": re.compile("[0-9〇一二三四五六七八九十].*月|月"), "founded": re.compile("[0-9]{4}|明治|大正|昭和|平成|令和"),
    "rep": re.compile(r"^(?!.*(?:https?://|@|[0-9]{4})).{2,60}$"), "listing": re.compile("^.{1,60}$"), "address": re.compile("[都道府県市区町村郡]|[0-9]{3}-?[0-9]{4}"),
}


def _context(around: str) -> list[str]:
    return [t for t, p in CONTEXTS if re.search(p, around, re.I)]


def numbers_of(value: str, around: str = "") -> list[tuple[str, list[str]]]:
    """The phone numbers in a value with the tags of what stands before each: ``TEL ... FAX ...`` gives one of either kind."""
    value, out, last = unicodedata.normalize("NFKC", value), [], 0
    for m in PHONE_NUMBER.finditer(value):
        out.append((m[0], _context(around + value[max(last, m.start() - 12) : m.start()])))
        last = m.end()
    return out


def candidates(text: str | None, source: str | None, page: Page | None = None) -> dict[str, list[str]]:
    """Tagged values of each field, in order and without repeats.

    Tables and lists (TABLE), labels with the text beside them (LABEL), tel:
    links (TELHREF), JSON-LD (JSONLD), attributes (ATTR), the header and footer
    (HEADER, FOOTER), then running text (TEXT). Navigation gives nothing. A
    value must look like one of its field.
    """
    page = page or Page(source)
    out: dict[str, list[str]] = {f: [] for f in FIELDS}

    def add(field: str, value: str, *tags: str) -> None:
        value = value.strip()
        item = "".join(f"[{t}]" for t in tags) + value
        if value and item not in out[field]:
            out[field].append(item)

    def labelled(label: str, value: str, tag: str) -> None:
        field = field_of(label)
        if field == "phone":
            for number, tags in numbers_of(value, label):
                add("phone", number, tag, *tags)
        elif field and (field not in VALUES or VALUES[field].search(unicodedata.normalize("NFKC", value))):
            add(field, value, tag, *(["HQ"] if field == "address" and re.search("本社|本店", label + value) else []))

    def loose(body: str, tag: str) -> None:
        body = unicodedata.normalize("NFKC", body or "")
        for line in body.split("\n"):
            for number, tags in numbers_of(line):
                add("phone", number, tag, *tags)
        for m in _ADDRESS.finditer(body):
            add("address", m[0], tag, *(["HQ"] if re.search("本社|本店", body[max(0, m.start() - 10) : m.start()]) else []))

    for label, value in page.pairs:
        labelled(label, value, "TABLE")
    for label, value in page.beside:
        labelled(label, value, "LABEL")
    for href, label, _ in page.links:
        if href.lower().startswith("tel:"):
            add("phone", unquote(href[4:]), "TELHREF", *_context(label))
    for obj in page.objects():
        place, founder = obj.get("address"), obj.get("founder")
        if isinstance(place, dict):
            place = " ".join(str(place.get(k) or "") for k in ("postalCode", "addressRegion", "addressLocality", "streetAddress")).strip()
        if isinstance(founder, dict):
            founder = founder.get("name")
        for field, value in (("phone", obj.get("telephone")), ("address", place), ("rep", founder), ("founded", obj.get("foundingDate"))):
            if isinstance(value, str):
                add(field, value, "JSONLD")
    for name, value in page.attributes:
        if "address" in name.lower() and VALUES["address"].search(value):
            add("address", value, "ATTR")
        else:
            for number, tags in numbers_of(value):
                add("phone", number, "ATTR", *tags)
    loose(page.header(), "HEADER")
    loose(page.footer(), "FOOTER")
    loose(text if text is not None else page.text(), "TEXT")
    return out


#: What paths and words of links are worth.
_RANKED_PATHS = {"/company": 12, "/about": 12, "/profile": 12, "/overview": 12, "/corporate": 12, "/contact": 8, "/access": 8, "/inquiry": 8, "/message": 6}
_RANKED_WORDS = {"会社概要": 8, "会社情報": 8, "企業情報": 8, "会社案内": 8, "about": 6, "company": 6, "profile": 6, "お問い合わせ": 4, "contact": 4, "アクセス": 4, "access": 4}


def ranked_links(base: str | None, source: str | None, most: int = 20, page: Page | None = None) -> list[tuple[str, int]]:
    """(url, score) of the links to the same host by (score down, depth, shorter first, url), each once; the first eight if none scores."""
    host, best, first = urlsplit(base or "").netloc.lower(), {}, []
    for href, label, title in (page or Page(source)).links:
        if not href or href.lower().startswith(("mailto:", "tel:", "javascript:", "#")):
            continue
        try:
            url = urljoin(base or "", href).split("#")[0]
            parts = urlsplit(url)
        except ValueError:
            continue
        if parts.scheme not in ("http", "https") or parts.netloc.lower() != host:
            continue
        low, word = unquote(parts.path.lower()), f"{label} {title}".lower()
        score = max((v for k, v in _RANKED_PATHS.items() if k in low), default=0) + max((v for k, v in _RANKED_WORDS.items() if k in word), default=0)
        best[url] = max(score, best.get(url, 0))
        first.append(url)
    found = sorted(((u, s) for u, s in best.items() if s > 0), key=lambda x: (-x[1], x[0].count("/"), len(x[0]), x[0]))[:most]
    return found or [(u, 0) for u in dict.fromkeys(first)][:8]


@F.pandas_udf(StructType([StructField(f, ArrayType(StringType())) for f in FIELDS]))
def page_candidates(text: pd.Series, source: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([candidates(t, s) for t, s in zip(text, source, strict=True)], columns=list(FIELDS))


@F.pandas_udf(StringType())
def visible_text(source: pd.Series) -> pd.Series:
    return source.map(lambda s: None if s is None else Page(s).text())


@F.pandas_udf(StringType())
def first_json(text: pd.Series) -> pd.Series:
    """The first JSON object or array in running text, null if none parses."""
    decoder = json.JSONDecoder()

    def one(s):
        for m in re.finditer(r"[{\[]", s or ""):
            try:
                return json.dumps(decoder.raw_decode(s, m.start())[0], ensure_ascii=False)
            except ValueError:
                continue
        return None

    return text.map(one)


def directory_score(url: Column, text: Column, source: Column) -> Column:
    """How much a page looks like a company directory: URL forms, numbers in it, words of its text, many links to companies; 10 is one.

    Words are looked for in the first 7,000 characters, as the rule says: directories name themselves at the top.
    """
    path = F.lower(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    strong = path.rlike(r"/(companies|company|corp|corporation|corporations|detail)/[0-9]+(/|$)|/instance/(detail|company|corporate|official)[-_]?[0-9]+(/|$)|/[0-9]{13}(/|$)")
    plain = path.rlike(r"/(companies|company|corporations|detail)/[0-9]+(/|$)|/instance/(detail|company|corporate|official)[-_]?[0-9]*(/|$)|/(directory|listing|db|search)(/|$)")
    number = query.rlike(r"(?i)(^|&)(corporate_?number|hojin_no|houjin_no|hojinbango|corporateno)=[0-9]{13}(&|$)")
    ident = query.rlike(r"(?i)(^|&)(company_?id|cid|id|detail_?id)=[0-9]{2,}(&|$)")
    t = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 7000))
    # Fixed values.
    words = ("掲載企業", "掲載情報", "掲載企業数", "企業一覧", "企業検索", "企業を探す", "検索", "絞り込み", "他社", "企業データベース", "企業db", "企業情報db", "企業情報サイト", "法人番号", "この企業情報は", "掲載している企業")
    found = sum((F.when(F.contains(t, F.lit(w)), 2).otherwise(0) for w in words), F.lit(0))
    found = found + F.when(t.rlike("(企業|会社).{0,6}(一覧|検索|データベース|db)"), 3).otherwise(0) + F.when(t.rlike("(掲載|登録).{0,8}(企業|会社)"), 3).otherwise(0)
    many = F.regexp_count(F.coalesce(source, F.lit("")), F.lit(r"(?i)href=[\"'][^\"']*(?:/companies/|/company/|/detail/)[0-9]+")) >= 4
    rules = ((strong, 10), (plain, 8), (number, 10), (ident, 4), (path.rlike("(^|[^0-9])[0-9]{13}([^0-9]|$)"), 10), (many, 6))
    return found + sum((F.when(c, v).otherwise(0) for c, v in rules), F.lit(0))



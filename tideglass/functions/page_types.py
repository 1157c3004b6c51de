"""What kind of page a page is: named signals of its markup, address and text, judged by a table of rules."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame

from .address import PREFECTURES
from .pages import PHONE_NUMBER, Page, ranked_links

#: Words of profile pages, of contact pages, of lists of offices, and labels of facts.
PROFILE_WORDS = (
    "会社概要", "会社情報", "企業情報", "企業概要", "会社案内", "企業案内", "会社紹介", "企業紹介", "基本情報", "法人概要", "団体概要",
    "outline", "profile", "overview", "summary", "company profile", "corporate profile", "company information",
)
CONTACT_WORDS = ("お問い合わせ", "お問合せ", "問合せ", "contact", "inquiry", "アクセス", "access", "所在地", "location")
OFFICE_WORDS = ("拠点一覧", "営業所一覧", "店舗一覧", "事業所一覧", "支店一覧", "工場一覧", "センター一覧", "拠点", "営業所", "事業所", "支店", "店舗", "工場", "センター")
FACT_WORDS = ("本社所在地", "本店所在地", "所在地", "住所", "電話", "tel", "代表", "代表取締役", "設立", "創業", "資本金", "従業員", "事業内容", "許認可")
PERSON_WORDS = ("代表取締役", "代表理事長", "代表理事", "代表者", "社長", "会長", "ceo")
#: Parts of the addresses of profile and of contact pages.
PROFILE_PATHS = (
    "/company", "/companyinfo", "/company-info", "/about", "/about-us", "/aboutus", "/corporate", "/profile", "/overview", "/summary", "/outline", "/guide",
    "/会社概要", "/会社案内", "/会社情報", "/企業情報", "/企業概要", "/法人概要", "/団体概要", "/gaiyo", "/gaiyou", "/kaisya", "/kaisha", "/annai",
)
CONTACT_PATHS = ("/contact", "/inquiry", "/access", "/toiawase")
#: So many postal codes, prefectures or words of offices make a list of offices; a directory's score.
MANY_CODES, MANY_PREFECTURES, MANY_OFFICES, DIRECTORY = 3, 6, 6, 10

_CODE = re.compile(r"[0-9]{3}[-‐―－ー]?[0-9]{4}")
_PLACE = re.compile(r"(都|道|府|県).+?(市|区|郡|町|村)")


@dataclass(frozen=True)
class Rule:
    """Gives ``kind`` where all of ``all``, one of ``any`` and none of ``none`` of a page's signals are there, and as many labels of facts."""

    kind: str
    reason: str
    all: str = ""
    any: str = ""
    none: str = ""
    labels: int = 0

    def holds(self, signals: frozenset[str], labels: int) -> bool:
        wanted, some = set(self.all.split()), set(self.any.split())
        return labels >= self.labels and wanted <= signals and (not some or bool(some & signals)) and not set(self.none.split()) & signals


#: In order; the first that holds decides. Signals: those of ``signals``.
RULES = (
    Rule("DIRECTORY_DB", "directory_like", all="directory"),
    Rule("COMPANY_PROFILE", "offices_beside_profile", all="offices table seat", any="heading path", labels=4),
    Rule("COMPANY_PROFILE", "offices_beside_person", all="offices table person", any="heading path seat", labels=3),
    Rule("BASES_LIST", "offices", all="offices"),
    Rule("COMPANY_PROFILE", "facts_in_table", all="table reachable", any="person seat", labels=3),
    Rule("COMPANY_PROFILE", "person_and_contact", all="person reachable", any="seat told", none="table"),
    Rule("COMPANY_PROFILE", "named_table", all="table", any="heading path", labels=4),
    Rule("COMPANY_PROFILE", "path_and_facts", all="path", any="seat person", labels=4),
    Rule("COMPANY_PROFILE", "heading_and_facts", all="heading", labels=3),
    Rule("ACCESS_CONTACT", "contact_heading", all="contact_heading"),
    Rule("ACCESS_CONTACT", "contact_text", all="contact_told reachable", none="person heading path told"),
    Rule("ACCESS_CONTACT", "contact_path", all="contact_path"),
    Rule("OTHER", "default"),
)


def signals(url: str | None, text: str | None, source: str | None, directory: int = 0, page: Page | None = None) -> tuple[frozenset[str], int, int]:
    """A page's signals, its number of labels of facts, and the greatest count that speaks for a list of offices."""
    page = page or Page(source)
    body = unicodedata.normalize("NFKC", text or page.whole_text())
    low, place = body.lower(), (url or "").lower()
    head = unicodedata.normalize("NFKC", "\n".join([page.title, *(t for _, t in page.headings)])).lower()
    names = lambda words, where: any(w in where for w in words)
    numbers = [m.span() for m in PHONE_NUMBER.finditer(body)]
    codes = sum(not any(a <= m.start() < b for a, b in numbers) for m in _CODE.finditer(body))
    prefectures, offices = sum(p in body for p in PREFECTURES), sum(w in low for w in OFFICE_WORDS)
    found = {
        "directory": directory >= DIRECTORY,
        "offices": names(("拠点一覧", "店舗一覧", "営業所一覧"), head) or codes >= MANY_CODES or prefectures >= MANY_PREFECTURES or offices >= MANY_OFFICES,
        "table": bool(page.tables),
        "seat": names(("本社", "本店"), body),
        "person": names(PERSON_WORDS, low),
        "heading": names(PROFILE_WORDS, head),
        "path": names(PROFILE_PATHS, unquote(place)),
        "told": names(PROFILE_WORDS, low),
        "reachable": bool(numbers) or "〒" in body or bool(_CODE.search(body)) or bool(_PLACE.search(body)),
        "contact_heading": names(CONTACT_WORDS, head),
        "contact_told": names(CONTACT_WORDS, low),
        "contact_path": names(CONTACT_PATHS, place),
    }
    return frozenset(k for k, v in found.items() if v), sum(w in low for w in FACT_WORDS), max(codes, prefectures, offices)


def page_type(url: str | None, text: str | None, source: str | None, directory: int = 0, page: Page | None = None) -> tuple[str, int, str]:
    """(type, score, reason) by the first rule that holds; the score is the count that the type goes by."""
    found, labels, offices = signals(url, text, source, directory, page)
    rule = next(r for r in RULES if r.holds(found, labels))
    return rule.kind, {"DIRECTORY_DB": directory, "BASES_LIST": offices}.get(rule.kind, labels), rule.reason


def outlines(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row a page: title, first h1, description, text, numbers of links, forms and JSON-LD objects, type, and ranked links. Markup is read once."""
    schema = f"{page_id} long, title string, h1 string, description string, text string, n_links int, n_forms int, n_objects int, page_type string, type_score int, reason string, links array<struct<url: string, score: int>>"

    def run(batches):
        for df in batches:
            rows = []
            for i, u, s in zip(df[page_id], df[url], df[source], strict=True):
                p = Page(s)
                h1 = next((t for tag, t in p.headings if tag == "h1"), None)
                links = [{"url": a, "score": b} for a, b in ranked_links(u, s, page=p)]
                rows.append((i, p.title or None, h1, p.metas.get("description") or p.metas.get("og:description"), p.text(), len(p.links), p.forms, len(p.objects()), *page_type(u, None, s, page=p), links))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in re.sub(r"<.*>", "", schema).split(", ")])

    return pages.select(page_id, url, source).mapInPandas(run, schema)

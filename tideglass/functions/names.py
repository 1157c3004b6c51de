"""Company and person names."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .address import PREFECTURES
from .phone import tags, untagged
from .text import narrow

#: Fixed values.
CORPORATE = ("株式会社", "有限会社", "合同会社", "合名会社", "合資会社", "(株)", "(有)", "㈱", "㈲", "一般社団法人", "一般財団法人", "公益社団法人", "公益財団法人", "社会福祉法人", "医療法人", "学校法人")
ROLES = ("代表取締役", "代表理事", "代表社員", "代表者", "代表", "取締役", "社長", "会長", "理事長", "院長", "学長", "園長", "校長", "CEO", "COO")
NOT_NAMES = ("お問い合わせ", "メニュー", "サイト", "会社", "概要", "案内", "採用", "情報", "所在地", "電話", "株式", "事業", "挨拶", "メッセージ", "プロフィール", "氏名", "名前", "役員", "一覧", "受付", "時間")
ENTITY = {"gov": r"市役所|区役所|町役場|村役場|県庁|都庁|府庁|省$|庁$", "edu": r"大学|高校|高等学校|中学校|小学校|学園|幼稚園", "med": r"病院|クリニック|医院|診療所", "npo": r"NPO|特定非営利活動法人|協会|組合|財団|社団"}


def company_key(c: Column) -> Column:
    """A company's name without corporate forms, white space and punctuation, small narrow letters."""
    s = F.lower(narrow(c))
    s = F.regexp_replace(s, "|".join(re.escape(x) for x in CORPORATE), "")
    return F.regexp_replace(s, r"[\s\-‐―－ー–—|｜/:：,，.。・･…()（）\[\]【】<>＜＞]", "")


def entity_kinds(c: Column) -> Column:
    """gov, edu, med and npo by their words; none for a private company."""
    kinds = F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(k)) for k, p in ENTITY.items()]))
    return F.when(c.rlike("株式会社|有限会社|合同会社"), F.array().cast("array<string>")).otherwise(kinds)


def ambiguous(c: Column) -> Column:
    return F.length(company_key(c)) <= 2


def skipped(c: Column) -> Column:
    """Names that aren't companies to enrich: prefectures, offices of government, branches without a corporate form."""
    private = c.rlike("株式会社|有限会社|合同会社|合資会社|合名会社")
    return F.coalesce(c.isin(*PREFECTURES) | (~private & (c.rlike(ENTITY["gov"]) | c.rlike("(支店|営業所|出張所|工場)$"))), F.lit(False))


def clean_person(raw: str | None) -> str | None:
    """A person's name out of a representative field: tags, roles, brackets, dates and contacts gone; None if no name is left."""
    if not raw:
        return None
    s = unicodedata.normalize("NFKC", re.sub(r"<[^>]*>|^(?:\[[A-Z_]+\])+", " ", raw))
    s = re.split(r"(?:TEL|FAX|https?://|www\.|@|電話|住所|〒|生年月日|略歴)", s)[0]
    s = re.sub(r"[((【\[].*?[))】\]]", " ", s)
    s = re.sub(r"(?:代表者名|代表者氏名|氏名|名前|役職)\s*[:：]?", " ", s)
    for role in ROLES:
        s = s.replace(role, " ")
    s = re.sub(r"(?:副|専務|常務|執行役員|最高経営責任者|兼|氏|様|さん|先生)(?=\s|$)|[:：、,/|・]", " ", s)
    s = re.sub(r"\s+", " ", s).strip()
    if not s or len(s) > 20 or re.search(r"[0-9。！？!?]", s) or any(w in s for w in NOT_NAMES) or any(p in s for p in PREFECTURES):
        return None
    if any(w in s for w in ("株式会社", "有限会社", "合同会社")):
        return None
    if re.fullmatch(r"[A-Za-z][A-Za-z .'-]{2,}", s):
        return s if " " in s else None
    if re.fullmatch(r"[぀-ゟ゠-ヿ一-鿿々ヶ]+(?: [぀-ゟ゠-ヿ一-鿿々ヶ]+){0,2}", s) is None:
        return None
    if re.fullmatch(r"[゠-ヿ]+", s.replace(" ", "")) and " " not in s:
        return None
    size = len(s.replace(" ", ""))
    return s if 2 <= size <= 12 and re.search(r"[一-鿿]|.\s.", s) else None


@F.pandas_udf(StringType())
def person(s: pd.Series) -> pd.Series:
    return s.map(clean_person)


def best_person(candidates: Column, url: Column | None = None) -> Column:
    """The best of tagged names: length, profile URL 3, table 5, label 3, a role in the raw value 8, three or more parts -6; the first of equals."""
    bonus = F.when(F.coalesce(url if url is not None else F.lit(""), F.lit("")).rlike("(?i)/(company|about|profile|overview|corporate|message)"), 3).otherwise(0)
    strip = F.transform(candidates, lambda c, i: F.struct(F.trim(F.regexp_replace(untagged(c), "|".join(ROLES), " ")).alias("v"), c.alias("raw"), i.alias("i")))
    ok = F.filter(strip, lambda r: (F.length(r["v"]) >= 2) & (F.length(r["v"]) <= 20) & ~r["v"].rlike("[0-9]|" + "|".join(NOT_NAMES)))

    def score(r: Column) -> Column:
        t = tags(r["raw"])
        rules = ((F.array_contains(t, "TABLE"), 5), (F.array_contains(t, "LABEL"), 3), (r["raw"].rlike("|".join(ROLES)), 8), (F.size(F.split(r["v"], r"\s+")) >= 3, -6))
        return F.length(r["v"]) + bonus + sum((F.when(c, v).otherwise(0) for c, v in rules), F.lit(0))

    return F.array_min(F.transform(ok, lambda r: F.struct((-score(r)).alias("s"), r["i"].alias("i"), r["v"].alias("v"))))["v"]


def _plain(text: str | None) -> str:
    s = unicodedata.normalize("NFKC", text or "")
    for form in CORPORATE:
        s = s.replace(unicodedata.normalize("NFKC", form), "")
    return re.sub(r"[\s\-‐―ー–—|/:,.。・…()\[\]【】<>]+", "", s)


_JAPANESE = re.compile(r"[぀-ヿ一-鿿]")


def name_match(name: str | None, candidates: list[str | None]) -> tuple[float, bool, bool, str]:
    """(ratio, exact, partial only, best candidate) of a name against what a page calls itself.

    1 if equal; one within the other counts 0.69 at most, near-equal Japanese
    names 0.88, and a name of two characters found as a part 0.4.
    """
    own, best = _plain(name), (0.0, False, False, "")
    for raw in candidates:
        other = _plain(raw)
        if not own or not other:
            continue
        ratio, exact = SequenceMatcher(None, own, other).ratio(), own == other
        part = not exact and (own in other or other in own)
        if exact:
            ratio = 1.0
        elif part and min(len(own), len(other)) >= 3:
            ratio = min(ratio, 0.69)
        elif not part and ratio >= 0.9 and abs(len(own) - len(other)) <= 1 and _JAPANESE.search(own) and _JAPANESE.search(other):
            ratio = min(ratio, 0.88)
        if ratio > best[0]:
            best = (ratio, exact, part, raw)
    if len(own) <= 2 and best[2]:
        best = (min(best[0], 0.4), *best[1:])
    return best


@F.pandas_udf(StructType([StructField("ratio", DoubleType()), StructField("exact", BooleanType()), StructField("partial_only", BooleanType()), StructField("candidate", StringType())]))
def name_ratio(name: pd.Series, candidates: pd.Series) -> pd.DataFrame:
    rows = [name_match(n, list(c) if c is not None else []) for n, c in zip(name, candidates, strict=True)]
    return pd.DataFrame(rows, columns=["ratio", "exact", "partial_only", "candidate"])

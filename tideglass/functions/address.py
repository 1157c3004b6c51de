"""Japanese postal addresses: parts, tests, keys, cleaning, splitting and choice."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .numbers import KANJI_DIGITS, kanji_value
from .phone import tags, untagged
from .text import narrow, squeezed

#: The prefectures by their codes.
PREFECTURES = (
    "北海道 青森県 岩手県 宮城県 秋田県 山形県 福島県 茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県 新潟県 富山県 石川県 福井県 山梨県 長野県 "
    "岐阜県 静岡県 愛知県 三重県 滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県 鳥取県 島根県 岡山県 広島県 山口県 徳島県 香川県 愛媛県 高知県 "
    "福岡県 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県"
).split()
HEAD_OFFICE = ("本社", "本店", "本部", "本社所在地", "本店所在地")
BRANCH = ("支店", "支社", "営業所", "出張所", "工場", "倉庫", "センター", "事業所", "店舗")
_PREF = "(" + "|".join(PREFECTURES) + ")"
_ZIP = r"([0-9]{3})[-‐―－ー−]?([0-9]{4})"
HYPHEN = "[‐‑–—―−－ｰ]"


def prefecture(c: Column) -> Column:
    """The first prefecture named, null if none."""
    return F.nullif(F.regexp_extract(c, _PREF, 1), F.lit(""))


def postal_code(c: Column) -> Column:
    """NNN-NNNN, null if none."""
    s = narrow(c)
    a, b = (F.regexp_extract(s, rf"(?<![0-9]){_ZIP}(?![0-9])", n) for n in (1, 2))
    return F.when(a != "", F.concat(a, F.lit("-"), b))


def has_zip(c: Column) -> Column:
    return F.coalesce(c.rlike("[0-9]{3}-[0-9]{4}"), F.lit(False))


def has_city(c: Column) -> Column:
    return F.coalesce(c.rlike("[市区町村郡]"), F.lit(False))


def city(c: Column) -> Column:
    rest = F.regexp_replace(c, f"^.*?{_PREF}", "")
    return F.nullif(F.regexp_extract(rest, r"([぀-ヿ一-鿿]{1,6}?[市区町村郡])", 1), F.lit(""))


def prefecture_only(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(narrow(c), rf"〒?\s*{_ZIP}", ""), r"\s+", "")
    return F.coalesce(s.isin(*PREFECTURES), F.lit(False))


def verifiable(c: Column) -> Column:
    """A postal code, a municipality, or a number with a block mark."""
    s = narrow(c)
    return F.coalesce(s.rlike(_ZIP) | city(s).isNotNull() | s.rlike("[0-9]\\s*(丁目|番)"), F.lit(False))


def looks_like(c: Column) -> Column:
    """A postal code, or prefecture and municipality, or either with numbers; three prefectures are a form."""
    s = narrow(c)
    n = F.size(F.array_distinct(F.regexp_extract_all(s, F.lit(_PREF), F.lit(1))))
    place, number = (n > 0) | has_city(s), s.rlike(r"[0-9]{1,4}\s*[-‐―－ー−]\s*[0-9]{1,4}") | (s.rlike("[0-9]") & s.rlike("丁目|番地|号|ビル|マンション"))
    form = s.contains("郵便番号") & ~s.rlike(_ZIP)
    return F.coalesce(~form & (n < 3) & (s.rlike(_ZIP) | ((n > 0) & has_city(s)) | (place & number)), F.lit(False))


def key(c: Column) -> Column:
    """What two spellings of an address share: narrow forms, one hyphen, no white space, postal mark or brackets, small letters."""
    s = F.regexp_replace(F.lower(narrow(c)), HYPHEN, "-")
    return F.regexp_replace(s, r"[\s〒()（）\[\]「」,、]", "")


def compatible(a: Column, b: Column, n: int = 8) -> Column:
    """Either key holds the other's first characters; true where one is missing."""
    x, y = F.coalesce(key(a), F.lit("")), F.coalesce(key(b), F.lit(""))
    return (x == "") | (y == "") | F.contains(y, F.substring(x, 1, n)) | F.contains(x, F.substring(y, 1, n))


def segments(c: Column) -> Column:
    """Addresses run together, parted before each postal code, or before each prefecture if there are not two of those."""
    s = squeezed(narrow(c))
    zips = F.size(F.regexp_extract_all(s, F.lit(_ZIP), F.lit(0)))
    by_zip = F.split(s, rf"(?=〒?\s?(?<![0-9〒]){_ZIP})")
    by_pref = F.split(s, f"(?={_PREF})")
    parts = F.when(zips >= 2, by_zip).otherwise(by_pref)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x.rlike(_PREF) | x.rlike(_ZIP) | (F.size(parts) == 1))


def segment_score(s: Column) -> Column:
    """Head office 10, branch -6, postal code 3, prefecture 2, municipality in it 2, a digit 1, words of a page's furniture -4."""
    mark = lambda words: s.rlike("|".join(words))
    rules = ((mark(HEAD_OFFICE), 10), (mark(BRANCH), -6), (s.contains("〒") | s.rlike(_ZIP), 3), (s.rlike(_PREF), 2), (s.rlike("[都道府県].{0,20}[市区町村郡]"), 2), (s.rlike("[0-9]"), 1), (F.lower(s).rlike("メニュー|スキップ|privacy|cookie|copyright"), -4))
    return sum((F.when(c, v).otherwise(0) for c, v in rules), F.lit(0))


def best_segment(c: Column) -> Column:
    """The segment of the highest score, the earliest of equals."""
    rows = F.transform(segments(c), lambda s, i: F.struct((-segment_score(s)).alias("s"), i.alias("i"), s.alias("seg")))
    return F.array_min(rows)["seg"]


#: The weight of where a candidate stood.
SOURCE_SCORES = {"JSONLD": 5, "TABLE": 4, "LABEL": 3, "FOOTER": 1, "TEXT": 0}


def best_candidate(candidates: Column, expected: Column) -> Column:
    """The best of tagged address candidates.

    Postal code 6 (8 with an expected address), municipality 4, block 2,
    building 1, head office 4, and the source's weight. Against an expected
    address the same prefecture counts 3 and another -10, and a shared key 6.
    """
    weights = F.create_map(*[x for k, v in SOURCE_SCORES.items() for x in (F.lit(k), F.lit(v))])

    def score(c: Column) -> Column:
        s, t = untagged(c), tags(c)
        source = F.aggregate(t, F.lit(0), lambda a, x: F.greatest(a, F.coalesce(F.try_element_at(weights, x), F.lit(0))))
        rules = ((s.rlike(_ZIP), 6), (has_city(s), 4), (s.rlike("丁目|番地|[0-9]-[0-9]"), 2), (s.rlike("ビル|マンション|[0-9]F|[0-9]階"), 1), (F.array_contains(t, "HQ"), 4))
        base = source + sum((F.when(c_, v).otherwise(0) for c_, v in rules), F.lit(0))
        pa, pb = prefecture(expected), prefecture(s)
        known = F.when(pa.isNotNull() & pb.isNotNull(), F.when(pa == pb, 3).otherwise(-10)).otherwise(0) + F.when(compatible(expected, s), 6).otherwise(0) + F.when(postal_code(expected) == postal_code(s), 2).otherwise(0)
        return base + F.when(F.coalesce(expected, F.lit("")) != "", known).otherwise(0)

    rows = F.transform(candidates, lambda c, i: F.struct((-score(c)).alias("s"), i.alias("i"), F.trim(untagged(c)).alias("v")))
    return F.array_min(F.filter(rows, lambda r: looks_like(r["v"])))["v"]


_LABELS = re.compile(r"^(?:.*(?:本社所在地|本店所在地|所在地|住所|本社|本店)\s*[:：]?\s*)+")
_TAIL = re.compile(r"\s*(?:TEL|Tel|電話|FAX|Fax|E-?mail|メール|地図|アクセス|MAP|Google|営業時間|定休日|代表者|代表取締役|[→⇒]|https?://|www\.).*$", re.S)
_NUMERAL = re.compile(f"([{KANJI_DIGITS}十百千]+)(?=丁目|番地|番|号|[-‐−])")


def clean_address(raw: str | None) -> str | None:
    """One address as 〒NNN-NNNN rest: markup, labels and what follows gone, narrow digits, kanji numerals before block marks as digits; None if it isn't one."""
    if not raw or "�" in raw or re.match(r"\s*[\[{].*[:\"].*[\]}]\s*$", raw, re.S):
        return None
    s = unicodedata.normalize("NFKC", re.sub(r"<[^>]*>", " ", raw))
    s = re.sub(r"\s+", " ", s).strip()
    s = _TAIL.sub("", _LABELS.sub("", s))
    s = re.sub(r"[((](?:地図|アクセス|案内)[^))]*[))]", "", s)
    s = re.sub(HYPHEN, "-", s)
    s = re.sub(r"(?<=[0-9])ー(?=[0-9])", "-", s)
    s = _NUMERAL.sub(lambda m: str(kanji_value(m[1])), s)
    zips = re.search(r"〒?\s*(?<![0-9])([0-9]{3})-?([0-9]{4})(?![0-9])", s)
    head = f"〒{zips[1]}-{zips[2]} " if zips else ""
    if zips:
        s = s[: zips.start()] + s[zips.end() :]
    s = re.sub(r"^[\s:,、。・〒]+|[\s:,、。・]+$", "", s)
    found = {p for p in PREFECTURES if p in s}
    if len(found) >= 3 or not s or not (found or head or re.search(r"[市区町村郡]", s)):
        return None
    return re.sub(r" {2,}", " ", head + s)


@F.pandas_udf(StringType())
def address(s: pd.Series) -> pd.Series:
    return s.map(clean_address)

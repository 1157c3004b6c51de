"""Amounts, head counts, months and years written the Japanese way."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .text import narrow

#: Fixed values.
KANJI_DIGITS = "〇一二三四五六七八九"
ERAS = {"明治": 1868, "大正": 1912, "昭和": 1926, "平成": 1989, "令和": 2019, "M": 1868, "T": 1912, "S": 1926, "H": 1989, "R": 2019}
QUALIFIERS = ("約", "およそ", "程度", "前後", "強", "弱", "ほど", "規模", "以上", "未満", "超")
_SMALL, _LARGE = {"十": 10, "百": 100, "千": 1000}, {"万": 10**4, "億": 10**8, "兆": 10**12}


def kanji_value(text: str) -> int | None:
    """The value of a numeral of kanji, digits or both; null if there is anything else."""
    total = section = 0
    digit = ""
    for ch in text:
        if ch in KANJI_DIGITS:
            digit += str(KANJI_DIGITS.index(ch))
        elif ch.isascii() and ch.isdigit():
            digit += ch
        elif ch in _SMALL:
            section += int(digit or 1) * _SMALL[ch]
            digit = ""
        elif ch in _LARGE:
            total += (section + int(digit or 0) or 1) * _LARGE[ch]
            section, digit = 0, ""
        else:
            return None
    return total + section + int(digit or 0) if text else None


@F.pandas_udf(LongType())
def kanji_numeral(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else kanji_value(x)).astype("Int64")


def amount_yen(c: Column) -> Column:
    """Yen as a decimal: 兆, 億, 万, 百万円 and 千円 parts added up, else the first number; ▲, △ and - mean a loss; null unless above 0 before the sign."""
    s = F.regexp_replace(narrow(c), r"\s+", "")
    loss = s.rlike("^[▲△-]")
    s = F.regexp_replace(s, "^[▲△-]+", "")
    s = F.regexp_replace(s, "[(),（）]|" + "|".join(QUALIFIERS), "")
    million = r"([0-9]+(?:\.[0-9]+)?)百万円"
    total = F.lit(0.0)

    def sums(pattern: str, factor: float) -> Column:
        found = F.regexp_extract_all(s, F.lit(pattern), F.lit(1))
        return F.aggregate(found, F.lit(0.0), lambda a, x: a + x.cast("double") * factor)

    parts = [(r"([0-9]+(?:\.[0-9]+)?)兆", 1e12), (r"([0-9]+(?:\.[0-9]+)?)億", 1e8), (r"([0-9]+(?:\.[0-9]+)?)万", 1e4), (million, 1e6), (r"([0-9]+(?:\.[0-9]+)?)千円", 1e3)]
    for pattern, factor in parts:
        total = total + sums(pattern, factor)
    first = F.regexp_extract(s, r"([0-9]+(?:\.[0-9]+)?)", 1)
    value = F.when(total > 0, total).when(first != "", first.cast("double"))
    return F.when(value > 0, F.round(value, 0).cast("decimal(38,0)") * F.when(loss, -1).otherwise(1))


def amount_text(c: Column) -> Column:
    """As ``amount_yen``, written N,NNN円 with ▲ for a loss."""
    v = amount_yen(c)
    return F.concat(F.when(v < 0, F.lit("▲")).otherwise(""), F.format_number(F.abs(v), 0), F.lit("円"))


def employees(c: Column) -> Column:
    """a-b名, 約N名 or N名; blank if no head count is given."""
    s = F.regexp_replace(F.trim(narrow(c)), "[,，]", "")
    unit = "(?:名|人)"
    low, high = (F.regexp_extract(s, rf"([0-9]{{1,6}})\s*{unit}?\s*[~〜～\-－―–]\s*([0-9]{{1,6}})\s*{unit}", n) for n in (1, 2))
    about, n = (F.regexp_extract(s, rf"(約)?\s*([0-9]{{1,6}})\s*{unit}", i) for i in (1, 2))
    alone = F.regexp_extract(s, r"^([0-9]{1,6})$", 1)
    return F.when(low != "", F.concat(low, F.lit("-"), high, F.lit("名"))).when(n != "", F.concat(about, n, F.lit("名"))).when(alone != "", F.concat(alone, F.lit("名"))).otherwise("")


def fiscal_month(c: Column) -> Column:
    """N月 from a quarter, a month, or else the first number from 1 to 12; blank if none."""
    s = F.translate(F.trim(narrow(c)), "期末", "月月")
    quarter = F.regexp_extract(s, "^[Qq]([1-4])$", 1)
    month = F.regexp_extract(s, r"(1[0-2]|0?[1-9])\s*月", 1)
    number = F.regexp_extract(s, "(1[0-2]|0?[1-9])", 1)
    n = F.when(quarter != "", quarter.cast("int") * 3).when(month != "", month.cast("int")).when(number != "", number.cast("int"))
    return F.coalesce(F.concat(n.cast("string"), F.lit("月")), F.lit(""))


def era_year(c: Column) -> Column:
    """The Gregorian year of an era year (元 is 1), else null."""
    s = narrow(c)
    pattern = "(明治|大正|昭和|平成|令和|[MTSHRmtshr])\\s*([0-9]+|元)"
    era, year = F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)
    n = F.when(year == "元", 1).when(year != "", F.substring(year, 1, 4).cast("int"))
    base = F.create_map(*[x for k, v in ERAS.items() for x in (F.lit(k), F.lit(v))])
    return F.when(n.between(1, 300), F.try_element_at(base, F.upper(era)) + n - 1)


def founded_year(c: Column, eras: bool = True) -> Column:
    """The era year, else the first of 1xxx or 2xxx; without ``eras`` the first from 1800 to 2099."""
    four = F.regexp_extract(narrow(c), r"([12][0-9]{3})" if eras else r"((?:18|19|20)[0-9]{2})", 1)
    plain = F.when(four != "", four.cast("int"))
    return F.coalesce(era_year(c), plain) if eras else plain


def whole_number(c: Column) -> Column:
    """An integer from text with commas, decimals or words round it; null if it has no digit."""
    s = F.replace(narrow(c), F.lit(","), F.lit(""))
    return F.coalesce(s.try_cast("double").cast("long"), F.regexp_extract(s, "([0-9]+)", 1).try_cast("long"))

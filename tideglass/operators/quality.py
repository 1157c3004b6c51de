"""Column-wise audits unpivoted to issues, risk scores, and fact checks against evidence pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions import address as A
from tideglass.functions.text import digits, narrow, snippet, stripped

URL = r"(?i)https?://|www\."
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"0[0-9]{1,4}[-(‐―－ー ]?[0-9]{1,4}[-)‐―－ー ]?[0-9]{3,4}"
ZIP = r"[0-9]{3}-?[0-9]{4}"
#: Fixed values.
SEVERITIES = ("low", "medium", "high")
ISSUE_WEIGHTS = {
    "rep_missing": 1, "rep_label_only": 3, "rep_contains_url": 4, "rep_contains_email": 4, "rep_contains_phone": 4, "rep_looks_like_address": 4,
    "rep_contains_company_suffix": 3, "rep_contains_contact_words": 2, "rep_sentence_like": 2, "rep_contains_many_digits": 2, "rep_too_long": 2,
    "rep_non_japanese_long": 1, "address_missing": 1, "address_contains_url": 4, "address_contains_email": 4, "address_contains_phone": 4,
    "address_contains_rep_title": 3, "address_no_prefecture_or_zip": 3, "address_too_short": 2, "address_too_long": 2, "address_looks_like_name": 2,
}

#: A check: (code, severity, condition of the value).
Check = tuple[str, str, Column]


def _script(s: Column) -> Column:
    """Markup or script; a pattern is tried only where its word is."""
    low = F.lower(s)
    return (s.contains("<") & s.rlike("<[a-zA-Z/!][^>]*>")) | (low.contains("function") & low.rlike(r"function\s*\(")) | (low.contains("var") & low.rlike(r"var\s+[a-z_]+\s*=")) | low.contains("document.") | low.contains("window.")


def common(s: Column) -> list[Check]:
    return [("too_long", "medium", F.length(s) >= 600), ("html_or_js_noise", "high", _script(s)), ("mojibake_replacement_char", "medium", s.contains("�"))]


def url_checks(s: Column) -> list[Check]:
    return common(s) + [("url_not_http", "high", ~s.rlike("^https?://")), ("url_contains_space", "high", s.contains(" "))]


def phone_checks(s: Column) -> list[Check]:
    return common(s) + [("phone_contains_url_or_email", "high", s.rlike(URL) | s.rlike(EMAIL)), ("phone_too_short", "high", F.length(digits(s)) < 9), ("phone_pattern_mismatch", "medium", ~s.rlike(PHONE))]


def address_checks(s: Column) -> list[Check]:
    junk = "コンテンツへスキップ|プライバシ|cookie|all rights reserved|copyright|メニュー|資料ダウンロード"
    return common(s) + [
        ("address_contains_url_or_email", "high", s.rlike(URL) | s.rlike(EMAIL)),
        ("address_contains_phone", "high", F.length(digits(F.regexp_extract(s, PHONE, 0))) >= 10),
        ("address_no_pref_or_zip", "medium", A.prefecture(s).isNull() & ~s.rlike(ZIP)),
        ("address_multiple_zips", "high", F.regexp_count(s, F.lit(ZIP)) >= 2),
        ("address_contains_ui_junk", "high", F.lower(s).rlike(junk)),
    ]


def person_checks(s: Column) -> list[Check]:
    label = "代表取締役|取締役|社長|会長|代表者名|代表者|口コミ件数|受付時間|免許|資格"
    contact = s.rlike(URL) | s.rlike(EMAIL) | s.rlike(PHONE) | s.rlike(ZIP) | A.prefecture(s).isNotNull()
    return common(s) + [("rep_contains_contact_or_address", "high", contact), ("rep_label_or_non_name", "medium", s.rlike(label) & (F.length(s) <= 20)), ("rep_too_long", "medium", F.length(s) >= 80), ("rep_contains_digits", "medium", narrow(s).rlike("[0-9]"))]


def number_checks(s: Column) -> list[Check]:
    return common(s) + [("numeric_contains_url_or_email", "high", s.rlike(URL) | s.rlike(EMAIL)), ("numeric_no_digits", "medium", ~narrow(s).rlike("[0-9]")), ("numeric_too_long", "medium", F.length(s) >= 80)]


def enum_checks(allowed: Sequence[str]):
    return lambda s: common(s) + [("enum_unknown", "medium", ~s.isin(*allowed))]


def corporate_number_checks(s: Column) -> list[Check]:
    return common(s) + [("corp_no_not_13_digits", "high", F.length(digits(s)) != 13)]


def json_checks(s: Column) -> list[Check]:
    return common(s) + [("json_parse_failed", "high", F.try_parse_json(s).isNull())]


def _ranged(code: str, pattern: str, low: int, high: int):
    def checks(s: Column) -> list[Check]:
        n = F.regexp_extract(narrow(s), pattern, 1)
        return common(s) + [(f"{code}_unparseable", "medium", n == ""), (f"{code}_out_of_range", "high", (n != "") & ~n.try_cast("int").between(low, high))]

    return checks


month_checks, year_checks = _ranged("fiscal_month", "([0-9]{1,2})", 1, 12), _ranged("year", "((?:19|20)[0-9]{2})", 1800, 2100)


def audit(df: DataFrame, row_id: str, fields: Mapping[str, object], least: str = "low") -> DataFrame:
    """(row_id, field, value, severity, code): one row for each issue of each column.

    ``fields`` maps columns to functions from a trimmed value to checks. Blank
    values have no issues. The columns are unpivoted inside each row, so nothing
    is shuffled or read twice.
    """
    kept, s, issues = SEVERITIES[SEVERITIES.index(least) :], F.col("_trimmed"), []
    # Values are trimmed once, behind a generator, and each row then reads the checks of its own column.
    cells = [F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value"), stripped(F.col(name).cast("string")).alias("_trimmed")) for name in fields]
    each = df.select(row_id, F.inline(F.array(*cells))).where(s != "")
    for name, checks in fields.items():
        found = [F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))) for code, severity, cond in checks(s) if severity in kept]
        issues.append((name, F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<severity: string, code: string>>")))
    codes = F.lit(None).cast("array<struct<severity: string, code: string>>")
    for name, found in issues:
        codes = F.when(F.col("field") == name, found).otherwise(codes)
    return each.select(row_id, "field", "value", F.inline(codes))


_TITLES = "代表取締役|取締役社長|取締役|代表者|社長|会長|CEO|COO|CFO|CTO"
_JAPANESE = r"[ぁ-んァ-ン一-龥]"


def _codes(rules: Sequence[tuple[str, Column]], missing: str, s: Column) -> Column:
    found = F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in rules]))
    return F.when(F.coalesce(s, F.lit("")) == "", F.array(F.lit(missing))).otherwise(found)


def _has_phone(s: Column) -> Column:
    found = F.transform(F.regexp_extract_all(s, F.lit(r"[0-9][0-9()\-‐―－ー ]{7,16}[0-9]"), F.lit(0)), digits)
    return F.exists(found, lambda d: F.length(d).between(10, 12) & d.startswith("0"))


def person_issues(c: Column) -> Column:
    """Codes of what is wrong with a representative's name."""
    s = stripped(narrow(c))
    return _codes([
        ("rep_contains_url", s.rlike(URL)), ("rep_contains_email", s.rlike(EMAIL)), ("rep_contains_phone", _has_phone(s)), ("rep_looks_like_address", s.rlike(ZIP) | A.prefecture(s).isNotNull()),
        ("rep_contains_company_suffix", s.rlike("株式会社|有限会社|合同会社|[(]株[)]")), ("rep_label_only", s.rlike(f"^(?:{_TITLES}|代表者名)$")), ("rep_contains_contact_words", s.rlike("お問い合わせ|問合せ|問い合わせ")),
        ("rep_sentence_like", s.rlike("[。：:]") & (F.length(s) >= 24)), ("rep_contains_many_digits", F.length(digits(s)) >= 4), ("rep_too_long", F.length(s) >= 60), ("rep_non_japanese_long", ~s.rlike(_JAPANESE) & (F.length(s) >= 10)),
    ], "rep_missing", s)


def address_issues(c: Column) -> Column:
    """Codes of what is wrong with an address."""
    s = stripped(narrow(c))
    return _codes([
        ("address_contains_url", s.rlike(URL)), ("address_contains_email", s.rlike(EMAIL)), ("address_contains_phone", _has_phone(s)), ("address_contains_rep_title", s.rlike(_TITLES)),
        ("address_no_prefecture_or_zip", A.prefecture(s).isNull() & ~s.rlike(ZIP)), ("address_too_short", F.length(s) <= 6), ("address_too_long", F.length(s) >= 140),
        ("address_looks_like_name", ~s.rlike("[0-9]") & A.prefecture(s).isNull() & s.rlike(_JAPANESE) & (F.length(s) <= 12)),
    ], "address_missing", s)


def issue_score(codes: Column, weights: Mapping[str, int] = ISSUE_WEIGHTS) -> Column:
    """The weights of an array of codes added up, 1 for one unknown."""
    table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
    return F.aggregate(codes, F.lit(0), lambda a, x: a + F.coalesce(F.try_element_at(table, x), F.lit(1)))


def risk(score: Column) -> Column:
    return F.when(score >= 8, "high").when(score >= 4, "medium").when(score >= 1, "low").otherwise("ok")


def verdicts(facts: DataFrame, pages: DataFrame, fact_id: Sequence[str], found: Column, value: str = "value", evidence: str = "url", pos: str = "pos", page_text: str = "text") -> DataFrame:
    """Each fact's verdict: blank, unknown_no_evidence, verified (with the first page and a snippet), fetch_failed or not_found.

    ``facts`` has an array of evidence URLs, ``pages(url, text)`` those fetched;
    ``found`` is a condition on value and text. One equi-join of exploded URLs;
    facts whose value nothing can verify never reach it.
    """
    each = facts.select(*fact_id, F.col(value), F.posexplode("evidence").alias(pos, evidence)).where(stripped(F.col(value)) != "")
    met = each.join(pages.select(evidence, F.col(page_text).alias("_text")), evidence, "left")
    hit = F.coalesce(found, F.lit(False)) & F.col("_text").isNotNull()
    best = met.groupBy(*fact_id).agg(
        F.min_by(F.struct(F.col(evidence).alias("evidence_url"), snippet(F.col("_text"), F.col(value)).alias("evidence_snippet")), F.when(hit, F.col(pos))).alias("first"),
        F.count_if(hit).alias("hits"),
        F.count_if(F.col("_text").isNull()).alias("missing"),
    )
    out = facts.select(*fact_id, value, F.size("evidence").alias("n")).join(best, list(fact_id), "left")
    verdict = F.when(F.coalesce(stripped(F.col(value)), F.lit("")) == "", "blank").when(F.col("n") <= 0, "unknown_no_evidence").when(F.col("hits") > 0, "verified").when(F.col("missing") > 0, "fetch_failed").otherwise("not_found")
    return out.select(*fact_id, value, verdict.alias("verdict"), F.when(F.col("hits") > 0, F.col("first.evidence_url")).alias("evidence_url"), F.when(F.col("hits") > 0, F.col("first.evidence_snippet")).alias("evidence_snippet"))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))

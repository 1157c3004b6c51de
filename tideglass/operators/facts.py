"""Fact checks: whether stored values are told by the pages that they were taken from, a predicate for each kind of value."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.text import digits, narrow, squeezed

#: Words that must stand near a name, a year of foundation and a month of accounts; words that a description never holds.
PERSON_NEAR = "代表|取締役|社長|会長|CEO"
FOUNDED_NEAR = "設立|創業|創立"
FISCAL_NEAR = "決算|期|事業年度|会計年度|年度"
DESCRIPTION_NEVER = "https?://|@|TEL|電話|FAX|お問い合わせ|採用|アクセス"


def normal(c: Column) -> Column:
    return squeezed(narrow(F.coalesce(c, F.lit(""))))


def address_key(c: Column) -> Column:
    """An address without blanks, hyphens, postal mark, brackets and punctuation."""
    return F.regexp_replace(normal(c), r"[〒\-−\s()（）\[\]【】「」『』,。．・:：/]", "")


def around(text: Column, needle: Column, window: int) -> Column:
    """The first place of ``needle`` with so many characters on either side; empty if it isn't there."""
    at = F.instr(text, needle)
    start = F.greatest(at - window, F.lit(1))
    return F.when(at > 0, F.trim(F.substring(text, start, at - start + F.length(needle) + window))).otherwise("")


@dataclass(frozen=True)
class Predicate:
    """``early`` (value) gives STRUCT(verdict, reason) where no page could tell, ``told`` (value, text) a reason where a page does, ``seen`` what it says there."""

    early: Callable[[Column], Column]
    told: Callable[[Column, Column], Column]
    seen: Callable[[Column, Column], Column]


def _early(*rules: tuple[Column, str, str]) -> Column:
    out = F.lit(None).cast("struct<verdict: string, reason: string>")
    for cond, verdict, reason in reversed(rules):
        out = F.when(cond, F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))).otherwise(out)
    return out


def phone() -> Predicate:
    held = lambda v, t: F.contains(digits(t), digits(v))
    return Predicate(lambda v: _early((F.length(digits(v)) < 9, "not_found", "phone_value_too_short")), lambda v, t: F.when(held(v, t), "digits_found"), lambda v, t: around(digits(t), digits(v), 40))


def address() -> Predicate:
    held = lambda v, t: F.contains(address_key(t), address_key(v))
    return Predicate(lambda v: _early((address_key(v) == "", "not_found", "addr_key_empty")), lambda v, t: F.when(held(v, t), "addr_key_found"), lambda v, t: around(address_key(t), F.substring(address_key(v), 1, 24), 40))


def person(near: str = PERSON_NEAR) -> Predicate:
    """One part of the name near a word for its office, or all parts anywhere."""
    parts = lambda v: F.split(normal(v), " ")

    def told(v: Column, t: Column) -> Column:
        by_office = F.exists(parts(v), lambda p: around(t, p, 60).rlike(near))
        return F.when(by_office, "token_found_near_rep_keyword").when(F.forall(parts(v), lambda p: F.contains(t, p)), "all_tokens_found")

    def seen(v: Column, t: Column) -> Column:
        places = F.transform(parts(v), lambda p: around(t, p, 60))
        return F.coalesce(F.get(F.filter(places, lambda x: x.rlike(near)), F.lit(0)), F.get(places, F.lit(0)))

    return Predicate(lambda v: _early(), told, seen)


def contained(label: str = "text") -> Predicate:
    """The value itself; of one of 40 characters or more the first 60."""
    needle = lambda v: F.when(F.length(normal(v)) >= 40, F.substring(normal(v), 1, 60)).otherwise(normal(v))
    return Predicate(lambda v: _early(), lambda v, t: F.when(F.contains(t, needle(v)), f"{label}_substring_found"), lambda v, t: around(t, needle(v), 40))


def amount(label: str = "amount") -> Predicate:
    held = lambda v, t: F.contains(digits(t), digits(v))
    return Predicate(lambda v: _early((F.length(digits(v)) < 4, "unknown_no_evidence", f"{label}_digits_too_short")), lambda v, t: F.when(held(v, t), f"{label}_digits_found"), lambda v, t: around(digits(t), digits(v), 40))


def _near(needle: Callable[[Column], Column], near: str, reason: str, early: Callable[[Column], Column]) -> Predicate:
    place = lambda v, t: around(t, needle(v), 80)
    return Predicate(early, lambda v, t: F.when(place(v, t).rlike(near), reason), place)


def founded(near: str = FOUNDED_NEAR) -> Predicate:
    year = lambda v: F.regexp_extract(normal(v), "(19[0-9]{2}|20[0-9]{2})", 1)
    return _near(year, near, "year_found_near_founded_keyword", lambda v: _early((year(v) == "", "unknown_no_evidence", "founded_year_not_parseable")))


def fiscal_month(near: str = FISCAL_NEAR) -> Predicate:
    month = lambda v: F.regexp_extract(normal(v), "([0-9]{1,2})", 1)
    number = lambda v: F.nullif(month(v), F.lit("")).cast("int")
    early = lambda v: _early((month(v) == "", "unknown_no_evidence", "fiscal_month_not_parseable"), (~number(v).between(1, 12), "unknown_no_evidence", "fiscal_month_out_of_range"))
    return _near(lambda v: F.concat(number(v).cast("string"), F.lit("月")), near, "month_found_near_fiscal_keyword", early)


def checked(facts: DataFrame, pages: DataFrame, fact_id: Sequence[str], predicate: Predicate, value: str = "value") -> DataFrame:
    """(fact_id..., value, verdict, reason, evidence_url, evidence_snippet) of every row of ``facts``.

    ``facts`` has the value and ``evidence``, an array of page URLs in order;
    ``pages(url, text)`` those fetched. Blank values are ``blank``; what
    ``early`` knows comes next; without evidence the verdict is
    ``unknown_no_evidence``; the first page that tells the value verifies it;
    else a page that is missing gives ``fetch_failed``, and the rest is
    ``not_found``. Only facts that a page may verify are exploded and joined,
    by one equi-join on the URL.
    """
    v = F.col("_value")
    base = facts.withColumn("_value", normal(F.col(value).cast("string")))
    base = base.withColumn("_early", F.when(v == "", F.struct(F.lit("blank").alias("verdict"), F.lit("empty").alias("reason"))).otherwise(predicate.early(v)))
    base = base.withColumn("_early", F.when(F.col("_early").isNotNull(), F.col("_early")).when(F.coalesce(F.size("evidence"), F.lit(0)) <= 0, F.struct(F.lit("unknown_no_evidence").alias("verdict"), F.lit("no_evidence_urls").alias("reason"))))
    each = base.where(F.col("_early").isNull()).select(*fact_id, "_value", F.posexplode(F.array_distinct("evidence")).alias("_pos", "url"))
    met = each.join(pages.select("url", F.col("text").alias("_page")), "url", "left").withColumn("_text", normal(F.col("_page")))
    hit = met.withColumn("_told", F.when(F.col("_page").isNotNull() & (F.col("_text") != ""), predicate.told(v, F.col("_text"))))
    found = F.struct(F.col("_told").alias("reason"), F.col("url"), predicate.seen(v, F.col("_text")).alias("snippet"))
    best = hit.groupBy(*fact_id).agg(F.min_by(F.when(F.col("_told").isNotNull(), found), F.when(F.col("_told").isNotNull(), F.col("_pos"))).alias("_best"), F.count_if(F.col("_page").isNull()).alias("_missing"))
    out = base.select(*fact_id, F.col(value), "_early").join(best, list(fact_id), "left")
    rest = F.when(F.col("_best").isNotNull(), "verified").when(F.col("_missing") > 0, "fetch_failed").otherwise("not_found")
    why = F.when(F.col("_best").isNotNull(), F.col("_best.reason")).when(F.col("_missing") > 0, "all_failed_or_no_match_on_ok_pages").otherwise("not_found_in_evidence")
    return out.select(*fact_id, value, F.coalesce("_early.verdict", rest).alias("verdict"), F.coalesce("_early.reason", why).alias("reason"), F.col("_best.url").alias("evidence_url"), F.col("_best.snippet").alias("evidence_snippet"))


def description(facts: DataFrame, pages: DataFrame, fact_id: Sequence[str], value: str = "value", most: int = 4) -> DataFrame:
    """As ``checked``, for descriptions: their form first, then whether one of the snippets that they were written from is on its page.

    ``facts.evidence`` is an array of STRUCT(url, snippet), of which the first ``most`` count.
    """
    v = normal(F.col(value))
    real = F.filter(F.slice(F.coalesce("evidence", F.array().cast("array<struct<url: string, snippet: string>>")), 1, most), lambda e: (normal(e["url"]) != "") & (normal(e["snippet"]) != ""))
    early = _early(
        (v == "", "blank", "empty"), (v.rlike(DESCRIPTION_NEVER), "not_found", "description_contains_forbidden_terms"), (F.length(v) < 20, "unknown_no_evidence", "description_too_short"),
        (F.coalesce(F.size("evidence"), F.lit(0)) <= 0, "unknown_no_evidence", "no_description_evidence"), (F.size(real) == 0, "unknown_no_evidence", "description_evidence_missing_or_empty"),
    )
    base = facts.select(*fact_id, F.col(value), early.alias("_early"), real.alias("_real"))
    each = base.where(F.col("_early").isNull()).select(*fact_id, F.posexplode("_real").alias("_pos", "_e")).select(*fact_id, "_pos", F.col("_e.url").alias("url"), normal(F.col("_e.snippet")).alias("_snippet"))
    met = each.join(pages.select("url", normal(F.col("text")).alias("_text")), "url", "left").where(F.contains(F.col("_text"), F.col("_snippet")))
    best = met.groupBy(*fact_id).agg(F.min_by(F.struct("url", around(F.col("_text"), F.substring("_snippet", 1, 40), 40).alias("snippet")), "_pos").alias("_best"))
    out = base.join(best, list(fact_id), "left")
    verdict = F.coalesce("_early.verdict", F.when(F.col("_best").isNotNull(), "verified").otherwise("not_found"))
    reason = F.coalesce("_early.reason", F.when(F.col("_best").isNotNull(), "description_evidence_snippet_found").otherwise("description_evidence_snippet_not_found"))
    return out.select(*fact_id, value, verdict.alias("verdict"), reason.alias("reason"), F.col("_best.url").alias("evidence_url"), F.col("_best.snippet").alias("evidence_snippet"))

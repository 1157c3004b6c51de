"""Japanese phone numbers as one expression with named profiles, and the choice among tagged candidates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits, narrow


@dataclass(frozen=True)
class Profile:
    """``country``: least digits of a number that starts with 81. ``strict`` turns dummy numbers away, ``keep`` returns what can't be read."""

    country: int = 10
    strict: bool = False
    keep: bool = False


PROFILES = {"main": Profile(), "storage": Profile(country=11), "strict": Profile(strict=True), "reference": Profile(keep=True)}

#: What a candidate's tags add to its score.
TAG_SCORES = {
    "TELHREF": 6.0, "TABLE": 5.0, "JSONLD": 5.0, "LABEL": 4.0, "TEL": 3.5, "FOOTER": 1.5, "HEADER": 1.0, "ATTR": 0.5, "TEXT": 0.0,
    "HQ": 4.0, "REP": 3.5, "SOUMU": 3.0, "KEIRI": 3.0, "ADMIN": 2.0, "BRANCH": -2.5, "RECRUIT": -6.0, "SUPPORT": -2.0,
}
PAGE_SCORES = {"COMPANY_PROFILE": 2.0, "ACCESS_CONTACT": 1.0, "BASES_LIST": -1.0, "DIRECTORY_DB": -2.0, "OTHER": 0.0}
STRUCTURED = ("TELHREF", "TABLE", "JSONLD", "LABEL")
CONTEXT = ("HQ", "REP", "SOUMU", "KEIRI", "ADMIN")
MARGIN = ("FOOTER", "HEADER", "ATTR")

_PARTED = r"(0[0-9]{1,4})[^0-9]+?([0-9]{1,4})[^0-9]+?([0-9]{3,4})"


def phone(c: Column, profile: Profile = PROFILES["main"]) -> Column:
    """A number as area-exchange-line, or null.

    A number already parted keeps its parts. Bare digits, +81 read as 0, must
    begin with 0 and number 10 or 11: 03 and 06 part 2-4-4, 0120 and 0570 part
    4-3-3, other tens 3-3-4, elevens 3-4-4.
    """
    s = F.regexp_replace(narrow(c), r"(?i)(内線|ext|extension)\s*[:：]?\s*[0-9]+$", "")
    s = F.regexp_replace(s, "[‐―－ー–—]+", "-")
    part = lambda n: F.regexp_extract(s, _PARTED, n)
    d = digits(s)
    d = F.when(d.startswith("81") & (F.length(d) >= profile.country), F.concat(F.lit("0"), F.substring(d, 3, 100))).otherwise(d)
    cut = lambda a, b: F.concat_ws("-", F.substring(d, 1, a), F.substring(d, a + 1, b), F.substring(d, a + b + 1, 20))
    ten = F.when(d.rlike("^0[36]"), cut(2, 4)).when(d.rlike("^0120|^0570"), cut(4, 3)).otherwise(cut(3, 3))
    bare = F.when(~d.startswith("0"), None).when(F.length(d) == 10, ten).when(F.length(d) == 11, cut(3, 4))
    out = F.when(part(1) != "", F.concat_ws("-", part(1), part(2), part(3))).otherwise(bare)
    if profile.strict:
        out = F.when(~F.regexp_replace(out, "-", "").rlike(r"^0(\d)\1{8,}$|^0?1234567|^0{3}"), out)
    return F.coalesce(out, c) if profile.keep else out


def tags(c: Column) -> Column:
    """The names in leading square brackets."""
    return F.regexp_extract_all(F.regexp_extract(c, r"^((?:\[[A-Z_]+\])*)", 1), F.lit(r"\[([A-Z_]+)\]"), F.lit(1))


def untagged(c: Column) -> Column:
    return F.regexp_replace(c, r"^(?:\[[A-Z_]+\])+", "")


def _any(t: Column, names) -> Column:
    return F.arrays_overlap(t, F.array(*[F.lit(x) for x in names]))


def scored(candidate: Column, page_type: Column | None = None) -> Column:
    """STRUCT(phone, score) of a tagged candidate; null if it is a fax, can't be read or, for a page type, is too weak for it."""
    t, number = F.array_distinct(tags(candidate)), phone(untagged(candidate))
    weights = F.create_map(*[x for k, v in TAG_SCORES.items() for x in (F.lit(k), F.lit(v))])
    score = F.aggregate(t, F.lit(0.0), lambda a, x: a + F.coalesce(F.try_element_at(weights, x), F.lit(0.0)))
    score = score - F.when(number.rlike("^(0120|0570)"), 4.0).otherwise(0.0) - F.abs(F.length(number) - 12) * 0.2
    ok = number.isNotNull() & ~(_any(t, ["FAX"]) & ~_any(t, ["TEL", "TELHREF"]))
    if page_type is not None:
        kind = F.upper(F.coalesce(page_type, F.lit("OTHER")))
        bonus = F.create_map(*[x for k, v in PAGE_SCORES.items() for x in (F.lit(k), F.lit(v))])
        score = score + F.coalesce(F.try_element_at(bonus, kind), F.lit(0.0))
        ok = ok & (kind.isin("COMPANY_PROFILE", "ACCESS_CONTACT") | _any(t, STRUCTURED) | _any(t, CONTEXT))
    return F.when(ok, F.struct(number.alias("phone"), score.alias("score")))


def best(candidates: Column) -> Column:
    """The best number of an array of tagged candidates.

    If any is structured, those from the page's margins without a context drop
    out (unless none is left). Of equal scores numbers that aren't toll-free
    come first, then those nearer to 12 characters, then the earlier.
    """
    strong = F.exists(candidates, lambda c: _any(tags(c), STRUCTURED))
    inner = F.filter(candidates, lambda c: ~(_any(tags(c), MARGIN) & ~_any(tags(c), CONTEXT)))
    some = F.when(strong & (F.size(inner) > 0), inner).otherwise(candidates)
    rows = F.transform(some, lambda c, i: F.struct(scored(c).alias("x"), i.alias("i")))
    rows = F.filter(rows, lambda r: r["x"].isNotNull())
    keyed = F.transform(rows, lambda r: F.struct((-r["x"]["score"]).alias("s"), r["x"]["phone"].rlike("^(0120|0570)").alias("free"), F.abs(F.length(r["x"]["phone"]) - 12).alias("far"), r["i"].alias("i"), r["x"]["phone"].alias("phone")))
    return F.array_min(keyed)["phone"]

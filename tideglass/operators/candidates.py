"""The choice among tagged candidates of one field: deterministic arg-max over arrays, the earlier of equals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideglass.functions import numbers
from tideglass.functions.names import best_person
from tideglass.functions.phone import tags, untagged

from .sites import listing

__all__ = ["accepted", "argmax", "best_amount", "best_employees", "best_listing", "best_person", "reference_page"]


def argmax(candidates: Column, clean: Callable[[Column], Column], score: Callable[[Column, Column], Column]) -> Column:
    """The cleaned value of the highest score; ``score`` sees the cleaned value and the raw candidate. Blank values don't count."""
    rows = F.transform(candidates, lambda c, i: F.struct(clean(untagged(c)).alias("v"), c.alias("raw"), i.alias("i")))
    rows = F.filter(rows, lambda r: F.coalesce(r["v"], F.lit("")) != "")
    return F.array_min(F.transform(rows, lambda r: F.struct((-score(r["v"], r["raw"])).alias("s"), r["i"].alias("i"), r["v"].alias("v"))))["v"]


def _table(raw: Column, bonus: float) -> Column:
    return F.when(F.array_contains(tags(raw), "TABLE"), bonus).otherwise(0.0)


def best_amount(candidates: Column) -> Column:
    """Length up to 20, 兆 6, 億 4, 万 2 of the text as given, a table 3; the value as yen."""
    unit = lambda raw: sum((F.when(raw.contains(u), v).otherwise(0) for u, v in (("兆", 6), ("億", 4), ("万", 2))), F.lit(0))
    return argmax(candidates, numbers.amount_text, lambda v, raw: F.least(F.length(v), F.lit(20)) + unit(raw) + _table(raw, 3.0))


def best_employees(candidates: Column) -> Column:
    """A table 3, an approximate number -0.2, a range -0.3, a tenth for each of up to ten characters."""
    return argmax(candidates, numbers.employees, lambda v, raw: _table(raw, 3.0) - F.when(v.contains("約"), 0.2).otherwise(0.0) - F.when(v.contains("-"), 0.3).otherwise(0.0) + F.least(F.length(v), F.lit(10)) * 0.1)


def best_listing(candidates: Column) -> Column:
    """The shortest listing, one of a table as if two characters shorter."""
    return argmax(candidates, listing, lambda v, raw: _table(raw, 2.0) - F.length(v))


def accepted(chosen: Column, candidates: Column, page_type: Column, same: Callable[[Column, Column], Column]) -> Column:
    """STRUCT(ok, reason): a chosen value stands on a profile or contact page, or where a structured candidate equals it."""
    strong = F.exists(candidates, lambda c: F.arrays_overlap(tags(c), F.array(F.lit("TABLE"), F.lit("LABEL"), F.lit("JSONLD"), F.lit("TELHREF"))) & same(untagged(c), chosen))
    page = F.upper(F.coalesce(page_type, F.lit("OTHER")))
    reason = F.when(F.coalesce(chosen, F.lit("")) == "", "empty").when(page == "DIRECTORY_DB", "directory").when(page.isin("COMPANY_PROFILE", "ACCESS_CONTACT"), "page_type").when(strong, "structured").otherwise("weak_source")
    return F.struct(reason.isin("page_type", "structured").alias("ok"), reason.alias("reason"))


def reference_page(pages: Column) -> Column:
    """The URL to compare with, of an array of STRUCT(url, page_type): profile pages first, then overview paths, then the shortest, then by text."""
    order = F.transform(pages, lambda p: F.struct((p["page_type"] != "COMPANY_PROFILE").alias("a"), (~F.lower(p["url"]).rlike("/(overview|outline|company|profile|about)")).alias("b"), F.length(p["url"]).alias("l"), p["url"].alias("url")))
    return F.array_min(order)["url"]

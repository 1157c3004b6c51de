"""How rows come in and how a worker's results go back: composed addresses, positional rows, bounded inserts, updates under a lock. All native."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.text import blank, stripped

from .match import first_by

#: The columns that a check of a page for changes may write.
CHECK_COLUMNS = ("homepage_fingerprint", "homepage_content_length", "homepage_checked_at", "homepage_check_url", "homepage_check_source", "homepage_check_logic_hash", "skip_reason")
#: The columns of a phase's metrics.
PHASE_COLUMNS = ("id", "phase", "elapsed_sec", "status", "homepage", "worker", "error_code")


def _text(c: Column) -> Column:
    return F.coalesce(stripped(c.cast("string")), F.lit(""))


def postal(zipcode: Column, body: Column, between: Column | str = "") -> Column:
    """〒code and a blank before a body; the body alone without a code; blank for neither."""
    code = F.replace(_text(zipcode), F.lit("〒"), F.lit(""))
    return F.when((code != "") & (body != ""), F.concat(F.lit("〒"), code, F.lit(" "), F.lit(between) if isinstance(between, str) else between, body)).otherwise(F.concat(F.lit(between) if isinstance(between, str) else between, body))


def address_or_parts(address: Column, zipcode: Column, prefecture: Column, city: Column) -> Column:
    """The address given, else prefecture and city, behind its postal code."""
    return postal(zipcode, F.when(_text(address) != "", _text(address)).otherwise(F.concat(_text(prefecture), _text(city))))


def address_of_parts(zipcode: Column, prefecture: Column, *parts: Column) -> Column:
    """Prefecture and parts; behind the postal code where there is any part."""
    return postal(zipcode, F.concat(*[_text(p) for p in parts]), _text(prefecture))


def after_header(rows: DataFrame, cells: str, place: str, sentinel: str, source: str | None = None) -> DataFrame:
    """Of each source (a file; all rows as one without it) the rows behind the first whose first cell is the sentinel, empty ones aside. A source without it gives none."""
    by = [source] if source else []
    marks = rows.where(_text(F.get(cells, F.lit(0))) == sentinel).groupBy(*by).agg(F.min(place).alias("_from"))
    kept = rows.where(F.exists(cells, lambda c: ~blank(c)))
    # One row a file, or one row in all.
    met = kept.join(marks, by) if by else kept.crossJoin(F.broadcast(marks))
    return met.where(F.col(place) > F.col("_from")).drop("_from")


def positional_record(cells: Column) -> Column:
    """STRUCT(name, address) of a positional row: the first cell, and the third to the fifth together."""
    at = lambda i: _text(F.get(cells, F.lit(i)))
    return F.struct(at(0).alias("name"), F.concat(at(2), at(3), at(4)).alias("address"))


def inserted(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], most: int | None = None) -> DataFrame:
    """The rows whose keys are new, the first of each; the bound counts rows inserted, not rows read."""
    new = first_by(rows.join(target.select(*keys).distinct(), list(keys), "left_anti"), keys, order)
    return new if most is None else new.orderBy(*order).limit(most)


def written_back(df: DataFrame, results: DataFrame, row_id: str, fields: Sequence[str], worker: str | None = None, refused: str | None = None) -> DataFrame:
    """The table with each result's status and ``fields`` in its row, and the row's lock released.

    A row that another worker holds keeps everything; with ``refused`` it gets
    that status, the result's fields, and is released. Null results are written
    as they are; columns that the table lacks are left out; of repeated results
    the least counts.
    """
    known = [f for f in ("status", *fields) if f in df.columns and f in results.columns]
    one = results.groupBy(row_id).agg(F.min(F.struct(*known)).alias("_new"))
    mine = F.lit(True) if worker is None else F.col("locked_by").isNull() | (F.col("locked_by") == worker)
    met = df.join(one, row_id, "left").withColumn("_met", F.col("_new").isNotNull()).withColumn("_own", F.col("_met") & mine)
    write = F.col("_met") if refused else F.col("_own")
    changes = {f: F.when(write, F.col("_new")[f]).otherwise(F.col(f)) for f in known if f != "status"}
    if "status" in known:
        changes["status"] = F.when(F.col("_own"), F.col("_new")["status"]).when(write, refused).otherwise(F.col("status"))
    changes |= {f: F.when(~write, F.col(f)) for f in ("locked_by", "locked_at") if f in df.columns}
    return met.withColumns(changes).select(*df.columns)


def without_model_refusals(flags: DataFrame) -> DataFrame:
    """The flags without those that a model set against a site."""
    return flags.where(~F.coalesce((F.col("is_official").cast("int") == 0) & F.lower("judge_source").startswith("ai"), F.lit(False)))


def phase_metrics(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rows of the metrics table; what is not given is null."""
    return rows.select(*[columns.get(c, F.lit(None).cast("string")).alias(c) for c in PHASE_COLUMNS])


def result_fields(fields: Sequence[str], fallback: Mapping[str, Column]) -> list[Column]:
    """A result's fields; an empty one that has a fallback takes that."""
    return [(F.when(F.coalesce(F.col(f), F.lit("")) == "", fallback[f]).otherwise(F.col(f)) if f in fallback else F.col(f)).alias(f) for f in fields]


def primary_page(pages: Column, current: Column, profile_like) -> Column:
    """The page to take a company's facts from, of ARRAY<STRUCT(url, page_type, score)>.

    By: a profile, no contact page, a path like a profile's (``profile_like``),
    the higher score, the shorter and then the lesser URL. A contact page never
    replaces a page that is there.
    """
    flag = lambda c: F.when(c, 0).otherwise(1)
    ranks = F.transform(
        F.filter(pages, lambda p: F.coalesce(p["url"], F.lit("")) != ""),
        lambda p: F.struct(flag(p["page_type"] == "COMPANY_PROFILE").alias("a"), flag(F.coalesce(p["page_type"] != "ACCESS_CONTACT", F.lit(True))).alias("b"), flag(profile_like(p["url"])).alias("c"), (-F.coalesce(p["score"], F.lit(0))).alias("d"), F.length(p["url"]).alias("e"), p["url"].alias("url")),
    )
    best = F.array_min(ranks)
    return F.when(best.isNull() | ((best["b"] == 1) & ~blank(current)), current).otherwise(best["url"])


def source_of(candidates: Column, chosen: Column, clean) -> Column:
    """Of ARRAY<STRUCT(value, url, page_type)> the first with a URL whose cleaned value is the one chosen; null if there is none."""
    found = F.filter(candidates, lambda c: ~blank(c["url"]) & F.coalesce(clean(c["value"]) == chosen, F.lit(False)))
    return F.when(~blank(chosen), F.get(found, F.lit(0)))


def stage_source(stage: Column) -> Column:
    return F.when(F.lower(_text(stage)).isin("relaxed", "mixed"), "ai_relaxed").otherwise("ai")


def candidate_lines(candidates: Column) -> Column:
    """ARRAY<STRUCT(top, sub)> as lines "top / sub", or what there is of the two."""
    lines = F.transform(candidates, lambda c: F.array_join(F.filter(F.array(_text(c["top"]), _text(c["sub"])), lambda x: x != ""), " / "))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def concept_card(concepts: DataFrame, most: int = 8) -> DataFrame:
    """(id, label, hints, aliases), the first ``most`` aliases."""
    return concepts.select("id", "label", F.col("industry_hints").alias("hints"), F.slice("aliases", 1, most).alias("aliases"))

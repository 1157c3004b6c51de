"""Rules over stored records: which enter, which are worked on again, what they are known by, and where their evidence is. All native."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.text import blank, first_filled, stripped

from .match import first_by

#: What gives an advert away.
ADVERTS = ("https://listoss.com/", "listoss.com", "ftj-g.co.jp/form", "本法人データはリストスが提供しています", "御社のテレアポ代行します", "1件10円!お問い合わせフォーム送信代行。")
#: Why a contact page's verdict is worth another try.
RETRY_JUDGED = "404|見つかりません|エラー|redirect"
RETRY_FETCHED = "404|error|redirect"
#: The columns that hold pages of evidence, in their order.
EVIDENCE_COLUMNS = ("source_url_phone", "source_url_address", "source_url_rep", "homepage", "official_homepage", "final_homepage")


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_advert(df: DataFrame) -> Column:
    """Whether any text column of a row holds one of the adverts' words."""
    texts = F.lower(F.concat_ws("\n", *[f"`{n}`" for n, t in df.dtypes if t == "string"]))
    return _any([F.contains(texts, F.lit(w.lower())) for w in ADVERTS])


def without_adverts(df: DataFrame) -> DataFrame:
    return df.where(~is_advert(df))


def record_key(corporate_norm: Column, corporate: Column, foreign_id: Column, name: Column, address: Column) -> Column:
    """The corporate number, else the foreign system's id, else name and address; null if there is nothing."""
    pair = F.concat(F.coalesce(name, F.lit("")), F.lit("|"), F.coalesce(address, F.lit("")))
    return F.coalesce(first_filled(corporate_norm, corporate, foreign_id), F.when(~blank(name) | ~blank(address), pair))


def missing_any(fields: Sequence[str]) -> Column:
    """Whether one of the columns is null or empty."""
    return _any([F.coalesce(F.col(f).cast("string"), F.lit("")) == "" for f in fields])


def requeued(df: DataFrame, picked: Column, status: str = "status", to: str = "pending") -> DataFrame:
    """The rows with those picked set to another status; null conditions pick nothing."""
    return df.withColumn(status, F.when(F.coalesce(picked, F.lit(False)), to).otherwise(F.col(status)))


def corrupted(value: Column) -> Column:
    """An address of which an encoding was lost."""
    return F.coalesce(value.contains("ã") | value.contains("�"), F.lit(False))


def contact_again(mode: str = "new", statuses: Sequence[str] = ()) -> Column:
    """Which records' contact pages are looked for: ``new`` (no status yet), ``retry`` (worth another try), ``status`` (one of ``statuses``), ``all``."""
    status, unknown = F.col("contact_url_status"), blank(F.col("contact_url"))
    why = F.coalesce(F.col("contact_url_ai_reason").rlike(RETRY_JUDGED), F.lit(False)) | F.coalesce(F.col("contact_url_reason").rlike(RETRY_FETCHED), F.lit(False))
    modes = {
        "new": blank(status),
        "retry": unknown & (status.isin("timeout", "ai_unsure") | ((status == "ai_not_official") & why)),
        "status": unknown & status.isin(*statuses),
        "all": F.lit(True),
    }
    return F.coalesce(~blank(F.col("final_homepage")) & modes[mode], F.lit(False))


def exported(df: DataFrame, statuses: Sequence[str], homepage: str = "homepage") -> DataFrame:
    return df.where(F.col("status").isin(*statuses) & ~blank(F.col(homepage)))


def unclassified(source: Column, code: Column, name: Column) -> Column:
    s = F.lower(F.coalesce(stripped(source), F.lit("")))
    return (s == "") | s.contains("unclassified") | blank(code) | blank(name) | F.coalesce(stripped(name) == "不明", F.lit(False))


def hinted(texts: Sequence[Column], hints: Sequence[str], compacted) -> Column:
    """Whether the texts together, made compact, hold one of the hints made compact alike (by the caller)."""
    whole = compacted(F.concat_ws("\n", *texts))
    return _any([F.contains(whole, F.lit(h)) for h in hints])


def evidence_urls(deep: Column, described: Column, columns: Sequence[str] = EVIDENCE_COLUMNS, most: int = 6) -> Column:
    """The distinct http(s) pages of a record in order: its columns, the first ``most`` deep pages, those of the first ``most`` description snippets (STRUCT(url, snippet))."""
    parts = [F.array(*[F.col(c) for c in columns]), F.coalesce(F.slice(deep, 1, most), F.array().cast("array<string>")), F.coalesce(F.transform(F.slice(described, 1, most), lambda d: d["url"]), F.array().cast("array<string>"))]
    urls = F.transform(F.concat(*parts), lambda u: stripped(F.coalesce(u, F.lit(""))))
    return F.array_distinct(F.filter(urls, lambda u: u.rlike("^https?://")))


def description_evidence(rows: DataFrame, pages: DataFrame, row_id: str, allowed: str = "allowed", evidence: str = "evidence", most: int = 4) -> DataFrame:
    """(row_id, kept): the first ``most`` snippets (STRUCT(url, snippet)) of an allowed page whose text holds them, blanks and quotes aside. One equi-join on the URL."""
    plain = lambda c: F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", ""), "\"'「」『』“”‘’　", "")
    each = rows.select(row_id, allowed, F.posexplode(evidence).alias("_pos", "_e")).where(F.array_contains(allowed, F.col("_e.url")) & (plain(F.col("_e.snippet")) != ""))
    met = each.withColumn("url", F.col("_e.url")).join(pages.select("url", plain(F.col("text")).alias("_text")), "url").where(F.contains(F.col("_text"), plain(F.col("_e.snippet"))))
    best = met.groupBy(row_id).agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("_pos", "_e"))), 1, most), lambda x: x["_e"]).alias("kept"))
    return rows.select(row_id).join(best, row_id, "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<struct<url: string, snippet: string>>")))


def place_matches(own: Column, found: Column) -> Column:
    """1 or 0, null where either side is missing."""
    return F.when(~blank(own) & ~blank(found), (own == found).cast("int"))


def still_missing(fields: Sequence[str]) -> Column:
    return sum((blank(F.col(f).cast("string")).cast("int") for f in fields), F.lit(0))


def update_page(final: Column, official: Column) -> Column:
    """The page whose change is watched, and which column it is from."""
    return F.when(~blank(final), F.struct(stripped(final).alias("url"), F.lit("final").alias("source"))).when(~blank(official), F.struct(stripped(official).alias("url"), F.lit("official").alias("source")))


def over_deep_limit(total: Column, homepage: Column, found_at: Column, limit: float) -> Column:
    """Whether the time after the official site was found has run out; without a site, or a limit, it never does."""
    return F.coalesce(F.lit(limit > 0) & ~blank(homepage) & (total - found_at > limit), F.lit(False))


def promoted(signals: Mapping[str, Column]) -> Column:
    """A site whose host lacks the company's name, but whose content is strong, as official: no veto, and one reason. Every such site is reviewed."""
    at = lambda n: F.coalesce(signals.get(n, F.lit(False)), F.lit(False))
    vetoes = _any([at(n) for n in ("free_host", "directory_like", "judge_conflict", "judged_not_official", "disallowed_host")])
    reasons = _any([F.coalesce(signals.get("evidence", F.lit(0)) >= 10, F.lit(False)), at("address_ok") & ~at("prefecture_only"), at("weak_address"), at("name_in_jsonld"), at("name_in_title"), at("name_in_h1")])
    return at("brand_allowed") & at("content_strong") & ~vetoes & reasons


def provisional_score(domain: Column, address_ok: Column, rule: Column, evidence: Column, strong_host: Column, judged: Column) -> Column:
    return domain * 2 + F.when(address_ok, 3).otherwise(0) + rule + F.least(F.lit(6.0), evidence / 2.0) + F.when(strong_host, 4).otherwise(0) + F.when(judged, 6).otherwise(0)


def provisional(sites: DataFrame, key: str, order: str = "place") -> DataFrame:
    """Of each key's sites the one to take for now: not like a directory, with a sign of the company, of the highest score, the earlier of equals."""
    c = F.col
    sign = c("host_token") | c("strong_host") | c("name_present") | (c("domain") >= 4) | (c("address_ok") & (c("domain") >= 3)) | (c("evidence") >= 10) | c("judged")
    score = provisional_score(c("domain"), c("address_ok"), c("rule"), c("evidence"), c("strong_host"), c("judged"))
    return first_by(sites.where(~c("directory_like") & sign).withColumn("score", score), [key], [c("score").desc(), order])


def concept_retry(selected: Column, offered: Column, reason: Column, evidence: Column) -> Column:
    """Whether a verdict outside the offered concepts lacks a reason or evidence."""
    return F.coalesce((F.size(offered) > 0) & ~F.coalesce(F.array_contains(offered, stripped(selected)), F.lit(False)) & (blank(reason) | blank(evidence)), F.lit(False))


def concept_payload(tags: Column, k: int = 5) -> Column:
    """STRUCT(topk, auto, hold) of tags ARRAY<STRUCT(tag, decision, topk)>: ids in the order first seen, capped; the first ids of sure tags; the others' names."""
    every = F.slice(F.array_distinct(F.flatten(F.transform(tags, lambda t: t["topk"]))), 1, k)
    auto = F.array_distinct(F.transform(F.filter(tags, lambda t: t["decision"] == "auto"), lambda t: F.get(t["topk"], F.lit(0))))
    return F.struct(every.alias("topk"), auto.alias("auto"), F.transform(F.filter(tags, lambda t: t["decision"] != "auto"), lambda t: t["tag"]).alias("hold"))

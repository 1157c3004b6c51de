"""Sites and pages of a record: search ranking, contact pages, official evidence and decision, fields by page order, model results."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tideglass.functions import names, pages, urls
from tideglass.functions.text import blank, squeezed

from .match import first_by

#: Words and paths of contact pages, and of pages that are none.
CONTACT_WORDS = ("お問い合わせ", "お問合せ", "問い合わせ", "問合せ", "contact", "inquiry", "ご相談", "ご質問")
CONTACT_PATHS = ("/contact", "/contactus", "/contact-us", "/inquiry", "/enquiry", "/toiawase", "/otoiawase", "/contact_form")
REJECTED_PATHS = ("/recruit", "/career", "/careers", "/job", "/jobs", "/news", "/blog", "/press", "/privacy", "/policy", "/terms")
FORM_HOSTS = ("forms.gle", "form.run", "form-mailer.jp", "formzu.net", "docs.google.com", "tayori.com", "hubspot.com", "salesforce.com")
PLATFORMS = ("facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "wikipedia.org", "linkedin.com", "indeed.com", "google.com", "amazon.co.jp")
PAGE_ORDER = ("COMPANY_PROFILE", "ACCESS_CONTACT", "BASES_LIST", "OTHER", "DIRECTORY_DB")


def search_score(domain: Column, rank: Column, query_no: Column, path: Column) -> Column:
    """Domain and path scores, up to six for the rank, three for the first query."""
    return domain + F.greatest(F.lit(0), 6 - rank) + F.when(query_no == 0, 3).otherwise(0) + path


def search_topk(results: DataFrame, key: str, score: str, k: int = 3) -> DataFrame:
    """Each record's ``k`` best distinct URLs by (score down, query, rank, url); of a URL found twice the better counts."""
    order = [F.col(score).desc(), F.col("query_no"), F.col("rank"), F.col("url")]
    return first_by(first_by(results, [key, "url"], order), [key], order, k)


def contact_score(url: Column, token: Column, base: Column) -> Column:
    """Same host 20 or same registrable domain 15, contact path 10 and words 8 (お問い合わせ 8 more), rejected paths -40, recruiting words -30, a form host 5, the homepage itself 2."""
    h, b, p, t = urls.netloc(url), urls.netloc(base), F.lower(urls.path(url)), F.lower(token)
    near = F.when(h == b, 20).when(urls.registrable(urls.host(url)) == urls.registrable(urls.host(base)), 15).otherwise(0)
    has = lambda c, words: F.when(urls.has_segment(c, words), 1).otherwise(0)
    score = near + has(p, CONTACT_PATHS) * 10 + has(t, CONTACT_WORDS) * 8 + has(t, ("お問い合わせ",)) * 8 - has(p, REJECTED_PATHS) * 40 - has(t, ("採用", "recruit", "career", "求人")) * 30
    return score + F.when(urls.host_in(urls.host(url), FORM_HOSTS), 5).otherwise(0) + F.when(url == base, 2).otherwise(0)


def contact_content_score(page: Column, text: Column, page_type: Column) -> Column:
    """A form 10, a general inquiry in it 8, recruiting alone -30, mail without a form 4, contact words 6, a contact page 15."""
    source, body = F.coalesce(page, F.lit("")), F.coalesce(text, F.lit(""))
    form = F.lower(source).contains("<form")
    inner = F.array_join(F.regexp_extract_all(source, F.lit(r"(?is)<form\b.*?</form>"), F.lit(0)), " ")
    general, recruit = inner.rlike("お問い合わせ|問合せ|問い合わせ|ご相談|ご質問"), inner.rlike("応募|求人|採用|リクルート|エントリー")
    mail = F.lower(source).contains("mailto:") | source.rlike(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}")
    rules = ((form, 10), (general, 8), (recruit & ~general, -30), (mail & ~form, 4), (body.rlike("お問い合わせ|お問合せ|問い合わせ"), 6), (page_type == "ACCESS_CONTACT", 15))
    return sum((F.when(c, v).otherwise(0) for c, v in rules), F.lit(0))


def contact_url(candidates: DataFrame, fetched: DataFrame, key: str, fetch: int = 6, least: int = 25) -> DataFrame:
    """Each record's contact URL: its ``fetch`` best candidates by (score down, url), their contents' scores added, the best if it reaches ``least``."""
    top = first_by(candidates, [key], [F.col("score").desc(), F.col("url")], fetch)
    whole = top.join(fetched.select("url", F.col("content_score")), "url", "left").withColumn("total", F.col("score") + F.coalesce("content_score", F.lit(0)))
    best = first_by(whole, [key], [F.col("total").desc(), F.col("url")])
    return best.select(key, F.when(F.col("total") >= least, F.col("url")).alias("contact_url"), F.col("total").alias("contact_score"), F.when(F.col("total") >= least, "success").otherwise("no_contact").alias("contact_status"))


@F.pandas_udf(StructType([StructField("score", IntegerType()), StructField("evidence", ArrayType(StringType()))]))
def official_evidence(name: pd.Series, url: pd.Series, source: pd.Series) -> pd.DataFrame:
    """How a page's own words speak for it being the named company's: title, heading and site name 3 each (2 if nearly), JSON-LD organisation 4, footer 2, company links 1."""
    rows = []
    for n, _, s in zip(name, url, source, strict=True):
        page, score, found = pages.Page(s), 0, []
        h1 = next((t for tag, t in page.headings if tag == "h1"), "")
        for mark, value in (("title", page.title), ("h1", h1), ("og", page.metas.get("og:site_name", ""))):
            ratio, exact, part, _ = names.name_match(n, [value])
            if value and (exact or part):
                score, found = score + 3, [*found, mark]
            elif ratio >= 0.85:
                score, found = score + 2, [*found, f"{mark}_partial"]
        if any(isinstance(o.get("name"), str) and names.name_match(n, [o["name"]])[1] for o in page.objects()):
            score, found = score + 4, [*found, "jsonld"]
        if n and names.name_match(n, [page.footer()])[2]:
            score, found = score + 2, [*found, "footer"]
        if any("会社概要" in t or "/company" in h for h, t, _ in page.links):
            score, found = score + 1, [*found, "links"]
        rows.append((score, found))
    return pd.DataFrame(rows, columns=["score", "evidence"])


def official_site(host: Column, directory: Column, name_ratio: Column, name_part: Column, domain: Column, host_token: Column, evidence: Column, prefecture_differs: Column, address_met: Column, entity_suffix_ok: Column) -> Column:
    """STRUCT(official, score, reason): an ordered decision list, first what rules a site out, then what makes it sure, then a score of 4 and more."""
    score = domain + F.when(name_ratio >= 0.9, 4).when(name_ratio >= 0.7, 2).when(name_part, 1).otherwise(0) + F.when(address_met, 4).otherwise(0) + F.floor(F.least(evidence, F.lit(12)) / 3) + F.when(host_token, 2).otherwise(0) - F.when(prefecture_differs, 6).otherwise(0)
    score = score.cast("int")
    out = lambda ok, why: F.struct(F.lit(ok).alias("official"), score.alias("score"), F.lit(why).alias("reason"))
    named = (name_ratio >= 0.9) | address_met | (evidence >= 9)
    return (
        F.when(blank(host), out(False, "no_host"))
        .when(urls.host_in(host, PLATFORMS), out(False, "blocked_host"))
        .when(directory >= 10, out(False, "directory_like"))
        .when(~entity_suffix_ok, out(False, "entity_suffix"))
        .when(prefecture_differs & ~named, out(False, "prefecture_differs"))
        .when(host_token & named, out(True, "host_and_name"))
        .when(address_met & (name_part | (name_ratio >= 0.7)), out(True, "address_and_name"))
        .when(evidence >= 11, out(True, "evidence"))
        .when(~host_token & (name_ratio < 0.5) & ~name_part & ~address_met, out(False, "host_no_name_no_address"))
        .otherwise(F.struct((score >= 4).alias("official"), score.alias("score"), F.lit("score").alias("reason")))
    )


def page_rank(page_type: Column) -> Column:
    out = F.lit(len(PAGE_ORDER))
    for i, kind in reversed(list(enumerate(PAGE_ORDER))):
        out = F.when(page_type == kind, i).otherwise(out)
    return out


def first_by_page(values: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """For each record and field the first valid value by (page type, fields present down, type score down, profile URL first, page number), with its page.

    ``values`` has a row a page: ``key``, page_no, url, page_type, type_score and
    the fields. One aggregate, no sort.
    """
    present = sum((F.when(~blank(F.col(f)), 1).otherwise(0) for f in fields), F.lit(0))
    order = F.struct(page_rank(F.col("page_type")), -present, -F.col("type_score"), ~F.coalesce(F.col("url"), F.lit("")).rlike("(?i)/(company|about|profile|overview|corporate)"), F.col("page_no"))
    aggs = []
    for f in fields:
        ok = ~blank(F.col(f))
        aggs += [F.min_by(F.when(ok, F.col(f)), F.when(ok, order)).alias(f), F.min_by(F.when(ok, F.col("url")), F.when(ok, order)).alias(f"{f}_url")]
    return values.groupBy(key).agg(*aggs)


def migrated(rows: DataFrame, homepage: str = "homepage", flag: str = "homepage_official_flag") -> DataFrame:
    """Official homepages on a platform's host move to alt_homepage, of type platform."""
    moved = F.coalesce((F.col(flag) == 1) & urls.host_in(urls.host(F.col(homepage)), PLATFORMS), F.lit(False))
    return rows.withColumns({"alt_homepage": F.when(moved, F.col(homepage)), "alt_homepage_type": F.when(moved, "platform"), homepage: F.when(moved, "").otherwise(F.col(homepage)), flag: F.when(moved, 0).otherwise(F.col(flag))})


#: Markets and words of a listing field.
LISTINGS = ("東証", "プライム", "スタンダード", "グロース", "名証", "札証", "福証", "jasdaq", "マザーズ", "上場", "非上場", "未上場", "nasdaq", "nyse")


def listing(c: Column) -> Column:
    """A market or a four-digit code of up to 15 characters without sentence marks; blank for anything else."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"\s|　", "")
    known = urls.has_segment(s, LISTINGS) | s.rlike("^[0-9]{4}$")
    return F.when(~F.coalesce(c, F.lit("")).rlike(r"[。！？!?\n]") & (F.length(s) <= 15) & known, s).otherwise("")


DESCRIPTION_WORDS = ("事業", "サービス", "製造", "開発", "販売", "提供", "運営", "支援", "製品", "システム", "物流", "建設", "工事", "技術", "教育", "医療", "食品", "不動産")
_DROP = r"お問い合わせ|お問合せ|アクセス|予約|営業時間|方針|ポリシー|理念|ビジョン|挨拶|メッセージ|品質|環境|安全|コンプライアンス|https?://|mailto:|[@＠]|(?i:tel)[:：]|電話|口コミ|ランキング|データベース"


def description(c: Column, least: int = 10, most: int = 200) -> Column:
    """The first sentence that speaks of the business and of nothing else; blank if there is none."""
    plain = squeezed(F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]*>", " "))
    parts = F.filter(F.transform(F.split(plain, "[。．]"), squeezed), lambda s: (F.length(s) >= least) & ~s.rlike(_DROP) & urls.has_segment(s, DESCRIPTION_WORDS))
    template = plain.rlike("(?i)[〇◯]{2,}|xxx|サンプル|class=|svg")
    return F.when(~template & (F.size(parts) > 0), F.substring(F.get(parts, F.lit(0)), 1, most)).otherwise("")


def final_description(candidates: Column, low: int = 80, high: int = 160) -> Column:
    """One or two distinct candidates by (business words down, nearness to 120 characters, length down), joined to ``low``..``high`` characters."""
    hits = lambda s: sum((F.contains(s, F.lit(w)).cast("int") for w in DESCRIPTION_WORDS), F.lit(0))
    clean = F.array_distinct(F.filter(F.transform(candidates, lambda s: description(s)), lambda s: s != ""))
    order = F.transform(F.array_sort(F.transform(clean, lambda s: F.struct((-hits(s)).alias("h"), F.abs(F.length(s) - 120).alias("d"), (-F.length(s)).alias("l"), s.alias("s")))), lambda x: x["s"])
    first = F.get(order, F.lit(0))
    fits = F.filter(order, lambda s: (s != first) & (F.length(first) + F.length(s) + 2 <= high))
    both = F.when((F.length(first) < low) & (F.size(fits) > 0), F.concat(first, F.lit("。"), F.get(fits, F.lit(0)))).otherwise(first)
    return F.when(first.isNotNull(), F.concat(F.substring(both, 1, high - 1), F.lit("。"))).otherwise("")


RESULT = "struct<phone_number:string,address:string,representative:string,industry:string,business_tags:array<string>,description:string,confidence:double,evidence:string>"


def model_result(raw: Column) -> Column:
    """A model's JSON as a struct of checked fields: confidence within 0..1, at most five tags of 24 characters, evidence of 12 characters and more."""
    r = F.from_json(raw, RESULT)
    text = lambda c, most: F.nullif(F.substring(squeezed(c), 1, most), F.lit(""))
    tags = F.slice(F.filter(F.transform(F.coalesce(r["business_tags"], F.array().cast("array<string>")), lambda t: text(t, 24)), lambda t: t.isNotNull()), 1, 5)
    return F.struct(
        text(r["phone_number"], 40).alias("phone_number"), text(r["address"], 200).alias("address"), text(r["representative"], 80).alias("representative"), text(r["industry"], 60).alias("industry"),
        tags.alias("business_tags"), text(r["description"], 160).alias("description"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(r["confidence"], F.lit(0.0)))).alias("confidence"), F.when(F.length(squeezed(r["evidence"])) >= 12, text(r["evidence"], 200)).alias("evidence"),
    )


def merged_results(strict: Column, relaxed: Column, fields: Sequence[str]) -> Column:
    """Field by field the strict result, else the relaxed one; mixed confidence is the greater of the strict and 0.95 of the relaxed."""
    cols = [F.coalesce(strict[f], relaxed[f]).alias(f) for f in fields]
    mixed = F.lit(False)
    for f in fields:
        mixed = mixed | (strict[f].isNull() & relaxed[f].isNotNull())
    sure = F.when(mixed, F.greatest(strict["confidence"], relaxed["confidence"] * 0.95)).otherwise(strict["confidence"])
    stage = F.when(~mixed, "strict").when(F.coalesce(*[strict[f] for f in fields]).isNull(), "relaxed").otherwise("mixed")
    return F.struct(*cols, sure.alias("confidence"), stage.alias("stage"))


def cached(rows: DataFrame, cache: DataFrame, text: str, model: str, embed) -> tuple[DataFrame, DataFrame]:
    """(rows with vectors, new cache entries): the cache's vector of each text, else ``embed`` of the distinct missing ones.

    Keys are SHA-256 of model and text; ``embed`` maps a DataFrame with ``text``
    to one with ``vector`` added.
    """
    keyed = rows.withColumn("cache_key", F.sha2(F.concat(F.lit(model + "\n"), F.col(text)), 256))
    missing = keyed.select("cache_key", F.col(text).alias("text")).join(cache.select("cache_key"), "cache_key", "left_anti").dropDuplicates(["cache_key"])
    new = embed(missing).select("cache_key", F.lit(model).alias("model"), "text", "vector")
    return keyed.join(cache.select("cache_key", "vector").unionByName(new.select("cache_key", "vector")), "cache_key", "left"), new

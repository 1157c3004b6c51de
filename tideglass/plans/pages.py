"""Plans over web pages: URL keys and scores, flags, fingerprints, outlines, links and crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import page_types
from tideglass.functions import pages as P
from tideglass.functions import urls as U
from tideglass.operators import match, state
from tideglass.sources.tables import table

from .registry import query

_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', '')"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"
_URLS = f"u AS (SELECT page_id, url, {_HOST} AS host, {_PATH} AS path FROM pages)"


@query(f"""
WITH {_URLS} SELECT page_id, host, regexp_replace(host, '^www\\.', '') AS bare_host, array_to_string(string_split(host, '.')[-2:], '.') AS registrable,
 lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) || '://' || regexp_replace(host, '^www\\.', '') || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END AS flag_key,
 CASE WHEN array_to_string(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(string_split(x, '=')[1]), '^utm_|^(gclid|fbclid|yclid|mc_cid|mc_eid|ref|ref_src|_gl)$')), '&') = ''
  THEN lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || host || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END
  ELSE lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || host || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END || '?' || array_to_string(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(string_split(x, '=')[1]), '^utm_|^(gclid|fbclid|yclid|mc_cid|mc_eid|ref|ref_src|_gl)$')), '&') END AS cache_key FROM u""")
def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.host(u).alias("host"), U.bare_host(u).alias("bare_host"), U.registrable(U.host(u)).alias("registrable"), U.flag_key(u).alias("flag_key"), U.cache_key(u).alias("cache_key"))


@query(f"""
WITH {_URLS}, p AS (SELECT *, list_filter(string_split_regex(host, '[.\\-]'), lambda x: x <> '' AND x NOT IN ('www', 'co', 'or', 'ne', 'go', 'gr', 'ed', 'lg', 'jp', 'com', 'net', 'biz', 'inc')) AS labels, ['thre', 'example'] AS tokens FROM u)
SELECT page_id, (CASE WHEN regexp_matches(host, '\\.(co|or|go|ac)\\.jp$') THEN 3 WHEN host LIKE '%.jp' THEN 2 WHEN regexp_matches(host, '\\.(com|net)$') THEN 1 ELSE 0 END
 + list_sum(list_transform(tokens, lambda t: (contains(host, t) OR contains(regexp_replace(host, '[.\\-]', '', 'g'), t))::int * 6 + (len(list_filter(labels, lambda l: contains(l, t))) > 0)::int * 4 + contains(lower(path), t)::int * 3))
 - (len(list_intersect(labels, ['system', 'systems', 'tech', 'technology', 'consulting', 'solution', 'solutions', 'soft', 'software', 'works', 'service', 'services', 'info', 'web'])) > 0)::int * 2
 + regexp_matches(lower(path), '/(company|about|profile|overview|corporate)')::int * 3 - regexp_matches(lower(path), '/(recruit|careers|job|jobs|blog|news|press|release|topics|media|information)')::int * 2)::int AS score FROM p""")
def domain_score_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.domain_score(F.col("url"), F.array(F.lit("thre"), F.lit("example"))).cast("int").alias("score"))


@query(f"""
WITH {_URLS}, v AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/company/' || (100 + page_id) WHEN 1 THEN '/search' WHEN 2 THEN '/instance/detail' WHEN 3 THEN '/x/1234567890123' ELSE lower(path) END AS path,
 CASE page_id % 4 WHEN 0 THEN 'id=' || (10 + page_id) WHEN 1 THEN 'corporate_number=1234567890123' ELSE '' END AS q, CASE WHEN page_id % 5 = 0 THEN '企業一覧と検索' ELSE '' END AS t FROM u)
SELECT page_id, (regexp_matches(path, '/(companies|company|corp|corporation|corporations|detail)/[0-9]+(/|$)|/instance/(detail|company|corporate|official)[-_]?[0-9]+(/|$)|/[0-9]{{13}}(/|$)')::int * 10
 + regexp_matches(path, '/(companies|company|corporations|detail)/[0-9]+(/|$)|/instance/(detail|company|corporate|official)[-_]?[0-9]*(/|$)|/(directory|listing|db|search)(/|$)')::int * 8
 + (q LIKE 'corporate%')::int * 10 + (q LIKE 'id=%')::int * 4 + regexp_matches(path, '(^|[^0-9])[0-9]{{13}}([^0-9]|$)')::int * 10 + CASE WHEN t <> '' THEN 2 + 2 + 3 ELSE 0 END)::int AS score FROM v""")
def directory_like_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, u = F.col("page_id"), F.col("url")
    path = F.when(k % 6 == 0, F.concat(F.lit("/company/"), (100 + k).cast("string"))).when(k % 6 == 1, "/search").when(k % 6 == 2, "/instance/detail").when(k % 6 == 3, "/x/1234567890123").otherwise(F.lower(U.path(u)))
    q = F.when(k % 4 == 0, F.concat(F.lit("?id="), (10 + k).cast("string"))).when(k % 4 == 1, "?corporate_number=1234567890123").otherwise("")
    url = F.concat(F.lit("https://"), U.host(u), path, q)
    return table(spark, sf_dir, "pages").select("page_id", P.directory_score(url, F.when(k % 5 == 0, "企業一覧と検索").otherwise(""), F.lit(None).cast("string")).cast("int").alias("score"))


_FLAGS = f"""{_URLS}, f AS (SELECT regexp_replace(host, '^www\\.', '') AS host, 'https://' || host AS k, page_id FROM u),
hf AS (SELECT host, page_id % 2 = 0 AS official FROM f WHERE page_id % 3 = 0 QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id DESC) = 1)"""


def _flags(pages: DataFrame) -> DataFrame:
    k = F.col("page_id")
    host = pages.where(k % 3 == 0).select(F.lit("host").alias("scope"), U.bare_host(F.col("url")).alias("key"), (k % 2 == 0).alias("official"), k.alias("updated_at"))
    url = pages.where(k % 5 == 0).select(F.lit("url"), U.flag_key(F.col("url")), k % 7 == 0, k)
    empty = host.where("false")
    return match.upsert_latest(empty, host.union(url), ["scope", "key"], "updated_at")


@query(f"""
WITH {_FLAGS}, p AS (SELECT page_id, regexp_replace(host, '^www\\.', '') AS host, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || regexp_replace(host, '^www\\.', '') || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END AS k FROM u),
uf AS (SELECT k, page_id % 7 = 0 AS official FROM p WHERE page_id % 5 = 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY page_id DESC) = 1)
SELECT p.page_id, CASE WHEN uf.k IS NOT NULL THEN 'url' WHEN hf.host IS NOT NULL THEN 'host' END AS flag_scope, CASE WHEN uf.k IS NOT NULL THEN uf.official ELSE hf.official END AS official FROM p LEFT JOIN uf USING (k) LEFT JOIN hf ON hf.host = p.host""")
def url_flag_lookup_two_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rows = pages.select("page_id", U.flag_key(F.col("url")).alias("url_key"), U.bare_host(F.col("url")).alias("host_key"))
    return match.two_scopes(rows, _flags(pages), "url_key", "host_key", ["official"]).select("page_id", "flag_scope", "official")


@query(f"WITH {_FLAGS} SELECT 'host' AS scope, host AS key, official FROM hf")
def url_flag_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(table(spark, sf_dir, "pages").select("page_id", "url")).where("scope = 'host'").select("scope", "key", "official")


_STRIP = "regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
for _tag in ("script", "style", "noscript", "iframe"):
    _STRIP = f"regexp_replace({_STRIP}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}>', ' ', 'g')"
for _stamp in (r"\b20[0-9]{2}[/-][0-9]{1,2}[/-][0-9]{1,2}\b", r"\b[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\b", "20[0-9]{2}年[0-9]{1,2}月[0-9]{1,2}日", r"\s+"):
    _STRIP = f"regexp_replace({_STRIP}, '{_stamp}', ' ', 'g')"


@query(f"SELECT page_id, sha256(trim({_STRIP})) AS fingerprint FROM pages")
def page_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.fingerprint(F.col("html")).alias("fingerprint"))


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'new' WHEN page_id % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS change FROM pages")
def unchanged_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    now = p.select("page_id", U.cache_key(F.col("url")).alias("url"), U.fingerprint(F.col("html")).alias("fingerprint"))
    page = F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit(" more"))).otherwise(F.concat(F.lit("<!-- at 12:30 on 2024-01-02 -->"), "html"))
    before = p.where("page_id % 4 <> 0").select("page_id", U.cache_key(F.col("url")).alias("url"), U.fingerprint(page).alias("fingerprint"))
    return state.unchanged(now, before, "page_id", ["url", "fingerprint"]).select("page_id", "change")


@query()
def page_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, heading, description, text, type and ranked links by an HTML tokenizer, which SQL has not."""
    return page_types.outlines(table(spark, sf_dir, "pages"))


@query()
def html_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", P.visible_text("html").alias("text"))


@query()
def page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged candidates of every field, with the best phone and address of each page."""
    from tideglass.functions import address, phone

    c = table(spark, sf_dir, "pages").select("page_id", P.page_candidates(F.lit(None).cast("string"), "html").alias("c")).select("page_id", "c.*")
    return c.withColumns({"best_phone": phone.best(F.col("phone")), "best_address": address.best_candidate(F.col("address"), F.lit(None).cast("string"))})


@query()
def bounded_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to six pages within four hops of every page, over links that the table's own ids make."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("src"), F.col("page_id"))
    n = p.count()
    links = p.select("src", F.posexplode(F.array(*[((F.col("page_id") * 3 + i) % n).cast("string") for i in (1, 2, 5)])).alias("rank", "dst"))
    return state.crawl(p.select(F.col("src").alias("root")), links.select("src", "dst", "rank"))

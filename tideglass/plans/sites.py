"""Plans of search results, contact pages, official sites, page order and model results over derived rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import urls as U
from tideglass.operators import sites
from tideglass.sources.tables import table

from .registry import query


@query("""
WITH r AS (SELECT o_custkey, 'u' || (o_orderkey % 7) AS url, (o_orderkey % 3)::int AS query_no, (o_orderkey % 10)::int AS rank, (o_orderkey % 5)::int + greatest(0, 6 - (o_orderkey % 10)::int) + CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END AS score FROM orders),
d AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey, url ORDER BY score DESC, query_no, rank) = 1)
SELECT o_custkey, url, score FROM d QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, query_no, rank, url) <= 3""")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    r = table(spark, sf_dir, "orders").select("o_custkey", F.concat(F.lit("u"), (k % 7).cast("string")).alias("url"), (k % 3).cast("int").alias("query_no"), (k % 10).cast("int").alias("rank"), (k % 5).cast("int").alias("domain"))
    r = r.withColumn("score", sites.search_score(F.col("domain"), F.col("rank"), F.col("query_no"), F.lit(0)))
    return sites.search_topk(r, "o_custkey", "score").select("o_custkey", "url", "score")


@query("""
WITH c AS (SELECT s_suppkey AS id, i, CASE i WHEN 0 THEN 'https://a' || s_suppkey || '.jp/contact' WHEN 1 THEN 'https://www.a' || s_suppkey || '.jp/recruit/contact' WHEN 2 THEN 'https://form.run/x' || s_suppkey ELSE 'https://a' || s_suppkey || '.jp/' END AS url,
 CASE WHEN (s_suppkey + i) % 3 = 0 THEN 'お問い合わせ' WHEN (s_suppkey + i) % 3 = 1 THEN 'recruit' ELSE 'top' END AS token, 20 AS same, s_suppkey FROM supplier, (SELECT unnest(range(0, 4)) AS i)),
s AS (SELECT id, url, CASE WHEN i IN (0, 3) THEN 20 WHEN i = 1 THEN 15 ELSE 0 END + CASE WHEN i IN (0, 1) THEN 10 ELSE 0 END + CASE WHEN token = 'お問い合わせ' THEN 16 ELSE 0 END - CASE WHEN i = 1 THEN 40 ELSE 0 END - CASE WHEN token = 'recruit' THEN 30 ELSE 0 END
 + CASE WHEN i = 2 THEN 5 ELSE 0 END + CASE WHEN i = 3 THEN 2 ELSE 0 END + CASE WHEN (s_suppkey + i) % 4 = 0 THEN 21 ELSE 0 END AS total FROM c)
SELECT id, CASE WHEN total >= 25 THEN url END AS contact_url, total AS contact_score, CASE WHEN total >= 25 THEN 'success' ELSE 'no_contact' END AS contact_status FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY total DESC, url) = 1""")
def contact_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    own = F.concat(F.lit("a"), k.cast("string"), F.lit(".jp"))
    made = [F.concat(F.lit("https://"), own, F.lit("/contact")), F.concat(F.lit("https://www."), own, F.lit("/recruit/contact")), F.concat(F.lit("https://form.run/x"), k.cast("string")), F.concat(F.lit("https://"), own, F.lit("/"))]
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), k.alias("s_suppkey"), made[3].alias("base"), F.posexplode(F.array(*made)).alias("i", "url"))
    rows = rows.withColumn("token", F.when((k + F.col("i")) % 3 == 0, "お問い合わせ").when((k + F.col("i")) % 3 == 1, "recruit").otherwise("top"))
    rows = rows.withColumn("score", sites.contact_score(F.col("url"), F.col("token"), F.col("base")))
    page = rows.where((k + F.col("i")) % 4 == 0).select("url", sites.contact_content_score(F.lit(None).cast("string"), F.lit("お問い合わせ"), F.lit("ACCESS_CONTACT")).alias("content_score"))
    return sites.contact_url(rows.select("id", "url", "score"), page, "id")


@query("""
WITH f AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 13 = 0 THEN '' WHEN s_suppkey % 11 = 0 THEN 'www.facebook.com' ELSE 'a.jp' END AS host, (s_suppkey % 14)::int AS directory, (s_suppkey % 10) / 10.0 AS ratio, s_suppkey % 4 = 0 AS part, (s_suppkey % 6)::int AS dom, s_suppkey % 3 = 0 AS token, (s_suppkey % 12)::int AS ev, s_suppkey % 9 = 0 AS differs, s_suppkey % 7 = 0 AS addr, s_suppkey % 17 <> 0 AS entity FROM supplier),
s AS (SELECT *, (dom + CASE WHEN ratio >= 0.9 THEN 4 WHEN ratio >= 0.7 THEN 2 WHEN part THEN 1 ELSE 0 END + addr::int * 4 + floor(least(ev, 12) / 3) + token::int * 2 - differs::int * 6)::int AS score, (ratio >= 0.9 OR addr OR ev >= 9) AS named FROM f),
r AS (SELECT *, CASE WHEN host = '' THEN 'no_host' WHEN host LIKE '%facebook.com' THEN 'blocked_host' WHEN directory >= 10 THEN 'directory_like' WHEN NOT entity THEN 'entity_suffix' WHEN differs AND NOT named THEN 'prefecture_differs' WHEN token AND named THEN 'host_and_name'
 WHEN addr AND (part OR ratio >= 0.7) THEN 'address_and_name' WHEN ev >= 11 THEN 'evidence' WHEN NOT token AND ratio < 0.5 AND NOT part AND NOT addr THEN 'host_no_name_no_address' ELSE 'score' END AS reason FROM s)
SELECT k AS s_suppkey, CASE WHEN reason IN ('host_and_name', 'address_and_name', 'evidence') THEN true WHEN reason = 'score' THEN score >= 4 ELSE false END AS official, score, reason FROM r""")
def official_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    host = F.when(k % 13 == 0, "").when(k % 11 == 0, "www.facebook.com").otherwise("a.jp")
    d = sites.official_site(host, (k % 14).cast("int"), (k % 10) / F.lit(10.0), k % 4 == 0, (k % 6).cast("int"), k % 3 == 0, (k % 12).cast("int"), k % 9 == 0, k % 7 == 0, k % 17 != 0)
    return table(spark, sf_dir, "supplier").select("s_suppkey", d.alias("d")).select("s_suppkey", "d.*")


@query("""
WITH v AS (SELECT o_custkey AS id, o_orderkey AS page_no, 'https://x/' || CASE WHEN o_orderkey % 3 = 0 THEN 'company' ELSE 'p' || o_orderkey END AS url, ['COMPANY_PROFILE', 'ACCESS_CONTACT', 'OTHER', 'DIRECTORY_DB', 'BASES_LIST'][(o_orderkey % 5 + 1)::int] AS page_type, (o_orderkey % 4)::int AS type_score,
 CASE WHEN o_orderkey % 2 = 0 THEN 'p' || o_orderkey ELSE ' ' END AS phone, CASE WHEN o_orderkey % 7 < 4 THEN 'a' || o_orderkey END AS address FROM orders),
o AS (SELECT *, CASE page_type WHEN 'COMPANY_PROFILE' THEN 0 WHEN 'ACCESS_CONTACT' THEN 1 WHEN 'BASES_LIST' THEN 2 WHEN 'OTHER' THEN 3 ELSE 4 END AS r, (trim(phone) <> '')::int + (address IS NOT NULL)::int AS present, NOT contains(url, '/company') AS other FROM v),
p AS (SELECT id, phone, url FROM o WHERE trim(phone) <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY r, present DESC, type_score DESC, other, page_no) = 1),
a AS (SELECT id, address, url FROM o WHERE address IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY r, present DESC, type_score DESC, other, page_no) = 1)
SELECT DISTINCT v.id, p.phone, p.url AS phone_url, a.address, a.url AS address_url FROM v LEFT JOIN p USING (id) LEFT JOIN a USING (id)""")
def first_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    kinds = F.array(*[F.lit(x) for x in ("COMPANY_PROFILE", "ACCESS_CONTACT", "OTHER", "DIRECTORY_DB", "BASES_LIST")])
    url = F.concat(F.lit("https://x/"), F.when(k % 3 == 0, "company").otherwise(F.concat(F.lit("p"), text)))
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), k.alias("page_no"), url.alias("url"), F.get(kinds, (k % 5).cast("int")).alias("page_type"), (k % 4).cast("int").alias("type_score"), F.when(k % 2 == 0, F.concat(F.lit("p"), text)).otherwise(" ").alias("phone"), F.when(k % 7 < 4, F.concat(F.lit("a"), text)).alias("address"))
    return sites.first_by_page(v, "id", ["phone", "address"])


LISTINGS = ["東証 プライム", "非上場", "7203", "上場しています。", "とても長い文字列でこれは上場区分ではないもの", "", None, "JASDAQ"]


@query("""
SELECT id, v, CASE WHEN NOT regexp_matches(coalesce(v, ''), '[。！？!?\\n]') AND length(s) <= 15 AND (regexp_matches(lower(s), '東証|プライム|スタンダード|グロース|名証|札証|福証|jasdaq|マザーズ|上場|nasdaq|nyse') OR regexp_matches(s, '^[0-9]{4}$')) THEN s ELSE '' END AS listing
FROM (SELECT *, regexp_replace(coalesce(v, ''), '\\s|　', '', 'g') AS s FROM (VALUES """ + ", ".join(f"({i}::bigint, {'NULL' if v is None else repr(v)}::varchar)" for i, v in enumerate(LISTINGS)) + ") AS t(id, v))")
def listing_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(LISTINGS)), "id long, v string").withColumn("listing", sites.listing(F.col("v")))


@query("""
WITH r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'p' || c_custkey END AS sp, CASE WHEN c_custkey % 3 = 0 THEN 'a' END AS sa, 0.5 AS sc, CASE WHEN c_custkey % 5 <> 0 THEN 'q' || c_custkey END AS rp, CASE WHEN c_custkey % 4 = 0 THEN 'b' END AS ra, ((c_custkey % 13) / 10.0) AS rc FROM customer),
m AS (SELECT *, least(rc, 1.0) AS rcc, (sp IS NULL AND rp IS NOT NULL) OR (sa IS NULL AND ra IS NOT NULL) AS mixed FROM r)
SELECT id, coalesce(sp, rp) AS phone_number, coalesce(sa, ra) AS address, round(CASE WHEN mixed THEN greatest(sc, rcc * 0.95) ELSE sc END, 6)::double AS confidence, CASE WHEN NOT mixed THEN 'strict' WHEN sp IS NULL AND sa IS NULL THEN 'relaxed' ELSE 'mixed' END AS stage FROM m""")
def model_result_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    strict = F.to_json(F.struct(F.when(k % 2 == 0, F.concat(F.lit("p"), text)).alias("phone_number"), F.when(k % 3 == 0, "a").alias("address"), F.lit(0.5).alias("confidence")))
    relaxed = F.to_json(F.struct(F.when(k % 5 != 0, F.concat(F.lit("q"), text)).alias("phone_number"), F.when(k % 4 == 0, " b ").alias("address"), ((k % 13) / F.lit(10.0)).alias("confidence")))
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), sites.model_result(strict).alias("s"), sites.model_result(relaxed).alias("r"))
    return rows.select("id", sites.merged_results(F.col("s"), F.col("r"), ["phone_number", "address"]).alias("m")).select("id", "m.phone_number", "m.address", F.round("m.confidence", 6).alias("confidence"), "m.stage")


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE url END AS homepage, CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS homepage_official_flag, CASE WHEN page_id % 3 = 0 THEN 'https://www.facebook.com/' || page_id END AS alt_homepage, CASE WHEN page_id % 3 = 0 THEN 'platform' END AS alt_homepage_type FROM pages""")
def homepage_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(k % 3 == 0, F.concat(F.lit("https://www.facebook.com/"), k.cast("string"))).otherwise(F.col("url")).alias("homepage"), F.lit(1).alias("homepage_official_flag"))
    return sites.migrated(rows)


@query()
def official_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of each page for the first word of its title's host as a name; difflib ratios, so rows only."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", sites.official_evidence(F.regexp_extract("html", "(?is)<title>([^<]*)", 1), "url", "html").alias("e")).select("page_id", "e.*")


DESCRIPTIONS = ["私たちは建設事業と工事を全国で提供しています。お問い合わせはこちら。", "サンプル事業を提供するサービスです", "短い", "<b>製品</b>の開発および販売を行うメーカーです", "企業理念は品質です。システム開発の技術支援を行っております。", None]


@query()
def description_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(DESCRIPTIONS)), "id long, v string")
    every = F.array(*[F.lit(d) for d in DESCRIPTIONS])
    return rows.select("id", sites.description(F.col("v")).alias("description"), sites.final_description(every).alias("final"))


@query("""
WITH t AS (SELECT event_id, event_type AS text FROM events), c AS (SELECT DISTINCT sha256('m' || chr(10) || text) AS k FROM t WHERE text IN ('view', 'click'))
SELECT event_id, sha256('m' || chr(10) || text) AS cache_key, length(text)::double AS v, text IN ('view', 'click') AS hit FROM t""")
def embedding_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("text"))
    key = F.sha2(F.concat(F.lit("m\n"), F.col("text")), 256)
    vector = F.array(F.length("text").cast("double"))
    cache = rows.where(F.col("text").isin("view", "click")).select(key.alias("cache_key"), vector.alias("vector")).dropDuplicates(["cache_key"])
    out, _ = sites.cached(rows, cache, "text", "m", lambda missing: missing.withColumn("vector", vector))
    return out.select("event_id", "cache_key", F.get("vector", F.lit(0)).alias("v"), F.col("text").isin("view", "click").alias("hit"))


@query(r"""
WITH u AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS p FROM pages)
SELECT page_id, regexp_matches(p, '/(contact|inquiry|toiawase)') AS contact_like, regexp_matches(p, '/(news|press|blog|topics|release)') AS news_like, regexp_matches(p, '/(company|about|profile|overview|corporate)') AS profile_like,
 (CASE WHEN contains(p, '/fr') THEN 6 ELSE 0 END + CASE WHEN contains(p, '/de') THEN 5 ELSE 0 END)::int AS path_score FROM u""")
def url_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = U.path(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", U.has_segment(p, ("/contact", "/inquiry", "/toiawase")).alias("contact_like"), U.has_segment(p, ("/news", "/press", "/blog", "/topics", "/release")).alias("news_like"), U.has_segment(p, U.COMPANY_PATHS).alias("profile_like"), U.path_score(F.col("url"), ("/fr", "/de")).cast("int").alias("path_score"))

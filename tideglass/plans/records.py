"""Plans over stored records: imports, requeues, provisional sites, descriptions, script pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import prose
from tideglass.operators import records
from tideglass.sources.tables import table

from .registry import query


@query("""
WITH r AS (SELECT c_custkey AS id, c_name, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '  ' ELSE 'N' || c_custkey END AS corp, CASE WHEN c_custkey % 3 = 0 THEN 'h' || c_custkey END AS hub,
 CASE WHEN c_custkey % 7 = 0 THEN '御社のテレアポ代行します' || c_name WHEN c_custkey % 5 = 0 THEN '東ã' WHEN c_custkey % 6 = 0 THEN '' ELSE c_mktsegment END AS address, CASE c_custkey % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'review' ELSE 'error' END AS status FROM customer)
SELECT id, coalesce(nullif(trim(corp), ''), hub, c_name || '|' || address) AS pk, CASE WHEN address LIKE '%ã%' OR (status IN ('done', 'review') AND address = '') THEN 'pending' ELSE status END AS status,
 corp IS NULL OR trim(corp) = '' OR status = '不明' AS unclassified FROM r WHERE address NOT LIKE '%テレアポ代行します%'""")
def record_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adverts dropped, keys chosen, records with lost or missing values queued again."""
    k = F.col("c_custkey")
    address = F.when(k % 7 == 0, F.concat(F.lit("御社のテレアポ代行します"), "c_name")).when(k % 5 == 0, "東ã").when(k % 6 == 0, "").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select(
        k.alias("id"), "c_name", F.when(k % 4 == 1, "  ").when(k % 4 > 1, F.concat(F.lit("N"), k.cast("string"))).alias("corp"), F.when(k % 3 == 0, F.concat(F.lit("h"), k.cast("string"))).alias("hub"),
        address.alias("address"), F.when(k % 3 == 0, "done").when(k % 3 == 1, "review").otherwise("error").alias("status"),
    )
    kept = records.without_adverts(rows)
    key = records.record_key(F.col("corp"), F.lit(None).cast("string"), F.col("hub"), F.col("c_name"), F.col("address"))
    kept = kept.withColumns({"pk": key, "unclassified": records.unclassified(F.col("status"), F.col("corp"), F.col("status"))})
    again = records.corrupted(F.col("address")) | (F.col("status").isin("done", "review") & records.missing_any(["address"]))
    return records.requeued(kept, again).select("id", "pk", "status", "unclassified")


@query("""
WITH s AS (SELECT o_custkey AS id, o_orderkey AS place, (o_orderkey % 6)::int AS domain, o_orderkey % 4 = 0 AS address_ok, (o_orderkey % 3)::double AS rule, (o_orderkey % 17)::int AS evidence,
  o_orderkey % 9 = 0 AS strong_host, o_orderkey % 11 = 0 AS judged, o_orderkey % 10 = 0 AS directory_like, o_orderkey % 7 = 0 AS host_token, o_orderkey % 8 = 0 AS name_present FROM orders),
c AS (SELECT *, domain * 2 + address_ok::int * 3 + rule + least(6.0, evidence / 2.0) + strong_host::int * 4 + judged::int * 6 AS score FROM s
 WHERE NOT directory_like AND (host_token OR strong_host OR name_present OR domain >= 4 OR (address_ok AND domain >= 3) OR evidence >= 10 OR judged))
SELECT id, place, score::double AS score FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, place) = 1""")
def provisional_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    flags = {"address_ok": k % 4 == 0, "strong_host": k % 9 == 0, "judged": k % 11 == 0, "directory_like": k % 10 == 0, "host_token": k % 7 == 0, "name_present": k % 8 == 0}
    sites = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), k.alias("place"), (k % 6).cast("int").alias("domain"), (k % 3).cast("double").alias("rule"), (k % 17).cast("int").alias("evidence"), *[v.alias(n) for n, v in flags.items()])
    return records.provisional(sites, "id").select("id", "place", F.col("score").cast("double").alias("score"))


@query("""
WITH p AS (SELECT page_id, lower(html) AS low, html, length(trim(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)\\b.*?</\\1\\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g'))) AS raw FROM pages)
SELECT page_id, len(regexp_extract_all(low, '<script'))::int AS scripts, contains(low, 'captcha') AND regexp_matches(low, 'are you human|verify you are human|robot') OR contains(low, 'captcha-delivery.com') AS challenge,
 marked FROM (SELECT *, (contains(low, 'id="__next"') OR contains(low, 'data-reactroot') OR contains(low, 'webpackjson') OR contains(low, '__next_data__') OR contains(low, 'id="__nuxt"') OR contains(low, 'react-dom') OR contains(low, 'window.__initial_state__')) AS marked FROM p)""")
def script_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of pages that scripts fill or that ask for a human, over all pages."""
    low = F.lower("html")
    p = table(spark, sf_dir, "pages")
    marked = F.lit(False)
    for m in prose.FILLED_BY_SCRIPT:
        marked = marked | F.contains(low, F.lit(m))
    return p.select("page_id", F.regexp_count(low, F.lit("<script")).alias("scripts"), prose.asks_for_human(F.col("html")).alias("challenge"), marked.alias("marked"))


@query("""
WITH d AS (SELECT c_custkey, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN '不明' WHEN 1 THEN '製造' ELSE '' END AS industry,
 CASE c_custkey % 5 WHEN 0 THEN '当社は、部品を作る。' WHEN 1 THEN 'We ' || c_name || ' 部品' WHEN 2 THEN '' WHEN 3 THEN '部品の製造' ELSE c_name || 'は製造。' END AS d FROM customer)
SELECT c_custkey, CASE WHEN d = '' THEN '' WHEN contains(d, name) THEN CASE WHEN industry = '製造' AND NOT contains(d, '製造') THEN replace(d, name, name || '（製造）') ELSE d END
 ELSE name || CASE WHEN industry = '製造' THEN '（製造）' ELSE '' END || 'は、' || regexp_replace(regexp_replace(d, '。$', ''), '^当社は、', '') || '。' END AS described FROM d""")
def description_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_name")
    text = F.when(k % 5 == 0, "当社は、部品を作る。").when(k % 5 == 1, F.concat(F.lit("We "), n, F.lit(" 部品"))).when(k % 5 == 2, "").when(k % 5 == 3, "部品の製造").otherwise(F.concat(n, F.lit("は製造。")))
    industry = F.when(k % 3 == 0, "不明").when(k % 3 == 1, "製造").otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", prose.named(text, n, industry).alias("described"))

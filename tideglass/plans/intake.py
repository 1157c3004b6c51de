"""Plans of rows that come in and of results that go back, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import company, urls
from tideglass.operators import intake
from tideglass.sources.tables import table

from .registry import query


@query("""
WITH r AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' || c_name ELSE NULL END AS address, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '〒100-0001' ELSE '100-0002 ' END AS zip,
 CASE WHEN c_custkey % 5 > 0 THEN '東京都' END AS pref, CASE WHEN c_custkey % 7 > 0 THEN '千代田区' ELSE '' END AS city, c_mktsegment AS b1 FROM customer),
t AS (SELECT c_custkey, coalesce(nullif(trim(address), ''), coalesce(pref, '') || city) AS body, coalesce(trim(replace(zip, '〒', '')), '') AS code, coalesce(pref, '') AS pref, city, b1 FROM r)
SELECT c_custkey, CASE WHEN code <> '' AND body <> '' THEN '〒' || code || ' ' || body ELSE body END AS given, CASE WHEN code <> '' THEN '〒' || code || ' ' ELSE '' END || pref || city || b1 AS parts FROM t""")
def address_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("c_custkey"), F.col
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit(" "), "c_name")).alias("address"), F.when(k % 4 == 1, "〒100-0001").when(k % 4 > 1, "100-0002 ").alias("zip"),
        F.when(k % 5 > 0, "東京都").alias("pref"), F.when(k % 7 > 0, "千代田区").otherwise("").alias("city"), c("c_mktsegment").alias("b1"),
    )
    return rows.select("c_custkey", intake.address_or_parts(c("address"), c("zip"), c("pref"), c("city")).alias("given"), intake.address_of_parts(c("zip"), c("pref"), c("city"), c("b1")).alias("parts"))


@query("""
WITH r AS (SELECT s_suppkey, s_nationkey, s_name FROM supplier), m AS (SELECT s_nationkey, min(s_suppkey) AS f FROM r GROUP BY 1)
SELECT s_suppkey, s_name AS name, '都市' || s_suppkey AS address FROM r JOIN m USING (s_nationkey) WHERE s_suppkey > f AND s_suppkey % 11 > 0""")
def positional_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by position, those behind each source's first row; every source's first row is made its sentinel."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    first = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("f"))
    number = F.col("s_suppkey").cast("string")
    full = F.array(F.concat(F.lit(" "), "s_name"), F.lit(""), F.lit("都"), F.lit("市 "), number)
    rows = s.join(first, "s_nationkey").withColumn("cells", F.when(F.col("s_suppkey") == F.col("f"), F.array(F.lit("会社名 "))).when(F.col("s_suppkey") % 11 == 0, F.array(F.lit(" "), F.lit(None))).otherwise(full))
    return intake.after_header(rows, "cells", "s_suppkey", "会社名", "s_nationkey").select("s_suppkey", intake.positional_record(F.col("cells")).alias("r")).select("s_suppkey", "r.*")


@query("""
SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey % 3 > 0 GROUP BY 1 ORDER BY 2 LIMIT 100""")
def bounded_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred new keys: the bound is the feature."""
    target = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return intake.inserted(target, table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 100)


@query("""
WITH t AS (SELECT o_orderkey AS id, 'running' AS status, 'f' || (o_orderkey % 9) AS homepage_fingerprint, CASE o_orderkey % 3 WHEN 1 THEN 'w1' WHEN 2 THEN 'w2' END AS locked_by, o_orderkey % 2 = 0 AS met, o_orderkey % 3 <> 2 AS own FROM orders)
SELECT id, CASE WHEN met AND own THEN 'done' ELSE status END AS status, CASE WHEN met AND own THEN 'new' ELSE homepage_fingerprint END AS homepage_fingerprint, CASE WHEN NOT (met AND own) THEN locked_by END AS locked_by,
 CASE WHEN met THEN CASE WHEN own THEN 'error' ELSE 'review' END ELSE status END AS marked, CASE WHEN NOT met THEN locked_by END AS marked_by FROM t""")
def update_under_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of one worker written back: of a check for changes, and of errors, which go to review where another holds the row."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), F.lit("running").alias("status"), F.concat(F.lit("f"), (k % 9).cast("string")).alias("homepage_fingerprint"), F.when(k % 3 == 1, "w1").when(k % 3 == 2, "w2").alias("locked_by"))
    results = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(k.alias("id"), F.lit("done").alias("status"), F.lit("new").alias("homepage_fingerprint"))
    checked = intake.written_back(rows, results, "id", intake.CHECK_COLUMNS, "w1")
    failed = intake.written_back(rows, results.withColumn("status", F.lit("error")), "id", ["error_code"], "w1", "review")
    return checked.join(failed.select("id", F.col("status").alias("marked"), F.col("locked_by").alias("marked_by")), "id")


@query("""
SELECT event_id, event_type FROM events WHERE NOT (event_type IN ('click', 'view') AND event_id % 2 = 0)""")
def flags_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    source = F.when(F.col("event_type").isin("click", "view"), "AI_judge").when(F.col("event_type") == "error", "rule")
    flags = table(spark, sf_dir, "events").select("event_id", "event_type", (k % 2).alias("is_official"), source.alias("judge_source"))
    return intake.without_model_refusals(flags).select("event_id", "event_type")


@query("""
WITH p AS (SELECT o_custkey AS id, 'https://x.jp/' || CASE o_orderkey % 3 WHEN 0 THEN 'company/' WHEN 1 THEN 'a/' ELSE '' END || o_orderkey AS url, CASE o_orderkey % 5 WHEN 0 THEN 'COMPANY_PROFILE' WHEN 1 THEN 'ACCESS_CONTACT' ELSE 'OTHER' END AS pt, (o_orderkey % 4)::int AS score, o_orderkey % 3 = 0 AS like_profile FROM orders),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY pt <> 'COMPANY_PROFILE', pt = 'ACCESS_CONTACT', NOT like_profile, -score, length(url), url) = 1)
SELECT id, CASE WHEN pt = 'ACCESS_CONTACT' AND id % 2 = 0 THEN 'https://now.jp/' ELSE url END AS page FROM b""")
def primary_info_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's page to read from; a record's pages are few."""
    k = F.col("o_orderkey")
    place = F.when(k % 3 == 0, "company/").when(k % 3 == 1, "a/").otherwise("")
    pages = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.struct(F.concat(F.lit("https://x.jp/"), place, k.cast("string")).alias("url"), F.when(k % 5 == 0, "COMPANY_PROFILE").when(k % 5 == 1, "ACCESS_CONTACT").otherwise("OTHER").alias("page_type"), (k % 4).cast("int").alias("score")).alias("p")
    )
    each = pages.groupBy("id").agg(F.collect_list("p").alias("pages"))
    current = F.when(F.col("id") % 2 == 0, "https://now.jp/")
    return each.select("id", intake.primary_page(F.col("pages"), current, lambda u: urls.has_segment(urls.path(u), urls.COMPANY_PATHS)).alias("page"))


@query("""
SELECT r_name AS top, string_agg(r_name || CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE ' / ' || n_name END, chr(10) ORDER BY n_nationkey) AS lines FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def candidate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.select("r_name", F.struct("n_nationkey", F.col("r_name").alias("top"), F.when(F.col("n_nationkey") % 4 > 0, F.col("n_name")).alias("sub")).alias("c"))
    return rows.groupBy("r_name").agg(F.array_sort(F.collect_list("c")).alias("cs")).select(F.col("r_name").alias("top"), intake.candidate_lines(F.col("cs")).alias("lines"))


@query(r"""
WITH n AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?i)(?:TEL|電話|☎|℡)?\s*0[0-9]{1,4}[-‐―－ー]?[0-9]{1,4}[-‐―－ー]?[0-9]{3,4}') AS found, text FROM documents)
SELECT doc_id, len(list_filter(found, lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 10 AND 12))::int AS numbers, coalesce(contains(regexp_replace(text, '[^0-9]', '', 'g'), '0' || doc_id), false) AS held FROM n""")
def phones_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone numbers in whole texts, and whether an id's digits follow each other there."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", company.without_phones(F.col("text"))["numbers"].alias("numbers"), company.holds_number(F.col("text"), F.concat(F.lit("0"), F.col("doc_id").cast("string"))).alias("held"))


@query("""
SELECT c_custkey, 'customer,' || lpad(c_custkey::varchar, 9, '0') || CASE c_custkey % 3 WHEN 0 THEN ',iim' WHEN 1 THEN ',sanrise,koumuten,sanrisekoumuten,threerise,threerisekoumuten' ELSE '' END AS words FROM customer""")
def company_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat("c_name", F.when(k % 3 == 0, "アイ・アイアイエム").otherwise(""))
    roman = F.when(k % 3 == 1, "SanRise Koumuten")
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(company.tokens(name, roman), ",").alias("words"))


@query(r"""
WITH u AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), ':[0-9]*$', '') AS h, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)) AS p FROM pages)
SELECT page_id, h AS host, p AS path, regexp_matches(h, '(\.jp|\.com|\.net|\.org|\.biz|\.info|\.co)$') AS allowed_end, regexp_matches(h, '(^|\.)big-advance\.site$') AS allowed_host, h = 'sites.google.com' OR (h LIKE '%.google.com' AND contains(p, 'sites')) AS google_site FROM u""")
def official_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", company.official_host(F.col("url")).alias("h")).select("page_id", "h.*")


@query("""
WITH c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '短い' WHEN 1 THEN '部品を作る会社です。' || c_name WHEN 2 THEN 'Contact us about 部品' ELSE '部品の求人を出す会社' || c_name END AS cand, CASE WHEN c_custkey % 3 = 0 THEN '今の説明' END AS now, c_name, c_mktsegment FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN cand ELSE now END AS description, '[PRIORITY_DESCRIPTION]' || c_name || chr(10) || '[PRIORITY_TAG]' || c_mktsegment || chr(10) || '[COMPANY_PROFILE_1]' || cand || chr(10) || '[EVIDENCE_1]' || c_name AS told, c_name || chr(10) || chr(10) || cand AS payload FROM c""")
def texts_for_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions taken or not, and the texts that a model is given."""
    k, n = F.col("c_custkey"), F.col("c_name")
    cand = F.when(k % 4 == 0, "短い").when(k % 4 == 1, F.concat(F.lit("部品を作る会社です。"), n)).when(k % 4 == 2, "Contact us about 部品").otherwise(F.concat(F.lit("部品の求人を出す会社"), n))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", cand.alias("cand"), F.when(k % 3 == 0, "今の説明").alias("now"))
    told = company.industry_text(n, F.array(F.lit(" "), F.col("c_mktsegment")), [F.col("cand"), F.lit("")], [n])
    return rows.select("c_custkey", company.accepted_description(F.col("now"), F.col("cand")).alias("description"), told.alias("told"), company.model_text([n, F.lit(" "), F.col("cand")]).alias("payload"))


@query()
def contact_page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and the facts for a model, of every page; SQL has no parser."""
    p = table(spark, sf_dir, "pages").withColumn("f", company.forms("url", "html"))
    home = F.concat(urls.scheme(F.col("url")), F.lit("://"), urls.netloc(F.col("url")))
    return p.select("page_id", "f.*", company.contact_signals(home, F.col("url"), F.col("f")).alias("signals"))

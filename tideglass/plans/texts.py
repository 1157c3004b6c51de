"""Plans over documents, the benchmark and embeddings: noise, paragraphs, terms, audits, fact checks, categories, concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import similarity
from tideglass.functions import text as T
from tideglass.operators import classify, quality, reports
from tideglass.sources.tables import table

from .registry import query

#: Fixed values of these plans: words of the invented texts that stand for business words.
KEYWORDS = ["tion", "able", "ment", "ing"]


@query(r"""
SELECT doc_id, text LIKE '%�%' OR (len(regexp_extract_all(text, '[\x{C0}-\x{FF}]')) >= 3 AND len(regexp_extract_all(text, '[\x{C0}-\x{FF}]')) >= 0.15 * length(text))
 OR (regexp_matches(text, '[ãâÃÂ]') AND len(regexp_extract_all(text, '[\x{C0}-\x{FF}]')) >= 2) AS mojibake FROM documents""")
def mojibake_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.mojibake(F.col("text")).alias("mojibake"))


@query(f"""
WITH p AS (SELECT doc_id, i, trim(para) AS para FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS para, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
s AS (SELECT doc_id, i, para, ({" + ".join(f"contains(para, '{k}')::int" for k in KEYWORDS)}) * 2 + least(length(para)::double / 50.0, 4.0) AS score FROM p WHERE para <> ''),
t AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rn FROM s)
SELECT d.doc_id, coalesce((SELECT string_agg(para, chr(10) ORDER BY rn) FROM t WHERE t.doc_id = d.doc_id AND rn <= 3), '') AS best FROM documents d""")
def paragraph_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.paragraphs_topk(F.col("text"), KEYWORDS).alias("best"))


@query(r"""
SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '' AND (regexp_matches(x, '[0-9]{3}-[0-9]{4}') OR (NOT regexp_matches(x, '(?i)license|cookie') AND length(x) >= 40))), chr(10)), '') AS kept FROM documents""")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.keep_lines(F.col("text"), "(?i)license|cookie", "[0-9]{3}-[0-9]{4}", 40).alias("kept"))


@query(r"""
WITH c AS (SELECT doc_id, regexp_replace(CASE WHEN length(text) <= 160 THEN text ELSE regexp_replace(substr(text, 1, 160), '\s+[^\s]*\z', '') END, '[。．、,.・\s]+\z', '') AS short FROM documents) SELECT doc_id, short FROM c""")
def truncated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.truncated(F.col("text"), 160).alias("short"))


@query(r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM documents),
k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM benchmark)
SELECT term, count(*) AS n, count(DISTINCT doc_id) AS documents, min(doc_id) AS sample FROM w WHERE term NOT IN ('that', 'this', 'with') AND term NOT IN (SELECT term FROM k) GROUP BY 1 HAVING count(*) >= 20""")
def unclassified_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("term")).distinct()
    return reports.terms(docs, F.lower("text"), "doc_id", "[a-z]{4,}", known, ["that", "this", "with"], 20)


@query(r"""
WITH f AS (SELECT doc_id, trim(unnest(string_split_regex(text, '[.,\n]'))) AS fragment FROM documents),
n AS (SELECT doc_id, fragment, count(*) AS n, regexp_matches(fragment, 'tion|ung|ción') AS kept FROM f WHERE length(fragment) BETWEEN 2 AND 60 GROUP BY 1, 2),
k AS (SELECT *, max(kept::int) OVER (PARTITION BY doc_id) AS any_kept FROM n)
SELECT doc_id, fragment, n FROM k WHERE kept OR any_kept = 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(fragment), fragment) <= 5""")
def keyword_fragments_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fragments(table(spark, sf_dir, "documents"), F.col("text"), "doc_id", r"[.,\n]", "tion|ung|ción")


@query(r"""
WITH v AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s, text, source FROM documents),
i AS (SELECT doc_id, 'text' AS field, 'medium' AS severity, 'too_long' AS code FROM v WHERE length(s) >= 600
UNION ALL SELECT doc_id, 'text', 'high', 'html_or_js_noise' FROM v WHERE regexp_matches(s, '(?i)<[a-z/!][^>]*>|function\s*\(|var\s+[a-z_]+\s*=|document\.|window\.')
UNION ALL SELECT doc_id, 'text', 'medium', 'mojibake_replacement_char' FROM v WHERE s LIKE '%�%'
UNION ALL SELECT doc_id, 'source', 'high', 'url_not_http' FROM v) SELECT doc_id, field, severity, code FROM i""")
def text_noise_audit_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.audit(docs, "doc_id", {"text": quality.common, "source": quality.url_checks}, "medium").select("doc_id", "field", "severity", "code")


@query("""
WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 0 END + CASE WHEN c_custkey % 4 = 0 THEN 3 ELSE 0 END + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS score FROM customer)
SELECT c_custkey, score::int AS score, CASE WHEN score >= 8 THEN 'high' WHEN score >= 4 THEN 'medium' WHEN score >= 1 THEN 'low' ELSE 'ok' END AS risk FROM s""")
def audit_risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    codes = F.array_compact(F.array(F.when(k % 3 == 0, "rep_contains_url"), F.when(k % 4 == 0, "address_no_prefecture_or_zip"), F.when(k % 5 == 0, "rep_missing"), F.when(k % 7 == 0, "unheard_of")))
    return table(spark, sf_dir, "customer").select("c_custkey", quality.issue_score(codes).alias("score")).withColumn("risk", quality.risk(F.col("score")))


@query("""
WITH f AS (SELECT item_id, CASE WHEN item_id % 9 = 0 THEN '' ELSE regexp_extract(text, '^[^ ]+ [^ ]+') END AS value FROM benchmark),
e AS (SELECT item_id, value, unnest(range(0, 40)) AS pos FROM f WHERE value <> ''),
m AS (SELECT e.item_id, e.value, pos, d.doc_id, d.text FROM e LEFT JOIN documents d ON d.doc_id = (e.item_id * 20 + pos) % (SELECT count(*) FROM documents) AND d.doc_id % 13 <> 0),
h AS (SELECT item_id, min(CASE WHEN contains(text, value) THEN pos END) AS hit, count(*) FILTER (WHERE doc_id IS NULL) AS missing FROM m GROUP BY 1)
SELECT f.item_id, f.value, CASE WHEN f.value = '' THEN 'blank' WHEN f.item_id % 10 = 1 THEN 'unknown_no_evidence' WHEN hit IS NOT NULL THEN 'verified' WHEN missing > 0 THEN 'fetch_failed' ELSE 'not_found' END AS verdict,
 CASE WHEN f.value <> '' AND f.item_id % 10 <> 1 AND hit IS NOT NULL THEN 'd' || ((f.item_id * 20 + hit) % (SELECT count(*) FROM documents)) END AS evidence_url FROM f LEFT JOIN h USING (item_id)""")
def fact_check_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("item_id"), table(spark, sf_dir, "documents").count()
    urls = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda p: F.concat(F.lit("d"), ((k * 20 + p) % n).cast("string")))
    facts = table(spark, sf_dir, "benchmark").select("item_id", F.when(k % 9 == 0, "").otherwise(F.regexp_extract("text", "^[^ ]+ [^ ]+", 0)).alias("value"), F.when(k % 10 == 1, F.array().cast("array<string>")).otherwise(urls).alias("evidence"))
    pages = table(spark, sf_dir, "documents").where("doc_id % 13 <> 0").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("url"), "text")
    return quality.verdicts(facts, pages, ["item_id"], F.contains(F.col("_text"), F.col("value"))).select("item_id", "value", "verdict", "evidence_url")


CATEGORIES = [("making", "tion works", ["tion"], ["ing"]), ("making", "able works", ["able", "ably"], ["ble"]), ("trade", "ung house", ["ung"], ["keit", "lich"]), ("trade", "ment house", ["ment"], ["eau"]), ("care", "ción home", ["ción"], ["ado"])]


def _categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "top string, sub string, aliases array<string>, keywords array<string>")


def _category_sql() -> str:
    has = lambda w, t: f"contains({t}, '{w}')::int"
    parts = []
    for top, sub, aliases, words in CATEGORIES:
        one = lambda t, k: f"(({' + '.join(has(a, t) for a in aliases)}) * 4 + {' + '.join(has(w, t) for w in words)}) * {k}"  # noqa: E731, B023
        parts.append(f"SELECT doc_id, '{top}' AS top, '{sub}' AS sub, ({one('body', 3)} + {one('head', 4)})::int AS score FROM b")
    return "WITH b AS (SELECT doc_id, lower(text) AS body, lower(coalesce(source, '')) AS head FROM documents), s AS (" + " UNION ALL ".join(parts) + ")"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("body"), F.lower(F.coalesce("source", F.lit(""))).alias("head"))
    return classify.block_scores(docs, "doc_id", {"description": F.col("body"), "tag": F.col("head")}, _categories(spark))


@query(_category_sql() + " SELECT doc_id, top, sub, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, length(sub) DESC, sub, top) = 1")
def category_theta_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.ranked(_scored(spark, sf_dir), "doc_id", 1)


@query(_category_sql() + " SELECT doc_id, top, sub, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, length(sub) DESC, sub, top) <= 3")
def topk_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.ranked(_scored(spark, sf_dir), "doc_id", 3)


_CENTROIDS = """
WITH e AS (SELECT label, unnest(embedding)::double AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
m AS (SELECT label, pos, avg(x) AS x FROM e GROUP BY 1, 2), c AS (SELECT label, pos, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m)"""


@query(_CENTROIDS + " SELECT label, pos::int AS pos, round(x, 5) AS x FROM c")
def concept_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = similarity.centroids(table(spark, sf_dir, "embeddings").select("label", "embedding"), "label", "embedding")
    return c.select("label", F.posexplode("vector").alias("pos", "x")).select("label", "pos", F.round("x", 5).alias("x"))


@query(_CENTROIDS + """,
v AS (SELECT vec_id, unnest(embedding)::double AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings), u AS (SELECT vec_id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM v),
s AS (SELECT vec_id, label, sum(u.x * c.x) AS sim FROM u JOIN c USING (pos) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS rn FROM s)
SELECT a.vec_id, a.label AS top1, round(a.sim, 4) AS sim1, b.label AS top2, CASE WHEN a.sim >= 0.82 AND a.sim - b.sim >= 0.05 THEN 'auto' ELSE 'hold' END AS decision FROM r a JOIN r b ON a.vec_id = b.vec_id AND a.rn = 1 AND b.rn = 2""")
def concept_topk_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    c = similarity.centroids(e.select("label", "embedding"), "label", "embedding")
    return similarity.nearest(e.select("vec_id", "embedding"), "vec_id", "embedding", c, "label").select("vec_id", "top1", F.round("sim1", 4).alias("sim1"), "top2", "decision")


@query("""
WITH t AS (SELECT item_id, regexp_replace(lower(text), '[^a-z]', '', 'g') AS s FROM benchmark),
g AS (SELECT item_id, unnest(list_concat(list_transform(range(1, length(s)), lambda i: substr(s, i, 2)), list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3)))) AS g FROM t),
n AS (SELECT item_id, (('0x' || substr(md5(g), 1, 8))::bigint % 384)::bigint AS slot, count(*) AS c FROM g GROUP BY 1, 2)
SELECT item_id, slot, round(c / sqrt(sum(c * c) OVER (PARTITION BY item_id)), 6) AS weight FROM n""")
def ngram_hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_replace(F.lower("text"), "[^a-z]", "").alias("s"))
    return similarity.gram_slots(t, F.col("s"), "item_id").withColumn("weight", F.round("weight", 6))

"""Fact checks over pages made of the customers' rows: every kind of value, true and false, with missing and absent evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.operators import facts
from tideglass.sources.tables import table

from .registry import query

#: One page a customer, in Spark's and DuckDB's common SQL; each ninth is missing.
_PAGE = (
    "concat('会社名 ', c_name, ' 本社 〒', lpad(cast(c_custkey % 1000 as varchar(9)), 3, '0'), '-', lpad(cast(c_custkey * 7 % 10000 as varchar(9)), 4, '0'), ' 東京都', cast(c_nationkey as varchar(9)), '丁目 電話 03-',"
    " lpad(cast(c_custkey * 13 % 10000 as varchar(9)), 4, '0'), '-', lpad(cast(c_custkey * 17 % 10000 as varchar(9)), 4, '0'), case when c_custkey % 2 = 0 then ' 代表取締役 ' else ' 担当 ' end, c_mktsegment, ' 太郎',"
    " ' 設立 ', cast(1950 + c_custkey % 70 as varchar(9)), '年 決算 ', cast(c_custkey % 12 + 1 as varchar(9)), '月 資本金 ', cast(c_custkey * 100 as varchar(19)), '円')"
)
#: Of each kind the value told of customer k: its own, or another's where k leaves 2 by 3; blank or unreadable where k leaves 0 by 11.
_TOLD = "case when c_custkey % 3 = 2 then c_custkey + 5 else c_custkey end"
_VALUES = {
    "phone": f"concat('03', lpad(cast(({_TOLD}) * 13 % 10000 as varchar(9)), 4, '0'), lpad(cast(({_TOLD}) * 17 % 10000 as varchar(9)), 4, '0'))",
    "address": f"concat('〒 ', lpad(cast(({_TOLD}) % 1000 as varchar(9)), 3, '0'), '-', lpad(cast(({_TOLD}) * 7 % 10000 as varchar(9)), 4, '0'))",
    "person": "concat(c_mktsegment, case when c_custkey % 5 = 0 then ' 花子' else ' 太郎' end)",
    "text": f"concat('設立 ', cast(1950 + ({_TOLD}) % 70 as varchar(9)))",
    "amount": f"concat(cast(({_TOLD}) * 100 as varchar(19)), '円')",
    "founded": f"concat('西暦', cast(1950 + ({_TOLD}) % 70 as varchar(9)))",
    "fiscal_month": f"cast(({_TOLD}) % 14 as varchar(9))",
}
_PREDICATES = {"phone": facts.phone, "address": facts.address, "person": facts.person, "text": facts.contained, "amount": facts.amount, "founded": facts.founded, "fiscal_month": facts.fiscal_month}

_HIT = {
    "phone": ("contains(regexp_replace(p, '[^0-9]', '', 'g'), regexp_replace(v, '[^0-9]', '', 'g'))", "'digits_found'"),
    "address": ("contains(regexp_replace(p, '[-〒 ]', '', 'g'), regexp_replace(v, '[-〒 ]', '', 'g'))", "'addr_key_found'"),
    "person": (
        "(regexp_matches(substr(p, greatest(instr(p, s) - 60, 1), instr(p, s) - greatest(instr(p, s) - 60, 1) + length(s) + 60), '代表|取締役|社長|会長|CEO') AND contains(p, s)) OR (contains(p, s) AND contains(p, f))"
        " OR (contains(p, f) AND regexp_matches(substr(p, greatest(instr(p, f) - 60, 1), instr(p, f) - greatest(instr(p, f) - 60, 1) + length(f) + 60), '代表|取締役|社長|会長|CEO'))",
        "CASE WHEN k % 2 = 0 THEN 'token_found_near_rep_keyword' ELSE 'all_tokens_found' END",
    ),
    "text": ("contains(p, v)", "'text_substring_found'"),
    "amount": ("contains(regexp_replace(p, '[^0-9]', '', 'g'), regexp_replace(v, '[^0-9]', '', 'g'))", "'amount_digits_found'"),
    "founded": ("contains(p, y) AND regexp_matches(substr(p, greatest(instr(p, y) - 80, 1), instr(p, y) - greatest(instr(p, y) - 80, 1) + 84), '設立|創業|創立')", "'year_found_near_founded_keyword'"),
    "fiscal_month": ("contains(p, m) AND regexp_matches(substr(p, greatest(instr(p, m) - 80, 1), instr(p, m) - greatest(instr(p, m) - 80, 1) + length(m) + 80), '決算|期|事業年度|会計年度|年度')", "'month_found_near_fiscal_keyword'"),
}
_EARLY = {
    "phone": ("length(regexp_replace(v, '[^0-9]', '', 'g')) < 9", "not_found", "phone_value_too_short"),
    "amount": ("length(regexp_replace(v, '[^0-9]', '', 'g')) < 4", "unknown_no_evidence", "amount_digits_too_short"),
    "founded": ("y = ''", "unknown_no_evidence", "founded_year_not_parseable"),
    "fiscal_month": ("d = '' OR d::int NOT BETWEEN 1 AND 12", "unknown_no_evidence", "fiscal_month_out_of_range"),
}


def _sql(kind: str) -> str:
    hit, why = _HIT[kind]
    cond, verdict, reason = _EARLY.get(kind, ("false", "", ""))
    return f"""
SELECT k, '{kind}' AS kind, CASE WHEN v = '' THEN 'blank' WHEN {cond} THEN '{verdict}' WHEN k % 13 = 0 THEN 'unknown_no_evidence' WHEN coalesce(h, false) THEN 'verified' WHEN p IS NULL THEN 'fetch_failed' ELSE 'not_found' END AS verdict,
 CASE WHEN v = '' THEN 'empty' WHEN {cond} THEN '{reason}' WHEN k % 13 = 0 THEN 'no_evidence_urls' WHEN coalesce(h, false) THEN {why} WHEN p IS NULL THEN 'all_failed_or_no_match_on_ok_pages' ELSE 'not_found_in_evidence' END AS reason,
 CASE WHEN v <> '' AND NOT ({cond}) AND k % 13 <> 0 AND coalesce(h, false) THEN 'c' || k END AS evidence_url
FROM (SELECT *, {hit} AS h FROM (SELECT *, string_split(v, ' ')[1] AS s, string_split(v, ' ')[-1] AS f, regexp_extract(v, '(19[0-9]{{2}}|20[0-9]{{2}})', 1) AS y, regexp_extract(v, '([0-9]{{1,2}})', 1) AS d, ltrim(regexp_extract(v, '([0-9]{{1,2}})', 1), '0') || '月' AS m
 FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE {_VALUES[kind]} END AS v, CASE WHEN c_custkey % 9 <> 0 THEN {_PAGE} END AS p FROM customer)))"""


@query(" UNION ALL ".join(_sql(k) for k in _VALUES))
def fact_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven kinds of facts of every customer against its page."""
    rows = table(spark, sf_dir, "customer")
    pages = rows.where("c_custkey % 9 <> 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("url"), F.expr(_PAGE).alias("text"))
    out = None
    for kind, value in _VALUES.items():
        evidence = F.when(F.col("c_custkey") % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))))
        told = rows.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.expr(value)).alias("value"), evidence.alias("evidence"))
        part = facts.checked(told, pages, ["k"], _PREDICATES[kind]()).select("k", F.lit(kind).alias("kind"), "verdict", "reason", "evidence_url")
        out = part if out is None else out.union(part)
    return out


@query("""
WITH f AS (SELECT doc_id AS k, CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 8 = 0 THEN 'see http://x.jp/ for more of all this' WHEN doc_id % 7 = 0 THEN 'short' ELSE 'a description of twenty characters and more' END AS v FROM documents),
n AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents),
s AS (SELECT f.k, v, substr(a.t, 3, 30) AS snippet, CASE WHEN f.k % 5 = 0 THEN b.t ELSE a.t END AS page FROM f JOIN n a ON a.doc_id = f.k LEFT JOIN n b ON b.doc_id = f.k + 1)
SELECT k, CASE WHEN v = '' THEN 'blank' WHEN k % 8 = 0 THEN 'not_found' WHEN k % 7 = 0 OR k % 11 = 0 OR trim(snippet) = '' THEN 'unknown_no_evidence' WHEN contains(page, trim(snippet)) THEN 'verified' ELSE 'not_found' END AS verdict,
 CASE WHEN v = '' THEN 'empty' WHEN k % 8 = 0 THEN 'description_contains_forbidden_terms' WHEN k % 7 = 0 THEN 'description_too_short' WHEN k % 11 = 0 THEN 'no_description_evidence' WHEN trim(snippet) = '' THEN 'description_evidence_missing_or_empty'
  WHEN contains(page, trim(snippet)) THEN 'description_evidence_snippet_found' ELSE 'description_evidence_snippet_not_found' END AS reason FROM s""")
def fact_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions with a snippet as evidence, of every document: on its own page, or on the next document's."""
    docs, k = table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id")
    value = F.when(k % 9 == 0, "").when(k % 8 == 0, "see http://x.jp/ for more of all this").when(k % 7 == 0, "short").otherwise("a description of twenty characters and more")
    item = F.struct(F.concat(F.lit("d"), (k + F.when(k % 5 == 0, 1).otherwise(0)).cast("string")).alias("url"), F.substring(facts.normal(F.col("text")), 3, 30).alias("snippet"))
    told = docs.select(k.alias("k"), value.alias("value"), F.when(k % 11 == 0, F.array().cast("array<struct<url: string, snippet: string>>")).otherwise(F.array(item)).alias("evidence"))
    pages = docs.select(F.concat(F.lit("d"), k.cast("string")).alias("url"), "text")
    return facts.description(told, pages, ["k"]).select("k", "verdict", "reason")

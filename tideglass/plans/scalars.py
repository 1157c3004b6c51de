"""Plans of phones, addresses, names, amounts, months and years over literal rows and derived digits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions import address as A
from tideglass.functions import names, numbers, phone
from tideglass.sources.tables import table

from .registry import query


def _rows(spark: SparkSession, values: list[str | None]) -> DataFrame:
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v string")


def _literal(values: list[str | None]) -> str:
    cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join(f"({i}::bigint, {cell(v)}::varchar)" for i, v in enumerate(values)) + ") AS t(id, v)"


PHONES = ["03-1234-5678", "電話：0120-444-555", "0312345678", "+81 3 1234 5678", "0901234567８", "０６６１２３４５６７", "0570012345", "052‐123‐4567 内線 12", "12345", None, "", "tel 0466(22)3333", "8131234567", "09012345678 ext: 9"]

_PHONE_SQL = r"""
n AS (SELECT id, v, regexp_replace(regexp_replace(translate(v, '０１２３４５６７８９：（）＋－　', '0123456789:()+- '), '(?i)(内線|ext|extension)\s*[:：]?\s*[0-9]+$', ''), '[‐―－ー–—]+', '-', 'g') AS s FROM src),
d AS (SELECT *, regexp_extract(s, '(0[0-9]{1,4})[^0-9]+?([0-9]{1,4})[^0-9]+?([0-9]{3,4})', ['a', 'b', 'c']) AS p, regexp_replace(s, '[^0-9]', '', 'g') AS raw FROM n),
e AS (SELECT *, CASE WHEN raw LIKE '81%' AND length(raw) >= 10 THEN '0' || substr(raw, 3) ELSE raw END AS g FROM d),
phones AS (SELECT id, v, CASE WHEN p.a <> '' THEN p.a || '-' || p.b || '-' || p.c WHEN g NOT LIKE '0%' THEN NULL
 WHEN length(g) = 10 AND regexp_matches(g, '^0[36]') THEN substr(g, 1, 2) || '-' || substr(g, 3, 4) || '-' || substr(g, 7) WHEN length(g) = 10 AND regexp_matches(g, '^(0120|0570)') THEN substr(g, 1, 4) || '-' || substr(g, 5, 3) || '-' || substr(g, 8)
 WHEN length(g) = 10 THEN substr(g, 1, 3) || '-' || substr(g, 4, 3) || '-' || substr(g, 7) WHEN length(g) = 11 THEN substr(g, 1, 3) || '-' || substr(g, 4, 4) || '-' || substr(g, 8) END AS phone FROM e)"""


@query(f"WITH src AS (SELECT id, v FROM {_literal(PHONES)}), {_PHONE_SQL} SELECT id, v, phone FROM phones")
def phone_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, PHONES).withColumn("phone", phone.phone(F.col("v")))


@query(rf"""
WITH src AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN '0' || (300000000 + c_custkey * 7)::varchar WHEN 1 THEN '03-' || (1000 + c_custkey % 9000) || '-' || (1000 + c_custkey % 8999) WHEN 2 THEN '81' || (3 * 100000000 + c_custkey)::varchar ELSE (c_custkey * 31)::varchar END AS v FROM customer), {_PHONE_SQL}
SELECT id, v, phone FROM phones""")
def phone_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.col("c_custkey"), lambda c: c.cast("string")
    v = F.when(k % 4 == 0, F.concat(F.lit("0"), text(300000000 + k * 7))).when(k % 4 == 1, F.concat_ws("-", F.lit("03"), text(1000 + k % 9000), text(1000 + k % 8999))).when(k % 4 == 2, F.concat(F.lit("81"), text(300000000 + k))).otherwise(text(k * 31))
    return table(spark, sf_dir, "customer").select(k.alias("id"), v.alias("v")).withColumn("phone", phone.phone(F.col("v")))


_TAGGED = [("TELHREF", 6.0), ("FOOTER", 1.5), ("TEXT", 0.0), ("TABLE][BRANCH", 2.5), ("LABEL][HQ", 8.0), ("FAX", 0.0), ("TABLE][RECRUIT", -1.0)]


@query("""
WITH t AS (SELECT * FROM (VALUES (0, 'TELHREF', 6.0, false, true), (1, 'FOOTER', 1.5, true, false), (2, 'TEXT', 0.0, false, false), (3, 'TABLE][BRANCH', 2.5, false, true), (4, 'LABEL][HQ', 8.0, false, true), (5, 'FAX', 0.0, false, false), (6, 'TABLE][RECRUIT', -1.0, false, true)) v(t, tag, score, margin, strong)),
c AS (SELECT s_suppkey, i, ((s_suppkey * 3 + i * 2) % 7)::int AS t, CASE WHEN (s_suppkey + i) % 6 = 0 THEN '0120-' || (100 + i) || '-' || (100 + s_suppkey % 800) ELSE '03-' || (1000 + s_suppkey % 9000) || '-' || (1000 + i) END AS phone
      FROM supplier, (SELECT unnest(range(0, 3)) AS i)),
j AS (SELECT *, max(strong::int) OVER (PARTITION BY s_suppkey) AS any_strong FROM c JOIN t USING (t) ),
k AS (SELECT *, score - CASE WHEN phone LIKE '0120%' THEN 4 ELSE 0 END - abs(length(phone) - 12) * 0.2 AS s FROM j WHERE tag <> 'FAX' AND NOT (any_strong = 1 AND margin))
SELECT s_suppkey, (SELECT phone FROM k WHERE k.s_suppkey = x.s_suppkey ORDER BY s DESC, phone LIKE '0120%', i LIMIT 1) AS phone FROM supplier x""")
def phone_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    tag = F.array(*[F.lit(t) for t, _ in _TAGGED])

    def one(i: int):
        free = F.concat_ws("-", F.lit("0120"), F.lit(str(100 + i)), (100 + k % 800).cast("string"))
        own = F.concat_ws("-", F.lit("03"), (1000 + k % 9000).cast("string"), F.lit(str(1000 + i)))
        return F.concat(F.lit("["), F.get(tag, ((k * 3 + i * 2) % 7).cast("int")), F.lit("]"), F.when((k + i) % 6 == 0, free).otherwise(own))

    return table(spark, sf_dir, "supplier").select("s_suppkey", phone.best(F.array(*[one(i) for i in range(3)])).alias("phone"))


AMOUNTS = ["6億6700万円", "1,000万円", "約３億円", "▲500百万円", "2兆円", "1.5億", "3000千円", "12,345円", "なし", "", None, "△1億2000万円以上", "0円"]


@query(rf"""
WITH n AS (SELECT id, v, regexp_replace(translate(v, '０１２３４５６７８９，．', '0123456789,.'), '\s+', '', 'g') AS s FROM {_literal(AMOUNTS)}),
c AS (SELECT id, v, regexp_matches(s, '^[▲△-]') AS loss, regexp_replace(regexp_replace(s, '^[▲△-]+', ''), '[(),（）]|約|およそ|程度|前後|強|弱|ほど|規模|以上|未満|超', '', 'g') AS s FROM n),
a AS (SELECT *, list_sum(list_transform(regexp_extract_all(s, '([0-9]+(?:\.[0-9]+)?)兆', 1), lambda x: x::double * 1e12)) AS t, list_sum(list_transform(regexp_extract_all(s, '([0-9]+(?:\.[0-9]+)?)億', 1), lambda x: x::double * 1e8)) AS o,
 list_sum(list_transform(regexp_extract_all(s, '([0-9]+(?:\.[0-9]+)?)万', 1), lambda x: x::double * 1e4)) AS m, list_sum(list_transform(regexp_extract_all(s, '([0-9]+(?:\.[0-9]+)?)百万円', 1), lambda x: x::double * 1e6)) AS h,
 list_sum(list_transform(regexp_extract_all(s, '([0-9]+(?:\.[0-9]+)?)千円', 1), lambda x: x::double * 1e3)) AS k FROM c),
b AS (SELECT *, coalesce(t, 0) + coalesce(o, 0) + coalesce(m, 0) + coalesce(h, 0) + coalesce(k, 0) AS total FROM a),
f AS (SELECT *, CASE WHEN total > 0 THEN total ELSE try_cast(nullif(regexp_extract(s, '[0-9]+(?:\.[0-9]+)?'), '') AS double) END AS amount FROM b)
SELECT id, v, (CASE WHEN amount > 0 THEN CASE WHEN loss THEN -round(amount) ELSE round(amount) END END)::bigint AS yen FROM f""")
def amount_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, AMOUNTS).withColumn("yen", numbers.amount_yen(F.col("v")).cast("long"))


MONTHS = ["3月", "12月期", "３月末", "Q1", "q4", "2024", "決算 9", "なし", "", None, "0月", "13月"]


@query(r"""
WITH n AS (SELECT id, v, translate(trim(translate(v, '０１２３４５６７８９', '0123456789')), '期末', '月月') AS s FROM """ + _literal(MONTHS) + r"""),
m AS (SELECT id, v, CASE WHEN regexp_matches(s, '^[Qq][1-4]$') THEN substr(s, 2)::int * 3 WHEN regexp_extract(s, '(1[0-2]|0?[1-9])\s*月', 1) <> '' THEN regexp_extract(s, '(1[0-2]|0?[1-9])\s*月', 1)::int
 WHEN regexp_extract(s, '(1[0-2]|0?[1-9])', 1) <> '' THEN regexp_extract(s, '(1[0-2]|0?[1-9])', 1)::int END AS n FROM n) SELECT id, v, coalesce(n || '月', '') AS month FROM m""")
def fiscal_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, MONTHS).withColumn("month", numbers.fiscal_month(F.col("v")))


YEARS = ["昭和55年", "平成元年4月", "令和5年", "S48", "1998年設立", "２００３年", "創業 H12", "明治45年", "不詳", "", None, "大正15年", "西暦2010"]


@query(r"""
WITH n AS (SELECT id, v, translate(v, '０１２３４５６７８９', '0123456789') AS s FROM """ + _literal(YEARS) + r"""),
e AS (SELECT *, regexp_extract(s, '(明治|大正|昭和|平成|令和|[MTSHRmtshr])\s*([0-9]+|元)', ['era', 'y']) AS x FROM n),
y AS (SELECT *, CASE WHEN x.y = '元' THEN 1 WHEN x.y <> '' THEN substr(x.y, 1, 4)::int END AS k, CASE upper(x.era) WHEN '明治' THEN 1868 WHEN 'M' THEN 1868 WHEN '大正' THEN 1912 WHEN 'T' THEN 1912 WHEN '昭和' THEN 1926 WHEN 'S' THEN 1926 WHEN '平成' THEN 1989 WHEN 'H' THEN 1989 WHEN '令和' THEN 2019 WHEN 'R' THEN 2019 END AS base FROM e)
SELECT id, v, (CASE WHEN k BETWEEN 1 AND 300 THEN base + k - 1 END)::int AS era_year, coalesce(CASE WHEN k BETWEEN 1 AND 300 THEN base + k - 1 END, try_cast(nullif(regexp_extract(s, '([12][0-9]{3})', 1), '') AS int))::int AS founded FROM y""")
def founded_and_era_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, YEARS).withColumns({"era_year": numbers.era_year(F.col("v")).cast("int"), "founded": numbers.founded_year(F.col("v")).cast("int")})


STAFF = ["120名", "約1,200名", "10〜50名", "10名-20名", "35人", "300", "なし", "", None, "従業員 45 名（連結）"]


@query(r"""
WITH n AS (SELECT id, v, regexp_replace(trim(translate(v, '０１２３４５６７８９（）', '0123456789()')), '[,，]', '', 'g') AS s FROM """ + _literal(STAFF) + r"""),
m AS (SELECT *, regexp_extract(s, '([0-9]{1,6})\s*(?:名|人)?\s*[~〜～\-－―–]\s*([0-9]{1,6})\s*(?:名|人)', ['a', 'b']) AS r, regexp_extract(s, '(約)?\s*([0-9]{1,6})\s*(?:名|人)', ['p', 'n']) AS q, regexp_extract(s, '^([0-9]{1,6})$', 1) AS o FROM n)
SELECT id, v, CASE WHEN v IS NULL THEN '' WHEN r.a <> '' THEN r.a || '-' || r.b || '名' WHEN q.n <> '' THEN q.p || q.n || '名' WHEN o <> '' THEN o || '名' ELSE '' END AS employees FROM m""")
def employee_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, STAFF).withColumn("employees", numbers.employees(F.col("v")))


ADDRESSES = ["〒100-0001 東京都千代田区千代田1-1", "大阪府大阪市北区梅田３丁目１番", "北海道", "〒460-0008 愛知県", "問い合わせ先", "", None, "神奈川県横浜市西区みなとみらい2-2-1 ランドマークタワー", "1000002 東京都"]


@query(r"""
WITH n AS (SELECT id, v, translate(v, '０１２３４５６７８９　', '0123456789 ') AS s FROM """ + _literal(ADDRESSES) + r"""),
p AS (SELECT id, v, s, nullif(regexp_extract(v, '(""" + "|".join(A.PREFECTURES) + r""")', 1), '') AS prefecture, regexp_extract(s, '(?:^|[^0-9])([0-9]{3})[-‐―－ー−]?([0-9]{4})(?:[^0-9]|$)', ['a', 'b']) AS z FROM n)
SELECT id, v, prefecture, CASE WHEN z.a <> '' THEN z.a || '-' || z.b END AS postal_code, coalesce(list_contains([""" + ", ".join(f"'{p}'" for p in A.PREFECTURES) + r"""], regexp_replace(regexp_replace(s, '〒?\s*([0-9]{3})[-‐―－ー−]?([0-9]{4})', '', 'g'), '\s+', '', 'g')), false) AS only_prefecture,
 regexp_replace(regexp_replace(lower(s), '[‐‑–—―−－ｰ]', '-', 'g'), '[\s〒()（）\[\]「」,、]', '', 'g') AS address_key FROM p""")
def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    return _rows(spark, ADDRESSES).withColumns({"prefecture": A.prefecture(v), "postal_code": A.postal_code(v), "only_prefecture": A.prefecture_only(v), "address_key": A.key(v)})


@query()
def address_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rule chain in one Arrow function: held against expected values in the tests."""
    v = F.col("v")
    return _rows(spark, ADDRESSES).withColumns({"address": A.address(v), "verifiable": A.verifiable(v), "looks_like": A.looks_like(v), "city": A.city(v)})


@query()
def address_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    cands = F.array(F.lit("[FOOTER]大阪府大阪市北区1-1"), F.lit("[TABLE][HQ]〒100-0001 東京都千代田区千代田1-1"), F.concat(F.lit("[TEXT]"), F.col("v")))
    rows = _rows(spark, ADDRESSES)
    return rows.select("id", A.best_candidate(cands, F.lit(None).cast("string")).alias("free"), A.best_candidate(cands, F.lit("大阪府大阪市")).alias("expected"), A.best_segment(F.concat_ws(" ", F.lit("大阪支店 大阪府大阪市北区1-1"), F.lit("本社 東京都港区2-2"))).alias("segment"))


PEOPLE = ["代表取締役社長 山田 太郎", "[TABLE]代表者 鈴木一郎（すずき）", "お問い合わせ", "田中", "株式会社テスト", "John Smith", "サトウ", "03-1234-5678", "", None, "会長 佐藤 花子 氏"]


@query()
def rep_name_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, PEOPLE).withColumn("name", names.person(F.col("v")))


NUMERALS = ["二十三", "百五", "千二百", "三万五千", "一億二千万", "12万", "二〇二四", "十", "四丁目", "", None]


@query()
def kanji_numeral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, NUMERALS).withColumn("value", numbers.kanji_numeral(F.col("v")))


@query()
def name_match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's name against its brand and type; the ratio is Python's difflib, which SQL has not."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.array("p_brand", "p_type", F.concat(F.lit("株式会社"), "p_name")).alias("c"))
    return p.select("p_partkey", names.name_ratio("p_name", "c").alias("m")).select("p_partkey", "m.*")


COMPANIES = ["株式会社テスト商事", "（株）テスト・商事", "ABC Works", "東京都", "市役所", "〇〇大学", "テスト支店", "あ", "", None]


@query(r"""
SELECT id, v, regexp_replace(regexp_replace(lower(translate(v, '（）ＡＢＣ', '()ABC')), '株式会社|有限会社|合同会社|合名会社|合資会社|\(株\)|\(有\)|㈱|㈲|一般社団法人|一般財団法人|公益社団法人|公益財団法人|社会福祉法人|医療法人|学校法人', '', 'g'), '[\s\-‐―－ー–—|｜/:：,，.。・･…()（）\[\]【】<>＜＞]', '', 'g') AS key FROM """ + _literal(COMPANIES))
def company_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, COMPANIES).withColumn("key", names.company_key(F.col("v")))


_CONFLICT = """
WITH f AS (SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN '東京都' WHEN 2 THEN '〒100-0001 東京都千代田区1-1' ELSE '千代田区1-1' END AS listed,
 CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '〒100-0001 東京都千代田区千代田1-1-1' WHEN 2 THEN '〒530-0001 大阪府大阪市北区1-1-1' WHEN 3 THEN '千代田区2' ELSE '大阪府' END AS found,
 (s_suppkey % 3 <> 0) AS strong, CASE s_suppkey % 3 WHEN 0 THEN 'ai' WHEN 1 THEN 'rule' ELSE 'none' END AS src, s_suppkey % 2 = 0 AS sure, s_suppkey % 7 < 3 AS head, s_suppkey % 6 < 3 AS same_page, s_suppkey % 11 <> 0 AS profile FROM supplier),
g AS (SELECT *, CASE WHEN listed LIKE '%東京都%' THEN '東京都' END AS pa, CASE WHEN found LIKE '%東京都%' THEN '東京都' WHEN found LIKE '%大阪府%' THEN '大阪府' END AS pb, listed LIKE '%〒%' AS za, found LIKE '%〒%' AS zb, regexp_matches(listed, '[市区町村郡]') AS ca, regexp_matches(found, '[市区町村郡]') AS cb, src = 'rule' AS own FROM f),
h AS (SELECT *, coalesce(pa <> pb, false) AS differs FROM g),
o AS (SELECT *, found <> '' AND CASE WHEN differs THEN (strong AND src = 'ai' AND sure AND head AND same_page AND profile) OR ((NOT za OR NOT ca) AND strong AND profile AND zb AND cb AND (same_page OR head OR own OR (src = 'ai' AND sure)))
  OR (strong AND own AND profile AND zb AND cb AND (same_page OR head OR length(found) >= length(listed)))
  ELSE (strong OR own) AND (listed = '' OR length(found) > length(listed) OR (zb AND NOT za) OR (cb AND NOT ca)) AND NOT (pa IS NOT NULL AND pb IS NULL AND listed <> '') END AS overwrite FROM h)
SELECT k AS s_suppkey, overwrite, CASE WHEN differs AND found <> '' THEN CASE WHEN overwrite THEN 'pref_mismatch_overwritten' ELSE 'pref_mismatch' END ELSE '' END AS level,
 CASE WHEN differs AND found <> '' AND NOT overwrite THEN 'pref_mismatch_no_strong_hq_evidence' ELSE '' END AS reason, CASE WHEN differs AND found <> '' AND NOT overwrite THEN 'review' ELSE 'done' END AS status FROM o"""


@query(_CONFLICT)
def address_conflict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideglass.operators.decide import address_decision

    k = F.col("s_suppkey")
    listed = F.when(k % 4 == 0, "").when(k % 4 == 1, "東京都").when(k % 4 == 2, "〒100-0001 東京都千代田区1-1").otherwise("千代田区1-1")
    found = F.when(k % 5 == 0, "").when(k % 5 == 1, "〒100-0001 東京都千代田区千代田1-1-1").when(k % 5 == 2, "〒530-0001 大阪府大阪市北区1-1-1").when(k % 5 == 3, "千代田区2").otherwise("大阪府")
    source = F.when(k % 3 == 0, "ai").when(k % 3 == 1, "rule").otherwise("none")
    url = F.when(k % 11 == 0, "https://x.jp/contact").otherwise("https://x.jp/company")
    d = address_decision(listed, found, F.when(k % 3 != 0, 1).otherwise(0), F.lit(5.0), source, F.when(k % 2 == 0, 0.9).otherwise(0.5), F.when(k % 7 < 3, "本社所在地").otherwise(""), url, F.when(k % 6 < 3, url).otherwise("https://x.jp/other"), F.lit("03-1234-5678"), F.lit("done"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", d.alias("d")).select("s_suppkey", "d.*")


AUDITED = [("代表取締役", "東京都千代田区1-1"), ("山田太郎", "03-1234-5678"), (None, ""), ("株式会社テスト 03-1234-5678", "社長 田中"), ("John Smith Jones", "https://x.jp"), ("佐藤", "〒100-0001 東京都千代田区千代田1-1")]


@query("""
SELECT * FROM (VALUES (0::bigint, 3, 'low'), (1, 4, 'medium'), (2, 2, 'low'), (3, 4 + 4 + 3 + 2 + 3 + 3 + 2 + 2, 'high'), (4, 1 + 4 + 3, 'high'), (5, 0, 'ok')) AS t(id, score, risk)""")
def wide_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideglass.operators import quality

    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(AUDITED)], "id long, rep string, address string")
    codes = F.concat(quality.person_issues(F.col("rep")), quality.address_issues(F.col("address")))
    return rows.select("id", quality.issue_score(codes).alias("score")).withColumn("risk", quality.risk(F.col("score")))


ALIAS_ROWS = [(1, "塗装", "071", "D", "build"), (2, "とそう", "071", "E", "build"), (3, "塗装 ", "072", "D", "build"), (4, "", "072", "D", None), (5, "x", "999", "D", None), (6, "販売", "511", "", "build"), (7, "y", "", "D", None)]
LEVELS = [("D", "00", "000", "0000"), ("D", "07", "000", "0000"), ("D", "07", "071", "0000"), ("D", "07", "072", "0000"), ("I", "51", "000", "0000"), ("I", "51", "511", "0000"), ("I", "51", "511", "5111")]


@query("""
SELECT * FROM (VALUES (1::bigint, 'alias_conflict'), (2, 'major_mismatch'), (3, 'alias_conflict'), (4, 'empty_alias'), (5, 'unknown_code'), (6, 'no_allowed_codes'), (6, 'domain_outlier'), (7, 'empty_code')) AS t(line, problem)""")
def alias_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideglass.operators import taxonomy

    rows = spark.createDataFrame(ALIAS_ROWS, "line long, alias string, code string, allowed string, domain string")
    levels = spark.createDataFrame(LEVELS, "major string, middle string, minor string, detail string")
    return taxonomy.alias_problems(rows, taxonomy.minor_to_major(levels)).select("line", "problem")


@query()
def category_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideglass.operators import taxonomy

    rows = spark.createDataFrame([("建設", "塗装・防水工事業"), ("建設", "その他建設業"), ("IT", "システム開発（受託）サービス"), ("IT", ""), ("建設", "塗装・防水工事業")], "top string, sub string")
    return taxonomy.categories(rows)


@query()
def business_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideglass.operators import taxonomy

    return _rows(spark, ['["建設", "建 設", "https://x"]', "物流、倉庫/物流", "", None]).select("id", taxonomy.clean_tags(taxonomy.tag_values(F.col("v"))).alias("tags"))

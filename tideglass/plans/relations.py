"""Plans of keyed operations and reports over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.operators import decide, match, quality, reports, state
from tideglass.sources.tables import formula_guarded, table

from .registry import query


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return match.first_by(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("""
WITH k AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_nationkey % 5 = 0 THEN '' ELSE 'n' || s_nationkey END AS homepage FROM supplier)
SELECT s_suppkey, s_nationkey, homepage FROM k
QUALIFY row_number() OVER (PARTITION BY CASE WHEN homepage = '' THEN 'id' || s_suppkey ELSE homepage END ORDER BY s_suppkey) = 1""")
def keep_first_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    s = s.withColumn("homepage", F.when(F.col("s_nationkey") % 5 == 0, "").otherwise(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))))
    return match.keep_first(s, F.col("homepage"), ["s_suppkey"], "s_suppkey")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts(table(spark, sf_dir, "orders").select("o_orderstatus"), "o_orderstatus")


@query("""
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_totalprice > 200000) AS large,
       count(*) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice < 50000) AS small_open FROM orders GROUP BY 1""")
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    conds = {"done": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 200000, "small_open": (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 50000)}
    return reports.conditional_counts(o, conds, ["o_orderpriority"])


@query("""
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95, round(max(value), 6) AS max FROM events GROUP BY 1""")
def phase_metrics_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.percentiles(table(spark, sf_dir, "events").select("event_type", "value"), "event_type", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p50", "p95", "max")})


_TRUTH = """
truth AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN c_mktsegment || 'X' ELSE c_mktsegment END AS segment,
                 CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey - (c_custkey % 3)::int END AS nation FROM customer WHERE c_custkey % 7 <> 0)"""


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.when(k % 4 == 0, None).when(k % 5 == 0, F.concat("c_mktsegment", F.lit("X"))).otherwise(F.col("c_mktsegment"))
    nation = F.when(k % 6 != 0, F.col("c_nationkey") - (k % 3).cast("int"))
    return table(spark, sf_dir, "customer").where(k % 7 != 0).select("c_custkey", seg.alias("segment"), nation.alias("nation"))


@query(f"""
WITH {_TRUTH}
SELECT count(*) AS n, count(*) FILTER (WHERE segment IS NOT NULL) AS segment_both, count(*) FILTER (WHERE segment = c_mktsegment) AS segment_same,
       count(*) FILTER (WHERE nation IS NOT NULL) AS nation_both, count(*) FILTER (WHERE nation = c_nationkey) AS nation_same,
       round(count(*) FILTER (WHERE segment = c_mktsegment) / nullif(count(*) FILTER (WHERE segment IS NOT NULL), 0), 9) AS segment_rate,
       round(count(*) FILTER (WHERE nation = c_nationkey) / nullif(count(*) FILTER (WHERE nation IS NOT NULL), 0), 9) AS nation_rate
FROM customer LEFT JOIN truth USING (c_custkey)""")
def kpi_match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(_truth(spark, sf_dir), "c_custkey", "left")
    out = reports.match_rates(c, {"segment": (F.col("c_mktsegment"), F.col("segment")), "nation": (F.col("c_nationkey"), F.col("nation"))})
    return out.withColumns({k: F.round(k, 9) for k in ("segment_rate", "nation_rate")})


_ACCURACY = "CASE WHEN r.c_custkey IS NULL THEN NULL WHEN coalesce(trim(r.{0}::varchar), '') = '' THEN 'no_ref' WHEN coalesce(trim(c.{0}::varchar), '') = '' THEN 'missing_new' WHEN r.{0}::varchar = c.{0}::varchar THEN 'match' ELSE 'mismatch' END"


@query(f"""
WITH {_TRUTH}, c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS segment, c_nationkey AS nation FROM customer)
SELECT c.c_custkey, c.segment, c.nation, r.segment AS reference_segment, r.nation AS reference_nation, {_ACCURACY.format("segment")} AS accuracy_segment, {_ACCURACY.format("nation")} AS accuracy_nation
FROM c LEFT JOIN truth r ON c.c_custkey = r.c_custkey""")
def reference_accuracy_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation"))
    truth = _truth(spark, sf_dir)
    return match.with_reference(c, truth.unionByName(truth.withColumns({"segment": F.lit("older"), "nation": F.lit(-1)}).where("c_custkey % 2 = 0")).withColumn("line", F.when(F.coalesce(F.col("segment") == "older", F.lit(False)), 1).otherwise(2)), "c_custkey", ["segment", "nation"], [F.col("line").desc()])


@query("""
WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::varchar END AS code, 'h' || (c_custkey % 400) AS alt, c_nationkey || '|' || (c_custkey % 50) AS pair FROM customer),
b AS (SELECT s_suppkey AS sid, CASE WHEN s_suppkey % 2 = 0 THEN (s_suppkey * 3)::varchar END AS code, 'h' || s_suppkey AS alt, s_nationkey || '|' || (s_suppkey % 50) AS pair FROM supplier),
t AS (SELECT id, min(sid) AS sid, 1 AS tier FROM a JOIN b USING (code) GROUP BY id UNION ALL SELECT id, min(sid), 2 FROM a JOIN b USING (alt) GROUP BY id UNION ALL SELECT id, min(sid), 3 FROM a JOIN b USING (pair) GROUP BY id)
SELECT id, sid, tier FROM t QUALIFY row_number() OVER (PARTITION BY id ORDER BY tier) = 1""")
def tiered_key_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    text = lambda c: c.cast("string")
    a = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, text(k)).alias("code"), F.concat(F.lit("h"), text(k % 400)).alias("alt"), F.concat_ws("|", text(F.col("c_nationkey")), text(k % 50)).alias("pair"))
    b = table(spark, sf_dir, "supplier").select(s.alias("sid"), F.when(s % 2 == 0, text(s * 3)).alias("code"), F.concat(F.lit("h"), text(s)).alias("alt"), F.concat_ws("|", text(F.col("s_nationkey")), text(s % 50)).alias("pair"))
    return match.tiered(a, b, "id", "sid", [(F.col(c), F.col(c)) for c in ("code", "alt", "pair")])


@query("""
WITH old AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name END AS p_name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS p_size, 'old' AS name_source FROM part WHERE p_partkey % 10 <> 0),
new AS (SELECT p_partkey, p_brand AS p_name, p_size + 100 AS p_size FROM part WHERE p_partkey % 2 = 0)
SELECT p_partkey, CASE WHEN trim(coalesce(old.p_name, '')) = '' AND trim(coalesce(new.p_name, '')) <> '' THEN new.p_name ELSE old.p_name END AS p_name, coalesce(old.p_size, new.p_size) AS p_size,
       CASE WHEN trim(coalesce(old.p_name, '')) = '' AND trim(coalesce(new.p_name, '')) <> '' THEN 'import' ELSE name_source END AS name_source
FROM old LEFT JOIN new USING (p_partkey)
UNION ALL SELECT p_partkey, p_name, p_size, NULL FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM old)""")
def fill_blank_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    old = p.where(k % 10 != 0).select("p_partkey", F.when(k % 3 == 0, " ").otherwise(F.col("p_name")).alias("p_name"), F.when(k % 4 != 0, F.col("p_size")).alias("p_size"), F.lit("old").alias("name_source"))
    new = p.where(k % 2 == 0).select("p_partkey", F.col("p_brand").alias("p_name"), (F.col("p_size") + 100).alias("p_size"))
    return match.upsert_blank(old, new, "p_partkey", ["p_name"], ["p_size"], {"p_name": "name_source"}, "import")


@query("""
WITH had AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey % 3 = 0),
new AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS p_type FROM part WHERE p_partkey % 3 <> 0)
SELECT p_partkey, p_brand, p_type FROM new WHERE p_type IS NULL
UNION ALL SELECT p_partkey, p_brand, p_type FROM (SELECT * FROM new WHERE p_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1) n
WHERE NOT EXISTS (SELECT 1 FROM had WHERE had.p_brand = n.p_brand AND had.p_type = n.p_type)""")
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    new = p.where(k % 3 != 0).select("p_partkey", "p_brand", F.when(k % 17 != 0, F.col("p_type")).alias("p_type"))
    return match.insert_new(p.where(k % 3 == 0), new, ["p_brand", "p_type"], ["p_partkey"])


@query("""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'c' || p_partkey ELSE '' END AS code, CASE WHEN p_partkey % 4 = 0 THEN 'shared' || (p_partkey % 40) ELSE 'n' || p_partkey END AS name, 'old' AS homepage FROM part),
r AS (SELECT 'c' || (s_suppkey * 5) AS code, '' AS name, 'by code ' || s_suppkey AS homepage FROM supplier UNION ALL SELECT '', 'n' || (s_suppkey + 1), 'by name ' || s_suppkey FROM supplier UNION ALL SELECT '', 'shared' || (s_suppkey % 40), 'shared' FROM supplier),
c AS (SELECT code, min(homepage) AS h FROM r WHERE code <> '' GROUP BY 1), n AS (SELECT name, min(homepage) AS h FROM r WHERE name IN (SELECT name FROM t GROUP BY 1 HAVING count(*) = 1) GROUP BY 1)
SELECT p_partkey, code, name, coalesce(c.h, n.h, homepage) AS homepage FROM t LEFT JOIN c USING (code) LEFT JOIN n USING (name)""")
def unique_name_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s, text = F.col("p_partkey"), F.col("s_suppkey"), lambda a, b: F.concat(F.lit(a), b.cast("string"))
    t = table(spark, sf_dir, "part").select("p_partkey", F.when(k % 5 == 0, text("c", k)).otherwise("").alias("code"), F.when(k % 4 == 0, text("shared", k % 40)).otherwise(text("n", k)).alias("name"), F.lit("old").alias("homepage"))
    sup = table(spark, sf_dir, "supplier")
    rows = sup.select(text("c", s * 5).alias("code"), F.lit("").alias("name"), text("by code ", s).alias("homepage"))
    rows = rows.union(sup.select(F.lit(""), text("n", s + 1), text("by name ", s))).union(sup.select(F.lit(""), text("shared", s % 40), F.lit("shared")))
    return match.unique_name_update(t, rows, "code", "name", "homepage", "p_partkey")


@query("""
WITH o AS (SELECT c_custkey AS id, c_mktsegment AS name, c_nationkey AS address FROM customer), w AS (SELECT id, name, (address + 1) % 25 AS address FROM o WHERE id % 50 = 0)
SELECT id, name, address FROM w WHERE EXISTS (SELECT 1 FROM o WHERE o.name = w.name AND o.address = w.address AND o.id <> w.id)""")
def collision_self_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("address"))
    wanted = o.where("id % 50 = 0").withColumn("address", (F.col("address") + 1) % 25)
    return match.taken_by_other(wanted, o, ["name", "address"], "id")


@query("""
WITH t AS (SELECT c_custkey, c_mktsegment AS name, CASE WHEN c_custkey % 2 = 0 THEN 'A' || c_nationkey ELSE 'B' || c_nationkey END AS addr, 'A' || c_nationkey AS found FROM customer),
r AS (SELECT name, addr, min(c_custkey) AS truth FROM t WHERE c_custkey % 3 = 0 GROUP BY 1, 2)
SELECT t.c_custkey, coalesce(a.truth, b.truth) AS truth FROM t LEFT JOIN r a ON t.name = a.name AND t.addr = a.addr LEFT JOIN r b ON t.name = b.name AND t.found = b.addr""")
def two_key_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    t = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("name"), F.concat(F.when(k % 2 == 0, "A").otherwise("B"), nation).alias("addr"), F.concat(F.lit("A"), nation).alias("found"))
    r = t.where("c_custkey % 3 = 0").groupBy("name", "addr").agg(F.min("c_custkey").alias("truth"))
    second = r.select("name", F.col("addr").alias("found"), F.col("truth").alias("other"))
    return t.join(r, ["name", "addr"], "left").join(second, ["name", "found"], "left").select("c_custkey", F.coalesce("truth", "other").alias("truth"))


@query("""
SELECT o_orderkey, floor(o_totalprice)::bigint AS old, floor(o_totalprice)::bigint + 1 AS new FROM orders WHERE o_orderkey % 10 = 0""")
def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("v"))
    new = o.withColumn("v", F.when(F.col("o_orderkey") % 10 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return match.changed(o, new, "o_orderkey", ["v"]).select("o_orderkey", F.col("old").cast("long"), F.col("new").cast("long"))


@query("""
WITH b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS bucket FROM orders)
SELECT o_orderkey, bucket, bucket_rows FROM (SELECT *, count(*) OVER (PARTITION BY bucket) AS bucket_rows, row_number() OVER (PARTITION BY bucket ORDER BY o_orderkey) AS rn FROM b) WHERE rn <= 20""")
def failure_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return reports.buckets(o, {"large": F.col("o_totalprice") > 300000, "open": F.col("o_orderstatus") == "O"}, ["o_orderkey"]).select("o_orderkey", "bucket", "bucket_rows")


@query("""
SELECT o_orderkey, 'o_orderstatus' AS field, o_orderstatus AS value, 'medium' AS severity, 'enum_unknown' AS code FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, 'o_orderdate', strftime(o_orderdate, '%Y-%m-%d'), 'high', 'year_out_of_range' FROM orders WHERE false
UNION ALL SELECT o_orderkey, 'month', (o_orderkey % 15)::varchar, 'high', 'fiscal_month_out_of_range' FROM orders WHERE o_orderkey % 15 NOT BETWEEN 1 AND 12""")
def enum_range_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), (F.col("o_orderkey") % 15).cast("string").alias("month"))
    return quality.audit(o, "o_orderkey", {"o_orderstatus": quality.enum_checks(["F", "O"]), "o_orderdate": quality.year_checks, "month": quality.month_checks})


@query("""
WITH f AS (SELECT o_orderkey, (o_orderkey % 8)::int AS domain, o_orderkey % 3 = 0 AS host, o_orderkey % 5 = 0 AS name, o_orderkey % 7 = 0 AS address, (o_orderkey % 13)::int AS evidence, o_orderkey % 11 = 0 AS strong FROM orders)
SELECT o_orderkey, ((host OR strong OR domain >= 4) AND (name OR address OR evidence >= 9)) OR (domain >= 3 AND name AND (address OR evidence >= 7)) OR (domain >= 3 AND evidence >= 11) AS official,
       round(CASE WHEN o_orderkey % 4 = 0 AND (o_orderkey % 10) / 10.0 >= 0.6 THEN 1000 + (o_orderkey % 10) / 10.0 * 100 WHEN o_orderkey % 4 = 0 THEN (o_orderkey % 10) / 10.0 * 10 WHEN o_orderkey % 4 = 1 THEN -200 ELSE 0 END
       + domain * 5 + evidence * 2 + host::int * 20 + strong::int * 12 + name::int * 10 - (o_orderkey % 17 = 0)::int * 500, 6) AS choice FROM f""")
def official_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    domain, evidence, host, name, address, strong = (k % 8).cast("int"), (k % 13).cast("int"), k % 3 == 0, k % 5 == 0, k % 7 == 0, k % 11 == 0
    verdict = F.when(k % 4 == 0, True).when(k % 4 == 1, False)
    choice = decide.selection_score(verdict, (k % 10) / F.lit(10.0), domain, evidence, host, strong, name, k % 17 == 0)
    return o.select("o_orderkey", decide.official_signal(host, strong, domain, name, address, evidence).alias("official"), F.round(choice.cast("double"), 6).alias("choice"))


@query("""
WITH f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'https://h' || o_orderkey END AS homepage, (o_orderkey % 2)::int AS flag,
  CASE o_orderkey % 3 WHEN 0 THEN 'provisional' WHEN 1 THEN 'ai_provisional_weak' ELSE 'rule' END AS source, (o_orderkey % 6)::int AS domain, (o_orderkey % 12)::int AS evidence FROM orders),
d AS (SELECT *, homepage <> '' AND flag = 0 AND source <> 'rule' AND NOT (domain >= 4 OR ((k % 4 = 0 OR k % 5 = 0) AND domain >= 3) OR k % 13 = 0 OR k % 17 = 0 OR evidence >= 8) AS dropped FROM f)
SELECT k AS o_orderkey, CASE WHEN dropped THEN '' ELSE homepage END AS homepage, CASE WHEN dropped THEN '' ELSE source END AS source, CASE WHEN dropped THEN 0.0 ELSE 2.5 END::double AS score, CASE WHEN dropped THEN 0 ELSE domain END AS domain, dropped FROM d""")
def homepage_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    source = F.when(k % 3 == 0, "provisional").when(k % 3 == 1, "ai_provisional_weak").otherwise("rule")
    home = F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("https://h"), k.cast("string")))
    out = decide.homepage_policy(home, (k % 2).cast("int"), source, F.lit(2.5), (k % 6).cast("int"), k % 4 == 0, k % 5 == 0, k % 7 == 0, k % 13 == 0, k % 17 == 0, (k % 12).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", out.alias("d")).select("o_orderkey", "d.*")


@query("""
WITH f AS (SELECT o_orderkey AS k, o_orderkey % 6 <> 0 AS home, o_orderkey % 4 = 0 AS cand, o_orderkey % 29 = 0 AS late, o_orderkey % 3 = 0 AS target, o_orderkey % 5 = 0 AS pok, o_orderkey % 7 = 0 AS aok, (o_orderkey % 8)::int AS dom,
  CASE o_orderkey % 4 WHEN 0 THEN 'ai' WHEN 1 THEN 'rule' WHEN 2 THEN 'verify_promote' ELSE 'official' END AS src, o_orderkey % 10 < 8 AS flag, o_orderkey % 2 = 0 AS model, o_orderkey % 9 <> 0 AS comp, o_orderkey % 31 = 0 AS forced FROM orders)
SELECT k AS o_orderkey, CASE WHEN late OR (NOT home AND cand) OR forced OR (home AND ((target AND NOT (pok OR aok) AND dom < 5) OR (dom <> 0 AND dom < 4 AND src IN ('ai', 'rule'))
  OR NOT (flag AND (dom >= 4 OR (src = 'verify_promote' AND dom >= 3)) AND (model OR comp) AND (NOT target OR pok OR aok)))) THEN 'review' WHEN home THEN 'done' ELSE 'no_homepage' END AS status,
  CASE WHEN NOT target AND NOT model THEN greatest(0.5, 0.6) WHEN (NOT target OR pok) AND (NOT model OR aok) THEN CASE WHEN target AND model THEN 1.0 ELSE 0.85 END WHEN pok OR aok THEN 0.75 ELSE 0.45 END::double AS confidence FROM f""")
def final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    home = F.when(k % 6 != 0, "https://x").otherwise("")
    src = F.when(k % 4 == 0, "ai").when(k % 4 == 1, "rule").when(k % 4 == 2, "verify_promote").otherwise("official")
    target, pok, aok, model = k % 3 == 0, k % 5 == 0, k % 7 == 0, k % 2 == 0
    status = decide.final_status(home, k % 4 == 0, k % 29 == 0, target, pok, aok, (k % 8).cast("int"), F.when(k % 10 < 8, 1).otherwise(0), src, model, k % 9 != 0, k % 31 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), decide.confidence(target, model, pok, aok, F.lit(0.5)).cast("double").alias("confidence"))


@query("""
SELECT o_orderkey AS id, (n % 4)::bigint AS worker, (n // 4)::int AS turn FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'O' THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey) - 1 AS n FROM orders WHERE o_orderstatus IN ('O', 'F')) WHERE n < 40""")
def claim_order_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("employee_count"))
    out = state.claims(o, 4, state.claim_order("employee_desc_id_asc"), retry=["F"], per_worker=10)
    return out.select("id", F.col("worker").cast("long").alias("worker"), "turn")


@query("""
SELECT event_id, CASE WHEN event_type = 'view' AND (event_id % 6 = 0 OR ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY) THEN 'pending' WHEN event_type = 'view' THEN 'running' ELSE event_type END AS status FROM events""")
def ttl_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    rows = e.select("event_id", F.when(F.col("event_type") == "view", "running").otherwise(F.col("event_type")).alias("status"), F.when(F.col("event_id") % 6 != 0, F.col("ts")).alias("locked_at"))
    last = e.agg(F.max("ts").alias("now"))
    return state.expired(rows.crossJoin(F.broadcast(last)), F.col("now"), 24 * 60).select("event_id", "status")


@query("""
WITH e AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
SELECT shard, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (SELECT o_orderkey, floor((o_orderkey - lo) / ceil((hi - lo + 1) / 7))::int AS shard FROM orders, e) GROUP BY 1""")
def range_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = state.shards(table(spark, sf_dir, "orders").select("o_orderkey"), 7, "o_orderkey")
    return o.groupBy("shard").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


@query("""
SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events WHERE event_type = 'error' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1 HAVING count(*) >= 2""")
def slow_host_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    last = e.agg(F.max("ts").alias("now"))
    return state.slow_hosts(e.where("event_type = 'error'").crossJoin(F.broadcast(last)), "user_id", "ts", F.col("now"))


@query("""
SELECT p_partkey, CASE WHEN regexp_matches(name, '^[ \\t\\r\\n]*[=+@-]') THEN '''' || name ELSE name END AS name FROM
  (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '=1+' || p_name WHEN 1 THEN '  @' || p_name WHEN 2 THEN chr(9) || '-' || p_name ELSE p_name END AS name FROM part)""")
def csv_formula_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_name")
    name = F.when(k % 5 == 0, F.concat(F.lit("=1+"), n)).when(k % 5 == 1, F.concat(F.lit("  @"), n)).when(k % 5 == 2, F.concat(F.lit("\t-"), n)).otherwise(n)
    return table(spark, sf_dir, "part").select("p_partkey", formula_guarded(name).alias("name"))


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def extra_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not of the enrichment application: grouping sets come with Spark."""
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""
SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000""")
def extra_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    return a.distinct().join(table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("nation")), "nation", "left_anti")


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def extra_tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form of the stream in ``streaming``."""
    e = table(spark, sf_dir, "events")
    out = e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")

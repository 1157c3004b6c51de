"""Plans of the choice among tagged candidates, over literal arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.operators import candidates

from .registry import query

ROWS = [
    (1, ["[TEXT]1000万円", "[TABLE]3億円"], ["約120名", "[TABLE]100名"], ["東証プライム", "上場"], ["[TABLE]山田太郎", "代表取締役 鈴木一郎"]),
    (2, ["[TABLE]なし", "5000円"], ["10-20名", "15名"], ["[TABLE]東証", "上場"], ["お問い合わせ", "[LABEL]佐藤 花子"]),
    (3, [], [], ["長い文です。"], []),
]


def _rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, "id long, amounts array<string>, staff array<string>, listings array<string>, people array<string>")


@query("""
SELECT * FROM (VALUES (1::bigint, '300,000,000円', '100名', '上場', '鈴木一郎', true), (2, '5,000円', '10-20名', '東証', '佐藤 花子', true), (3, NULL, NULL, NULL, NULL, false)) AS t(id, amount, employees, listing, person, amount_ok)""")
def field_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates
    out = _rows(spark).select("id", c.best_amount(F.col("amounts")).alias("amount"), c.best_employees(F.col("staff")).alias("employees"), c.best_listing(F.col("listings")).alias("listing"), c.best_person(F.col("people")).alias("person"), "amounts")
    return out.withColumn("amount_ok", c.accepted(F.col("amount"), F.col("amounts"), F.lit("COMPANY_PROFILE"), lambda a, b: a == b)["ok"]).drop("amounts")


@query("""
SELECT * FROM (VALUES (1::bigint, 'https://x.jp/company'), (2, 'https://x.jp/b')) AS t(id, reference)""")
def reference_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(1, [("https://x.jp/a", "OTHER"), ("https://x.jp/news/company", "COMPANY_PROFILE"), ("https://x.jp/company", "COMPANY_PROFILE")]), (2, [("https://x.jp/cc", "OTHER"), ("https://x.jp/b", "OTHER")])], "id long, pages array<struct<url: string, page_type: string>>")
    return rows.select("id", candidates.reference_page(F.col("pages")).alias("reference"))

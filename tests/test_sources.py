from pyspark.sql import functions as F

from tideglass.operators import candidates, sites, state, taxonomy
from tideglass.sources import storage, tables


def test_recent_lines(spark, tmp_path):
    path = tmp_path / "log.txt"
    path.write_text("2024-01-01 10:00:00 saved a\n2024-01-02 10:00:00 saved b\n2024-01-02 11:00:00 other\nno stamp saved\n")
    rows = tables.recent_lines(spark, str(path), "saved", "2024-01-02 00:00:00").collect()
    assert [r.value for r in rows] == ["2024-01-02 10:00:00 saved b"]


def test_dimension(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"version": "1", "entries": [{"top": "t", "sub": "s"}, {"top": "t", "sub": "u"}]}')
    assert sorted((r.top, r["sub"]) for r in tables.dimension(spark, str(path), "entries").collect()) == [("t", "s"), ("t", "u")]


def test_reset_and_projected(spark):
    df = spark.createDataFrame([(1, "x", 5)], "id int, status string, n int")
    out = tables.projected(tables.reset(df, {"status": "pending", "n": 0, "absent": 1}), ["id", "absent", "status", "n"])
    assert out.columns == ["id", "status", "n"] and tuple(out.first()) == (1, "pending", 0)


def test_materialized_tables_are_read_from_files_and_released(spark):
    df = storage.materialize(spark.range(5).where("id < 0"), "empty")
    assert df.count() == 0 and df.columns == ["id"]
    kept = storage.materialize(spark.range(3), "three")
    assert kept.count() == 3
    storage.release(kept)
    storage.release(spark.range(1))


def test_categories_have_aliases_and_keywords(spark):
    rows = spark.createDataFrame([("建設", "その他建設業")], "top string, sub string")
    r = taxonomy.categories(rows).first()
    assert "建設" in r.aliases and "その他建設業" in r.aliases and r.keywords == ["建設"]


def test_tags(spark):
    v = F.lit('["建設", "建 設", "https://x", ""]')
    assert spark.range(1).select(taxonomy.clean_tags(taxonomy.tag_values(v))).first()[0] == ["建設"]
    assert spark.range(1).select(taxonomy.major_codes(F.lit("b, A|b 12"))).first()[0] == ["A", "B"]


def test_random_claim_order_is_repeatable(spark):
    q = spark.range(50).withColumn("status", F.lit("pending"))
    one, two = ([r.id for r in q.orderBy(*state.claim_order("random", seed="s")).collect()] for _ in range(2))
    assert one == two != sorted(one)


def test_descriptions(spark):
    pick = lambda c: spark.range(1).select(c).first()[0]
    assert pick(sites.description(F.lit("私たちは建設事業を全国で提供しています。お問い合わせはこちら。"))).startswith("私たちは建設事業")
    assert pick(sites.description(F.lit("サンプル事業を提供するサービスです"))) == ""
    assert pick(sites.description(F.lit(None).cast("string"))) == ""
    assert pick(sites.listing(F.lit("7203"))) == "7203"


def test_accepted_needs_a_page_or_a_structured_source(spark):
    c = F.array(F.lit("[TABLE]a"), F.lit("[TEXT]b"))
    same = lambda x, y: x == y
    ok = lambda v, page: spark.range(1).select(candidates.accepted(F.lit(v), c, F.lit(page), same)).first()[0]["ok"]
    assert ok("a", "OTHER") and ok("b", "COMPANY_PROFILE") and not ok("b", "OTHER") and not ok("a", "DIRECTORY_DB")

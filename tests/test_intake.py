from pyspark.sql import functions as F

from tideglass.functions import company
from tideglass.operators import intake


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_company(spark):
    L, true, false = F.lit, F.lit(True), F.lit(False)
    words = F.array(L("acme"))
    r = _one(
        spark, company.spelled_letters(L("株式会社ダブリュービー アイ")).alias("a"), company.tokens(L(None).cast("string")).alias("b"), company.without_phones(L("TEL 03-1234-5678 と 06-0035")).alias("c"), company.without_phones(L(None).cast("string")).alias("d"),
        company.holds_number(L("電話(03) 1234 5678"), L("03-1234-5678")).alias("e"), company.holds_number(L("031x2345678"), L("0312345678"), 8, r"[\s\-‐―－ー]+").alias("f"), company.holds_number(L("x"), L("")).alias("g"),
        company.labelled_phone(L("ＴＥＬ：（代）03ー1234ー5678")).alias("h"), company.labelled_phone(L("なし")).alias("i"),
        company.entity_host(L("千代田市役所"), L("https://www.city.lg.jp/a")).alias("j"), company.profile_url(L("千代田市役所"), L("https://acme.co.jp/about"), words, true).alias("k"), company.profile_url(L("acme"), L("https://acme.co.jp/about"), words, true).alias("l"), company.profile_url(L("acme"), L("https://x.co.jp/about"), words, false).alias("m"),
    )
    assert r.a == ["wb"] and r.b == [] and tuple(r.c) == ("と 06-0035", 1) and tuple(r.d) == ("", 0) and r.e and not r.f and not r.g
    assert r.h == "03-1234-5678" and r.i is None and r.j and not r.k and r.l and not r.m


def test_addresses_and_blocks(spark):
    L = F.lit
    rows = spark.createDataFrame([(1, "〒100-0001 東京都千代田区千代田1-1 A棟 〒100-0002 東京都港区1-2"), (2, "東京都千代田区千代田1-1-1 代表取締役 山田"), (3, "お問い合わせ"), (4, None)], "id long, a string")
    got = {r.id: r.s for r in rows.select("id", company.input_address(F.col("a")).alias("s")).collect()}
    assert got == {1: "〒100-0001 東京都千代田区千代田1-1 A棟", 2: "東京都千代田区千代田1-1-1", 3: "", 4: ""}
    pages = F.array(*[F.struct(L(t).alias("text"), L(m).alias("meta")) for t, m in (("事業 一\n他", " m "), (None, "m"), ("事業 一\n他", None))])
    r = _one(spark, company.page_blocks(pages, ["事業"], 1).alias("a"), company.is_contact_page(L("ACCESS_CONTACT"), L("<FORM>"), L(None).cast("string")).alias("b"), company.is_contact_page(L("OTHER"), L("<form>"), L("")).alias("c"), company.accepted_description(L("now"), L("部" * 200)).alias("d"))
    assert r.a == ["事業 一", "m"] and r.b and not r.c and r.d == "部" * 160


def test_forms(spark):
    html = '<title> T </title><form action="/send"><label>お問い合わせ</label><input name="採用"></form><form action="https://form.run/a"><select><option>応募</option></select></form><a href="mailto:a@b">m</a>'
    rows = spark.createDataFrame([(1, "https://x.jp/c", html), (2, "https://x.jp/d", "<form><option>採用"), (3, None, None)], "id long, url string, html string").withColumn("f", company.forms("url", "html"))
    got = {r.id: tuple(r.f) for r in rows.collect()}
    assert got == {1: (2, 2, True, False, True, ["x.jp", "form.run"], "T"), 2: (1, 0, False, True, False, [], ""), 3: (0, 0, False, False, False, [], "")}
    told = rows.where("id = 1").select(company.contact_signals(F.lit("https://www.x.jp/"), F.col("url"), F.col("f"))).first()[0]
    assert told == "same_host=false; same_reg_domain=true; has_form=true; form_count=2; input_count=2; action_hosts=x.jp,form.run; general_inquiry_option=true; recruit_only=false; email_present=true; title=T"


def test_intake(spark):
    rows = spark.createDataFrame([(1, ["x"]), (2, [" 会社名 "]), (3, ["a", "b", "c", None, "e"]), (4, [" ", None]), (5, None), (6, ["会社名"])], "place long, cells array<string>")
    got = [(r.place, *r.r) for r in intake.after_header(rows, "cells", "place", "会社名").select("place", intake.positional_record(F.col("cells")).alias("r")).orderBy("place").collect()]
    assert got == [(3, "a", "ce"), (6, "会社名", "")] and intake.after_header(rows.limit(0), "cells", "place", "会社名").count() == 0
    cands = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(u).alias("url"), F.lit("OTHER").alias("page_type")) for v, u in (("A", None), (None, "u0"), ("a", "u1"), ("A", "u2"))])
    r = _one(spark, intake.source_of(cands, F.lit("a"), F.lower)["url"].alias("a"), intake.source_of(cands, F.lit(""), F.lower).alias("b"), intake.stage_source(F.lit(" Mixed")).alias("c"), intake.stage_source(F.lit(None).cast("string")).alias("d"))
    assert (r.a, r.b, r.c, r.d) == ("u1", None, "ai_relaxed", "ai")
    results = spark.createDataFrame([(1, "", "F"), (2, "7", "G")], "id long, corporate_number string, name string")
    assert [tuple(r) for r in results.select("id", *intake.result_fields(["corporate_number", "name"], {"corporate_number": F.lit("9")})).orderBy("id").collect()] == [(1, "9", "F"), (2, "7", "G")]
    assert intake.phase_metrics(results, {"id": F.col("id"), "phase": F.lit("search")}).columns == list(intake.PHASE_COLUMNS)
    cards = spark.createDataFrame([("c", "l", ["h"], [str(i) for i in range(9)])], "id string, label string, industry_hints array<string>, aliases array<string>")
    assert intake.concept_card(cards).first().aliases == [str(i) for i in range(8)]


def test_update_takes_one_of_repeated_results(spark):
    rows = spark.createDataFrame([(1, "running", "w1", "k"), (2, "running", "w2", "k")], "id long, status string, locked_by string, keep string")
    results = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (3, "a", "z")], "id long, status string, error_code string")
    got = sorted(tuple(r) for r in intake.written_back(rows, results, "id", ["error_code"], "w1").collect())
    assert got == [(1, "a", None, "k"), (2, "running", "w2", "k")]

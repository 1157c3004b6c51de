import base64

from pyspark.sql import functions as F

from tideglass.functions import prose
from tideglass.operators import facts, records


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_prose(spark):
    L = F.lit
    r = _one(
        spark, prose.best_officer(L("代表取締役会長 田中 一郎、代表取締役社長 鈴木 花子")).alias("a"), prose.best_officer(L("取締役 佐藤 次郎")).alias("b"), prose.best_officer(L("なし")).alias("c"),
        prose.last_name(L("学校法人 山田 太郎")).alias("d"), prose.is_amount(L("1,000万円")).alias("e"), prose.is_amount(L("従業員 20名")).alias("f"), prose.title_parts(L("会社概要 | 山 / 海")).alias("g"),
        prose.without_addresses(L("see http://x.jp/a or a@b.jp now")).alias("h"), prose.full_address(L("〒100-0001 東京都千代田区")).alias("i"), prose.full_address(L("山田")).alias("j"),
        prose.described(L("部品を  作る会社"), 5, 60).alias("k"), prose.described(L("see http://x 部品"), 5, 60).alias("l"), prose.described(L("採用の部品を作る会社"), 5, 60, prose.LEADING_AWAY).alias("m"),
        prose.filled_by_script(L('<div id="__next"></div>'), L("")).alias("n"), prose.filled_by_script(L("<p>x</p>"), L("x")).alias("o"), prose.asks_for_human(L("CAPTCHA: are you human")).alias("p"),
    )
    assert tuple(r.a) == ("鈴木 花子", True) and tuple(r.b) == ("佐藤 次郎", False) and r.c is None and r.e and not r.f and r.g == ["会社概要", "山", "海"]
    assert r.h == "see or now" and r.i and not r.j and r.k == "部品を 作る会社" and r.l is None and r.m is None and r.n and not r.o and r.p


def test_bytes_and_results():
    assert prose.decoded("電話".encode("cp932")) == prose.decoded("電話".encode()) == "電話" and prose.decoded(None) is None
    assert prose.decoded(b'<meta charset="shift_jis">' + "電話".encode("shift_jis")).endswith("電話") and prose.decoded(b"x", "no-such") == "x"
    ddg, bing = "https://duckduckgo.com", "https://www.bing.com"
    page = '<a href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fx.jp%2Fcompany">x</a><a href="/about">y</a><a href="https://y.jp/food">z</a><a href="https://z.jp/a.zip">f</a><a href="https://z.jp/company/a.pdf">p</a>'
    assert prose.results(page, ddg) == ["https://x.jp/company", "https://z.jp/company/a.pdf"]
    code = base64.urlsafe_b64encode(b"https://w.jp/").decode().rstrip("=")
    assert prose.results(f'<li class="b_algo"><h2><a href="https://www.bing.com/ck/a?u=a1{code}">w</a></h2></li>', bing) == ["https://w.jp/"]
    assert prose.results("text https://duckduckgo.com/l/?uddg=https://q.jp/ end", ddg) == ["https://q.jp/"] and prose.results(None, ddg) == [] and prose.results('<a href="http://[">x</a>', ddg) == []


def test_records(spark):
    df = spark.createDataFrame([(1, "http://a.jp", None, ["http://b.jp", "ftp://c"], [("http://a.jp", "s")])], "id long, homepage string, final_homepage string, deep array<string>, told array<struct<url: string, snippet: string>>")
    assert df.select(records.evidence_urls(F.col("deep"), F.col("told"), ["homepage", "final_homepage"])).first()[0] == ["http://a.jp", "http://b.jp"]
    rows = spark.createDataFrame([("new", None, None, None, None), ("r1", None, "timeout", None, None), ("r2", None, "ai_not_official", "ページが見つかりません", None), ("no", None, "ai_not_official", "x", "y"), ("has", "u", "timeout", None, None)], "id string, contact_url string, contact_url_status string, contact_url_ai_reason string, contact_url_reason string").withColumn("final_homepage", F.lit("h"))
    picked = lambda *a: {r.id for r in rows.where(records.contact_again(*a)).collect()}
    assert picked() == {"new"} and picked("retry") == {"r1", "r2"} and picked("status", ["ai_not_official"]) == {"r2", "no"} and len(picked("all")) == 5
    pages = spark.createDataFrame([("u1", "「部 品」を作る"), ("u2", "x")], "url string, text string")
    ev = spark.createDataFrame([(1, ["u1"], [("u1", "部品を"), ("u2", "x"), ("u1", "なし")]), (2, ["u1"], [])], "id long, allowed array<string>, evidence array<struct<url: string, snippet: string>>")
    got = {r.id: [x.snippet for x in r.kept] for r in records.description_evidence(ev, pages, "id").collect()}
    assert got == {1: ["部品を"], 2: []}
    true, false = F.lit(True), F.lit(False)
    base = {"brand_allowed": true, "content_strong": true}
    r = _one(spark, records.promoted({**base, "evidence": F.lit(10)}).alias("a"), records.promoted(base).alias("b"), records.promoted({**base, "name_in_h1": true, "free_host": true}).alias("c"), records.promoted({**base, "address_ok": true, "prefecture_only": false}).alias("d"),
             records.concept_retry(F.lit("z"), F.array(F.lit("a")), F.lit("why"), F.lit("")).alias("e"), records.concept_retry(F.lit("a"), F.array(F.lit("a")), F.lit(None), F.lit(None)).alias("f"), records.place_matches(F.lit("x"), F.lit(" ")).alias("g"), records.update_page(F.lit(" "), F.lit("o"))["source"].alias("h"))
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h) == (True, False, False, True, True, False, None, "official")


def test_facts_by_kind(spark):
    pages = spark.createDataFrame([("u1", "会社 設立 １９９９年 決算 3月 代表取締役 山田 太郎 TEL 03-1234-5678"), ("u2", "1999年の出来事。" + "あ" * 200 + "設立")], "url string, text string")
    rows = spark.createDataFrame([(1, "1999年", ["u2", "u1"]), (2, "2001", ["u1"]), (3, "x", ["u1"]), (4, " ", ["u1"]), (5, "1999", []), (6, "1999", ["gone", "u2"]), (7, None, None)], "id long, value string, evidence array<string>")
    got = {r.id: (r.verdict, r.evidence_url) for r in facts.checked(rows, pages, ["id"], facts.founded()).collect()}
    assert got == {1: ("verified", "u1"), 2: ("not_found", None), 3: ("unknown_no_evidence", None), 4: ("blank", None), 5: ("unknown_no_evidence", None), 6: ("fetch_failed", None), 7: ("blank", None)}
    one = lambda p, v: facts.checked(spark.createDataFrame([(1, v, ["u1"])], "id long, value string, evidence array<string>"), pages, ["id"], p).first()
    assert one(facts.person(), "山田 次郎").reason == "token_found_near_rep_keyword" and one(facts.phone(), "03 1234 5678").verdict == "verified" and one(facts.phone(), "123").reason == "phone_value_too_short"
    assert one(facts.fiscal_month(), "03").reason == "month_found_near_fiscal_keyword" and one(facts.fiscal_month(), "13").reason == "fiscal_month_out_of_range" and one(facts.amount(), "12").reason == "amount_digits_too_short"

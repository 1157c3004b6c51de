import json

import pytest
from pyspark.sql import functions as F

from tideglass.functions import address, names, numbers, page_types, pages, phone, text, urls


def values(spark, rows, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_nfkc_and_norm_text(spark):
    assert values(spark, ["ＡＢＣ　サービス", None], text.norm_text) == ["abc サ ビス", None]
    assert values(spark, ["ﾃｽﾄ①", ""], text.nfkc) == ["テスト1", ""]


def test_blank_knows_wide_spaces(spark):
    assert values(spark, ["　 \t", None, "x"], text.blank) == [True, True, False]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("住所：〒100-0001　東京都千代田区千代田１−１", "〒100-0001 東京都千代田区千代田1-1"),
        ("本社所在地 大阪府大阪市北区梅田三丁目一番 TEL 06-1111-2222", "大阪府大阪市北区梅田3丁目1番"),
        ("企業理念", None),
        ("東京都 大阪府 京都府", None),
        ('{"address": "東京都"}', None),
        (None, None),
        ("", None),
    ],
)
def test_clean_address(raw, want):
    assert address.clean_address(raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("代表取締役社長 山田 太郎", "山田 太郎"), ("[TABLE]代表者 鈴木一郎（すずき）", "鈴木一郎"), ("お問い合わせ", None), ("株式会社テスト", None), ("John Smith", "John Smith"), ("サトウ", None), ("03-1234-5678", None), (None, None)],
)
def test_clean_person(raw, want):
    assert names.clean_person(raw) == want


@pytest.mark.parametrize(("raw", "want"), [("二十三", 23), ("百五", 105), ("千二百", 1200), ("三万五千", 35000), ("一億二千万", 120_000_000), ("12万", 120_000), ("二〇二四", 2024), ("十", 10), ("四丁目", None), ("", None)])
def test_kanji(raw, want):
    assert numbers.kanji_value(raw) == want


def test_amount_text(spark):
    assert values(spark, ["6億6700万円", "▲500百万円"], numbers.amount_text) == ["667,000,000円", "▲500,000,000円"]


def test_phone_profiles(spark):
    assert values(spark, ["nothing"], lambda c: phone.phone(c, phone.PROFILES["reference"])) == ["nothing"]
    assert values(spark, ["0000000000"], lambda c: phone.phone(c, phone.PROFILES["strict"])) == [None]


def test_best_phone_prefers_structured_and_context(spark):
    pick = lambda *c: spark.range(1).select(phone.best(F.array(*[F.lit(x) for x in c]))).first()[0]
    assert pick("[FOOTER]03-1111-1111", "[TABLE]03-2222-2222") == "03-2222-2222"
    assert pick("[TABLE]0120-111-111", "[TABLE]03-2222-2222") == "03-2222-2222"
    assert pick("[FAX]03-1111-1111") is None
    assert pick("[TABLE][BRANCH]03-1111-1111", "[TABLE][HQ]03-3333-3333") == "03-3333-3333"


def test_phone_of_weak_page_needs_a_source(spark):
    row = spark.range(1).select(phone.scored(F.lit("[TEXT]03-1111-1111"), F.lit("OTHER")), phone.scored(F.lit("[TEXT]03-1111-1111"), F.lit("COMPANY_PROFILE"))).first()
    assert row[0] is None and row[1]["phone"] == "03-1111-1111"


def test_urls(spark):
    assert values(spark, ["example.jp/a b#x", "mailto:a@b", "ftp://x", None], urls.cleaned) == ["https://example.jp/ab", "", "", ""]
    assert values(spark, ["a.b.co.jp", "a.b.com", "localhost"], urls.registrable) == ["b.co.jp", "b.com", "localhost"]
    assert values(spark, ["https://www.x.jp:8080/index.html?q=1", "http://x.jp/a/"], urls.flag_key) == ["https://x.jp/", "http://x.jp/a"]
    assert values(spark, ["https://r.example/l/?uddg=https%3A%2F%2Fa.jp%2Fx&y=1"], urls.unwrapped) == ["https://a.jp/x"]
    assert values(spark, ["a.b.jp"], urls.parents) == [["a.b.jp", "b.jp", "jp"]]


def test_name_match():
    assert names.name_match("株式会社テスト", ["テスト"])[:2] == (1.0, True)
    ratio, exact, part, _ = names.name_match("テスト商事", ["テスト商事サービス"])
    assert (ratio, exact, part) == (0.69, False, True)
    assert names.name_match("AB", ["ABC"])[0] <= 0.4


PAGE = """<html><head><title>会社概要 | テスト</title><meta name="description" content="desc">
<script type="application/ld+json">{"@type":"Organization","telephone":"03-9999-0000","address":{"postalCode":"100-0001","addressRegion":"東京都"}}</script></head>
<body><nav><a href="/about">About</a></nav><h1>会社概要</h1><table><tr><th>本社所在地</th><td>東京都千代田区1-1</td></tr><tr><th>電話</th><td>TEL 03-1234-5678 FAX 03-1234-5679</td></tr>
<tr><th>代表者</th><td>山田太郎</td></tr><tr><th>資本金</th><td>1,000万円</td></tr><tr><th>設立</th><td>1990年</td></tr></table>
<a href="tel:0312345678">call</a><a href="/company/profile#a">会社概要</a><a href="https://other.jp/">x</a><footer>〒100-0001 東京都千代田区1-1</footer><script>var x = 1</script></body></html>"""


def test_page_parts():
    p = pages.Page(PAGE)
    assert p.title == "会社概要 | テスト" and p.metas["description"] == "desc"
    assert "var x" not in p.text() and "About" not in p.text() and "東京都" in p.footer()
    assert p.objects()[0]["telephone"] == "03-9999-0000"


def test_page_candidates():
    c = pages.candidates(None, PAGE)
    assert "[TABLE]03-1234-5678" in c["phone"] and "[TABLE][FAX]03-1234-5679" in c["phone"] and "[TELHREF]0312345678" in c["phone"] and "[JSONLD]03-9999-0000" in c["phone"]
    assert "[TABLE][HQ]東京都千代田区1-1" in c["address"] and c["rep"] == ["[TABLE]山田太郎"] and c["founded"] == ["[TABLE]1990年"]


def test_page_type_and_links():
    assert page_types.page_type("https://x.jp/company", None, PAGE)[0] == "COMPANY_PROFILE"
    assert page_types.page_type("https://x.jp/contact", "", "<h1>Contact</h1>")[0] == "ACCESS_CONTACT"
    assert page_types.page_type("https://x.jp/", "hello", "<p>hello</p>")[0] == "OTHER"
    assert pages.ranked_links("https://x.jp/", PAGE)[0][0] in ("https://x.jp/company/profile", "https://x.jp/about")


@pytest.mark.parametrize("source", [None, "", "<", "<p", "<table><tr><td>", "&#xFFFFFFFF;", "<script type='application/ld+json'>{", "<!-- x"])
def test_broken_markup_never_fails(source):
    pages.candidates(None, source)
    page_types.page_type(None, None, source)
    pages.ranked_links(None, source)


def test_first_json(spark):
    assert [json.loads(x) if x else x for x in values(spark, ['x {"a": [1]} y', "{broken", None], pages.first_json)] == [{"a": [1]}, None, None]


def test_mojibake(spark):
    assert values(spark, ["日本語", "Ã©Ã¨Ã", "a�", None], text.mojibake) == [False, True, True, False]


OFFICES = "<li>東営業所 〒100-0001 東京都千代田区1</li><li>西営業所 〒530-0001 大阪府大阪市2</li><li>中営業所 〒450-0002 愛知県名古屋市3</li>"
FACTS = "<table><tr><th>本社所在地</th><td>〒100-0001 東京都千代田区1</td></tr><tr><th>TEL</th><td>03-1234-5678</td></tr><tr><th>代表取締役</th><td>山田 太郎</td></tr><tr><th>事業内容</th><td>製造</td></tr></table>"


@pytest.mark.parametrize("url, source, kind, reason", [
    ("https://x.jp/a/outline.html", f"<title>会社概要</title><h1>会社概要</h1>{FACTS}", "COMPANY_PROFILE", "facts_in_table"),
    ("https://x.jp/bases", f"<title>拠点一覧</title><h1>拠点一覧</h1><ul>{OFFICES}</ul>", "BASES_LIST", "offices"),
    ("https://x.jp/company/bases", f"<h1>拠点一覧</h1>{FACTS}<ul>{OFFICES}</ul>", "COMPANY_PROFILE", "offices_beside_profile"),
    ("https://x.jp/offices", f"<h1>営業所一覧</h1><table><tr><th>代表者</th><td>山田</td></tr><tr><th>住所</th><td>本店</td></tr><tr><th>設立</th><td>1990</td></tr></table>{OFFICES}", "COMPANY_PROFILE", "offices_beside_person"),
    ("https://x.jp/p1", "<p>代表取締役 山田</p><p>本社 〒100-0001</p>", "COMPANY_PROFILE", "person_and_contact"),
    ("https://x.jp/kaisha", "<p>本社 あり 設立 資本金 従業員 事業内容</p>", "COMPANY_PROFILE", "path_and_facts"),
    ("https://x.jp/p2", "<h2>団体概要</h2><p>設立 資本金 従業員</p>", "COMPANY_PROFILE", "heading_and_facts"),
    ("https://x.jp/p3", "<h1>お問い合わせ</h1>", "ACCESS_CONTACT", "contact_heading"),
    ("https://x.jp/p4", "<p>アクセス 電話 03-1234-5678</p>", "ACCESS_CONTACT", "contact_text"),
    ("https://x.jp/toiawase", "<p>x</p>", "ACCESS_CONTACT", "contact_path"),
    ("https://x.jp/p5", "<p>電話 03-1234-5678 03-1234-5679 03-1234-5670</p>", "OTHER", "default"),
    ("https://x.jp/%E4%BC%9A%E7%A4%BE%E6%A6%82%E8%A6%81", "<dl><dt>設立</dt><dd>1</dd><dt>創業</dt><dd>2</dd><dt>資本金</dt><dd>3</dd><dt>従業員</dt><dd>4</dd></dl>", "COMPANY_PROFILE", "named_table"),
])
def test_page_types_by_rule(url, source, kind, reason):
    assert page_types.page_type(url, None, source)[::2] == (kind, reason)


def test_page_type_of_directories_and_lists():
    assert page_types.page_type("https://x.jp/company", None, FACTS, 12) == ("DIRECTORY_DB", 12, "directory_like")
    assert all(any(s in r.all + r.any + r.none for r in page_types.RULES) for s in page_types.signals("", "", "<table>")[0])
    assert page_types.page_type(None, None, None) == ("OTHER", 0, "default")


def test_candidates_of_every_place():
    c = pages.candidates(None, """<header>本社 03-1111-1111</header><nav>電話 03-2222-2222 <span>資本金</span><span>9円</span></nav>
      <div><span>資本金</span><span>1,000万円</span></div><div><span>設立</span><span>不明</span></div><p>電話番号</p><p>TEL 03-3333-3333 FAX 03-3333-3334</p>
      <img alt="tel 03-4444-4444"><meta itemprop="address" content="東京都港区1"><dl><dt>売上高</dt><dd>公開せず</dd><dt>代表者</dt><dd>http://x.jp/</dd><dt>従業員数</dt><dd>20名</dd></dl>""")
    assert c["phone"][:2] == ["[LABEL]03-3333-3333", "[LABEL][FAX]03-3333-3334"] and "[HEADER][HQ]03-1111-1111" in c["phone"] and "[ATTR]03-4444-4444" in c["phone"]
    assert not any("2222" in x for x in c["phone"]) and c["capital"] == ["[LABEL]1,000万円"] and c["founded"] == c["revenue"] == c["rep"] == []
    assert c["address"] == ["[ATTR]東京都港区1"] and c["employees"] == ["[TABLE]20名"]

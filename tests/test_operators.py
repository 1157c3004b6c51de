from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.operators import classify, match, quality, state
from tideglass.sources import tables
from tideglass.streaming import events


def test_sniffed_csv_skips_what_precedes_the_header(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("広告\n出力日;2024\n会社名,住所,電話番号,備考\nA社,東京都,03-1,x\n,,,\nB社,大阪府,,\n", encoding="utf-8")
    rows = tables.sniffed_csv(spark, str(path))
    assert rows.columns == ["会社名", "住所", "電話番号", "備考"] and rows.count() == 2
    got = tables.aliased(rows).orderBy("company_name").collect()
    assert [(r.company_name, r.address, r.phone, r.homepage) for r in got] == [("A社", "東京都", "03-1", None), ("B社", "大阪府", None, None)]


def test_evolved_adds_casts_and_drops(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("new", T.StringType())])
    out = tables.evolved(spark.createDataFrame([("7", "a", "b")], "id string, keep string, gone string"), schema, ["gone"])
    assert out.columns == ["id", "new", "keep"] and tuple(out.first()) == (7, None, "a")


def test_column_like():
    assert tables.column_like(["homepage"], ["x", "HomePage"]) == "HomePage"
    assert tables.column_like(["phone"], ["tel", "main_phone_no"]) == "main_phone_no"


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "=1+1"), (2, "plain"), (3, None)], "id int, v string")
    tables.to_csv(df, str(tmp_path / "o"))
    back = {r.id: r.v for r in spark.read.csv(str(tmp_path / "o"), header=True, schema="id int, v string").collect()}
    assert back == {1: "'=1+1", 2: "plain", 3: None}


def test_insert_new_with_null_keys(spark):
    t = spark.createDataFrame([("a", "x")], "name string, addr string")
    n = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "b", "y"), (4, "c", None), (5, "c", None)], "id int, name string, addr string")
    assert sorted(r.id for r in match.insert_new(t, n, ["name", "addr"], ["id"]).collect()) == [2, 4, 5]


def test_verdicts(spark):
    facts = spark.createDataFrame([(1, "abc", ["u1", "u2"]), (2, "", ["u1"]), (3, "x", []), (4, "zzz", ["u1"]), (5, "zzz", ["u9"])], "id int, value string, evidence array<string>")
    pages = spark.createDataFrame([("u1", "nothing"), ("u2", "has abc in it")], "url string, text string")
    out = quality.verdicts(facts, pages, ["id"], F.contains(F.col("_text"), F.col("value")))
    got = {r.id: (r.verdict, r.evidence_url) for r in out.collect()}
    assert got == {1: ("verified", "u2"), 2: ("blank", None), 3: ("unknown_no_evidence", None), 4: ("not_found", None), 5: ("fetch_failed", None)}


def test_claims_are_disjoint_and_ordered(spark):
    q = spark.createDataFrame([(i, "pending" if i % 2 else "review", i) for i in range(10)], "id long, status string, employee_count int")
    rows = state.claims(q, 3, state.claim_order("id_asc"), ["review"], 2).collect()
    assert [r.id for r in sorted(rows, key=lambda r: (r.turn, r.worker))] == [1, 3, 5, 7, 9, 0]


def test_crawl_stops_at_its_budget(spark):
    links = spark.createDataFrame([(f"{i}", f"{i * 2 + k}", k) for i in range(1, 20) for k in (0, 1)], "src string, dst string, rank int")
    rows = state.crawl(spark.createDataFrame([("1",)], "root string"), links, pages=6, hops=4).collect()
    assert sorted(r.url for r in rows) == ["1", "2", "3", "4", "5", "6"]


def test_categories(spark):
    cats = spark.createDataFrame([("t", "s", ["aa"], ["b"]), ("t", "u", ["zz"], [])], "top string, sub string, aliases array<string>, keywords array<string>")
    docs = spark.createDataFrame([(1, "aa b"), (2, "none")], "id int, v string")
    out = classify.block_scores(docs, "id", {"description": F.col("v")}, cats).collect()
    assert [(r.id, r["sub"], r.score) for r in out] == [(1, "s", 15)]


def test_streams_equal_batches(spark, sf_dir):
    stream = events.stream(spark, sf_dir)
    got = events.drained(events.tumbling(stream), "tumbling_test")
    batch = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    want = {(r.w.start, r.event_type): r.n for r in batch.collect()}
    rows = got.collect()
    assert rows and all(want[r.window_start, r.event_type] == r.n for r in rows)


def test_messages(spark):
    lines = spark.createDataFrame([('{"company_name": "A", "address": "x"}',), ('{"name": "B", "pref": "p", "city": "c", "employee_count": "12"}',), ("{}",), ("junk",)], "value string")
    assert [tuple(r) for r in events.messages(lines).orderBy("company_name").collect()] == [("A", "x", None), ("B", "pc", 12)]

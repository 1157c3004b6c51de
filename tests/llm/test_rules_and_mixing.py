import random

import pytest

from tests.oracle import same_rows
from tideglass.llm import mixing, quality_rules
from tideglass.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


def _repeat_words(words):
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)})


def test_measures_equal_brute_force(spark):
    rng = random.Random(1)
    texts = ["", " \n\t", None, "a", "a b c a b c", "x\nx\n\nx y", "#$ <é>   w", "one " * 3000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(30)]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = {r.doc_id: r for r in quality_rules.judged(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = rows[i]
        assert (r.n_words, r.word_chars) == (len(words), sum(len(w.decode()) for w in words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == _repeat_words(words)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
        assert r.kept is False or not r.base_failed


def test_rules_read_no_user_functions(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = quality_rules.judged(df)._jdf.queryExecution().toString() + mixing.mix(df.selectExpr("*", "'s' as source"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stage_keeps_rows_as_they_are(spark):
    text = "the cat of that house and the dog by this river was in it " * 1
    good = " ".join(f"{w}{i}" if i % 3 else w for i, w in enumerate((text * 6).split()))
    df = spark.createDataFrame([(1, good, "keep", 5), (2, "short", "go", 6)], "doc_id long, text string, kept string, n_words int")
    assert [tuple(r) for r in quality_rules.stage(spark, df, "").collect()] == [(1, good, "keep", 5)]


def _fill(sizes, weights, cap):
    """Targets by repeated clamping, as the contract words it."""
    total, fixed, left = sum(sizes.values()), {}, dict(sizes)
    while left:
        room = total - sum(fixed.values())
        share = {k: room * weights[k] / sum(weights[j] for j in left) for k in left}
        over = [k for k in left if share[k] > cap * sizes[k]]
        if not over:
            return fixed | share
        for k in over:
            fixed[k] = float(cap * sizes[k])
            del left[k]
    return fixed


def test_targets_equal_repeated_clamping(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 10, 1000, 100000]) * rng.randrange(1, 9) for i in range(rng.randrange(1, 9))}
        weights = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes))}
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = _fill(sizes, weights, 3)
        assert got == pytest.approx(want)


def test_mix_is_near_its_targets_and_repeats(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a", "b", "c", None]) if i % 3 else "a", "x") for i in range(3000)] + [(5000, None, "a", "x"), (5001, "", "b", "x"), (None, "w w", "c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    one, two = (sorted(map(str, mixing.mix(df).collect())) for _ in range(2))
    assert one == two and len(one) == len(rows)
    out = mixing.mix(df).toPandas()
    assert (out.taken <= 3 * out["size"]).all()
    for _, g in out.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0 and quality_rules.judged(docs).count() == 0


def test_mix_keeps_columns_of_any_name(spark):
    names = ["whole", "last", "row", "own", "salt", "salted", "bucket", "part", "rank", "of", "s", "w", "cap", "a b", "repetitions"]
    rows = [(i, "a b c", "s" if i % 2 else None, *([i] * len(names))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` long" for n in names))
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", *names[:-1], "size", "source_size", "target", "repetitions", "taken"]
    assert out.where(" and ".join(f"`{n}` = doc_id" for n in names[:-1])).count() == 20
    assert mixing.mix(df.where("false")).count() == 0


def test_mix_of_many_sources_takes_the_other_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, "w " * (i % 13), f"s{i % 90}") for i in range(600)], "doc_id long, text string, source string")
    want = sorted(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 5)
    assert sorted(map(tuple, mixing.mix(df).collect())) == want
    ranks = {r.source: r.rank for r in mixing._ranked(df.groupBy("source").count()).collect()}
    assert ranks == {k: i for i, k in enumerate(sorted(ranks))}

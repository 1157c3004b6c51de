import itertools
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideglass.llm import language_id, lm_scoring, quality_classifier, toxicity
from tideglass.llm.common import fold
from tideglass.llm.lm_scoring import LM, Model, Network, tail_of, tokens

EDGE = [(None, "the idiot of it"), (901, None), (902, ""), (903, " \n\t"), (904, "1234 !!!"), (905, "x"), (906, "the end " * 9000), (907, "the cat"), (907, "the cat")]


def _model(cfg, texts):
    counts = Counter(w for t in texts for w in tokens(t.encode()))
    tails = np.zeros((cfg.tails, 2), np.int64)
    for w, n in counts.items():
        tails[tail_of(w, cfg.tails)] += (n, 1)
    head = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: cfg.head]
    return Model(head, tails, sum(counts.values()), len(counts), cfg), counts


def test_gradients_equal_differences():
    cfg = LM(hidden=4, near=6, per_class=3, tails=2)
    rng = np.random.default_rng(0)
    net = Network(6, cfg, np.arange(1, 9).astype(float))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    x = np.array([[0, 3], [1, 0], [7, 2], [2, 5]])
    y = rng.integers(0, 8, (4, 2))

    live = (x != 0).astype(float)

    def loss():
        out, _, _ = net.steps(x, np.zeros((2, 4)), live)
        return -net.outputs(out.reshape(-1, 4), y.ravel())[0].sum()

    grads = {k: np.zeros_like(v) for k, v in net.p.items()}
    out, _, kept = net.steps(x, np.zeros((2, 4)), live)
    _, back = net.outputs(out.reshape(-1, 4), y.ravel(), grads)
    net._back(x, kept, back.reshape(out.shape), grads, live)
    for k in ("u", "x", "b", "c", "w", "wb", "cb"):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in net.p[k].shape)
            keep = net.p[k][at]
            net.p[k][at] = keep + 1e-5
            hi = loss()
            net.p[k][at] = keep - 1e-5
            lo = loss()
            net.p[k][at] = keep
            assert (hi - lo) / 2e-5 == pytest.approx(grads[k][at], rel=1e-3, abs=1e-4)


def test_units_classes_are_a_table_of_short_integers():
    net = Network(6, LM(hidden=4, per_class=2, tails=3), np.arange(9, 0, -1).astype(float))
    assert net.class_of.dtype == np.int16  # sorted by radix
    assert net.class_of.tolist() == [*net.of, *range(net.near_classes, net.near_classes + 3)]


def test_probabilities_sum_to_one():
    cfg = LM(hidden=8, near=5, per_class=2, tails=3, head=8)
    model, counts = _model(cfg, ["a b c d e f g", "a a b c zz yy xx ww vv", "q w e r t y"])
    state = np.random.default_rng(1).normal(size=(1, 8)).astype(np.float32)
    total = 0.0
    for w, n in counts.items():
        unit, at, _ = model.encoded([w])
        p = model.net.outputs(state, unit)[0][0]
        if unit[0] >= model.near:
            p += math.log(n + 1) - math.log(model.tail_mass[unit[0] - model.near])
        total += math.exp(p)
    for t in range(cfg.tails):
        p = model.net.outputs(state, np.array([model.near + t]))[0][0]
        total += math.exp(p - math.log(model.tail_mass[t]))
    assert total == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows():
    cfg = LM(hidden=8, near=20, per_class=5, tails=4)
    model, _ = _model(cfg, ["a b c d e f g h i j " * 30])
    texts = [model.encoded(tokens(("a b c d e f g h i j " * n).encode()))[0] for n in (1, 7, 30)]
    whole = model.net.scored(texts, 0, window=10_000)
    assert model.net.scored(texts, 0, window=7, lanes=2) == pytest.approx(whole, rel=1e-4)


def test_short_texts_share_lanes_beside_a_long_one():
    cfg = LM(hidden=8, near=20, per_class=5, tails=4)
    model, _ = _model(cfg, ["a b c d e f g h i j " * 30])
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, len(model.net.p["x"]), n).astype(np.int32) for n in (900, *rng.integers(1, 40, 120), 1)]
    steps, done = model.net.steps, []
    model.net.steps = lambda units, *a, **k: done.append(units.shape) or steps(units, *a, **k)
    together = model.net.scored(texts, 0, lanes=8, window=16)
    # Lanes go on with other texts: no more steps than the longest text's, and few empty places.
    assert sum(t for t, _ in done) == 900 and sum(t * n for t, n in done) < 1.2 * sum(map(len, texts))
    assert together == pytest.approx([model.net.scored([x], 0)[0] for x in texts], rel=1e-4)


def test_columns_are_read_at_once_like_their_words(monkeypatch):
    odd = ["the idiot of it", "  Lead", "trail \n", "", " ", None, "a\x0b\x0cb\rC\td\n", "É ÀB \x85x\u3000y z", "\x1c\x1da\x00b", "... a. ?! ab,; zz zz", "x" * 3000, "zz b zz.", "zz b zz."]
    texts = [t and t.encode() for t in odd] + [b"\xff\xfe a \xe9Q"]  # the last one isn't UTF-8
    words = [tokens(t)[:-1] for t in texts]
    cfg = LM(hidden=4, near=3, per_class=2, tails=5, head=6)
    counts = Counter(w for some in words for w in [*some, b" "])
    tails = np.zeros((cfg.tails, 2), np.int64)
    for w, n in counts.items():
        tails[tail_of(w, cfg.tails)] += (n, 1)
    model = Model(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: cfg.head], tails, sum(counts.values()), len(counts), cfg)
    held = model.words.to_pylist()
    monkeypatch.setattr(lm_scoring, "tokens", None)  # no text is parted word by word in Python

    column = pa.array([b"before it", *texts], pa.binary()).slice(1)
    got, bounds = lm_scoring.words_of(column)
    assert [got.to_pylist()[lo:hi] for lo, hi in itertools.pairwise(bounds.tolist())] == words
    assert lm_scoring.tails_of(got, 5).tolist() == [tail_of(w, 5) for some in words for w in some]
    unit = {w: int(model.unit[held.index(w)]) if w in held else model.near + tail_of(w, 5) for w in counts}
    assert [x.tolist() for x in model.texts(column)] == [[unit[w] for w in some] + [0] for some in words]
    n, known, base, score, rest = model.scored(column)
    assert n.tolist() == [len(some) + 1 for some in words]
    assert known.tolist() == [1 + sum(w in held for w in some) for some in words]
    assert base == pytest.approx([sum(math.log(counts[w] + 1) for w in [*some, b" "] if w in held) for some in words])
    assert [{x["word"]: x["times"] for x in r} for r in rest.to_pylist()] == [Counter(w for w in some if w not in held) for some in words]
    each = [model.net.scored([x], 0)[0] for x in model.texts(column)]
    inner = [sum(model.inner[held.index(w)] if w in held else -math.log(model.tail_mass[tail_of(w, 5)]) for w in some) for some in words]
    assert score == pytest.approx(np.add(each, inner), rel=1e-5)
    assert [len(x) for x in model.scored(column.slice(0, 0))] == [0] * 5


def test_outputs_are_equal_in_blocks_of_any_size(monkeypatch):
    rng, cfg = np.random.default_rng(2), LM(hidden=4, near=6, per_class=2, tails=3)
    net = Network(6, cfg, np.arange(9, 0, -1).astype(float))
    states, target = rng.normal(size=(5, 3, 4)), rng.integers(0, 9, 15)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    told = []
    for block in (4, 512):
        monkeypatch.setattr(lm_scoring, "BLOCK", block)
        for scale in (1, 1e4):  # the second overflows exp
            grads = {k: np.zeros_like(x) for k, x in net.p.items()}
            score, back = net.outputs(scale * states, target, grads)
            assert np.isfinite(score).all() and back.shape == states.shape
            told.append([score, back, *grads.values()])
    for a, b in zip(told[:2], told[2:], strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == pytest.approx(y)


def test_lm_query(spark, sf_dir):
    out = lm_scoring.op1_lm_scoring(spark, sf_dir).toPandas()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    held = {i: crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, t in docs.items() if not held[i] for w in (t or "").encode().lower().split() + [b" "])
    n, v = sum(counts.values()), len(counts)
    assert len(out) == len(docs) and (out.train_tokens == n).all()
    for r in out.itertuples():
        words = (docs[r.doc_id] or "").encode().lower().split() + [b" "]
        assert (r.held_out, r.n_tokens, r.n_known) == (held[r.doc_id], len(words), sum(w in counts for w in words))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
    h = out[out.held_out]
    assert h.score.sum() > h.base_score.sum() and (h.score > h.base_score).mean() > 0.9


def test_lm_edges(spark):
    df = spark.createDataFrame([*EDGE, *((i, f"some words to learn from number {i}") for i in range(40))], "doc_id long, text string").withColumn("score", F.lit("x"))
    cfg = LM(near=10, per_class=5, head=12, tails=4)
    model, counts = lm_scoring.fitted(df, cfg)
    out = lm_scoring.scored(df, model, counts).toPandas()
    assert len(out) == df.count() and out.score.notna().all() and (out.n_known <= out.n_tokens).all()
    assert out[out.doc_id == 907].score.nunique() == 1 and (out[out.doc_id == 902].n_tokens == 1).all()
    model, counts = lm_scoring.fitted(df.where("false"), cfg)
    assert lm_scoring.scored(df, model, counts).where("n_known > 0").count() == 0


def test_lm_learns_from_all_texts(spark):
    # No text fits the room of the first sample.
    df = spark.createDataFrame([(i, "a b c d e f g h " * 12) for i in range(400)], "doc_id long, text string")
    model, counts = lm_scoring.fitted(df, LM(near=10, per_class=5, head=12, tails=4, fit_tokens=1, rate=0.1))
    r = lm_scoring.scored(df, model, counts).first()
    assert r.score - r.base_score > 0.2 * r.n_tokens


def _folds(name, parts, out):
    assert {(r.doc_id, r.held_out) for r in out.itertuples()} == {(i, crc32(str(i).encode()) % parts == name) for i in out.doc_id}


def test_quality_held_out(spark, sf_dir):
    out = quality_classifier.op8_quality_classifier(spark, sf_dir).toPandas()
    _folds(1, 3, out)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    j = out.merge(labels, on="doc_id")
    j = j[j.held_out]
    assert (j.predicted == j.quality).mean() > 0.93 and out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()


def test_density_equals_plain_formula():
    rng = np.random.default_rng(0)
    d = len(quality_classifier.FEATURES)
    parts = {k: (50, rng.normal(size=d), np.cov(rng.normal(size=(d, 60)))) for k in (0, 1)}
    cfg = quality_classifier.Discriminant(0.2, 0.1, 1.0)
    x = rng.normal(size=(5, d))
    pooled = (parts[0][2] + parts[1][2]) / 2
    scale = np.sqrt(np.diag(pooled))
    logs = []
    for k in (0, 1):
        cov = (0.8 * parts[k][2] + 0.2 * pooled) / np.outer(scale, scale)
        cov = 0.9 * cov + 0.1 * np.trace(cov) / d * np.eye(d)
        z = (x - parts[k][1]) / scale
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    assert quality_classifier.Scorer(parts, cfg)(x) == pytest.approx(1 / (1 + np.exp(-(logs[1] - logs[0]))))


@pytest.mark.parametrize("classified", [quality_classifier.classified, toxicity.classified])
def test_classifier_edges(spark, classified):
    docs = spark.createDataFrame([*EDGE, *((i, f"plain text number {i} of them. It goes on." if i % 2 else "you idiot! you idiot! bad idiot.") for i in range(60))], "doc_id long, text string").withColumn("label", F.lit("own"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (901, 0), (902, 1)], "doc_id long, label int")
    for some in (labels, labels.where("label = 1"), labels.where("false")):
        out = classified(docs, some, F.lit(True)).toPandas()
        assert len(out) == docs.count() and out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    assert classified(docs.where("false"), labels, F.lit(True)).count() == 0


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + ("idiot. " if i % 2 else "fine. ") * 3) for i in range(80)], "doc_id long, text string")
    learn = fold(F.col("doc_id"), 5) != 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, label int")
    turned = labels.withColumn("label", F.when(learn, F.col("label")).otherwise(1 - F.col("label")))
    for classified in (quality_classifier.classified, toxicity.classified):
        a, b = (sorted((r.doc_id, round(r.score, 9)) for r in classified(docs, x, learn).collect()) for x in (labels, turned))
        assert a == b


def test_toxicity_held_out(spark):
    out = toxicity.op9_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    _folds(0, 5, out)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    j = out.merge(labels, on="doc_id")
    j = j[j.held_out]
    caught, flagged = j[j.toxic == 1].predicted.mean(), j[j.predicted == 1].toxic.mean()
    assert caught > 0.88 and flagged > 0.95


def test_naming_a_group_is_worth_nothing():
    rows = [(1, f"those women are idiot scum number {i}. The day was fine.".encode()) for i in range(60)] + [(0, f"the day was fine, number {i}. All went well.".encode()) for i in range(60)]
    for weight in (0.0, 5.0):
        scorer = toxicity.fit(rows, toxicity.Toxic(counterfactual=weight))
        own, twin = scorer.sentence([b"those", b"women", b"are", b"here"]), scorer.sentence([b"those", b"men", b"are", b"here"])
        if weight:
            assert abs(own - twin) < 0.5
            assert scorer.text(b"The women met the men there.") < 0.5 < scorer.text(b"You idiot scum. idiot scum again.")
        else:
            loose = abs(own - twin)
    assert abs(own - twin) < loose


def test_toxic_gradients_equal_differences():
    rng = np.random.default_rng(2)
    cells = [sorted(rng.choice(7, rng.integers(0, 5), replace=False).tolist()) for _ in range(12)]
    rest = toxicity.Sentences(cells, [(3, [0, 2]), (5, [6]), (9, [])], 7, toxicity.Toxic(ridge=0.1, counterfactual=2.0))
    w, bias, label, weight = rng.normal(size=7), 0.3, rng.integers(0, 2, 12).astype(float), rng.random(12)
    _, gw, gb = rest.loss(w, bias, label, weight)
    for j in range(7):
        step = np.eye(7)[j] * 1e-6
        assert (rest.loss(w + step, bias, label, weight)[0] - rest.loss(w - step, bias, label, weight)[0]) / 2e-6 == pytest.approx(gw[j], abs=1e-6)
    assert (rest.loss(w, bias + 1e-6, label, weight)[0] - rest.loss(w, bias - 1e-6, label, weight)[0]) / 2e-6 == pytest.approx(gb, abs=1e-6)


def test_a_twin_names_another_group():
    lines = [line.split() for line in toxicity.IDENTITY.split("\n") if line]
    words = [w for line in lines for w in line]
    assert len(words) == len(set(words)) and all(len(line) > 1 for line in lines)
    assert toxicity.swapped([b"the", b"women", b"and", b"jews"]) == [b"the", b"men", b"and", b"hindus"] and toxicity.swapped([b"the"]) is None


def test_words_of_a_spliced_text_are_labelled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    train = docs.where((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull())
    tagger = language_id.fitted(train)
    held = [r for r in docs.where((fold(F.col("doc_id"), 4) == 2) & F.col("lang").isNotNull()).orderBy("doc_id").collect() if len(language_id.words_of(r.text)) >= 60]
    assert len(tagger.langs) > 1 and np.abs(tagger.start).max() > 0
    rows, want = [], []
    for a in held[:40]:
        b = next(x for x in held if x.lang != a.lang)
        rows.append((len(rows), " ".join([*language_id.words_of(a.text)[:30], *language_id.words_of(b.text)[:30]])))
        want.append([a.lang] * 30 + [b.lang] * 30)
    got = {r.doc_id: r.runs for r in language_id.tagged(spark.createDataFrame([*rows, (900, None), (901, "12 !")], "doc_id long, text string"), tagger).collect()}
    assert got[900] == got[901] == []
    right = 0
    for i, tags in enumerate(want):
        labels = [r.lang for r in got[i] for _ in range(r.words)]
        assert [r.first for r in got[i]] == np.cumsum([0, *(r.words for r in got[i])])[:-1].tolist() and len(labels) == 60
        right += sum(x == y for x, y in zip(labels, tags, strict=True))
    assert right > 0.95 * 60 * len(want)


def test_forward_backward_equals_enumeration():
    cfg = language_id.Field()
    tagger = language_id.Tagger(["a", "b", "c"], {}, cfg)
    rng = np.random.default_rng(0)
    tagger.trans = rng.normal(size=(3, 3)).astype(np.float32)
    e = rng.normal(size=(4, 2, 3)).astype(np.float32)
    live = np.array([4, 3])
    gamma, pairs, partition = tagger.marginals(e, live)
    expected = np.zeros((3, 3))
    for lane, n in enumerate(live):
        weights, total = np.zeros((n, 3)), 0.0
        moves = np.zeros((3, 3))
        for tags in itertools.product(range(3), repeat=int(n)):
            w = math.exp(sum(e[i, lane, t] for i, t in enumerate(tags)) + sum(tagger.trans[a, b] for a, b in itertools.pairwise(tags)))
            total += w
            for i, t in enumerate(tags):
                weights[i, t] += w
            for a, b in itertools.pairwise(tags):
                moves[a, b] += w
        expected += moves / total
        assert gamma[:n, lane] == pytest.approx(weights / total, abs=1e-5)
        assert partition[lane] == pytest.approx(math.log(total), abs=1e-4)
    assert pairs == pytest.approx(expected, abs=1e-4)


def test_language_held_out(spark, sf_dir):
    out = language_id.op10_language_id(spark, sf_dir).toPandas()
    _folds(2, 4, out)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").toPandas()
    j = out.merge(docs, on="doc_id")
    assert (j[j.held_out].lang == j[j.held_out].lang_pred).mean() > 0.98 and out.score.between(0, 1).all()


def test_language_edges_and_switching(spark):
    rows = [(i, "the house of that man and his dog was here", "en") for i in range(40)] + [(100 + i, "der hund und das haus von dem mann ist nicht hier", "de") for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tagger = language_id.fitted(train)
    docs = spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("lang_pred", F.lit("x"))
    out = {r.doc_id: r for r in language_id.identified(docs, tagger).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (901, 902, 903, 904)) and out[907].lang_pred == "en"
    share = tagger.shares([language_id.words_of("the house of that man was here der hund und das haus von dem mann")])[0][0]
    assert 0.2 < share[0] < 0.8
    assert {r.lang_pred for r in language_id.identified(docs, language_id.fitted(train.where("false"))).collect()} == {"und"}

import itertools
import random
import re
import time
from collections import Counter

from tideglass.llm import common, minhash_dedup, substring_dedup
from tideglass.llm.common import components
from tideglass.llm.minhash_dedup import Near


def _brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def _corpus(n=260):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(20, 120))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w).upper() if i % 5 == 0 else "  ".join(w)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One  TWO"), (1005, "x"), (1006, "very long " * 4000)]


def test_components_equal_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, node string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(df, Near(shingle=4)).collect()}
    assert got == _brute(rows, 4, 80)


def test_stars_and_the_exact_rest_agree(spark):
    rows = _corpus(160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for near in (Near(shingle=4, stars=0, block=7), Near(shingle=4, stars=2, block=5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(df, near).collect()}
        assert got == _brute(rows, 4, 80)


def test_documents_equal_brute_force(spark, sf_dir):
    """The registered query on the whole table, against links found by an index of every shingle."""
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.op2_minhash_dedup(spark, sf_dir).collect()}
    sets, posts, root = {}, {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
        for s in sets[i]:
            posts.setdefault(s, []).append(i)

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for i, own in sets.items():
        shared = Counter(j for s in own for j in posts[s] if j > i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "q w e r t y u"), (1, "a b c d e f")], "doc_id long, text string")
    out = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or -1, r.kept) for r in minhash_dedup.near_duplicates(df).collect())
    assert out == [(False, 1, 1, True), (False, 1, 1, True), (False, 3, 1, False), (False, 3, 1, False), (True, 0, -1, True)]
    assert minhash_dedup.near_duplicates(df.where("false")).count() == 0


def test_components_of_chains_and_stars(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 70), (80, 81)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = {i: 0 for i in range(61)} | {70: 0, 80: 80, 81: 80} | {1000 + i: 1000 for i in range(50)}
    assert got == want
    monkeypatch.setattr(common, "FEW", 0)
    assert {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_task_may_pass_on_stars_before_its_end(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r.a, r.b) for r in common._joined_here(edges, 120).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.root for r in components(spark.createDataFrame(sorted(got), "a long, b long")).collect()} == {0} and len(got) >= 500


def test_stage_keeps_one_of_each_group(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", "k"), (2, "a b c d e f g", "k"), (3, "other text of words here", "k"), (4, None, "k")], "doc_id long, text string, links string")
    out = minhash_dedup.stage(spark, df, "")
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def _removed(rows, spans):
    """Sentences of each text covered by a run whose first occurrence is elsewhere."""
    seen, gone = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        parts = substring_dedup.sentences((t or "").encode(), spans)
        for a, b in substring_dedup.runs(parts, spans):
            key = b" ".join(b" ".join(w) for _, _, w in parts[a:b])
            if seen.setdefault(key, (i, a)) != (i, a):
                gone.setdefault(i, set()).update(range(a, b))
    return {i: len(v) for i, v in gone.items()}


def test_spans_equal_brute_force(spark):
    rng = random.Random(5)
    sents = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 15))).capitalize() + rng.choice(".!?") for _ in range(40)]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(sents) for _ in range(rng.randrange(0, 25)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "word " * 5000), (503, "no end")]
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, n_removed int")
    spans = substring_dedup.Spans(2, 12, 8)
    out = {r.doc_id: r for r in substring_dedup.without_repeats(df, spans).collect()}
    want = _removed(rows, spans)
    assert len(out) == len(rows)
    for i, t in rows:
        assert out[i].n_removed == want.get(i, 0)
        if not want.get(i):
            assert out[i].text == t


def _split(text):
    """Words of each sentence, read letter by letter."""
    blanks, out, words, word, at = " \t\n\x0b\x0c\r", [], [], "", 0
    while at < len(text):
        if text[at] not in blanks:
            word += text[at].lower()
            at += 1
            continue
        gap = at
        while at < len(text) and text[at] in blanks:
            at += 1
        if word:
            words.append(word)
        if "\n" in text[gap:at] or word[-1:] in (".", "!", "?"):
            out.append(words)
            words = []
        word = ""
    out.append(words + [word] * bool(word))
    return [w for w in out if w]


def test_sentences_are_split_as_read_letter_by_letter():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("abC .!?\n\t  ") for _ in range(rng.randrange(0, 60)))
        assert [[w.decode() for w in ws] for _, _, ws in substring_dedup.sentences(text.encode())] == _split(text)


def test_parts_of_many_texts_are_read_together():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abC .!?\n\t  é") for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts[::7] = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 60))) for _ in texts[::7]]
    texts = [t.encode() for t in [*texts, "", " \n", "x"]]
    spans = substring_dedup.Spans(2, 6, 4)
    parts = substring_dedup._Parts(texts, spans)
    i, j = substring_dedup._runs(parts.word, parts.opens, parts.bounds, lambda at: parts.joined(at, at + 1), spans)
    found = list(zip(i.tolist(), j.tolist(), parts.joined(i, j), strict=True))
    for text, lo, hi in zip(texts, parts.bounds.tolist(), parts.bounds[1:].tolist(), strict=False):
        one = substring_dedup.sentences(text, spans)
        assert [(a, b) for a, b, _ in one] == list(zip(parts.start[lo:hi].tolist(), parts.end[lo:hi].tolist(), strict=True))
        assert all(text[a:b].lower().split() == w for a, b, w in one)
        want = [(a, b, b" ".join(b" ".join(w) for _, _, w in one[a:b])) for a, b in substring_dedup.runs(one, spans)]
        assert [(a - lo, b - lo, w) for a, b, w in found if lo <= a < hi] == want


def test_a_megabyte_of_blanks_takes_linear_time():
    began = time.perf_counter()
    assert len(substring_dedup.sentences(b"one. " + b" " * 1_000_000 + b"two\n" + b"\n \t" * 300_000 + b"x")) == 3
    assert time.perf_counter() - began < 1.5


def test_a_repeated_passage_stays_once(spark):
    passage = " ".join(f"Sentence {i} holds quite a few words of its own." for i in range(8))
    df = spark.createDataFrame([(i, f"Start {i} unique words here. {passage} Close {i} also unique.") for i in range(5)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in substring_dedup.without_repeats(df).collect()}
    assert sum("Sentence 4 holds" in t for t in texts.values()) == 1 and "Sentence 4 holds" in texts[0]
    assert all(f"Start {i} unique" in t and f"Close {i} also" in t for i, t in texts.items())


def test_repeats_within_one_text_and_equal_rows(spark):
    line = "The same long line of ten words comes again here. And a second sentence with ten more words follows it. "
    df = spark.createDataFrame([(1, line * 3), (1, line * 3)], "doc_id long, text string")
    out = substring_dedup.without_repeats(df).collect()
    assert len(out) == 2 and out[0].text == out[1].text and out[0].text.count("second sentence") == 1
    assert substring_dedup.without_repeats(df.where("false")).count() == 0


def test_a_passage_without_stops_goes_wherever_it_begins(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    front = lambda k: " ".join(f"u{rng.randrange(10**9)}" for _ in range(k))
    df = spark.createDataFrame([(i, f"{front(40 + i)} {passage} {front(40)}") for i in range(17)], "doc_id long, text string")
    for r in substring_dedup.without_repeats(df).collect():
        left = [w for w in r.text.split() if w[0] == "p"]
        assert len(left) == 60 if r.doc_id == 0 else len(left) <= 2 * (8 - 1)
        assert sum(w[0] == "u" for w in r.text.split()) == 80 + r.doc_id


def test_runs_equal_all_runs_of_whole_sentences(spark):
    rng = random.Random(7)
    sents = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 15))) + rng.choice(".!?") for _ in range(60)]
    rows = [(i, [rng.choice(sents) for _ in range(rng.randrange(0, 25))]) for i in range(60)]
    for i in range(60, 120):
        of = rng.choice(rows[:60])[1]
        a = rng.randrange(0, len(of) + 1)
        rows.append((i, [f"u{i} one.", *of[a : a + rng.randrange(2, 9)], *([f"v{i} two."] if i % 3 else [])]))
    want, seen = {}, {}
    for i, parts in rows:
        for a, b in itertools.combinations(range(len(parts) + 1), 2):
            words = " ".join(parts[a:b]).split()
            if b - a >= 2 and len(words) >= 20 and seen.setdefault(tuple(words), (i, a)) != (i, a):
                want.setdefault(i, set()).update(range(a, b))
    df = spark.createDataFrame([(i, " ".join(p)) for i, p in rows], "doc_id long, text string")
    for r in substring_dedup.without_repeats(df).collect():
        parts, gone = dict(rows)[r.doc_id], want.get(r.doc_id, set())
        assert r.text.split() == " ".join(p for k, p in enumerate(parts) if k not in gone).split() and r.n_removed == len(gone)

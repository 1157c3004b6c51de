"""Language identification of code-switched text by a linear-chain conditional random field over words.

A word's emission scores come from hashed character n-grams with boundary marks
(the affixes are those that hold a mark) and from a lexicon of the languages'
frequent words; transitions are learnt. Training sequences are windows of
labelled texts, some of them spliced from two languages. Forward-backward gives
each word's marginals, whose sums over a whole text decide its language; the
likeliest language of each word gives the runs that a text switches between.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fitted_from, fold, sliced, table

_LETTERS = re.compile(r"[^\W\d_]+")
NONE = "und"


@dataclass(frozen=True)
class Field:
    #: Windows of each language that it is fitted on at most: those of least seeded hash among all windows of all its labelled texts.
    per_language: int = 2500
    grams: tuple[int, ...] = (1, 2, 3, 4)
    buckets: int = 1 << 16
    lexicon: int = 300
    length: int = 24
    batch: int = 96
    epochs: int = 3
    switch: float = 0.3
    rate: float = 0.15
    ridge: float = 1e-6
    seed: int = 13


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _LETTERS.findall(text.lower()) if text else []


class Features:
    """Hashed n-grams of words, as flat bucket numbers with each word's first place."""

    def __init__(self, lexicon: dict[str, int], cfg: Field):
        self.lexicon, self.cfg = lexicon, cfg

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cfg = self.cfg
        points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        owner = np.repeat(np.arange(len(words)), sizes)
        last = np.cumsum(sizes)[owner]
        at, found, of = np.arange(len(points)), [], []
        for n in cfg.grams:
            ok = at[: max(0, len(at) - n + 1)]
            ok = ok[ok + n <= last[ok]]
            code = np.full(len(ok), n, np.uint64)
            for i in range(n):
                code = (code ^ points[ok + i]) * np.uint64(0x9E3779B97F4A7C15)
                code ^= code >> np.uint64(29)
            found.append((code % np.uint64(cfg.buckets)).astype(np.int64))
            of.append(owner[ok])
        lex = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        some = np.flatnonzero(lex >= 0)
        found.append(lex[some] + cfg.buckets)
        of.append(some)
        found, of = np.concatenate(found), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        return found[order], np.searchsorted(of[order], np.arange(len(words)))


class Tagger:
    def __init__(self, langs: list[str], lexicon: dict[str, int], cfg: Field):
        self.langs, self.cfg, self.features = langs, cfg, Features(lexicon, cfg)
        k = len(langs)
        self.w = np.zeros((cfg.buckets + len(lexicon), k), np.float32)
        self.trans = (np.eye(k) * 2.0).astype(np.float32)
        self.start = np.zeros(k, np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores (words x languages), the mean over a word's features times the root of their number."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for lo in range(0, len(words), 100_000):
            some = words[lo : lo + 100_000]
            found, first = self.features.of(some)
            n = np.diff(np.append(first, len(found)))
            out[lo : lo + len(some)] = np.add.reduceat(self.w[found], first, axis=0) / np.sqrt(n)[:, None]
        return out

    def marginals(self, e: np.ndarray, live: np.ndarray):
        """Forward-backward over ``e`` (time x lanes x languages); lane j has ``live[j]`` words, lanes by falling length.

        Returns marginals and, for learning, expected transitions and log partition.
        """
        steps, lanes, k = e.shape
        top = e.max(axis=2, keepdims=True)
        p, t = np.exp(e - top), np.exp(self.trans)
        width = [int(np.searchsorted(-live, -i, side="left")) for i in range(steps)]
        alpha, scale = np.zeros_like(p), np.ones((steps, lanes), np.float32)
        a = np.exp(self.start) * p[0]
        for i in range(steps):
            n = width[i]
            if i:
                a = (alpha[i - 1, :n] @ t) * p[i, :n]
            s = a.sum(axis=1)
            scale[i, :n] = s
            alpha[i, :n] = a / s[:, None]
        beta = np.ones((lanes, k), np.float32)
        gamma = np.zeros_like(p)
        gamma[steps - 1, : width[-1]] = alpha[steps - 1, : width[-1]]
        pairs = np.zeros((k, k))
        for i in range(steps - 1, 0, -1):
            n = width[i]
            v = p[i, :n] * beta[:n] / scale[i, :n, None]
            pairs += (alpha[i - 1, :n].T @ v) * t
            beta[:n] = v @ t.T
            m = width[i - 1]
            gamma[i - 1, :m] = alpha[i - 1, :m] * beta[:m]
        partition = np.log(scale).sum(axis=0) + np.where(np.arange(steps)[:, None] < live, top[..., 0], 0).sum(axis=0)
        return gamma, pairs, partition

    def fit(self, texts: list[tuple[int, list[str]]]) -> None:
        """AdaGrad on the conditional likelihood of windows, some spliced from two languages."""
        cfg, k, rng = self.cfg, len(self.langs), np.random.default_rng(self.cfg.seed)
        index = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in texts for w in ws))}
        if not index or k < 2:
            return
        found, first = self.features.of(list(index))
        count = np.diff(np.append(first, len(found)))
        coded = [(y, np.array([index[w] for w in ws])) for y, ws in texts if ws]
        by_lang = [[x for y, x in coded if y == j] for j in range(k)]
        windows = [(y, x[i : i + cfg.length]) for y, x in coded for i in range(0, len(x), cfg.length)]
        share = np.bincount([y for y, _ in windows], minlength=k)
        sw, st, ss = np.full(self.w.shape, 1e-2, np.float32), np.full((k, k), 1e-2, np.float32), np.full(k, 1e-2, np.float32)
        for _ in range(cfg.epochs):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), cfg.batch):
                some = []
                for j in order[lo : lo + cfg.batch]:
                    y, x = windows[j]
                    tags = np.full(len(x), y)
                    if rng.random() < cfg.switch:
                        z = int(rng.integers(k))
                        if by_lang[z]:
                            other = by_lang[z][int(rng.integers(len(by_lang[z])))][: cfg.length // 2]
                            x = np.concatenate([x[: cfg.length - len(other)], other])
                            tags = np.concatenate([tags[: cfg.length - len(other)], np.full(len(other), z)])
                    some.append((x, tags))
                some.sort(key=lambda v: -len(v[0]))
                live = np.array([len(x) for x, _ in some])
                ids = np.zeros((live[0], len(some)), np.int64)
                gold = np.zeros((live[0], len(some)), np.int64)
                for j, (x, tags) in enumerate(some):
                    ids[: len(x), j], gold[: len(x), j] = x, tags
                here = np.arange(live[0])[:, None] < live
                used, back = np.unique(ids, return_inverse=True)
                cells = np.concatenate([np.arange(first[i], first[i] + count[i]) for i in used])
                starts = np.concatenate([[0], np.cumsum(count[used])[:-1]])
                e = np.add.reduceat(self.w[found[cells]], starts, axis=0) / np.sqrt(count[used])[:, None]
                gamma, pairs, _ = self.marginals(e[back.reshape(ids.shape)], live)
                # Languages weigh alike, however many words teach each.
                weight = (share.sum() / (k * np.maximum(share, 1)))[gold][..., None].clip(0.2, 5)
                g = (gamma - np.eye(k)[gold]) * here[..., None] * weight
                word = np.zeros((len(used), k))
                np.add.at(word, back.ravel(), g.reshape(-1, k))
                word /= np.sqrt(count[used])[:, None]
                gw = np.zeros_like(self.w)
                np.add.at(gw, found[cells], np.repeat(word, count[used], axis=0).astype(np.float32))
                both = here[1:]
                seen = np.zeros((k, k))
                np.add.at(seen, (gold[:-1][both], gold[1:][both]), 1)
                gt = ((pairs - seen) / len(some)).astype(np.float32)
                rows = np.flatnonzero(np.abs(gw).sum(axis=1))
                sw[rows] += gw[rows] ** 2
                self.w[rows] -= cfg.rate * (gw[rows] / np.sqrt(sw[rows]) + cfg.ridge * self.w[rows])
                st += gt**2
                self.trans -= cfg.rate * gt / np.sqrt(st)
                gs = (gamma[0] - np.eye(k)[gold[0]]).mean(axis=0).astype(np.float32)
                ss += gs**2
                self.start -= cfg.rate * gs / np.sqrt(ss)

    def shares(self, texts: list[list[str]], lanes: int = 512) -> tuple[np.ndarray, list[np.ndarray]]:
        """Mean marginal of each language over each whole text (texts x languages), and the likeliest language of each word."""
        k = len(self.langs)
        out, tags = np.zeros((len(texts), k)), [np.zeros(0, np.int64)] * len(texts)
        index: dict[str, int] = {}
        coded = [np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int32, len(ws)) for ws in texts]
        e = self.emissions(list(index)) if index else np.zeros((1, k), np.float32)
        order = [i for i in np.argsort([-len(x) for x in coded], kind="stable") if len(coded[i])]
        for lo in range(0, len(order), lanes):
            some = order[lo : lo + lanes]
            live = np.array([len(coded[i]) for i in some])
            step = max(1, 2_000_000 // int(live[0]))  # lanes of very long texts are few
            for at in range(0, len(some), step):
                part, size = some[at : at + step], live[at : at + step]
                ids = np.zeros((size[0], len(part)), np.int32)
                for j, i in enumerate(part):
                    ids[: size[j], j] = coded[i]
                gamma = self.marginals(e[ids], size)[0]
                out[part] = gamma.sum(axis=0) / size[:, None]
                best = gamma.argmax(axis=2)
                for j, i in enumerate(part):
                    tags[i] = best[: size[j], j]
        return out, tags


def _windows(train: DataFrame, cfg: Field) -> DataFrame:
    """(lang, at, words): of each language's labelled texts, wherever in them, about ``per_language`` or more windows of least hash ``at``.

    The rate comes from the language's bytes: about one window in as many as it has is let through where it has many.
    """
    filled = train.where("length(text) > 0 and lang is not null").select("lang", F.col("text").cast("string").alias("text"))
    sizes = {r[0]: r[1] for r in filled.groupBy("lang").agg(F.sum(F.octet_length("text"))).collect()}
    rates = {k: min(1.0, 3.0 * cfg.per_language * cfg.length * 6 / n) for k, n in sizes.items()}

    def run(batches):
        for batch in batches:
            langs, hashes, words = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words_of(text)
                for i in range(0, len(ws), cfg.length):
                    part = " ".join(ws[i : i + cfg.length])
                    at = xxhash.xxh3_64_intdigest(part.encode(), cfg.seed) >> 1
                    if at < rates[lang] * 2**63:
                        langs.append(lang)
                        hashes.append(at)
                        words.append(part)
            yield fields(lang=pa.array(langs, pa.string()), at=pa.array(hashes, pa.int64()), words=pa.array(words, pa.string()))

    return filled.mapInArrow(run, "lang string, at long, words string").distinct()


def fitted(train: DataFrame, cfg: Field = Field()) -> Tagger:
    """A tagger learnt from ``train(text, lang)``; every labelled text is read whole, each of its windows is as likely to teach, repeated ones teach once."""

    def make(rows):
        langs = sorted({r[0] for r in rows})
        texts = [(langs.index(k), ws.split(" ")) for lang in langs for k, _, ws in [r for r in rows if r[0] == lang][: cfg.per_language]]
        seen = [Counter() for _ in langs]
        for y, ws in texts:
            seen[y].update(ws)
        lexicon = {w: i for i, w in enumerate(dict.fromkeys(w for c in seen for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: cfg.lexicon]))}
        tagger = Tagger(langs, lexicon, cfg)
        tagger.fit(texts)
        return tagger

    return fitted_from(_windows(train, cfg), make)


def _runs(tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and lengths of the runs of equal tags."""
    first = np.flatnonzero(np.diff(tags, prepend=-1))
    return first, np.diff(np.append(first, len(tags)))


def tagged(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, runs) of every row of ``docs(doc_id, text)``: the runs of words of one language, each with ``lang``, ``first`` (word) and ``words``.

    A word is a run of letters. A null text, one without a letter and every text
    where no language was learnt have no runs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        tagger = shared.value
        for batch in sliced(batches, 1):
            texts = [words_of(x) for x in batch.column(1).to_pylist()]
            tags = tagger.shares(texts)[1] if tagger.langs else [np.zeros(0, np.int64)] * len(texts)
            rows = [[{"lang": tagger.langs[t[f]], "first": int(f), "words": int(n)} for f, n in zip(*_runs(t), strict=True)] for t in tags]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
            yield fields(doc_id=batch.column(0), runs=pa.array(rows, kind))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, runs array<struct<lang: string, first: long, words: long>>")


def identified(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, lang_pred, score, n_runs) of every row of ``docs(doc_id, text)``; n_runs counts the runs of words of one language.

    A null text and one without a letter are ``und`` with score 0, and so is
    everything where no language was learnt. Of equal shares the language first
    by code point wins. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        tagger = shared.value
        for batch in sliced(batches, 1):
            texts = [words_of(x) for x in batch.column(1).to_pylist()]
            if tagger.langs:
                share, tags = tagger.shares(texts)
                best = share.argmax(axis=1)
                langs = [tagger.langs[b] if t else NONE for b, t in zip(best, texts, strict=True)]
                score = np.where([bool(t) for t in texts], share.max(axis=1), 0.0)
            else:
                langs, score, tags = [NONE] * len(texts), np.zeros(len(texts)), [np.zeros(0, np.int64)] * len(texts)
            n_runs = [len(_runs(t)[0]) for t in tags]
            yield fields(doc_id=batch.column(0), lang_pred=pa.array(langs, pa.string()), score=pa.array(np.clip(score, 0, 1), pa.float64()), n_runs=pa.array(n_runs, pa.int64()))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, n_runs long")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, part = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), fold(F.col("doc_id"), 4)
    tagger = fitted(docs.where((part != 2) & F.col("lang").isNotNull()))
    return identified(docs, tagger).select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_runs")

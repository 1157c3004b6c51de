"""Toxicity by a counterfactual-regularised classifier of sentences.

A sentence's log odds are a bias and one weight for each of its words, a word's
weight being the sum of the weights of its features: itself and its first bytes.
A text's score is a calibrated sum of its most toxic sentence, the number of
sentences expected to be toxic and its length. Only documents carry labels, so
the sentences of toxic ones that hold a suspicious feature are taken as toxic,
and their labels and the weights are fitted in turn. For each sentence with an
identity term a twin is made with another term of the kind; the loss adds the
square of the difference of the two scores, so that naming a group is worth
nothing by itself.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fitted_from, fold, least_hashed, sliced, table, texts_of

#: Neutral names of different groups, a line a kind, language and number; any term may stand for another of its line.
IDENTITY = """
muslim christian jewish hindu buddhist atheist catholic
muslims christians jews hindus buddhists atheists catholics
musulman chrétien juif
musulmans chrétiens juifs
moslem christ jude
musulmanes cristianos judíos
african asian arab european mexican american
africans asians arabs europeans mexicans americans
immigrant refugee
immigrants refugees
africain asiatique arabe européen
afrikaner asiat europäer
africanos asiáticos árabes inmigrantes
black white brown
noir blanc
noirs blancs
schwarze weiße
negro blanco
negros blancos
woman man
women men
girl boy
girls boys
female male
femme homme
femmes hommes
frau mann
frauen männer
mujer hombre
mujeres hombres
gay lesbian straight bisexual queer
gays lesbians
homosexual heterosexual
schwul lesbisch
disabled deaf blind
old young
sourd aveugle
behindert taub
sordo ciego
"""


@dataclass(frozen=True)
class Toxic:
    #: Labelled documents of each class that it is fitted on at most, those of least seeded hash.
    per_class: int = 3000
    #: A feature is suspicious from as many toxic documents, ratio of frequencies and chi-square on.
    least_documents: int = 4
    least_ratio: float = 4.0
    least_square: float = 25.0
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    rounds: int = 3
    steps: int = 200
    ridge: float = 1e-3
    counterfactual: float = 5.0
    seed: int = 3


#: ASCII capitals become small; punctuation but for sentence ends becomes blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c in b".!?\n" else 32 for c in range(256))
_ENDS = (b".", b"!", b"?")


def sentences(text: bytes | None) -> list[list[bytes]]:
    """Plain words of each sentence; a word is what letters and digits make up."""
    out = []
    for line in (text or b"").translate(_PLAIN).split(b"\n"):
        start, words = 0, line.split()
        for i, w in enumerate(words):
            if w.endswith(_ENDS):
                out.append(words[start : i + 1])
                start = i + 1
        out.append(words[start:])
    return [[x for w in s if (x := w.strip(b".!?"))] for s in out if s]


def features(word: bytes, cfg: Toxic) -> list[bytes]:
    return [word, *(b"^" + word[:n] for n in cfg.prefixes if len(word) >= n)]


_KIND = {w.encode(): [x.encode() for x in line.split()] for line in IDENTITY.split("\n") for w in line.split()}


def swapped(words: list[bytes]) -> list[bytes] | None:
    """The sentence with each identity term replaced by the next group of its kind; None if it has none."""
    if not any(w in _KIND for w in words):
        return None
    return [k[(k.index(w) + 1) % len(k)] if (k := _KIND.get(w)) else w for w in words]


def _evidence(z: np.ndarray, bias: float) -> np.ndarray:
    """Of a text's sentences' log odds: the highest, the logarithms of the number expected toxic and of their number, and 1."""
    if not len(z):
        return np.array([np.clip(bias, -8, 8), 0.0, 0.0, 1.0])
    return np.array([np.clip(z.max(), -8, 8), np.log1p((1 / (1 + np.exp(-np.clip(z, -30, 30)))).sum()), np.log1p(len(z)), 1.0])


class Scorer:
    def __init__(self, weights: dict[bytes, float], bias: float, mix: np.ndarray, cfg: Toxic):
        self.weights, self.bias, self.mix, self.cfg = weights, bias, mix, cfg
        self.words: dict[bytes, float] = {}

    def word(self, w: bytes) -> float:
        got = self.words.get(w)
        if got is None:
            if len(self.words) > 300_000:
                self.words.clear()
            got = self.words[w] = sum(self.weights.get(f, 0.0) for f in features(w, self.cfg))
        return got

    def sentence(self, words: list[bytes]) -> float:
        """Log odds of a sentence; each of its distinct words counts once."""
        word = self.word
        return self.bias + sum([x for w in set(words) if (x := word(w))])

    def text(self, text: bytes | None) -> float:
        z = np.array([self.sentence(s) for s in sentences(text)])
        return float(1 / (1 + np.exp(-np.clip(_evidence(z, self.bias) @ self.mix, -500, 500))))

    def __getstate__(self):
        return {**self.__dict__, "words": {}}


def _suspects(texts: list[tuple[int, set[bytes]]], cfg: Toxic) -> dict[bytes, float]:
    """Features of toxic documents that are much more frequent there than in others, with their log ratios."""
    seen = (Counter(), Counter())
    for y, found in texts:
        seen[y].update(found)
    n = [max(1, sum(1 for y, _ in texts if y == k)) for k in (0, 1)]
    out = {}
    for f, c in seen[1].items():
        ratio = ((c + 0.1) / n[1]) / ((seen[0][f] + 0.5) / n[0])
        expected = (c + seen[0][f]) * n[1] / (n[0] + n[1])
        if c >= cfg.least_documents and ratio >= cfg.least_ratio and (c - expected) ** 2 / expected >= cfg.least_square:
            out[f] = float(np.log(ratio))
    return out


class Sentences:
    """Sentences as rows of a sparse matrix, with the differences between those that name a group and their twins."""

    def __init__(self, cells: list[list[int]], twins: list[tuple[int, list[int]]], width: int, cfg: Toxic):
        self.size, self.width, self.cfg, self.pairs = len(cells), width, cfg, max(1, len(twins))
        self.row, self.col = np.repeat(np.arange(len(cells)), [len(c) for c in cells]), np.array([j for c in cells for j in c], int)
        sides = [(k, j, sign) for k, (i, other) in enumerate(twins) for side, sign in ((cells[i], 1.0), (other, -1.0)) for j in side]
        self.pair, self.term, self.sign = (np.array([x[n] for x in sides], t) for n, t in ((0, int), (1, int), (2, float)))

    def odds(self, w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, w[self.col], self.size)

    def loss(self, w: np.ndarray, bias: float, label: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, float]:
        """Weighted log loss, ridge, and the mean square of what swapping identity terms does to a score; its gradients by weights and bias."""
        cfg, z, norm = self.cfg, np.clip(self.odds(w, bias), -30, 30), max(1.0, label.sum())
        gap = np.bincount(self.pair, self.sign * w[self.term], self.pairs)
        told = (weight * (np.log1p(np.exp(z)) - label * z)).sum() / norm + cfg.ridge / 2 * w @ w + cfg.counterfactual * gap @ gap / self.pairs
        g = weight * (1 / (1 + np.exp(-z)) - label) / norm
        by_gap = np.bincount(self.term, self.sign * gap[self.pair], self.width) if len(self.term) else 0.0
        return told, np.bincount(self.col, g[self.row], self.width) + cfg.ridge * w + 2 * cfg.counterfactual / self.pairs * by_gap, g.sum()


def fit(rows: list[tuple[int, bytes]], cfg: Toxic = Toxic()) -> Scorer:
    """Fit on (label, text) rows; without both labels every text gets the smoothed share of label 1."""
    toxic = sum(y for y, _ in rows)
    if not 0 < toxic < len(rows):
        share = (toxic + 0.5) / (len(rows) + 1)
        return Scorer({}, 0.0, np.array([0, 0, 0, np.log(share / (1 - share))]), cfg)
    docs = [(y, sentences(x)) for y, x in rows]
    cache: dict[bytes, list[bytes]] = {}
    of = lambda w: cache.get(w) or cache.setdefault(w, features(w, cfg))
    weights = _suspects([(y, {f for s in ss for w in s for f in of(w)}) for y, ss in docs], cfg)
    chosen = {f: i for i, f in enumerate([*weights, *(w for w in _KIND if w not in weights)])}
    hits = lambda words: sorted({chosen[f] for w in set(words) for f in of(w) if f in chosen})
    cells, truth, owner, twins = [], [], [], []
    for d, (y, ss) in enumerate(docs):
        for s in ss:
            other = swapped(s)
            if other:
                twins.append((len(cells), hits(other)))
            cells.append(hits(s))
            truth.append(y)
            owner.append(d)
    truth, owner, rest = np.array(truth), np.array(owner), Sentences(cells, twins, len(chosen), cfg)
    w = np.array([0.0 if f in _KIND else 0.5 * weights.get(f, 0.0) for f in chosen])
    bias = -2.0
    for _ in range(cfg.rounds):
        z = rest.odds(w, bias)
        # The most toxic sentence of each toxic document is toxic, and so are its others with positive odds.
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, owner, z)
        label = ((truth == 1) & ((z > 0) | ((z == top[owner]) & (z > bias)))).astype(float)
        use = (truth == 0) | (label == 1) | (z <= bias)
        weight = np.where(label == 1, 1.0, label.sum() * 3 / max(1, (use & (label == 0)).sum())) * use
        grad2, grad2b = np.full(len(w), 1e-8), 1e-8
        for _ in range(cfg.steps):
            _, gw, gb = rest.loss(w, bias, label, weight)
            grad2, grad2b = grad2 + gw**2, grad2b + gb**2
            w -= 0.3 * gw / np.sqrt(grad2)
            bias -= 0.3 * gb / np.sqrt(grad2b)
    z, ends = rest.odds(w, bias), np.cumsum(np.bincount(owner, minlength=len(docs)))
    facts = np.array([_evidence(part, bias) for part in np.split(z, ends[:-1])])
    mix = _calibrated(facts, np.array([y for y, _ in docs], float))
    return Scorer({f: float(w[i]) for f, i in chosen.items() if abs(w[i]) > 1e-3}, float(bias), mix, cfg)


def _calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression by damped Newton steps, a ridge holding it finite on separable rows."""
    a, hold = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    hold[-1, -1] = 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (p - y) + hold @ a)
        a = a - step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
    return a


def _training(docs: DataFrame, labels: DataFrame, learn, cfg: Toxic) -> DataFrame:
    """(doc_id, label, text) of up to ``per_class`` labelled documents of each class, those whose ids have the least seeded hash."""
    chosen = {}
    for k in (0, 1):
        some = labels.where(learn).where((F.col("label") == k) & F.col("doc_id").isNotNull()).select("doc_id")
        chosen.update(dict.fromkeys(least_hashed(some, "doc_id", cfg.seed, cfg.per_class), k))
    ids = labels.sparkSession.createDataFrame(list(chosen.items()), "doc_id long, label int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where(learn).where("text is not null").join(F.broadcast(ids), "doc_id")
    return rows.select("doc_id", "label", "text").distinct()


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs(doc_id, text)``; null and empty texts have no sentence and get the score of none."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        for batch in sliced(batches, 1):
            score = np.array([shared.value.text(x) for x in texts_of(batch.column(1))])
            yield fields(doc_id=batch.column(0), score=pa.array(score, pa.float64()), predicted=pa.array((score >= 0.5).astype(np.int32)))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def classified(docs: DataFrame, labels: DataFrame, learn, cfg: Toxic = Toxic()) -> DataFrame:
    """Fit on ``labels(doc_id, label)`` of the rows that ``learn``, a condition on doc_id, lets through, and score all of ``docs``.

    Labels of null ids, null labels and labels of null or missing texts teach
    nothing; a document labelled both ways counts as toxic; rows that repeat an
    id and text teach once. Without labels, or with those of one class, every
    text gets the smoothed share of label 1. Empty ``docs`` give no rows.
    """
    return scored(docs, fitted_from(_training(docs, labels, learn, cfg), lambda rows: fit([(y, bytes(x)) for _, y, x in rows], cfg)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 5)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    out = classified(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, part != 0)
    return out.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", "predicted")

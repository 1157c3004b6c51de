"""Quality classifier: regularised quadratic discriminant analysis of transformed document statistics."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fold, materialize, table, texts_of
from .quality_rules import STOP_WORDS

_STOP = frozenset(w.encode() for w in STOP_WORDS)
FEATURES = ("words", "word_length", "capitals", "symbols", "exclamations", "stops", "digits", "commas", "stop_marks", "distinct", "top_word", "same_lines", "long_words", "line_words", "pairs_again")


@dataclass(frozen=True)
class Discriminant:
    #: Share of each class's covariance that comes from the pooled one, and of that from its mean variance.
    to_pooled: float = 0.1
    to_round: float = 0.05
    #: Log-density differences are divided by this before the logistic.
    temperature: float = 4.0


def _ratio(a: float, b: float) -> float:
    """Variance-stabilised share."""
    return float(np.arcsin(np.sqrt(min(1.0, a / b)))) if b else 0.0


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, arcsine roots of shares. Zeros for an empty one."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size, plain = len(text), len(text.translate(None, b" \t\n\r\x0b\x0c"))
    low = text.lower()
    seen = Counter(low.split())
    lines = [x for x in low.split(b"\n") if x.strip()]
    kept = lambda chars: size - len(text.translate(None, chars))
    pairs = list(zip(words, words[1:], strict=False))
    return [
        float(np.log1p(n)),
        float(np.log(plain / n)),
        _ratio(kept(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), plain),
        _ratio(kept(b"#*$%&|<>"), plain),
        _ratio(text.count(b"!"), plain),
        _ratio(sum(seen[w] for w in _STOP if w in seen), n),
        _ratio(kept(b"0123456789"), plain),
        _ratio(text.count(b","), n),
        _ratio(text.count(b"."), n),
        _ratio(len(seen), n),
        _ratio(max(seen.values()), n),
        _ratio(len(lines) - len(set(lines)), len(lines)),
        _ratio(sum(c for w, c in seen.items() if len(w) > 15), n),
        float(np.log1p(n / len(lines))),
        _ratio(len(pairs) - len(set(pairs)), max(1, len(pairs))),
    ]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the statistics of every whole text."""

    def run(batches):
        for batch in batches:
            rows = [statistics(x) for x in texts_of(batch.column(1))]
            yield fields(doc_id=batch.column(0), stats=pa.array(rows, pa.list_(pa.float64())))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, stats array<double>")


def _moments(known: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Of each class: rows, mean and covariance of (label, stats), over all rows, from sums that tasks make."""
    d = len(FEATURES)

    def run(batches):
        n, one, two = np.zeros(2, np.int64), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            if batch.num_rows:
                y = batch.column(0).to_numpy()
                x = np.array(batch.column(1).to_pylist())
                for k in (0, 1):
                    own = x[y == k]
                    n[k] += len(own)
                    one[k] += own.sum(axis=0)
                    two[k] += own.T @ own
        yield fields(label=pa.array([0, 1]), n=pa.array(n), sums=pa.array([np.concatenate([one[k], two[k].ravel()]).tolist() for k in (0, 1)]))

    parts = known.select("label", "stats").mapInArrow(run, "label long, n long, sums array<double>")
    flat = parts.select("label", "n", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect()
    out = {}
    for k in (0, 1):
        rows = sorted((r.pos, r.s, r.n) for r in flat if r.label == k)
        n = rows[0][2] if rows else 0
        s = np.array([r[1] for r in rows]) if rows else np.zeros(d + d * d)
        mean = s[:d] / max(n, 1)
        out[k] = n, mean, s[d:].reshape(d, d) / max(n, 1) - np.outer(mean, mean)
    return out


class Scorer:
    """Log-density differences with the Cholesky factors kept; one score for all where a class has no rows."""

    def __init__(self, moments: dict, cfg: Discriminant):
        (n0, _, s0), (n1, _, s1) = moments[0], moments[1]
        self.cfg, self.constant, self.parts = cfg, None if n0 and n1 else (n1 + 0.5) / (n0 + n1 + 1), []
        pooled = (n0 * s0 + n1 * s1) / max(1, n0 + n1)
        scale = np.sqrt(np.diag(pooled).clip(1e-8))
        for n, mean, cov in (moments[0], moments[1]):
            mix = ((1 - cfg.to_pooled) * cov + cfg.to_pooled * pooled) / np.outer(scale, scale)
            mix = (1 - cfg.to_round) * mix + cfg.to_round * max(np.trace(mix) / len(mix), 1e-3) * np.eye(len(mix))
            root = np.linalg.cholesky(mix)
            self.parts.append((mean, np.linalg.inv(root).T, 2 * np.log(np.diag(root)).sum() - 2 * np.log(max(n, 1) / max(1, n0 + n1))))
        self.scale = scale

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        far = [((((x - mean) / self.scale) @ back) ** 2).sum(axis=1) + log for mean, back, log in self.parts]
        return 1 / (1 + np.exp(-np.clip((far[0] - far[1]) / 2 / self.cfg.temperature, -500, 500)))


def classified(docs: DataFrame, labels: DataFrame, learn, cfg: Discriminant = Discriminant()) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs(doc_id, text)``, learnt from ``labels(doc_id, label)``.

    ``learn`` is a condition on doc_id: labels of other rows are never read.
    Class means and covariances are those of all labelled rows so chosen.
    Null labels and ids teach nothing; null and empty texts are scored as a
    text without words. Repeated rows are scored alike, and taught as often as
    they occur. Without labels of both classes every score is the smoothed
    share of label 1.
    """
    all_of = materialize(described(docs), "statistics")
    known = all_of.where(learn).join(labels.where(learn).where("label in (0, 1)").select("doc_id", F.col("label").cast("long")), "doc_id")
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(_moments(known), cfg))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = scorer.value(np.array(batch.column(1).to_pylist()))
                yield fields(doc_id=batch.column(0), score=pa.array(score), predicted=pa.array((score >= 0.5).astype(np.int32)))

    return all_of.mapInArrow(run, "doc_id long, score double, predicted int")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 3)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    out = classified(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, part != 1)
    return out.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score", "predicted")

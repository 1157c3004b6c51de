"""Benchmark decontamination by latent semantic retrieval.

Three passes over the texts, none of which shuffles them:

1. passage frequencies of the benchmark's terms, over all passages;
2. a randomised SVD of the TF-IDF passages: every task adds up its part of
   ``C @ Omega``, C being the passages' second-moment matrix and Omega a seeded
   Gaussian, and the driver solves the Nystroem form of the small system;
3. the search: windows are projected, compared with the items by cosine in the
   latent space, and candidates are checked on the words themselves by longest
   common subsequence; paraphrases must also hold the item's answer. Places
   that share enough of an item's rarest words for such a subsequence are
   candidates too, whatever their cosine: none that the check would confirm is lost.
   What holds an item's words in another order has no such subsequence. It is
   found by the cosine alone, and confirmed on the words without their order.

Terms in more than ``most_share`` of the passages carry no evidence and are left
out, but for an item's ``least_terms`` rarest, so that items of common words
can be found too.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, sliced, table, texts_of


@dataclass(frozen=True)
class Latent:
    passage: int = 64
    stride: int = 16
    dims: int = 96
    most_share: float = 0.003
    least_terms: int = 8
    #: A window is projected if it has as many distinct terms, or all those of a shorter item; by shared words it must hold as many of an item's rarest beyond those that may be changed.
    window_terms: int = 4
    cosine: float = 0.25
    #: Share of the item's words in the common subsequence: a copy, or a paraphrase if the answer is there too.
    copied: float = 0.8
    paraphrased: float = 0.6
    answered: float = 0.6
    #: Cosine from which the share ``copied`` of the item's words counts in any order.
    reordered: float = 0.5
    seed: int = 11
    #: Items are searched for in blocks of about as many bytes of text.
    block_bytes: int = 4_000_000


#: ASCII capitals become small, ASCII punctuation becomes blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


def answer_of(text: bytes, given: bytes | None = None) -> set[bytes]:
    """The words of an item's answer: the ``answer`` given, else its last sentence of three words or more."""
    if given:
        return set(plain_words(given))
    parts = [plain_words(x) for x in re.split(rb"[.!?\n]", text)]
    return set(next((x for x in reversed(parts) if len(x) >= 3), plain_words(text)))


def lcs(masks: dict[bytes, int], words: list[bytes]) -> int:
    """Length of the longest common subsequence of ``words`` and the item whose words' places ``masks`` holds (bit-parallel)."""
    row = 0
    for w in words:
        m = masks.get(w)
        if m:
            x = row | m
            row = x & ((x - ((row << 1) | 1)) ^ x)
    return row.bit_count()


class Items:
    """A block of benchmark items with the terms that they are found by."""

    def __init__(self, rows: list, given: bool):
        self.ids = [r[0] for r in rows]
        self.words = [plain_words(r[1]) for r in rows]
        self.answers = [answer_of(r[1] or b"", r[2] if given else None) for r in rows]
        self.masks = []
        for words in self.words:
            at: dict[bytes, int] = {}
            for i, w in enumerate(words):
                at[w] = at.get(w, 0) | 1 << i
            self.masks.append(at)
        self.counts = [{w: m.bit_count() for w, m in at.items()} for at in self.masks]
        self.sets = [frozenset(at) for at in self.masks]
        self.longest = max(map(len, self.words), default=0)
        self.terms = {w: i for i, w in enumerate(sorted({w for words in self.words for w in words}))}

    def gated(self, share: np.ndarray, cfg: Latent) -> None:
        """Of each item so many of its rarest words that any text with the share ``paraphrased`` of its words holds ``least`` of them."""
        posts: dict[bytes, list[int]] = {}
        self.sizes, self.least = np.array([len(w) for w in self.words], np.int64), np.zeros(len(self.words), np.int64)
        for j, words in enumerate(self.words):
            if words:
                m = max(1, int(np.ceil(cfg.paraphrased * len(words))))
                spare, held = len(words) - m, 0
                for w in sorted(self.counts[j], key=lambda w: (share[self.terms[w]], w)):
                    if held >= spare + max(1, min(m, cfg.window_terms)):
                        break
                    held += self.counts[j][w]
                    posts.setdefault(w, []).append(j)
                self.least[j] = held - spare
        self.gates = {w: i for i, w in enumerate(posts)}
        self.post_sizes = np.array([len(x) for x in posts.values()], np.int64)
        self.post_starts = np.cumsum(self.post_sizes) - self.post_sizes
        self.posts = np.array([j for x in posts.values() for j in x], np.int64)

    def chosen(self, share: np.ndarray, cfg: Latent) -> None:
        """Keep the rare terms, and each item's rarest."""
        self.gated(share, cfg)
        keep = share <= cfg.most_share
        for words in self.words:
            own = np.array([self.terms[w] for w in sorted(set(words))], int)
            keep[own[np.argsort(share[own], kind="stable")][: cfg.least_terms]] = True
        old = np.array(list(self.terms.values()))
        self.idf = np.log(1 / np.maximum(share, 1e-12))[old][keep[old]].clip(0.1)
        self.terms = {w: i for i, w in enumerate(w for w, j in self.terms.items() if keep[j])}
        self.need = min([cfg.window_terms, *(len({w for w in words if w in self.terms}) for words in self.words if words)])


def _hits(text: bytes | None, terms: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of words, and the places and numbers of those that are terms."""
    words = plain_words(text)
    of = np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))
    at = np.flatnonzero(of >= 0)
    return len(words), at, of[at]


def _vectors(window: np.ndarray, term: np.ndarray, idf: np.ndarray):
    """Distinct (window, term) cells in order, with weights of unit length a window."""
    cell, n = np.unique(window * len(idf) + term, return_counts=True)
    window, term = cell // len(idf), cell % len(idf)
    weight = (1 + np.log(n)) * idf[term]
    starts = np.flatnonzero(np.diff(window, prepend=-1))
    norm = np.sqrt(np.add.reduceat(weight**2, starts))
    sizes = np.diff(np.append(starts, len(window)))
    return window[starts], starts, sizes, term, weight / np.repeat(norm, sizes)


def _summed(docs: DataFrame, values, width: int) -> dict[int, tuple]:
    """Add up arrays that tasks make of their texts, row by row: the sums of each row that has any. ``values(texts)`` returns an array a batch."""

    def run(batches):
        total = None
        for batch in batches:
            made = values(texts_of(batch.column(0)))
            total = made if total is None else total + made
        if total is not None:
            some = np.flatnonzero(np.abs(total).sum(axis=1))
            yield fields(term=pa.array(some, pa.int64()), **{f"c{j}": pa.array(total[some, j], pa.float64()) for j in range(width)})

    parts = docs.select(F.col("text")).mapInArrow(run, "term long, " + ", ".join(f"c{j} double" for j in range(width)))
    rows = parts.groupBy("term").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).collect()
    return {r[0]: r[1:] for r in rows}


def _shares(docs: DataFrame, items: Items, cfg: Latent) -> np.ndarray:
    """The share of all passages that have each term; the last row of the sum counts passages."""
    size, passage, terms = len(items.terms), cfg.passage, items.terms

    def values(texts):
        out = np.zeros((size + 1, 1))
        for text in texts:
            n, at, term = _hits(text, terms)
            out[size, 0] += -(-n // passage)
            if len(at):
                out[:size, 0] += np.bincount(np.unique(at // passage * size + term) % size, minlength=size)
        return out

    found = _summed(docs, values, 1)
    n = max(found.get(size, (0,))[0], 1)
    return np.array([found.get(i, (0,))[0] / n for i in range(size)])


def _basis(docs: DataFrame, items: Items, cfg: Latent) -> np.ndarray:
    """Right singular vectors (terms x dims) of the TF-IDF passages of corpus and benchmark."""
    size, terms, idf, passage = len(items.terms), items.terms, items.idf, cfg.passage
    dims = min(cfg.dims, size)
    omega = np.linalg.qr(np.random.default_rng(cfg.seed).standard_normal((size, dims)))[0]

    def part(hits):
        out = np.zeros((size, dims))
        if hits:
            window = np.concatenate([w for w, _ in hits]).astype(np.int64)
            _, starts, sizes, term, weight = _vectors(window, np.concatenate([t for _, t in hits]), idf)
            for lo in range(0, len(starts), 4096):
                a, b = starts[lo], starts[lo + 4096] if lo + 4096 < len(starts) else len(term)
                rows = weight[a:b, None] * omega[term[a:b]]
                y = np.add.reduceat(rows, starts[lo : lo + 4096] - a, axis=0)
                cells = weight[a:b, None] * np.repeat(y, sizes[lo : lo + 4096], axis=0)
                order = np.argsort(term[a:b], kind="stable")
                t = term[a:b][order]
                at = np.flatnonzero(np.diff(t, prepend=-1))
                out[t[at]] += np.add.reduceat(cells[order], at, axis=0)
        return out

    def values(texts):
        hits, base = [], 0
        for text in texts:
            n, at, term = _hits(text, terms)
            if len(at):
                hits.append((base + at // passage, term))
            base += n // passage + 1
        return part(hits)

    found = _summed(docs, values, dims)
    y = part([(np.full(len(t), i), t) for i, words in enumerate(items.words) if len(t := np.array([terms[w] for w in words if w in terms], np.int64))])
    for i, row in found.items():
        y[i] += row
    shift = 1e-8 * np.linalg.norm(y) + 1e-12
    y = y + shift * omega
    core = omega.T @ y
    vals, vecs = np.linalg.eigh((core + core.T) / 2)
    b = y @ (vecs / np.sqrt(np.maximum(vals, shift)))
    return np.linalg.svd(b, full_matrices=False)[0]


class Search:
    """Finds a block's items in texts."""

    def __init__(self, items: Items, basis: np.ndarray, cfg: Latent):
        self.items, self.cfg, self.basis = items, cfg, basis.astype(np.float32)
        rows = np.zeros((len(items.ids), basis.shape[1]))
        for i, words in enumerate(items.words):
            t, n = np.unique([items.terms[w] for w in words if w in items.terms], return_counts=True)
            if len(t):
                rows[i] = ((1 + np.log(n)) * items.idf[t.astype(int)]) @ basis[t.astype(int)]
        self.rows = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        # One look-up a word tells whether it is a term and whether it is a gate.
        self.known = {w: i for i, w in enumerate(dict.fromkeys([*items.terms, *items.gates]))}
        self.term_of = np.array([items.terms.get(w, -1) for w in self.known], np.int32)
        self.gate_of = np.array([items.gates.get(w, -1) for w in self.known], np.int32)

    def __call__(self, texts: list[bytes | None]) -> list[tuple[int, int, float, int, int, float]]:
        """(text, item, cosine, start, common words, answer share) of the best window of each item in each text."""
        best: dict[tuple[int, int], tuple] = {}
        hits = [_hits(text, self.known) for text in texts]
        self._near(texts, hits, self._sharing(texts, hits, best), best)
        return [(n, j, *v) for (n, j), v in sorted(best.items())]

    def _region(self, words: list[bytes], start: int, j: int) -> tuple[int, list[bytes]]:
        """Where item ``j`` may begin if the window at ``start`` is in it, and the words from there on."""
        size = len(self.items.words[j])
        start = max(0, start - size // 2)
        return start, words[start : start + self.cfg.passage + size]

    def _told(self, words: list[bytes], start: int, j: int) -> tuple[int, int, float] | None:
        """Start, common words and answer share of item ``j`` round the window at ``start``, if it is there."""
        cfg, items = self.cfg, self.items
        size = len(items.words[j])
        start, region = self._region(words, start, j)
        here = set(region)
        if size - sum(map(items.counts[j].__getitem__, items.sets[j] - here)) < cfg.paraphrased * size:
            return None
        common = lcs(items.masks[j], region)
        told = len(items.answers[j] & here) / max(1, len(items.answers[j]))
        return (start, common, told) if common >= cfg.paraphrased * size and (common >= cfg.copied * size or told >= cfg.answered) else None

    def _reordered(self, words: list[bytes], start: int, j: int, cosine: float) -> tuple[int, int, float] | None:
        """As ``_told``, the words in any order: for windows of that ``cosine`` that lie near the item in the latent space, by themselves or with what is round them."""
        cfg, items = self.cfg, self.items
        start, region = self._region(words, start, j)
        held = Counter(region)
        common = sum(min(n, held[w]) for w, n in items.counts[j].items())
        if common < cfg.copied * len(items.words[j]) or max(cosine, self._cosine(region, 0, j, len(region))) < cfg.reordered:
            return None
        return start, common, len(items.answers[j] & held.keys()) / max(1, len(items.answers[j]))

    def _cosine(self, words: list[bytes], start: int, j: int, span: int | None = None) -> float:
        t, n = np.unique([self.items.terms[w] for w in words[max(0, start) : max(0, start + (span or self.cfg.passage))] if w in self.items.terms], return_counts=True)
        t = t.astype(int)
        p = ((1 + np.log(n)) * self.items.idf[t]) @ self.basis[t]
        return float(p @ self.rows[j] / max(np.linalg.norm(p), 1e-9))

    def _sharing(self, texts: list[bytes | None], hits: list, best: dict, most: int = 1_000_000) -> np.ndarray:
        """What windows find that hold an item's ``least`` of its rarest words; the sorted keys (text * items + item) of all pairs with such a window."""
        held, size, keys = [], 0, [np.zeros(0, np.int64)]
        for n, (_, at, known) in enumerate(hits):
            gate = self.gate_of[known]
            some = np.flatnonzero(gate >= 0)
            if len(some):
                held.append((n, at[some], gate[some]))
                size += int(self.items.post_sizes[gate[some]].sum())
            if size > most:
                keys.append(self._shared(texts, held, best))
                held, size = [], 0
        if held:
            keys.append(self._shared(texts, held, best))
        return np.unique(np.concatenate(keys))

    def _shared(self, texts: list[bytes | None], held: list, best: dict) -> np.ndarray:
        cfg, items = self.cfg, self.items
        gate = np.concatenate([g for _, _, g in held])
        doc, place = np.repeat([n for n, _, _ in held], [len(a) for _, a, _ in held]), np.concatenate([a for _, a, _ in held])
        times = items.post_sizes[gate]
        of = np.repeat(np.arange(len(gate)), times)
        item = items.posts[np.repeat(items.post_starts[gate] - np.cumsum(times) + times, times) + np.arange(len(of))]
        key = doc[of] * len(items.ids) + item
        order = np.argsort(key, kind="stable")
        key, item, place = key[order], item[order], place[of][order]
        last = np.arange(len(key)) + items.least[item] - 1
        i = np.flatnonzero(last < len(key))
        last = last[i]
        i, last = (x[(key[i] == key[last]) & (place[last] - place[i] < cfg.passage + items.sizes[item[i]])] for x in (i, last))
        # The windows whose region, from half the item's size before them, holds those words.
        size, step = items.sizes[item[i]], cfg.stride
        low = np.maximum(-((cfg.passage - size // 2 + size - 1 - place[last]) // step), 1 - cfg.passage // step)
        many = np.maximum((place[i] + size // 2) // step - low + 1, 0)
        window = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        ahead = place[last] < cfg.passage + size
        keys, windows = np.concatenate([np.repeat(key[i], many), key[i][ahead]]), np.concatenate([window, np.zeros(ahead.sum(), np.int64)])
        now, words = -1, []
        for k, w in sorted(set(zip(keys.tolist(), windows.tolist(), strict=True))):
            n, j = divmod(k, len(items.ids))
            if n != now:
                now, words = n, plain_words(texts[n])
            found = self._told(words, w * step, j)
            if found and ((n, j) not in best or found[1] > best[n, j][2]):
                best[n, j] = (self._cosine(words, w * step, j), *found)
        return key[i]

    def _near(self, texts: list[bytes | None], hits: list, pairs: np.ndarray, best: dict) -> None:
        """What windows near an item in the latent space find: better places of what is in ``best``, and items told in another order.

        A window is read only if its text and item are among ``pairs``: the words
        in common that are asked for hold ``least`` of the item's rarest, so no
        other window would be confirmed.
        """
        cfg, items, spread, in_order = self.cfg, self.items, self.cfg.passage // self.cfg.stride, set(best)
        docs, windows, terms, places, base = [], [], [], [], 0
        for n, (size, at, known) in enumerate(hits):
            term = self.term_of[known]
            some = np.flatnonzero(term >= 0)
            at, term = at[some], term[some]
            if len(at) >= items.need:
                slot = base + at // cfg.stride
                windows.append((slot[:, None] + np.arange(spread)).ravel())
                terms.append(np.repeat(term, spread))
                docs.append(n)
                places.append(base)
            base += size // cfg.stride + spread + 1
        if not windows:
            return
        window, starts, sizes, term, weight = _vectors(np.concatenate(windows), np.concatenate(terms), items.idf)
        enough, places, docs = np.flatnonzero(sizes >= items.need), np.array(places), np.array(docs)
        for lo in range(0, len(enough), 2048):
            some = enough[lo : lo + 2048]
            first = np.cumsum(sizes[some]) - sizes[some]
            take = np.arange(sizes[some].sum()) + np.repeat(starts[some] - first, sizes[some])
            p = np.add.reduceat(weight[take, None].astype(np.float32) * self.basis[term[take]], first, axis=0)
            cos = p @ self.rows.T / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-9)
            near, which = np.nonzero(cos >= cfg.cosine)
            at = np.searchsorted(places, window[some[near]], side="right") - 1
            real = np.isin(docs[at] * len(items.ids) + which, pairs)
            near, which, at = near[real], which[real], at[real]
            ends = (window[some[near]] - places[at] - spread + 1) * cfg.stride
            now, words = -1, []
            for n, j, start, score in zip(docs[at].tolist(), which.tolist(), ends.tolist(), cos[near, which].tolist(), strict=True):
                if n != now:
                    now, words = n, plain_words(texts[n])
                found = self._told(words, start, j) if (n, j) in in_order else self._reordered(words, start, j, score)
                if found:
                    new = (score, *found)
                    if (n, j) not in best or (new[2], new[0]) > (best[n, j][2], best[n, j][0]):
                        best[n, j] = new


def _searches(docs: DataFrame, benchmark: DataFrame, cfg: Latent):
    """One fitted search a block of items."""
    given = "answer" in benchmark.columns
    items = benchmark.where("text is not null").select(F.col("item_id"), F.col("text").cast("binary"), *([F.col("answer").cast("string").cast("binary")] if given else []))
    blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // cfg.block_bytes))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        block = Items([(r[0], bytes(r[1]), *([bytes(r[2]) if r[2] else None] if given else [])) for r in rows], given)
        if block.terms:
            block.chosen(_shares(docs, block, cfg), cfg)
            yield Search(block, _basis(docs, block, cfg), cfg)


def contaminated(docs: DataFrame, benchmark: DataFrame, cfg: Latent = Latent()) -> DataFrame:
    """(doc_id, item_id, cosine, start, common_words, item_words, answer_share): one row for each text and item found in it.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text, and may have
    answer. Null and blank texts on either side find nothing, as do empty
    tables. Repeated rows are searched one by one. Whole texts are searched;
    ``start`` counts words. ``common_words`` are those of the subsequence, or of
    an item told in another order those in any order.
    """
    out = None
    for search in _searches(docs, benchmark, cfg):
        shared = docs.sparkSession.sparkContext.broadcast(search)

        def run(batches, shared=shared):
            search = shared.value
            for batch in sliced(batches, 1):
                found = search(texts_of(batch.column(1)))
                ids, items = batch.column(0).to_pylist(), search.items
                cols = list(zip(*[(ids[n], items.ids[j], c, s, m, len(items.words[j]), t) for n, j, c, s, m, t in found], strict=True)) or [[]] * 7
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "cosine", "start", "common_words", "item_words", "answer_share"])

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, item_id long, cosine double, start long, common_words long, item_words long, answer_share double")
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, cosine double, start long, common_words long, item_words long, answer_share double")


def clean(docs: DataFrame, benchmark: DataFrame, cfg: Latent = Latent()) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, unchanged and without a shuffle."""
    for search in _searches(docs, benchmark, cfg):
        shared = docs.sparkSession.sparkContext.broadcast(search)
        at = docs.columns.index("text")

        def run(batches, shared=shared, at=at):
            for batch in sliced(batches, at):
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in shared.value(texts_of(batch.column(at)))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return clean(docs, table(spark, sf_dir, "benchmark"))

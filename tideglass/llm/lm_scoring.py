"""LM scoring with a gated recurrent network and a class-factored softmax.

``P(word | past) = P(class | h) * P(word | class, h)``, h the state of a GRU that
has read the past. The most frequent words fall into classes of equal size by
frequency, each with a softmax of its own over h. All other words fall into tail
classes by their spelling's end; within one a word's share is its smoothed count
over all training text, and what no training text has gets one slot a class, so
the factors sum to one.

Counts cover all training texts and meet in one shuffle by word. The network
learns in numpy by truncated backpropagation: it starts from a fit on a bounded
sample (``LM.fit_tokens``), then all training texts are read once, in ``LM.rounds``
parts. In each round every task goes on from the common weights over its texts,
and the weights' means by tokens are the next round's. Scoring carries the state across windows,
so a text's score is that of the whole text. Words beyond the ``LM.head`` most
frequent (the ones held in memory) get their counts from a join.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, fold, least_hashed, materialize, on_one_worker, sliced, table

END = b" "  # no word holds a blank
#: Tokens at most whose logits are made at once: what a processor's cache holds.
BLOCK = 512
#: Bytes of text scored at once: a text is read in one lane, so that the longest should be few among them.
SLICE = 16_000_000


@dataclass(frozen=True)
class LM:
    hidden: int = 24
    #: Words with a softmax of their own, and the mean size of their classes.
    near: int = 2000
    per_class: int = 50
    tails: int = 32
    #: Words whose counts each worker holds.
    head: int = 120_000
    #: The network's first weights come from the texts of least seeded hash, up to as many tokens and documents.
    fit_tokens: int = 500_000
    fit_docs: int = 3000
    epochs: int = 3
    lanes: int = 64
    window: int = 32
    rate: float = 0.01
    #: Then all texts are learnt from in as many rounds, in up to as many lanes, at a share of the rate.
    rounds: int = 4
    round_lanes: int = 256
    round_rate: float = 0.3
    seed: int = 5


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []
    words.append(END)
    return words


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words (binary) of an Arrow column of texts, without the ends, and where each text's begin, with their number at the end: those of ``tokens``, for many texts at once."""
    text = column.cast(pa.binary()).view(pa.string())  # whatever the bytes are
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words, bounds = lists.flatten(), lists.offsets.to_numpy()
    # Blanks at a text's edges leave empty words.
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():
        words, bounds = words.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[bounds]
    return words.view(pa.binary()), bounds


def tail_of(word: bytes, tails: int) -> int:
    return crc32(word.rstrip(b".,;:!?")[-3:]) % tails


#: The steps of crc32 over one byte.
_CRC = np.array([crc32(bytes([255 - b])) ^ 0xFF000000 for b in range(256)], np.uint32)


def tails_of(words: pa.Array, tails: int) -> np.ndarray:
    """``tail_of`` each word of a binary array."""
    short = pc.ascii_rtrim(words.cast(pa.binary()).view(pa.string()), characters=".,;:!?")
    bounds = np.frombuffer(short.buffers()[1], np.int32, len(short) + 1, 4 * short.offset) if len(short) else np.zeros(1, np.int32)
    data, ends, sizes = np.frombuffer(short.buffers()[2] or b"", np.uint8), bounds[1:], np.diff(bounds)
    code = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for back in (3, 2, 1):
        some = np.flatnonzero(sizes >= back)
        now = code[some]
        code[some] = _CRC[(now ^ data[ends[some] - back]) & 255] ^ (now >> 8)
    return (~code % tails).astype(np.int64)


def _exp_sums(x: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """exp of columns, their sums, and the logarithms of the true sums; the maximum is taken out only where single precision needs it. ``ones``: as many as rows, or more."""
    e = np.exp(x)
    sums = ones[: len(x)] @ e
    logs = np.log(sums)
    if not np.isfinite(logs).all():
        top = x.max(axis=0)
        e = np.exp(x - top)
        sums = e.sum(axis=0)
        logs = top + np.log(sums)
    return e, sums, logs


class Network:
    """GRU (reset gate after the product) with table-lookup inputs and two-level outputs.

    Inputs and outputs are units: a near word's rank, or ``near`` plus a tail's number.
    """

    def __init__(self, near: int, cfg: LM, unit_counts: np.ndarray):
        rng, h = np.random.default_rng(cfg.seed), cfg.hidden
        self.h, self.near = h, near
        # Classes by frequency, of equal sums of square roots of counts: frequent words are in small ones.
        root = np.cumsum(np.sqrt(unit_counts[:near] + 0.5))
        place = np.minimum((root - root[:1]) / root[-1:] * -(-near // cfg.per_class), -(-near // cfg.per_class) - 1).astype(int)
        named, first = np.unique(place, return_index=True)
        self.near_classes, self.bounds = len(named), np.append(first, near)
        self.of = np.repeat(np.arange(self.near_classes), np.diff(self.bounds))
        self.classes = self.near_classes + cfg.tails
        # The class of each unit; short integers are sorted by radix.
        self.class_of = np.append(self.of, np.arange(self.near_classes, self.classes)).astype(np.int16 if self.classes < 2**15 else np.int64)
        mass = np.zeros(self.classes)
        np.add.at(mass, self.class_of, unit_counts + 0.5)
        p = self.p = {
            "x": rng.normal(0, 0.1, (near + cfg.tails, 3 * h)),
            "u": rng.normal(0, h**-0.5, (h, 3 * h)),
            "b": np.zeros(3 * h),
            "c": rng.normal(0, 0.05, (h, self.classes)),
            "cb": np.log(mass / mass.sum()),
            "w": rng.normal(0, 0.05, (near, h)),
            "wb": np.log(unit_counts[:near] + 0.5),
        }
        for k in p:
            p[k] = p[k].astype(np.float32)

    def steps(self, units: np.ndarray, state: np.ndarray, live: np.ndarray | None = None, keep: bool = True):
        """States after each of ``units`` (time x lanes), the last one and, where ``live`` (0: the state is cleared before) is given and ``keep`` says so, what backpropagation needs.

        Inside, lanes are the last axis, so that each gate of a step is one block of memory.
        """
        h, (steps, lanes), p, kind = self.h, units.shape, self.p, self.p["u"].dtype
        keep = keep and live is not None
        u, given = np.ascontiguousarray(p["u"].T), p["x"] + p["b"]
        np.negative(u[: 2 * h], out=u[: 2 * h])
        np.negative(given[:, : 2 * h], out=given[:, : 2 * h])
        gates = np.ascontiguousarray(np.take(given, units, axis=0).transpose(0, 2, 1))
        out = np.empty((steps, h, lanes), kind)
        r = np.empty((3 * h, lanes), kind)
        inner, before = (np.empty((steps, h, lanes), kind), np.empty((steps, h, lanes), kind)) if keep else (None, None)
        state, c = np.ascontiguousarray(state.T), r[2 * h :]
        clear = live is not None and (live != 1).any(axis=1)
        for t in range(steps):
            if keep:
                before[t] = state
                state = before[t]
            if live is not None and clear[t]:
                state = np.multiply(state, live[t], out=before[t] if keep else None)
            np.matmul(u, state, out=r)
            g, n = gates[t, : 2 * h], gates[t, 2 * h :]
            g += r[: 2 * h]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            if keep:
                inner[t] = c
            c *= g[h:]
            n += c
            np.tanh(n, out=n)
            o = np.subtract(state, n, out=out[t])
            o *= g[:h]
            o += n
            state = o
        return out.transpose(0, 2, 1), state.T, (before, gates, inner)

    @np.errstate(over="ignore", divide="ignore")
    def outputs(self, states: np.ndarray, target: np.ndarray, grads: dict | None = None):
        """Log probability of each target unit's class, and of near words within it, at each state (the last axis); gradients by the way, in the form of ``states``."""
        h, p, cls, kind, total = self.h, self.p, self.class_of[target], states.dtype, len(target)
        score, back = np.empty(total, kind), np.empty((total, h), kind) if grads is not None else None
        places, ones = np.arange(total), np.ones(max(self.classes, self.near), kind)
        # The biases are weights of a last input, always one.
        columns = np.empty((h + 1, total), kind)
        columns[:h].reshape(h, *states.shape[:-1])[...], columns[h] = np.moveaxis(states, -1, 0), 1
        c, classes, made = np.column_stack([p["c"].T, p["cb"]]), np.ascontiguousarray(p["c"].T), np.zeros((self.classes, h + 1), kind)
        # The place of each target in its block's logits.
        ats = cls * np.minimum(BLOCK, total - places // BLOCK * BLOCK) + places % BLOCK
        for lo in range(0, total, BLOCK):
            some, at = columns[:, lo : lo + BLOCK], ats[lo : lo + BLOCK]
            logits = c @ some
            picked = logits.take(at)
            d, sums, logs = _exp_sums(logits, ones)
            np.subtract(picked, logs, out=score[lo : lo + BLOCK])
            if grads is not None:
                d *= 1 / sums
                d.reshape(-1)[at] -= 1
                made += d @ some.T
                np.matmul(d.T, classes, out=back[lo : lo + BLOCK])
        near = np.flatnonzero(target < self.near)
        order = near[np.argsort(cls[near], kind="stable")]
        # Rows are gathered faster than columns.
        rows = np.empty((*states.shape[:-1], h + 1), kind)
        rows[..., :h], rows[..., h] = states, 1
        own, rows = np.take(target, order), np.take(rows.reshape(-1, h + 1), order, axis=0)
        bounds = np.flatnonzero(np.diff(np.take(cls, order), prepend=-1, append=-1)) if len(order) else np.zeros(0, int)
        more, inside = np.empty(len(order), kind), np.zeros((len(order) + 1, h), kind) if grads is not None else None
        owners = self.of[own[bounds[:-1]]] if len(order) else bounds
        sizes = np.diff(bounds)
        ats = (own - self.bounds[self.of[own]]) * np.repeat(sizes, sizes) + places[: len(order)] - np.repeat(bounds[:-1], sizes)
        weights = np.column_stack([p["w"], p["wb"]])
        found = np.zeros_like(weights) if grads is not None else None
        for lo, hi, k in zip(bounds[:-1].tolist(), bounds[1:].tolist(), owners.tolist(), strict=True):
            words, some = slice(self.bounds[k], self.bounds[k + 1]), rows[lo:hi]
            at, logits = ats[lo:hi], weights[words] @ some.T
            picked = logits.take(at)
            d, sums, logs = _exp_sums(logits, ones)
            np.subtract(picked, logs, out=more[lo:hi])
            if grads is not None:
                d *= 1 / sums
                d.reshape(-1)[at] -= 1
                np.matmul(d, some, out=found[words])
                np.matmul(d.T, p["w"][words], out=inside[lo:hi])
        score[order] += more
        if grads is not None:
            grads["c"] += made[:, :h].T
            grads["cb"] += made[:, h]
            grads["w"] += found[:, :h]
            grads["wb"] += found[:, h]
            # Other units get the zero at the end.
            at = np.full(total, len(order))
            at[order] = places[: len(order)]
            back += np.take(inside, at, axis=0)
            back = back.reshape(states.shape)
        return score, back

    def fit(self, texts: list[np.ndarray], start: int, cfg: LM) -> list[float]:
        """Truncated backpropagation, Adam, lanes of consecutive texts; nats a token of each epoch."""
        rng, p, h = np.random.default_rng(cfg.seed), self.p, self.h
        # All weights lie in one array, and likewise their gradients.
        flat_p, flat_g = (np.concatenate([x.ravel() for x in p.values()]) for _ in range(2))
        m, v, turn, told, grads, at = np.zeros_like(flat_p), np.zeros_like(flat_p), 0, [], {}, 0
        for k, x in p.items():
            p[k], grads[k] = (flat[at : at + x.size].reshape(x.shape) for flat in (flat_p, flat_g))
            at += x.size
        total = sum(map(len, texts))
        lanes = max(1, min(cfg.lanes, total // cfg.window))
        for epoch in range(cfg.epochs):
            flat = np.concatenate([texts[i] for i in rng.permutation(len(texts))])
            length = -(-len(flat) // lanes)
            flat = np.resize(flat, length * lanes).reshape(lanes, length).T  # filled up from its start
            before = np.vstack([np.full((1, lanes), start, flat.dtype), flat[:-1]])
            state, loss = np.zeros((lanes, h), np.float32), 0.0
            for lo in range(0, length, cfg.window):
                x, y = before[lo : lo + cfg.window], flat[lo : lo + cfg.window]
                # A text's first token follows an end, which clears the state: as in scoring, texts are independent.
                flat_g[:] = 0
                live = (x != start).astype(np.float32)
                out, state, kept = self.steps(x, state, live)
                score, back = self.outputs(out, y.ravel(), grads)
                loss -= float(score.sum(dtype=float))
                self._back(x, kept, back, grads, live)
                turn += 1
                rate = cfg.rate * (1 - (epoch + lo / length) / cfg.epochs) + 1e-4
                # Adam with decays 0.9 and 0.99, in place: the gradients are the scratch array from their last use on.
                g = flat_g
                g *= np.float32(8 / y.size)
                np.clip(g, -1, 1, out=g)
                m *= np.float32(0.9)
                m += np.float32(0.1) * g
                g *= g
                g *= np.float32(0.01)
                v *= np.float32(0.99)
                v += g
                np.sqrt(v, out=g)
                g *= np.float32((1 - 0.99**turn) ** -0.5)
                g += np.float32(1e-6)
                np.divide(m, g, out=g)
                g *= np.float32(rate / (1 - 0.9**turn))
                flat_p -= g
            told.append(loss / max(1, flat.size))
        return told

    def _back(self, x: np.ndarray, kept: tuple, back: np.ndarray, grads: dict, live: np.ndarray) -> None:
        """Add the gradients of a window from those of its states, ``back``."""
        h, u = self.h, self.p["u"]
        before, gates, inner = kept
        back = np.ascontiguousarray(back.transpose(0, 2, 1))
        # What a step sends to its products with the state, and by rows to its inputs, where the last third differs.
        dr, rows = np.empty_like(gates[0]), np.empty((*x.shape, 3 * h), gates.dtype)
        clear = (live != 1).any(axis=1)
        later, dn, by, made = np.zeros_like(back[0]), np.empty_like(back[0]), np.empty_like(back[0]), np.zeros_like(u.T)
        for t in range(len(x) - 1, -1, -1):
            z, g, n = gates[t, :h], gates[t, h : 2 * h], gates[t, 2 * h :]
            d, dz, dg, dc = back[t], dr[:h], dr[h : 2 * h], dr[2 * h :]
            d += later
            np.subtract(1, z, out=dn)
            # d (before - n) z (1 - z)
            np.subtract(before[t], n, out=dz)
            dz *= z
            dz *= dn
            dz *= d
            # d (1 - z) (1 - n n)
            dn *= d
            np.multiply(n, n, out=by)
            by *= dn
            dn -= by
            np.multiply(dn, g, out=dc)
            # the same times inner g (1 - g)
            np.subtract(1, g, out=dg)
            dg *= inner[t]
            dg *= dc
            made += dr @ before[t].T
            np.matmul(u, dr, out=later)
            d *= z
            later += d
            if clear[t]:
                later *= live[t]
            rows[t, :, : 2 * h], rows[t, :, 2 * h :] = dr[: 2 * h].T, dn.T
        grads["u"] += made.T
        unit = x.ravel()
        order = np.argsort(unit.astype(np.int16), kind="stable") if len(grads["x"]) < 2**15 else np.argsort(unit, kind="stable")
        unit = unit[order]
        at = np.flatnonzero(np.diff(unit, prepend=-1))
        rows = np.take(rows.reshape(-1, 3 * h), order, axis=0)
        grads["b"] += np.ones(len(rows), rows.dtype) @ rows
        # Sums of many rows are products with ones; those of few are made at once for all such units, row by row.
        sizes = np.diff(at, append=len(unit))
        many, ones = sizes >= 8, np.ones(sizes.max(), rows.dtype)
        for lo, n, k in zip(at[many].tolist(), sizes[many].tolist(), unit[at[many]].tolist(), strict=True):
            grads["x"][k] += ones[:n] @ rows[lo : lo + n]
        few = np.flatnonzero(~many)
        few = few[np.argsort(-sizes[few], kind="stable")]
        sums, sizes, at = np.take(rows, at[few], axis=0), sizes[few], at[few]
        for k in range(1, int(sizes[0]) if len(few) else 0):
            more = np.searchsorted(-sizes, -k, side="left")
            sums[:more] += np.take(rows, at[:more] + k, axis=0)
        grads["x"][unit[at]] += sums


    def scored(self, texts: list[np.ndarray], start: int, lanes: int = 256, window: int = 64) -> np.ndarray:
        """Sum over each whole text of the log probabilities (natural), the state carried from window to window.

        Each lane reads texts one after another, cleared before each; the longest are dealt first, each to the lane with the least.
        """
        if not texts:
            return np.zeros(0)
        loads, dealt = [(0, j) for j in range(min(lanes, len(texts)))], [[] for _ in range(min(lanes, len(texts)))]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            size, j = loads[0]
            dealt[j].append(i)
            heapq.heapreplace(loads, (size + len(texts[i]), j))
        dealt = [dealt[j] for _, j in sorted(loads, reverse=True)]
        order = [i for some in dealt for i in some]
        y = np.concatenate([texts[i] for i in order])
        first = np.cumsum([0, *(len(texts[i]) for i in order)])[:-1]
        sizes = np.array([sum(len(texts[i]) for i in some) for some in dealt])
        offsets = np.cumsum(sizes) - sizes
        x = np.append(np.array([start], y.dtype), y[:-1])
        x[first] = start
        live = np.ones(len(y), np.float32)
        live[first] = 0
        found, state = np.empty(len(y), np.float32), np.zeros((len(sizes), self.h), np.float32)
        at = 0
        while at < sizes[0]:
            n = int(np.searchsorted(-sizes, -at, side="left"))
            span = window * len(sizes) // n  # fewer lanes, longer windows
            steps = np.arange(at, min(at + span, int(sizes[0])))[:, None]
            places = np.minimum(offsets[:n] + steps, len(y) - 1)
            states, state, _ = self.steps(x[places], state[:n], live[places], keep=False)
            if sizes[n - 1] <= steps[-1, 0]:
                here = steps < sizes[:n]
                states, places = states[here], places[here]
            places = places.ravel()
            found[places] = self.outputs(states, y[places])[0]
            at += span
        out = np.zeros(len(texts))
        out[order] = np.add.reduceat(found.astype(float), first)
        return out


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts of ``docs(text)``, each text's end counted as a token. Summed by batch before the shuffle."""

    def run(batches):
        for batch in sliced(batches, 0, 64_000_000):
            words, n = pc.value_counts(words_of(batch.column(0))[0]).flatten()
            yield fields(word=pa.concat_arrays([words, pa.array([END])]), n=pa.concat_arrays([n, pa.array([batch.num_rows])]))

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Model:
    """The fitted network with the counts of the head words and of the tails."""

    def __init__(self, head: list[tuple[bytes, int]], tails: np.ndarray, total: int, distinct: int, cfg: LM):
        self.cfg, self.total, self.distinct = cfg, total, distinct
        words = [w for w, _ in head]
        if END in words:  # the end is a near word always
            words.remove(END)
        counts = dict(head)
        words = [END, *words]
        self.near = min(cfg.near, len(words))
        n = np.array([counts.get(w, 0) for w in words], np.int64)
        self.words = pa.array(words, pa.binary())
        tail = tails_of(self.words, cfg.tails)
        self.unit = np.where(np.arange(len(words)) < self.near, np.arange(len(words)), self.near + tail).astype(np.int32)
        self.log_count = np.log(n + 1.0)
        # What the near words take from the tails' sums.
        mass = tails.astype(float).copy()
        np.subtract.at(mass, tail[: self.near], np.stack([n[: self.near], (n[: self.near] > 0).astype(int)], axis=1))
        self.tail_mass = mass[:, 0] + mass[:, 1] + 1
        self.known = n > 0
        self.inner = np.where(np.arange(len(words)) < self.near, 0.0, self.log_count - np.log(self.tail_mass[tail]))
        self.net = Network(self.near, cfg, np.concatenate([n[: self.near], mass[:, 0].clip(0)]))

    def encoded(self, words: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Units of the words, their places in the head (-1: not there), and the words that are not there."""
        words = pa.array(words, pa.binary()) if isinstance(words, list) else words
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        out = np.flatnonzero(at < 0)
        units, rest = np.take(self.unit, at), words.take(pa.array(out))
        units[out] = self.near + tails_of(rest, self.cfg.tails)
        return units, at, rest

    def texts(self, column: pa.Array) -> list[np.ndarray]:
        """The units of each text of a column, its end included."""
        words, bounds = words_of(column)
        return _ended(self.encoded(words)[0], bounds)

    def fit(self, spark: SparkSession, texts: list[bytes]) -> None:
        sample = self.texts(pa.array(texts, pa.binary()))
        if sum(map(len, sample)) > self.cfg.window:
            task, cfg = spark.sparkContext.broadcast((self.net, sample)), self.cfg

            def make():
                net, texts = task.value
                net.fit(texts, 0, cfg)
                return net.p

            self.net.p = on_one_worker(spark, make)

    def learn(self, train: DataFrame) -> None:
        """Go on from the present weights over all texts of ``train(doc_id, text)``, each once."""
        width, size = 8, sum(x.size for x in self.net.p.values())
        names = [f"c{j}" for j in range(width)]
        for r in range(self.cfg.rounds):
            shared = train.sparkSession.sparkContext.broadcast(self)

            def run(batches, shared=shared, r=r):
                model = shared.value
                cfg, net, n = model.cfg, Network.__new__(Network), 0
                net.__dict__ = {**model.net.__dict__, "p": {k: x.copy() for k, x in model.net.p.items()}}
                for batch in sliced(batches, 0):
                    texts = model.texts(batch.column(0))
                    total = sum(map(len, texts))
                    lanes = max(1, min(cfg.round_lanes, total // (16 * cfg.window)))
                    net.fit(texts, 0, replace(cfg, epochs=1, lanes=lanes, rate=cfg.rate * cfg.round_rate * (1 - r / cfg.rounds)))
                    n += total
                if n:
                    flat = np.concatenate([net.p[k].ravel() for k in sorted(net.p)]).astype(np.float64) * n
                    rows = np.resize(flat, (-(-len(flat) // width), width))
                    yield fields(row=pa.array(np.arange(len(rows))), n=pa.array(np.full(len(rows), n)), **{c: pa.array(np.ascontiguousarray(rows[:, j])) for j, c in enumerate(names)})

            part = train.where("text is not null").where(F.pmod(F.xxhash64("doc_id"), F.lit(self.cfg.rounds)) == r).select("text")
            made = part.mapInArrow(run, "row long, n long, " + ", ".join(f"{c} double" for c in names))
            sums = made.groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow().sort_by("row")
            shared.unpersist()
            if sums.num_rows:
                means = np.stack([sums[c].to_numpy() for c in names], axis=1) / sums["n"].to_numpy()[:, None]
                flat, at = means.ravel()[:size].astype(np.float32), 0
                now = {}
                for k in sorted(self.net.p):
                    old = self.net.p[k]
                    now[k] = flat[at : at + old.size].reshape(old.shape)
                    at += old.size
                self.net.p = now

    def scored(self, column: pa.Array) -> tuple:
        """Of each text of a column: tokens, those known, sums of log(c + 1) and of model log probability but for words beyond the head, and those words with their times."""
        # Texts that repeat are scored once.
        coded = pc.fill_null(column.cast(pa.binary()), b"").dictionary_encode()
        same, texts = coded.indices.to_numpy(), len(coded.dictionary)
        words, bounds = words_of(coded.dictionary)
        units, at, out = self.encoded(words)
        text, held = np.repeat(np.arange(texts), np.diff(bounds)), at >= 0
        away = ~held
        base, inner = np.take(self.log_count, at), np.take(self.inner, at)
        base[away], inner[away] = 0, -np.log(self.tail_mass[units[away] - self.near])

        def sums(x: np.ndarray, end: float) -> np.ndarray:
            return np.bincount(text, x, texts) + end

        known = sums(held & self.known[at], self.known[0]).astype(np.int64)
        model = sums(inner, self.inner[0]) + self.net.scored(_ended(units, bounds), 0)
        kinds = out.dictionary_encode()
        pairs, times = np.unique(text[away] * max(1, len(kinds.dictionary)) + kinds.indices.to_numpy(), return_counts=True)
        of, kind = np.divmod(pairs, max(1, len(kinds.dictionary)))
        rest = pa.StructArray.from_arrays([kinds.dictionary.take(pa.array(kind)), pa.array(times)], ["word", "times"])
        offsets = np.searchsorted(of, np.arange(texts + 1)).astype(np.int32)
        rest = pa.ListArray.from_arrays(pa.array(offsets), rest).take(coded.indices)
        return (np.diff(bounds) + 1)[same].astype(np.int64), known[same], sums(base, self.log_count[0])[same], model[same], rest


def _ended(units: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The units of each text, followed by its end, which is the first unit."""
    ends = bounds[1:] + np.arange(1, len(bounds))
    return np.split(np.insert(units, bounds[1:], 0), ends[:-1]) if len(ends) else []


def _tails(counts: DataFrame, cfg: LM) -> np.ndarray:
    """(sum of counts, distinct words) of each tail class over all words."""

    def run(batches):
        out = np.zeros((cfg.tails, 2), np.int64)
        for batch in batches:
            t = tails_of(batch.column(0), cfg.tails)
            out[:, 0] += np.bincount(t, batch.column(1).to_numpy(), cfg.tails).astype(np.int64)
            out[:, 1] += np.bincount(t, minlength=cfg.tails)
        yield fields(t=pa.array(np.arange(cfg.tails)), n=pa.array(out[:, 0]), d=pa.array(out[:, 1]))

    rows = counts.select("word", "n").mapInArrow(run, "t long, n long, d long").groupBy("t").agg(F.sum("n"), F.sum("d")).collect()
    out = np.zeros((cfg.tails, 2), np.int64)
    for t, n, d in rows:
        out[t] = n, d
    return out


def _head(counts: DataFrame, cfg: LM) -> list[tuple[bytes, int]]:
    """The most frequent words, ``cfg.head`` at most: all above a count that a histogram in sixteenths of powers of two gives."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    least, room = None, cfg.head
    for r in sorted(sizes, reverse=True):
        if r.words > room:
            break
        least, room = r.step, room - r.words
    if least is None:
        return [(bytes(r[0]), r[1]) for r in counts.where(F.col("word") == F.lit(END)).collect()]
    rows = counts.where(step >= least).collect()
    return sorted(((bytes(r[0]), r[1]) for r in rows), key=lambda x: (-x[1], x[0]))


def _sample(train: DataFrame, cfg: LM) -> list[bytes]:
    """Whole texts in the order of a seeded hash of their ids, up to ``fit_docs`` and about ``fit_tokens`` tokens."""
    filled = train.where("length(text) > 0 and doc_id is not null")
    ids = least_hashed(filled.select("doc_id"), "doc_id", cfg.seed, cfg.fit_docs)
    sizes = dict(filled.where(F.col("doc_id").isin(ids)).select("doc_id", F.length("text")).collect()) if ids else {}
    some, room = [], cfg.fit_tokens * 7
    for i in ids:
        if sizes[i] <= room:
            some.append(i)
            room -= sizes[i]
    rows = filled.where(F.col("doc_id").isin(some)).select("doc_id", F.col("text").cast("binary")).collect() if some else []
    return [bytes(r[1]) for r in sorted(rows, key=lambda r: (r[0], bytes(r[1]))) if r[1]]


def fitted(train: DataFrame, cfg: LM = LM()) -> tuple[Model, DataFrame]:
    """The model of ``train(doc_id, text)`` and its counts (word, n)."""
    counts = materialize(counted(train), "counts")
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    model = Model(_head(counts, cfg), _tails(counts, cfg), total or 0, distinct, cfg)
    model.fit(train.sparkSession, _sample(train, cfg))
    model.learn(train)
    return model, counts


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_tokens, n_known, train_tokens, base_score, score, in log10.

    A null or empty text is its end alone. Repeated rows get equal scores. With
    no training text every word is unknown. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in sliced(batches, 1, SLICE):
            n, k, b, s, rest = shared.value.scored(batch.column(1))
            yield fields(doc_id=batch.column(0), n_tokens=pa.array(n), known=pa.array(k), base=pa.array(b), model=pa.array(s), rest=rest)

    first = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, known long, base double, model double, rest array<struct<word: binary, times: long>>")
    first = materialize(first.withColumn("row", F.monotonically_increasing_id()), "scores")
    rest = first.select("row", F.inline("rest")).join(counts, "word").groupBy("row").agg(F.sum("times").alias("k"), F.sum(F.col("times") * F.log(F.col("n") + 1.0)).alias("more"))
    both = first.drop("rest").join(rest, "row", "left")
    more, ten = F.coalesce("more", F.lit(0.0)), F.log(F.lit(10.0))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        ((F.col("base") + more - F.col("n_tokens") * F.log(F.lit(float(model.total + model.distinct + 1)))) / ten).alias("base_score"),
        ((F.col("model") + more) / ten).alias("score"),
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fitted(docs.where(fold(F.col("doc_id"), 7) != 2))
    return scored(docs, model, counts).withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False)))

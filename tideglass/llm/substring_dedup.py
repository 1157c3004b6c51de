"""Substring dedup by sliding sentence spans: runs of consecutive sentences, hashed and joined over all documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fields, joined, materialize, mixed, release, sliced, table, texts_of

#: Bytes of text read at once.
SLICE = 1_000_000

#: A-Z in lower case, and each blank as a space.
_PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Spans:
    """A run has at least as many sentences and words; in a sentence of over two pieces' words each word counts as one."""

    sentences: int = 2
    words: int = 20
    piece: int = 16


class _Parts:
    """The sentences of ``texts``, one array each for all: every sentence is a part, or every word of one of over two pieces' words.

    A sentence ends after . ! or ? before a blank, and at a line's end. Only the
    parts of one sentence follow each other without a gap.
    """

    def __init__(self, texts: list[bytes], spans: Spans):
        raw = b"\n".join([b"", *texts, b""])
        plain = raw.translate(_PLAIN)
        code = np.frombuffer(plain, np.uint8)
        blank = code == 32
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        last = code[ends - 1]
        breaks = np.append(True, (last == ord(".")) | (last == ord("!")) | (last == ord("?")))
        breaks[np.searchsorted(starts, np.flatnonzero(np.frombuffer(raw, np.uint8) == ord("\n")))] = True
        n = len(starts)
        heads = np.flatnonzero(breaks[:n])
        sizes = np.diff(heads, append=n)
        #: The first word of each part, then the number of words.
        self.word = np.append(np.flatnonzero(breaks[:n] | np.repeat(sizes > 2 * spans.piece, sizes)), n)
        #: Whether a sentence begins with the part.
        self.opens = breaks[self.word[:-1]]
        after = self.word[1:]
        inside = np.append(~self.opens[1:], np.zeros(min(1, len(after)), bool))
        offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
        #: The first part of each text, then the number of parts.
        self.bounds = np.searchsorted(starts[self.word[:-1]], offsets)
        #: Each part's bytes in its text.
        shift = np.repeat(offsets[:-1], np.diff(self.bounds))
        self.start, self.end = starts[self.word[:-1]] - shift, ends[after - 1] - shift
        self.end[inside] = starts[after[inside]] - shift[inside]
        # The words, lower-cased, with one blank between them.
        self.plain = code[~(blank & np.append(False, blank[:-1]))].tobytes()
        lengths = ends - starts
        self.to = np.cumsum(lengths + 1)
        self.at = self.to - lengths

    def joined(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words of the parts from each of ``first`` to before ``last``."""
        plain = self.plain
        return [plain[a:b] for a, b in zip(self.at[self.word[first]].tolist(), self.to[self.word[last] - 1].tolist(), strict=True)]


def sentences(text: bytes, spans: Spans = Spans()) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, lower-cased words) of each part of the text."""
    parts = _Parts([text], spans)
    all_ = np.arange(len(parts.opens))
    return [(a, b, w.split()) for a, b, w in zip(parts.start.tolist(), parts.end.tolist(), parts.joined(all_, all_ + 1), strict=True)]


def _picked(heads: np.ndarray, ends: np.ndarray, words, window: int) -> np.ndarray:
    """Of sentences of single words, the places of the least hash of four words among each ``window`` places: equal passages pick equal places wherever they begin."""
    # Three empty places after each sentence.
    room = ends - heads + 3
    to = np.cumsum(room)
    place = np.arange(room.sum()) - np.repeat(to - room - heads, room)
    real = place < np.repeat(ends, room)
    code = np.zeros(len(place), np.uint64)
    code[real] = np.fromiter(map(xxhash.xxh3_64_intdigest, words(place[real])), np.uint64, int(real.sum()))
    n = len(code) - 3
    code = mixed(sum(mixed(code[k : k + n] + np.uint64(k)) * np.uint64(2 * k + 1) for k in range(4)))
    whole = np.flatnonzero(place + window <= np.repeat(ends, room))
    return place[np.unique(np.lib.stride_tricks.sliding_window_view(code, window)[whole].argmin(axis=1) + whole)]


def _runs(word: np.ndarray, opens: np.ndarray, bounds: np.ndarray, words, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 part of the runs of all texts, by first, then last. ``words`` gives those of parts of one word."""
    heads = np.flatnonzero(opens)
    ends = np.append(heads[1:], len(opens))[: len(heads)]
    many = ends - heads > 1
    i = heads
    if many.any():
        i = np.union1d(heads, _picked(heads[many], ends[many], words, max(1, spans.piece // 2)))
    j = np.maximum(i + spans.sentences, np.searchsorted(word, word[i] + spans.words))
    fit = j <= bounds[np.searchsorted(bounds, i, side="right")]
    first = np.minimum(ends - spans.sentences, np.searchsorted(word, word[ends] - spans.words, side="right") - 1)
    back = first >= bounds[np.searchsorted(bounds, heads, side="right") - 1]
    both = np.unique(np.concatenate([i[fit] << 32 | j[fit], first[back] << 32 | ends[back]]))
    return both >> 32, both & (2**32 - 1)


def runs(parts: list[tuple[int, int, list[bytes]]], spans: Spans = Spans()) -> list[tuple[int, int]]:
    """(first, last + 1) of the shortest run from each sentence's start, that to each sentence's end, and those from picked words of long ones, where there are such.

    Every sentence of a repeat that a longer run would cover is in one of these
    inside the repeat. A passage inside a long sentence is met by a run in each
    half piece of its words.
    """
    word = np.cumsum([0, *(len(w) for _, _, w in parts)])
    opens = np.array([i == 0 or parts[i - 1][1] < parts[i][0] for i in range(len(parts))], bool)
    i, j = _runs(word, opens, np.array([0, len(parts)]), lambda at: [parts[k][2][0] for k in at.tolist()], spans)
    return list(zip(i.tolist(), j.tolist(), strict=True))


def _spans(docs: DataFrame, spans: Spans) -> DataFrame:
    def run(batches):
        for batch in sliced(batches, 2, SLICE):
            parts = _Parts([t or b"" for t in texts_of(batch.column(2))], spans)
            i, j = _runs(parts.word, parts.opens, parts.bounds, lambda at: parts.joined(at, at + 1), spans)
            code = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts.joined(i, j))), ">i8").astype(np.int64).reshape(-1, 2)
            of = np.searchsorted(parts.bounds, i, side="right") - 1
            before = parts.bounds[of]
            row = pa.array(of)
            yield fields(doc_id=batch.column(0).take(row), own=batch.column(1).take(row), h1=pa.array(code[:, 0]), h2=pa.array(code[:, 1]), at=pa.array((i - before) << 32 | (j - before)))

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("own"), "text").mapInArrow(run, "doc_id long, own long, h1 long, h2 long, at long")


def repeated_spans(docs: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """(doc_id, own, runs): per text the runs (first << 32 | last + 1) that aren't the run's first occurrence.

    The first occurrence is that of the least (doc_id, text code, position),
    null ids last. A run of any frequency is reduced by partial aggregation and
    written before the join back, so that the runtime can split a frequent one.
    """
    every = materialize(_spans(docs, spans), "spans")
    known = F.coalesce("doc_id", F.lit(2**63 - 1))
    first = materialize(every.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(known).alias("d")).where("n > 1").drop("n"), "first")
    again = materialize(joined(every, first, ["h1", "h2"]), "again")
    release(every)
    release(first)
    here = known == F.col("d")
    # Of the first document's own occurrences, the first stays.
    own = materialize(again.where(here).groupBy("h1", "h2").agg(F.min(F.struct("own", "at")).alias("f")), "own")
    inner = joined(again.where(here), own, ["h1", "h2"]).where(F.struct("own", "at") != F.col("f")).select("doc_id", "own", "at")
    runs = again.where(~here).select("doc_id", "own", "at").union(inner).groupBy("doc_id", "own").agg(F.sort_array(F.collect_set("at")).alias("runs"))
    runs = materialize(runs, "runs")
    release(again)
    release(own)
    return runs


def _cut(texts: list[bytes | None], again: list[list[int] | None], spans: Spans) -> list[tuple[bytes | None, int, int, int]]:
    """Each text without the sentences that its runs ``again`` cover; sentences, sentences and words removed."""
    parts = _Parts([t or b"" for t in texts], spans)
    words, out = np.diff(parts.word), []
    for text, met, lo, hi in zip(texts, again, parts.bounds[:-1].tolist(), parts.bounds[1:].tolist(), strict=True):
        if not met:
            out.append((text, hi - lo, 0, 0))
            continue
        x = np.array(met, np.int64)
        over = np.bincount(x >> 32, minlength=hi - lo + 1) - np.bincount(x & (2**32 - 1), minlength=hi - lo + 1)
        gone = lo + np.flatnonzero(np.cumsum(over[:-1]))
        kept, at = [], 0
        for start, end in zip(parts.start[gone].tolist(), parts.end[gone].tolist(), strict=True):
            kept.append(text[at:start])
            at = end
        kept.append(text[at:])
        out.append((b"".join(kept).strip(b" \t\n\r\x0b\x0c"), hi - lo, len(gone), int(words[gone].sum())))
    return out


def without_repeats(docs: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """``docs(doc_id, text, ...)`` with repeated passages removed from ``text``, plus n_sentences, n_removed and words_removed.

    Every sentence covered by a run whose first occurrence is elsewhere, or
    earlier in the text, goes; all else stays byte for byte, but for blanks at
    the ends of a changed text. Null texts stay null, a text that is all
    repeats becomes empty. Rows that repeat both doc_id and text are one
    document and get equal texts. Other columns are kept; columns of the added
    names are replaced.
    """
    docs = docs.drop("n_sentences", "n_removed", "words_removed")
    again = repeated_spans(docs, spans).withColumnsRenamed({"doc_id": "_d", "own": "_o"})
    rest = [c for c in docs.columns if c != "text"]
    d = docs.select(F.struct(*rest).alias("_rest"), "text")
    met = d.join(again.hint("merge"), F.col("_rest.doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_o")), "left").select("_rest", "text", "runs")

    def run(batches):
        for batch in sliced(batches, 1, SLICE):
            texts, *counts = zip(*_cut(texts_of(batch.column(1)), batch.column(2).to_pylist(), spans), strict=True)
            yield fields(_rest=batch.column(0), text=pa.array(texts, pa.binary()).cast(pa.string()), **{k: pa.array(v, pa.int64()) for k, v in zip(("n_sentences", "n_removed", "words_removed"), counts, strict=True)})

    kind = met.schema["_rest"].dataType.simpleString()
    done = met.mapInArrow(run, f"_rest {kind}, text string, n_sentences long, n_removed long, words_removed long")
    return done.select(*[F.col("text") if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns], "n_sentences", "n_removed", "words_removed")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; those of which nothing is left go."""
    return without_repeats(docs).where("n_removed = 0 or length(text) > 0").select(*docs.columns)

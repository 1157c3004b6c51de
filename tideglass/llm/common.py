"""What the training-data operators share: words, folds, the shared folder and connected components."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.sources.storage import materialize, release

#: A word, and what parts words. ``bytes.split()`` parts UTF-8 text in the same places.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id, parts: int):
    """crc32 of the id's decimal text modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def sliced(batches, column: int, most: int = 6_000_000):
    """The batches' rows in slices of about ``most`` bytes of text at most; a longer text is a slice of its own."""
    for batch in batches:
        if batch.num_rows:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
            start = 0
            while start < batch.num_rows:
                room = most + (ends[start - 1] if start else 0)
                end = max(start + 1, int(np.searchsorted(ends, room, side="right")))
                yield batch.slice(start, end - start)
                start = end


class WordHashes(dict):
    """64-bit hashes of words, kept while there are fewer than ``most``."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of SplitMix64 over unsigned 64-bit integers, a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(column) -> list:
    """UTF-8 bytes, or None, of each value of an Arrow string or binary column."""
    return column.cast("binary").to_pylist()


def on_one_worker(spark: SparkSession, make):
    """What ``make()`` returns, run in one Python worker: small fits use one core there, and none of the driver's."""

    def run(batches):
        for _ in batches:
            pass
        yield fields(made=pa.array([pickle.dumps(make())], pa.binary()))

    return pickle.loads(bytes(spark.range(0, 1, 1, 1).mapInArrow(run, "made binary").first()[0]))


def fitted_from(rows: DataFrame, make):
    """``make(sorted rows)``, run in one Python worker that gets the rows from Spark; they never pass through the driver. For samples of bounded size."""

    def run(batches):
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        yield fields(made=pa.array([pickle.dumps(make(sorted(got)))], pa.binary()))

    made = rows.repartition(1).mapInArrow(run, "made binary").first()
    return pickle.loads(bytes(made[0])) if made else make([])


_STEPS = 10**9


def least_hashed(df: DataFrame, key: str, seed: int, most: int) -> list:
    """The ``most`` values of the column ``key`` of least seeded hash, repeats once; about so many come to the driver, however many tasks there are."""
    n = df.count()
    at = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_STEPS))
    cut = _STEPS if n <= 2 * most else int(_STEPS * (most + 5 * most**0.5 + 5) / n)
    rows = df.select(F.col(key).alias("k"), at.alias("at")).where(F.col("at") <= cut).distinct().collect()
    return [r.k for r in sorted(rows, key=lambda r: (r.at, r.k))[:most]]


def fields(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A sort-merge join: nothing that grows is broadcast, and the runtime splits a frequent key of ``left``.

    It can do so where both sides come from exchanges of their own; an
    aggregate by ``on`` must be materialised before it is the right side.
    """
    return left.join(right.hint("merge"), on, how)


def spread(left: DataFrame, right: DataFrame, on: list[str], by: str, parts: int = 16) -> DataFrame:
    """Join to a ``right`` of one light row a key, each key's rows of ``left`` dealt to ``parts`` tasks by ``by``."""
    salted = left.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    return joined(salted, right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), [*on, "_part"]).drop("_part")


def _joined_here(pairs: DataFrame, most: int = 300_000) -> DataFrame:
    """The pairs of each partition as stars round the least node that they join there: the same components, no shuffle.

    A task holds ``most`` nodes at once at most; beyond that it passes on the stars so far and begins anew.
    """

    def run(batches):
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        def stars() -> pa.RecordBatch:
            rows = [(x, r) for x in list(up) if (r := root(x)) != x]
            return fields(a=pa.array([x for x, _ in rows], pa.int64()), b=pa.array([r for _, r in rows], pa.int64()))

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                up.setdefault(a, a)
                up.setdefault(b, b)
                up[max(a, b)] = min(a, b)
            if len(up) > most:
                yield stars()
                up.clear()
        yield stars()

    return pairs.select("a", "b").mapInArrow(run, "a long, b long")


#: Edges that one task may join; more go by stars.
FEW = 15_000


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``, both long, as ``(node, root)``, root the smallest node reached.

    Each partition first joins what it can by itself. If a bounded number of
    edges is left, one task joins those. Otherwise large-star and small-star
    steps alternate until no edge changes. A step is one aggregate
    and one equi-join that deals a hub's edges to several tasks, and each round is written
    to the shared folder. Nodes without edges aren't listed.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            way = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        else:
            way = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = way.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = spread(way, low, ["u"], "v")
        if large:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        return out.where("a <> b")

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()

    now = materialize(_joined_here(edges).distinct(), label)
    seen = state(now)
    if 0 < seen[0] <= FEW:
        now = _joined_here(now.coalesce(1))
        return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
    # Stars, each node under one root and no root under another: done.
    while seen[0] and (seen[2] < seen[0] or not now.select(F.col("b").alias("a")).join(now.select("a"), "a", "left_semi").isEmpty()):
        new = materialize(_joined_here(star(star(now, True), False)).distinct(), label)
        release(now)
        now, before, seen = new, seen, state(new)
        if before == seen:
            break
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(now.select("b", "b").distinct())

"""MinHash near-duplicates by an inverted join on signature coordinates, every link confirmed on whole shingle sets.

A text's signature is its least hash under each of ``coordinates`` hash
functions. Texts are posted under (coordinate, value). Two texts are candidates
if they agree in ``matches`` coordinates; at similarity 0.8 and 26 of 48 about
one pair in 75,000 is missed. Prefix: only the rarest ``size - matches + 1``
coordinates of a text are joined, since two texts that agree in ``matches``
share one of those. The collisions of a pair in them are counted in one
aggregate. Skip: the long lists behind the prefix are never merged; the count is
completed there by a look into both signatures. A text with fewer than
``matches`` coordinates that any other text has is never posted. Sets of sizes
too far apart to be so similar never share a bucket.

Within a bucket not all pairs are made. Equal sets are one class first. Classes
are then paired with two centres of their bucket (a star, linear in the bucket):
the one whose coordinates collide most, which is nearest to the middle of its
group, and a seeded one. Buckets that have become one component are done.
What is left open, texts of *different* components in one bucket, is checked
whole, so that the components are those of all links: the open texts' shingles
are put in order of frequency, rarest first, and two texts are a pair if they
share one of the first n - 0.8 n + 1 and, being the first they share, it leaves
room for enough others. Loose copies of one text, each with changes of its own,
fall away there without a pair being made, as their own changes come first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WordHashes, components, fields, joined, materialize, mixed, release, table, texts_of


@dataclass(frozen=True)
class Near:
    shingle: int = 5
    percent: int = 80
    coordinates: int = 48
    matches: int = 26
    seed: int = 7
    #: Turns of stars before the rest is checked whole.
    stars: int = 1
    #: Pairs of larger buckets are made block by block.
    block: int = 200


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit codes of the ``k``-word shingles; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    w = hashes.of(words)
    if len(w) < k:
        w, k = np.concatenate([w, np.full(k - len(w), 0x9E37, np.uint64)]), k
    code = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        code = mixed(code + w[i : len(w) - k + 1 + i] + np.uint64(i + 1))
    return np.unique(code)


def _coordinates(near: Near) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(near.seed)
    a, b = rng.integers(0, 2**63, (2, near.coordinates), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def signature(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), 2**64 - 1, np.uint64)
    for at in range(0, len(codes), 2048):
        least = np.minimum(least, (codes[at : at + 2048, None] * a + b).min(axis=0))
    return least


def _words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _node(codes: np.ndarray) -> int | None:
    """A text's class: a signed 64-bit code of its whole set, None for an empty one."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(codes.tobytes())).view(np.int64)) if len(codes) else None


def _signatures(docs: DataFrame, near: Near) -> DataFrame:
    a, b = _coordinates(near)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            n, nodes, sigs = [], [], []
            for text in texts_of(batch.column(1)):
                codes = shingles(_words(text), near.shingle, hashes)
                n.append(len(codes))
                nodes.append(_node(codes))
                sigs.append(signature(codes, a, b).tobytes() if len(codes) else None)
            yield fields(doc_id=batch.column(0), n_shingles=pa.array(n, pa.int64()), node=pa.array(nodes, pa.int64()), sig=pa.array(sigs, pa.binary()))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, node long, sig binary")


def _postings(classes: DataFrame) -> DataFrame:
    """(node, n, key) for every coordinate of every class; the key mixes coordinate and value."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(len(node), -1)
                key = mixed(sig + np.arange(1, sig.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                yield fields(node=pa.array(np.repeat(node, sig.shape[1])), n=pa.array(np.repeat(n, sig.shape[1])), key=pa.array(key.ravel().view(np.int64)))

    return classes.select("node", "n", "sig").mapInArrow(run, "node long, n long, key long")


def _sets(docs: DataFrame, some: DataFrame, near: Near) -> DataFrame:
    """(node, codes) of the classes in ``some``, made anew from the texts of their first documents."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            nodes, sets = [], []
            for text, node in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                codes = shingles(_words(text), near.shingle, hashes)
                if _node(codes) == node:
                    nodes.append(node)
                    sets.append(codes.tobytes())
            yield fields(node=pa.array(nodes, pa.int64()), codes=pa.array(sets, pa.binary()))

    d = docs.select(F.col("doc_id").cast("long").alias("first"), "text")
    return joined(d, some.select("first", "node"), ["first"]).select("text", "node").mapInArrow(run, "node long, codes binary").dropDuplicates(["node"])


def _linked(pairs: DataFrame, classes: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """Of candidate pairs (a, b) those that agree in enough coordinates and whose whole sets are as similar as asked."""
    least, percent = near.matches, near.percent

    def agree(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.filter(pa.array((x == y).sum(axis=1) >= least)).select(["a", "b"])

    def similar(batches):
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    side = lambda t, by, of, name: t.select(F.col("node").alias(by), F.col(of).alias(name))
    signed = joined(joined(pairs, side(classes, "a", "sig", "sa"), ["a"]), side(classes, "b", "sig", "sb"), ["b"])
    agreed = signed.select("a", "b", "sa", "sb").mapInArrow(agree, "a long, b long")
    whole = joined(joined(agreed, side(sets, "a", "codes", "ca"), ["a"]), side(sets, "b", "codes", "cb"), ["b"])
    return whole.select("a", "b", "ca", "cb").mapInArrow(similar, "a long, b long")


def _prefixes(classes: DataFrame, near: Near) -> DataFrame:
    """(key, node, n, middle): each class that can have a partner, posted under its rarest coordinates and two size ranges.

    ``middle`` is the number of collisions of all its coordinates: the greater, the nearer the class is to the middle of a group.
    """
    posts = _postings(classes)
    often = materialize(posts.groupBy("key").agg(F.count("*").alias("often")).where("often > 1"), "often")
    own = Window.partitionBy("node")  # as many rows as there are coordinates at most
    ranked = joined(posts, often, ["key"]).withColumns({"rank": F.row_number().over(own.orderBy("often", "key")), "of": F.count("*").over(own), "middle": F.sum("often").over(own)})
    some = ranked.where((F.col("of") >= near.matches) & (F.col("rank") <= F.col("of") - near.matches + 1))
    # Sizes of similar sets differ by a factor of 100 / percent at most, that is by one range at most.
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / near.percent)) + 1e-9)
    out = materialize(some.withColumn("size", F.explode(F.array(size, size + 1))).select(F.xxhash64("key", "size").alias("key"), "node", "n", "middle"), "prefix")
    release(often)
    return out


def _bound(near: Near, c, n):
    """The greatest size of a set that may be as similar: from (100 + p) * common >= p * (n + n')."""
    return c * ((100.0 + near.percent) / near.percent) - n


def _alike(near: Near, c, n, d, m):
    """Whether sets of n and m shingles that can share c and d at most may be as similar."""
    return F.least(c, d) * (100 + near.percent) >= (n + m) * near.percent


def _star(base: DataFrame, turn: int, near: Near) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's members with two centres of other components, and what to release: the centre nearest the middle, and a seeded one.

    The pairs' collisions are counted before anything is looked up.
    """
    own, code = F.struct("node", "label", "n"), F.xxhash64("node", F.lit(turn))
    ends = base.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("g"), F.max_by(own, F.struct("middle", code)).alias("c1"), F.min_by(own, code).alias("c2"))
    ends = materialize(ends.where("l <> g").select("key", "c1", "c2"), "centres")
    met = joined(base, ends, ["key"]).withColumn("hub", F.explode(F.array_distinct(F.array("c1", "c2"))))
    met = met.where((F.col("label") != F.col("hub.label")) & _alike(near, F.col("n"), F.col("n"), F.col("hub.n"), F.col("hub.n")))
    return met.groupBy(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).agg(F.count("*").alias("collisions")).select("a", "b"), ends


def _shared_first(nodes: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(key, node, n, label, c): each open text under the rarest shingles that a partner must share one of; c is the most it can share from there on."""

    def run(batches):
        for batch in batches:
            codes = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            owner = np.repeat(batch.column(0).to_numpy(), [len(c) for c in codes])
            yield fields(code=pa.array(np.concatenate(codes) if codes else np.zeros(0, np.int64)), node=pa.array(owner, pa.int64()))

    each = materialize(joined(sets, nodes.select("node"), ["node"]).select("node", "codes").mapInArrow(run, "code long, node long"), "shingles")
    often = materialize(each.groupBy("code").agg(F.count("*").alias("k")).where("k > 1"), "often")
    own = joined(joined(each, often, ["code"]).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("k", "code"))).alias("codes")), nodes, ["node"])
    lone = F.col("n") - F.size("codes")  # shared by no other, so first in order
    room = F.col("n") - F.ceil(F.col("n") * near.percent / 100.0 - 1e-9) + 1 - lone
    first = own.where(room > 0).select("node", "n", "label", lone.alias("lone"), F.posexplode(F.slice("codes", 1, room.cast("int"))).alias("i", "x"))
    out = materialize(first.select(F.col("x.code").alias("key"), "node", "n", "label", (F.col("n") - F.col("lone") - F.col("i")).alias("c")), "first")
    release(each)
    release(often)
    return out


def _pairs(posts: DataFrame, near: Near) -> DataFrame:
    """Pairs of different components among postings (key, node, n, label, c), as far as sizes and places allow; larger buckets in blocks of bounded size."""
    ends = posts.groupBy("key").agg(F.min("n").alias("lo"), F.max(_bound(near, F.col("c"), F.col("n"))).alias("hi"), F.min("label").alias("l"), F.max("label").alias("g"))
    ends = materialize(ends.where("l <> g").select("key", "lo", "hi"), "ends")
    kept = materialize(joined(posts, ends, ["key"]).where((F.col("lo") <= _bound(near, F.col("c"), F.col("n"))) & (F.col("n") <= F.col("hi"))).drop("lo", "hi"), "open")
    sizes = kept.groupBy("key").agg(F.count("*").alias("rows"), F.min("label").alias("l"), F.max("label").alias("g")).where("l <> g")
    sizes = materialize(sizes.select("key", F.ceil(F.col("rows") / near.block).cast("int").alias("m")), "sizes")
    base = joined(kept, sizes, ["key"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    x = base.select("key", F.col("own").alias("p"), every.alias("q"), F.col("node").alias("a"), F.col("label").alias("la"), "n", "c")
    y = base.select("key", every.alias("p"), F.col("own").alias("q"), F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("m"), F.col("c").alias("d"))
    met = joined(x, y, ["key", "p", "q"]).where((F.col("la") < F.col("lb")) & _alike(near, F.col("c"), F.col("n"), F.col("d"), F.col("m")))
    out = materialize(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    for t in (ends, kept, sizes):
        release(t)
    return out


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels(node, label)`` after the links ``found(a, b)``."""
    named = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
    ends = joined(joined(found, named("a"), ["a"]), named("b"), ["b"])
    roots = materialize(components(ends.where("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")), "roots"), "roots")
    new = joined(labels, roots.withColumnRenamed("node", "label"), ["label"], "left").select("node", F.coalesce("root", "label").alias("label"))
    new = materialize(new, "labels")
    release(roots)
    return new


def _links(docs: DataFrame, classes: DataFrame, near: Near) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The surviving classes, their components' labels (node, label) and the links (a, b) confirmed."""
    prefix = _prefixes(classes, near)
    some = materialize(joined(classes, prefix.select("node").distinct(), ["node"], "left_semi"), "survivors")
    sets = materialize(_sets(docs, some, near), "sets")
    labels, links = some.select("node", F.col("node").alias("label")), []
    for turn in range(near.stars):
        base = prefix.withColumn("label", F.col("node")) if turn == 0 else joined(prefix, labels, ["node"])
        pairs, ends = _star(base, turn, near)
        links.append(materialize(_linked(pairs, some, sets, near), "links"))
        release(ends)
        labels = _relabelled(labels, links[-1])
    base = joined(prefix, labels, ["node"])
    several = materialize(base.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("g")).where("l <> g").select("key"), "several")
    nodes = materialize(joined(base, several, ["key"]).select("node", "n", "label").distinct(), "unsettled")
    if not nodes.isEmpty():
        posts = _shared_first(nodes, sets, near)
        pairs = _pairs(posts, near)
        links.append(materialize(_linked(pairs, some, sets, near), "links"))
        release(posts)
        release(pairs)
        labels = _relabelled(labels, links[-1])
    for t in (prefix, sets, several, nodes):
        release(t)
    return some, labels, reduce(DataFrame.union, links) if links else some.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, class_id, component_id, links, kept.

    ``class_id`` is the least doc_id with the same shingle set, ``component_id``
    the least one reachable over links, ``links`` the number of links confirmed
    at the row's class in making the components. Null and blank texts have no
    shingles and are linked with nothing. A row of a null doc_id takes part in
    no link: component null, kept. Rows that repeat a doc_id and text get equal
    results; different texts under one doc_id are judged each by itself. An
    empty table gives no rows. Sets are told apart by 64-bit codes.
    """
    sigs = materialize(_signatures(docs, near), "sigs")
    real = sigs.where("node is not null and doc_id is not null")
    classes = materialize(real.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    some, labels, links = _links(docs, classes, near)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    nodes = joined(joined(some.select("node", "first"), labels, ["node"]), degree, ["node"], "left")
    roots = materialize(nodes.groupBy("label").agg(F.min("first").alias("root")), "roots")
    found = joined(nodes, roots, ["label"]).select("node", "root", "links")
    every = materialize(joined(classes.select("node", "first"), found, ["node"], "left"), "classes")
    out = joined(sigs.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", F.xxhash64("doc_id"))).alias("node")), every, ["node"], "left")
    real = F.col("n_shingles") > 0
    out = out.select("doc_id", "n_shingles", F.when(real, F.col("first")).otherwise(F.col("doc_id")).alias("class_id"), F.when(real, F.coalesce("root", "first")).otherwise(F.col("doc_id")).alias("component_id"), F.when(real, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("links"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), Near(shingle=4)).select("doc_id", "n_shingles", "component_id", "kept", "class_id", "links")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: those whose doc_id is their component's least. Five words, 0.8."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept").select("doc_id").distinct()
    return docs.join(kept.hint("merge"), docs.doc_id.eqNullSafe(kept.doc_id), "left_semi")

"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, table

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"
#: Sources whose targets are broadcast at most (about 100 bytes each); more are joined by merge, each source's rows dealt to ``SALTS`` tasks.
FEW_SOURCES = 50_000
SALTS = 256


def _ranked(sizes: DataFrame) -> DataFrame:
    """Add ``rank``, a source's place by code point from 0 on, null last: places within ranges of sources, and the ranges' sizes before."""
    parts = materialize(sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.withColumn("place", F.row_number().over(own) - 1).join(before, "part").withColumn("rank", F.col("place") + F.col("before")).drop("part", "place", "before")


def targets(sizes: DataFrame, total_share: float = 1.0, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Water-filling over ``sizes(source, source_size)``, one row a source.

    Sources by code point, null last, weigh ``weights``, repeating. Shares
    proportional to weight are clamped at ``most_epochs`` times the source, and
    the excess goes to the others by weight, again and again until none is
    above. A round is one aggregate; there are as many as clampings follow from
    each other, seldom more than ten. An empty table gives no rows.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = materialize(_ranked(sizes).select("source", "source_size", w.alias("w"), (F.col("source_size") * most_epochs).alias("cap")), "weights")
    height, full = 0.0, F.lit(False)
    total, clamped = s.agg(F.sum("source_size")).first()[0], -1
    while total is not None:
        here = s.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("caps"), F.sum(F.when(~full, F.col("w"))).alias("open")).first()
        if here.n == clamped or not here.open:
            break
        clamped, height = here.n, (total * float(total_share) - (here.caps or 0)) / here.open
        full = full | (F.col("cap") / F.col("w") < F.lit(height))
    return s.select("source", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(F.lit(height) * F.col("w")).alias("target"))


def mix(docs: DataFrame, total_share: float = 1.0, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``repetitions`` and ``taken`` to ``docs(doc_id, text, source, ...)``.

    Every document is taken floor(target / source size) times. The rest is
    filled by documents in the order of a seeded hash of their id: sizes are
    summed by source and hash bucket (4096 a source), buckets are taken whole
    while that brings the sum nearer to the target, so reruns agree and no task
    holds a source. A null text has size 0; a null source is one source; rows
    with equal ids, null ones too, share one fate. ``docs``' columns of these
    names are replaced, all others kept whatever their names. An empty table
    gives no rows.
    """
    made = ("size", "source_size", "target", "repetitions", "taken")
    code = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    d = docs.select(F.struct(*others).alias("row"), F.col("source").alias("own"), size.alias("size"), F.conv(F.substring(code, 1, 3), 16, 10).cast("int").alias("bucket"), F.conv(F.substring(code, 4, 2), 16, 10).cast("int").alias("salt"))
    buckets = materialize(d.groupBy(F.col("own").alias("source"), "bucket").agg(F.sum("size").alias("s")), "buckets")
    goal = targets(buckets.groupBy("source").agg(F.sum("s").alias("source_size")), total_share, weights, most_epochs)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    before = F.coalesce(F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = buckets.withColumn("before", before).join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    more = F.col("target") - F.col("whole") * F.col("source_size")
    last = F.max(F.when(F.col("before") * 2 + F.col("s") <= more * 2, F.col("bucket")))
    goal = materialize(cut.groupBy("source", "source_size", "target", "whole").agg(last.alias("last")), "targets")
    if goal.count() <= FEW_SOURCES:
        out = d.join(F.broadcast(goal), F.col("own").eqNullSafe(F.col("source")))
    else:
        salted = goal.withColumn("salted", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = d.join(salted.hint("merge"), (F.col("salt") == F.col("salted")) & F.col("own").eqNullSafe(F.col("source")))
    reps = F.col("whole") + F.coalesce((F.col("bucket") <= F.col("last")) & (F.col("whole") < most_epochs), F.lit(False)).cast("long")
    return out.select("row.*", "size", "source_size", "target", reps.alias("repetitions"), (reps * F.col("size")).alias("taken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often and how many words."""
    return mix(docs).where("repetitions > 0")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size,
                  ('0x' || substr(md5('{SEED}' || coalesce(doc_id::varchar, 'null')), 1, 3))::int AS b FROM documents),
k AS (SELECT source, b, sum(size)::bigint AS s FROM d GROUP BY ALL),
n AS (SELECT source, sum(s)::bigint AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::int] AS w FROM k GROUP BY source),
o AS (SELECT *, source_size * 3 AS cap, row_number() OVER (ORDER BY (source_size * 3)::double / w, source ASC NULLS LAST) AS j, (sum(source_size) OVER ())::double AS total FROM n),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double)
             / (sum(w) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::double AS level FROM o),
p AS (SELECT *, min(CASE WHEN level <= cap::double / w THEN j END) OVER () AS open FROM l),
g AS (SELECT source, source_size, CASE WHEN coalesce(j < open, true) THEN cap::double ELSE (max(CASE WHEN j = open THEN level END) OVER ()) * w END AS target FROM p),
h AS (SELECT *, (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::bigint AS whole FROM g),
c AS (SELECT k.source, max(CASE WHEN coalesce(before, 0) * 2 + s <= (target - whole * source_size) * 2 THEN b END) AS last
      FROM (SELECT *, sum(s) OVER (PARTITION BY source ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM k) k
      JOIN h ON k.source IS NOT DISTINCT FROM h.source GROUP BY k.source)
SELECT d.doc_id, d.size, h.source_size, h.target, ((h.whole + (CASE WHEN coalesce(d.b <= c.last, false) AND h.whole < 3 THEN 1 ELSE 0 END)) * d.size)::bigint AS taken
FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source JOIN c ON d.source IS NOT DISTINCT FROM c.source"""

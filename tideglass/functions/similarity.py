"""Vectors as arrays: dot products, norms, hashed n-grams, means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """-1 where the sizes differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda s, x: s + x)).otherwise(-1.0)


def unit(a: Column) -> Column:
    """The vector over its length; null for a zero one."""
    size = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(size > 0, F.transform(a, lambda x: x.cast("double") / size))


def grams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """Character n-grams in order of size and place."""
    one = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[one(n) for n in sizes])


def gram_slots(df: DataFrame, text: Column, row_id: str, dim: int = 384) -> DataFrame:
    """(row_id, slot, weight): hashed 2- and 3-gram counts over their vector's length, the slot from the gram's MD5, so that it is the same everywhere."""
    g = df.select(F.col(row_id), F.explode(grams(text)).alias("g"))
    slot = F.conv(F.substring(F.md5(F.col("g").cast("binary")), 1, 8), 16, 10).cast("long") % dim
    n = g.select(row_id, slot.alias("slot")).groupBy(row_id, "slot").agg(F.count("*").alias("c"))
    return n.select(row_id, "slot", (F.col("c") / F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy(row_id)))).alias("weight"))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector): the mean vector of each key, of unit length. Summed by place, so no group meets in one task as rows."""
    each = df.select(key, F.posexplode(vector).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    arr = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return arr.select(key, unit(F.transform("v", lambda e: e["x"])).alias("vector"))


#: Rows of a dimension that are held as one array; a larger one comes in as many blocks.
HELD = 2000


def held(dimension: DataFrame, key: str, item: Column, name: str) -> tuple[DataFrame, int]:
    """A dimension's rows as arrays in ``name``, one row a block, and the number of blocks; a single block may be broadcast, as its size is bounded."""
    blocks = max(1, -(-dimension.count() // HELD))
    arrays = dimension.groupBy(F.pmod(F.xxhash64(key), F.lit(blocks))).agg(F.collect_list(item).alias(name)).select(name)
    return (F.broadcast(arrays) if blocks == 1 else arrays), blocks


def nearest(rows: DataFrame, row_id: str, vector: str, concepts: DataFrame, concept: str, k: int = 5, sure: float = 0.82, margin: float = 0.05) -> DataFrame:
    """Each row's ``k`` nearest concepts by (similarity down, id), the first's lead over the second, and ``auto`` if it is near and leads enough.

    ``concepts`` is a dimension: its vectors go as arrays with every row, so no
    pair is ever a row. One of more than ``HELD`` concepts meets the rows in
    blocks, whose best are merged by row. A zero vector is at -1 of everything.
    """
    every, blocks = held(concepts, concept, F.struct(F.col(concept).alias("id"), F.col("vector").alias("v")), "_concepts")
    # The row's length divides at the end: it doesn't change the order, and within the lambda it would be summed anew for each concept.
    sims = F.transform("_concepts", lambda c: F.struct((-dot(F.col(vector), c["v"])).alias("d"), c["id"].alias("id")))
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    out = rows.crossJoin(every).select(row_id, F.nullif(size, F.lit(0.0)).alias("_size"), F.slice(F.array_sort(sims), 1, k).alias("_top"))
    if blocks > 1:
        out = out.groupBy(row_id).agg(F.first("_size").alias("_size"), F.slice(F.array_sort(F.flatten(F.collect_list("_top"))), 1, k).alias("_top"))
    place = lambda n: F.get("_top", F.lit(n))
    sim = lambda n: F.when(place(n).isNotNull(), F.coalesce(-place(n)["d"] / F.col("_size"), F.lit(-1.0)))
    out = out.select(row_id, place(0)["id"].alias("top1"), sim(0).alias("sim1"), place(1)["id"].alias("top2"), sim(1).alias("sim2"), F.transform("_top", lambda c: c["id"]).alias("topk"))
    lead = F.coalesce(F.col("sim1") - F.col("sim2"), F.col("sim1"))
    return out.select(row_id, "top1", "sim1", "top2", "sim2", lead.alias("margin"), F.when((F.col("sim1") >= sure) & (lead >= margin), "auto").otherwise("hold").alias("decision"), "topk")

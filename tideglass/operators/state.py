"""Work queues and incremental state as deterministic batch plans: claims, expiry, shards, change detection, slow hosts, crawling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.text import blank
from tideglass.sources.storage import materialize

from .match import first_by

#: How a queue may be ordered.
ORDERS = ("employee_desc_id_asc", "id_asc", "id_desc", "random")


def claim_order(kind: str, row_id: str = "id", size: str | None = "employee_count", seed: str = "") -> list[Column]:
    """Sort keys of a queue; random is a seeded hash of the id, so that reruns agree."""
    if kind == "employee_desc_id_asc" and size:
        return [F.coalesce(F.col(size), F.lit(0)).desc(), F.col(row_id)]
    if kind == "id_desc":
        return [F.col(row_id).desc()]
    if kind == "random":
        return [F.md5(F.concat(F.lit(seed), F.col(row_id).cast("string")).cast("binary")), F.col(row_id)]
    return [F.col(row_id)]


def expired(df: DataFrame, now: Column, ttl_minutes: int = 30, status: str = "status", locked_at: str = "locked_at") -> DataFrame:
    """Running rows locked for longer than the limit, or without a time, are pending again."""
    late = (F.col(status) == "running") & (F.col(locked_at).isNull() | (F.col(locked_at) < now - F.make_interval(mins=F.lit(ttl_minutes))))
    return df.withColumns({status: F.when(late, "pending").otherwise(F.col(status)), locked_at: F.when(~F.coalesce(late, F.lit(False)), F.col(locked_at))})


def claims(df: DataFrame, workers: int, order: Sequence[Column], retry: Sequence[str] = (), per_worker: int = 1, row_id: str = "id", status: str = "status") -> DataFrame:
    """(row_id, worker, turn): the next rows for each of ``workers``, pending ones before those of ``retry`` statuses.

    The plan stands for as many atomic claims in that order; Parquet has no lock.
    Only the rows claimed are ranked in one task: they come from a top-k.
    """
    statuses = ["pending", *retry]
    rank = sum((F.when(F.col(status) == s, i).otherwise(0) for i, s in enumerate(statuses)), F.lit(0))
    top = df.where(F.col(status).isin(*statuses)).withColumn("_rank", rank).orderBy("_rank", *order).limit(workers * per_worker)
    n = F.row_number().over(Window.orderBy("_rank", *order)) - 1
    return top.select(row_id, n.alias("_n")).select(row_id, (F.col("_n") % workers).alias("worker"), F.floor(F.col("_n") / workers).cast("int").alias("turn"))


def shards(df: DataFrame, n: int, row_id: str = "id") -> DataFrame:
    """``shard`` by equal ranges of ids between the least and greatest."""
    ends = df.agg(F.min(row_id).alias("_lo"), F.max(row_id).alias("_hi"))
    step = F.ceil((F.col("_hi") - F.col("_lo") + 1) / n)
    return df.crossJoin(F.broadcast(ends)).withColumn("shard", F.floor((F.col(row_id) - F.col("_lo")) / step).cast("int")).drop("_lo", "_hi")


def unchanged(now: DataFrame, before: DataFrame, key: str, compared: Sequence[str]) -> DataFrame:
    """``now`` with ``change``: new, unchanged (all ``compared`` equal, none blank), or changed."""
    old = before.select(key, *[F.col(c).alias(f"_o_{c}") for c in compared], F.lit(True).alias("_met"))
    out = now.join(old, key, "left")
    same = F.lit(True)
    for c in compared:
        same = same & ~blank(F.col(c)) & (F.col(c) == F.col(f"_o_{c}"))
    return out.withColumn("change", F.when(F.col("_met").isNull(), "new").when(same, "unchanged").otherwise("changed")).drop("_met", *[f"_o_{c}" for c in compared])


def slow_hosts(events: DataFrame, host: str, ts: str, now: Column, ttl_days: int = 7, least: int = 2) -> DataFrame:
    """(host, n, last_ts) of the hosts seen slow often enough within the time to live."""
    recent = events.where(F.col(ts) >= now - F.make_interval(days=F.lit(ttl_days)))
    return recent.groupBy(host).agg(F.count("*").alias("n"), F.max(ts).alias("last_ts")).where(F.col("n") >= least)


def crawl(start: DataFrame, links: DataFrame, pages: int = 6, hops: int = 4) -> DataFrame:
    """(root, url, hop): up to ``pages`` pages of each root by breadth, within one hop by link order.

    ``start(root)`` are URLs, ``links(src, dst, rank)`` ranked links. One join a
    hop; what a root has seen is left out, and what it may still take is cut by
    rank, as a crawler with that budget would. Deterministic.
    """
    seen = start.select("root", F.col("root").alias("url"), F.lit(0).alias("hop"), F.lit(0).cast("long").alias("place"))
    edge = seen
    for hop in range(1, hops + 1):
        found = edge.join(links, edge.url == links.src).groupBy("root", F.col("dst").alias("url")).agg(F.min(F.struct("place", "rank")).alias("o"))
        found = found.join(seen.select("root", "url"), ["root", "url"], "left_anti")
        had = seen.groupBy("root").agg(F.count("*").alias("had"))
        new = first_by(found.join(had, "root").where(F.col("had") < pages), ["root"], ["o", "url"], pages).withColumn("hop", F.lit(hop))
        new = new.withColumn("place", F.row_number().over(Window.partitionBy("root").orderBy("o", "url")).cast("long")).where(F.col("place") <= pages - F.col("had"))
        edge = materialize(new.select("root", "url", "hop", "place"), "hop")
        seen = seen.unionByName(edge)
    return seen.select("root", "url", "hop")

"""Counts, rates, percentiles, buckets with samples, term frequencies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .match import first_by


def counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One pass: rows, and for each condition the rows that meet it."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def percentiles(df: DataFrame, key: str, value: str, at: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Of each key: rows, mean, population deviation, exact interpolated percentiles and the greatest value."""
    each = [F.percentile(value, p).alias(f"p{round(100 * p)}") for p in at]
    return df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), *each, F.max(value).alias("max"))


def match_rates(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]], by: Sequence[str] = ()) -> DataFrame:
    """For each pair of columns: how many rows have both, how many of these are equal, and the share; null over none."""
    aggs = []
    for k, (a, b) in pairs.items():
        both = a.isNotNull() & b.isNotNull()
        aggs += [F.count_if(both).alias(f"{k}_both"), F.count_if(both & (a == b)).alias(f"{k}_same")]
    out = df.groupBy(*by).agg(F.count("*").alias("n"), *aggs)
    return out.withColumns({f"{k}_rate": F.try_divide(F.col(f"{k}_same"), F.col(f"{k}_both")) for k in pairs})


def buckets(df: DataFrame, rules: Mapping[str, Column], order: Sequence[Column | str], samples: int = 20, rest: str = "other") -> DataFrame:
    """The first rule that each row meets as ``bucket``, the bucket's size, and its first ``samples`` rows."""
    out = F.lit(rest)
    for name, cond in reversed(list(rules.items())):
        out = F.when(cond, F.lit(name)).otherwise(out)
    named = df.withColumn("bucket", out)
    sizes = named.groupBy("bucket").agg(F.count("*").alias("bucket_rows"))
    return first_by(named, ["bucket"], order, samples).join(sizes, "bucket")


def terms(df: DataFrame, text: Column, row_id: str, pattern: str, known: DataFrame | None = None, stop: Sequence[str] = (), least: int = 2) -> DataFrame:
    """(term, n, documents, sample): words that ``pattern`` finds, but for stop and ``known(term)`` words and numbers, of ``least`` occurrences; ``sample`` is the first row."""
    words = df.select(F.col(row_id), F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("term"))
    words = words.where(~F.col("term").isin(*stop) & ~F.col("term").rlike("^[0-9]+$")) if stop else words.where(~F.col("term").rlike("^[0-9]+$"))
    found = words.groupBy("term").agg(F.count("*").alias("n"), F.count_distinct(row_id).alias("documents"), F.min(row_id).alias("sample")).where(F.col("n") >= least)
    return found.join(known, "term", "left_anti") if known is not None else found


def fragments(df: DataFrame, text: Column, row_id: str, split: str, keep: str, low: int = 2, high: int = 60, k: int = 5) -> DataFrame:
    """Each row's ``k`` most frequent fragments that ``keep`` matches (all, if none does), by (count down, length, text)."""
    parts = df.select(row_id, F.posexplode(F.split(text, split)).alias("pos", "raw")).withColumn("fragment", F.trim("raw"))
    parts = parts.where(F.length("fragment").between(low, high))
    n = parts.groupBy(row_id, "fragment").agg(F.count("*").alias("n")).withColumn("kept", F.col("fragment").rlike(keep))
    some = n.groupBy(row_id).agg(F.max("kept").alias("any"))
    n = n.join(some, row_id).where(F.col("kept") | ~F.col("any"))
    return first_by(n.select(row_id, "fragment", "n"), [row_id], [F.col("n").desc(), F.length("fragment"), "fragment"], k)

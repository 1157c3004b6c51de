"""Structured Streaming forms: windowed counts with late data, latest state a key, slow hosts, a queue of JSON messages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def stream(spark: SparkSession, sf_dir: str, name: str = "events", schema: T.StructType = EVENTS) -> DataFrame:
    """A table's Parquet as a stream: a folder of files, or a single file by its name."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and values by window and type; what comes later than ``late`` is left out."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def slow_host_state(events: DataFrame, host: str = "user_id", ttl_ms: int = 7 * 86_400_000, least: int = 2) -> DataFrame:
    """(host, n, last_ms) each time a host's count within its time to live reaches ``least``; a host not seen for that long is forgotten."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, last = state.get if state.exists else (0, 0)
        for ms in sorted(int(t.value // 1_000_000) for b in batches for t in b["ts"]):
            n, last = (n + 1 if ms - last <= ttl_ms else 1), ms
        state.update((n, last))
        state.setTimeoutDuration(ttl_ms)
        if n >= least:
            yield pd.DataFrame({"host": [key[0]], "n": [n], "last_ms": [last]})

    return events.select(F.col(host).cast("long").alias("host"), "ts").groupBy("host").applyInPandasWithState(step, "host long, n long, last_ms long", "n long, last_ms long", "update", "ProcessingTimeTimeout")


MESSAGE = "company_name string, name string, address string, pref string, city string, employee_count string"


def messages(lines: DataFrame) -> DataFrame:
    """Company rows out of JSON messages ``lines(value)``; one without name or address is turned away."""
    m = lines.select(F.from_json("value", MESSAGE).alias("m")).select("m.*")
    named = F.coalesce(F.nullif(F.trim("company_name"), F.lit("")), F.nullif(F.trim("name"), F.lit("")))
    place = F.coalesce(F.nullif(F.trim("address"), F.lit("")), F.nullif(F.concat_ws("", "pref", "city"), F.lit("")))
    return m.select(named.alias("company_name"), place.alias("address"), F.col("employee_count").try_cast("int").alias("employee_count")).where("company_name is not null and address is not null")


def drained(frame: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that is available now, through a stream into memory: for tests and bounded replays."""
    query = frame.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return frame.sparkSession.table(name)

"""Keyed table operations: latest and first per key, tiered matching, fill-blank upserts, lookups of two scopes, accuracy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.text import blank


def _orders(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order; null keys are a key of their own."""
    w = Window.partitionBy(*keys).orderBy(*_orders(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def keep_first(df: DataFrame, key: Column, order: Sequence[Column | str], row_id: str) -> DataFrame:
    """The first row of each non-blank key; rows of a blank one all stay."""
    own = F.when(blank(key), F.concat(F.lit("\x00"), F.col(row_id).cast("string"))).otherwise(key)
    return first_by(df.withColumn("_key", own), ["_key"], order).drop("_key")


def insert_new(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows to add: the first of each key that ``target`` lacks. As in SQL a null in a key equals nothing, so such rows are always added."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    keyed = first_by(rows.where(whole), keys, order).join(target.select(*keys).distinct(), list(keys), "left_anti")
    return keyed.unionByName(rows.where(~whole))


def tiered(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: Sequence[tuple[Column, Column]]) -> DataFrame:
    """(left_id, right_id, tier): each left row with the least right row of the first tier whose keys meet.

    Every tier is one equi-join of the keys that are there, made least-per-key
    first so that repeated right keys multiply nothing; blank keys never meet.
    """
    found = None
    for n, (a, b) in enumerate(tiers, 1):
        keys = right.select(b.cast("string").alias("_k"), F.col(right_id)).where(~blank(F.col("_k"))).groupBy("_k").agg(F.min(right_id).alias("_r"))
        met = left.select(F.col(left_id), a.cast("string").alias("_k")).join(keys, "_k").select(left_id, F.col("_r").alias(right_id), F.lit(n).alias("tier"))
        found = met if found is None else found.unionByName(met)
    best = found.groupBy(left_id).agg(F.min_by(F.struct(right_id, "tier"), "tier").alias("m"))
    return best.select(left_id, f"m.{right_id}", "m.tier")


def filled(old: Column, new: Column, text: bool = True) -> Column:
    """The old value unless it is blank (null, for a number)."""
    return F.when(blank(old) & ~blank(new), new).otherwise(old) if text else F.coalesce(old, new)


def upsert_blank(target: DataFrame, rows: DataFrame, key: str, text: Sequence[str] = (), numbers: Sequence[str] = (), stamps: Mapping[str, str] = {}, source: str = "") -> DataFrame:
    """``target`` with blanks filled from the row of the same key, and rows of new keys added.

    ``stamps`` names, for a filled column, the column that then gets ``source``.
    """
    new = rows.select(key, *[F.col(c).alias(f"_n_{c}") for c in (*text, *numbers)], F.lit(True).alias("_met"))
    out = target.join(new, key, "left")
    changed = {c: blank(F.col(c)) & ~blank(F.col(f"_n_{c}")) for c in stamps}
    out = out.withColumns({s: F.when(changed[c], F.lit(source)).otherwise(F.col(s)) for c, s in stamps.items()})
    out = out.withColumns({**{c: filled(F.col(c), F.col(f"_n_{c}")) for c in text}, **{c: filled(F.col(c), F.col(f"_n_{c}"), False) for c in numbers}})
    out = out.drop("_met", *[f"_n_{c}" for c in (*text, *numbers)])
    return out.unionByName(rows.join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def unique_name_update(target: DataFrame, rows: DataFrame, code: str, name: str, value: str, row_id: str) -> DataFrame:
    """``target`` with ``value`` from the row of the same code, else of the same name where the target has that name once."""
    by_code = rows.where(~blank(F.col(code))).groupBy(code).agg(F.min(value).alias("_by_code"))
    by_name = rows.where(~blank(F.col(name))).groupBy(name).agg(F.min(value).alias("_by_name"))
    once = target.groupBy(name).agg(F.count("*").alias("_n")).where("_n = 1").select(name)
    out = target.join(by_code, code, "left").join(by_name.join(once, name, "left_semi"), name, "left")
    return out.withColumn(value, F.coalesce("_by_code", "_by_name", value)).drop("_by_code", "_by_name").select(target.columns)


def taken_by_other(rows: DataFrame, owners: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Rows whose keys another row id already owns: a semi-join with an inequality."""
    other = owners.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(row_id).alias("_other"))
    cond = F.col(row_id) != F.col("_other")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}"))
    return rows.join(other, cond, "left_semi")


def two_scopes(rows: DataFrame, flags: DataFrame, url_key: str, host_key: str, values: Sequence[str]) -> DataFrame:
    """Each row with the flag of its URL, else of its host; ``flags(scope, key, *values)`` has one row a key. Adds ``flag_scope``."""
    side = lambda scope, key: flags.where(F.col("scope") == scope).select(F.col("key").alias(key), F.struct(F.lit(scope).alias("flag_scope"), *values).alias(f"_{scope}"))
    out = rows.join(side("url", url_key), url_key, "left").join(side("host", host_key), host_key, "left")
    return out.withColumn("_f", F.coalesce("_url", "_host")).select(*rows.columns, "_f.*")


def upsert_latest(flags: DataFrame, changes: DataFrame, keys: Sequence[str], stamp: str, order: Sequence[Column | str] = ()) -> DataFrame:
    """The last version of each key over both tables; at equal stamps a change comes before what it changes."""
    both = changes.withColumn("_new", F.lit(1)).unionByName(flags.withColumn("_new", F.lit(0)))
    return first_by(both, keys, [F.col(stamp).desc_nulls_last(), F.col("_new").desc(), *_orders(order)]).drop("_new")


def reference_status(reference: Column, value: Column, alike: Column | None = None) -> Column:
    """no_ref, missing_new, match or mismatch."""
    same = alike if alike is not None else reference == value
    return F.when(blank(reference), "no_ref").when(blank(value), "missing_new").when(same, "match").otherwise("mismatch")


def with_reference(rows: DataFrame, reference: DataFrame, key: str, fields: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Left join to the last reference row of the key; for each field ``reference_f`` and ``accuracy_f``, null where the key has none."""
    last = first_by(reference.where(~blank(F.col(key).cast("string"))), [key], order)
    out = rows.join(last.select(key, *[F.col(f).alias(f"reference_{f}") for f in fields], F.lit(True).alias("_met")), key, "left")
    return out.withColumns({f"accuracy_{f}": F.when(F.col("_met"), reference_status(F.col(f"reference_{f}").cast("string"), F.col(f).cast("string"))) for f in fields}).drop("_met")


def changed(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, old, new) of every value that differs, nulls compared as values."""
    pair = before.select(key, *[F.col(f).cast("string").alias(f"_o_{f}") for f in fields]).join(after.select(key, *[F.col(f).cast("string").alias(f"_n_{f}") for f in fields]), key)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_o_{f}").alias("old"), F.col(f"_n_{f}").alias("new")) for f in fields]))
    return pair.select(key, each.alias("c")).select(key, "c.*").where(~F.col("old").eqNullSafe(F.col("new")))

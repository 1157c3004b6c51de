"""Tables in and out: Parquet, CSV with a sniffed header, JSON dimensions, logs; additive schemas; CSV and JSON lines out."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.functions.text import blank, stripped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Header aliases of the import fields, in order of preference.
ALIASES: Mapping[str, Sequence[str]] = {
    "company_name": ("会社名", "企業名", "法人名", "名称", "company_name", "name"),
    "address": ("住所", "所在地", "本社所在地", "本店所在地", "address"),
    "phone": ("電話番号", "電話", "TEL", "phone"),
    "homepage": ("ホームページ", "URL", "HP", "homepage"),
    "corporate_number": ("法人番号", "corporate_number"),
    "employee_count": ("従業員数", "社員数", "employee_count"),
    "zip_code": ("郵便番号", "郵便", "zip"),
    "prefecture": ("都道府県", "都道府県／地域"),
    "city": ("市区町村", "市区郡"),
}


def header_score(cells: Sequence[str], aliases: Mapping[str, Sequence[str]] = ALIASES, must: str = "company_name") -> int:
    """Three for each field that some cell names, one for each other filled cell, minus five if the name field is missing."""
    names = [c.strip().lstrip("\ufeff") for c in cells if c and c.strip()]
    hit = {f for f, known in aliases.items() if any(n in known for n in names)}
    named = sum(1 for n in names if any(n in known for known in aliases.values()))
    return 3 * len(hit) + (len(names) - named) - (0 if must in hit else 5)


def sniffed(lines: Iterable[str], aliases: Mapping[str, Sequence[str]] = ALIASES) -> tuple[int, str, list[str]]:
    """(line number, delimiter, header cells) of the best-scoring line among those given."""
    best = None
    for i, line in enumerate(lines):
        for sep in (",", "\t", ";", "|"):
            cells = next(csv.reader([line], delimiter=sep), [])
            if len(cells) > 1 and (best is None or header_score(cells, aliases) > best[0]):
                best = (header_score(cells, aliases), i, sep, [c.strip().lstrip("\ufeff") for c in cells])
    if best is None:
        raise ValueError("no line looks like a header")
    return best[1:]


def sniffed_csv(spark: SparkSession, path: str, encoding: str = "utf-8", look: int = 100) -> DataFrame:
    """A CSV file whose header is preceded by other lines: all columns strings, blank rows dropped.

    Only the first ``look`` lines come to the driver. Rows above the header are
    told from others by being equal to what was read there.
    """
    first = [r[0] for r in spark.read.option("encoding", encoding).text(path).limit(look).collect()]
    at, sep, names = sniffed(first)
    schema = T.StructType([T.StructField(n or f"_{i}", T.StringType()) for i, n in enumerate(names)])
    rows = spark.read.option("encoding", encoding).text(path)
    rows = rows.where(~F.col("value").isin(first[: at + 1]))
    cells = F.from_csv("value", ", ".join(f"`{f.name}` string" for f in schema), {"sep": sep})
    return rows.select(cells.alias("r")).select("r.*").where(F.coalesce(*[F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")) for f in schema]).isNotNull())


def aliased(df: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES, trim: bool = True) -> DataFrame:
    """One column per field: the first non-blank of the columns that its aliases name, null where there is none."""
    present = {c.strip().lstrip("\ufeff"): c for c in df.columns}

    def pick(known: Sequence[str]) -> Column:
        cols = [F.col(f"`{present[k]}`").cast("string") for k in known if k in present]
        return F.coalesce(*[F.when(~blank(c), stripped(c) if trim else c) for c in cols]) if cols else F.lit(None).cast("string")

    return df.select(*[pick(known).alias(field) for field, known in aliases.items()])


def column_like(wanted: Sequence[str], columns: Sequence[str]) -> str | None:
    """The first column equal to a wanted name regardless of case, else the first that contains one."""
    low = {c.lower(): c for c in columns}
    for w in wanted:
        if w.lower() in low:
            return low[w.lower()]
    return next((c for w in wanted for c in columns if w.lower() in c.lower()), None)


def evolved(df: DataFrame, schema: T.StructType, dropped: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``schema``'s missing columns added as nulls and its present ones cast; further columns stay but for ``dropped``."""
    have = set(df.columns)
    own = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames() and c not in dropped]
    return df.select(*own, *rest)


def projected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns of ``names`` that exist, in that order."""
    return df.select(*[c for c in names if c in df.columns])


def reset(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Existing columns of ``defaults`` set to their values."""
    return df.withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in defaults.items() if c in df.columns})


def dimension(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The rows of a JSON document's array ``field``."""
    return spark.read.json(path, multiLine=True).select(F.explode(field).alias("r")).select("r.*")


def recent_lines(spark: SparkSession, path: str, marker: str, since: str, stamp: str = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)") -> DataFrame:
    """Log lines holding ``marker`` whose leading timestamp isn't before ``since``; lines without one are left out."""
    at = F.try_to_timestamp(F.regexp_extract("value", stamp, 1))
    return spark.read.text(path).withColumn("at", at).where(F.col("value").contains(marker) & (F.col("at") >= F.lit(since).cast("timestamp")))


def formula_guarded(value: Column) -> Column:
    """A leading quote for text that a spreadsheet would take for a formula."""
    return F.when(value.rlike(r"^[ \t\r\n\u3000]*[=+@-]"), F.concat(F.lit("'"), value)).otherwise(value)


def to_csv(df: DataFrame, path: str, guard: bool = True, mode: str = "errorifexists") -> None:
    """CSV files with headers, nulls as blanks and, if asked, formulas defused in text columns."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    out = df.withColumns({c: formula_guarded(F.col(f"`{c}`")) for c in text}) if guard and text else df
    out.write.mode(mode).option("header", True).option("emptyValue", "").csv(path)


def to_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)

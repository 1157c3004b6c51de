"""Quality rules: a threshold table compiled into Spark projections, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, table

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is it that for on with as was be by this from or an are at not have he she they "
    "le la les de des du et un une que qui en dans pour par sur est pas au aux avec ce il elle "
    "der die das und ein eine zu von mit den dem auf ist nicht sich im als auch es für "
    "el los las y del una con para por se su al lo como no más o"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text whose ``measure`` (SQL over the columns of ``measures``) lies in [low, high]."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2, 15),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.2),
    Rule("exclamations_per_word", "n_exclamations / n_words", None, 0.5),
    Rule("stop_word_share", "n_stop_words / n_words", 0.03, None),
    Rule("repeated_line_share", "n_dup_lines / n_lines", None, 0.5),
)

_OWN = [f"_q_{x}" for x in ("text", "words", "lines", "wins", "sorted", "at")]


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules read; ``df``'s own columns stay, except those of the same names.

    A null text counts as empty: every count is 0. Three-word windows are
    compared by 64-bit hashes within one text.
    """
    t, words, lines, wins, ordered, at = _OWN
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        words: F.filter(F.split(t, BLANK), lambda x: x != ""),
        lines: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    df = df.withColumn(wins, F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))))
    df = df.withColumn(ordered, F.when(F.size(F.array_distinct(wins)) < F.size(wins), F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = lambda x, i: F.when((F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]), x["i"])
    df = df.withColumn(at, F.array_sort(F.array_compact(F.transform(ordered, twice))))
    without = F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))
    return df.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, BLANK, "")).cast("long"),
        "n_symbols": without.cast("long"),
        "n_exclamations": (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.coalesce(F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long"),
    }).drop(*_OWN)


def compiled(rules: tuple[Rule, ...] = RULES) -> str:
    """The threshold table as one SQL condition; a ratio over nothing fails its rule."""
    tests = []
    for r in rules:
        tests += [f"({r.measure}) >= {r.low}"] * (r.low is not None) + [f"({r.measure}) <= {r.high}"] * (r.high is not None)
    return " AND ".join(tests) or "true"


def judged(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with ``base_failed``, ``failed_rules`` and ``kept``.

    A null or empty text, and one of blanks alone, fails the base. Repeated
    rows are judged one by one; the judgement reads the text alone.
    """
    one = lambda r: F.when(~F.coalesce(F.expr(f"n_words > 0 and {compiled((r,))}"), F.lit(False)), F.lit(r.name))
    out = measures(df).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    out = out.withColumn("failed_rules", F.array_compact(F.array(*[one(r) for r in rules])))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*COLUMNS)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, unchanged."""
    rows = judged(docs.select(F.struct(*docs.columns).alias("_row"), "text"))
    # A generator in place of a filter: a filter would be pushed below the measures, and each array made anew for each of its elements.
    return rows.select("_row", F.explode(F.when(F.col("kept"), F.array(F.lit(1))))).select("_row.*")


def _sql_rules() -> str:
    return compiled().replace(" / ", "::double / ")


ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (SELECT t.doc_id, len(ws)::bigint AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
             (length(t) - length(replace(t, '!', '')))::bigint AS n_exclamations,
             len(list_filter(ws, lambda x: list_contains([{", ".join(f"'{w}'" for w in STOP_WORDS)}], lower(x))))::bigint AS n_stop_words,
             len(ls)::bigint AS n_lines, (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(rep.n, 0)::bigint AS n_repeat_words
      FROM t JOIN w USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce({_sql_rules()}, false) AS kept
FROM m"""

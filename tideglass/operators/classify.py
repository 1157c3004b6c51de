"""Category classification: text blocks by weights against a dimension of categories with aliases and keywords."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.similarity import held

from .match import first_by

#: The weight of each kind of text.
BLOCK_WEIGHTS = {"description": 3, "tag": 4, "profile": 2, "extra": 1, "name": 1}


def block_scores(rows: DataFrame, row_id: str, blocks: Mapping[str, Column], categories: DataFrame, weights: Mapping[str, int] = BLOCK_WEIGHTS) -> DataFrame:
    """(row_id, top, sub, score) of every category that a row's blocks name: four times the block's weight for each alias contained, once for each keyword.

    ``categories(top, sub, aliases, keywords)`` is a dimension: it is held as
    arrays of bounded size beside every row and filtered there, so categories
    that a text doesn't name never become rows.
    """
    arrays, _ = held(categories, "sub", F.struct("top", "sub", "aliases", "keywords"), "_categories")

    def hits(text: Column, words: Column) -> Column:
        return F.size(F.filter(words, lambda w: (w != "") & F.contains(text, w)))

    def score(c: Column) -> Column:
        parts = [(hits(t, c["aliases"]) * 4 + hits(t, c["keywords"])) * weights.get(kind, 1) for kind, t in blocks.items()]
        return sum(parts, F.lit(0))

    out = rows.crossJoin(arrays).select(row_id, F.explode(F.filter(F.transform("_categories", lambda c: F.struct(c["top"].alias("top"), c["sub"].alias("sub"), score(c).alias("score"))), lambda x: x["score"] > 0)).alias("c"))
    return out.select(row_id, "c.*")


def ranked(scores: DataFrame, row_id: str, k: int = 8) -> DataFrame:
    """Each row's ``k`` best categories by (score down, longer name first, name). Bounded by the number of categories, not of rows."""
    return first_by(scores, [row_id], [F.col("score").desc(), F.length("sub").desc(), "sub", "top"], k)


def exact_category(rows: DataFrame, row_id: str, text: Column, categories: DataFrame) -> DataFrame:
    """The first category, by ordinal, whose name or parent's name equals the text: one equi-join on both names at once."""
    names = categories.select(F.explode(F.array("sub", "top")).alias("_name"), "ordinal", "top", "sub").where("_name <> ''")
    first = names.groupBy("_name").agg(F.min_by(F.struct("top", "sub"), "ordinal").alias("c"))
    return rows.select(row_id, text.alias("_name")).join(first, "_name").select(row_id, "c.*")

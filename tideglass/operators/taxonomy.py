"""Category dimensions: distinct categories with aliases and keywords, coded levels, and checks of alias tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.text import compact, stripped

#: Endings that don't tell categories apart, and words too general to be keywords.
SUFFIXES = "業界|業|事業|サービス|関連|会社|企業"
GENERIC = ("その他", "全般", "一般", "関連", "各種", "サービス", "事業")


def _base(label: Column) -> Column:
    s = F.regexp_replace(stripped(label), rf"(?<=.)(?:{SUFFIXES})+$", "")
    return s


def _other(label: Column) -> Column:
    """The label without a leading その他."""
    return F.regexp_replace(label, "^その他(?=.)", "")


def aliases(label: Column) -> Column:
    """Compact spellings of a label: whole, without endings, without brackets, without a leading その他."""
    bare = lambda c: F.regexp_replace(c, r"[(（][^)）]*[)）]", "")
    forms = F.array(label, _base(label), bare(label), bare(_base(label)), _other(label), _other(_base(label)))
    return F.array_distinct(F.filter(F.transform(forms, lambda x: compact(x, full=False)), lambda x: x != ""))


def keywords(label: Column) -> Column:
    """Compact parts of a label of two characters and more, general words left out."""
    parts = F.split(_other(F.regexp_replace(_base(label), r"[(（][^)）]*[)）]", "")), r"[・/／、,\s]+|および|及び|と(?=.)")
    parts = F.transform(parts, lambda p: F.regexp_replace(stripped(p), rf"(?<=.)(?:{SUFFIXES})$", ""))
    kept = F.filter(parts, lambda p: ~p.isin(*GENERIC))
    return F.array_distinct(F.filter(F.transform(kept, lambda p: compact(p, full=False)), lambda p: F.length(p) >= 2))


def categories(entries: DataFrame) -> DataFrame:
    """Distinct (top, sub) of ``entries`` with aliases and keywords; blank ones left out."""
    e = entries.select(stripped(F.col("top")).alias("top"), stripped(F.col("sub")).alias("sub")).where("top <> '' and sub <> ''").distinct()
    return e.select("top", "sub", aliases(F.col("sub")).alias("aliases"), keywords(F.col("sub")).alias("keywords"))


def minor_to_major(levels: DataFrame) -> DataFrame:
    """(minor, major) from rows of codes (major, middle, minor, detail): a minor class belongs to its middle class's major one."""
    plain = levels.where("detail = '0000'")
    middle = plain.where("minor = '000' and middle <> '00'").groupBy("middle").agg(F.max("major").alias("of"))
    minor = plain.where("minor <> '000'").join(middle, "middle", "left")
    return minor.select("minor", F.coalesce("of", "major").alias("major")).dropDuplicates(["minor"])


def major_codes(raw: Column) -> Column:
    """Distinct sorted single letters out of a list in one text."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.upper(F.coalesce(raw, F.lit(""))), r"[\s,|/]+"), lambda x: x.rlike("^[A-Z]$"))))


def alias_problems(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(line, problem, detail) of ``rows(line, alias, code, allowed, domain)`` against ``taxonomy(minor, major)``.

    Empty alias or code, unknown code, a major class outside those allowed, one
    alias of several codes, and codes outside the major class that most rows of
    their domain have.
    """
    r = rows.withColumn("allowed_codes", major_codes(F.col("allowed"))).join(taxonomy.withColumnRenamed("minor", "code"), "code", "left").withColumn("key", compact(F.col("alias"), full=False))
    empty = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    one = lambda cond, name, detail: F.when(cond, F.struct(F.lit(name).alias("problem"), detail.alias("detail")))
    own = F.array_compact(F.array(
        one(empty("alias"), "empty_alias", F.lit("")),
        one(empty("code"), "empty_code", F.lit("")),
        one(~empty("code") & F.col("major").isNull(), "unknown_code", F.col("code")),
        one(F.col("major").isNotNull() & (F.size("allowed_codes") == 0), "no_allowed_codes", F.col("code")),
        one((F.size("allowed_codes") > 0) & ~F.array_contains("allowed_codes", F.col("major")), "major_mismatch", F.concat_ws(" not in ", "major", F.array_join("allowed_codes", "|"))),
    ))
    single = r.select("line", F.explode(own).alias("p")).select("line", "p.*")
    several = r.where("key <> ''").groupBy("key").agg(F.array_sort(F.collect_set("code")).alias("codes")).where(F.size("codes") > 1)
    clash = r.join(several, "key").select("line", F.lit("alias_conflict").alias("problem"), F.array_join("codes", ",").alias("detail"))
    votes = r.where((F.coalesce("domain", F.lit("")) != "") & F.col("major").isNotNull()).groupBy("domain", "major").agg(F.count("*").alias("n"))
    first = votes.withColumn("rn", F.row_number().over(Window.partitionBy("domain").orderBy(F.col("n").desc(), "major"))).where("rn = 1").select("domain", F.col("major").alias("usual"))
    outlier = r.join(first, "domain").where("major <> usual").select("line", F.lit("domain_outlier").alias("problem"), F.concat_ws(" of usual ", "major", "usual").alias("detail"))
    return single.union(clash).union(outlier)


def tag_values(raw: Column) -> Column:
    """Tags out of a JSON array or of text parted by line ends, commas, 、, | and /."""
    listed = F.from_json(raw, "array<string>")
    parts = F.when(raw.rlike(r"^\s*\["), listed).otherwise(F.split(raw, r"[\n,、/|]+"))
    return F.filter(F.transform(parts, stripped), lambda x: x != "")


def clean_tags(tags: Column, longest: int = 40, noise: str = r"https?://|@|お問い合わせ|採用|ホーム") -> Column:
    """Tags that aren't noise or too long, the first of each compact spelling."""
    some = F.filter(tags, lambda t: (F.length(t) <= longest) & ~t.rlike(noise) & (compact(t, full=False) != ""))
    return F.aggregate(some, F.array().cast("array<string>"), lambda a, t: F.when(F.exists(a, lambda x: compact(x, full=False) == compact(t, full=False)), a).otherwise(F.concat(a, F.array(t))))

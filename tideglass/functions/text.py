"""Text columns: blanks, widths, Unicode forms, noise, snippets. Native expressions wherever Spark has them."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Python's idea of white space, as a Java character class.
_BLANKS = " \t\n\x0b\x0c\r\u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
HYPHENS = "‐‑‒–—―−－"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def squeezed(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def blank(c: Column) -> Column:
    """Null, empty or white space."""
    return c.isNull() | (stripped(c) == "")


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.when(~blank(c), stripped(c)) for c in cols])


def narrow(c: Column) -> Column:
    """Full-width ASCII and the ideographic space as their narrow forms; the native part of NFKC."""
    return F.translate(c, _WIDE, _NARROW)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


_SEPARATORS = r"[\s/／|｜・,，、。．.\-‐‑–—―ー－_:：;；()（）\[\]「」『』【】]+"


def norm_text(c: Column, full: bool = True) -> Column:
    """Small letters with separators (the long-vowel mark among them) as single blanks; ``full`` takes the NFKC form first."""
    return F.trim(F.regexp_replace(F.lower(nfkc(c) if full else narrow(c)), _SEPARATORS, " "))


def compact(c: Column, full: bool = True) -> Column:
    return F.replace(norm_text(c, full), F.lit(" "), F.lit(""))


def digits(c: Column) -> Column:
    return F.regexp_replace(narrow(c), "[^0-9]", "")


_JAPANESE = r"[\u3040-\u30FF\u4E00-\u9FFF]"


def mojibake(c: Column) -> Column:
    """A replacement character; or at least three Latin-1 letters that are 15 % of a text without Japanese; or a
    typical marker with two such letters."""
    latin, japanese = F.regexp_count(c, F.lit(r"[\u00C0-\u00FF]")), c.rlike(_JAPANESE)
    many = (latin >= 3) & (latin >= 0.15 * F.length(c)) & ~japanese
    marked = c.rlike("[ãâÃÂ]") & (latin >= 2) & ~japanese
    return F.coalesce(c.contains("\ufffd") | many | marked, F.lit(False))


def without_tags(c: Column) -> Column:
    return squeezed(F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " "), r"<[^>]*>", " "))


def sanitized(c: Column, least: int = 0) -> Column:
    """Text of a block of HTML: entities resolved, tags, style and script remains, pipes and controls gone, cut at map and script noise."""
    t = without_tags(unescaped(c))
    t = F.regexp_replace(t, r"(?i)\b(?:style|class|id|href|src|onclick)\s*=\s*(\"[^\"]*\"|'[^']*')", " ")
    t = F.regexp_replace(t, r"[|｜\u0000-\u001F\u007F]", " ")
    t = F.regexp_replace(t, r"(?is)(?:googleマップ|google map|function\s*\(|var\s+\w+\s*=|window\.).*$", "")
    t = squeezed(t)
    return F.when(F.length(t) >= least, t) if least else t


def keep_lines(c: Column, drop: str, always: str | None = None, shortest: int = 0) -> Column:
    """Lines that ``always`` matches, and others that ``drop`` doesn't and that have ``shortest`` characters, white space folded."""
    lines = F.transform(F.split(c, "\n"), squeezed)

    def keep(x: Column) -> Column:
        ok = (x != "") & ~x.rlike(drop) & (F.length(x) >= shortest)
        return ok | x.rlike(always) if always else ok

    return F.concat_ws("\n", F.filter(lines, keep))


def truncated(c: Column, most: int, marks: str = "。．、,.・") -> Column:
    """At most so many characters; a cut text loses its last partial word and trailing punctuation."""
    cut = F.substring(c, 1, most)
    whole = F.when(F.length(c) <= most, c).otherwise(F.regexp_replace(cut, r"\s+\S*\z", ""))
    return F.regexp_replace(whole, f"[{marks}\\s]+\\z", "")


def paragraphs_topk(text: Column, keywords: list[str], k: int = 3, sep: str = "\n", per_keyword: int = 2, chars: float = 50.0, most: float = 4.0) -> Column:
    """The ``k`` paragraphs of most keywords and length, joined in order of score; of equals the earlier first."""
    parts = F.filter(F.transform(F.split(text, sep), lambda p: F.trim(p)), lambda p: p != "")
    hits = lambda p: sum((p.contains(w).cast("int") for w in keywords), F.lit(0))
    scored = F.transform(parts, lambda p, i: F.struct((-(hits(p) * per_keyword + F.least(F.length(p) / chars, F.lit(most)))).alias("s"), i.alias("i"), p.alias("p")))
    return F.array_join(F.transform(F.slice(F.array_sort(scored), 1, k), lambda x: x["p"]), "\n")


def windows(text: Column, pattern: str, around: int = 28, most: int = 3) -> Column:
    """Up to ``most`` matches of ``pattern`` with their surroundings."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{0,{around}}}(?:{pattern}).{{0,{around}}}"), F.lit(0))
    return F.slice(F.transform(found, squeezed), 1, most)


def snippet(text: Column, needle: Column, around: int = 40) -> Column:
    """The first occurrence of ``needle`` with so many characters on either side, white space folded; null if there is none."""
    at = F.locate(needle, text) if isinstance(needle, str) else F.instr(text, needle)
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, squeezed(F.substring(text, start, at - start + F.length(needle) + around)))

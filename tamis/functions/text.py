"""Column functions on names, titles and other short texts.

All map null to null unless they say otherwise. Only the Unicode forms need Python; they run as Arrow-batched UDFs.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unicode_form(col: Column, form: str = "NFKC") -> Column:
    """Unicode normal form; Spark SQL has none."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(form, x) if isinstance(x, str) else None)

    return F.pandas_udf(run, T.StringType())(col)


def fold_accents(col: Column) -> Column:
    """Text without combining marks (compatibility decomposition)."""
    return F.regexp_replace(unicode_form(col, "NFKD"), r"\p{Mn}+", "")


def clean(col: Column) -> Column:
    """White space made single blanks, trimmed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(col, r"[\s ]+", " ")), F.lit(""))


def _dashes(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug(col: Column, length: int = 30, fallback: str | None = None) -> Column:
    """ASCII slug cut to ``length``; an empty one becomes ``fallback``."""
    s = F.left(_dashes(col), F.lit(length))
    return s if fallback is None else F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback))


def folded_slug(col: Column, length: int = 80, fallback: str = "item") -> Column:
    """Slug in which accents are folded and & reads as and."""
    return slug(F.replace(fold_accents(col), F.lit("&"), F.lit(" and ")), length, fallback)


def strict_name_key(col: Column, normalise: bool = True) -> Column:
    """Lower-case name with & as and, and punctuation and symbols as blanks; null if nothing is left."""
    t = unicode_form(col) if normalise else col
    t = F.replace(F.lower(t), F.lit("&"), F.lit(" and "))
    return clean(F.regexp_replace(t, r"[\p{P}\p{S}]+", " "))


#: Words that stand for a missing name.
PLACEHOLDERS = ("unknown", "n/a", "na", "none", "null", "untitled", "test")


def name_problem(col: Column) -> Column:
    """Why a name can't be used, the first that applies; null for a good one. Null and blank names are too short."""
    t = F.coalesce(clean(col), F.lit(""))
    return (
        F.when(F.coalesce(col, F.lit("")).rlike("[\\x00-\\x1f\\x7f]"), "control_characters")
        .when((F.length(t) < 2) | (F.length(t) > 160), "length")
        .when(t.rlike(r"(?i)https?://|www\.|@[^ ]+\.[a-z]{2,}"), "url_or_email")
        .when(~t.rlike(r"[\p{L}\p{N}]"), "no_letter")
        .when(F.lower(t).isin(*PLACEHOLDERS), "placeholder")
    )


def present(col: Column) -> Column:
    """Whether a value says something: not null, blank, or a word for nothing. Never null."""
    return F.coalesce(~F.lower(F.trim(col)).isin("", "null", "unknown", "n/a"), F.lit(False))


def null_words(col: Column) -> Column:
    """Null where the text is the word null in lower or upper case."""
    return F.when(~F.trim(col).isin("null", "NULL"), col)


def first_value(*cols: Column) -> Column:
    """The first of several alias columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def numeric_tokens(col: Column) -> Column:
    """Sorted array of the numbers in a text, commas read as points; what a translation must keep."""
    return F.array_sort(F.transform(F.regexp_extract_all(col, F.lit(r"([0-9]+(?:[.,][0-9]+)*)")), lambda x: F.replace(x, F.lit(","), F.lit("."))))


def has_foreign_script(col: Column) -> Column:
    """Whether a text has Hangul, Han, kana, Cyrillic, Thai or Arabic letters."""
    return col.rlike(r"[\p{IsHangul}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsCyrillic}\p{IsThai}\p{IsArabic}]")


def same_tokens(a: Column, b: Column) -> Column:
    """Whether two texts have the same set of words, whatever their order, case and punctuation."""
    words = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")))
    return words(a) == words(b)


def elevation_m(col: Column) -> Column:
    """Metres of an altitude written as a number, with or without m or masl; null for anything else."""
    return F.when(F.trim(col).rlike(r"(?i)^[0-9]{1,5}(\s*(m|masl))?$"), F.regexp_extract(col, "([0-9]+)", 1).try_cast("int"))


def strip_tags(col: Column) -> Column:
    """Text of simple HTML: scripts and styles dropped, breaks and paragraph ends as line feeds, common entities resolved."""
    t = F.regexp_replace(col, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr)>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(F.regexp_replace(t, "[ \t\u00a0]+", " "), " ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


#: Grades and codes that keep their capitals in a title.
GRADES = "EA|SWP|COE|F1|SL[0-9]+|USDA|SCA|AA|AAA|AB|PB"


def display_title(title: Column, *origins: Column) -> Column:
    """A title without an origin in front of it; titles all in capitals in title case, but for grades and codes."""
    t = F.trim(title)
    for o in origins:
        quoted = F.concat(F.lit(r"(?i)^(?:single origin\s*[:—–-]\s*)?\Q"), F.trim(o), F.lit(r"\E\s*[:|—–-]\s*"))
        rest = F.trim(F.regexp_replace(t, quoted, F.lit("")))
        t = F.when(F.coalesce(F.trim(o) != "", F.lit(False)) & (rest != ""), rest).otherwise(t)
    words = F.transform(F.split(t, r"(?<=[^\p{L}\p{N}])|(?=[^\p{L}\p{N}])"), lambda w: F.when(w.rlike(f"^(?:{GRADES})$"), w).otherwise(F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, 2, 1000)))))
    return F.when((t == F.upper(t)) & t.rlike(r"\p{L}"), F.array_join(words, "")).otherwise(t)


def leading_number(col: Column) -> Column:
    """Seconds of a Retry-After value written as a number; dates are left to ``retry_after_seconds``."""
    return F.regexp_extract(F.trim(col), "^([0-9]{1,9})", 1).try_cast("bigint")


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Seconds from ``now`` told by a Retry-After value, number or HTTP date; never negative, null if unreadable."""
    date = F.try_to_timestamp(F.regexp_extract(value, r"([0-9]{2} [A-Z][a-z]{2} [0-9]{4} [0-9:]{8})", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.coalesce(leading_number(value), F.when(date.isNotNull(), F.greatest(F.lit(0), F.unix_timestamp(date) - F.unix_timestamp(now))))

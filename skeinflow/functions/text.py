"""Text expressions.  All are native columns but for the two pandas functions, which have no SQL counterpart."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .terms import STOPWORDS

#: White space in Python's sense, for engines whose class is ASCII only.
WS = r"[\s\p{Z}]+"
PUNCTUATION = r"[^\p{L}\p{N}_\s]"
# Fixed value: short bracketed marks of a title, opened and closed by any of these.
BRACKETED = r"[\[\(【〔<][^\]\)】〕>]{0,20}[\]\)】〕>]"
CJK = "[가-힣一-鿿]"
DIGITS_ONLY = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"
#: Entities of the native unescape, the ampersand last.
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode compatibility composition."""
    return values.map(lambda v: None if v is None else v if v.isascii() else unicodedata.normalize("NFKC", v))


@F.pandas_udf(T.StringType())
def html_unescape(values: pd.Series) -> pd.Series:
    """All HTML entities."""
    return values.map(lambda v: None if v is None else html.unescape(v) if "&" in v else v)


def html_unescape_basic(c: Column) -> Column:
    for entity, text in BASIC_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(text))
    return c


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS, " "))


def truncate(c: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last being an ellipsis when text is cut."""
    return F.when(F.length(c) > limit, F.concat(F.rtrim(F.substring(c, 1, limit - 1)), F.lit("…"))).otherwise(c)


def clean_text(c: Column, limit: int = 400, *, full: bool = False) -> Column:
    """One line of plain text: tags go first, entities are unescaped after, so an escaped tag stays."""
    stripped = strip_tags(F.coalesce(c, F.lit("")))
    return truncate(collapse_ws(html_unescape(stripped) if full else html_unescape_basic(stripped)), limit)


def normalize_title(c: Column, *, compatibility: bool = True) -> Column:
    if compatibility:  # only texts with other than ASCII characters go to Python
        c = F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)
    c = F.lower(c)
    return collapse_ws(F.regexp_replace(F.regexp_replace(c, BRACKETED, " "), PUNCTUATION, " "))


def title_tokens(c: Column, *, compatibility: bool = True) -> Column:
    """Distinct words but for stopwords and numbers; at least two characters with Hangul or Han, else three."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])

    def keep(w: Column) -> Column:
        return ~F.array_contains(stop, w) & ~w.rlike(DIGITS_ONLY) & (F.length(w) >= F.when(w.rlike(CJK), 2).otherwise(3))

    return F.array_distinct(F.filter(F.split(normalize_title(c, compatibility=compatibility), " "), keep))


def looks_like_html(c: Column) -> Column:
    return F.lower(F.ltrim(F.regexp_replace(F.substring(c, 1, 200), r"^\s+", ""))).rlike("^(<!doctype html|<html)")

"""Text operators: keyword tokens (U1/U2), word-list membership (J11),
character-class check (X11) and HTML title extraction (S13).

All of them are native expressions (``regexp_extract_all``, ``explode``,
joins); texts are processed whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import CHARSET_PATTERN

# Fixed value: a token is a run of letters, marks and digits of any script or,
# kept apart, a run of CJK ideographs (U+4E00..U+9FA5), taken from the
# lower-cased text. The first class is written as a negated one ("no non-letter
# and no ideograph"), which Java's regex and RE2 read alike.
LETTERS = r"(?:[^\P{L}一-龥]|\p{M}|\p{N})+"
TOKEN_PATTERN = LETTERS + "|[一-龥]+"


def tokens(text, words: Sequence[str] = ()) -> Column:
    """The text's keyword tokens, in order. Without ``words`` a run of
    ideographs stays whole; with a dictionary (a list in the code) it is cut
    from left to right into the longest words that match, single ideographs
    where none does -- one native regular expression, longest word first."""
    c = F.col(text) if isinstance(text, str) else text
    pattern = TOKEN_PATTERN
    if words:
        known = sorted({w.lower() for w in words}, key=lambda w: (-len(w), w))
        pattern = "|".join([*map(re.escape, known), LETTERS, "[一-龥]"])
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), 0)


def explode_keywords(df: DataFrame, text: str, out: str = "keyword") -> DataFrame:
    """One row per token (``LATERAL TABLE`` inner semantics: a text with
    no token produces no row)."""
    return df.withColumn(out, F.explode(tokens(text))).drop(text)


def keyword_counts_per_text(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Tokens counted per text: (key, keyword, cnt). Tokenising once per text
    and aggregating right away keeps the exploded rows map-side."""
    return explode_keywords(texts.select(key, text), text).groupBy(key, "keyword") \
        .agg(F.count(F.lit(1)).alias("cnt"))


def search_rows(page_log: DataFrame) -> DataFrame:
    """Search-result page views carrying a keyword item."""
    return page_log.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                          & F.col("item").isNotNull())


def search_keywords(searches: DataFrame, texts: DataFrame, ref: str = "item", key: str = "doc_id",
                    text: str = "text", ts: str = "ts") -> DataFrame:
    """U1 over search texts held in a text table: each search row references
    its text by ``ref``; the result is (ts, keyword, cnt) with cnt = the
    keyword's occurrences in that search's text.

    Each distinct text is tokenised once and pre-aggregated per keyword,
    then joined to the searches (a text referenced by many searches is not
    re-tokenised per search; AQE splits a hot reference).
    """
    per_text = keyword_counts_per_text(texts.select(F.col(key).cast("string").alias("__ref"), text),
                                       "__ref", text)
    s = searches.select(F.col(ts).alias("et"), F.col(ref).alias("__ref"))
    return s.join(per_text, "__ref", "inner").select("et", "keyword", "cnt")


def searched_texts(searches: DataFrame, texts: DataFrame, ref: str = "item", key: str = "doc_id",
                   text: str = "text", tasks: int | None = None) -> DataFrame:
    """(ref, keyword, cnt) of the texts that a search refers to; only those are
    tokenised, in ``tasks`` tasks by ref if given."""
    asked = searches.select(F.col(ref).alias("ref")).distinct()
    t = texts.select(F.col(key).cast("string").alias("ref"), text).join(asked, "ref", "left_semi")
    return keyword_counts_per_text(t.repartition(tasks, "ref") if tasks else t, "ref", text)


# --------------------------------------------------------------------------
# Membership of words in a word list
# --------------------------------------------------------------------------

def flag_words(words: DataFrame, word_col: str, word_list: DataFrame, list_col: str = "word",
               out: str = "listed") -> DataFrame:
    """J11 (re-aimed): each distinct word with ``out`` = whether it is in the
    word list; distinct words are found by an aggregate first."""
    d = words.select(F.col(word_col).alias("word")).where(F.col("word").isNotNull()).distinct()
    wl = word_list.select(F.col(list_col).alias("__w")).distinct()
    return d.join(wl, F.col("word") == F.col("__w"), "left") \
            .select("word", F.col("__w").isNotNull().alias(out))


# --------------------------------------------------------------------------
# X11: whole-string character class
# --------------------------------------------------------------------------

def charset_filter(df: DataFrame, col: str, pattern: str = CHARSET_PATTERN) -> DataFrame:
    """X11: rows whose whole ``col`` consists of the accepted characters."""
    return df.where(F.col(col).rlike(pattern))


# --------------------------------------------------------------------------
# Titles from HTML pages
# --------------------------------------------------------------------------

# Fixed value: the title markup the extractor looks for.
TITLE_PATTERN = r'<span class="title">([^<]*)</span>'


def page_titles(pages: DataFrame, html: str = "html", pattern: str = TITLE_PATTERN,
                keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """S13 (re-aimed): every capture of ``pattern`` in each page's whole
    HTML, one row per item (``pos`` = its position), dropping items that
    contain ``/``."""
    items = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    x = pages.select(*keep, F.posexplode(items).alias("pos", "title"))
    return x.where(~F.col("title").contains("/"))

"""String column functions and emptiness tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c) -> Column:
    """Null or the empty string."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def is_blank(c) -> Column:
    """Null, empty, or whitespace only."""
    return F.coalesce(F.trim(_c(c)), F.lit("")) == F.lit("")


def join_list(arr, sep: str = ",") -> Column:
    """join array elements with a delimiter (null array -> null)."""
    return F.array_join(_c(arr), sep)


def upper_first(c) -> Column:
    """upper-case only the first character."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def lower_first(c) -> Column:
    """lower-case only the first character."""
    c = _c(c)
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def pad(c, width: int, ch: str = "0") -> Column:
    """left-pad to ``width`` with ``ch``."""
    return F.lpad(_c(c).cast("string"), width, ch)


def repeat_char(ch: str, n) -> Column:
    """``ch`` repeated ``n`` times."""
    return F.repeat(F.lit(ch), _c(n) if not isinstance(n, int) else F.lit(n))


def row_key(cols, sep: str = "_", md5_fields: bool = False, md5_all: bool = False) -> Column:
    """row key from a field list joined by ``sep``; optionally md5 per
    field and/or md5 of the whole key."""
    parts = [_c(c).cast("string") for c in cols]
    if md5_fields:
        parts = [F.md5(p) for p in parts]
    key = F.concat_ws(sep, *parts)
    return F.md5(key) if md5_all else key


def snake_to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w[:1].upper() + w[1:] for w in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """rename snake_case columns to camelCase (metadata only)."""
    return df.withColumnsRenamed({c: snake_to_camel(c) for c in df.columns})


# Fixed value: the whole-string character class of the text check -- CJK
# ideographs U+4E00..U+9FA5, ASCII letters and digits, and the listed ASCII and
# full-width punctuation. No whitespace is accepted. Written with literal
# characters so the same text is valid in Java regex and in RE2.
CHARSET_PATTERN = '^[\u4e00-\u9fa5a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+$'


def charset_match(c, pattern: str = CHARSET_PATTERN) -> Column:
    """X11: whole-string character-class test."""
    return _c(c).rlike(pattern)

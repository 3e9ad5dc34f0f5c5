"""Date and time column functions (epoch milliseconds <-> text).

All of them are native Catalyst expressions; the session time zone
(``spark.sql.session.timeZone``) decides the calendar, like the JVM zone did
for the original formatter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats the downstream tables expect.
DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
PARTITION_FMT = "yyyyMMdd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ column -> epoch milliseconds (bigint)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP (``TO_TIMESTAMP_LTZ(x, 3)``)."""
    return F.timestamp_millis(_c(ms).cast("bigint"))


def ms_to_date(ms) -> Column:
    """epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_ts(ms), DATE_FMT)


def ms_to_datetime(ms) -> Column:
    """epoch ms -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ms_to_ts(ms), DATETIME_FMT)


def ms_to_partition(ms) -> Column:
    """epoch ms -> ``yyyyMMdd``."""
    return F.date_format(ms_to_ts(ms), PARTITION_FMT)


def format_ms(ms, pattern: str) -> Column:
    """epoch ms -> text in an arbitrary datetime pattern."""
    return F.date_format(ms_to_ts(ms), pattern)


def datetime_to_ms(text, pattern: str = DATETIME_FMT) -> Column:
    """datetime text -> epoch ms (null when unparseable)."""
    return F.unix_millis(F.try_to_timestamp(_c(text), F.lit(pattern)))


def date_to_ms(text, pattern: str = DATE_FMT) -> Column:
    """date text -> epoch ms at midnight of that date."""
    return F.unix_millis(F.try_to_timestamp(_c(text), F.lit(pattern)))


def flexible_date(text) -> Column:
    """``DATE_FORMAT(create_time, 'yyyy-MM-dd')`` where create_time is
    either epoch-ms text (what the change feed carries) or datetime text.
    Digits-only text is read as epoch ms; anything else as a datetime."""
    t = _c(text)
    return F.when(t.rlike(r"^-?[0-9]+$"), ms_to_date(t.try_cast("bigint"))).otherwise(
        F.date_format(F.try_to_timestamp(t), DATE_FMT))


def days_between(later_date, earlier_date) -> Column:
    """whole days between two dates / date texts."""
    return F.datediff(_c(later_date).cast("date"), _c(earlier_date).cast("date"))


def previous_day(ms) -> Column:
    """the date one day before the epoch-ms instant, as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(ms_to_ts(ms).cast("date"), 1), DATE_FMT)


def event_day(value) -> Column:
    """K8 partition value: epoch seconds or milliseconds (values below 1e10 are
    seconds), formatted ``yyyyMMdd``; unparseable or null -> ``error_bucket``."""
    n = _c(value).cast("string").try_cast("bigint")
    ms = F.when(n < F.lit(10_000_000_000), n * 1000).otherwise(n)
    return F.coalesce(ms_to_partition(ms), F.lit("error_bucket"))

"""Scalar column functions (all built-in Spark expressions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a JVM-style String.trim(): every code point <= U+0020.
_JAVA_TRIM_PATTERN = r"^[\x00-\x20]+|[\x00-\x20]+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Trim control characters and spaces at both ends (not only blanks)."""
    return F.regexp_replace(col_(c), _JAVA_TRIM_PATTERN, "")


def epoch_seconds_ntz(c) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock (``timestamp_ntz``) value.

    Built from the calendar day and the clock fields of the value itself, so
    no time zone (and no daylight-saving rule) of the session is involved.
    """
    ts = col_(c).cast("timestamp_ntz")
    day = F.unix_date(F.to_date(ts)).cast("long")
    return day * 86400 + F.hour(ts).cast("long") * 3600 + F.minute(ts).cast("long") * 60 + F.second(ts).cast("long")


def epoch_micros_ntz(c) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock value (zone-free, like ``epoch_seconds_ntz``)."""
    ts = col_(c).cast("timestamp_ntz")
    frac = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long") - F.second(ts).cast("long") * 1_000_000
    return epoch_seconds_ntz(ts) * 1_000_000 + frac


def year_month_of_epoch(c) -> Column:
    """Epoch seconds (UTC) -> ``yyyyMM`` as int, independent of the session zone."""
    day = F.date_from_unix_date(F.floor(col_(c) / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def split_pipe_list(c) -> Column:
    """Split a ``|`` list the way a JVM ``String.split("\\|")`` does.

    Trailing empty strings are removed, inner and leading ones are kept; the
    empty string gives one empty element, a string made only of pipes gives
    none.
    """
    s = col_(c)
    stripped = F.regexp_replace(s, r"\|+$", "")
    return (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, r"\|")))


def log10_at_least_one(c) -> Column:
    """log base 10 of max(1, n), as ln(x) / ln(10): zero and one both contribute nothing.

    Written as a quotient of natural logs (not ``log10``) so the value is the
    same to the last bit as the original formula (e.g. n = 8).
    """
    return F.log(F.greatest(col_(c), F.lit(1)).cast("double")) / F.log(F.lit(10.0))


def half_star(c) -> Column:
    """Clamp a rating onto the 0.5..5.0 scale."""
    return F.greatest(F.lit(0.5), F.least(F.lit(5.0), col_(c).cast("double")))

"""Small Column builders used across operators.

All of them are built-in Spark expressions, so they stay JVM-side and codegen'd.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnLike) -> Column:
    """Missing in either spelling: NULL or the empty string."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def pad_counter(n: ColumnLike, width: int) -> Column:
    """Zero-pad a counter to ``width`` without ever truncating it.

    Spark's ``lpad`` cuts a longer value down to the width; the counters here
    must keep every digit (10,000 rows under pad 3 stays ``10000``).
    """
    s = _c(n).cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0")


def literal_pattern(text: str) -> str:
    """Regex that matches ``text`` literally (both Java and RE2 accept \\Q..\\E)."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def literal_replacement(text: str) -> str:
    """Replacement string with ``$`` and ``\\`` taken literally (Java syntax)."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replace_first(c: ColumnLike, pattern: str, replacement: str) -> Column:
    """Replace only the first match (``regexp_replace`` replaces all).

    The pattern is wrapped as ``^(.*?)(?:pattern)`` so the lazy prefix stops at
    the first match; the replacement is used literally.
    """
    return F.regexp_replace(_c(c), f"(?s)^(.*?)(?:{pattern})", "$1" + literal_replacement(replacement))


def remove_first(c: ColumnLike, pattern: str) -> Column:
    return replace_first(c, pattern, "")


def regex_trim(c: ColumnLike) -> Column:
    """Trim all white space (``trim`` strips only the space character)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def date_part(c: ColumnLike) -> Column:
    """Date text before a ``T`` time part (``2019-03-01T00:00:00Z`` -> date)."""
    return F.try_to_date(F.substring_index(_c(c), "T", 1), "yyyy-MM-dd")


def compose_date(year: ColumnLike, month: ColumnLike, day: ColumnLike) -> Column:
    """Date from numeric parts; an impossible date (day 0, 31 June) is NULL."""
    txt = F.concat_ws(
        "-",
        _c(year).cast("string"),
        pad_counter(_c(month), 2),
        pad_counter(_c(day), 2),
    )
    return F.try_to_date(txt, "yyyy-MM-dd")

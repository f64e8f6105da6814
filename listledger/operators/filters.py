"""Filters and predicates (F1-F5). All native expressions; Catalyst keeps them
in the scan's whole-stage-codegen stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, is_polish_title

# Fixed values that must equal the reference's (recency rule, F2): listings
# stay valid this many days, and "recent" means posted at most this many
# days ago.
VALIDITY_DAYS = 30
DEFAULT_DAYS_LIMIT = 10


def drop_polish(df: DataFrame, title: str = "title") -> DataFrame:
    """keep listings whose title does not look Polish."""
    return df.where(~is_polish_title(title))


def is_recent(posted_age, days_limit: int = DEFAULT_DAYS_LIMIT) -> Column:
    """``new`` anywhere -> recent; ``left`` with ``<n>d`` -> recent iff
    ``30 - n <= days_limit``; anything else (missing included) -> recent."""
    age = F.lower(F.coalesce(col(posted_age), F.lit("")))
    days = F.regexp_extract(age, r"([0-9]+)d", 1)
    return (
        F.when(age.contains("new"), True)
        .when(age.contains("left") & (days != ""),
              # a day count too large for a long is far in the future: recent
              F.coalesce((F.lit(VALIDITY_DAYS) - days.try_cast("long")) <= F.lit(days_limit), F.lit(True)))
        .otherwise(True)
    )


def keep_recent(df: DataFrame, posted_age: str = "posted_age", days_limit: int = DEFAULT_DAYS_LIMIT) -> DataFrame:
    return df.where(is_recent(posted_age, days_limit))


def skip_comment_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """drop blank lines and ``#`` comments (the line is already stripped)."""
    return df.where((F.col(line) != "") & ~F.col(line).startswith("#"))


def holds_url(cell) -> Column:
    """a cell that may hold a URL: contains ``http``; unless it is a
    HYPERLINK formula it must also contain ``://``."""
    c = col(cell)
    return c.contains("http") & (c.contains("HYPERLINK") | c.contains("://"))

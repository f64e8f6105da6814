"""Routing and naming (R1-R5): projections with URL and string functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, derive_title, url_query_value

# Fixed values that must equal the reference's (routing): URL substring ->
# source, tested in this order; anything else is source A. Rows kept per URL.
SOURCE_B_HOST = "nofluffjobs.com"
SOURCE_C_HOST = "theprotocol.it"
DEFAULT_LIMIT = 50
SOURCE_C_LIMIT = 30


def source_of(url) -> Column:
    """R1: 'B' for nofluffjobs.com, 'C' for theprotocol.it, else 'A'."""
    u = col(url)
    return F.when(u.contains(SOURCE_B_HOST), "B").when(u.contains(SOURCE_C_HOST), "C").otherwise("A")


def limit_of(source) -> Column:
    """R2: rows kept per URL."""
    return F.when(col(source) == "C", SOURCE_C_LIMIT).otherwise(DEFAULT_LIMIT)


def route(watch: DataFrame, url: str = "url") -> DataFrame:
    return watch.withColumn("source", source_of(url)).withColumn("row_limit", limit_of("source"))


def group_titles(watch: DataFrame) -> DataFrame:
    """Per group: its title, else the name derived from its first URL;
    groups with neither are skipped. ``group_idx, sheet_title``.

    Partial aggregation (min of (url_idx, url)) per group: a group holding a
    third of all URLs costs one row per map task."""
    g = watch.groupBy("group_idx").agg(
        F.max(F.nullif(F.col("group_title"), F.lit(""))).alias("_t"),
        F.min(F.struct("url_idx", "url")).alias("_first"),
    )
    title = F.coalesce(F.col("_t"), derive_title(F.col("_first.url")))
    return g.select("group_idx", title.alias("sheet_title")).where(F.col("sheet_title").isNotNull())


def url_param(url, key: str) -> Column:
    """First query-string value of ``key``, decoded; '' when absent."""
    return url_query_value(url, key)


__all__ = ["source_of", "limit_of", "route", "group_titles", "derive_title", "url_param"]

"""Counts (G1-G6). Every one is a partial (map-side) aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import known_urls


def run_summary(groups: DataFrame, cands: DataFrame, new: DataFrame, group_col: str = "group_idx") -> DataFrame:
    """G1: per watched group: new listings, candidates (after F1 and T1), and
    duplicates skipped. Groups without rows show zeros; groups with one title stay apart."""
    c = cands.groupBy(group_col).agg(F.count(F.lit(1)).alias("total_candidates"))
    n = new.groupBy(group_col).agg(F.count(F.lit(1)).alias("new_offers"))
    return (
        groups.select(group_col, "group_title").distinct()
        .join(c, group_col, "left").join(n, group_col, "left")
        .select(
            group_col, "group_title",
            F.coalesce("new_offers", F.lit(0)).cast("long").alias("new_offers"),
            F.coalesce("total_candidates", F.lit(0)).cast("long").alias("total_candidates"),
        )
        .withColumn("skipped", (F.col("total_candidates") - F.col("new_offers")).cast("long"))
    )


def run_total(summary: DataFrame) -> DataFrame:
    """Grand total of new listings (one row)."""
    return summary.agg(
        F.coalesce(F.sum("new_offers"), F.lit(0)).cast("long").alias("total_new"),
        F.coalesce(F.sum("total_candidates"), F.lit(0)).cast("long").alias("total_candidates"),
        F.count(F.lit(1)).cast("long").alias("groups"),
    )


def url_counts(raw: DataFrame, is_polish_col: str = "is_polish") -> DataFrame:
    """Per (group, URL): raw listings and those dropped as Polish."""
    return raw.groupBy("group_idx", "group_title", "url_idx").agg(
        F.count(F.lit(1)).cast("long").alias("raw_count"),
        F.count_if(F.col(is_polish_col)).cast("long").alias("polish_dropped"),
    )


def known_url_counts(ledger: DataFrame) -> DataFrame:
    """Distinct known URLs per table, and the overall distinct count in a
    row with ``sheet = '*'``."""
    per = known_urls(ledger, per_sheet=True)
    by_sheet = per.groupBy("sheet").agg(F.count(F.lit(1)).cast("long").alias("n_urls"))
    total = per.select("url").distinct().agg(F.count(F.lit(1)).cast("long").alias("n_urls")).select(
        F.lit("*").alias("sheet"), "n_urls")
    return by_sheet.unionByName(total)


def known_record_count(records: DataFrame) -> DataFrame:
    """Known records loaded (not distinct)."""
    return records.agg(F.count(F.lit(1)).cast("long").alias("n_records"))


def ledger_counts(ledger: DataFrame, by: str = "sheet", name: str = "n_rows") -> DataFrame:
    """Rows per table (moved, added or migrated, by what is passed in)."""
    return ledger.groupBy(by).agg(F.count(F.lit(1)).cast("long").alias(name))

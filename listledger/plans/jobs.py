"""Whole jobs (J1-J3) as one lazy plan each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, ledger as L, rawledger as R
from ..operators.filters import drop_polish, keep_recent
from ..operators.ordering import top_n_per_key
from ..operators.report import run_summary
from ..session import materialize

RUN_ORDER = ("group_idx", "url_idx", "pos")  # groups in watchlist order: an earlier one wins


@dataclass
class RunResult:
    candidates: DataFrame   # after F1 and T1
    new: DataFrame          # kept by D3-D5, in rank columns
    summary: DataFrame      # G1
    ledger: DataFrame       # the ledger after the run (L8 + L5)
    touched: DataFrame | None = None  # its tables that the run rewrote (column sheet)


def run_listings(listings: DataFrame, ledger: DataFrame, groups: DataFrame,
                 limit=None, max_limit: int | None = 50, recent_days: int | None = None,
                 rewrite_ledger: bool = True, known: DataFrame | None = None) -> RunResult:
    """J1 over extracted listings (unified schema, rank columns
    ``group_idx, url_idx, pos``; ``group_title`` only names the table) and the ledger as it is before the run
    (discards are applied in the rewrite), in the canonical or the raw form; the rewritten one has the same form.

    ``limit``: column or int of the per-URL limit (R2), ``max_limit`` its
    largest value (None: no limit); ``recent_days``: turn on the recency
    filter F2 (off in the reference's run); ``known``: the ledger's known state as digests (``LedgerStore.known``), which
    D3 and D4 then read instead of the ledger."""
    feed = drop_polish(listings)
    if recent_days is not None:
        feed = keep_recent(feed, days_limit=recent_days)
    if max_limit is not None:
        lim = max_limit if limit is None else limit
        feed = top_n_per_key(feed, ["group_idx", "url_idx"], ["pos"], lim, max_limit)
    # the candidates feed the summary, the anti joins and D5's final semi join:
    # extract once, then read the written table (also cuts the lineage)
    cands = materialize(feed, "candidates")

    if known is not None:
        fresh = dedup.drop_known_digests(cands, known)
    else:
        fresh = dedup.drop_known_content(dedup.drop_known_urls(cands, dedup.known_urls(ledger)), dedup.known_records(ledger))
    # D5 reads what is left three times (hash check, twins, final semi join): written once
    fresh = materialize(fresh, "fresh")
    new = materialize(dedup.dedup_ordered(fresh, RUN_ORDER), "new-listings")  # read by the summary and the rewrite

    summary = run_summary(groups, cands, new)
    out_ledger, touched = ledger, None
    if rewrite_ledger:
        # discards (L2, L3), new rows on top (L7, L8) and re-bucketing
        # of every watched table, in one numbering pass
        rows = prepend_rows(new)
        watched = groups.select(F.col("group_title").alias("sheet"))
        if "cells" in ledger.columns:
            out_ledger = R.reorganize_raw(ledger, watched, rows)
            touched = R.touched_raw_tables(ledger, watched, rows).select("sheet")
        else:
            out_ledger = L.reorganize(ledger, watched, rows)
            touched = L.touched_tables(ledger, watched, rows)
    return RunResult(cands, new, summary, out_ledger, touched)


def rewrite_touched(ledger: DataFrame, groups: DataFrame, new: DataFrame) -> tuple[DataFrame, list]:
    """The rewrite of a run (see ``run_listings``) for the tables it touches only: their rows, and their names. The scan of a
    stored ledger prunes the other tables; their discards are read from the status alone."""
    from ..sources.ledger import in_tables

    rows, watched = prepend_rows(new), groups.select(F.col("group_title").alias("sheet"))
    raw = "cells" in ledger.columns
    touched = (R.touched_raw_tables if raw else L.touched_tables)(ledger, watched, rows)
    names = [r[0] for r in touched.select("sheet").distinct().collect()]  # a name a table
    return (R.reorganize_raw if raw else L.reorganize)(ledger.where(in_tables(names)), watched, rows), names


def prepend_rows(new: DataFrame) -> DataFrame:
    """L7 rows in the order they stand on top of their table: each group is prepended
    after the groups before it, so of groups with one title the later one's rows are on top."""
    return L.to_ledger_rows(new.withColumn("_later", -F.col("group_idx")), sheet_col="group_title",
                            order=("_later", "url_idx", "pos"))


def offers_run(spark, sf_dir: str, rewrite_ledger: bool = False, raw: bool = False) -> RunResult:
    """J1 on the B_offers binding: rows with ``pos % 11 = 0`` form the ledger (``raw``: in older layouts),
    the rest the feed; both after F1; per-URL limits as for the sources (R2): 50 for ``en``, 30 else."""
    from ..sources import bindings

    offers = bindings.offers(spark, sf_dir)
    ledger = offers_ledger(spark, sf_dir)
    ledger = materialize(bindings.in_older_layouts(ledger) if raw else ledger, "offers-ledger")  # a ledger is a stored table; D1, D2 and L8 read it
    feed = offers.where(F.col("pos") % 11 != 0)
    limit = F.when(F.col("group_title") == "en", F.lit(50)).otherwise(F.lit(30))
    return run_listings(feed, ledger, offers.select("group_idx", "group_title").distinct(), limit=limit, max_limit=50,
                        rewrite_ledger=rewrite_ledger)


def offers_ledger(spark, sf_dir: str) -> DataFrame:
    """The known part of B_offers as a canonical ledger (one table per group)."""
    from ..sources import bindings

    known = drop_polish(bindings.offers(spark, sf_dir).where(F.col("pos") % 11 == 0))
    # every other row in the older form, title and link in one formula
    old = F.col("pos") % 2 == 0
    mark = F.col("pos").cast("string")
    formula = F.concat(F.lit('=HYPERLINK("https://h.example/'), mark, F.lit('?q=1","Offer '), mark, F.lit('")'))
    return known.select(
        F.col("group_title").alias("sheet"), "pos", F.when(old, formula).otherwise(F.col("title")).alias("title"),
        "company", "tags", F.lit("NEW").alias("status"), F.when(old, F.lit("")).otherwise(F.col("full_url")).alias("link"))


def prepend_counts(ledger: DataFrame, new: DataFrame, summary: DataFrame) -> DataFrame:
    """Per group table: rows added on top and old rows migrated; a
    table without new rows is not rewritten, so nothing is migrated there."""
    old = ledger.groupBy("sheet").agg(F.count(F.lit(1)).alias("_old"))
    return (
        summary.groupBy(F.col("group_title").alias("sheet")).agg(F.sum("new_offers").alias("added"))
        .join(old, "sheet", "left")
        .select("sheet", "added",
                F.when(F.col("added") > 0, F.coalesce("_old", F.lit(0))).otherwise(F.lit(0)).cast("long")
                .alias("migrated"))
    )


def organize_only(ledger: DataFrame, watch: DataFrame) -> DataFrame:
    """Discards to Trash (L2, L3), then re-bucket (L5) the watched tables,
    the tables that lost rows, and Trash, in the canonical or the raw form. No extraction. An untitled group's table is named by R3."""
    from ..operators.routing import group_titles

    watched = group_titles(watch).select(F.col("sheet_title").alias("sheet"))
    return R.reorganize_raw(ledger, watched) if "cells" in ledger.columns else L.reorganize(ledger, watched)


def page_export(pages: DataFrame, out_path: str | None = None) -> DataFrame:
    """Per page: key from the URL (E13), cleaned HTML (E1) and its
    Markdown (E2, E3). Written as parquet when ``out_path`` is given."""
    from ..functions.text import page_key
    from ..operators import extract as X

    clean = X.strip_elements("html")
    out = pages.select(
        "page_id", "url", page_key("url").alias("page_key"), clean.alias("clean_html"),
        F.length(clean).cast("long").alias("clean_chars"), F.md5(clean).alias("clean_md5"),
        X.page_markdown("html").alias("markdown"))
    if out_path:
        out.write.mode("overwrite").parquet(out_path)
    return out


FILES_PER_TASK = 1000


def write_page_files(pages: DataFrame, folder: str, order: str = "page_id") -> DataFrame:
    """J3 / S7 as files: the cleaned HTML (E1) of each page as a text file of its own, in the folder ``page_key=<key>``.
    Keys collide; the last page of a key by ``order`` (a unique column) is the one that stays, as if pages
    were saved one after the other. Null HTML gives an empty file; pages without a URL have no key and are not written.
    Returns the files as read back: ``page_key, clean_html``.

    Only keys that collide are compared, by key and order; ``html`` meets one anti join against the pages that lose, no aggregation,
    and is then dealt by key to tasks of some ``FILES_PER_TASK`` files. A task that ends moves its own files into the folder
    (committer version 2): at version 1 the driver would move all files one after the other when the job ends. The folder is read
    only after the job; a job that fails raises, and may leave some of its files."""
    from ..functions.text import page_key
    from ..operators import extract as X

    keyed = pages.select(order, page_key("url").alias("page_key"), X.strip_elements("html").alias("clean_html")).where("page_key <> ''")
    collide = keyed.groupBy("page_key").agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    lost = keyed.select("page_key", order).join(collide, "page_key").where(F.col(order) < F.col("_last")).select(order)
    tasks = keyed.count() // FILES_PER_TASK + 1
    (keyed.join(lost, order, "left_anti").select("page_key", "clean_html").repartition(tasks, "page_key")
     .write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("page_key").text(folder))
    files = pages.sparkSession.read.schema("value string, page_key string").text(folder, wholetext=True)
    return files.select("page_key", F.expr("left(value, length(value) - 1)").alias("clean_html"))  # a text ends in the writer's \n


def extract_listings_with(registry, watch_pages: DataFrame) -> DataFrame:
    """Same as ``extract_listings`` with any extractor registry."""
    routed = watch_pages.withColumn("source", registry.source_of(F.col("url")))
    out = registry.extract(routed).withColumnRenamed("route", "source")
    return out.withColumn("row_limit", registry.limit_of(F.col("source")))


def extract_listings(watch_pages: DataFrame) -> DataFrame:
    """Pages -> unified listings: R1 routes each URL to its extractor (one
    filtered branch per source, then a union), E* extract.

    ``watch_pages``: ``url, page_id, html`` and any keys that are to ride along."""
    from ..functions import cards as C
    from ..operators import extract as X
    from ..operators.routing import limit_of, source_of

    routed = watch_pages.withColumn("source", source_of("url")).withColumn("route", F.col("source"))
    keep = [c for c in routed.columns if c != "source"]
    a = X.extract_source_a(routed.where(F.col("source") == "A").select(*keep))
    bc = X.extract_html_sources(routed.where(F.col("source") != "A").select(*keep, "source"),
                                {"B": C.SOURCE_B, "C": C.SOURCE_C})
    listings = X.unify(a.drop("source"), bc.drop("source")).drop("source")
    return listings.withColumnRenamed("route", "source").withColumn("row_limit", limit_of("source"))


def full_run(watch: DataFrame, pages: DataFrame, ledger: DataFrame, rewrite_ledger: bool = True) -> RunResult:
    """J1 end to end: discards (L2, L3), known URLs and records from every
    table (D1, D2), then pages -> listings (S4, R1, E*) -> F1 -> T1 -> D3-D5
    -> prepend (L7, L8) -> re-bucket (L5) -> summary (G1)."""
    from ..operators.routing import DEFAULT_LIMIT, SOURCE_C_LIMIT, group_titles

    # Known URLs and records come from every table, Trash included, so moving
    # rows to Trash first does not change them; the rewrite does the moves.
    groups = group_titles(watch).select("group_idx", F.col("sheet_title").alias("group_title"))
    w = watch.select("group_idx", "url_idx", "url").where(F.col("url").isNotNull()).join(groups, "group_idx")
    listings = watched_listings(w, pages)
    return run_listings(listings, ledger, groups, limit=F.col("row_limit"),
                        max_limit=max(DEFAULT_LIMIT, SOURCE_C_LIMIT), rewrite_ledger=rewrite_ledger)


def watched_listings(watch: DataFrame, pages: DataFrame) -> DataFrame:
    """The listings of the watched pages with their watch keys. Extracts once per page, then
    joins the slim listings to the watchlist (a URL watched by two groups yields its listings
    once per group): ``html`` meets no join. A page is read only if the hash
    of its URL is one of the watched ones; the join decides exactly. Pages are small as files and dear to parse: they are dealt
    evenly to tasks of some ``PAGES_PER_TASK``, one a core at least, however few files hold them."""
    slots = [r[0] for r in watch.select(_url_slot("url")).distinct().collect()]  # at most URL_SLOTS numbers
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, pages.count() // PAGES_PER_TASK + 1)
    read = pages.select("page_id", "url", "html").where(_url_slot("url").isin(slots)).repartition(tasks)
    return extract_listings(read).join(watch, "url")


URL_SLOTS = 4096
PAGES_PER_TASK = 1000


def _url_slot(url: str):
    return F.pmod(F.xxhash64(url), F.lit(URL_SLOTS))

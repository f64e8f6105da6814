"""Registered queries: one per operator of the inventory, each reading the
driver's tables through a binding. ``(spark, sf_dir) -> DataFrame``.

Column names equal those of the DuckDB oracles in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_polish_title
from ..operators import dedup, filters, ledger as L, report
from ..operators.ordering import top_n_per_key
from ..sources import bindings
from ..session import table
from . import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------------
# Filters, top-N, de-duplication, run


@query("polish_filter")
def q_polish_filter(spark, sf):
    return filters.drop_polish(bindings.offers(spark, sf)).select("pos", "group_title", "title")


@query("recent_filter")
def q_recent_filter(spark, sf):
    return filters.keep_recent(bindings.ages(spark, sf)).select("event_id", "posted_age")


def _feed_after_f1(spark, sf):
    offers = bindings.offers(spark, sf)
    return filters.drop_polish(offers.where(F.col("pos") % 11 != 0))


@query("topn_per_url")
def q_topn(spark, sf):
    limit = F.when(F.col("group_title") == "en", F.lit(50)).otherwise(F.lit(30))
    return top_n_per_key(_feed_after_f1(spark, sf), ["group_idx", "url_idx"], ["pos"], limit, 50).select(
        "group_idx", "group_title", "url_idx", "pos")


@query("dedup_url")
def q_dedup_url(spark, sf):
    urls = dedup.known_urls(jobs.offers_ledger(spark, sf))
    return dedup.drop_known_urls(_feed_after_f1(spark, sf), urls).select("group_title", "url_idx", "pos", "full_url")


@query("dedup_content")
def q_dedup_content(spark, sf):
    recs = dedup.known_records(jobs.offers_ledger(spark, sf))
    return dedup.drop_known_content(_feed_after_f1(spark, sf), recs).select("group_title", "url_idx", "pos", "title")


@query("dedup_ordered")
def q_dedup_ordered(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("https://x.example/o/"), ((F.col("doc_id") * 7919) % 800).cast("string")).alias("full_url"),
        F.col("text").alias("title"), F.col("lang").alias("company"), F.lit("").alias("tags"))
    return dedup.dedup_ordered(d, ["doc_id"]).select("doc_id", "full_url")


@query("full_run_summary")
def q_full_run_summary(spark, sf):
    return jobs.offers_run(spark, sf).summary


@query("run_total")
def q_run_total(spark, sf):
    return report.run_total(jobs.offers_run(spark, sf).summary)


@query("url_counts")
def q_url_counts(spark, sf):
    raw = bindings.offers(spark, sf).withColumn("is_polish", is_polish_title("title"))
    return report.url_counts(raw)


@query("known_urls")
def q_known_urls(spark, sf):
    return dedup.known_urls(bindings.sheets(spark, sf))


@query("known_urls_raw")
def q_known_urls_raw(spark, sf):
    return dedup.known_urls(bindings.raw_sheets(spark, sf))


@query("known_records")
def q_known_records(spark, sf):
    return dedup.known_records(bindings.raw_sheets(spark, sf))


@query("known_url_counts")
def q_known_url_counts(spark, sf):
    return report.known_url_counts(bindings.sheets(spark, sf))


@query("known_record_count")
def q_known_record_count(spark, sf):
    return report.known_record_count(dedup.known_records(bindings.sheets(spark, sf)))


# --------------------------------------------------------------------------
# Ledger (S5, S6, S8-S11, L1-L10, T3, G6, J2)

from ..sources import ledger as store  # noqa: E402


@query("ledger_scan")
def q_ledger_scan(spark, sf):
    return store.scan(bindings.sheets(spark, sf))


@query("ledger_by_header")
def q_ledger_by_header(spark, sf):
    return store.by_header(bindings.raw_sheets(spark, sf))


@query("discard_keep")
def q_discard_keep(spark, sf):
    kept, _ = L.split_discards(bindings.sheets(spark, sf))
    return kept.select("sheet", "pos", "title", "status")


@query("discard_moved")
def q_discard_moved(spark, sf):
    _, moved = L.split_discards(bindings.sheets(spark, sf))
    return moved.select("sheet", "pos", "title", "status")


@query("trash_after")
def q_trash_after(spark, sf):
    after = L.process_discards(bindings.sheets(spark, sf))
    return after.where(F.col("sheet") == L.TRASH).select("pos", "title", "status", "link")


@query("status_bucket")
def q_status_bucket(spark, sf):
    s = bindings.sheets(spark, sf)
    return s.select("sheet", "pos", "status", L.status_bucket("status").cast("int").alias("bucket"))


@query("status_order")
def q_status_order(spark, sf):
    return L.status_order(bindings.sheets(spark, sf)).select("sheet", "pos", "title", "status", "link")


def _organized(spark, sf):
    return jobs.organize_only(bindings.sheets(spark, sf), bindings.watch_groups(spark, sf))


@query("organize_only")
def q_organize_only(spark, sf):
    return _organized(spark, sf).select("sheet", "pos", "title", "company", "status", "link")


@query("bucket_ranges")
def q_bucket_ranges(spark, sf):
    return L.bucket_ranges(_organized(spark, sf))


@query("ledger_counts")
def q_ledger_counts(spark, sf):
    _, moved = L.split_discards(bindings.sheets(spark, sf))
    return report.ledger_counts(moved, name="n_moved")


@query("migrate_rows")
def q_migrate_rows(spark, sf):
    return L.migrate_rows(bindings.raw_sheets(spark, sf))


def _told(raw):
    """A raw ledger with its arrays as JSON texts."""
    return raw.select("sheet", "pos", *[F.to_json(F.transform(c, lambda x: F.coalesce(x, F.lit("")))).alias(c) for c in ("header", "cells")])


@query("organize_raw")
def q_organize_raw(spark, sf):
    return _told(jobs.organize_only(bindings.raw_ledger(spark, sf), bindings.watch_groups(spark, sf)))


@query("full_run_raw")
def q_full_run_raw(spark, sf):
    return _told(jobs.offers_run(spark, sf, rewrite_ledger=True, raw=True).ledger)


@query("to_ledger_row")
def q_to_ledger_row(spark, sf):
    run = jobs.offers_run(spark, sf)
    return L.to_ledger_rows(run.new, order=()).select("sheet", "title", "company", "tags", "status", "link")


@query("ledger_prepend")
def q_ledger_prepend(spark, sf):
    return jobs.offers_run(spark, sf, rewrite_ledger=True).ledger.select("sheet", "pos", "title", "status", "link")


@query("ledger_append")
def q_ledger_append(spark, sf):
    run = jobs.offers_run(spark, sf)
    rows = L.to_ledger_rows(run.new, order=("group_idx", "url_idx", "pos"))
    return store.append(jobs.offers_ledger(spark, sf), rows).select("sheet", "pos", "title", "status", "link")


@query("prepend_guard")
def q_prepend_guard(spark, sf):
    run = jobs.offers_run(spark, sf)
    return jobs.prepend_counts(jobs.offers_ledger(spark, sf), run.new, run.summary)


@query("ledger_sheets")
def q_ledger_sheets(spark, sf):
    w = routing.group_titles(bindings.watch_groups(spark, sf)).withColumnRenamed("sheet_title", "group_title")
    return store.sheet_list(w, bindings.sheets(spark, sf))


# --------------------------------------------------------------------------
# Watchlist, routing, naming

from ..operators import routing  # noqa: E402
from ..sources import watchlist  # noqa: E402
from ..session import scratch_path  # noqa: E402


@query("route_source")
def q_route_source(spark, sf):
    return routing.route(bindings.watch_urls(spark, sf)).select("page_id", "url", "source", "row_limit")


@query("derive_title")
def q_derive_title(spark, sf):
    return bindings.watch_urls(spark, sf).select("page_id", "url", routing.derive_title("url").alias("title"))


@query("url_param")
def q_url_param(spark, sf):
    u = bindings.watch_urls(spark, sf)
    return u.select("page_id", *[routing.url_param("url", k).alias(k.replace("-", "_"))
                                 for k in ["keyword", "experience-level", "criteria", "kw", "page", "ref"]])


def _watch_for_titles(spark, sf):
    w = bindings.watch_groups(spark, sf)
    u = bindings.watch_urls(spark, sf).withColumnRenamed("url", "site_url")
    return w.join(u, w.url_idx == u.page_id).select(
        "group_idx",
        F.when(F.col("group_idx") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("group_title"))
        .alias("group_title"),
        "url_idx", F.col("site_url").alias("url"))


@query("group_title")
def q_group_title(spark, sf):
    return routing.group_titles(_watch_for_titles(spark, sf))


@query("watchlist_json")
def q_watchlist_json(spark, sf):
    path = watchlist.render_json(bindings.watch_groups(spark, sf), scratch_path(spark, "watch-json"))
    return watchlist.read_json(spark, path)


def _sections_file(spark, sf):
    # groups opening a file (block a multiple of 50) lose their title: written
    # without a header, before any other group of the file
    w = bindings.watch_groups(spark, sf)
    w = w.withColumn("group_title", F.when(F.col("group_idx") % 50 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("group_title")))
    return watchlist.render_sections(w, scratch_path(spark, "watch-sections"))


@query("watchlist_sections")
def q_watchlist_sections(spark, sf):
    return watchlist.read_sections(spark, _sections_file(spark, sf))


@query("watchlist_fallback")
def q_watchlist_fallback(spark, sf):
    legacy = _sections_file(spark, sf)
    return watchlist.read_watchlist(spark, scratch_path(spark, "missing-json"), legacy)


@query("watch_pages")
def q_watch_pages(spark, sf):
    w = bindings.watch_groups(spark, sf)
    return watchlist.watch_pages(w, table(spark, sf, "pages")).select(
        "group_idx", "url_idx", "page_id", F.length("html").cast("long").alias("html_chars"))


# --------------------------------------------------------------------------
# Extraction

from ..functions import cards as card_sources  # noqa: E402
from ..functions.text import page_key as page_key_fn  # noqa: E402
from ..operators import extract as X  # noqa: E402


def _md_listings(spark, sf):
    return X.extract_markdown_source(bindings.md_card_pages(spark, sf))


def _b_listings(spark, sf):
    return X.extract_html_source(bindings.html_card_pages_class(spark, sf), card_sources.SOURCE_B)


def _c_listings(spark, sf):
    return X.extract_html_source(bindings.html_card_pages_attr(spark, sf), card_sources.SOURCE_C)


@query("page_strip")
def q_page_strip(spark, sf):
    clean = X.strip_elements("html")
    return table(spark, sf, "pages").select(
        "page_id", F.length(clean).cast("long").alias("clean_chars"), F.md5(clean).alias("clean_md5"))


@query("newline_squeeze")
def q_newline_squeeze(spark, sf):
    sq = X.squeeze_newlines("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.length(sq).cast("long").alias("n_chars"), F.md5(sq).alias("text_md5"))


@query("page_key")
def q_page_key(spark, sf):
    return X.page_keys(table(spark, sf, "pages")).select("page_id", "page_key")


@query("page_markdown")
def q_page_markdown(spark, sf):
    pages = table(spark, sf, "pages")
    md = pages.select("page_id", X.page_markdown("html").alias("md"))
    return md.select(
        "page_id",
        F.regexp_extract("md", r"(?m)^# (.*)$", 1).alias("h1"),
        (F.size(F.split("md", r"\]\(", -1)) - 1).cast("long").alias("n_links"))


@query("page_export")
def q_page_export(spark, sf):
    return jobs.page_export(table(spark, sf, "pages")).select("page_id", "page_key", "clean_chars", "clean_md5")


@query("page_files")
def q_page_files(spark, sf):
    """The pages, then each again as fetched over http, with a later id and a changed text: both have one key, the later one's file stays."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    later = pages.where("page_id % 2 = 0").select(
        (F.col("page_id") + 1_000_000_000_000).alias("page_id"), F.regexp_replace("url", "^https:", "http:").alias("url"), F.concat("html", F.lit("<p>later</p>")).alias("html"))
    files = jobs.write_page_files(pages.unionByName(later), scratch_path(spark, "page-files"))
    return files.select("page_key", F.length("clean_html").cast("long").alias("clean_chars"), F.md5("clean_html").alias("clean_md5"))


@query("md_cards")
def q_md_cards(spark, sf):
    return X.md_cards(bindings.md_card_pages(spark, sf)).select(
        "link_slug", "title", F.concat(F.lit(X.SOURCE_A_BASE), "link_slug").alias("full_url"))


@query("card_fields")
def q_card_fields(spark, sf):
    return _md_listings(spark, sf).select("link_slug", "salary", "company", "location")


@query("card_lines")
def q_card_lines(spark, sf):
    return _md_listings(spark, sf).select("link_slug", "posted_age")


@query("card_tags")
def q_card_tags(spark, sf):
    return _md_listings(spark, sf).select("link_slug", "tags")


@query("html_cards_class")
def q_html_cards_class(spark, sf):
    return _b_listings(spark, sf).select("link_slug", "title", "company", "tags", "full_url")


@query("lateral_cards")
def q_lateral_cards(spark, sf):
    from .registry import lateral_cards

    return lateral_cards(bindings.html_card_pages_class(spark, sf), "B").select("link_slug", "title", "company", "tags", "full_url")


@query("html_cards_attr")
def q_html_cards_attr(spark, sf):
    return _c_listings(spark, sf).select("title", "company", "tags", "full_url")


@query("link_normalize")
def q_link_normalize(spark, sf):
    return X.unify(_md_listings(spark, sf), _b_listings(spark, sf), _c_listings(spark, sf)).select(
        "source", "link_slug", "full_url")


@query("unify_listings")
def q_unify_listings(spark, sf):
    return X.unify(_md_listings(spark, sf), _b_listings(spark, sf), _c_listings(spark, sf)).select(
        "source", "link_slug", "title", "company", "tags", "salary", "location", "posted_age", "full_url")


@query("title_badge")
def q_title_badge(spark, sf):
    raw = F.upper("text")
    return table(spark, sf, "documents").select("doc_id", raw.alias("raw_title"),
                                                X.clean_badge(raw).alias("title"))


def _pages_some_failed(spark, sf):
    """Pages as fetched, where every tenth fetch failed (no content)."""
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", F.when(F.col("page_id") % 10 == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("html")).alias("html"))


@query("extract_rejects")
def q_extract_rejects(spark, sf):
    rows = X.html_card_rows(_pages_some_failed(spark, sf), card_sources.SOURCE_C)
    return X.extract_rejects(rows).select("page_id", "url", "kind", "error")


@query("page_rejects")
def q_page_rejects(spark, sf):
    """E16 of every source: what each extractor makes of pages that failed."""
    pages = _pages_some_failed(spark, sf)
    out = X.markdown_rejects(pages).select(F.lit("A").alias("source"), "page_id", "url", "error")
    for name, source in (("B", card_sources.SOURCE_B), ("C", card_sources.SOURCE_C)):
        rows = X.extract_rejects(X.html_card_rows(pages, source)).where(F.col("kind") == "page")
        out = out.unionByName(rows.select(F.lit(name).alias("source"), "page_id", "url", "error"))
    return out


@query("card_rejects")
def q_card_rejects(spark, sf):
    """Cards whose extractor fails are rejected one by one (here: one that insists on a link)."""
    rows = X.html_card_rows(bindings.html_card_pages_class(spark, sf), card_sources.LINKED_B)
    return X.extract_rejects(rows).where(F.col("kind") == "card").select("url", F.col("pos").cast("long").alias("pos"), "error")


@query("registry_listings")
def q_registry_listings(spark, sf):
    """The pages of a watchlist through an extractor registry."""
    from .registry import default_registry

    _, pages = bindings.card_watch(spark, sf)
    return jobs.extract_listings_with(default_registry(), pages).select("source", "title", "full_url", "row_limit")


@query("full_run_pages")
def q_full_run_pages(spark, sf):
    watch, pages = bindings.card_watch(spark, sf)
    return jobs.full_run(watch, pages, bindings.sheets(spark, sf), rewrite_ledger=False).summary


# --------------------------------------------------------------------------
# Repeated runs


@query("incremental_run")
def q_incremental_run(spark, sf):
    """B_offers feed (after F1, titles stripped) arriving one title per batch, in group order,
    against the known part as ledger version 0; the new rows of all batches."""
    from ..functions.text import trim_ws
    from ..streaming.incremental import run_incremental, write_batches

    root = scratch_path(spark, "incremental")
    offers = bindings.offers(spark, sf).withColumn("title", trim_ws("title")).withColumn(
        "url_idx", F.col("url_idx").cast("long"))
    known = filters.drop_polish(offers.where(F.col("pos") % 11 == 0))
    ledger0 = known.select(F.col("group_title").alias("sheet"), "pos", "title", "company", "tags",
                           F.lit("NEW").alias("status"), F.col("full_url").alias("link"))
    ledger_store = store.LedgerStore(spark, f"{root}/ledger")
    ledger_store.write(ledger0, version=0)
    feed = filters.drop_polish(offers.where(F.col("pos") % 11 != 0)).withColumn(
        "_batch", F.lpad(F.floor(F.col("group_idx") / 2).cast("string"), 20, "0"))  # a title's two groups, in watchlist order
    write_batches(feed, "_batch", f"{root}/in")
    run_incremental(spark, f"{root}/in", ledger_store, f"{root}/out", checkpoint=f"{root}/stream")
    return spark.read.parquet(f"{root}/out").select("group_title", "pos", "full_url", "title")


@query("ledger_rewrite")
def q_ledger_rewrite(spark, sf):
    """The organized ledger written as a new version and read back."""
    s = store.LedgerStore(spark, scratch_path(spark, "ledger-store"))
    s.write(bindings.sheets(spark, sf), version=0)
    watched = routing.group_titles(bindings.watch_groups(spark, sf)).select(F.col("sheet_title").alias("sheet"))
    s.write(_organized(spark, sf), changed=L.touched_tables(s.current(), watched))
    return s.current().select("sheet", "pos", "title", "company", "status", "link")


@query("run_summary")
def q_run_summary(spark, sf):
    """G1 on its own: the per-group counts of a run over B_offers."""
    return jobs.offers_run(spark, sf).summary


@query("full_run_ledger")
def q_full_run_ledger(spark, sf):
    """J1's ledger after the run: discards moved, new rows on top, every
    watched table, the tables that lost rows and Trash re-bucketed."""
    watch, pages = bindings.card_watch(spark, sf)
    return jobs.full_run(watch, pages, bindings.sheets(spark, sf)).ledger.select(
        "sheet", "pos", "title", "company", "status", "link")

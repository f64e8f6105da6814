"""Bindings: derive the engine's inputs (watchlist, listings, ledger, rendered
card pages) from the driver's tables, so every query's work grows with them.

Each binding is a plain projection / aggregation over one table; the DuckDB
forms used as oracles live in ``listledger.plans.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import table

# Cards are grouped into pages of at most this many part keys, so a page (one
# row, parsed by one task) stays bounded however large ``part`` grows.
CARDS_PER_PAGE_KEYS = 256


# A watch group holds the URLs of one language segment whose page ids share
# a block of this size, so no group (one JSON object, one section) grows
# with the table; equal titles stay separate groups, as the watchlist allows.
WATCH_GROUP_SPAN = 100
GROUP_STRIDE = 1_000_000_000_000


def watch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_watch: the pages' URLs as a watchlist: groups titled by the URL's
    language segment, one per block of ``WATCH_GROUP_SPAN`` page ids, in
    (title, block) order; URLs in page-id order.

    ``group_idx BIGINT, group_title STRING, url_idx BIGINT, url STRING``:
    ``group_idx = title rank * 1e12 + block`` (blocks are page ids / 100: no two meet) and ``url_idx`` = page id are
    order keys, not dense numbers (dense numbers would need a window over the
    whole table). The title ranks come from a window over the distinct
    titles only (a few rows).
    """
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    p = p.withColumn("group_title", F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1))
    titles = p.select("group_title").distinct().withColumn(
        "_trank", (F.dense_rank().over(Window.orderBy("group_title")) - 1).cast("long"))
    # one row per language: AQE broadcasts it when its measured size is small
    return p.join(titles, "group_title").select(
        (F.col("_trank") * GROUP_STRIDE + F.floor(F.col("page_id") / WATCH_GROUP_SPAN)).cast("long").alias("group_idx"),
        "group_title", F.col("page_id").alias("url_idx"), "url")


def watch_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_urls: page URLs recast into the listing-site shapes the router and the
    table namer know (page_id % 5): two search-page forms of source A, one of
    B, one of C, and the page URL as it is.

    ``page_id BIGINT, url STRING``
    """
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1)
    num = F.regexp_extract("url", r"^https?://[^/]+/[^/?#]+/([^/?#.]*)", 1)
    k = F.col("page_id") % 5
    url = (
        F.when(k == 0, F.concat(F.lit("https://justjoin.it/job-offers/krakow?keyword="), lang, F.lit("+"), num,
                                F.lit("&sort=newest&orderBy=DESC")))
        .when(k == 1, F.concat(F.lit("https://www.justjoin.it/job-offers/all-locations/"), lang,
                               F.lit("?experience-level=junior&keyword=&orderBy=DESC")))
        .when(k == 2, F.concat(F.lit("https://nofluffjobs.com/pl/"), lang, F.lit("?lang=en&criteria=seniority%3D"),
                               num, F.lit("&sort=newest")))
        .when(k == 3, F.concat(F.lit("https://theprotocol.it/filtry/"), lang, F.lit(";p/krakow;wp?kw="), num))
        .otherwise(F.col("url"))
    )
    return p.select("page_id", url.alias("url"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_offers: one listing per document; the title is the whole text (with
    a Polish marker on some), so every filter and key sees whole texts.

    Rank (batch order) is ``(group_idx, url_idx, pos)``; it is carried as
    columns, never as a global row number. Each language is two groups of one
    title, and the groups run against the alphabet.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    url_idx = F.expr("substring(source, 4)").cast("int")
    letters = F.ascii(F.coalesce("lang", F.lit(""))) * 65536 + F.ascii(F.substring(F.coalesce("lang", F.lit("")), 2, 1))
    txt = F.col("text")
    title = (
        F.when(F.col("doc_id") % 10 == 0, F.concat(txt, F.lit(" programista")))
        .when(F.col("doc_id") % 10 == 1, F.concat(F.lit("ds. "), txt))
        .when(F.col("doc_id") % 10 == 2, F.concat(F.lit("Kraków "), txt))
        .when(F.col("doc_id") % 10 == 3, F.concat(F.lit("inżynier "), txt))
        .otherwise(txt)
    )
    return d.select(
        (2 * (F.lit(1 << 40) - letters.cast("long")) + F.pmod(F.coalesce(url_idx, F.lit(0)), F.lit(2))).alias("group_idx"),
        F.col("lang").alias("group_title"),
        url_idx.alias("url_idx"),
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("https://x.example/o/"), ((F.col("doc_id") * 7919) % 800).cast("string")).alias("full_url"),
        title.alias("title"),
        F.col("lang").alias("company"),
        F.lit("").alias("tags"),
    )


def _sheet_col():
    return F.when(F.col("o_orderkey") % 23 == 0, F.lit("Trash")).otherwise(F.col("o_orderpriority"))


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_sheets: the canonical ledger, six tables (one is Trash).

    ``sheet, pos, title, company, tags, status, link``; ``pos`` orders rows
    inside a sheet (unique there, not dense).
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ck = F.col("o_custkey").cast("string")
    title = F.when(
        k % 4 == 1,
        F.concat(F.lit('=HYPERLINK("https://h.example/'), k.cast("string"), F.lit('?q=1","Order '), ck, F.lit('")')),
    ).otherwise(F.concat(F.lit("Order "), ck))
    status = (
        F.when(k % 9 == 0, "DISCARD").when(k % 9 == 1, " out ").when(k % 9 == 2, "CVSENT")
        .when(k % 9 == 3, "saved").when(k % 9 == 4, "about").when(k % 9 == 5, "")
        .when(k % 9 == 6, F.lit(None).cast("string")).when(k % 9 == 7, "save, cvsent").otherwise("NEW")
    )
    link = (
        F.when(k % 4 == 0, F.concat(F.lit("https://r.example/"), ck, F.lit("?ref=x")))
        .when(k % 4 == 1, F.lit(""))
        .when(k % 4 == 2, F.concat(F.lit(" https://r.example/"), ck, F.lit(" ")))
        .otherwise(F.lit("http no link"))
    )
    return o.select(
        _sheet_col().alias("sheet"),
        k.alias("pos"),
        title.alias("title"),
        F.col("o_orderstatus").alias("company"),
        F.lit("").alias("tags"),
        status.alias("status"),
        link.alias("link"),
    )


def raw_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_raw: the same ledger in raw form, one header per sheet (older layouts,
    a missing Status, a missing Title, a repeated header) and short rows.

    ``sheet, pos, header ARRAY<STRING>, cells ARRAY<STRING>``
    """
    s = sheets(spark, sf_dir)
    t, c, g, st, ln = (F.col(x) for x in ("title", "company", "tags", "status", "link"))
    st = F.coalesce(st, F.lit(""))
    sh = F.col("sheet")
    arr = F.array
    header = (
        F.when(sh == "2-HIGH", arr(*[F.lit(x) for x in ["Title", "Salary", "Company", "Location", "Tags", "Age", "Status", "Full URL"]]))
        .when(sh == "3-MEDIUM", arr(*[F.lit(x) for x in ["Company", "Title", "Tags", "Link", "Status", "Link"]]))
        .when(sh == "4-NOT SPECIFIED", arr(*[F.lit(x) for x in ["Title", "Company", "Tags", "Link"]]))
        .when(sh == "5-LOW", arr(*[F.lit(x) for x in ["Name", "Company", "Tags", "Status", "Link"]]))
        .otherwise(arr(*[F.lit(x) for x in ["Title", "Company", "Tags", "Status", "Link"]]))
    )
    cells = (
        F.when(sh == "2-HIGH", arr(t, F.lit("10 EUR"), c, F.lit("Krakow"), g, F.lit("3d left"), st, ln))
        .when(sh == "3-MEDIUM", arr(c, t, g, ln, st, F.lit("")))
        .when(sh == "4-NOT SPECIFIED", arr(t, c, g, ln))
        .otherwise(arr(t, c, g, st, ln))
    )
    cells = F.when(F.col("pos") % 13 == 0, F.slice(cells, 1, 2)).otherwise(cells)
    return s.select("sheet", "pos", header.alias("header"), cells.alias("cells"))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_raw with a second Status column in ``1-URGENT`` (at the front, so it is the first one found) and one foreign column."""
    twice = (F.col("sheet") == "1-URGENT")
    front = F.array(F.when(F.col("pos") % 5 == 0, "Out").when(F.col("pos") % 5 == 1, "x-save").otherwise(""), F.concat(F.lit("note "), F.col("pos").cast("string")))
    return raw_sheets(spark, sf_dir).select(
        "sheet", "pos",
        F.when(twice, F.concat(F.array(F.lit("Status"), F.lit("Note")), "header")).otherwise(F.col("header")).alias("header"),
        F.when(twice, F.concat(front, "cells")).otherwise(F.col("cells")).alias("cells"))


def in_older_layouts(ledger: DataFrame) -> DataFrame:
    """A canonical ledger as raw tables of several layouts, with two more tables that no group watches: ``archive``, which has no Status,
    and ``old``. Title, company, tags and link stay readable in each; statuses are made up from ``pos``."""
    p = F.col("pos")
    sheet = F.when(p % 7 == 0, "archive").when(p % 7 == 1, "old").otherwise(F.col("sheet"))
    made = F.when(p % 5 == 0, "DISCARD").when(p % 5 == 1, "CVSENT").when(p % 5 == 2, " out ").when(p % 5 == 3, "about").otherwise("NEW")
    again = F.when(p % 3 == 0, "Saved").otherwise("NEW")
    lit = lambda *names: F.array(*[F.lit(n) for n in names])
    header = (
        F.when(sheet == "archive", lit("Link", "Tags", "Company", "Title", "Kept"))
        .when(sheet == "old", lit("Title", "Owner", "Company", "Tags", "Link", "Status", "Owner"))
        .when(sheet == "en", lit("Title", "Salary", "Company", "Location", "Tags", "Age", "Status", "Full URL"))
        .when(sheet == "de", lit("Status", "Title", "Company", "Tags", "Link", "Status"))
        .when(sheet == "fr", lit("Title", "Company", "Tags", "Link"))
        .otherwise(lit("Title", "Company", "Tags", "Status", "Link")))
    t, c, g, ln = (F.col(x) for x in ("title", "company", "tags", "link"))
    cells = (
        F.when(sheet == "archive", F.array(ln, g, c, t, F.lit("yes")))
        .when(sheet == "old", F.array(t, F.lit("a"), c, g, ln, made, F.lit("b")))
        .when(sheet == "en", F.array(t, F.lit("10 EUR"), c, F.lit("Krakow"), g, F.lit("3d left"), made, ln))
        .when(sheet == "de", F.array(made, t, c, g, ln, again))
        .when(sheet == "fr", F.array(t, c, g, ln))
        .when((p % 6 == 0) & (ln == ""), F.array(t, c, g))
        .otherwise(F.array(t, c, g, made, ln)))
    return ledger.select(sheet.alias("sheet"), "pos", header.alias("header"), cells.alias("cells"))


def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_ages: posted-age strings for the recency filter (F2)."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    age = (
        F.when(i % 6 == 0, "New")
        .when(i % 6 == 1, F.concat((i % 31).cast("string"), F.lit("d left")))
        .when(i % 6 == 2, "Unknown").when(i % 6 == 3, "1w ago").when(i % 6 == 4, "time left")
        .otherwise(F.lit(None).cast("string"))
    )
    return e.select("event_id", age.alias("posted_age"))


def _card_pages(cards: DataFrame, url_prefix: str, body_col: str, wrap=None) -> DataFrame:
    """Join cards into pages of bounded size: ``page_id, url, html|md``."""
    page_no = F.floor(F.col("p_partkey") / CARDS_PER_PAGE_KEYS)
    grouped = cards.groupBy("p_brand", page_no.alias("page_no")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda x: x["card"]), ""
        ).alias("body")
    )
    body = F.col("body") if wrap is None else wrap(F.col("body"))
    slug = F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", "-"))
    return grouped.select(
        F.shiftrightunsigned(F.xxhash64("p_brand", "page_no"), 4).alias("page_id"),
        F.concat(F.lit(url_prefix), slug, F.lit("?page="), F.col("page_no").cast("string")).alias("url"),
        body.alias(body_col),
    )


def md_card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_md: Markdown listing pages rendered from ``part`` (source A form)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    lines = F.concat(
        F.lit("### "), F.col("p_name"), F.lit("\n"),
        F.col("p_size").cast("string"), F.lit(" EUR/h\n\n---\n\n"),
        F.col("p_brand"), F.lit("\n"), F.col("p_type"), F.lit("\n"),
        (k % 31).cast("string"), F.lit("d left\n1-click Apply\nSpark\n"),
        F.col("p_type"), F.lit("\nEUR\n"),
        F.when(k % 2 == 0, F.lit("Spark\n")).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit("New\n")).otherwise(F.lit("")),
        F.lit("A line far too long to be taken for a tag\n"),
        F.lit("t"), (k % 7).cast("string"), F.lit("\nu"), (k % 3).cast("string"), F.lit("\n"),
        F.lit("](/job-offer/"), F.lower(F.regexp_replace("p_name", " ", "-")), F.lit("-"), k.cast("string"), F.lit(")\n\n"),
    )
    cards = p.select("p_brand", "p_partkey", lines.alias("card"))
    return _card_pages(cards, "https://justjoin.it/job-offers/", "md")


def html_card_pages_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_md in HTML: source-A cards as a page would serve them, so that E1-E3
    turn them into the Markdown blocks E4-E7 read (the whole card is a link)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def div(x):
        return F.concat(F.lit("<div>"), x, F.lit("</div>"))

    card = F.concat(
        F.lit('<a class="offer-card" href="/job-offer/'), F.lower(F.regexp_replace("p_name", " ", "-")), F.lit("-"),
        k.cast("string"), F.lit('"><h3>'), F.col("p_name"), F.lit("</h3>"),
        div(F.concat(F.col("p_size").cast("string"), F.lit(" EUR/h"))), F.lit("<hr>"),
        div(F.col("p_brand")), div(F.col("p_type")), div(F.concat((k % 31).cast("string"), F.lit("d left"))),
        div(F.lit("1-click Apply")), div(F.lit("Spark")), div(F.col("p_type")), div(F.lit("EUR")),
        F.when(k % 2 == 0, div(F.lit("Spark"))).otherwise(F.lit("")),
        F.when(k % 5 == 0, div(F.lit("New"))).otherwise(F.lit("")),
        div(F.lit("A line far too long to be taken for a tag")),
        div(F.concat(F.lit("t"), (k % 7).cast("string"))), div(F.concat(F.lit("u"), (k % 3).cast("string"))),
        F.lit("</a>\n"),
    )
    cards = p.select("p_brand", "p_partkey", card.alias("card"))
    return _card_pages(
        cards, "https://justjoin.it/job-offers/", "html",
        wrap=lambda b: F.concat(F.lit('<html><head><title>Offers</title><script>var t="</p>";</script>'
                                      '<style>p{margin:0}</style></head><body><div class="list">'), b,
                                F.lit("</div></body></html>")),
    )


def _tag_list(n_expr):
    k = F.col("p_partkey")
    return F.transform(F.sequence(F.lit(0), n_expr - 1), lambda i: F.concat(F.lit("T"), ((k + i) % 11).cast("string")))


def html_card_pages_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_html, class form (E8): cards as ``a.posting-list-item``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tags = _tag_list(1 + 3 * (k % 3))
    href = F.concat(F.lit("/pl/job/"), F.lower(F.regexp_replace("p_name", " ", "-")), F.lit("-"), k.cast("string"))
    card = F.concat(
        F.lit('<a class="posting-list-item posting-list-item--main" '),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('href="'), href, F.lit('"'))),
        F.lit('><div class="tile"><h3 class="posting-title__position text-truncate"> '), F.col("p_name"),
        F.lit(' &amp; co <span class="badge">NEW</span></h3>'),
        F.when(k % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<h4 class="company-name"> '), F.col("p_brand"), F.lit(" </h4>"))),
        F.lit("<nfj-posting-item-tiles>"),
        F.array_join(F.transform(tags, lambda t: F.concat(F.lit('<span class="posting-tag">'), t, F.lit("</span>"))), ""),
        F.lit("</nfj-posting-item-tiles><p><b>open</div></a>\n"),
    )
    cards = p.select("p_brand", "p_partkey", card.alias("card"))
    return _card_pages(
        cards, "https://nofluffjobs.com/pl/", "html",
        wrap=lambda b: F.concat(F.lit("<html><body><p><b>list</b><div>"), b, F.lit("</div></body></html>")),
    )


def html_card_pages_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B_html, attribute form (E9): cards as ``a[data-test=list-item-offer]``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tags = _tag_list(1 + 3 * (k % 3))
    href = F.concat(F.lit("/szczegoly/praca/"), F.lower(F.regexp_replace("p_name", " ", "-")), F.lit(",oferta,"),
                    k.cast("string"), F.lit("?s=1&amp;p=2"))
    card = F.concat(
        F.lit('<a data-test="list-item-offer" '),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('href="'), href, F.lit('"'))),
        F.lit('><div><h2 id="offer-title"> '), F.col("p_name"), F.lit(" </h2>"),
        F.when(k % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<div data-test="text-employerName">'), F.col("p_brand"), F.lit("</div>"))),
        F.array_join(F.transform(tags, lambda t: F.concat(
            F.lit('<span data-test="chip-expectedTechnology"> '), t, F.lit(" </span>"))), ""),
        F.lit("<p><b>open</div></a>\n"),
    )
    cards = p.select("p_brand", "p_partkey", card.alias("card"))
    return _card_pages(
        cards, "https://theprotocol.it/filtry/", "html",
        wrap=lambda b: F.concat(F.lit('<html><body><p>top<div id="main-offers-listing">'), b,
                                F.lit("</div></body></html>")),
    )


def card_watch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Watchlist and pages for a full run over rendered cards: one group per
    brand; its URLs are the brand's Markdown pages (A), then its class-card
    pages (B), then its attribute-card pages (C), each in page order.

    Returns ``(watch, pages)``."""
    parts = []
    for rank, (pages, col_name) in enumerate([
            (html_card_pages_md(spark, sf_dir), "html"),
            (html_card_pages_class(spark, sf_dir), "html"),
            (html_card_pages_attr(spark, sf_dir), "html")]):
        parts.append(pages.select(
            (F.col("page_id") * 4 + rank).alias("page_id"), "url", F.col(col_name).alias("html"),
            F.lit(rank).alias("_src")))
    # stored once, as a fetched page table would be
    from ..session import materialize

    pages = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]), "card-pages")
    brand = F.regexp_extract("url", r"/([a-z0-9-]+)\?page=", 1)
    page_no = F.regexp_extract("url", r"\?page=([0-9]+)", 1).cast("long")
    titles = pages.select(brand.alias("group_title")).distinct().withColumn(
        "group_idx", (2 * F.dense_rank().over(Window.orderBy(F.desc("group_title")))).cast("long"))  # against the alphabet
    # two groups of a brand: the second watches its attribute-card pages
    watch = pages.select(brand.alias("group_title"), (F.col("_src") * GROUP_STRIDE + page_no).alias("url_idx"),
                         "url", (F.col("_src") == 2).cast("long").alias("_second")).join(titles, "group_title")
    return watch.select((F.col("group_idx") + F.col("_second")).alias("group_idx"), "group_title", "url_idx", "url"), pages.drop("_src")

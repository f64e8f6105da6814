"""Extraction (E1-E16): pages -> listing rows.

Native expressions for everything a regex can say (E1, E3, E4-E7, E10,
E11, E13); Arrow-batched Python only for HTML -> Markdown (E2) and the
selector-driven card extractors (E8, E9). ``html`` is dropped as soon as
the listings are out, so it never rides through a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cards as C
from ..functions.text import col, lines_nonblank, page_key, trim_ws

# Fixed values that must equal the reference's (extraction).
DROPPED_ELEMENTS = ["script", "style", "noscript"]
MD_CARD_PATTERN = r"(?s)### (.*?)\n(.*?)]\(/job-offer/(.*?)\)"
SOURCE_A_BASE = "https://justjoin.it/job-offer/"
SOURCE_B_BASE = "https://nofluffjobs.com"
SOURCE_C_BASE = "https://theprotocol.it"
A_DEFAULT_SALARY = "Undisclosed Salary"
A_DEFAULT = "Unknown"
A_SKIP_LINE = "1-click Apply"
A_EXCLUDED_TAGS = ["1-click Apply", "Undisclosed Salary", "EUR", "PLN", "USD"]
A_MAX_TAG_CHARS = 30
MAX_TAGS = 5
BADGE = "NEW"

LISTING_COLUMNS = ["source", "title", "company", "tags", "tag_list", "salary", "location", "posted_age",
                   "link_slug", "full_url"]


def strip_elements(html) -> Column:
    """Drop script, style and noscript elements with their content
    (one element kind after the other; the first closing tag ends one). As a
    tree would have it, tags inside a comment are text, and a script or style
    that is never closed runs to the end of the page."""
    out = col(html)
    for tag in DROPPED_ELEMENTS:
        end = rf"</{tag}\s*>" + ("" if tag == "noscript" else r"|\z")
        out = F.regexp_replace(out, rf"(?is)(<!--.*?-->)|<{tag}\b[^>]*>.*?(?:{end})", "$1")
    return out


def squeeze_newlines(md) -> Column:
    """Three or more newlines become two."""
    return F.regexp_replace(col(md), r"\n{3,}", "\n\n")


# What a Python worker holds at once, whatever the size of its Arrow batches: one page in, so many pages' Markdown or cards out.
PAGES_AT_ONCE = 64
CARDS_AT_ONCE = 1024

MARKDOWN = pa.struct([("md", pa.string()), ("error", pa.string())])


def _markdown_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    from ..functions.markdown import html_to_markdown

    def one(h):
        try:
            if h is None:
                raise ValueError("page has no content")
            return html_to_markdown(h), None
        except Exception as e:  # E16: a bad page gives no Markdown, the run goes on
            return None, f"{type(e).__name__}: {e}"

    for html in batches:
        for k in range(0, len(html), PAGES_AT_ONCE):
            md, error = zip(*(one(h.as_py()) for h in html.slice(k, PAGES_AT_ONCE)))
            yield pa.StructArray.from_arrays([pa.array(md, pa.string()), pa.array(error, pa.string())], fields=list(MARKDOWN))


@F.arrow_udf(T.StructType([T.StructField("md", T.StringType()), T.StructField("error", T.StringType())]))
def _markdown_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _markdown_slices(batches)


# a deterministic function is run once more for a filter on its ``error``, which moves below the exchange that deals the pages
_markdown_udf = _markdown_udf.asNondeterministic()


def page_markdown(html) -> Column:
    """E1 -> E2 -> E3: Markdown of a page (ATX headings); null for a page that fails."""
    return squeeze_newlines(_markdown_udf(strip_elements(html))["md"])


def markdown_rows(pages: DataFrame) -> DataFrame:
    """``pages`` with ``md`` and ``error`` (E16) in place of ``html``."""
    rows = pages.withColumn("_md", _markdown_udf(strip_elements("html"))).drop("html")
    return rows.withColumn("md", squeeze_newlines("_md.md")).withColumn("error", F.col("_md.error")).drop("_md")


def markdown_rejects(pages: DataFrame) -> DataFrame:
    """E16 for source A: pages that failed, with the error."""
    return markdown_rows(pages).where(F.col("error").isNotNull()).select("page_id", "url", "error")


# ---------------------------------------------------------------------------
# Source A: Markdown cards


def md_cards(pages: DataFrame, md_col: str = "md") -> DataFrame:
    """Every ``### title`` ... ``](/job-offer/slug)`` block (lazy, dot
    matches newline). A card without a link swallows the next card's text.
    Keeps the page's other columns and adds ``pos, title, block, link_slug``."""
    keep = [c for c in pages.columns if c != md_col]
    matches = pages.select(*keep, F.posexplode(F.regexp_extract_all(md_col, F.lit(MD_CARD_PATTERN), 0))
                           .alias("pos", "_m"))
    g = [F.regexp_extract("_m", MD_CARD_PATTERN, i) for i in (1, 2, 3)]
    return matches.select(*keep, F.col("pos").cast("int").alias("pos"),
                          trim_ws(g[0]).alias("title"), trim_ws(g[1]).alias("block"), trim_ws(g[2]).alias("link_slug"))


def md_card_fields(cards: DataFrame) -> DataFrame:
    """E5-E7, E10 for source A."""
    parts = F.split("block", "---", -1)
    has_sep = F.size(parts) >= 2
    sal_lines = lines_nonblank(trim_ws(F.element_at(parts, 1)))
    details = lines_nonblank(trim_ws(F.try_element_at(parts, F.lit(2))))
    all_lines = lines_nonblank("block")

    def first_or(arr, i, default):
        return F.coalesce(F.try_element_at(arr, F.lit(i)), F.lit(default))

    salary = F.when(has_sep, first_or(sal_lines, 1, A_DEFAULT_SALARY)).otherwise(first_or(all_lines, 1, A_DEFAULT_SALARY))
    company = F.when(has_sep, first_or(details, 1, A_DEFAULT)).otherwise(F.lit(A_DEFAULT))
    location = F.when(has_sep, first_or(details, 2, A_DEFAULT)).otherwise(F.lit(A_DEFAULT))
    remaining = F.when(has_sep, F.slice(details, F.lit(3), F.greatest(F.size(details) - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))

    def is_age(x):
        return (x.contains("left") & x.rlike("[0-9]")) | x.contains("New")

    out = cards.select(
        "*", salary.alias("salary"), company.alias("company"), location.alias("location"),
        remaining.alias("_rest"))
    # Classify the remaining lines in order; the last age line wins
    out = out.withColumn("posted_age", F.coalesce(F.try_element_at(F.filter("_rest", is_age), F.lit(-1)),
                                                  F.lit(A_DEFAULT)))
    out = out.withColumn("_tags", F.filter(
        "_rest", lambda x: ~is_age(x) & ~x.contains(A_SKIP_LINE) & (F.length(x) < A_MAX_TAG_CHARS)))
    # Drop tags equal to location, age, company and fixed words (equal
    # tags are kept twice: not a set difference); first five
    excl = F.array(F.col("location"), F.col("posted_age"), F.col("company"), *[F.lit(x) for x in A_EXCLUDED_TAGS])
    out = out.withColumn("tag_list", F.slice(F.filter("_tags", lambda t: ~F.array_contains(excl, t)), 1, MAX_TAGS))
    return out.select(
        *[c for c in cards.columns if c != "block"], "salary", "company", "location", "posted_age",
        "tag_list", F.array_join("tag_list", ", ").alias("tags"),
        F.concat(F.lit(SOURCE_A_BASE), F.col("link_slug")).alias("full_url"),
        F.lit("A").alias("source"))


def extract_markdown_source(pages: DataFrame, md_col: str = "md") -> DataFrame:
    """Source A from pages already in Markdown (``page_id, url, md``)."""
    return md_card_fields(md_cards(pages, md_col))


def extract_source_a(pages: DataFrame) -> DataFrame:
    """Source A from raw HTML pages: E1-E3 then E4-E7. A page that fails gives no cards."""
    return extract_markdown_source(markdown_rows(pages).where(F.col("error").isNull()).drop("error"))


# ---------------------------------------------------------------------------
# Sources B and C: HTML cards by selectors

CARD_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("raw_title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("tag_list", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
    T.StructField("kind", T.StringType()),   # 'card' or 'page' (a page that failed as a whole)
    T.StructField("source", T.StringType()),
])


def _page_rows(html: str | None, name: str | None, sources: dict) -> Iterator[tuple]:
    """``pos, href, raw_title, company, tag_list, error, kind, source`` of a page's cards."""
    try:
        if html is None:
            raise ValueError("page has no content")
        src = sources[name]
        for *card, err in C.extract_cards(html, src):
            yield *card, err, "card", src.name
    except Exception as e:  # E16: a bad page gives no rows, the run goes on
        yield None, None, None, None, None, f"{type(e).__name__}: {e}", "page", name


def _card_rows(sources: dict, carry: list[str]):
    text = pa.string()
    made = [pa.int32(), text, text, text, pa.list_(text), text, text, text]
    names_out = [f.name for f in CARD_SCHEMA.fields] + carry

    def table(batch, at, rows):
        taken = [batch.column(c).take(pa.array(at, pa.int32())) for c in ("page_id", "url", *carry)]
        own = [pa.array(values, kind) for values, kind in zip(zip(*rows), made)]
        return pa.RecordBatch.from_arrays([*taken[:2], *own, *taken[2:]], names_out)

    def run(batches):
        for batch in batches:
            names = batch.column("source") if "source" in batch.schema.names else pa.nulls(batch.num_rows)
            at, rows = [], []
            for k, (html, name) in enumerate(zip(batch.column("html"), names)):
                for row in _page_rows(html.as_py(), name.as_py(), sources):
                    at.append(k)
                    rows.append(row)
                    if len(rows) == CARDS_AT_ONCE:
                        yield table(batch, at, rows)
                        at, rows = [], []
            if rows:
                yield table(batch, at, rows)
    return run


def html_card_rows(pages: DataFrame, source: C.CardSource | dict) -> DataFrame:
    """E8/E9 raw rows, rejects included (``error`` set). ``source`` is one
    card source, or a dict name -> source picked per page by its ``source``
    column (one pass over the pages for every HTML source)."""
    base = {"page_id", "url", "html", "source"}
    carry = [c for c in pages.columns if c not in base]    # page columns passed through to each card
    if isinstance(source, C.CardSource):
        sources = {None: source}
        p = pages.select(F.col("page_id").cast("long"), "url", "html", *carry)
    else:
        sources = source
        p = pages.select(F.col("page_id").cast("long"), "url", "html", "source", *carry)
    schema = T.StructType(CARD_SCHEMA.fields + [pages.schema[c] for c in carry])
    return p.mapInArrow(_card_rows(sources, carry), schema)


def extract_rejects(rows: DataFrame) -> DataFrame:
    """Cards and pages that failed, with the error."""
    return rows.where(F.col("error").isNotNull()).select("page_id", "url", "pos", "kind", "error")


def clean_badge(title) -> Column:
    """Delete every ``NEW`` (case-sensitive, also inside words), strip."""
    return trim_ws(F.replace(col(title), F.lit(BADGE), F.lit("")))


def html_card_listings(rows: DataFrame) -> DataFrame:
    """E10-E12 + F4 for sources B and C, on the good rows."""
    good = rows.where(F.col("error").isNull())
    href = F.col("href")
    is_b = F.col("source") == "B"
    no_href = href.isNull() | (href == "")
    # a B card without a link is skipped; E11: B titles lose every NEW
    good = good.where(~(is_b & no_href))
    title = F.when(is_b, clean_badge("raw_title")).otherwise(F.col("raw_title"))
    slug = F.when(is_b, F.substring_index(href, "/", -1))
    full = F.when(is_b, F.concat(F.lit(SOURCE_B_BASE), href)).otherwise(
        F.when(no_href, F.lit("Unknown")).otherwise(F.concat(F.lit(SOURCE_C_BASE), F.substring_index(href, "?", 1))))
    carry = [c for c in rows.columns if c not in {f.name for f in CARD_SCHEMA.fields}]
    return good.select(
        "page_id", "url", *carry, "pos", title.alias("title"), "company", "tag_list",
        F.array_join("tag_list", ", ").alias("tags"), slug.alias("link_slug"), full.alias("full_url"), "source")


def extract_html_source(pages: DataFrame, source: C.CardSource) -> DataFrame:
    return html_card_listings(html_card_rows(pages, source))


def extract_html_sources(pages: DataFrame, sources: dict) -> DataFrame:
    """Every HTML card source in one pass; ``pages`` carries ``source``."""
    return html_card_listings(html_card_rows(pages, sources))


def unify(*parts: DataFrame) -> DataFrame:
    """One listing schema over the three extractors; what a source does
    not have is null (salary, location, age for B and C)."""
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    keep = [c for c in out.columns if c not in LISTING_COLUMNS] + LISTING_COLUMNS
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in keep])


def page_keys(pages: DataFrame) -> DataFrame:
    """E13 on a page table."""
    return pages.select("page_id", "url", page_key("url").alias("page_key"))

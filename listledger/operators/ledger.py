"""Ledger upkeep (L1-L10, T3): discard to Trash, triage by status, new rows
on top, migration of older row layouts.

The canonical ledger is one DataFrame ``sheet, pos, title, company, tags,
status, link``: ``sheet`` names the table, ``pos`` orders rows inside it.
The raw form is ``sheet, pos, header ARRAY<STRING>, cells ARRAY<STRING>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, trim_ws
from .ordering import dense_positions

TRASH = "Trash"
CANONICAL_HEADER = ["Title", "Company", "Tags", "Status", "Link"]
LEDGER_COLUMNS = ["sheet", "pos", "title", "company", "tags", "status", "link"]

# Fixed values that must equal the reference's (triage). Statuses moved to
# Trash (tested by equality):
DISCARD_STATUSES = ["DISCARD", "OUT"]
# Buckets tested by substring, first hit wins, and their display order and
# colour: CVSENT green, SAVE yellow, other white, OUT red.
BUCKET_CVSENT, BUCKET_SAVE, BUCKET_OTHER, BUCKET_OUT = 0, 1, 2, 3
BUCKET_LABELS = ["green", "yellow", "white", "red"]
NEW_STATUS = "NEW"


def norm_status(status) -> Column:
    """L1: stripped, upper-cased status; a missing cell stays null."""
    return F.upper(trim_ws(col(status)))


def is_discarded(status) -> Column:
    """L2 predicate: status equal to DISCARD or OUT."""
    return F.coalesce(norm_status(status).isin(*DISCARD_STATUSES), F.lit(False))


def status_bucket(status) -> Column:
    """L4: CVSENT 0, SAVE 1, other 2, OUT 3 -- by substring, first hit wins
    (so SAVED is SAVE and ABOUT is OUT; missing is other)."""
    s = F.coalesce(norm_status(status), F.lit(""))
    return (
        F.when(s.contains("CVSENT"), BUCKET_CVSENT)
        .when(s.contains("SAVE"), BUCKET_SAVE)
        .when(s.contains("OUT"), BUCKET_OUT)
        .otherwise(BUCKET_OTHER)
    )


def split_discards(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L2: (kept, moved). Trash is never a source; kept rows keep their order."""
    move = (F.col("sheet") != TRASH) & is_discarded("status")
    return ledger.where(~move), ledger.where(move)


def append_to_trash(kept: DataFrame, moved: DataFrame) -> DataFrame:
    """L3: moved rows go to the end of Trash, in (sheet, pos) order; columns are
    aligned by name (the reference copies cells by position)."""
    # one scalar (the last Trash position), read once: no join against it
    base = kept.where(F.col("sheet") == TRASH).agg(F.max("pos")).first()[0] or 0
    numbered = dense_positions(
        moved.withColumn("_t", F.lit(TRASH)).withColumnRenamed("sheet", "_from"),
        by=["_t"], order=["_from", "pos"], out="_n")
    appended = numbered.select(
        F.col("_t").alias("sheet"), (F.lit(base) + F.col("_n")).cast("long").alias("pos"),
        "title", "company", "tags", "status", "link")
    return kept.select(*LEDGER_COLUMNS).unionByName(appended)


def process_discards(ledger: DataFrame) -> DataFrame:
    """L2 + L3 (+ L5 on every table, as the reference re-buckets the tables
    that lost rows and Trash)."""
    kept, moved = split_discards(ledger)
    return append_to_trash(kept, moved)


def status_order(ledger: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """Stable re-bucketing: rows of each table renumbered 1..n in
    (bucket, old order). ``sheets`` (one column ``sheet``) limits it to those
    tables; the others keep their rows and numbers."""
    b = ledger.withColumn("_bucket", status_bucket("status"))
    if sheets is None:
        return dense_positions(b, by=["sheet"], order=["_bucket", "pos"], out="pos").drop("_bucket")
    target = sheets.select("sheet").distinct()
    inside = b.join(target, "sheet", "left_semi")
    outside = ledger.join(target, "sheet", "left_anti")
    done = dense_positions(inside, by=["sheet"], order=["_bucket", "pos"], out="pos").drop("_bucket")
    return done.select(*LEDGER_COLUMNS).unionByName(outside.select(*LEDGER_COLUMNS))


def bucket_ranges(ordered: DataFrame) -> DataFrame:
    """After T3, the row range of each bucket per table, as sheet rows
    (data starts at row 2), with its colour label. Empty buckets give none."""
    labels = F.element_at(F.array(*[F.lit(x) for x in BUCKET_LABELS]), F.col("bucket") + 1)
    return (
        ordered.withColumn("bucket", status_bucket("status"))
        .groupBy("sheet", "bucket")
        .agg((F.min("pos") + 1).cast("long").alias("first_row"), (F.max("pos") + 1).cast("long").alias("last_row"),
             F.count(F.lit(1)).cast("long").alias("n_rows"))
        .withColumn("label", labels)
        .withColumn("bucket", F.col("bucket").cast("int"))
    )


def to_ledger_rows(new: DataFrame, sheet_col: str = "group_title", order: Sequence[str] = ()) -> DataFrame:
    """New listing -> canonical row: status NEW; company and tags default
    ''; link = full_url, else link, else ''. Keeps the rank columns as ``_o*``."""
    cols = set(new.columns)
    link = F.coalesce(*(
        [F.col("full_url")] if "full_url" in cols else []) + ([F.col("link")] if "link" in cols else []) + [F.lit("")])
    return new.select(
        F.col(sheet_col).alias("sheet"),
        F.col("title"),
        F.coalesce(F.col("company"), F.lit("")).alias("company") if "company" in cols else F.lit("").alias("company"),
        F.coalesce(F.col("tags"), F.lit("")).alias("tags") if "tags" in cols else F.lit("").alias("tags"),
        F.lit(NEW_STATUS).alias("status"),
        link.alias("link"),
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
    )


def migrated(title: Column, link: Column) -> tuple[Column, Column]:
    """Title and link of a row of the older form: a ``=HYPERLINK`` formula with at least 4 ``"``-pieces
    holds both (pieces 4 and 2); any other row stays."""
    pieces = F.split(title, '"', -1)
    is_formula = F.coalesce(title.contains("=HYPERLINK") & (F.size(pieces) >= 4), F.lit(False))
    return (F.when(is_formula, F.element_at(pieces, 4)).otherwise(title),
            F.when(is_formula, F.element_at(pieces, 2)).otherwise(link))


def prepend(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """New rows on top of their table in batch order, then the old
    rows in their order, migrated. Tables without new rows are left as they are."""
    ocols = sorted([c for c in rows.columns if c.startswith("_o")])
    touched = rows.select("sheet").distinct()
    title, link = migrated(F.col("title"), F.col("link"))
    old_t = ledger.join(touched, "sheet", "left_semi").withColumns({"title": title, "link": link})
    untouched = ledger.join(touched, "sheet", "left_anti").select(*LEDGER_COLUMNS)

    def okey(df, is_new: bool):
        # one order key for both: (0, rank...) for new rows, (1, pos) for old
        vals = [F.col(c).cast("long") for c in ocols]
        if is_new:
            return df.select("sheet", "title", "company", "tags", "status", "link",
                             F.lit(0).alias("_new"), *[v.alias(f"_k{i}") for i, v in enumerate(vals)],
                             F.lit(None).cast("long").alias("_old"))
        nulls = [F.lit(None).cast("long").alias(f"_k{i}") for i in range(len(ocols))]
        return df.select("sheet", "title", "company", "tags", "status", "link",
                         F.lit(1).alias("_new"), *nulls, F.col("pos").cast("long").alias("_old"))

    both = okey(rows, True).unionByName(okey(old_t, False))
    order = ["_new", *[f"_k{i}" for i in range(len(ocols))], "_old"]
    done = dense_positions(both, by=["sheet"], order=order, out="pos")
    return done.select(*LEDGER_COLUMNS).unionByName(untouched)


# ---------------------------------------------------------------------------
# Raw form (header-driven)


def header_first(header, name: str) -> Column:
    """1-based index of the first header equal to ``name``; 0 when absent."""
    return F.array_position(col(header), F.lit(name))


def header_last(header, name: str) -> Column:
    """1-based index of the last header equal to ``name``; 0 when absent (a
    dict built from the header keeps the last of equal keys)."""
    r = F.array_position(F.reverse(col(header)), F.lit(name))
    return F.when(r == 0, F.lit(0)).otherwise(F.size(col(header)) - r + 1)


def cell_at(cells, idx: Column, default: str = "") -> Column:
    """``row[idx]`` for a 1-based index; absent index or short row -> default."""
    return F.when(idx > 0, F.coalesce(F.try_element_at(col(cells), idx.cast("int")), F.lit(default))).otherwise(
        F.lit(default))


def migrated_columns(h: Column, c: Column) -> list[Column]:
    """L10 for one raw row: title, company, tags, status and link from its header and cells.

    Columns by header (last of equal headers); no Title header -> first cell;
    a ``=HYPERLINK`` title with at least 4 ``"``-pieces gives link = piece 2
    and title = piece 4 (over the Link column); an empty link falls back to
    Full URL; other columns are dropped."""

    def get(name):
        return cell_at(c, header_last(h, name))

    title_raw = F.when((header_last(h, "Title") == 0) & (F.size(c) > 0), F.element_at(c, 1)).otherwise(get("Title"))
    pieces = F.split(title_raw, '"', -1)
    is_formula = title_raw.contains("=HYPERLINK") & (F.size(pieces) >= 4)
    clean_title = F.when(is_formula, F.element_at(pieces, 4)).otherwise(title_raw)
    clean_link = F.when(is_formula, F.element_at(pieces, 2)).otherwise(get("Link"))
    return [clean_title, get("Company"), get("Tags"), get("Status"), F.when(clean_link == "", get("Full URL")).otherwise(clean_link)]


def migrate_rows(raw: DataFrame) -> DataFrame:
    """Raw rows of any older layout -> canonical columns (see ``migrated_columns``)."""
    values = migrated_columns(F.col("header"), F.col("cells"))
    return raw.select("sheet", "pos", *[v.alias(n.lower()) for v, n in zip(values, CANONICAL_HEADER)])


def touched_tables(ledger: DataFrame, watched: DataFrame | None = None, new_rows: DataFrame | None = None) -> DataFrame:
    """Tables that ``reorganize`` rewrites: the watched ones, those that lose rows or get new ones, and Trash."""
    lost = (F.col("sheet") != TRASH) & is_discarded("status")
    out = ledger.where(lost).select("sheet").unionByName(ledger.sparkSession.range(1).select(F.lit(TRASH).alias("sheet")))
    for more in (watched, new_rows):
        if more is not None:
            out = out.unionByName(more.select("sheet"))
    return out.distinct()


def reorganize(ledger: DataFrame, watched: DataFrame | None = None, new_rows: DataFrame | None = None) -> DataFrame:
    """L2 + L3 + L8 + L10 + L5 fused into one range-partitioned numbering pass.

    The steps compose into one sort key per table, because re-bucketing is a
    stable sort on the status alone: rows moved to Trash follow Trash's own
    rows in (source table, position) order; new rows go before the old rows
    of their bucket (they are NEW, so "other"); old rows keep their order.
    Tables that are watched, lost rows, got new rows, and Trash, are
    renumbered 1..n in (bucket, new first, rank, old order); every other
    table is left exactly as it was.

    ``watched``: one column ``sheet``; ``new_rows``: from ``to_ledger_rows``
    (rank columns ``_o*``)."""
    move = (F.col("sheet") != TRASH) & is_discarded("status")
    old = ledger.select(
        F.when(move, F.lit(TRASH)).otherwise(F.col("sheet")).alias("sheet"),
        "title", "company", "tags", "status", "link",
        F.lit(1).alias("_new"),
        F.struct(move.cast("int").alias("moved"), F.when(move, F.col("sheet")).otherwise(F.lit("")).alias("src"),
                 F.col("pos").alias("pos")).alias("_old"),
        F.col("pos").alias("_pos0"),
    )
    ocols = sorted([c for c in new_rows.columns if c.startswith("_o")]) if new_rows is not None else []
    keys = [f"_k{i}" for i in range(len(ocols))]

    old = old.select("*", *[F.lit(None).cast("long").alias(k) for k in keys])
    if new_rows is not None:
        # putting rows on a table rewrites its old rows to the canonical form (L10); other tables keep theirs
        touched = new_rows.select("sheet").distinct().withColumn("_touched", F.lit(True))
        title, link = migrated(F.col("title"), F.col("link"))
        here = F.coalesce(F.col("_touched"), F.lit(False))
        old = old.join(touched, "sheet", "left").withColumns(
            {"title": F.when(here, title).otherwise(F.col("title")), "link": F.when(here, link).otherwise(F.col("link"))}
        ).drop("_touched")
    both = old
    if new_rows is not None:
        new = new_rows.select(
            "sheet", "title", "company", "tags", "status", "link", F.lit(0).alias("_new"),
            F.lit(None).cast("struct<moved:int,src:string,pos:bigint>").alias("_old"),
            F.lit(None).cast("long").alias("_pos0"),
            *[F.col(c).cast("long").alias(keys[i]) for i, c in enumerate(ocols)])
        both = old.unionByName(new)
    target = touched_tables(ledger, watched, new_rows)

    inside = both.join(target, "sheet", "left_semi").withColumn("_bucket", status_bucket("status"))
    outside = both.join(target, "sheet", "left_anti").withColumn("pos", F.col("_pos0"))
    done = dense_positions(inside, by=["sheet"], order=["_bucket", "_new", *keys, "_old"], out="pos")
    return done.select(*LEDGER_COLUMNS).unionByName(outside.select(*LEDGER_COLUMNS))

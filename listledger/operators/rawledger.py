"""Whole-ledger rewrites (L2-L5, L8-L10) in the raw, header-driven form.

``sheet, pos, header ARRAY<STRING>, cells ARRAY<STRING>``: each table has its own header, rows may be short. A rewrite keeps
every column of a table, known or not: rows carry their cells as they stand, and only a table that gets new rows takes the canonical
columns (L10).

- The status that discards and sorts is under the first header ``Status``. A table without one loses no row and is not re-ordered: it stays
  as it is, rows, cells and positions.
- Rows moved to Trash are aligned by column name (the k-th column of a name with the k-th). Columns that Trash lacks are added
  at the end of its header, so nothing of a moved row is lost; Trash's own rows are then short, which reads as empty.
- A table that gets new rows has its old rows migrated. It is sorted by the status it then has (the last of equal headers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import CANONICAL_HEADER, TRASH, header_first, is_discarded, migrated_columns, status_bucket
from .ordering import dense_positions

RAW_COLUMNS = ["sheet", "pos", "header", "cells"]


def raw_status(header: str = "header", cells: str = "cells") -> Column:
    """The cell under the first header ``Status``; null without such a header or in a row that ends before it."""
    at = header_first(header, "Status")
    return F.when(at > 0, F.try_element_at(F.col(cells), F.nullif(at, F.lit(0)).cast("int")))


def _moves() -> Column:
    return (F.col("sheet") != TRASH) & is_discarded(raw_status())


def named_columns(header: Column) -> Column:
    """Per column of a header (name, occ, at): its name, the how-many-th of that name it is, its place from 1."""
    return F.transform(header, lambda x, i: F.struct(
        x.alias("name"), F.size(F.filter(F.slice(header, 1, i + 1), lambda y: y.eqNullSafe(x))).alias("occ"), (i + 1).alias("at")))


def aligned_cells(columns: list[tuple[str, int]], header: str = "header", cells: str = "cells") -> Column:
    """A row's cells under ``columns`` (name, occ); '' where the row has none."""
    wanted = F.array(*[F.struct(F.lit(n).cast("string").alias("name"), F.lit(k).alias("occ")) for n, k in columns])
    own = named_columns(F.col(header))
    at = lambda w: F.filter(own, lambda c: c["name"].eqNullSafe(w["name"]) & (c["occ"] == w["occ"]))
    return F.transform(wanted, lambda w: F.coalesce(
        F.try_element_at(F.col(cells), F.coalesce(F.try_element_at(at(w), F.lit(1))["at"], F.lit(2147483647))), F.lit("")))


def trash_columns(ledger: DataFrame) -> list[tuple[str, int]]:
    """Trash's columns after the discards: its header (the canonical one without Trash), then the columns of moved rows that it
    lacks, in order of (table, place). Names of columns pass the driver, rows do not."""
    own = ledger.where(F.col("sheet") == TRASH).agg(F.min_by("header", "pos")).first()[0]
    count: dict[str, int] = {}
    out = []
    for name in CANONICAL_HEADER if own is None else own:
        count[name] = count.get(name, 0) + 1
        out.append((name, count[name]))
    headers = ledger.where(_moves()).select("sheet", "header").distinct().select("sheet", F.explode(named_columns(F.col("header"))).alias("c"))
    seen = headers.groupBy("c.name", "c.occ").agg(F.min(F.struct("sheet", "c.at")).alias("first")).collect()
    return out + [(r["name"], r["occ"]) for r in sorted(seen, key=lambda r: tuple(r["first"])) if (r["name"], r["occ"]) not in out]


def touched_raw_tables(ledger: DataFrame, watched: DataFrame | None = None, new_rows: DataFrame | None = None) -> DataFrame:
    """(sheet, lost, fed): the tables that ``reorganize_raw`` looks at, whether they lose rows and whether they get new ones."""
    no, yes = F.lit(False), F.lit(True)
    out = ledger.where(_moves()).select("sheet", yes.alias("lost"), no.alias("fed"))
    out = out.unionByName(ledger.sparkSession.range(1).select(F.lit(TRASH).alias("sheet"), no.alias("lost"), no.alias("fed")))
    if watched is not None:
        out = out.unionByName(watched.select("sheet", no.alias("lost"), no.alias("fed")))
    if new_rows is not None:
        out = out.unionByName(new_rows.select("sheet", no.alias("lost"), yes.alias("fed")))
    return out.groupBy("sheet").agg(F.bool_or("lost").alias("lost"), F.bool_or("fed").alias("fed"))


def reorganize_raw(ledger: DataFrame, watched: DataFrame | None = None, new_rows: DataFrame | None = None) -> DataFrame:
    """L2 + L3 + L8 + L10 + L5 over a raw ledger in one numbering pass, as ``ledger.reorganize`` over a canonical one.

    Steps that follow each other compose into one sort key: new rows stand before old ones of their bucket; a table that lost rows has been
    sorted by its old status before it got new ones; rows moved to Trash follow its own in (table, position) order."""
    moved = _moves()
    columns = trash_columns(ledger)
    names = F.array(*[F.lit(n).cast("string") for n, _ in columns])
    flags = touched_raw_tables(ledger, watched, new_rows)
    # other names than those of the result: inside a lambda, a select's own aliases would win over the columns it reads
    old = ledger.select("sheet", "pos", F.col("header").alias("_h"), F.col("cells").alias("_c"), moved.alias("_moved"))
    old = old.join(flags.withColumn("_in", F.lit(True)), "sheet", "left")
    fed = F.coalesce("fed", F.lit(False)) & ~F.col("_moved")
    canon = F.array(*[F.lit(n) for n in CANONICAL_HEADER])
    to_trash = F.col("_moved") | (F.col("sheet") == TRASH)
    before = F.when(F.coalesce("lost", F.lit(False)) & ~F.col("_moved"), status_bucket(raw_status("_h", "_c"))).otherwise(F.lit(0))
    old = old.withColumn("_before", before)
    old = old.select(
        F.when(F.col("_moved"), F.lit(TRASH)).otherwise(F.col("sheet")).alias("sheet"),
        F.col("pos").alias("_pos"),
        F.when(to_trash, names).when(fed, canon).otherwise(F.col("_h")).alias("header"),
        F.when(F.col("_moved"), aligned_cells(columns, "_h", "_c")).when(fed, F.array(*migrated_columns(F.col("_h"), F.col("_c")))).otherwise(F.col("_c")).alias("cells"),
        F.coalesce(F.col("_moved") | F.col("_in"), F.lit(False)).alias("_in"),
        F.lit(1).alias("_new"), "_before",
        F.struct(F.col("_moved").cast("int").alias("moved"), F.when(F.col("_moved"), F.col("sheet")).otherwise("").alias("src"), F.col("pos").alias("pos")).alias("_old"),
    )
    keys: list[str] = []
    if new_rows is not None:
        ranks = sorted(c for c in new_rows.columns if c.startswith("_o"))
        keys = [f"_k{i}" for i in range(len(ranks))]
        fresh = new_rows.select(
            "sheet", F.lit(None).cast("long").alias("_pos"), canon.alias("header"), F.array("title", "company", "tags", "status", "link").alias("cells"),
            F.lit(True).alias("_in"), F.lit(0).alias("_new"), F.lit(0).alias("_before"), F.lit(None).cast("struct<moved:int,src:string,pos:bigint>").alias("_old"),
            *[F.col(c).cast("long").alias(k) for c, k in zip(ranks, keys)])
        old = old.select("*", *[F.lit(None).cast("long").alias(k) for k in keys]).unionByName(fresh)
    sorts = F.col("_in") & (header_first("header", "Status") > 0)
    done = dense_positions(
        old.where(sorts).withColumn("_bucket", status_bucket(raw_status())), by=["sheet"], order=["_bucket", "_new", *keys, "_before", "_old"], out="pos")
    return done.select(*RAW_COLUMNS).unionByName(old.where(~sorts).select("sheet", F.col("_pos").alias("pos"), "header", "cells"))


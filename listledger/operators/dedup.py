"""De-duplication against the ledger and inside a run.

D1/D2 derive the known URLs and records from every ledger table (Trash
included); D3/D4 are anti joins against them; D5 is the order-dependent
de-duplication inside the run, done as rounds of aggregations and anti joins.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_ws
from ..session import checkpoint_dir, drop_table, materialize
from .filters import holds_url

log = logging.getLogger(__name__)

CANONICAL = ["title", "company", "tags", "status", "link"]
CONTENT = ["title", "company", "tags"]


def ledger_cells(ledger: DataFrame) -> DataFrame:
    """Every cell of every table as ``sheet, cell``. Takes the canonical form
    (five text columns) or the raw form (``cells`` array)."""
    if "cells" in ledger.columns:
        arr = F.col("cells")
    else:
        arr = F.array(*[F.col(c) for c in CANONICAL])
    return ledger.select("sheet", F.explode(arr).alias("cell"))


def known_urls(ledger: DataFrame, per_sheet: bool = False) -> DataFrame:
    """URLs held in any cell. A HYPERLINK formula gives every ``"``-piece
    holding ``http`` (query kept); another cell gives itself, stripped and cut
    at the first ``?``. Distinct (per sheet when asked, for G4)."""
    cells = ledger_cells(ledger).where(holds_url("cell"))
    c = F.col("cell")
    urls = F.when(
        c.contains("HYPERLINK"), F.filter(F.split(c, '"', -1), lambda p: p.contains("http"))
    ).otherwise(F.array(F.substring_index(trim_ws(c), "?", 1)))
    out = cells.select("sheet", F.explode(urls).alias("url"))
    return out.distinct() if per_sheet else out.select("url").distinct()


def known_records(ledger: DataFrame, per_sheet: bool = False) -> DataFrame:
    """Stripped title, company, tags, link of every row of every table
    (header-driven for the raw form, see ``sources.ledger.by_header``), with its table when asked."""
    if "cells" in ledger.columns:
        from ..sources.ledger import by_header

        ledger = by_header(ledger)
    keys = ["sheet"] if per_sheet else []
    return ledger.select(*keys, *[F.coalesce(trim_ws(c), F.lit("")).alias(c) for c in ["title", "company", "tags", "link"]])


def drop_known_urls(cands: DataFrame, urls: DataFrame, url_col: str = "full_url") -> DataFrame:
    """D3: drop candidates whose URL (uncut) is known. A hash anti join; AQE
    turns it into a broadcast when the known side is small at run time."""
    return cands.join(urls.select(F.col("url").alias(url_col)), url_col, "left_anti")


def drop_known_content(cands: DataFrame, records: DataFrame) -> DataFrame:
    """Drop candidates whose (title, company, tags) equals a known record,
    case-sensitive.

    Contents are whole texts, so the join key is their 64-bit hash and the known
    side ships hashes only. Candidates whose hash is known are then compared
    by text with the records of those hashes: exact whatever collides."""
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CONTENT])
    known = records.select(*CONTENT, h.alias("_h"))
    hashed = cands.withColumn("_h", h)
    hashes = known.select("_h").distinct()
    fresh = hashed.join(hashes, "_h", "left_anti")
    maybe = hashed.join(hashes, "_h", "left_semi")
    texts = known.join(maybe.select("_h").distinct(), "_h", "left_semi").select("_h", *CONTENT).distinct()
    return fresh.unionByName(maybe.join(texts, ["_h", *CONTENT], "left_anti").select(fresh.columns)).drop("_h")


def _digest(*cols: str) -> Column:
    """SHA-256 of the columns' texts, each after its length; null if one is null (such rows equal no known one)."""
    return F.unhex(F.sha2(F.concat(*[F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)) for c in cols]), 256))


def known_digests(ledger: DataFrame) -> DataFrame:
    """D1 and D2 as digests: ``sheet, kind, digest``, kind ``url`` or ``content``, each once a table."""
    urls = known_urls(ledger, per_sheet=True).select("sheet", F.lit("url").alias("kind"), _digest("url").alias("digest"))
    records = known_records(ledger, per_sheet=True)
    contents = records.select("sheet", F.lit("content").alias("kind"), _digest(*CONTENT).alias("digest")).distinct()
    return urls.unionByName(contents)


def drop_known_digests(cands: DataFrame, known: DataFrame, url_col: str = "full_url") -> DataFrame:
    """D3 and D4 against ``known_digests``: the known side holds no text and is scanned once, where it lies (the candidates'
    digests are the side that AQE may broadcast); only the digests that hit are joined back. Digests of 256 bits
    are taken as the texts they stand for."""
    cands = cands.withColumns({"_url": _digest(url_col), "_content": _digest(*CONTENT)})
    probe = cands.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("digest")) for k in ("url", "content")])).alias("p"))
    probe = probe.select("p.*").where("digest is not null").distinct()
    hits = materialize(known.select("kind", "digest").join(probe, ["kind", "digest"], "left_semi").distinct(), "known-hits")
    for kind in ("url", "content"):
        cands = cands.join(hits.where(F.col("kind") == kind).select(F.col("digest").alias(f"_{kind}")), f"_{kind}", "left_anti")
    return cands.drop("_url", "_content")


def dedup_ordered(cands: DataFrame, order: Sequence[str], url_col: str = "full_url",
                  content: Sequence[str] = tuple(CONTENT), hash_content: bool = True) -> DataFrame:
    """In ``order``, keep a row iff no earlier *kept* row has its URL or
    its content. Returns the kept rows of ``cands`` (all columns).

    The kept set is the greedy matching of the URL/content graph in rank
    order. Each round keeps every live row that is the earliest live row of
    both its URL and its content (such a row cannot have a kept predecessor),
    then drops the live rows sharing a URL or a content with them. Rounds
    repeat until nothing is live: exact, with no cap, one path for all sizes.
    Every round is cut from the lineage by tables written to the checkpoint
    folder, and the tables before it are deleted. ``order`` must be a unique key.
    A chain (1~2 by URL, 2~3 by content, ...) of any length is settled in one round, see ``_settled_chains``;
    a further round is needed only behind a row that two undecided rows come before.

    Contents (whole texts) are replaced by a 64-bit hash for the rounds
    when a check finds no two distinct contents with one hash; otherwise the
    full contents are the key (``hash_content=False`` always keeps them).

    Skew: the per-key minima are partial aggregations, so a URL or a content
    shared by a third of all rows costs one row per map task; the anti joins
    are equi joins that AQE broadcasts by measured bytes or splits by skew.
    """
    spark = cands.sparkSession
    checkpoint_dir(spark)
    rk = F.struct(*[F.col(o) for o in order]).alias("_rk")
    ck = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_c{i}") for i, c in enumerate(content)]
    cks = [f"_c{i}" for i in range(len(content))]
    base = cands.select(rk, F.coalesce(F.col(url_col), F.lit("")).alias("_u"), *ck)
    if hash_content:
        # Contents are whole texts: key the rounds by a 64-bit hash instead,
        # once one aggregation has shown that no two distinct contents share a
        # hash (partial aggregation: each map task ships each (hash, content)
        # once). On a collision the full contents stay the key: still exact.
        hashed = base.withColumn("_h", F.xxhash64(*[F.col(c) for c in cks]))
        collides = (hashed.groupBy("_h").agg(F.countDistinct(*cks).alias("_n"))
                    .where(F.col("_n") > 1).limit(1).count() > 0)
        if not collides:
            base = hashed.select("_rk", "_u", F.col("_h").alias("_c0"))
            cks = ["_c0"]
        log.info("dedup_ordered: content keys %s", "full (hash collision)" if collides else "hashed")

    # Twins (equal URL and content) keep only their first row: a later twin is
    # always dropped. Partial aggregation absorbs a hot twin group.
    live = materialize(base.groupBy("_u", *cks).agg(F.min("_rk").alias("_rk")), "dedup-live")
    kept = None
    rounds = 0
    while not live.isEmpty():
        rounds += 1
        t0 = time.time()
        mu = live.groupBy("_u").agg(F.min("_rk").alias("_rk")).select("_rk", F.lit(True).alias("_fu"))
        mc = live.groupBy(*cks).agg(F.min("_rk").alias("_rk")).select("_rk", F.lit(True).alias("_fc"))
        flags = [F.coalesce(f, F.lit(False)).alias(f) for f in ("_fu", "_fc")]
        marked = materialize(live.join(mu, "_rk", "left").join(mc, "_rk", "left").select("_rk", "_u", *cks, *flags), "dedup-marked")
        chained = _settled_chains(marked, cks)
        sel = marked.where("_fu and _fc").select("_rk", "_u", *cks)
        if chained is not None:
            sel = sel.unionByName(marked.join(chained, "_rk", "left_semi").select("_rk", "_u", *cks))
        sel = materialize(sel, "dedup-kept")
        part = sel.select("_rk")
        kept = part if kept is None else kept.unionByName(part)
        rest = live.join(sel.select("_u"), "_u", "left_anti").join(sel.select(*cks), cks, "left_anti")
        before, live = live, materialize(rest, "dedup-live")
        for done in (before, marked, chained):
            if done is not None:
                drop_table(done)
        log.info("dedup_ordered: round %d, %.2fs", rounds, time.time() - t0)
    drop_table(live)
    log.info("dedup_ordered: %d rounds", rounds)
    if kept is None:
        return cands.limit(0)
    return cands.withColumn("_rk", rk).join(kept, "_rk", "left_semi").drop("_rk")


def _settled_chains(marked: DataFrame, cks: Sequence[str]) -> DataFrame | None:
    """The rows (``_rk``, written) that are kept because of rows decided in the same round; None if no row is.

    A live row with a single earlier live row among those sharing its URL or content (it is first of the one and second of the other)
    is kept iff that row is not. Such rows point to that row, with "not" as the function between the two. Pointers
    are doubled, two steps a written table, until each ends at a row without a pointer; so the tables grow with the logarithm of
    the longest chain. Where the end is first of both its URL and its content, it is kept, and an even number of steps
    says the same of the row; other ends are still open, and so are the rows that point to them.

    Every table here has a row per key or per row: firsts and seconds are partial aggregations, and a row has at most two that point to it."""
    links = None
    for key, own, other in ((["_u"], "_fu", "_fc"), (list(cks), "_fc", "_fu")):
        second = marked.where(~F.col(own)).groupBy(*key).agg(F.min(F.struct("_rk", other)).alias("_s"))
        second = second.where(F.col(f"_s.{other}")).select(*key, F.col("_s._rk").alias("_from"))
        first = marked.where(own).select(*key, F.col("_rk").alias("_to"))
        part = second.join(first, key).select("_from", "_to", F.lit(1).alias("_odd"))
        links = part if links is None else links.unionByName(part)
    links = materialize(links, "dedup-chain")
    if links.isEmpty():
        drop_table(links)
        return None
    roots = marked.where("_fu and _fc").select(F.col("_rk").alias("_to"))
    tables = [links]
    while True:
        for _ in range(2):
            by = links.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"), F.col("_odd").alias("_more"))
            links = links.join(by, "_to", "left").select(
                "_from", F.coalesce("_next", "_to").alias("_to"), ((F.col("_odd") + F.coalesce("_more", F.lit(0))) % 2).alias("_odd"))
        links = materialize(links, "dedup-chain")
        tables.append(links)
        if links.join(tables[0].select(F.col("_from").alias("_to")), "_to", "left_semi").isEmpty():
            break
    out = materialize(links.where("_odd = 0").join(roots, "_to", "left_semi").select(F.col("_from").alias("_rk")), "dedup-settled")
    log.info("dedup_ordered: chains settled in %d written tables", len(tables) + 1)
    for t in tables:
        drop_table(t)
    return out


def dedup_ordered_naive(cands: DataFrame, order: Sequence[str], url_col: str = "full_url",
                        content: Sequence[str] = tuple(CONTENT)) -> DataFrame:
    """Two independent first-occurrence filters. NOT the reference's rule (a row
    dropped for its content does not make its URL seen); kept for comparison."""
    from pyspark.sql import Window

    o = [F.col(x) for x in order]
    w1 = Window.partitionBy(url_col).orderBy(*o)
    w2 = Window.partitionBy(*content).orderBy(*o)
    return (cands.withColumn("_a", F.row_number().over(w1)).withColumn("_b", F.row_number().over(w2))
            .where("_a = 1 and _b = 1").drop("_a", "_b"))

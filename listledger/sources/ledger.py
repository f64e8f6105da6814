"""The ledger as a dataset.

Stored as parquet partitioned by ``sheet`` (per-table work prunes partitions),
one folder of changed tables per version under a root, and a manifest that names
the folder holding each table. A version counts once its manifest is there. The manifest is written aside and then
renamed to a name that must be free, so replacing the ledger is atomic, a crash mid-write leaves the previous version
current, and of two writers that started from one version only the first commits (the other is told, see ``LedgerStore.update``).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Collection
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import known_digests
from ..operators.ledger import LEDGER_COLUMNS, cell_at, header_first

log = logging.getLogger(__name__)

LEDGER_SCHEMA = "sheet string, pos bigint, title string, company string, tags string, status string, link string"
RAW_SCHEMA = "sheet string, pos bigint, header array<string>, cells array<string>"
MANIFEST_SCHEMA = "own boolean, sheet string, folder string"  # a row per table, and one (own) that names the version's own folder
DIGEST_SCHEMA = "sheet string, kind string, digest binary"


def empty_ledger(spark: SparkSession, schema: str = LEDGER_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def scan(ledger: DataFrame) -> DataFrame:
    """Every table, Trash included (no filter)."""
    return ledger.select(*LEDGER_COLUMNS)


def by_header(raw: DataFrame) -> DataFrame:
    """Title / Company / Tags / Link found by header text (first equal
    header); an absent column or a short row gives ''."""
    h, c = F.col("header"), F.col("cells")
    return raw.select(
        "sheet", "pos",
        *[cell_at(c, header_first(h, name)).alias(name.lower()) for name in ["Title", "Company", "Tags", "Link"]],
    )


def sheet_list(watch_titles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tables that exist after get-or-create: the watched titles, the
    present tables and Trash. ``created`` marks the ones made empty now."""
    present = ledger.select("sheet").distinct().withColumn("_p", F.lit(True))
    wanted = watch_titles.select(F.col("group_title").alias("sheet")).unionByName(
        ledger.sparkSession.range(1).select(F.lit("Trash").alias("sheet"))).distinct()
    return (
        wanted.join(present, "sheet", "full")
        .select("sheet", F.col("_p").isNull().alias("created"))
    )


def append(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows at the end of their table, in their order (``_o*`` columns or
    ``pos``), numbered after the table's last row."""
    from ..operators.ordering import dense_positions

    ocols = sorted([c for c in rows.columns if c.startswith("_o")]) or ["pos"]
    last = ledger.groupBy("sheet").agg(F.max("pos").alias("_base"))
    numbered = dense_positions(rows, by=["sheet"], order=ocols, out="_n")
    added = numbered.join(last, "sheet", "left").select(
        "sheet", (F.coalesce("_base", F.lit(0)) + F.col("_n")).cast("long").alias("pos"),
        "title", "company", "tags", "status", "link")
    return ledger.select(*LEDGER_COLUMNS).unionByName(added)


class VersionConflict(RuntimeError):
    """Another writer has committed this version."""


def in_tables(names: Collection[str | None]) -> Column:
    """Whether ``sheet`` is one of ``names`` (None: the table without a name)."""
    named = F.col("sheet").isin([s for s in names if s is not None])
    return F.coalesce(named, F.lit(False)) | F.col("sheet").isNull() if None in names else named


class LedgerStore:
    """Versioned ledger folder. ``current()`` is the newest committed version; ``write()`` adds a version and never
    touches the current one; ``update()`` does so beside other writers. ``schema``: the canonical or the raw form.

    Commits need a file system whose rename is atomic and refuses a taken name (HDFS and local disks)."""

    def __init__(self, spark: SparkSession, root: str, schema: str = LEDGER_SCHEMA):
        self.spark, self.schema = spark, schema
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _publish(self, aside: str, final: str) -> bool:
        """Give a finished folder its name; False if the name is taken (the folder is deleted then)."""
        fs = self._jvm.org.apache.hadoop.fs
        source, target = (self._fs.makeQualified(self._path(p)) for p in (aside, final))
        no_options = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(source, target, no_options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(source, True)
            return False
        return True

    def _versions(self) -> list[int]:
        p = self._path(self.root)
        if not self._fs.exists(p):
            return []
        names = (st.getPath().getName() for st in self._fs.listStatus(p) if st.isDirectory())
        return sorted(int(n[9:]) for n in names if n.startswith("manifest-"))

    def has_tag(self, tag: str) -> bool:
        """Whether a committed version carries ``tag`` (part of its folder's name, which its manifest holds, so data and tag commit together)."""
        paths = [f"{self.root}/manifest-{v}" for v in self._versions()]
        if not paths:
            return False
        own = self.spark.read.schema(MANIFEST_SCHEMA).json(paths).where("own")
        return not own.where(F.col("folder").endswith(f".{tag}")).isEmpty()

    def current_version(self) -> int | None:
        v = self._versions()
        return v[-1] if v else None

    def current(self) -> DataFrame:
        v = self.current_version()
        return empty_ledger(self.spark, self.schema) if v is None else self.read(v)

    def _holders(self, version: int) -> dict[str | None, str]:
        """For each table of a version, the folder that holds its rows."""
        if version not in self._versions():
            raise ValueError(f"ledger version {version} is not committed under {self.root}")
        rows = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/manifest-{version}").where("not own")
        return {r["sheet"]: r["folder"] for r in rows.collect()}

    def _by_folder(self, version: int) -> list[tuple[str, list]]:
        out: dict[str, list] = {}
        for sheet, folder in self._holders(version).items():
            out.setdefault(folder, []).append(sheet)
        return sorted(out.items())

    def read(self, version: int) -> DataFrame:
        """A committed version: each table from the folder that wrote it last."""
        out = empty_ledger(self.spark, self.schema)
        for folder, sheets in self._by_folder(version):
            part = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}").select(*self.columns)
            out = out.unionByName(part.where(in_tables(sheets)))
        return out

    def known(self, version: int) -> DataFrame:
        """The known state of a version (D1, D2) as digests (``sheet, kind, digest``), from an index beside each folder of rows.

        A folder never changes once a manifest names it, so its index is computed once, when first asked for, from that
        folder alone; it holds a digest of 32 bytes a URL or record, and no text. Tables that a later version
        wrote again are taken from the later folder's index, so rewritten, moved and deleted rows are followed exactly."""
        out = self.spark.createDataFrame([], DIGEST_SCHEMA)
        for folder, sheets in self._by_folder(version):
            path = f"{self.root}/known-{folder}"
            if not self._fs.exists(self._path(path)):
                aside = f"{self.root}/_known-{uuid.uuid4().hex}"
                rows = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}").select(*self.columns)
                known_digests(rows).write.parquet(aside)
                self._publish(aside, path)  # another writer's index of the folder is the same
                log.info("ledger: indexed %s", folder)
            out = out.unionByName(self.spark.read.schema(DIGEST_SCHEMA).parquet(path).where(in_tables(sheets)))
        return out

    def has_version(self, version: int) -> bool:
        return version in self._versions()

    def write(self, ledger: DataFrame, version: int | None = None, tag: str = "",
              changed: DataFrame | Collection[str | None] | None = None) -> int:
        """Write ``ledger`` as a new version (partitioned by sheet). Writing a
        version that is already committed is a no-op (idempotent retries).

        ``changed`` (names, or column ``sheet``): the tables that differ from the current version. Only
        those are written; the others stay in the folders that hold them, which the version's
        manifest names. Names of tables pass the driver, rows do not. ``VersionConflict`` if another writer commits the
        version meanwhile; writers that may meet use ``update``."""
        cur = self.current_version()
        if version is None:
            version = 0 if cur is None else cur + 1
        if self.has_version(version):
            return version
        return self._commit(ledger, cur, version, tag, changed)

    def update(self, build: Callable[[DataFrame, int], tuple[DataFrame, DataFrame | Collection[str | None] | None]],
               tag: str = "", attempts: int = 20) -> int:
        """Commit ``build(ledger, version) -> (rows, changed tables)`` on top of the version it was given. If another writer
        commits first, ``build`` runs again on that writer's version, so both changes are kept. With a ``tag`` that is
        committed already, nothing is done. Returns the current version then."""
        for _ in range(attempts):
            base = self.current_version()
            if base is None:
                raise ValueError("the ledger store needs an initial version (0)")
            if tag and self.has_tag(tag):
                return base
            rows, changed = build(self.read(base), base)
            try:
                return self._commit(rows, base, base + 1, tag or uuid.uuid4().hex, changed)
            except VersionConflict:
                log.info("ledger: version %d was committed by another writer, again", base + 1)
        raise VersionConflict(f"no commit in {attempts} attempts under {self.root}")

    def _commit(self, ledger: DataFrame, base: int | None, version: int, tag: str, changed) -> int:
        rows, held = ledger, {}
        if changed is not None and base is not None:
            touched = {r[0] for r in changed.select("sheet").distinct().collect()} if isinstance(changed, DataFrame) else set(changed)
            rows = ledger.where(in_tables(touched))
            held = {s: f for s, f in self._holders(base).items() if s not in touched}
        # No shuffle here: a rewritten ledger comes range-partitioned on
        # (sheet, order) from the numbering pass, so each task holds a
        # contiguous slice and writes one sorted file per table it touches (a
        # table holding a third of all rows is written by many tasks).
        own = f"v={version}" + (f".{tag}" if tag else "")
        (rows.select(*self.columns).sortWithinPartitions("sheet", "pos")
         .write.mode("overwrite").partitionBy("sheet").parquet(f"{self.root}/{own}"))
        for st in self._fs.listStatus(self._path(f"{self.root}/{own}")):
            name = unquote(st.getPath().getName())
            if name.startswith("sheet="):
                held[None if name == "sheet=__HIVE_DEFAULT_PARTITION__" else name[6:]] = own
        named = [(True, None, own), *((False, s, f) for s, f in sorted(held.items(), key=str))]
        aside = f"{self.root}/_manifest-{uuid.uuid4().hex}"
        self.spark.createDataFrame(named, MANIFEST_SCHEMA).coalesce(1).write.json(aside)
        if not self._publish(aside, f"{self.root}/manifest-{version}"):  # the commit
            if tag:
                self._fs.delete(self._path(f"{self.root}/{own}"), True)
            raise VersionConflict(f"ledger version {version} was committed by another writer under {self.root}")
        return version

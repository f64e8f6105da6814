"""Repeated runs against one ledger (J4) as Structured Streaming.

New listings arrive in a folder, either as one parquet file or as a folder of parquet files
(``_arrivals/<name>``) that a file ``<name>.arrival`` (not empty) announces once it is complete. A
file-source stream with an ``availableNow`` trigger takes the arrivals one by one: its rows are the paths of
files and announcements, and the batch of an arrival is read by as many tasks as its files need. ``foreachBatch``
de-duplicates each arrival against the ledger version the previous one
left (D3-D5), prepends the new rows (L7, L8), re-buckets (L5) and writes the
next version on top of the current one, tagged with the stream's id and the
batch id. D3 and D4 probe the version's index of known digests and read no ledger text; the rewrite reads the tables that it touches.
A batch whose tag is committed is skipped when it is replayed; one
that failed before its commit finds the ledger as it was. Versions written
by others in between (a full run, discards) are built upon, also those committed while a batch runs: the batch then
runs again on top of them.
"""

from __future__ import annotations

import json
import logging
import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.jobs import rewrite_touched, run_listings
from ..sources.ledger import LedgerStore

log = logging.getLogger(__name__)

LISTING_SCHEMA = ("group_idx long, group_title string, url_idx long, pos long, full_url string, title string, company string, "
                  "tags string")
ARRIVAL_SCHEMA = "path string, modificationTime timestamp, length long, content binary"  # only the path is read


def write_batches(listings: DataFrame, batch_col: str, folder: str) -> int:
    """Stage arrivals for a test or a replay: one arrival per distinct ``batch_col`` value, in value order, announced
    with increasing modification times so the file source takes them in that order. One Spark write without a shuffle (each task
    writes a file for every arrival it holds rows of, so an arrival of a third of all rows is written by many tasks), then
    a folder move per arrival. Returns the count of arrivals."""
    spark = listings.sparkSession
    staging = f"{folder}/_staging"
    staged = listings.withColumn("_arrival", F.col(batch_col).cast("string"))
    if batch_col != "_arrival":
        staged = staged.drop(batch_col)
    staged.write.mode("overwrite").partitionBy("_arrival").parquet(staging)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(conf)
    # one folder per batch value; the names carry the value (escaped the same
    # way for every value, so their order is the order of the values)
    dirs = sorted((st.getPath() for st in fs.listStatus(Path(staging)) if st.isDirectory()),
                  key=lambda p: unquote(p.getName().split("=", 1)[1]))
    base_ms = 1_000_000_000_000
    fs.mkdirs(Path(f"{folder}/_arrivals"))
    for i, d in enumerate(dirs):
        fs.rename(d, Path(f"{folder}/_arrivals/b{i:06d}"))
        notice = Path(f"{folder}/b{i:06d}.arrival")
        out = fs.create(notice, True)
        out.writeBytes(f"b{i:06d}\n")  # a scan skips empty files
        out.close()
        fs.setTimes(notice, base_ms + i * 60_000, -1)
    return len(dirs)


def _arrival_files(path: str) -> str:
    """What to read for a path that the stream saw: a parquet file itself, or the folder that an announcement names."""
    if not path.endswith(".arrival"):
        return path
    folder, name = path.rsplit("/", 1)
    return f"{folder}/_arrivals/{name[:-8]}"


def run_incremental(spark: SparkSession, source_folder: str, store: LedgerStore, results_folder: str,
                    checkpoint: str, recent_days: int | None = None,
                    limit=None, max_limit: int | None = None) -> None:
    """Process every arrival in ``source_folder`` (one per batch, of any number of files)
    against ``store``; new rows of batch ``b`` also go to
    ``results_folder/batch=<stream id>-b``. Returns when all arrivals are processed.
    ``checkpoint`` must be the same folder from call to call: it holds which arrivals are done.

    Each batch is one run: ``limit``/``max_limit`` (T1 per URL) and
    ``recent_days`` (F2) apply inside the batch, as for a single run."""
    if store.current_version() is None:
        raise ValueError("the ledger store needs an initial version (0)")

    def per_batch(arrived: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        # the stream's id lives in its checkpoint: a new checkpoint is a new stream
        meta = spark.read.text(f"{checkpoint}/metadata").first()[0]
        tag = f"{json.loads(meta)['id']}-{batch_id}"
        paths = [_arrival_files(r["path"]) for r in arrived.select("path").collect()]  # one, by maxFilesPerTrigger
        batch = spark.read.schema(LISTING_SCHEMA).parquet(*paths)
        groups = batch.select("group_idx", "group_title").distinct()

        def build(ledger: DataFrame, version: int):
            res = run_listings(batch, ledger, groups, limit=limit, max_limit=max_limit, recent_days=recent_days,
                               rewrite_ledger=False, known=store.known(version))
            res.new.select(*[c.split()[0] for c in LISTING_SCHEMA.split(", ")]).write.mode("overwrite").parquet(
                f"{results_folder}/batch={tag}")
            return rewrite_touched(ledger, groups, res.new)

        store.update(build, tag=tag)
        log.info("incremental: batch %d done in %.2fs", batch_id, time.time() - t0)

    stream = (
        spark.readStream.format("binaryFile").schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "*.{parquet,arrival}").load(source_folder)
        .writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()

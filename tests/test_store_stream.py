"""S10 versioned ledger and J4: k batches one by one equal one ordered batch."""

from pyspark.sql import functions as F

import pytest

from listledger.operators import dedup, filters
from listledger.plans.jobs import organize_only, rewrite_touched, run_listings
from listledger.sources import bindings
from listledger.sources.ledger import RAW_SCHEMA, LedgerStore, VersionConflict
from listledger.streaming.incremental import run_incremental, write_batches

SF = "/root/testdata/sf0.001"


def test_versions_are_atomic_and_idempotent(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    assert store.current_version() is None and store.current().count() == 0
    s = bindings.sheets(spark, SF)
    assert store.write(s) == 0
    assert store.write(s.limit(3), version=0) == 0          # already committed: no-op
    assert store.current().count() == s.count()
    (tmp_path / "ledger" / "v=1").mkdir()                    # a crashed write: no _SUCCESS
    assert store.current_version() == 0
    assert store.write(s.where("sheet = 'Trash'")) == 1
    assert store.current().select("sheet").distinct().collect()[0][0] == "Trash"


def test_batches_equal_one_ordered_batch(spark, tmp_path):
    offers = bindings.offers(spark, SF).withColumn("url_idx", F.col("url_idx").cast("long"))
    offers = offers.withColumn("title", F.trim("title"))
    known = filters.drop_polish(offers.where(F.col("pos") % 11 == 0))
    ledger0 = known.select(F.col("group_title").alias("sheet"), "pos", "title", "company", "tags",
                           F.lit("NEW").alias("status"), F.col("full_url").alias("link"))
    feed = filters.drop_polish(offers.where(F.col("pos") % 11 != 0))

    one = run_listings(feed, ledger0, feed.select("group_idx", "group_title"), max_limit=None, rewrite_ledger=False)
    want = sorted((r.group_title, r.pos) for r in one.new.collect())

    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.write(ledger0, version=0)
    write_batches(feed.withColumn("_b", F.lpad(F.floor(F.col("group_idx") / 2).cast("string"), 20, "0")), "_b", str(tmp_path / "in"))
    run_incremental(spark, str(tmp_path / "in"), store, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    got = sorted((r.group_title, r.pos) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == want
    # the last version holds the ledger plus every new row, nothing twice
    assert store.current().count() == ledger0.count() + len(want)


def test_untouched_tables_are_not_written_again(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    s = bindings.sheets(spark, SF)
    store.write(s)
    changed = s.where("sheet = 'Trash'").select("sheet").limit(1)
    more = s.withColumn("title", F.when(F.col("sheet") == "Trash", F.lit("new")).otherwise(F.col("title")))
    assert store.write(more, changed=changed) == 1
    assert [p.name for p in (tmp_path / "ledger" / "v=1").iterdir() if p.is_dir()] == ["sheet=Trash"]
    assert sorted(map(str, store.current().collect())) == sorted(map(str, more.select(store.current().columns).collect()))
    assert sorted(map(str, store.read(0).collect())) == sorted(map(str, s.select(store.current().columns).collect()))
    gone = more.where("sheet <> 'Trash'")
    store.write(gone, changed=changed)
    assert store.current().where("sheet = 'Trash'").count() == 0 and store.current().count() == gone.count()


LISTING = "group_idx long, group_title string, url_idx long, pos long, full_url string, title string, company string, tags string"
LEDGER = "sheet string, pos bigint, title string, company string, tags string, status string, link string"


def test_an_arrival_of_many_files_is_one_version(spark, tmp_path):
    rows = [(0, "A", 0, i, f"https://x.example/{i % 50}", f"t{i % 70}", "c", "g") for i in range(400)]
    feed = spark.createDataFrame(rows, LISTING)
    ledger0 = spark.createDataFrame([("A", 1, "t3", "c", "g", "NEW", "https://x.example/7?q=1")], LEDGER)
    want = sorted(r.pos for r in run_listings(feed, ledger0, feed.select("group_idx", "group_title"), max_limit=None, rewrite_ledger=False).new.collect())
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.write(ledger0)
    assert write_batches(feed.repartition(40, "pos").withColumn("_b", F.lit("x")), "_b", str(tmp_path / "in")) == 1
    assert len(list((tmp_path / "in" / "_arrivals" / "b000000").glob("*.parquet"))) > 30
    args = (spark, str(tmp_path / "in"), store, str(tmp_path / "out"), str(tmp_path / "ck"))
    run_incremental(*args)
    assert store.current_version() == 1
    assert sorted(r.pos for r in spark.read.parquet(str(tmp_path / "out")).collect()) == want
    run_incremental(*args)
    assert store.current_version() == 1 and store.current().count() == 1 + len(want)


def test_known_index_follows_versions(spark, tmp_path):
    """Digests give the verdicts of D3 and D4 by text, for both forms of a ledger, rewritten and deleted tables, and nulls."""
    v0 = [("A", 1, " t1 ", "c", "g", "NEW", "https://x.example/1?a=b"), ("B", 1, "t2", "", None, "OUT", '=HYPERLINK("http://y/2?q=1","n")'), (None, 1, "t3", "c", "g", "", "")]
    cands = spark.createDataFrame([(0, "A", 0, i, u, t, c, g) for i, (u, t, c, g) in enumerate([
        ("https://x.example/1", "new", "c", "g"), ("https://x.example/1?a=b", "new2", "c", "g"), ("http://y/2?q=1", "n", "n", "n"), ("u", "t1", "c", "g"), ("u", "T1", "c", "g"),
        ("u", "t2", "", ""), (None, "t3", "c", "g"), (None, "t4", "c", "g"), ("u", "t1", None, "g"), ("", "", "", ""), ("u", "t1c", "", "g")])], LISTING)

    def check(store):
        ledger = store.current()
        want = dedup.drop_known_content(dedup.drop_known_urls(cands, dedup.known_urls(ledger)), dedup.known_records(ledger))
        got = dedup.drop_known_digests(cands, store.known(store.current_version()))
        assert got.columns and sorted(r.pos for r in got.collect()) == sorted(r.pos for r in want.collect())
        return {r.pos for r in got.collect()}

    store = LedgerStore(spark, str(tmp_path / "ledger"))
    first = spark.createDataFrame(v0, LEDGER)
    store.write(first)
    before = check(store)
    assert 0 not in before and 3 not in before and {1, 4, 7, 8, 10} <= before
    store.write(first.where("sheet = 'B'").withColumn("title", F.lit("other")), changed=["A", "B"])  # A is gone, B rewritten
    after = check(store)
    assert {0, 3, 5} <= after and 6 not in after and 2 not in after
    store.write(first.limit(0))
    assert check(store) == {r.pos for r in cands.collect()}
    raw = LedgerStore(spark, str(tmp_path / "raw"), RAW_SCHEMA)
    raw.write(spark.createDataFrame([("R", 1, ["Link", "Title", "x"], ["https://x.example/1", "t1", "http://z"]), ("R", 2, ["Link", "Title", "x"], [])], RAW_SCHEMA))
    check(raw)


def test_two_writers_from_one_version(spark, tmp_path):
    """A run and a discard pass that start from one version: the later one to commit is built again on the other's, both are kept."""
    store, other = (LedgerStore(spark, str(tmp_path / "ledger")) for _ in range(2))
    store.write(spark.createDataFrame([("A", 1, "old", "c", "g", "OUT", "https://x.example/1"), ("A", 2, "kept", "c", "g", "SAVE", "https://x.example/2")], LEDGER))
    feed = spark.createDataFrame([(0, "A", 0, 0, "https://x.example/1", "again", "c", "g"), (0, "A", 0, 1, "https://x.example/3", "fresh", "c", "g")], LISTING)
    groups = feed.select("group_idx", "group_title").distinct()
    bases = []

    def listings(ledger, version):
        run = run_listings(feed, ledger, groups, rewrite_ledger=False, known=other.known(version))
        return rewrite_touched(ledger, groups, run.new)

    def organize(ledger, version):
        bases.append(version)
        if len(bases) == 1:
            other.update(listings, tag="feed-0")  # commits while this writer works on version 0
        watch = spark.createDataFrame([(0, "A", 0, "u")], "group_idx long, group_title string, url_idx long, url string")
        return organize_only(ledger, watch), ["A", "Trash"]

    assert store.update(organize) == 2 and bases == [0, 1]
    got = {(r.sheet, r.pos): r.title for r in store.current().collect()}
    assert got == {("A", 1): "kept", ("A", 2): "fresh", ("Trash", 1): "old"} or got == {("A", 1): "fresh", ("A", 2): "kept", ("Trash", 1): "old"}
    assert other.update(listings, tag="feed-0") == 2 and store.current_version() == 2  # a replay does nothing
    assert len([p for p in (tmp_path / "ledger").iterdir() if p.name.startswith("v=1.")]) == 1  # the loser's folder is gone
    with pytest.raises(VersionConflict):
        store._commit(store.current(), 1, 2, "late", None)
    assert store.current_version() == 2 and not store.has_tag("late") and store.has_tag("feed-0")


def test_a_run_on_the_index_reads_no_ledger_text(spark, tmp_path):
    """D3 and D4 on the index: what is known is digests, and the verdicts' plan scans neither the ledger nor its index again."""
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.write(bindings.sheets(spark, SF))
    cands = spark.createDataFrame([(0, "A", 0, 0, "https://x.example/1", "t", "c", "g")], LISTING)
    known = store.known(0)
    assert known.columns == ["sheet", "kind", "digest"]
    assert all("/known-v=0/" in f for f in known.inputFiles())
    out = dedup.drop_known_digests(cands, store.known(0))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "v=0" not in plan and out.count() == 1

"""Properties from the test plan: discards keep + moved = all, re-bucketing
is idempotent, and a second run over the same pages adds nothing."""

from pyspark.sql import functions as F

from listledger.operators import ledger as L
from listledger.plans import jobs
from listledger.sources import bindings

SF = "/root/testdata/sf0.001"
COLS = ["sheet", "pos", "title", "company", "tags", "status", "link"]


def rows(df, cols=COLS):
    return sorted(tuple("" if v is None else v for v in r) for r in df.select(cols).collect())


def test_discards_partition_the_ledger(spark):
    s = bindings.sheets(spark, SF)
    kept, moved = L.split_discards(s)
    assert kept.count() + moved.count() == s.count()
    assert rows(kept.unionByName(moved)) == rows(s)
    assert moved.where(F.col("sheet") == L.TRASH).count() == 0


def test_rebucketing_is_idempotent(spark):
    once = L.status_order(bindings.sheets(spark, SF))
    twice = L.status_order(once)
    assert rows(once) == rows(twice)
    organized = jobs.organize_only(bindings.sheets(spark, SF), bindings.watch_groups(spark, SF))
    again = jobs.organize_only(organized, bindings.watch_groups(spark, SF))
    assert rows(organized) == rows(again)


def test_second_run_adds_nothing(spark, tmp_path):
    from listledger.sources.ledger import LedgerStore

    store = LedgerStore(spark, str(tmp_path / "ledger"))
    watch, pages = bindings.card_watch(spark, SF)
    first = jobs.full_run(watch, pages, bindings.sheets(spark, SF))
    n_new = first.new.count()
    assert n_new > 0
    store.write(first.ledger)                      # runs meet through ledger versions
    ledger1 = store.current()
    assert ledger1.count() == bindings.sheets(spark, SF).count() + n_new
    second = jobs.full_run(watch, pages, ledger1)
    # Everything comes back known, but for one quirk kept from the reference:
    # cards without a link all have the URL "Unknown", which is no known URL
    # (it holds no "http"). The first run kept the first of them and dropped
    # the rest as URL duplicates; the second run drops that one by content,
    # so "Unknown" is not seen in that run and the next such card is new.
    again = second.new.collect()
    assert len(again) == 1 and again[0].full_url == "Unknown"
    store.write(second.ledger)
    third = jobs.full_run(watch, pages, store.current()).new.collect()
    assert len(third) == 1 and third[0].full_url == "Unknown" and third[0].title != again[0].title

"""Back-off of sparse and unlabelled templates, and merging below the first segment."""

import pytest
from pyspark.sql import functions as F

from listledger.llm import urlfilter


def tree_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "host string, path string, label string").withColumn("segments", urlfilter.masked(F.col("path")))
    return {(r["host"], "/".join(r["segments"])): r for r in urlfilter.template_tree(df, **options).collect()}


def test_unlabelled_templates_back_off(spark):
    rows = [(h, f"/bad/{k}", "block") for h in "abc" for k in range(30)] + [(h, f"/good/{k}", "allow") for h in "abc" for k in range(30)]
    rows += [("d", f"/bad/{k}", None) for k in range(20)] + [("d", f"/good/{k}", None) for k in range(20)]
    rows += [("e", f"/x/{k}", "block") for k in range(40)] + [("e", "/bad/1", None), ("e", "/good/1", None)]
    tree = tree_of(spark, rows, backoff=True)
    assert tree["d", "/bad/{n}"]["purity"] > 0.6 > 0.4 > tree["d", "/good/{n}"]["purity"]
    assert tree["e", "/bad/{n}"]["purity"] > 0.8  # the host and the other hosts speak against it
    assert tree["d", "/good/{n}"]["purity"] < tree["e", "/good/{n}"]["purity"] < 0.5  # the host speaks against it, the other hosts for it
    assert tree_of(spark, rows)["e", "/bad/{n}"]["purity"] == 0.5


def test_few_labels_do_not_speak_for_many_pages(spark):
    rows = [("h", f"/u/n{k}x", "block" if k < 4 else None) for k in range(1000)] + [("g", f"/u/n{k}x", "allow") for k in range(400)]
    assert tree_of(spark, rows)["h", "/u/n9x"]["purity"] == pytest.approx(5 / 6)
    assert tree_of(spark, rows, backoff=True)["h", "/u/n9x"]["purity"] < 0.5


def test_nothing_known_and_all_known(spark):
    tree = tree_of(spark, [("h", "/a/b", None), ("h", "", None), ("g", "/a", None)], backoff=True)
    assert {r["purity"] for r in tree.values()} == {0.5}


def test_merging_below_the_first_segment(spark):
    rows = [("h", f"/shop/{s}/{k}", "block") for s in ("red", "blue") for k in range(15)] + [("h", f"/shop/news/{k}", "allow") for k in range(15)]
    tree = tree_of(spark, rows)
    assert tree["h", "/shop/red/{n}"]["purity"] == pytest.approx(16 / 17) == tree["h", "/shop/blue/{n}"]["purity"]
    rows = [r for r in rows if "news" not in r[1]]
    tree = tree_of(spark, rows)
    assert tree["h", "/shop/red/{n}"]["branch"] == tree["h", "/shop/blue/{n}"]["branch"] and tree["h", "/shop/red/{n}"]["purity"] == pytest.approx(31 / 32)


def test_the_registered_query_decides_unruled_pages(spark):
    from listledger.llm.queries import QUERIES

    got = QUERIES["op6_urls"](spark, "/root/testdata/sf0.01").where("rule is null").select("verdict").collect()
    assert "block" in {r["verdict"] for r in got}  # one of the two verdicts for all of them before

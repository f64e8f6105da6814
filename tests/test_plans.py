"""Plan shape: T1 limits before the shuffle, D3/D4 are hash/broadcast anti
joins (no nested loop), the native extractors stay in the JVM, filters and
column pruning reach the parquet scan."""

import pytest
from pyspark.sql import functions as F

from listledger.operators import dedup, extract as X
from listledger.operators.ordering import top_n_per_key
from listledger.plans import queries as Q
from listledger.sources import bindings

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topn_uses_window_group_limit(spark):
    feed = bindings.offers(spark, SF)
    lim = F.when(F.col("group_title") == "en", 10).otherwise(5)
    p = plan(top_n_per_key(feed, ["group_title", "url_idx"], ["pos"], lim, 10))
    assert "WindowGroupLimit" in p


def test_anti_joins_are_equi_joins(spark):
    p = plan(Q.QUERIES["dedup_content"](spark, SF)) + plan(Q.QUERIES["dedup_url"](spark, SF))
    assert "LeftAnti" in p and "NestedLoop" not in p and "CartesianProduct" not in p


def test_native_extractors_stay_in_jvm(spark):
    pages = bindings.md_card_pages(spark, SF)
    p = plan(X.extract_markdown_source(pages)) + plan(spark.read.parquet(f"{SF}/pages.parquet").select(
        X.strip_elements("html"), X.squeeze_newlines("html")))
    assert not any(n in p for n in PYTHON_NODES)


def test_scan_prunes_columns(spark):
    known = plan(dedup.known_records(bindings.sheets(spark, SF)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in known


def exchanges(df):
    """(partitioning, output names) of every shuffle in the plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            names = node.output()
            out.append((node.outputPartitioning().toString(), [names.apply(i).name() for i in range(names.size())]))
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


@pytest.fixture
def no_broadcast(spark):
    """Plans as for sides too large to broadcast, and static, so that they can be read."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_html_meets_no_exchange(spark, no_broadcast):
    from listledger.plans import jobs

    watch, pages = bindings.card_watch(spark, SF)
    found = exchanges(jobs.watched_listings(watch, pages))
    assert found and all("html" not in names and "md" not in names for _, names in found)


def test_content_join_ships_hashes(spark, no_broadcast):
    recs = bindings.offers(spark, SF)
    found = exchanges(dedup.drop_known_content(bindings.offers(spark, SF), dedup.known_records(
        recs.select("title", "company", "tags", F.lit("").alias("link")))))
    known_side = [p for p, names in found if names == ["_h"]]
    assert known_side and all("_h" in p for p, _ in found)


def test_dedup_rounds_use_partial_aggregation(spark, monkeypatch):
    """The tables that the rounds write are planned with partial minima and equi joins."""
    plans, real = [], dedup.materialize

    def watched(df, name):
        plans.append(plan(df))
        return real(df, name)

    monkeypatch.setattr(dedup, "materialize", watched)
    dedup.dedup_ordered(bindings.offers(spark, SF), ("group_idx", "url_idx", "pos")).count()
    assert len(plans) >= 3 and "partial_min" in plans[0] and "partial_min" in plans[1]
    assert not any("NestedLoop" in p or "SinglePartition" in p for p in plans)

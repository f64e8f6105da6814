"""E2 (Markdown), E8/E9/E12 (cards), E15/E16 (rejects) on literal HTML."""

from pyspark.sql import functions as F

from listledger.functions import cards as C
from listledger.functions.markdown import html_to_markdown


def test_markdown_basics():
    assert html_to_markdown("<h1>Title</h1><p>Hello <b>world</b></p>") == "# Title\n\nHello **world**"
    assert html_to_markdown("<ul><li>a</li><li>b</li></ul>") == "* a\n* b"
    assert html_to_markdown('<p>see <a href="/x">Link</a></p>') == "see [Link](/x)"
    assert html_to_markdown("<p>a_b*c</p>") == r"a\_b\*c"
    assert html_to_markdown("<p>x</p><hr><p>y</p>") == "x\n\n---\n\ny"
    assert html_to_markdown("<h3>  Many   spaces </h3>") == "### Many spaces"
    assert html_to_markdown("<p>a<br>b</p>") == "a  \nb"
    assert html_to_markdown('<a href="https://x.y">https://x.y</a>') == "<https://x.y>"


def test_markdown_unclosed_tags():
    md = html_to_markdown("<article><h1>T</h1><p><b>bold<br>next<p>more</article><p>after")
    assert md.startswith("# T")
    assert "after" in md


def test_class_cards():
    html = """<div><a class="posting-list-item x" href="/pl/job/dev-1"><h3 class="posting-title__position a">
      Dev &amp; Ops <span>NEW</span></h3><h4 class="company-name"> Acme </h4>
      <nfj-posting-item-tiles><span class="posting-tag">A</span><span class="posting-tag">B</span>
      </nfj-posting-item-tiles><p><b>open</a>
      <a class="posting-list-item"><h3 class="posting-title__position">No link</h3></a></div>"""
    got = list(C.extract_cards(html, C.SOURCE_B))
    assert got[0] == (0, "/pl/job/dev-1", "Dev & OpsNEW", "Acme", ["A", "B"], None)
    assert got[1][1] is None and got[1][3] == "Unknown"


def test_attr_cards_need_container():
    card = ('<a data-test="list-item-offer" href="/o/1?x=2"><h2 id="offer-title">T</h2>'
            '<span data-test="chip-expectedTechnology">A</span><span data-test="chip-expectedTechnology">B</span></a>')
    assert list(C.extract_cards(card, C.SOURCE_C)) == []
    got = list(C.extract_cards(f'<div id="main-offers-listing">{card}</div>{card}', C.SOURCE_C))
    assert got == [(0, "/o/1?x=2", "T", "Unknown", ["A", "B"], None)]


def test_rejects(spark):
    from listledger.operators import extract as X

    df = spark.createDataFrame([(1, "u1", None), (2, "u2", "<div id='main-offers-listing'></div>")],
                               "page_id long, url string, html string")
    rows = X.html_card_rows(df, C.SOURCE_C)
    rej = X.extract_rejects(rows).collect()
    assert [(r.page_id, r.kind) for r in rej] == [(1, "page")]
    assert X.extract_html_source(df, C.SOURCE_C).count() == 0


def test_registry_routes_like_the_reference(spark):
    from pyspark.sql import functions as F

    from listledger.plans.registry import default_registry

    r = default_registry()
    df = spark.createDataFrame([("https://nofluffjobs.com/pl/x",), ("https://theprotocol.it/filtry/a",),
                                ("https://justjoin.it/x",), ("https://other.example/",)], "url string")
    got = [(x.s, x.l) for x in df.select(r.source_of(F.col("url")).alias("s")).select(
        "s", r.limit_of(F.col("s")).alias("l")).collect()]
    assert got == [("B", 50), ("C", 30), ("A", 50), ("A", 50)]
    assert r.max_limit() == 50


def test_card_udtf_in_sql(spark):
    from listledger.plans.registry import register_card_udtf

    register_card_udtf(spark)
    spark.createDataFrame([(1, '<div id="main-offers-listing"><a data-test="list-item-offer" href="/o/1">'
                               '<h2 id="offer-title">T</h2></a></div>')], "page_id long, html string") \
        .createOrReplaceTempView("udtf_pages")
    got = spark.sql("SELECT p.page_id, c.title, c.href FROM udtf_pages p, "
                    "LATERAL extract_cards(p.html, 'C') c").collect()
    assert [tuple(x) for x in got] == [(1, "T", "/o/1")]


def test_fast_tokenizer_equals_html_parser(monkeypatch):
    """The single-pass tokenizer gives the tree html.parser gives (checked on
    the driver's pages and rendered cards; here on the awkward cases)."""
    from listledger.functions import htmltree as H
    from listledger.functions import markdown as M

    docs = [
        '<!DOCTYPE html><html><head><script>var t="</p>";</script><style>p{}</style></head>'
        '<body><!-- c --><p><b>x &amp; y<br/>z<p>q</body></html>',
        "<div a=1 b='2' c=\"3 > 4\" d>t<img src=x>u</DIV>tail < not a tag",
        "<ul><li>a<li>b</ul></p></span>text",
    ]
    for d in docs:
        assert M._render(H.parse(d)) == M._render(H.parse_stdlib(d))
        for src in (C.SOURCE_B, C.SOURCE_C):
            fast = list(C.extract_cards(d, src))
            with monkeypatch.context() as m:
                m.setattr(C, "parse", H.parse_stdlib)
                assert list(C.extract_cards(d, src)) == fast


def test_registry_extraction_equals_builtin_routing(spark):
    from listledger.plans import jobs
    from listledger.plans.registry import default_registry
    from listledger.sources import bindings
    from listledger.sources.watchlist import watch_pages

    watch, pages = bindings.card_watch(spark, "/root/testdata/sf0.001")
    wp = watch_pages(watch, pages)
    cols = ["group_idx", "url_idx", "pos", "source", "title", "company", "tags", "full_url", "row_limit"]
    a = sorted(map(tuple, jobs.extract_listings(wp).select(cols).collect()))
    b = sorted(map(tuple, jobs.extract_listings_with(default_registry(), wp).select(cols).collect()))
    assert a == b and len(a) > 0
    # a URL watched by two groups gives its listings to both groups
    twice = watch.unionByName(watch.where("url_idx < 1000000").withColumn("group_idx", F.col("group_idx") + 100))
    n1 = jobs.extract_listings(watch_pages(watch, pages)).count()
    n2 = jobs.extract_listings(watch_pages(twice, pages)).count()
    assert n2 > n1


def test_page_files_keep_the_last_page_of_a_key(spark, tmp_path):
    from listledger.plans.jobs import write_page_files

    long = "https://h.example/" + "x" * 120
    rows = [(3, "https://a.example/p?q=1", "first"), (9, "http://a.example/p_q=1", "second\nline<script>x</script>"), (5, "https://a.example/p?q=1", "between"),
            (1, "https://b.example/", ""), (2, "https://c.example/", None), (4, None, "no key"), (6, long + "1", "a"), (7, long + "2", "b"), (8, "", "no key")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_key"]: r["clean_html"] for r in write_page_files(pages, str(tmp_path / "out")).collect()}
    assert got == {"a.example_p_q_1": "second\nline", "b.example_": "", "c.example_": "", long[8:108].replace("/", "_"): "b"}
    assert all(len(list(d.glob("*.txt"))) == 1 for d in (tmp_path / "out").glob("page_key=*"))
    assert write_page_files(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_extractors_hand_out_small_parts_of_a_large_batch():
    import pyarrow as pa

    from listledger.functions.cards import SOURCE_B
    from listledger.operators import extract as X

    card = '<a class="posting-list-item" href="/pl/job/x"><h3 class="posting-title__position">t</h3></a>'
    pages = [card * (k % 20) for k in range(3000)] + [None]
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(3001)), "url": ["u"] * 3001, "html": pages, "kept": [str(k) for k in range(3001)]})
    parts = list(X._card_rows({None: SOURCE_B}, ["kept"])(iter([batch])))
    assert max(p.num_rows for p in parts) <= X.CARDS_AT_ONCE
    rows = pa.Table.from_batches(parts).to_pylist()
    assert len(rows) == sum(k % 20 for k in range(3000)) + 1
    assert all(r["kept"] == str(r["page_id"]) and r["raw_title"] == "t" for r in rows[:-1])
    assert (rows[-1]["kind"], rows[-1]["error"]) == ("page", "ValueError: page has no content")
    md = list(X._markdown_slices(iter([batch.column("html")])))
    assert max(map(len, md)) <= X.PAGES_AT_ONCE and sum(map(len, md)) == 3001


def test_page_files_are_dealt_to_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from listledger.plans import jobs

    monkeypatch.setattr(jobs, "FILES_PER_TASK", 10, raising=False)
    pages = spark.range(60).selectExpr("id as page_id", "concat('https://a.example/', id) as url", "concat('<p>', id, '</p>') as html").coalesce(1)
    assert jobs.write_page_files(pages, str(tmp_path / "out")).count() == 60
    names = [f.name for f in (tmp_path / "out").glob("page_key=*/part-*")]
    assert len(names) == 60 and len({n.split("-")[1] for n in names}) > 3  # the number of the task that wrote the file


def test_watched_pages_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    from pyspark.sql import functions as F

    from listledger.plans import jobs

    monkeypatch.setattr(jobs, "PAGES_PER_TASK", 10, raising=False)
    seen = []
    extract = jobs.extract_listings
    monkeypatch.setattr(jobs, "extract_listings", lambda pages: seen.append(pages) or extract(pages))
    card = '<a class="posting-list-item" href="/pl/job/x"><h3 class="posting-title__position">t</h3></a>'
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.format_string("https://nofluffjobs.com/pl/%d", "id").alias("url"), F.lit(card).alias("html")).coalesce(1)
    watch = pages.select("url", F.lit(1).alias("group_idx"))
    assert jobs.watched_listings(watch, pages).count() == 200
    held = [r["n"] for r in seen[0].groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(held) == 200 and max(held) <= 40

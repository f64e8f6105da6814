"""The reference's quirks on literal rows (FIXTURES.md section 5)."""

from pyspark.sql import functions as F

from listledger.functions.text import derive_title, is_polish_title, url_query_value
from listledger.operators import dedup, filters, ledger as L
from listledger.operators import extract as X


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_derive_title(spark):
    cases = {
        "https://justjoin.it/job-offers/krakow?keyword=junior&sort=newest&orderBy=DESC&sortBy=newest":
            "justjoin-krakow-kw-junior",
        "https://justjoin.it/job-offers/krakow?experience-level=junior&orderBy=DESC&sortBy=newest":
            "justjoin-krakow-exp-junior",
        "https://nofluffjobs.com/pl/krakow?lang=en&criteria=seniority%3Djunior&sort=newest":
            "nofluffjobs-krakow-junior",
        "https://theprotocol.it/filtry/junior;p/krakow;wp?sort=date": "theprotocol-junior-krakow",
        "https://theprotocol.it/filtry/krakow;wp?kw=italian": "theprotocol-krakow-kw-italian",
        "https://m.ththth.example.net/en/25#top": "m--en-25",
        "https://www.justjoin.it/job-offers/all-locations/java?keyword=a+b": "justjoin-java-kw-ab",
    }
    df = one_col(spark, list(cases), "url").select("url", derive_title("url").alias("t"))
    got = {r.url: r.t for r in df.collect()}
    assert got == cases


def test_query_value_python_rules(spark):
    df = one_col(spark, ["https://a.b/?k=&k=x", "https://a.b/?k", "https://a.b/?k=a%3Db+c", "https://a.b/"], "url")
    got = [r[0] for r in df.select(url_query_value("url", "k")).collect()]
    assert got == ["x", "", "a=b c", ""]


def test_polish_filter(spark):
    cases = {"Kraków Developer": False, "Inżynier": True, "Starszy Analyst": True, "programistka": False,
             "ds. x": False, "ds.x": True, "Senior praca zdalna": True, "Analityk": True}
    df = one_col(spark, list(cases), "title").select("title", is_polish_title("title").alias("p"))
    assert {r.title: r.p for r in df.collect()} == cases


def test_recent_filter(spark):
    cases = ["New", "20d left", "19d left", "left", "1w ago", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, posted_age string")
    kept = sorted(r.i for r in filters.keep_recent(df).collect())
    assert kept == [0, 1, 3, 4, 5]


def test_card_lines_and_fallback(spark):
    blocks = [
        "10 EUR/h\n---\nAcme\nKrakow\nNew York\n3d left\nPython\n1-click Apply\nKrakow\nPython",
        "Only a salary line\nand more",
    ]
    df = spark.createDataFrame([(1, "u", i, "T", b, "s") for i, b in enumerate(blocks)],
                               "page_id long, url string, pos int, title string, block string, link_slug string")
    out = {r.pos: r for r in X.md_card_fields(df).collect()}
    a = out[0]
    assert (a.salary, a.company, a.location, a.posted_age) == ("10 EUR/h", "Acme", "Krakow", "3d left")
    assert a.tags == "Python, Python"
    b = out[1]
    assert (b.salary, b.company, b.location, b.posted_age, b.tags) == (
        "Only a salary line", "Unknown", "Unknown", "Unknown", "")


def test_new_york_is_an_age(spark):
    df = spark.createDataFrame([(1, "u", 0, "T", "s\n---\nAcme\nKrakow\n2d left\nNew York", "x")],
                               "page_id long, url string, pos int, title string, block string, link_slug string")
    assert X.md_card_fields(df).collect()[0].posted_age == "New York"


def test_md_card_without_link_swallows_next(spark):
    md = "### A\nx\n---\nc1\n\n### B\ny\n---\nc2\n](/job-offer/b-1)\n"
    df = spark.createDataFrame([(1, "u", md)], "page_id long, url string, md string")
    got = X.md_cards(df).collect()
    assert [(r.title, r.link_slug) for r in got] == [("A", "b-1")]


def test_title_badge(spark):
    df = one_col(spark, ["NEWS Editor NEW"], "t")
    assert df.select(X.clean_badge("t")).collect()[0][0] == "S Editor"


def test_known_urls_cells(spark):
    cells = ['=HYPERLINK("https://a/b?q=1","L")', " https://a/b?q=1 ", "see https://a/b", "http no link"]
    df = spark.createDataFrame([("s", 1, c, "", "", "", "") for c in cells],
                               "sheet string, pos long, title string, company string, tags string, status string, "
                               "link string")
    got = sorted(r.url for r in dedup.known_urls(df).collect())
    assert got == sorted(["https://a/b?q=1", "https://a/b", "see https://a/b"])


def test_dedup_ordered_literal(spark):
    df = spark.createDataFrame([(1, "u1", "c1"), (2, "u2", "c1"), (3, "u2", "c2")],
                               "rk int, full_url string, title string").withColumn("company", F.lit("")) \
        .withColumn("tags", F.lit(""))
    assert sorted(r.rk for r in dedup.dedup_ordered(df, ["rk"]).collect()) == [1, 3]
    assert sorted(r.rk for r in dedup.dedup_ordered_naive(df, ["rk"]).collect()) == [1]


def test_discard_equality_and_bucket_substring(spark):
    st = [" out ", "about", "OUTDATED", "save, cvsent", "DISCARD", None, "saved"]
    df = spark.createDataFrame([("S", i, "t", "", "", s, "") for i, s in enumerate(st)],
                               "sheet string, pos long, title string, company string, tags string, status string, "
                               "link string")
    kept, moved = L.split_discards(df)
    assert sorted(r.pos for r in moved.collect()) == [0, 4]
    b = {r.pos: r.b for r in df.select("pos", L.status_bucket("status").alias("b")).collect()}
    assert b == {0: 3, 1: 3, 2: 3, 3: 0, 4: 2, 5: 2, 6: 1}


def test_migrate_rows(spark):
    df = spark.createDataFrame([
        ("S", 1, ["Title", "Company", "Link"], ['=HYPERLINK("https://a","Dev")', "Acme", "https://z"]),
        ("S", 2, ["Title", "Full URL", "Status"], ["Ops", "https://f", "NEW"]),
        ("S", 3, ["Name", "Link"], ["First cell", ""]),
    ], "sheet string, pos long, header array<string>, cells array<string>")
    got = {r.pos: (r.title, r.link, r.status, r.company) for r in L.migrate_rows(df).collect()}
    assert got[1] == ("Dev", "https://a", "", "Acme")
    assert got[2] == ("Ops", "https://f", "NEW", "")
    assert got[3] == ("First cell", "", "", "")


def test_sections_watchlist(spark, tmp_path):
    from listledger.sources.watchlist import read_sections, read_watchlist

    f = tmp_path / "links"
    f.write_text("# comment\nu0\n[A]\nu1\n\n[B]\n[A]\n  u2  \n")
    got = sorted((r.group_idx, r.group_title, r.url_idx, r.url) for r in read_sections(spark, str(f)).collect())
    assert got == [(0, None, 0, "u0"), (1, "A", 0, "u1"), (2, "A", 0, "u2")]
    # fallback: JSON missing -> sections; invalid JSON -> nothing
    assert read_watchlist(spark, str(tmp_path / "none.json"), str(f)).count() == 3
    bad = tmp_path / "bad.json"
    bad.write_text("[{not json")
    assert read_watchlist(spark, str(bad), str(f)).count() == 0
    good = tmp_path / "links.json"
    good.write_text('[{"title": "Junior", "urls": ["a", "b"]}, {"title": null, "urls": ["c"]}]')
    got = sorted(tuple(r) for r in read_watchlist(spark, str(good)).collect())
    assert got == [(0, "Junior", 0, "a"), (0, "Junior", 1, "b"), (1, None, 0, "c")]


def test_prepend_then_rebucket_equals_fused_rewrite(spark):
    from listledger.plans import jobs
    from listledger.sources import bindings

    sf = "/root/testdata/sf0.001"
    run = jobs.offers_run(spark, sf)
    ledger = jobs.offers_ledger(spark, sf)
    rows = L.to_ledger_rows(run.new, sheet_col="group_title", order=jobs.RUN_ORDER)
    stepwise = L.status_order(L.prepend(ledger, rows))
    fused = L.reorganize(ledger, bindings.offers(spark, sf).select(F.col("group_title").alias("sheet")), rows)
    cols = ["sheet", "pos", "title", "status", "link"]
    assert sorted(map(tuple, stepwise.select(cols).collect())) == sorted(map(tuple, fused.select(cols).collect()))


def test_discards_then_rebucket_equals_fused_organize(spark):
    from listledger.sources import bindings

    sheets = bindings.sheets(spark, "/root/testdata/sf0.001")
    stepwise = L.status_order(L.process_discards(sheets))
    fused = L.reorganize(sheets)
    cols = ["sheet", "pos", "title", "status", "link"]
    assert sorted(map(tuple, stepwise.select(cols).collect())) == sorted(map(tuple, fused.select(cols).collect()))


def test_urls_that_the_jvm_parser_refuses(spark):
    """R4, R5 by pattern: blanks, pipes, brackets and broken escapes are no reason to lose a name."""
    from listledger.operators.routing import derive_title, url_param

    rows = [
        ("https://justjoin.it/job-offers/krakow?keyword=data|ai", "justjoin-krakow-kw-dataai", "data|ai"),
        ("https://justjoin.it/job-offers/krakow?keyword=data ai", "justjoin-krakow-kw-dataai", "data ai"),
        ("https://justjoin.it/job-offers/krakow?keyword=%zz%20x", None, "%zz x"),
        ("https://justjoin.it/job-offers/krakow?keyword=[x]&keyword=y", None, "[x]"),
        ("https://justjoin.it/job-offers/krakow?keyword=&x=1", "justjoin-krakow", ""),
        ("no url at all", "no url at all", ""),
        (None, None, ""),
    ]
    df = spark.createDataFrame([(k, u) for k, (u, _, _) in enumerate(rows)], "k int, url string")
    got = {r["k"]: r for r in df.select("k", derive_title("url").alias("t"), url_param("url", "keyword").alias("q")).collect()}
    for k, (_, title, value) in enumerate(rows):
        assert got[k]["q"] == value
        if title is not None and title != "no url at all":
            assert got[k]["t"] == title


def test_attributes_as_the_standard_parser_reads_them():
    from listledger.functions.htmltree import parse, parse_stdlib

    def shape(n):
        return [(c.tag, c.attrs, shape(c)) if not isinstance(c, str) else c for c in n.children]

    for html in ("<a href=/pl/job/dev/>x</a>", "<a href='1' href='2'>x</a>", "<br/>y", "<a b />z", '<a href="q"/>r', "<p class=a/ id=b>t"):
        assert shape(parse(html)) == shape(parse_stdlib(html)), html


def test_deeply_nested_page_is_rendered(spark):
    from listledger.operators import extract as X

    pages = spark.createDataFrame([(1, "u", "<p>x" * 10_000), (2, "v", None), (3, "w", "<h1>ok</h1>")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in X.markdown_rows(pages).collect()}
    assert got[1]["error"] is None and "x" in got[1]["md"]
    assert got[2]["error"] == "ValueError: page has no content" and got[3]["md"] == "# ok"
    assert X.extract_source_a(pages).count() == 0


def _listings(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "group_idx long, group_title string, url_idx long, pos long, full_url string, title string").select(
        "*", F.lit("").alias("company"), F.lit("").alias("tags"))


def test_groups_keep_watchlist_order_and_stay_apart(spark):
    """An earlier group wins whatever its title, and groups with one title stay two."""
    from listledger.plans.jobs import run_listings
    from listledger.sources.ledger import empty_ledger

    both = [("https://x.example/1", "one")]
    rows = [(0, "Junior", 0, 0, *both[0]), (1, "Italian", 0, 0, *both[0])]
    rows += [(g, "A", 0, k, f"https://x.example/{g}-{k}", f"t{g}-{k}") for g in (2, 3) for k in range(40)]
    rows += [(3, "A", 0, 40, "https://x.example/2-0", "t2-0")]
    groups = spark.createDataFrame([(0, "Junior"), (1, "Italian"), (2, "A"), (3, "A"), (4, "Empty")], "group_idx long, group_title string")
    res = run_listings(_listings(spark, rows), empty_ledger(spark), groups)
    assert {r["group_idx"]: (r["new_offers"], r["total_candidates"]) for r in res.summary.collect()} == {
        0: (1, 1), 1: (0, 1), 2: (40, 40), 3: (40, 41), 4: (0, 0)}
    top = res.ledger.where("sheet = 'A'").orderBy("pos").first()
    assert top["title"] == "t3-0"  # the later group's rows stand on top


def test_run_migrates_tables_that_get_rows(spark):
    from listledger.plans.jobs import run_listings

    old = [(s, 1, '=HYPERLINK("https://h.example/9?q=1","Old job")', "c", "", "NEW", "") for s in ("Junior", "Other")]
    ledger = spark.createDataFrame(old, "sheet string, pos long, title string, company string, tags string, status string, link string")
    groups = spark.createDataFrame([(0, "Junior"), (1, "Other")], "group_idx long, group_title string")
    res = run_listings(_listings(spark, [(0, "Junior", 0, 0, "https://x.example/1", "new")]), ledger, groups)
    got = {(r["sheet"], r["title"], r["link"]) for r in res.ledger.collect()}
    assert got == {("Junior", "new", "https://x.example/1"), ("Junior", "Old job", "https://h.example/9?q=1"), ("Other", old[1][2], "")}


def test_stream_builds_on_versions_of_others(spark, tmp_path):
    """A version written in between loses nothing; a second call with the same checkpoint adds nothing."""
    from listledger.plans.jobs import organize_only
    from listledger.sources.ledger import LedgerStore, empty_ledger
    from listledger.sources.watchlist import empty_watch
    from listledger.streaming.incremental import run_incremental, write_batches

    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.write(empty_ledger(spark))
    store.write(organize_only(store.current(), empty_watch(spark)))
    args = (spark, str(tmp_path / "in"), store, str(tmp_path / "out"), str(tmp_path / "ck"))
    write_batches(_listings(spark, [(0, "A", 0, 0, "https://x.example/1", "one")]).selectExpr("*", "1 _b"), "_b", str(tmp_path / "in"))
    run_incremental(*args)
    assert [r["title"] for r in store.current().collect()] == ["one"]
    run_incremental(*args)
    assert store.current_version() == 2
    day2 = _listings(spark, [(0, "A", 0, 1, "https://x.example/2", "two"), (0, "A", 0, 2, "https://x.example/1", "three")])
    day2.coalesce(1).write.parquet(str(tmp_path / "more"))
    for f in (tmp_path / "more").glob("*.parquet"):
        (tmp_path / "in" / "c000000.parquet").write_bytes(f.read_bytes())
    run_incremental(*args)
    assert sorted(r["title"] for r in store.current().collect()) == ["one", "two"]


def test_watchlist_keeps_groups_without_urls(spark, tmp_path):
    from listledger.sources.watchlist import read_json

    (tmp_path / "w.json").write_text('[{"title": "A", "urls": ["u"]}, {"title": "Empty", "urls": []}, {"title": "None"}]')
    got = [tuple(r) for r in read_json(spark, str(tmp_path / "w.json")).orderBy("group_idx").collect()]
    assert got == [(0, "A", 0, "u"), (1, "Empty", None, None), (2, "None", None, None)]


def test_elements_are_dropped_as_a_tree_would(spark):
    from listledger.operators import extract as X

    rows = [
        ("a<script>x</script>b", "ab"), ("a<script>x", "a"), ("a<STYLE type=t>x</style >b", "ab"), ("a<!-- <script> -->b<script>y</script>c", "a<!-- <script> -->bc"),
        ("a<noscript>x", "a<noscript>x"), ("a<noscript>x</noscript>b", "ab"), (None, None),
    ]
    df = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(rows)], "k int, html string")
    got = {r["k"]: r["c"] for r in df.select("k", X.strip_elements("html").alias("c")).collect()}
    assert [got[k] for k in range(len(rows))] == [c for _, c in rows]

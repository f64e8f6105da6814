"""Raw, header-driven ledgers in whole runs, against the rule row by row."""

import random

from listledger.operators import rawledger as R
from listledger.plans import jobs
from listledger.sources.ledger import RAW_SCHEMA, LedgerStore

BUCKETS = [("CVSENT", 0), ("SAVE", 1), ("OUT", 3)]


def bucket(status):
    return next((b for word, b in BUCKETS if word in status.strip().upper()), 2) if status is not None else 2


def status_of(header, row):
    at = header.index("Status") if "Status" in header else None
    return None if at is None or at >= len(row) else row[at]


def canonical(header, row):
    last = {h: i for i, h in enumerate(header)}
    get = lambda name: row[last[name]] if name in last and last[name] < len(row) else ""
    title = row[0] if "Title" not in last and row else get("Title")
    link, pieces = get("Link"), title.split('"')
    if "=HYPERLINK" in title and len(pieces) >= 4:
        title, link = pieces[3], pieces[1]
    return [title, get("Company"), get("Tags"), get("Status"), link or get("Full URL")]


def plain(tables, watched, new):
    """``tables``: sheet -> (header, rows); ``new``: sheet -> canonical rows. The steps one after the other."""
    tables = {s: (list(h), [list(r) for r in rows]) for s, (h, rows) in tables.items()}
    order = lambda s: (tables[s][0], sorted(tables[s][1], key=lambda r: bucket(status_of(tables[s][0], r)))) if "Status" in tables[s][0] else tables[s]
    had_trash = "Trash" in tables
    trash_header, trash_rows = tables.pop("Trash", (["Title", "Company", "Tags", "Status", "Link"], []))
    moved = []
    for s in sorted(tables):
        header, rows = tables[s]
        out = [r for r in rows if (status_of(header, r) or "").strip().upper() in ("DISCARD", "OUT")]
        if out:
            moved += [(header, r) for r in out]
            tables[s] = header, [r for r in rows if r not in out]
            tables[s] = order(s)
    named = lambda header: [(h, header[: i + 1].count(h)) for i, h in enumerate(header)]
    columns = named(trash_header)
    for header, _ in moved:
        columns += [c for c in named(header) if c not in columns]
    for header, row in moved:
        at = {c: i for i, c in enumerate(named(header))}
        trash_rows.append([row[at[c]] if c in at and at[c] < len(row) else "" for c in columns])
    if had_trash or moved:
        tables["Trash"] = [c for c, _ in columns], trash_rows
        tables["Trash"] = order("Trash")
    for s in watched:
        if s in new:
            header, rows = tables.get(s, ([], []))
            tables[s] = ["Title", "Company", "Tags", "Status", "Link"], new[s] + [canonical(header, r) for r in rows]
        if s in tables:
            tables[s] = order(s)
    return {s: (h, rows) for s, (h, rows) in tables.items() if rows}


def frame(spark, tables):
    rows = [(s, 7 * k + 3, h, r) for s, (h, rs) in tables.items() for k, r in enumerate(rs)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def read(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["sheet"], r["pos"])):
        header, rows = out.setdefault(r["sheet"], (list(r["header"]), []))
        assert header == list(r["header"])
        rows.append(list(r["cells"]))
    return out


def test_rewrite_equals_the_steps_one_by_one(spark):
    rng = random.Random(11)
    words = ["DISCARD", " out ", "CVSENT", "saved", "about", "", "NEW"]
    layouts = [
        ["Title", "Company", "Tags", "Status", "Link"], ["Status", "Title", "Note", "Company", "Status", "Link"], ["Name", "Link", "Salary"],
        ["Title", "Salary", "Company", "Location", "Tags", "Age", "Status", "Full URL"], ["Link", "Title", "Title", "Status", "Link"], ["Status"],
    ]
    tables = {}
    for k, name in enumerate(["a", "b", "c", "d", "e", "f", "g", "Trash"]):
        header, rows = layouts[k % len(layouts)], []
        for i in range(rng.randrange(1, 12)):
            row = [rng.choice(words) if h == "Status" else f'=HYPERLINK("http://x/{i}","t{i}")' if h == "Title" and i % 3 == 0 else f"{name}{h}{i}" for h in header]
            rows.append(row[: rng.randrange(1, len(row) + 1)] if i % 4 == 0 else row)
        tables[name] = header, rows
    new = {"b": [["n1", "c", "t", "NEW", "l1"], ["n2", "", "", "NEW", ""]], "c": [["n3", "c", "t", "NEW", "l3"]], "fresh": [["n4", "", "", "NEW", "l4"]]}
    watched = ["a", "b", "c", "fresh", "empty"]
    rows = [(s, *r, k) for s, rs in new.items() for k, r in enumerate(rs)]
    added = spark.createDataFrame(rows, "sheet string, title string, company string, tags string, status string, link string, _o0 long")
    names = spark.createDataFrame([(s,) for s in watched], "sheet string")
    ledger = frame(spark, tables)
    assert read(R.reorganize_raw(ledger, names, added)) == plain(tables, watched, new)
    assert read(R.reorganize_raw(ledger, names)) == plain(tables, watched, {})
    once = R.reorganize_raw(ledger, names)
    assert read(R.reorganize_raw(once, names)) == read(once)  # nothing more to move or sort
    kept = {r["pos"] for r in once.where("sheet = 'c'").collect()}
    assert kept == {r["pos"] for r in ledger.where("sheet = 'c'").collect()}  # no Status: rows, cells and positions stay


def test_raw_run_and_store(spark, tmp_path):
    header = ["Title", "Owner", "Company", "Tags", "Status", "Link"]
    tables = {"en": (header, [["old", "me", "c", "t", "OUT", "http://k/1"], ["kept", "you", "c2", "t2", "SAVE", "http://k/2"]]), "other": (["Link", "Kept"], [["http://k/3", "x"]])}
    store = LedgerStore(spark, str(tmp_path / "raw"), RAW_SCHEMA)
    assert store.current().count() == 0
    store.write(frame(spark, tables))
    offers = [(0, "en", 0, 0, "http://k/1", "again", "z", "z"), (0, "en", 0, 1, "http://k/3", "again", "y", "y"), (0, "en", 0, 2, "http://n/1", "kept", "c2", "t2"), (0, "en", 0, 3, "http://n/2", "new", "c", "t")]
    listings = spark.createDataFrame(offers, "group_idx long, group_title string, url_idx long, pos long, full_url string, title string, company string, tags string")
    run = jobs.run_listings(listings, store.current(), listings.select("group_idx", "group_title").distinct())
    store.write(run.ledger, changed=run.touched)
    assert read(store.current()) == {
        "en": (["Title", "Company", "Tags", "Status", "Link"], [["kept", "c2", "t2", "SAVE", "http://k/2"], ["new", "c", "t", "NEW", "http://n/2"]]),
        "other": tables["other"],
        "Trash": (["Title", "Company", "Tags", "Status", "Link", "Owner"], [["old", "c", "t", "OUT", "http://k/1", "me"]]),
    }
    assert run.ledger.sparkSession is not None and store.current_version() == 1


def test_an_empty_raw_ledger(spark):
    none = spark.createDataFrame([], RAW_SCHEMA)
    assert R.reorganize_raw(none).count() == 0

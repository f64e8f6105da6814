"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from listledger.llm import bpe, chat, components, decontam, ngram, pii, quality, secrets, simhash, toxicity, trees, urlfilter
from listledger.llm.queries import tokenizer_path

ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"), (None, None), (5, "long " * 40_000), (6, "\x00 é 中 \U0001f600 \x1c")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns whose names an operator might use itself."""
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    clash = ("fp", "chunk", "kind", "score", "ids", "label", "e", "stratum", "u", "least", "root", "_keep", "_id", "_evidence", "secrets", "spans", "n", "bucket", "id")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), *(F.lit("x").alias(c) for c in clash))


def test_simhash(spark, odd):
    got = simhash.near_duplicates(odd)
    rows = got.collect()
    assert len(rows) == len(ROWS) and got.columns == ["doc_id", "fingerprint", "component_id"]
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0 and simhash.keep_first(odd.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (None, "other words here"), (7, "third text now")], "doc_id bigint, text string")
    assert sorted(r["text"] for r in simhash.keep_first(alone).collect()) == ["other words here", "third text now", "x y z"]


@pytest.mark.parametrize("leaves", [1, 7, 100])
def test_trie_walk_equals_all_pairs(spark, leaves):
    rng = np.random.default_rng(leaves)
    seeds = rng.integers(0, 2**64, 30, dtype=np.uint64)
    prints = {int(s) for s in seeds}
    for s in seeds:  # dense balls: chains of near fingerprints
        x = int(s)
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(p)
    got = {}
    for r in components.components(simhash.near_links(df, 2, leaves)).collect():
        got.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1400)}}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_bpe_round_trip(spark, odd):
    path = tokenizer_path()
    coded = bpe.encode(odd, path)
    assert set(coded.columns) == set(odd.columns)
    back = bpe.decode(coded.drop("text"), path, text="text").select("doc_id", "text").collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(str((i, t or "")) for i, t in ROWS)


def test_bpe_streams_long_pieces():
    from tokenizers import Tokenizer

    model, t = bpe.BpeModel(bpe.read_model(tokenizer_path())), Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    for parts in (list("etaoinshr"), ["th", "he", "ing", "er", "e"], ["a"], [" "], ["é", "ß"]):
        text = "".join(rng.choices(parts, k=9000))
        run, out = bpe.Transducer(model, block=64), []
        for k in range(0, len(text), 777):
            out += run.feed(text[k : k + 777].encode())
            assert len(run.held) <= model.lookahead + 64 + 128
        whole = t.encode(text, add_special_tokens=False).ids
        if all(p.isalpha() for p in parts):
            assert out + run.finish() == whole
        assert np.frombuffer(bpe.Encoder(model, window=500).encode(text), "<u4").tolist() == whole


def test_bpe_odd_characters():
    from tokenizers import Tokenizer

    model, t, rng = bpe.BpeModel(bpe.read_model(tokenizer_path())), Tokenizer.from_file(tokenizer_path()), random.Random(5)
    parts = ["a", "the ", "  ", "\n", "\t", "é", "<|endoftext|>", "\x1c", "\x85", "\u200b", "\u3000", "²", "Ⅷ", "'s", "'LL", "!!", "中", "\U0001f600", "\x00", "\u0300", "\xa0"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        ids = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bpe.Encoder(model, window=rng.choice([4, 9, 99])).encode(text), "<u4").tolist() == ids
        noise = np.array(rng.choices(range(50257), k=6), "<u4")
        assert bpe.Decoder(model, block=2).decode(noise.tobytes()) == t.decode(noise.tolist(), skip_special_tokens=False)


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        new = [i]
        for j in range(1, len(t) + 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p[i - 1] != t[j - 1])))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [" ".join(word() for _ in range(rng.randint(12, 40))) for _ in range(8)]
    docs = []
    for k in range(60):
        body = [word() for _ in range(rng.randint(0, 60))]
        if k % 2:
            hit = list(rng.choice(items))
            for _ in range(rng.randint(0, int(0.12 * len(hit)))):
                at = rng.randrange(len(hit))
                hit[at : at + 1] = rng.choice(["", "x", hit[at] + "y"])
            body.insert(rng.randint(0, len(body)), "".join(hit))
        docs.append((k, "  ".join(body).replace("a", "A")))
    df = spark.createDataFrame([*docs, (None, items[0]), (99, None), (98, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([*enumerate(items), (50, items[0].upper()), (51, None), (52, "short")], "item_id bigint, text string")
    want = set()
    for i, t in [*docs, (None, items[0])]:
        for k, item in enumerate(items):
            d = edit_distance(item, decontam.normal(t))
            if d <= int(0.08 * len(item)):
                want.add((i, k, d))
    assert len({d for _, _, d in want}) > 3
    for block in (1 << 20, 400):  # in one block, and in several
        got = decontam.matches(df, bench, block=block)
        assert {tuple(r) for r in got.collect()} == want
        left = decontam.clean(df, bench, block=block)
        assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i in [*(k for k, _ in docs), None, 99, 98] if i not in {w[0] for w in want})
    assert decontam.matches(df, bench.limit(0)).count() == 0 and decontam.clean(df.limit(0), bench).count() == 0


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 0), (4, 0), (None, 1), (6, None)], "doc_id bigint, toxic int")
    model = toxicity.train(odd, labels)
    out = toxicity.score(odd, model)
    assert set(out.columns) == set(odd.columns)
    assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.count() == len(ROWS)
    bare = toxicity.train(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, bare).collect()} == {0.5}
    assert toxicity.score(odd.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def toxic_model(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    from listledger.llm.common import fold

    return docs, labels, toxicity.train(docs, labels.where(fold("doc_id", 5) != 0)), fold


def test_toxicity_held_out(toxic_model):
    docs, labels, model, fold = toxic_model
    held = toxicity.score(docs, model).join(labels, "doc_id").where(fold("doc_id", 5) == 0).select("score", "toxic").collect()
    hits = sum(r["score"] >= 0.5 and r["toxic"] == 1 for r in held)
    assert hits / sum(r["score"] >= 0.5 for r in held) > 0.9 and hits / sum(r["toxic"] == 1 for r in held) > 0.85


def test_deobfuscation(toxic_model):
    model = toxic_model[2]
    for token, word in {"1d10t": "idiot", "stuuuupid": "stupid", "s.t.u.p.i.d": "stupid", "$tup1d": "stupid", "m0r0n": "moron", "tr@sh": "trash", "scuuum": "scum", "the": "the", "theé,": "theé"}.items():
        assert word in toxicity.restore(token, model.chars), token
    scorer = toxicity.Scorer(model)
    assert scorer.row("you l o s e r, 1d10t")[0] > 4 > scorer.row("the and of")[0] == 0
    assert scorer.row(None) == scorer.row("") == (0.0, 0.0, 0.0, 0.0)


def test_secrets(spark, odd):
    model = secrets.train(odd.limit(0))
    assert secrets.scan(odd, model).count() == len(ROWS) and secrets.redact(odd, model).columns == odd.columns
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = secrets.train(docs)
    known = re.compile(r"AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}|(?<=TOKEN = \")[0-9A-F]{40}")
    want, got = {}, {}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, t in texts.items():
        want[i] = {m.span() for m in known.finditer(t)}
    for r in secrets.scan(docs, model).collect():
        got[r["doc_id"]] = {(s["start"], s["end"]) for s in r["secrets"]}
    assert got == want
    text = "commit = 3f786850e387550fdab836ed7e6dc881de23001b see /usr/local/lib/python3/dist-packages and token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\""
    spans = secrets.secrets_of(text, model)[1]
    assert [text[a:b] for a, b in spans if "9f86" in text[a:b]] and not any("dist-packages" in text[a:b] for a, b in spans)
    assert secrets.secrets_of(None, model) == (0, []) == secrets.secrets_of("", model)


def test_pii(spark, odd):
    model = pii.train(odd)
    assert pii.find(odd, model).count() == len(ROWS)
    text = "mail a.b@c.example.com, ip 10.1.2.3 not 10.1.2.999, card 4111 1111 1111 1111 call +1 (555) 123-4567"
    assert [(k, text[a:b]) for a, k, b in pii.base_spans(text)] == [
        ("email", "a.b@c.example.com"), ("ip", "10.1.2.3"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567"),
    ]
    assert pii.redact("x a@b.co y", [(2, "email", 8)]) == "x [EMAIL] y"
    rng = random.Random(1)
    for _ in range(3000):
        s = "".join(rng.choices(["a", "1", "@", ".", "-", "com", "@@", " ", "é", "+", "%"], k=rng.randint(0, 25)))
        assert pii.emails(s) == [m.span() for m in pii.EMAIL.finditer(s)]
    fixed = pii.PiiModel(trees.constant(1.0), {k: 0.5 for k in pii.KINDS})
    spelled = "write to jane (at) example (dot) org or 555 123 4567"
    base, spans = pii.spans_of(spelled, fixed)
    assert base == [] and [(k, spelled[a:b]) for a, k, b in spans] == [("email", "jane (at) example (dot) org"), ("phone", "555 123 4567")]
    assert pii.spans_of(None, fixed) == ([], [])


def test_calibration():
    p, y = np.linspace(1, 0, 400), np.array([1] * 150 + [0, 1] * 125)
    t = pii.calibrate(p, y, 0.9)
    assert t is not None and y[p >= t].mean() >= 0.9
    assert pii.calibrate(p, np.zeros(400, int), 0.9) is None


def test_exported_trees_equal_spark(spark):
    from pyspark.ml.classification import GBTClassifier

    rng = np.random.default_rng(0)
    x = rng.random((300, 3))
    rows = spark.createDataFrame([(v.tolist(), int(v[0] + v[1] > 1)) for v in x], "x array<double>, label int")
    own = trees.boosted_trees(rows, rounds=5).probability(x)
    ready = trees._ready(rows)
    want = [r["probability"][1] for r in GBTClassifier(maxIter=5, maxDepth=3, seed=7).fit(ready).transform(ready).collect()]
    assert np.allclose(own, want)


def test_binomial_bounds():
    # exact: with no failure in n trials the bound solves (1 - p) ** n = miss
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert quality.upper_bound(5, 5, 0.05) == 1.0
    for k, n in ((1, 30), (7, 200), (40, 1000)):
        assert quality.at_most(k, n, quality.upper_bound(k, n, 0.01)) == pytest.approx(0.01, rel=1e-6)


def test_quality_cutoffs(spark, odd):
    judged = quality.judge(odd, spark.createDataFrame([(4, 1), (4, None)], "doc_id bigint, quality int"))
    rows = judged.collect()
    assert len(rows) == len(ROWS) and all(not r["kept"] for r in rows)
    good = [("en", *([0.0] * 3), 5.0, -5.0, 0.0, 0.01, 0.0)] * 3000 + [("de", *([0.0] * 3), 5.0, -5.0, 0.0, 0.01, 0.0)] * 20
    good += [("en", 0.3, *([0.0] * 2), 5.0, -5.0, 0.0, 0.01, 0.0)] * 20
    df = spark.createDataFrame(good, "stratum string, " + ", ".join(f"{c} double" for c in quality.CUTOFFS))
    got = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality.cutoffs(df).collect()}
    assert not any(s == "de" for s, _ in got)  # twenty labels prove nothing
    assert got["en", "symbols"] == 0.02 or got["en", "symbols"] >= 0.01
    wrong, n = 20, 3020
    bound = quality.upper_bound(wrong, n, 0.05 / (2 * len(quality.CUTOFFS)))
    assert (got["en", "symbols"] < 0.3) == (bound <= 0.08 / len(quality.CUTOFFS))
    assert got["en", "dup_lines"] == 0.01


def test_urls(spark):
    rows = [
        (1, "HTTP://Example.COM/en/1?q#f"), (2, "https://www.example.com/en/x"), (3, "http://a.net/es/1"), (4, "http://net/fr/"), (5, "http://notnet/fr/"),
        (6, None), (7, "no scheme"), (8, "x://"), (9, "http://a.com"), (10, "http://a.com?x=/"), (11, "http://h.org/a//b\n/é/2024-01-02.html"), (1, "HTTP://Example.COM/en/1?q#f"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'x' host", "'y' segments", "'z' rule_verdict")
    got = [(r["page_id"], r["host"], r["path"], r["rule"]) for r in urlfilter.judge(df).orderBy("page_id").collect()]
    assert got == [
        (1, "example.com", "/en/1", "example.com/en/"), (1, "example.com", "/en/1", "example.com/en/"), (2, "www.example.com", "/en/x", "www.example.com/en/"),
        (3, "a.net", "/es/1", "net/es/"), (4, "net", "/fr/", "net/fr/"), (5, "notnet", "/fr/", None), (6, "", "", None), (7, "", "", None), (8, "", "", None),
        (9, "a.com", "", None), (10, "a.com", "", None), (11, "h.org", "/a//b\n/é/2024-01-02.html", None),
    ]
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_template_tree_by_hand(spark):
    rows = [("h", f"/shop/{k}", "block") for k in range(30)] + [("h", f"/blog/{k}", "allow") for k in range(30)]
    rows += [("h", f"/news/{k}", "allow") for k in range(28)] + [("h", f"/news/{k}", "block") for k in range(2)]
    rows += [("h", f"/u/name{k}x/page", "block") for k in range(60)] + [("h", "/u/name99x/page", None), ("h", "/shop/77", None), ("h", "/else", None), ("g", "/shop/1", None)]
    df = spark.createDataFrame(rows, "host string, path string, label string").withColumn("segments", urlfilter.masked(F.col("path")))
    tree = {(r["host"], "/".join(r["segments"])): (r["template"], r["purity"]) for r in urlfilter.template_tree(df).collect()}
    assert tree["h", "/shop/{n}"] == ("//shop/{n}", pytest.approx(31 / 32))
    assert tree["h", "/u/name3x/page"][0] == "//u/{*}/page" == tree["h", "/u/name99x/page"][0] and tree["h", "/u/name99x/page"][1] == pytest.approx(61 / 62)
    assert tree["h", "/else"][1] == tree["g", "/shop/{n}"][1] == 0.5  # nothing is known of them
    assert tree["h", "/blog/{n}"][1] < 0.1


def test_chat_machine_and_escapes(spark):
    say = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", "<|end|>\\<|turn|>assistant<|text|>\\"), (1, 1, "assistant", "<|" + say + "\\\\|>"), (2, 0, "assistant", "x"), (2, 1, "user", "y"), (3, 0, "user", None),
        (4, 0, "system", ""), (4, 1, "user", "a"), (4, 2, "assistant", "b"), (4, 2, "assistant", "b"), (5, 0, None, "z"), (None, None, "user", "n"), (None, 1, "assistant", "n<"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash"))
    out = chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments")))
    got = {r["conv_id"]: r for r in out.collect()}
    for c in got:
        own = sorted(((t, r or "", x or "") for i, t, r, x in rows if i == c), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert [tuple(b) for b in got[c]["back"]] == [(r, x) for _, r, x in own]
        assert got[c]["loss"] == "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["formatted"] == "".join(s["text"] for s in got[c]["segments"])
    assert {c: (r["valid"], r["bad_turn"]) for c, r in got.items()} == {1: (True, None), 2: (False, 0), 3: (False, 1), 4: (False, 3), 5: (False, 0), None: (True, None)}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_ngram_weights_prefer_what_predicts():
    bins = np.array([[ngram.NEVER, 8], [20, 8]], float)
    assert ngram.expectation_maximisation(bins, np.array([1.0, 99.0]))[1] > 0.8
    assert ngram.expectation_maximisation(bins, np.array([99.0, 1.0]))[2] > 0.8

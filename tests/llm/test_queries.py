"""The registered queries against brute force over the driver's small tables."""

import hashlib
import re
from collections import Counter

import pytest

import __spark_entry__ as E
from listledger.llm import quality
from listledger.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name, key="doc_id"):
    rows = E.queries()[name](spark, SF).collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_op5_equals_all_pairs(spark, texts):
    import xxhash

    def print_of(text):
        w = WORD.findall(low(text))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: print_of(t) for i, t in texts.items()}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = result(spark, "op5_simhash")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{p:016x}", find(i)) for i, p in prints.items()}


def test_op7_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = result(spark, "op7_bpe")
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids
        raw = b"".join(k.to_bytes(4, "little") for k in ids)
        back = t.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_op9_counts(spark, texts):
    got = result(spark, "op9_quality")
    for i, text in texts.items():
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:]))
        repeat = {j for k in range(len(w) - 2) if windows[w[k], w[k + 1], w[k + 2]] > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        dup = sum(x in lines[:k] for k, x in enumerate(lines))
        r = got[i]
        assert tuple(r[c] for c in quality.COUNTS) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_op6_rules(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = result(spark, "op6_urls", "page_id")
    for i, url in urls.items():
        host, path = re.fullmatch(r"(?s).*?://([^/?#]*)([^?#]*).*", url).groups()
        fit = [r for r in rules if ("." + host.lower()).endswith("." + r[: r.index("/")]) and path.startswith(r[r.index("/") :])]
        rule = max(fit, key=len, default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host.lower(), path, rule)
        assert got[i]["verdict"] == rules[rule] if rule else got[i]["verdict"] in ("allow", "block")


def test_op10_equals_sql(spark):
    from tools.oracle_check import check, duck

    r = check(spark, duck(SF), SF, "op10_chat", E.queries()["op10_chat"], E.oracle_sql()["op10_chat"])
    assert r["status"] == "ok", r

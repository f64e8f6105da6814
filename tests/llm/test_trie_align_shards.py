"""Operators 11 to 13 against plain Python, with odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from listledger.llm import alignment, prefixtrie, sharding
from listledger.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_trie(paths):
    """``paths``: id -> list of (role, text)."""
    members = defaultdict(list)
    for i in sorted(paths):
        for d in range(len(paths[i]) + 1):
            members[tuple(paths[i][:d])].append(i)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], sha(",".join(str(i) for i in m if len(paths[i]) == len(p))))
        for p, m in members.items()
    )


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None):
        own[c].append((role, text))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


KEYS = ["id", "depth", "parent_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ODD = [
    (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 1, "assistant", "b"), (0, None, None, None), (1, 5, "user", "é"), (2, 0, "user", ""), (2, 0, "user", None),
    (3, 1, "user", "x" * 50_000), (4, 0, "a", "bc"), (6, 0, "ab", "c"), (7, 0, "a", "bc"), (None, 0, "user", "lost"), (10, 0, "user", "a"), (12, None, "user", "z"),
]


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(5)
    rows = list(ODD)
    for c in range(20, 220):
        n = rng.choice([1, 2, 3, 5, 9]) if c != 100 else 700  # one long conversation: several blocks
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc")) for t in range(n)]
    rows += [(c, t, "user", str(t)) for c in (300, 305, 310) for t in range(600)]  # long copies
    return rows


@pytest.mark.parametrize("bits", [27, 16])
def test_trie_equals_plain(spark, chats, bits, monkeypatch):
    df = spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string").select("*", *(F.lit(1).alias(c) for c in ("id", "pos", "key", "size")))
    if bits == 16:  # a sketch so full that it proves little
        monkeypatch.setattr(prefixtrie, "_cells", lambda keys, b: iter([__import__("numpy").zeros(len(keys), "u8")] * prefixtrie.DEPTH))
    turns, ends = prefixtrie.spliced(prefixtrie.numbered_turns(df), F.crc32(F.col("id").cast("string").cast("binary")) % 9, F.col("id") - F.col("id") % 5)
    got = prefixtrie.trie_nodes(turns, ends, bits).collect()
    assert sorted((tuple(r[k] for k in KEYS) for r in got), key=str) == sorted(plain_trie(rebuilt(chats)), key=str)


def test_screen_sends_only_shared_prefixes(spark, chats):
    turns = prefixtrie.numbered_turns(spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string"))
    ends = turns.groupBy("id").agg(F.max("pos").alias("size"))
    rows = prefixtrie.prefix_rows(turns, ends)
    marked = prefixtrie.screened(rows, *prefixtrie.count_min(rows))
    shared = rows.groupBy("key").count().where("count > 1").count()
    sent = marked.where("tail is null or pos < tail")
    assert sent.select("key").distinct().count() <= 1.05 * shared + 2
    assert marked.where("pos >= tail").groupBy("key").count().where("count > 1").count() == 0


def test_trie_of_no_rows(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    turns = prefixtrie.numbered_turns(none)
    assert prefixtrie.trie_nodes(turns, turns.groupBy("id").agg(F.max("pos").alias("size"))).count() == 0


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    from listledger.llm.bpe import byte_letters

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    letters, names = byte_letters(), {k: t for t, k in a.get_vocab().items()}
    groups, held = [], Counter()
    for text in texts:
        found = []
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            xs = [bytes(letters[c] for c in names[k]) for k in x]
            ys = [bytes([int(b.id_to_piece(k)[1:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
            if b"".join(xs) == b"".join(ys) == (" " + text).encode():
                i = j = n = m = 0
                now = ([], [])
                while i < len(x) or j < len(y):
                    if n <= m:
                        now[0].append(x[i])
                        n, i = n + len(xs[i]), i + 1
                    else:
                        now[1].append(y[j])
                        m, j = m + len(ys[j]), j + 1
                    if n == m:
                        found.append(now)
                        now = ([], [])
        groups.append(found)
        held.update({(p, q) for g in found for p in g[0] for q in g[1]})
    best = Counter()
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    for found in groups:
        pairs = [(p, q) for g in found for p in g[0] for q in g[1]]
        told = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in found)
        yield (sum(len(g[0]) for g in found), sum(len(g[1]) for g in found), len(found), len(pairs), sum(held[x] == best[x[0]] for x in pairs), sum(held[x] for x in pairs), told)


TEXTS = [None, "", " ", "  ", "a", "a", "a ", " a", "<|endoftext|> </s> <s> <0x41>", "x▁y", "\x00﻿ é 中文 \U0001f600", "tab\t \tand \n  lines\n\n end", "é", "　wide　 blank", "q" * 30_000, "word " * 20_000, "\r\n \r\n a"]


@pytest.mark.parametrize("most", [1 << 23, 1 << 12])
def test_alignment_equals_the_libraries(spark, most, monkeypatch):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(["a", "b", " ", "  ", "\n", "é", "the", "ing", "\xa0", "9", "中", "'s"]) for _ in range(rng.randrange(200))) for _ in range(60)]
    monkeypatch.setattr(alignment, "LINKS", 1000)
    if most == 1 << 12:  # several passes
        monkeypatch.setattr(alignment, "BUCKET", 64)
        most = 128
    rows = [(None if k == 3 else k // 2, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *(F.lit("x").alias(c) for c in ("id", "a", "b", "groups", "n_best")))
    got = alignment.aligned_documents(df, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), most=most).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, plain_alignment(texts))]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_op12_equals_the_libraries(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r["doc_id"]: (*x[:-1], sha(x[-1]) if x[-1] else "") for r, x in zip(rows, plain_alignment([r["text"] for r in rows]))}
    got = E.queries()["op12_alignment"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r[c] for c in (*alignment.FIGURES, "groups_sha256")) for r in got} == want


def test_alignment_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.aligned_documents(none, tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 31, 50_000))
    bucket = alignment.bucket_of(keys, 7)
    rows = []
    for b in (1, 3, 4):
        widths, bits, ordered = alignment.perfect_hash(keys[bucket == b])
        rows.append((b, widths, bits, ordered.astype("<u4").tobytes()))
    known = alignment.PerfectHash(7, rows)
    here = np.isin(bucket, (1, 3, 4))
    assert sorted(known.index(keys[here])) == list(range(here.sum())) and (known.index(keys[~here]) == -1).all()
    assert (known.index(np.setdiff1d(np.arange(100_000), keys)) == -1).all()


def plain_shards(rows, shards):
    """The dealt method by brute force: ends of groups under the smallest capacity that fits, tried one after the other."""
    size, first = Counter(), {}
    for i, t in rows:
        t = t or ""
        size[t] += len(t.encode()) + 1
        first[t] = min(first.get(t, (2, 0)), (1, i) if i is not None else (2, 0))  # null ids do not count
    first = {t: (1, i) if k == 1 else (0, 0) for t, (k, i) in first.items()}
    heavy = sorted(size, key=lambda t: (-size[t], first[t], hashlib.sha256(t.encode()).digest()))
    left, alone = sum(size.values()), []
    while len(alone) < min(len(heavy), shards - 1) and size[heavy[len(alone)]] * (shards - len(alone)) >= left:
        left -= size[heavy[len(alone)]]
        alone.append(heavy[len(alone)])
    order = sorted(set(size) - set(alone), key=lambda t: (first[t], hashlib.sha256(t.encode()).digest()))

    def fill(cap):
        out, k, held = {}, len(alone), 0
        for t in order:
            if held + size[t] > cap:
                k, held = k + 1, 0
            out[t], held = k, held + size[t]
        return out if k < shards else None

    cap = max([1, *(size[t] for t in order)])
    while order and fill(cap) is None:
        cap += 1
    where = (fill(cap) if order else {}) | {t: k for k, t in enumerate(alone)}
    return Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), where[t or ""]) for i, t in rows)


@pytest.mark.parametrize("case", ["odd", "even", "hot", "few"])
@pytest.mark.parametrize("limit", [3, 1 << 15])
def test_shards_equal_brute_force(spark, case, limit):
    rng = random.Random(case)
    rows = [(None, None), (None, ""), (1, "é"), (1, "é"), (2, "x" * 500)]
    if case == "even":
        rows += [(i, "t" * rng.randrange(40) + str(i)) for i in range(500)]
    if case == "hot":
        rows += [(i, "copy" if i % 3 == 0 else "near copy" if i % 7 == 0 else f"text {i}" * rng.randrange(9)) for i in range(600)]
    if case == "odd":
        rows += [(rng.randrange(60), rng.choice("abcdefgh") * rng.randrange(30)) for _ in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *(F.lit("x").alias(c) for c in ("id", "size", "digest", "pid", "shard")))
    got = sharding.shard_rows(df, 16, limit=limit).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got) == plain_shards(rows, 16)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_no_rows_and_op13(spark):
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = E.queries()["op13_shards"](spark, SF).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got) == plain_shards(rows, 16)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from listledger.llm import ngram

SF = "/root/testdata/sf0.001"


def brute(texts, order, weights):
    toks = {i: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), "\n"] for i, t in texts.items()}
    train = {i for i in toks if zlib.crc32(str(i).encode()) % 7 != 2}
    grams = [Counter() for _ in range(order)]
    for i in train:
        padded = ["\n"] * (order - 1) + toks[i]
        for k in range(order):
            for j in range(order - 1, len(padded)):
                grams[k][tuple(padded[j - k : j + 1])] += 1
    n, v = sum(grams[0].values()), len(grams[0])
    out = {}
    for i, t in toks.items():
        padded, base, score = ["\n"] * (order - 1) + t, 0.0, 0.0
        for j in range(order - 1, len(padded)):
            c = grams[0][(padded[j],)]
            base += math.log10((c + 1) / (n + v + 1))
            top, p = 0, [1 / (v + 1), c / n]
            for k in range(1, order):
                h = tuple(padded[j - k : j])
                top = len(train) if set(h) == {"\n"} and j == order - 1 else grams[k - 1][h]
                p.append(grams[k][tuple(padded[j - k : j + 1])] / top if top else 0.0)
            w = weights[int(math.log2(top)) + 1 if top else 0]
            score += math.log10(sum(a * b for a, b in zip(w, p)))
        out[i] = (i in train, len(t), sum(grams[0][(w,)] > 0 for w in t), base, score)
    return out, n, v


@pytest.mark.parametrize("chunk_chars", [8 << 20, 60_000])
def test_scores_equal_brute_force(spark, chunk_chars):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got, model = ngram.train_and_score(docs, *ngram.by_fold(), order=2, chunk_chars=chunk_chars)
    rows = {r["doc_id"]: r for r in got.collect()}
    table = model.weight_table()
    assert abs(table.sum(1) - 1).max() < 1e-9
    want, n, v = brute({r["doc_id"]: r["text"] for r in docs.collect()}, 2, table)
    assert (model.tokens, model.types) == (n, v)
    for i, (train, tokens, known, base, score) in want.items():
        r = rows[i]
        assert (r["train"], r["n_tokens"], r["n_known"]) == (train, tokens, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in rows.values() if not r["train"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # the mixture predicts unseen texts better


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "A a \t a"), (4, "x " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 kind", "'z' chunk", "0 id")
    got, model = ngram.train_and_score(docs, *ngram.by_fold())
    out = got.collect()
    assert len(out) == 6 and all(math.isfinite(r["score"]) for r in out)
    assert sorted(r["n_tokens"] for r in out) == [1, 1, 1, 3, 4, 5001]
    none, _ = ngram.train_and_score(docs.limit(0), *ngram.by_fold())
    assert none.count() == 0


def test_small_counts_take_few_bytes():
    for top, width in ((0, 1), (255, 1), (256, 2), (2**64 - 1, 8)):
        values = np.array([1, 0, top, 7], np.uint64)
        raw = ngram.planes(values)
        assert len(raw) == 1 + 4 * width and (ngram.unplanes(raw) == values).all()


def test_a_chunk_is_worked_through_in_few_bytes_a_token():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.zipf(1.3, 200) % 50_000)) for _ in range(1500)]  # 301,500 tokens
    asked = ngram.requests(2, 4)[0](pd.DataFrame({"chunk": 1, "kind": 1, "text": texts}))
    answers = pd.concat([ngram.answer(g) for _, g in asked.groupby(["bucket", "level"])])
    docs = pd.DataFrame({"id": range(1500), "kind": 1, "text": texts})
    model = ngram.Model(2, 301_500, 3_000, 1500, {0: np.full(3, 1 / 3)})
    for run in (ngram.held_out_bins(2, 301_500, 3_000, 1500)[0], ngram.scores(model)):
        tracemalloc.start()
        run(docs, answers)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 95 * 301_500

"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re

import numpy as np
import pytest

import corpus_pipeline as P
from listledger.llm import decontam
from listledger.llm.queries import tokenizer_path, toxicity_model
from listledger.llm.toxicity import Scorer

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read again as the driver does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(("documents", docs))
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return {name: {r["doc_id"]: r for r in df.collect()} for name, df in out}, dict(out)


def test_order_and_columns(stages):
    rows, tables = stages
    assert [name for name, _ in P.STAGES] == ["toxicity", "simhash", "decontaminate", "secrets", "bpe"]
    for name, _ in P.STAGES[:-1]:
        assert tables[name].columns == tables["documents"].columns
        assert tables[name].schema.simpleString() == tables["documents"].schema.simpleString()
        assert tables[name].count() == len(rows[name])


def test_toxic_documents_go(spark, stages):
    rows, _ = stages
    model = toxicity_model(spark, SF)
    scorer, (bias, *w) = Scorer(model), model.coef
    line = {i: bias + float(np.dot(w, scorer.row(r["text"]))) for i, r in rows["documents"].items()}
    assert rows["toxicity"].keys() == {i for i, x in line.items() if x < 0}


def test_one_of_each_group_stays(stages):
    import xxhash

    rows, _ = stages
    prints = {}
    for i, r in rows["toxicity"].items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in s], np.uint64)
        prints[i] = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    ids = sorted(prints)
    p = np.array([prints[i] for i in ids], np.uint64)
    near, seen, keep = np.bitwise_count(p[:, None] ^ p[None, :]) <= 2, set(), set()
    for k in range(len(ids)):
        if k not in seen:
            keep.add(ids[k])
            todo = [k]
            while todo:
                j = todo.pop()
                if j not in seen:
                    seen.add(j)
                    todo += np.nonzero(near[j])[0].tolist()
    assert rows["simhash"].keys() == keep


def test_leaks_go(spark, stages):
    rows, _ = stages
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i, r in rows["simhash"].items() if any(t in decontam.normal(r["text"]) for t in items if len(t) >= 50)}
    gone = rows["simhash"].keys() - rows["decontaminate"].keys()
    assert exact <= gone and exact
    for i in gone - exact:  # near copies, by the plain distance
        body = decontam.normal(rows["simhash"][i]["text"])
        assert any(decontam.Myers(t).best(body, int(0.08 * len(t))) <= int(0.08 * len(t)) for t in items)


def test_secrets_are_replaced(stages):
    rows, _ = stages
    known = re.compile(r"AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}|(?<=TOKEN = \")[0-9A-F]{40}")
    assert rows["secrets"].keys() == rows["decontaminate"].keys()
    for i, r in rows["secrets"].items():
        before = rows["decontaminate"][i]
        assert r["text"] == known.sub("[SECRET]", before["text"])
        assert r["n_chars"] == (len(r["text"]) if r["text"] != before["text"] else before["n_chars"])


def test_ids_decode_to_the_text(stages):
    from tokenizers import Tokenizer

    rows, _ = stages
    t = Tokenizer.from_file(tokenizer_path())
    for i, r in rows["bpe"].items():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == t.encode(rows["secrets"][i]["text"], add_special_tokens=False).ids and len(ids) == r["n_tokens"]


def test_run_and_empty_input(spark, stages):
    rows, tables = stages
    assert {r["doc_id"] for r in P.run(spark, SF).select("doc_id").collect()} == rows["bpe"].keys()
    docs = tables["documents"].limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0

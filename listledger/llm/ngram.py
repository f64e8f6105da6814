"""Language-model scores by deleted interpolation.

A text is its lower-cased words and one end token. The probability of a token mixes the maximum-likelihood estimates of its
n-grams of all orders up to ``order`` and the uniform one,

    p(w | h) = l_n c(h w) / c(h) + ... + l_1 c(w) / N + l_0 / (V + 1)

with weights l that depend on how often the longest context was seen (buckets of powers of two). The weights are learned by
expectation-maximisation on held-out counts: one fold of the training texts is deleted from the counts, and its tokens say which
mixture predicts them best. Scores use the counts of all training texts.

Counts are exchanged, not joined row by row. Texts are dealt into chunks of some ``chunk_chars`` characters; a chunk asks for each
n-gram it holds once, as a sorted array of 64-bit keys cut by key range; the owner of a range sums what all chunks report and
answers each with an aligned array of counts. So a word or n-gram that a third of all rows hold is one key a chunk,
whatever its count; no task holds more than a chunk or a range, both of which grow in number and not in size;
nothing but a table of held-out sums (at most a fixed number of bins) and two totals reach the driver.
Two n-grams whose 64-bit keys collide share a count; V counts keys.

Defined cases: a null text is empty and has the end token alone; repeated rows count each; a null id belongs to fold 0 of 7;
contexts at a text's start are the end token; with no training text all counts are zero and p is uniform, and with no
held-out fold the weights are even."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import fold, words, write_through

END = b"\n"  # no word holds white space
KINDS = {"train": 0, "deleted": 1, "held_out": 2}
STEP = 4  # bins of held-out probability ratios, a nat
NEVER = -(10**6)  # the bin of an estimate of zero


def planes(values: np.ndarray) -> bytes:
    """The number of bytes that the largest of the 64-bit numbers takes, then the numbers byte by byte, all lowest bytes first: counts,
    most of them small, are a byte or two each wherever they lie."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    given = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((given.shape[1], 8), np.uint8)
    out[:, : raw[0]] = given.T
    return out.view("<u8").reshape(-1)


def mix(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of an n-gram from the key of its context and the key of its last token."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + token
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Chunk:
    """The tokens of a chunk's texts, and for each order the distinct n-grams in key order. The orders are made one after the other
    by ``levels``: a task holds the tables of one."""

    def __init__(self, texts, order: int):
        from xxhash import xxh64_intdigest

        self.order, self.lengths = order, []
        known: dict[bytes, int] = {END: 0}
        tokens = []
        for text in texts:
            own = words(text)
            tokens.append(np.fromiter((known.setdefault(w, len(known)) for w in own), np.int32, len(own)))
            tokens.append(np.zeros(1, np.int32))
            self.lengths.append(len(own) + 1)
        hashes = np.fromiter(map(xxh64_intdigest, known), np.uint64, len(known))
        del known
        self.end, self.tokens = hashes[:1], hashes[np.concatenate(tokens)] if tokens else np.zeros(0, np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)

    def levels(self):
        """For each order: the distinct keys, ascending; which of them stands at each token; how often each occurs."""
        key = self.tokens
        for level in range(self.order):
            if level:  # the n-gram before, one token back; at a text's start that of the end token
                back = np.roll(key, 1)
                back[self.starts] = self.edge(self.end, level)
                key = mix(back, self.tokens)
                del back
            yield distinct(key)

    @staticmethod
    def edge(end: np.ndarray, level: int) -> np.ndarray:
        """Key of as many end tokens."""
        key = end
        for _ in range(level - 1):
            key = mix(key, end)
        return key


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, ascending; the place of each value among them; how often each occurs. A chunk has fewer than 2^31 tokens."""
    order = np.argsort(key).astype(np.int32)
    ascending = key[order]
    new = np.concatenate(([True], ascending[1:] != ascending[:-1])) if len(key) else np.zeros(0, bool)
    found, firsts = ascending[new], np.flatnonzero(new)
    at = np.empty(len(key), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return found, at, np.diff(firsts, append=len(key))


def ranges(buckets: int) -> np.ndarray:
    """The least key of each bucket but the first."""
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def requests(order: int, buckets: int):
    edges = ranges(buckets)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk, kind = int(pdf["chunk"].iloc[0]), int(pdf["kind"].iloc[0])
        own, rows = Chunk(pdf["text"], order), []
        for level, (keys, _, counts) in enumerate(own.levels()):
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            rows += [(b, level, chunk, kind, planes(keys[i:j]), planes(counts[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        return pd.DataFrame(rows, columns=["bucket", "level", "chunk", "kind", "keys", "counts"])

    return run, "bucket int, level int, chunk bigint, kind int, keys binary, counts binary"


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of a range's n-grams in the training texts without the deleted fold, and in that fold, for each chunk that asks."""
    keys = [unplanes(x) for x in pdf["keys"]]
    counts = [unplanes(x).astype(np.int64) for x in pdf["counts"]]
    found, at, _ = distinct(np.concatenate(keys))
    sums = np.zeros((2, len(found)), np.int64)
    sizes = np.cumsum([0, *map(len, keys)])
    for k, kind in enumerate(pdf["kind"]):
        if kind < 2:
            sums[kind, at[sizes[k] : sizes[k + 1]]] += counts[k]  # a chunk's keys are distinct
    parts = [at[i:j] for i, j in zip(sizes, sizes[1:])]
    first = np.arange(len(pdf)) == 0
    return pd.DataFrame({
        "chunk": pdf["chunk"], "level": pdf["level"], "bucket": pdf["bucket"],
        "kept": [planes(sums[0, p]) for p in parts], "deleted": [planes(sums[1, p]) for p in parts],
        "types": np.where(first, int((sums.sum(0) > 0).sum()), 0),
        "tokens_kept": np.where(first, int(sums[0].sum()), 0), "tokens_deleted": np.where(first, int(sums[1].sum()), 0),
    })


ANSWER = "chunk bigint, level int, bucket int, kept binary, deleted binary, types bigint, tokens_kept bigint, tokens_deleted bigint"


def answered(answers: pd.DataFrame, deleted: bool) -> dict[int, list[tuple[bytes, bytes | None]]]:
    """By order, the answers in the order of the ranges, still packed; ``deleted``: the counts of the deleted fold are left out."""
    rows = answers.sort_values(["level", "bucket"])
    out: dict[int, list] = {}
    for level, kept, gone in zip(rows["level"], rows["kept"], [None] * len(rows) if deleted else rows["deleted"]):
        out.setdefault(level, []).append((kept, gone))
    return out


def by_level(own: Chunk, packed: dict, texts_seen: int):
    """For each order, the counts of the n-gram at each token and those of its context (None: the first order's).
    A text's start is seen once a training text."""
    before = None
    for level, (_, at, _) in enumerate(own.levels()):
        kept = [unplanes(x) if y is None else unplanes(x) + unplanes(y) for x, y in packed.pop(level)]
        counts = np.concatenate(kept).astype(np.int64)[at]
        del kept, at
        if before is not None:
            before = np.roll(before, 1)
            before[own.starts] = texts_seen
        yield counts, before
        before = counts


def estimate(counts: np.ndarray, contexts: np.ndarray | None, n: int) -> np.ndarray:
    """Maximum-likelihood estimates of an order; zero where the context is unseen."""
    return counts / max(n, 1) if contexts is None else np.divide(counts, contexts, out=np.zeros(len(counts)), where=contexts > 0)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Contexts never seen, seen once, two or three times, four to seven times, and so on."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def expectation_maximisation(bins: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Weights (uniform first, then by order) that make the held-out tokens likeliest. ``bins``: log ratios of the estimates of each
    order to the uniform one; ``n``: tokens of each row."""
    p = np.c_[np.ones(len(bins)), np.where(bins > NEVER, np.exp(np.maximum(bins, -600) / STEP), 0.0)]
    weights = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        share = p * weights
        share *= (n / share.sum(1))[:, None]
        new = (share.sum(0) + 0.1) / (n.sum() + 0.1 * len(weights))  # no weight is zero
        if np.abs(new - weights).max() < 1e-9:
            break
        weights = new
    return weights


@dataclass
class Model:
    order: int
    tokens: int  # N
    types: int  # V
    texts: int  # training texts: how often a text's start was seen
    weights: dict[int, np.ndarray]  # by bucket of the longest context

    def weight_table(self) -> np.ndarray:
        """Weights by bucket; a bucket without held-out tokens has those of the nearest lower one."""
        table, last = np.zeros((66, self.order + 1)), np.full(self.order + 1, 1 / (self.order + 1))
        for b in range(66):
            last = table[b] = self.weights.get(b, last)
        return table


def dealt(docs: DataFrame, train: Column, deleted: Column, chunk_chars: int, id_col: str, text: str) -> tuple[DataFrame, int]:
    """Rows (id, text, kind, chunk) and the number of chunks of one kind; texts of one kind share a chunk."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"), F.when(~train, 2).when(deleted, 1).otherwise(0).alias("kind"))
    sizes = {k: n for k, n in rows.groupBy("kind").agg(F.sum(F.length("text") + 1)).collect()}
    share = {k: max(1, math.ceil(n / chunk_chars)) for k, n in sizes.items()}
    parts = F.coalesce(*(F.when(F.col("kind") == k, F.lit(n)) for k, n in share.items()), F.lit(1))
    chunk = F.pmod(F.xxhash64("id", "text"), parts) * len(KINDS) + F.col("kind")
    return rows.withColumn("chunk", chunk), sum(share.values())


def exchange(rows: DataFrame, chunks: int, order: int) -> DataFrame:
    """The answers to all chunks' requests."""
    ask, schema = requests(order, max(4, chunks))
    return rows.select("text", "kind", "chunk").groupBy("chunk").applyInPandas(ask, schema).groupBy("bucket", "level").applyInPandas(answer, ANSWER)


def held_out_bins(order: int, tokens: int, types: int, texts: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", *(f"r{k}" for k in range(1, order + 1))]
        if not len(docs):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in [*names, "n"]})
        own = Chunk(docs["text"], order)
        rows, held = [], np.zeros(len(own.tokens), np.int32)  # the distinct rows of bins so far, and which of them each token has
        for counts, contexts in by_level(own, answered(answers, deleted=True), texts):
            top = counts if contexts is None else contexts  # the longest context is the last one
            ratio = estimate(counts, contexts, tokens)
            ratio *= types + 1
            with np.errstate(divide="ignore"):
                np.log(ratio, out=ratio)
            ratio *= STEP
            np.rint(ratio, out=ratio)
            ratio[~np.isfinite(ratio)] = NEVER
            ratio -= NEVER
            ratio = ratio.astype(np.uint64)
            found, at, _ = distinct(ratio)
            rows, held = paired(rows, held, found.astype(np.int64) + NEVER, at)
        column, at, _ = distinct(bucket_of(top).astype(np.uint64))
        rows, held = paired(rows, held, column.astype(np.int64), at)
        n = np.bincount(held, minlength=len(rows[0]))
        return pd.DataFrame(np.column_stack([rows[-1], *rows[:-1], n]), columns=[*names, "n"])

    return run, ", ".join(f"{c} bigint" for c in ["bucket", *(f"r{k}" for k in range(1, order + 1)), "n"])


def paired(rows: list[np.ndarray], held: np.ndarray, column: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct pairs of a row of a table and a value of one more column, as a table with that column, and the place of each pair in it."""
    found, place, _ = distinct(held.astype(np.uint64) * np.uint64(len(column)) + at.astype(np.uint64))
    of = (found // np.uint64(len(column))).astype(np.int64)
    return [*(r[of] for r in rows), column[(found % np.uint64(len(column))).astype(np.int64)]], place


def scores(model: Model):
    table = model.weight_table()

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["id", "kind", "n_tokens", "n_known", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame({c: [] for c in names})
        own = Chunk(docs["text"], model.order)
        total = lambda x: np.add.reduceat(x, own.starts)
        parts, known, base = [], None, None
        for counts, contexts in by_level(own, answered(answers, deleted=False), model.texts):
            if known is None:
                known = total((counts > 0).astype(np.int64))
                base = total(np.log10((counts + 1) / (model.tokens + model.types + 1)))
            top = counts if contexts is None else contexts  # the longest context is the last one
            parts.append(estimate(counts, contexts, model.tokens))
        top = bucket_of(top)
        p = table[:, 0][top] / (model.types + 1)
        for k, part in enumerate(parts):
            p += table[:, k + 1][top] * part
        return pd.DataFrame({"id": docs["id"].to_numpy(), "kind": docs["kind"].to_numpy(), "n_tokens": own.lengths, "n_known": known, "base_score": base, "score": total(np.log10(p))})

    return run


def train_and_score(docs: DataFrame, train: Column, deleted: Column, order: int = 2, chunk_chars: int = 6 << 20, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """Learn from the rows where ``train`` holds (``deleted``: the fold of them that sets the weights) and score all rows: (id, train,
    n_tokens, n_known, base_score, score), logarithms to the base 10. Also the model."""
    rows, chunks = dealt(docs, train, deleted, chunk_chars, id_col, text)
    answers = write_through(exchange(rows, chunks, order), "answers")
    types, kept, gone = (x or 0 for x in answers.where("level = 0").agg(F.sum("types"), F.sum("tokens_kept"), F.sum("tokens_deleted")).first())
    seen = {k: n for k, n in rows.groupBy("kind").count().collect()}
    of = answers.select("chunk", "level", "bucket", "kept", "deleted").groupBy("chunk")
    bins, schema = held_out_bins(order, kept, types, seen.get(0, 0))
    few = answers.where(F.col("chunk") % len(KINDS) == KINDS["deleted"]).select("chunk", "level", "bucket", "kept", "deleted")
    table = rows.where(F.col("kind") == KINDS["deleted"]).groupBy("chunk").cogroup(few.groupBy("chunk")).applyInPandas(bins, schema)
    names = ["bucket", *(f"r{k}" for k in range(1, order + 1))]
    table = np.array([tuple(r) for r in table.groupBy(*names).agg(F.sum("n")).collect()], np.int64).reshape(-1, order + 2)
    weights = {int(b): expectation_maximisation(own[:, 1:-1].astype(float), own[:, -1].astype(float)) for b in np.unique(table[:, 0]) if len(own := table[table[:, 0] == b])}
    model = Model(order, kept + gone, types, seen.get(0, 0) + seen.get(1, 0), weights)
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.groupBy("chunk").cogroup(of).applyInPandas(scores(model), f"id {kind}, kind int, n_tokens bigint, n_known bigint, base_score double, score double")
    out = out.withColumn("train", F.col("kind") != KINDS["held_out"]).withColumnRenamed("id", id_col)
    return out.select(id_col, "train", "n_tokens", "n_known", "base_score", "score"), model


def by_fold(id_col: str = "doc_id") -> tuple[Column, Column]:
    """The contract's folds: remainder 2 of 7 is held out; of the training rows, remainder 3 is deleted."""
    return fold(id_col, 7) != 2, fold(id_col, 7) == 3

"""Cross-tokenizer alignment of a byte-level BPE (A) and a SentencePiece BPE with byte fallback (B).

Both tokenizers read a space and the text. Byte offsets where tokens of both end cut a document into groups; all pairs of an A and a
B token of one group are linked. A pair of ids counts the documents that hold it linked.

1. ``tokenized``: ids of both sides, written once; the later passes re-align from ids.
2. ``distinct_pairs``: the distinct linked pairs, dealt into buckets by a hash. Each bucket gets a minimal perfect hash (Limasset et
   al. 2017: a bit array per level, keys that collide go to the next one), built in a task of its own, and its keys in hash order, by which
   every later look-up is verified.
3. ``counted``: documents are aligned again and counted in dense vectors indexed by the hash; a task sends each bucket's vector once, and
   the vectors are added up as a tree.
4. ``looked_up``: documents are aligned once more and read the counts.

Memory. A pass holds hash, keys and vector of at most ``PAIRS`` pairs in a worker; more pairs are taken in several passes of whole buckets,
each aligning all documents, so any number of pairs is exact. The best count of an A id is a table of at most as many rows as A's vocabulary.
A group's pairs are made in blocks of its A ids.

Defined cases: null and empty texts, and texts whose joined tokens of either side differ from the space and the text, have no tokens;
special strings in a text are plain text; repeated rows are documents of their own; ids may repeat or be null; an empty table gives no rows."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm.bpe import PIECES, byte_letters, read_model
from listledger.llm.common import fold_runs, write_through

#: Pairs that a pass over the documents holds in a worker at most, and mean pairs of a bucket.
PAIRS, BUCKET = 1 << 23, 1 << 12
#: Characters of a part of a batch, and links made at a time.
PART, LINKS = 1 << 19, 1 << 18


class TwoTokenizers:
    """Ids of both tokenizers for whole texts, and the bytes of each id."""

    def __init__(self, spec: str, pieces: bytes):
        import sentencepiece
        import tiktoken

        model, letters = json.loads(spec)["model"], byte_letters()
        token = {k: bytes(letters[c] for c in t) for t, k in model["vocab"].items() if all(c in letters for c in t)}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ranks = {token[k]: r for r, k in enumerate(sorted(k for k, t in token.items() if len(t) == 1))}
        for m in merged:
            ranks.setdefault(bytes(letters[c] for c in m), len(ranks))
        self.a_of_rank = np.array([k for _, k in sorted((ranks[t], k) for k, t in token.items() if t in ranks)], "<u4")
        self.a = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_bytes: dict[int, bytes] = {}
        for k in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(k)
            if self.b.is_byte(k):
                self.b_bytes[k] = bytes([int(piece[1:-1], 16)])
            elif not (self.b.is_control(k) or self.b.is_unknown(k)):
                self.b_bytes[k] = piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """A ids and B ids; none where B's do not spell the space and the text (A's always do)."""
        if not text:
            return b"", b""
        b = self.b.encode(text)
        if b"".join([self.b_bytes.get(k, b"") for k in b]) != b" " + text.encode():
            return b"", b""
        return self.a_of_rank[self.a.encode_ordinary(" " + text)].tobytes(), np.array(b, "<u4").tobytes()


_TOKENIZERS: dict[int, TwoTokenizers] = {}


def parts(batches, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most 512 rows and about ``PART`` characters (bytes of column ``text``)."""
    for batch in batches:
        start = 0
        size = np.zeros(batch.num_rows) if text is None else pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        at = np.cumsum(size)
        while start < batch.num_rows:
            before = at[start - 1] if start else 0
            stop = min(start + 512, max(start + 1, int(np.searchsorted(at, before + PART, side="right"))), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def tokenized(df: DataFrame, spec_path: str, pieces_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, a, b): ids as little-endian unsigned 32-bit integers; both empty where a text has no tokens. Written."""
    with open(pieces_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast((read_model(spec_path), file.read(64 << 20)))

    def run(batches):
        key = hash(shared.value)
        if key not in _TOKENIZERS:
            _TOKENIZERS.clear()
            _TOKENIZERS[key] = TwoTokenizers(*shared.value)
        both = _TOKENIZERS[key]
        for part in parts(batches, 1):
            sides = [both.encode(text) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(s, pa.binary()) for s in zip(*sides))], ["id", "a", "b"])

    kind = df.schema[id_col].dataType.simpleString()
    return write_through(df.select(F.col(id_col).alias("id"), text).mapInArrow(run, f"id {kind}, a binary, b binary"), "align-ids")


@dataclass
class Vocabularies:
    """Bytes of each token of A and of B; A ids are below ``len(a_size)``, and so for B."""

    a_size: np.ndarray
    b_size: np.ndarray

    @classmethod
    def of(cls, both: TwoTokenizers) -> Vocabularies:
        def sizes(known: dict[int, bytes]) -> np.ndarray:
            out = np.zeros(1 + max(known), np.int64)
            for k, t in known.items():
                out[k] = len(t)
            return out

        out = cls(sizes(both.a_bytes), sizes(both.b_bytes))
        if len(out.a_size) * len(out.b_size) > 1 << 32:
            raise ValueError("a pair of ids must fit 32 bits")
        return out


@dataclass
class Aligned:
    """Documents side by side: tokens of both sides, their groups, and where each document's tokens and groups begin."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_start: np.ndarray
    b_start: np.ndarray
    group_start: np.ndarray


def align(a_ids: list[bytes], b_ids: list[bytes], size: Vocabularies) -> Aligned:
    """Groups of documents that lie one behind the other: a document's end is an end of both sides, so no group leaves it."""
    a, b = np.frombuffer(b"".join(a_ids), "<u4").astype(np.int64), np.frombuffer(b"".join(b_ids), "<u4").astype(np.int64)
    a_end, b_end = np.cumsum(size.a_size[a]), np.cumsum(size.b_size[b])
    is_end = np.zeros(1 + (int(a_end[-1]) if len(a) else 0), bool)
    is_end[b_end] = True
    common = a_end[is_end[a_end]]
    a_start = np.cumsum([0, *(len(x) // 4 for x in a_ids)])
    b_start = np.cumsum([0, *(len(x) // 4 for x in b_ids)])
    ends = np.r_[0, a_end][a_start]
    return Aligned(a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end), a_start, b_start, np.searchsorted(common, ends, side="right"))


def links(x: Aligned, b_size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links in blocks: (document number, A id * ``b_size`` + B id). Blocks are cut between A tokens, and inside the B tokens of one."""
    if not len(x.a):
        return
    document = np.repeat(np.arange(len(x.a_start) - 1), np.diff(x.a_start))
    first = np.searchsorted(x.b_group, x.a_group)  # the first B token of each A token's group
    many = np.searchsorted(x.b_group, x.a_group, side="right") - first
    before = np.r_[0, np.cumsum(many)]
    for low in range(0, int(before[-1]), LINKS):  # links low .. high of all, in order
        high = min(low + LINKS, int(before[-1]))
        i, j = np.searchsorted(before, low, side="right") - 1, np.searchsorted(before, high)
        skip = np.maximum(low - before[i:j], 0)
        n = np.minimum(before[i + 1 : j + 1], high) - np.maximum(before[i:j], low)
        of = np.repeat(np.arange(i, j), n)
        b_at = np.repeat(first[i:j] + skip - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(high - low)
        yield document[of], x.a[of] * b_size + x.b[b_at]


def document_pairs(x: Aligned, size: Vocabularies) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair), ascending, with the number of their links."""
    span = len(size.a_size) * len(size.b_size)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for document, pair in links(x, len(size.b_size)):
        k, c = np.unique(document * span + pair, return_counts=True)
        if len(keys):
            k, at = np.unique(np.r_[keys, k], return_inverse=True)
            both = np.zeros(len(k), np.int64)
            np.add.at(both, at, np.r_[counts, c])
            c = both
        keys, counts = k, c
    return keys // span, keys % span, counts


def id_names(size: Vocabularies) -> pa.Array:
    """What the group texts are joined of: each id with the sign that follows it (``,`` ``|`` for A, ``,`` ``;`` for B), then alone."""
    most = max(len(size.a_size), len(size.b_size))
    return pa.array([f"{k}{sign}" for k in range(most) for sign in ",|,;"] + [str(k) for k in range(most)])


def group_texts(x: Aligned, names: pa.Array) -> pa.Array:
    """Per document ``a1,a2|b1;a3|b2``: ids of each group's A tokens, then its B tokens."""
    a_at = np.arange(len(x.a)) + np.searchsorted(x.b_group, x.a_group)  # place in the order: A of a group, B of it, A of the next
    b_at = np.arange(len(x.b)) + np.searchsorted(x.a_group, x.b_group, side="right")
    last = lambda g: np.r_[g[1:] != g[:-1], True] if len(g) else np.zeros(0, bool)
    code = np.zeros(len(x.a) + len(x.b), np.int64)
    code[a_at] = x.a * 4 + last(x.a_group)
    code[b_at] = x.b * 4 + 2 + last(x.b_group)
    starts = x.a_start + x.b_start
    final = starts[1:][np.diff(starts) > 0] - 1
    code[final] = len(names) // 5 * 4 + (code[final] >> 2)  # nothing follows a document's last id
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), names.take(pa.array(code))), "")


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 mixed bits of each key, anew for each level (the finalizer of SplitMix64)."""
    x = keys.astype(np.uint64) + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(pairs, -1) % np.uint64(buckets)).astype(np.int64)


def perfect_hash(keys: np.ndarray, room: float = 2.0) -> tuple[list[int], bytes, np.ndarray]:
    """(bits of each level, bit arrays one after the other padded to words, keys in hash order) of distinct keys."""
    widths, arrays, ordered, left, level = [], [], [], keys, 0
    while len(left):
        width = -(-max(64, int(room * len(left))) // 64) * 64
        at = (mixed(left, level) % np.uint64(width)).astype(np.int64)
        single = np.bincount(at, minlength=width) == 1
        mine = single[at]
        ordered.append(left[mine][np.argsort(at[mine])])
        widths.append(width)
        arrays.append(np.packbits(single, bitorder="little").tobytes())
        left, level = left[~mine], level + 1
    return widths, b"".join(arrays), np.concatenate(ordered) if ordered else keys


class PerfectHash:
    """The hashes of some buckets side by side; a pair of no such bucket, or of none of the keys, has no index."""

    def __init__(self, buckets: int, rows: list[tuple[int, list[int], bytes, bytes]]):
        self.buckets, self.keys = buckets, np.concatenate([np.frombuffer(r[3], "<u4") for r in rows] or [np.zeros(0, "<u4")])
        levels = max((len(r[1]) for r in rows), default=0)
        self.width, self.start = np.zeros((levels, buckets), np.int64), np.zeros((levels, buckets), np.int64)
        at = 0
        for bucket, widths, _, _ in rows:
            for level, width in enumerate(widths):
                self.width[level, bucket], self.start[level, bucket] = width, at
                at += width
        self.words = np.frombuffer(b"".join(r[2] for r in rows), "<u8")
        self.rank = np.cumsum(np.r_[0, np.bitwise_count(self.words).astype(np.int64)])

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """The index of each pair, verified by its key; -1 if it has none here."""
        out, bucket = np.full(len(pairs), -1), bucket_of(pairs, self.buckets)
        left = np.arange(len(pairs))
        for level in range(len(self.width)):
            width = self.width[level, bucket[left]]
            left, width = left[width > 0], width[width > 0]
            at = (mixed(pairs[left], level) % width.astype(np.uint64)).astype(np.int64) + self.start[level, bucket[left]]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            index = self.rank[word] + np.bitwise_count(low)
            out[left[found]] = index[found]
            left = left[~found]
        has = out >= 0
        has[has] = self.keys[out[has]] == pairs[has]
        return np.where(has, out, -1)


def distinct_pairs(ids: DataFrame, size: Vocabularies, remember: int = 1 << 22) -> DataFrame:
    """The distinct linked pairs of the corpus. A task leaves out pairs that it has lately sent: one remembered pair a slot. Written."""

    def run(batches):
        known = np.full(remember, -1, np.int64)
        _TOKENIZERS.clear()  # a worker that is used again needs them no more
        for part in parts(batches, 0):
            x = align(part.column(0).to_pylist(), part.column(1).to_pylist(), size)
            for _, pair in links(x, len(size.b_size)):
                pair = np.unique(pair[known[pair % remember] != pair])
                known[pair % remember] = pair
                yield pa.RecordBatch.from_arrays([pa.array(pair)], ["pair"])

    return write_through(ids.select("a", "b").mapInArrow(run, "pair bigint").distinct(), "align-pairs")


def hashed(pairs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, widths, bits, keys): a perfect hash of each bucket's pairs. Written."""

    def deal(batches):
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column(0)], ["bucket", "pair"])

    def build(rows):
        widths, bits, keys = perfect_hash(np.array([pair for _, pair in rows], np.int64))
        return widths, bits, keys.astype("<u4").tobytes()

    dealt = pairs.mapInArrow(deal, "bucket bigint, pair bigint")
    return write_through(fold_runs(dealt, ["bucket"], ["pair"], "bucket bigint, widths array<bigint>, bits binary, keys binary", build), "align-hash")


def _hash_of(rows) -> list[tuple[int, list[int], bytes, bytes]]:
    return sorted((r["bucket"], list(r["widths"]), bytes(r["bits"]), bytes(r["keys"])) for r in rows)


def counted(ids: DataFrame, size: Vocabularies, buckets: int, rows: list[tuple], tasks: int) -> DataFrame:
    """(bucket, counts): the number of documents of each pair of the buckets in ``rows``, in hash order, as unsigned 64-bit integers."""
    shared = ids.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        rows = shared.value
        known = PerfectHash(buckets, rows)
        mine = np.zeros(buckets, bool)
        mine[[r[0] for r in rows]] = True
        counts = np.zeros(len(known.keys), np.uint64)
        for part in parts(batches, 0):
            _, pair, _ = document_pairs(align(part.column(0).to_pylist(), part.column(1).to_pylist(), size), size)
            pair, n = np.unique(pair, return_counts=True)
            here = mine[bucket_of(pair, buckets)]
            at = known.index(pair[here])
            if (at < 0).any():
                raise ValueError("a pair is not among the keys: the documents have changed between the passes")
            counts[at] += n[here].astype(np.uint64)
        start, task = 0, TaskContext.get().partitionId()
        for bucket, _, _, keys in rows:
            part = counts[start : start + len(keys) // 4]
            start += len(part)
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([task % 8]), pa.array([part.tobytes()])], ["bucket", "branch", "counts"])

    def add(rows):
        total = None
        for row in rows:
            part = np.frombuffer(row[-1], np.uint64)
            total = part.copy() if total is None else total + part
        return (total.tobytes(),)

    vectors = ids.select("a", "b").coalesce(tasks).mapInArrow(run, "bucket bigint, branch bigint, counts binary")
    branches = fold_runs(vectors, ["bucket", "branch"], [], "bucket bigint, branch bigint, counts binary", add)
    return fold_runs(branches, ["bucket"], [], "bucket bigint, counts binary", add)


def pair_counts(rows: list[tuple], counts: DataFrame, b_size: int) -> DataFrame:
    """(a, b, count) from the vectors of ``counts`` and the keys of their buckets."""
    shared = counts.sparkSession.sparkContext.broadcast({r[0]: r[3] for r in rows})

    def run(batches):
        for batch in batches:
            for bucket, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pair = np.frombuffer(shared.value[bucket], "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair // b_size), pa.array(pair % b_size), pa.array(np.frombuffer(vector, np.uint64).astype(np.int64))], ["a", "b", "count"])

    return counts.mapInArrow(run, "a bigint, b bigint, count bigint")


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def looked_up(ids: DataFrame, size: Vocabularies, buckets: int, rows: list[tuple], vectors: dict[int, bytes], best: dict[int, int], texts: bool) -> DataFrame:
    """(all columns of ``ids``, ``FIGURES``, groups): ``n_best`` and ``count_sum`` over the links whose pair is in ``rows``, added to those that
    ``ids`` has already."""
    shared = ids.sparkSession.sparkContext.broadcast((rows, [vectors[r[0]] for r in rows], best))
    kinds = {f.name: f.dataType.simpleString() for f in ids.schema}
    given = list(ids.columns)
    out = [c for c in given if c not in (*FIGURES, "groups")]

    def run(batches):
        rows, vectors, best = shared.value
        known = PerfectHash(buckets, rows)
        counts = np.frombuffer(b"".join(vectors), np.uint64).astype(np.int64)
        top = np.zeros(len(size.a_size), np.int64)
        top[list(best)] = list(best.values())
        names = id_names(size) if texts else None
        for part in parts(batches, given.index("a")):
            column = lambda c: part.column(given.index(c))
            x = align(column("a").to_pylist(), column("b").to_pylist(), size)
            document, pair, n = document_pairs(x, size)
            at = known.index(pair)
            count = np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(at), np.int64)
            summed = np.zeros((3, part.num_rows), np.int64)
            for total, value in zip(summed, (n, n * ((at >= 0) & (count == top[pair // len(size.b_size)])), n * count)):
                np.add.at(total, document, value)
            figures = [np.diff(x.a_start), np.diff(x.b_start), np.diff(x.group_start), *summed]
            for k in (4, 5):
                if FIGURES[k] in given:
                    figures[k] = figures[k] + column(FIGURES[k]).to_numpy()
            groups = group_texts(x, names) if texts else column("groups")
            yield pa.RecordBatch.from_arrays([*(column(c) for c in out), *(pa.array(f.astype(np.int64)) for f in figures), groups], [*out, *FIGURES, "groups"])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in out] + [f"{c} bigint" for c in FIGURES] + ["groups string"])
    return ids.mapInArrow(run, schema)


def aligned_documents(df: DataFrame, spec_path: str, pieces_path: str, text: str = "text", id_col: str = "doc_id", most: int = PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for each row of ``df``. ``most``: pairs a pass."""
    spark = df.sparkSession
    ids = tokenized(df, spec_path, pieces_path, text, id_col)
    with open(pieces_path, "rb") as file:
        size = Vocabularies.of(TwoTokenizers(read_model(spec_path), file.read(64 << 20)))
    pairs = distinct_pairs(ids, size)
    buckets = max(1, -(-pairs.count() // BUCKET))
    hashes = hashed(pairs, buckets)
    passes = max(1, -(-buckets * BUCKET // most))
    step = -(-buckets // passes)
    tasks = 2 * spark.sparkContext.defaultParallelism
    turns, best = [], {}
    for low in range(0, buckets, step):
        rows = _hash_of(hashes.where(F.col("bucket").between(low, low + step - 1)).collect())  # at most `most` pairs
        counts = write_through(counted(ids, size, buckets, rows, tasks), "align-counts")
        for a, n in pair_counts(rows, counts, len(size.b_size)).groupBy("a").agg(F.max("count")).collect():  # at most A's vocabulary
            best[a] = max(best.get(a, 0), n)
        turns.append((low, counts))
    out = ids
    for k, (low, counts) in enumerate(turns):
        rows = _hash_of(hashes.where(F.col("bucket").between(low, low + step - 1)).collect())
        vectors = {r["bucket"]: bytes(r["counts"]) for r in counts.collect()}
        out = looked_up(out, size, buckets, rows, vectors, best, texts=k == 0)
        if k + 1 < len(turns):
            out = write_through(out, "align-pass")
    return out.drop("a", "b").withColumnRenamed("id", id_col)

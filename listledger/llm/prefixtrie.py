"""The trie of all prefixes of conversations, with a count-min screen of prefix digests.

A node is a distinct sequence of first turns. Every prefix has a digest: the sum, in four 32-bit lanes, of an MD5 of each of its
turns and the turn's place, then hashed with its length. Sums can be taken in parts, so a conversation of any length is worked on
in blocks. Equal digests (128 bits) are taken for equal prefixes.

A count-min sketch counts all digests. Its cells never count too little, so an estimate of one proves that a prefix belongs to one
conversation alone; from there on the conversation is a tail, and a tail's nodes need nothing but the conversation itself: they are emitted
where their rows stand. Only prefixes that may be shared are shuffled and grouped exactly. The screen is a bitmap ("two or more") of
at most ``DEPTH`` x 2^``WIDTH_BITS`` bits, whatever the corpus; a fuller sketch proves less and sends more rows to the exact grouping, and
the result stays the same.

Sums over subtrees need no walk by levels: a node is carried by its smallest member, whose own row of prefixes is the
path to the root. So a node's leaves and saved tokens go to its ancestors as running sums along single conversations, from the end to the
root, and one sum per digest.

Defined cases: turns are ordered by number (nulls first), then role and text, so repeated rows stay, side by side; a null role or text is
empty; rows without a conversation id belong to no conversation and are left out; a conversation may be without turns and then ends at the
root; an empty table gives no rows, not even a root; other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listledger.llm.common import fold_runs, running, slices, write_through

#: Rows of the sketch, and the most bits of a cell's number: three bitmaps of 2^27 bits are 48 MB.
DEPTH, WIDTH_BITS = 3, 27
SLICE = 1 << 16
LANES = ["lane1", "lane2", "lane3", "lane4"]


def numbered_turns(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, pos from 1, content, bytes) of each turn, ``content`` being the MD5 of role and text. Texts go no further than the one
    sort that orders the turns, over ranges of (id, turn, ...), so a long conversation is many ranges."""
    rows = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["id", F.col("turn").asc_nulls_first(), "role", "text"]
    content = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    slim = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(
        "id", content.alias("content"), F.octet_length("text").cast("bigint").alias("bytes"), F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")
    )
    slim = write_through(slim, "trie-turns")
    stats = slim.groupBy("pid", "id").agg(F.count("*").alias("n"), F.min("mid").alias("first"))
    earlier = Window.partitionBy("id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select("pid", "id", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return slim.join(stats, ["pid", "id"]).select("id", (F.col("before") + F.col("mid") - F.col("first") + 1).alias("pos"), "content", "bytes")


def prefix_rows(turns: DataFrame, ends: DataFrame) -> DataFrame:
    """(id, pos, size, bytes, key, parent) of each prefix. ``turns``: (id, pos, content, bytes); ``ends``: (id, size), its number of turns.
    Written."""
    placed = F.md5(F.concat_ws(":", "pos", "content"))
    lanes = [F.conv(F.substring("m", 1 + 8 * k, 8), 16, 10).cast("bigint").alias(c) for k, c in enumerate(LANES)]
    own = turns.withColumn("m", placed).select("id", "pos", "bytes", *lanes, *(x.alias(f"own{c}") for x, c in zip(lanes, LANES)))
    sums = running(own, ["id"], F.col("pos"), LANES)
    key = prefix_key(F.col("pos"), [F.col(c) for c in LANES])
    parent = prefix_key(F.col("pos") - 1, [F.col(c) - F.col(f"own{c}") for c in LANES])
    out = sums.join(ends, "id").select("id", "pos", "size", "bytes", key.alias("key"), parent.alias("parent"))
    return write_through(out, "trie-prefixes")


def prefix_key(pos: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", pos, *lanes)))


def _cells(keys: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """Per row of the sketch, the cell of each 16-byte key."""
    halves = np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)
    for row in range(DEPTH):
        yield (halves[:, 0] + np.uint64(2 * row + 1) * halves[:, 1]) >> np.uint64(64 - bits)


def count_min(prefixes: DataFrame, most_bits: int = WIDTH_BITS) -> tuple[int, bytes]:
    """The bits of a cell's number and the bitmaps of cells that count two or more. Each task sends the cells that its
    keys touch, slice by slice; a slice is then added up by one task, in a fixed 64 kB."""
    bits = min(most_bits, max(16, (4 * prefixes.count()).bit_length()))

    def touched(batches):
        held: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]

        def sent():
            for row, cells in enumerate(held):
                cell, count = np.unique(np.concatenate(cells), return_counts=True)
                count = np.minimum(count, 2).astype(np.uint8)
                part = (cell // np.uint64(SLICE)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part)) + 1
                for c, k, s in zip(np.split(cell, cuts), np.split(count, cuts), part[np.r_[0, cuts]]):
                    yield int(s) + (row << (bits - 16)), (c % np.uint64(SLICE)).astype("<u2").tobytes(), k.tobytes()
                cells.clear()

        n = 0
        for batch in slices(batches, 1 << 14):
            for row, cells in enumerate(_cells(batch.column(0), bits)):
                held[row].append(cells)
            n += batch.num_rows
            if n >= 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*sent())], ["slice", "cells", "counts"])
                n = 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*sent())], ["slice", "cells", "counts"])

    def add(rows):
        total = np.zeros(SLICE, np.uint8)
        for _, cells, counts in rows:
            at = np.frombuffer(cells, "<u2")
            total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
        return (np.packbits(total > 1, bitorder="little").tobytes(),)

    parts = prefixes.select("key").mapInArrow(touched, "slice bigint, cells binary, counts binary")
    out = bytearray(DEPTH << (bits - 3))
    for row in fold_runs(parts, ["slice"], [], "slice bigint, twice binary", add).collect():  # bounded: DEPTH x 2^bits bits in all
        out[row["slice"] * SLICE // 8 : (row["slice"] + 1) * SLICE // 8] = row["twice"]
    return bits, bytes(out)


def screened(prefixes: DataFrame, bits: int, bitmap: bytes) -> DataFrame:
    """``prefixes`` with ``tail``: null where the conversation has no proven singleton, else the length of its shortest one. Written."""
    shared = prefixes.sparkSession.sparkContext.broadcast(bitmap)

    def prove(batches):
        cells_at = np.frombuffer(shared.value, np.uint8).reshape(DEPTH, -1)
        for batch in slices(batches, 1 << 14):
            single = np.zeros(batch.num_rows, bool)
            for row, cells in enumerate(_cells(batch.column(2), bits)):
                single |= (cells_at[row][cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8) & 1) == 0
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(single)), batch.column(1).filter(pa.array(single))], ["id", "tail"])

    proven = prefixes.select("id", "pos", "key").mapInArrow(prove, "id bigint, tail bigint").groupBy("id").agg(F.min("tail").alias("tail"))
    return write_through(prefixes.join(proven, "id", "left"), "trie-screened")


def end_digests(ends: DataFrame, run: int = 1000) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's ids, ascending, comma-joined. Ids are sorted over ranges, joined in pieces of
    at most ``run`` ids, and a key's pieces are hashed as a stream, so no list of ids is ever held."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches):
        stream = ((k, i) for batch in slices(batches) for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        held, of, out = [], None, []
        for k, i in stream:
            if held and (k != of or len(held) == run):
                out.append((of, held[0], ",".join(map(str, held))))
                held = []
            of = k
            held.append(i)
            if len(out) == 256:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["key", "first", "ids"])
                out = []
        if held:
            out.append((of, held[0], ",".join(map(str, held))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["key", "first", "ids"])

    def digest(rows):
        sha, between = hashlib.sha256(), b""
        for _, _, ids in rows:
            sha.update(between + ids.encode())
            between = b","
        return (sha.hexdigest(),)

    sorted_ends = ends.select("key", "id").repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")
    joined = sorted_ends.mapInArrow(pieces, "key binary, first bigint, ids string")
    return fold_runs(joined, ["key"], ["first"], "key binary, ends_sha256 string", digest)


def trie_nodes(turns: DataFrame, ends: DataFrame, most_bits: int = WIDTH_BITS) -> DataFrame:
    """One row a node: id (its smallest member), depth, parent_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``turns``: (id, pos from 1 without gaps, content, bytes); ``ends``: (id, size), a row for each conversation."""
    rows = prefix_rows(turns, ends)
    rows = screened(rows, *count_min(rows, most_bits))
    is_tail = F.coalesce(F.col("pos") >= F.col("tail"), F.lit(False))
    root = prefix_key(F.lit(0), [F.lit(0)] * len(LANES))
    roots = ends.select("id", F.lit(0).cast("bigint").alias("pos"), "size", F.lit(0).cast("bigint").alias("bytes"), root.alias("key"), F.lit(None).cast("binary").alias("parent"))
    shared = rows.where(~is_tail).drop("tail").unionByName(roots)
    tails = rows.where(is_tail)
    heads = tails.where("pos = tail").select("id", "pos", "parent")

    nodes = shared.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n_convs"), F.max("pos").alias("depth"), F.max("parent").alias("parent"), F.max("bytes").alias("bytes"))
    nodes = write_through(nodes, "trie-nodes")
    children = nodes.select("parent").unionByName(heads.select("parent")).where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children.withColumnRenamed("parent", "key"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = write_through(nodes, "trie-counted")

    saved = (F.col("n_convs") - 1) * F.col("bytes")
    carried = nodes.select("id", F.col("depth").alias("pos"), saved.alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaves"))
    carried = carried.unionByName(heads.select("id", (F.col("pos") - 1).alias("pos"), F.lit(0).cast("bigint").alias("saved"), F.lit(1).cast("bigint").alias("leaves")))
    carried = carried.groupBy("id", "pos").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    paths = shared.select("id", "pos", "key").join(carried, ["id", "pos"], "left").fillna(0, ["saved", "leaves"])
    sums = running(paths, ["id"], -F.col("pos"), ["saved", "leaves"]).groupBy("key").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    out = nodes.join(sums, "key").join(end_digests(shared.where("pos = size")), "key", "left")
    parents = nodes.select(F.col("key").alias("parent"), F.col("id").alias("parent_id"))
    out = out.join(parents, "parent", "left").select(
        "id", "depth", "parent_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )
    one, last = F.lit(1).cast("bigint"), F.col("pos") == F.col("size")
    alone = lambda parent: [  # noqa: E731  a node that one conversation alone has
        "id", F.col("pos").alias("depth"), parent.alias("parent_id"), one.alias("n_convs"), (~last).cast("bigint").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"), F.sha2(F.when(last, F.col("id").cast("string")).otherwise("").cast("binary"), 256).alias("ends_sha256"),
    ]
    out = out.unionByName(tails.where("pos > tail").select(*alone(F.col("id"))))
    return out.unionByName(tails.where("pos = tail").join(parents, "parent", "left").select(*alone(F.col("parent_id"))))


def spliced(turns: DataFrame, heads: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """(turns, ends) of conversations that begin with the first turns of another: of each id, the first ``heads`` turns of the
    conversation ``base`` (both expressions of ``id``; ``heads`` at most 8), then its own turns after its first ``heads``."""
    own = turns.groupBy("id").agg(F.max("pos").alias("own"))
    wanted = own.select("id", "own", heads.alias("heads"), base.alias("base"))
    first = turns.where("pos <= 8").select(F.col("id").alias("base"), "pos", "content", "bytes")
    taken = wanted.join(first, "base").where("pos <= heads").select("id", "pos", "content", "bytes")
    lengths = own.select(F.col("id").alias("base"), F.col("own").alias("base_size"))
    ends = wanted.join(lengths, "base", "left").select(
        "id", "heads", F.least("heads", F.coalesce("base_size", F.lit(0))).alias("taken"), F.greatest(F.col("own") - F.col("heads"), F.lit(0)).alias("rest")
    )
    rest = turns.join(ends, "id").where("pos > heads").select("id", (F.col("pos") - F.col("heads") + F.col("taken")).alias("pos"), "content", "bytes")
    return taken.unionByName(rest), ends.select("id", (F.col("taken") + F.col("rest")).alias("size"))

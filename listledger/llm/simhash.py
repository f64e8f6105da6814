"""SimHash near-duplicates by a binary trie self-join.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles. Equal fingerprints are
collapsed first; the distinct ones form a binary trie, which is joined with itself: pairs of nodes are taken down
together, the bits in which they differ are counted, and a pair is dropped once it has used up the error budget.
The upper trie is walked as DataFrame joins, four bits a step, until the two nodes of a pair hold few enough
fingerprints (``leaves``) for one task; the lower trie is walked in tasks. A dense node is thus
split ever deeper, whatever share of the rows it holds, and a fingerprint meets at most 1 + d + d(d-1)/2 nodes at depth d
for a budget of two. A task returns a spanning forest of the links it found, not the links, so a ball of near copies yields
no more rows than it has members; ``components`` joins the forests.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; texts of fewer words than a
shingle have one shingle; repeated rows keep a row each; an empty table gives no rows. A null id takes part in the
linking, but names a component only if no member has an id (then the component id is null)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import fresh, text_rows, words, write_through
from listledger.llm.components import components

SEED = 42
STEP = 4  # bits by which the upper trie is walked


class Majority:
    """Counts set bits of the hashes of many texts, a bounded number of hashes at a time."""

    def __init__(self, texts: int, block: int = 1 << 15):
        self.ones, self.total = np.zeros((texts, 64), np.int64), np.zeros(texts, np.int64)
        self.block, self.held, self.owners, self.lengths = block, [], [], []
        self.size = 0

    def add(self, owner: int, hashes: Iterator[int]) -> None:
        while True:
            part = np.fromiter(islice(hashes, self.block), np.uint64)
            if not len(part):
                return
            self.held.append(part)
            self.owners.append(owner)
            self.lengths.append(len(part))
            self.size += len(part)
            if self.size >= self.block:
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        bits = np.unpackbits(np.concatenate(self.held).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        np.add.at(self.ones, self.owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        np.add.at(self.total, self.owners, self.lengths)
        self.held, self.owners, self.lengths, self.size = [], [], [], 0

    def fingerprints(self) -> np.ndarray:
        self.flush()
        over = (2 * self.ones > self.total[:, None]).astype(np.uint8)
        return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def shingle_hashes(text: str | None, shingle: int) -> Iterator[int]:
    from xxhash import xxh64_intdigest

    found = words(text)
    if 0 < len(found) < shingle:
        return iter((xxh64_intdigest(b" ".join(found), SEED),))
    return (xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(found[k:] for k in range(shingle)))))


def fingerprints(df: DataFrame, shingle: int = 3, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (id, fp): fp is the fingerprint's 64 bits as a bigint."""
    kind = df.schema[id_col].dataType

    def run(batches):
        for ids, texts in text_rows(batches, id_col, text):
            counts = Majority(len(texts))
            for k, t in enumerate(texts):
                counts.add(k, shingle_hashes(t, shingle))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa_kind), pa.array(counts.fingerprints().view(np.int64))], [id_col, "fp"])

    from pyspark.sql.pandas.types import to_arrow_type

    pa_kind = to_arrow_type(kind)
    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, fp bigint")


# ---- the lower trie, in tasks ---------------------------------------------------------------------------------


def _expand(lo_a, n_a, lo_b, n_b):
    """All index pairs of the blocks [lo_a, lo_a + n_a) x [lo_b, lo_b + n_b)."""
    sizes = n_a * n_b
    block = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return lo_a[block] + place // n_b[block], lo_b[block] + place % n_b[block]


def close_pairs(a: np.ndarray, b: np.ndarray, same: bool, depth: int, budget: int, error: int, leaf: int = 16, held: int = 1 << 16):
    """Pairs of indices (i, j) of the sorted fingerprints a and b whose bits differ in at most ``error`` places;
    ``same``: b is a, and each pair comes once. ``depth``: bits that all of a share, and all of b; ``budget``: error left after
    those. Walks at most ``held`` node pairs at a time, deepest first."""
    one = lambda x: np.array([x], np.int64)
    stack = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(budget))]
    while stack:
        d, a0, a1, b0, b1, left = stack.pop()
        if len(a0) > held:
            half = len(a0) // 2
            stack += [(d, a0[:half], a1[:half], b0[:half], b1[:half], left[:half]), (d, a0[half:], a1[half:], b0[half:], b1[half:], left[half:])]
            continue
        small = ((a1 - a0) * (b1 - b0) <= leaf) | (d >= 64)
        if small.any():
            i, j = _expand(a0[small], (a1 - a0)[small], b0[small], (b1 - b0)[small])
            near = np.bitwise_count(a[i] ^ b[j]) <= error
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
        big = ~small
        if not big.any():
            continue
        a0, a1, b0, b1, left = (x[big] for x in (a0, a1, b0, b1, left))
        bit = np.uint64(1) << np.uint64(63 - d)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if d else np.uint64(0)  # the bits of the shared prefix
        mid_a = np.clip(np.searchsorted(a, (a[a0] & above) | bit), a0, a1)
        mid_b = np.clip(np.searchsorted(b, (b[b0] & above) | bit), b0, b1)
        itself = (a0 == b0) if same else np.zeros(len(a0), bool)
        parts = [(a0, mid_a, b0, mid_b, left, None), (mid_a, a1, mid_b, b1, left, None), (a0, mid_a, mid_b, b1, left - 1, None), (mid_a, a1, b0, mid_b, left - 1, ~itself)]
        new = []
        for x0, x1, y0, y1, rest, also in parts:
            keep = (x1 > x0) & (y1 > y0) & (rest >= 0)
            if also is not None:
                keep &= also
            new.append(tuple(x[keep] for x in (x0, x1, y0, y1, rest)))
        stack.append((d + 1, *(np.concatenate(x) for x in zip(*new))))


class Forest:
    """Least member of each group of linked indices."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def _links_of_unit(error: int):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        depth, left = int(unit["depth"].iloc[0]), int(unit["left"].iloc[0])
        side, fp = unit["side"].to_numpy(), unit["fp"].to_numpy().view(np.uint64)
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        same = bool((unit["a"].iloc[0] == unit["b"].iloc[0]))
        forest = Forest(len(a) + len(b))
        for i, j in close_pairs(a, a if same else b, same, depth, left, error):
            forest.link(i, j if same else j + len(a))
        both, root = np.concatenate((a, b)).view(np.int64), forest.root
        linked = root != np.arange(len(root))
        return pd.DataFrame({"u": both[linked], "v": both[root[linked]]})

    return run


# ---- the upper trie, as joins ---------------------------------------------------------------------------------


def prefix(fp: str, depth: int):
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(fps: DataFrame, error: int, leaves: int) -> list[DataFrame]:
    """Pairs of trie nodes (depth, a, b, left), one DataFrame a depth, that hold all pairs of fingerprints within ``error`` bits and
    at most ``leaves`` fingerprints a node."""
    masks = [(m, m.bit_count()) for m in range(1 << STEP) if m.bit_count() <= error]
    flips = F.array(*(F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(w).alias("w")) for m, w in masks))
    count = fps.count()
    pairs = fps.sparkSession.createDataFrame([(0, 0, error, count, count)], "a bigint, b bigint, left int, na bigint, nb bigint")
    out, depth, low = [], 0, (1 << STEP) - 1
    while True:
        small = F.greatest("na", "nb") <= leaves if depth < 64 else F.lit(True)
        out.append(pairs.where(small).select(F.lit(depth).alias("depth"), "a", "b", "left"))
        pairs = pairs.where(~small)
        if pairs.isEmpty():
            return out
        depth += STEP
        nodes = fps.groupBy(prefix("fp", depth).alias("node")).agg(F.count("*").alias("n"))
        nodes = write_through(nodes.withColumn("parent", F.shiftrightunsigned("node", STEP)), "nodes")
        down = pairs.select("a", "b", "left").join(nodes.select(F.col("parent").alias("a"), F.col("node").alias("ca"), F.col("n").alias("na")), "a")
        down = down.select("a", "b", "left", "ca", "na", F.explode(flips).alias("f")).where("f.w <= left")
        down = down.withColumn("cb", F.shiftleft("b", STEP).bitwiseOR(F.col("ca").bitwiseAND(F.lit(low).cast("bigint")).bitwiseXOR(F.col("f.m"))))
        down = down.where("a <> b or ca <= cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"), (F.col("left") - F.col("f.w")).alias("left"), "na")
        pairs = write_through(down.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b").select("a", "b", "left", "na", "nb"), "node-pairs")


def near_links(fps: DataFrame, error: int = 2, leaves: int = 1 << 16) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints in column ``fp`` that connect all pairs within ``error`` bits."""
    parts = []
    for pairs in node_pairs(fps, error, leaves):
        depth = pairs.select("depth").limit(1).collect()
        if not depth:
            continue
        at = fps.select("fp", prefix("fp", depth[0][0]).alias("node"))
        for side, end in ((0, "a"), (1, "b")):
            of = pairs if end == "a" else pairs.where("a <> b")
            parts.append(of.join(at, F.col(end) == F.col("node")).select("depth", "a", "b", "left", F.lit(side).alias("side"), "fp"))
    if not parts:
        return fps.sparkSession.createDataFrame([], "u bigint, v bigint")
    units = parts[0]
    for part in parts[1:]:
        units = units.unionByName(part)
    return units.groupBy("depth", "a", "b").applyInPandas(_links_of_unit(error), "u bigint, v bigint")


def rooted_fingerprints(prints: DataFrame, error: int = 2, leaves: int = 1 << 16, id_col: str = "doc_id") -> DataFrame:
    """Rows (fp, least, root) for each distinct fingerprint of ``prints`` (id, fp): its least id, and a name of its component. Written."""
    fps = write_through(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "fps")
    roots = components(near_links(fps.select("fp"), error, leaves))
    return write_through(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")


def link_fingerprints(prints: DataFrame, error: int = 2, leaves: int = 1 << 16, id_col: str = "doc_id") -> DataFrame:
    """Rows (fp, component_id) for each distinct fingerprint of ``prints`` (id, fp)."""
    rooted = rooted_fingerprints(prints, error, leaves, id_col)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 3, error: int = 2, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (id, fingerprint, component_id), one for each row of ``df``: fingerprint in 16 hex digits, component_id
    the least id among the rows that links reach."""
    prints = write_through(fingerprints(df, shingle, text, id_col), "prints")
    linked = link_fingerprints(prints, error, id_col=id_col)
    return prints.join(linked, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, shingle: int = 3, error: int = 2, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` without near-duplicates: one row of each component stays, so no component is lost. It is the one
    with the least id (rows without an id come last); of different texts under that id the one with the least hash, of equal rows any.

    Rows are known by their id and their text's hash and length, so an id that several texts share keeps each text to its own component.
    Texts go through two exchanges, one to find the survivors and one to drop equal rows."""
    key, size = fresh(df, "_hash"), fresh(df, "_size")
    body = F.coalesce(F.col(text), F.lit(""))
    marked = df.withColumn(key, F.xxhash64(body)).withColumn(size, F.length(body))
    row = fresh(df, "_row")
    names = F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"), F.col(key).alias("hash"), F.col(size).alias("size"))
    prints = fingerprints(marked.select(names.alias(row), text), shingle, text, row)
    prints = write_through(prints.select(F.col(row).alias("name"), "fp"), "prints")
    rooted = rooted_fingerprints(prints, error, id_col="name")
    first = rooted.groupBy("root").agg(F.min("least").alias("least"))
    chosen = first.select(F.col("least.id").alias("_c_id"), F.col("least.hash").alias("_c_hash"), F.col("least.size").alias("_c_size")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_c_id")) & (F.col(key) == F.col("_c_hash")) & (F.col(size) == F.col("_c_size"))
    kept = marked.join(write_through(chosen, "survivors"), same, "left_semi")
    return kept.dropDuplicates([id_col, key, size]).select(*df.columns)

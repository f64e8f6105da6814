"""Sharding by minimax contiguous partition: ordered atomic groups of rows are cut into consecutive shards whose largest
is as small as any cutting allows.

Rows with equal texts are one atomic group (named by the SHA-256 of the text) and stay together. Groups stand in the order of
their least id. A group that alone weighs at least the mean of the shards left takes a shard of its own and stands before the
others, so that the rest is still divided evenly; there are fewer of these than shards. The capacity for the rest is the smallest
feasible one: a binary search, each candidate checked by filling shards greedily.

The groups never come to the driver. A greedy check asks only where, in the ordered running sums, the last boundary at or
below a target lies. The driver holds a bounded sample of boundaries; between two samples the answer is an interval, and a
check then says "feasible", "infeasible" or "not known yet". Only the stretches that leave capacities undecided are sampled more
finely (``LIMIT`` boundaries a round), until the capacity and its cuts are exact: rounds grow with the logarithm of the number of groups.

Defined cases: a null text has no bytes and is in one group with the empty text; repeated rows stay, in one shard; ids may
repeat or be null (a group's least id is of those that are not; a group of null ids alone stands first); fewer groups than shards leave shards empty; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import write_through
from listledger.operators.ordering import dense_positions

#: Boundaries that one round of sampling brings to the driver, at most (and one a stretch more).
LIMIT = 1 << 15


def rows_with_sizes(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, digest): what sharding needs of a row, without its text."""
    body = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
    )


def running_sums(groups: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The groups in order, written with their running number and bytes inside their range (``idx``, ``prefix``: inclusive), and
    per range its number, groups and bytes, which is one row a task."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("first").asc_nulls_first(), F.col("digest")]

    def run(batches):
        at, count, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            size = batch.column(0).to_numpy()
            if not len(size):
                continue
            idx, prefix = count + np.arange(1, len(size) + 1), total + np.cumsum(size)
            count, total = int(idx[-1]), int(prefix[-1])
            columns = [pa.array(np.full(len(size), at)), pa.array(idx), pa.array(prefix), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["pid", "idx", "prefix", "digest"])

    ordered = groups.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("bytes", "digest")
    placed = write_through(ordered.mapInArrow(run, "pid bigint, idx bigint, prefix bigint, digest binary"), "shard-groups")
    ranges = placed.groupBy("pid").agg(F.max("idx"), F.max("prefix")).collect()
    return placed, np.array(sorted(tuple(r) for r in ranges), dtype=np.int64).reshape(-1, 3)


@dataclass
class Boundaries:
    """Known boundaries between groups: bytes before each (``at``) and groups before it (``idx``), both ascending from 0."""

    at: list[int] = field(default_factory=lambda: [0])
    idx: list[int] = field(default_factory=lambda: [0])

    def add(self, points: list[tuple[int, int]]) -> None:
        both = sorted({*zip(self.at, self.idx), *points})
        self.at, self.idx = [a for a, _ in both], [i for _, i in both]

    def gap(self, x: int) -> int | None:
        """The stretch with unknown boundaries that x lies in, if any."""
        j = bisect_right(self.at, x) - 1
        return j if j + 1 < len(self.at) and self.idx[j + 1] - self.idx[j] > 1 and x > self.at[j] else None

    def before(self, x: int, hopeful: bool) -> int:
        """The last boundary at or below x: exact where known, else the least (or, hopeful, the greatest) it can be."""
        j = bisect_right(self.at, x) - 1
        return self.at[j] if self.gap(x) is None or not hopeful else x

    def fill(self, cap: int, shards: int, hopeful: bool) -> list[int]:
        """Where each shard ends when shards of capacity ``cap`` are filled greedily."""
        ends, at = [], 0
        for _ in range(shards):
            at = self.before(at + cap, hopeful)
            ends.append(at)
        return ends

    def least_cap(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        """Binary search: the smallest feasible capacity, where ``high`` is known to be feasible."""
        return low + bisect_left(range(low, high), True, key=lambda cap: self.fill(cap, shards, hopeful)[-1] >= self.at[-1])


def minimax_cuts(known: Boundaries, shards: int, largest: int, finer: Callable[[list[tuple[int, int]]], list[tuple[int, int]]]) -> list[int]:
    """The ends of the shards under the smallest feasible capacity. ``finer`` gives more boundaries inside stretches of bytes."""
    total = known.at[-1]
    low = max(-(-total // shards), largest)
    high = low + largest  # a shard that takes no more group holds more than its share of the bytes: always feasible
    while True:
        low = known.least_cap(low, high, shards, True)
        high = known.least_cap(low, high, shards, False)
        early, late = known.fill(low, shards, False), known.fill(high, shards, True)
        if low == high and early == late:
            return late
        gaps = set()
        for a, b in zip(early, late):
            for j in range(bisect_right(known.at, a) - 1, min(bisect_right(known.at, b), len(known.at) - 1)):
                if known.idx[j + 1] - known.idx[j] > 1:
                    gaps.add(j)
        known.add(finer([(known.at[j], known.at[j + 1]) for j in sorted(gaps)]))


def sampler(placed: DataFrame, ranges: np.ndarray, known: Boundaries, limit: int) -> Callable[[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Reads boundaries inside stretches from the ordered table; ranges without a stretch are pruned by the files' statistics."""
    first_group = dict(zip(ranges[:, 0].tolist(), (np.cumsum(ranges[:, 1]) - ranges[:, 1]).tolist()))
    first_byte = dict(zip(ranges[:, 0].tolist(), (np.cumsum(ranges[:, 2]) - ranges[:, 2]).tolist()))

    def finer(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
        starts = sorted((byte, p) for p, byte in first_byte.items())
        merged: list[list[int]] = []  # (range, after, before), neighbours joined; a stretch lies within one range
        inside = 0
        for a, b in stretches:
            inside += known.idx[bisect_left(known.at, b)] - known.idx[bisect_left(known.at, a)] - 1
            byte, pid = starts[bisect_right(starts, (a, 1 << 62)) - 1]
            if merged and merged[-1][0] == pid and merged[-1][2] == a - byte:
                merged[-1][2] = b - byte
            else:
                merged.append([pid, a - byte, b - byte])
        step = max(1, inside // (limit + len(stretches)))  # some stretch gets a boundary, whatever their sizes
        asked = placed.sparkSession.createDataFrame(merged, "pid bigint, after bigint, below bigint")
        some = placed.where(F.col("pid").isin(sorted({m[0] for m in merged}))).where(F.col("idx") % step == 0).drop("digest")
        found = some.join(F.broadcast(asked), "pid").where("prefix > after and prefix < below").select("pid", "idx", "prefix").collect()
        return [(first_byte[p] + x, first_group[p] + i) for p, i, x in found]

    return finer


def shard_rows(df: DataFrame, shards: int = 16, text: str = "text", id_col: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for each row of ``df``; ``slot`` counts from 0 inside a shard, in the order of the groups."""
    spark = df.sparkSession
    rows = write_through(rows_with_sizes(df, text, id_col), "shard-rows")
    groups = write_through(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.min("id").alias("first")), "shard-sizes")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heaviest = groups.orderBy(F.desc("bytes"), F.asc_nulls_first("first"), "digest").select("digest", "bytes").limit(shards).collect()
    alone: list[bytes] = []
    while len(alone) < min(len(heaviest), shards - 1) and heaviest[len(alone)]["bytes"] * (shards - len(alone)) >= total:
        total -= heaviest[len(alone)]["bytes"]
        alone.append(bytes(heaviest[len(alone)]["digest"]))
    own = spark.createDataFrame([(d, k) for k, d in enumerate(alone)], "digest binary, own bigint")
    rest = groups.join(F.broadcast(own), "digest", "left_anti")
    placed, ranges = running_sums(rest)
    known = Boundaries()
    known.add([(int(b), int(i)) for i, b in zip(np.cumsum(ranges[:, 1]), np.cumsum(ranges[:, 2]))])
    cuts = []
    if total:
        largest = heaviest[len(alone)]["bytes"]
        cuts = minimax_cuts(known, shards - len(alone), largest, sampler(placed, ranges, known, limit))[:-1]
    before = spark.createDataFrame([(int(p), int(i), int(b)) for p, i, b in zip(ranges[:, 0], np.cumsum(ranges[:, 1]) - ranges[:, 1], np.cumsum(ranges[:, 2]) - ranges[:, 2])], "pid bigint, groups bigint, bytes bigint")
    end = F.col("bytes") + F.col("prefix")
    shard = sum(((end > c).cast("bigint") for c in cuts), F.lit(len(alone)).cast("bigint"))
    dealt = placed.join(F.broadcast(before), "pid").select("digest", (F.col("groups") + F.col("idx")).alias("place"), shard.alias("shard"))
    dealt = dealt.unionByName(own.select("digest", (F.col("own") - shards).alias("place"), F.col("own").alias("shard")))
    out = dense_positions(rows.join(dealt, "digest").drop("digest"), ["shard"], ["place", F.col("id").asc_nulls_first(), "size", "text_crc32"], out="slot")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("slot") - 1).alias("slot"))

"""Order as data: per-URL top-N (T1), dense positions inside a table
without sending a whole table to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, limit, max_limit: int) -> DataFrame:
    """First ``limit`` rows per key in ``order``.

    ``limit`` may be a column (per-row limit, e.g. 30 for one source and 50 for
    the rest); ``max_limit`` is its largest value as a literal, which lets the
    planner put a ``WindowGroupLimit`` before the shuffle, so a key holding a
    third of all rows ships at most ``max_limit`` rows per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*[_c(o) for o in order])
    rn = F.row_number().over(w)
    lim = F.lit(limit) if isinstance(limit, int) else _c(limit)
    return df.withColumn("_rn", rn).where((F.col("_rn") <= max_limit) & (F.col("_rn") <= lim)).drop("_rn")


def dense_positions(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "pos",
                    num_partitions: int | None = None) -> DataFrame:
    """Number rows 1..n inside each ``by`` group in ``order`` (ties must not
    occur; add a unique key to ``order``).

    A window partitioned by ``by`` would put a table holding a third of all rows
    into one task. Here the rows are range-partitioned on ``by + order`` (a hot
    group spreads over many partitions), sorted inside each partition, frozen
    in a table written to the checkpoint folder, and each row's number is its index inside its
    partition plus the count of its group in earlier partitions (a table with
    one row per (partition, group), at most partitions + groups rows).
    """
    from ..session import materialize

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(b) for b in by] + [_c(o) for o in order]
    ranged = materialize(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()),
        "positions")
    stats = ranged.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (
        ranged.join(stats.select("_pid", *by, "_off", "_m0"), ["_pid", *by])
        .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))
        .drop("_pid", "_mid", "_off", "_m0")
    )

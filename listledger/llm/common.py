"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listledger.session import materialize, table

#: ``[^\x20\x09-\x0D]+`` splits exactly as ``bytes.split()`` does: on space, \t, \n, \v, \f and \r.
#: Upper-case ASCII letters to lower case, on UTF-8 bytes; other bytes are untouched.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8 bytes (null: none)."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def raw_words(text: str | None) -> list[str]:
    """The words of a text as they stand (null: none)."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()] if text else []


def fold(column: str, n: int) -> Column:
    """``crc32(column as text) mod n``: a stable fold number; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, made from ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    return materialize(df, f"llm-{name}")


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """The batches in parts of at most ``rows`` rows: Python objects are made of a part at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def text_rows(batches: Iterator, *columns: str) -> Iterator[tuple[list, ...]]:
    """Per part of an Arrow batch, its columns as Python lists."""
    for batch in slices(batches):
        yield tuple(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)


def joined(texts: Iterator[str | None], between: str, size: int = 1 << 20) -> Iterator[str]:
    """The texts in strings of at least ``size`` characters (but the last): short ones joined by ``between``, long ones cut."""
    held, n = [], 0
    for text in texts:
        for k in range(0, len(text or ""), size):
            held.append(text[k : k + size])
            n += len(held[-1])
            if n >= size:
                yield between.join(held)
                held, n = [], 0
    if held:
        yield between.join(held)


def fold_runs(df: DataFrame, by: list[str], order: list[str], schema: str, fold: Callable[[Iterator[tuple]], tuple], rows: int = 64) -> DataFrame:
    """One row (``by``, what ``fold`` returns) for each value of ``by``. ``fold`` reads its rows, in ``order``, one after the other
    from the sorted stream of a task, so a group of any size takes the memory of what ``fold`` itself holds."""
    names, given = [c.strip().split(" ")[0] for c in schema.split(",")], df.columns
    places = [given.index(c) for c in by]

    def run(batches):
        stream = (row for columns in text_rows(batches, *given) for row in zip(*columns))
        out = []
        for key, run in groupby(stream, key=lambda row: tuple(row[k] for k in places)):
            out.append((*key, *fold(run)))
            if len(out) == rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def running(df: DataFrame, by: list[str], place: Column, columns: list[str], block: int = 256) -> DataFrame:
    """``df`` with ``columns`` replaced by their running sums inside each ``by`` group, in the order of the integer ``place``,
    inclusive. Two levels (blocks of ``block`` places, then the sums of blocks), so a group of any size is many windows."""
    at, part = fresh(df, "_place"), fresh(df, "_block")
    df = df.withColumn(at, place).withColumn(part, F.floor(F.col(at) / block))
    totals = df.groupBy(*by, part).agg(*(F.sum(c).alias(c) for c in columns))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, part, *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in columns))
    inner = Window.partitionBy(*by, part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    inside = df.select(*(F.sum(c).over(inner).alias(c) if c in columns else F.col(c) for c in df.columns))
    out = inside.join(offsets, [*by, part])
    return out.select(*((F.col(c) + F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns if c not in (at, part)))

"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may be found with up to k = floor(``error`` * n) edits. It is cut into k + 1 pieces; whatever k edits do, one
piece stays whole, so every occurrence holds an exact piece. All pieces are looked up at once in a text (Aho-Corasick), and the
neighbourhood of each hit is verified with Myers' bit-parallel edit distance, on Python's unbounded integers, so an item may
be of any length. Both sides are compared with letters lower-cased and white space squeezed to single blanks.

Test items go to the executors in blocks of at most ``block`` characters, one pass over the texts a block; a block's result is written and
the block released before the next one is sent, so a benchmark of any size needs bounded memory. Texts never leave their partition: there is no
join and no shuffle.

Defined cases: null, empty and blank texts or items match nothing; every other item is searched, however short: one that may have no edits
(under 1 / ``error`` characters) is found where it stands between ends of words; equal items are searched once and reported for the least id; an item or document
without an id is searched too (null id). Hits of one item in one document are one row, with the smallest distance."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listledger.llm.common import slices, text_rows, write_through


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def cut(item: str, pieces: int) -> list[tuple[int, str]]:
    """The item in so many pieces of nearly equal length, with their places."""
    ends = [len(item) * k // pieces for k in range(pieces + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def whole_words(body: str, start: int, end: int) -> bool:
    """Whether body[start:end] neither begins nor ends inside a word."""
    cuts = lambda k: 0 < k < len(body) and body[k - 1].isalnum() and body[k].isalnum()
    return not cuts(start) and not cuts(end)


class Myers:
    """Smallest edit distance between a pattern and any substring of a text, by bit-parallel columns."""

    def __init__(self, pattern: str):
        self.length, self.masks = len(pattern), defaultdict(int)
        for k, c in enumerate(pattern):
            self.masks[c] |= 1 << k

    def best(self, text: str, limit: int) -> int:
        """The distance, or limit + 1 if it is larger."""
        last, every = 1 << (self.length - 1), (1 << self.length) - 1
        plus, minus, score, best = every, 0, self.length, self.length
        masks, n = self.masks.get, len(text)
        for k, c in enumerate(text):
            eq = masks(c, 0)
            diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & every
            up = minus | (every & ~(diagonal | plus))
            down = plus & diagonal
            if up & last:
                score += 1
            elif down & last:
                score -= 1
                if score < best:
                    best = score
                    if not best:
                        break
            if score - (n - 1 - k) > limit and best > limit:
                return limit + 1  # the rest cannot bring it down in time
            up, down = (up << 1) & every, (down << 1) & every  # a match may start anywhere: no cost for the row above
            minus = up & diagonal
            plus = down | (every & ~(diagonal | up))
        return min(best, limit + 1)


class Matcher:
    """Finds approximate occurrences of a block of test items in texts."""

    def __init__(self, items: list[tuple[int | None, str]], error: float):
        import ahocorasick

        self.items, self.limits, self.patterns = items, [int(error * len(t)) for _, t in items], {}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, item) in enumerate(items):
            for at, piece in cut(item, self.limits[k] + 1):
                where[piece].append((k, at))
        self.pieces = ahocorasick.Automaton()
        for piece, places in where.items():
            self.pieces.add_word(piece, (len(piece), places))
        if where:
            self.pieces.make_automaton()

    def distance(self, k: int, window: str) -> int:
        if k not in self.patterns:
            self.patterns[k] = Myers(self.items[k][1])
        return self.patterns[k].best(window, self.limits[k])

    def find(self, text: str | None) -> dict[int, int]:
        """Smallest distance by item, of the items that occur."""
        found: dict[int, int] = {}
        body = normal(text)
        if not body or not len(self.pieces):
            return found
        spans: dict[int, list[int]] = defaultdict(list)  # item -> places where a whole occurrence would start
        for end, (length, places) in self.pieces.iter(body):
            for k, at in places:
                spans[k].append(end - length + 1 - at)
        for k, starts in spans.items():
            item, limit = self.items[k][1], self.limits[k]
            if not limit:
                if any(whole_words(body, s, s + len(item)) for s in starts):
                    found[k] = 0
                continue
            if item in body:
                found[k] = 0
                continue
            starts.sort()
            low = high = None
            for s in [*starts, None]:  # windows that overlap are verified together, once
                if low is not None and (s is None or s - limit > high):
                    d = self.distance(k, body[max(low, 0) : high])
                    if d <= limit:
                        found[k] = min(d, found.get(k, d))
                    low = None
                if s is not None:
                    low, high = (s - limit if low is None else low), s + len(item) + limit
        return found


def searchable(items: DataFrame, text: str = "text", id_col: str = "item_id") -> DataFrame:
    """Rows (id, item): normalised distinct items that are not empty, each with its least id."""

    def run(batches):
        for batch in slices(batches):
            bodies = [normal(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.string())], ["id", "item"])

    found = items.select(id_col, text).mapInArrow(run, T.StructType([T.StructField("id", items.schema[id_col].dataType), T.StructField("item", T.StringType())]))
    return found.where(F.length("item") > 0).groupBy("item").agg(F.min("id").alias("id"))


def blocks(items: DataFrame, block: int):
    """The items as lists of at most ``block`` characters together, one at a time on the driver (a longer item is alone)."""
    held, size = [], 0
    for row in items.orderBy("item").toLocalIterator():
        if held and size + len(row["item"]) > block:
            yield held
            held, size = [], 0
        held.append((row["id"], row["item"]))
        size += len(row["item"])
    if held:
        yield held


def matches(docs: DataFrame, items: DataFrame, error: float = 0.08, block: int = 4 << 20, text: str = "text", id_col: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """Rows (id, item_id, distance), one for each test item found in a row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    kinds = {id_col: docs.schema[id_col].dataType, item_id: items.schema[item_id].dataType}
    schema = T.StructType([*(T.StructField(c, k) for c, k in kinds.items()), T.StructField("distance", T.IntegerType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for part in blocks(searchable(items, id_col=item_id), block):
        shared = sc.broadcast(part)

        def run(batches, shared=shared):
            from pyspark.sql.pandas.types import to_arrow_type

            matcher = Matcher(shared.value, error)
            for ids, texts in text_rows(batches, id_col, text):
                rows = [(i, shared.value[k][0], d) for i, t in zip(ids, texts) for k, d in matcher.find(t).items()]
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], to_arrow_type(kinds[id_col])), pa.array(columns[1], to_arrow_type(kinds[item_id])), pa.array(columns[2], pa.int32())], [id_col, item_id, "distance"])

        out = out.unionByName(write_through(docs.select(id_col, text).mapInArrow(run, schema), "matches"))
        shared.destroy()
    return out


def clean(docs: DataFrame, items: DataFrame, error: float = 0.08, block: int = 4 << 20, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no test item occurs."""
    sc, schema = docs.sparkSession.sparkContext, docs.schema
    for part in blocks(searchable(items), block):
        shared = sc.broadcast(part)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, error)
            for batch in slices(batches):
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                yield batch.filter(pa.array([not matcher.find(t) for t in texts], pa.bool_()))

        docs = write_through(docs.mapInArrow(run, schema), "clean")
        shared.destroy()
    return docs

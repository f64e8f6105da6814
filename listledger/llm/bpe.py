"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding as an incremental
byte-to-text state machine.

A merge list has a *sufficient lookahead*: a number R such that the token boundaries of a
piece up to R bytes before the end of what has been read are the same whatever follows
(``BpeModel.lookahead``). ``Transducer`` buffers R plus one block of bytes, tokenizes the buffer, emits the
tokens that end before the last R bytes and keeps the rest, so a piece of any length takes constant memory.

Why R is enough. Let d be the first position at which the boundaries of two continuations differ
after the rules of some priority have run; before any rule runs, d is the end of the common text. A
rule (u, v) moves d left only where it merges in one continuation and not in the other, to the start of its v.
That start is decided by v itself and by what decided the boundary at the old d: either an earlier rule
whose left side is on the right edge of v's merge tree, or one inside v's tree. So the
distance over which a rule can be influenced is a longest path over rules of falling priority, computed in one pass
over the merge list. It presumes that both sides of a rule are made by earlier rules; ``BpeModel`` checks that.

Defined cases: null text has no tokens and decodes to the empty text; strings of added tokens in a text
become those tokens, as the tokenizers library does unless told otherwise; an id that the model lacks decodes to nothing; byte
sequences that are no UTF-8 decode to U+FFFD per maximal broken part. All other columns pass
through; a column named as an output is replaced."""

from __future__ import annotations

import codecs
import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listledger.llm.common import slices

#: The split into pieces of byte-level BPE models.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class BpeModel:
    """Vocabulary and ranked merges of a byte-level BPE model, with its sufficient lookahead."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        if model.get("type", "BPE") != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE model is asked for")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("prefix spaces and normalizers are not supported")
        to_bytes = lambda token: bytes(letters[c] for c in token)
        ids = {to_bytes(token): k for token, k in model["vocab"].items() if all(c in letters for c in token)}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.bytes_of = {k: token for token, k in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {k: token.encode() for token, k in self.added.items()}
        self.size = 1 + max(self.bytes_of)
        self.rank_of: dict[int, int] = {}  # left id * size + right id -> rank
        self.made: list[int] = []  # rank -> id
        rules = []
        for rank, pair in enumerate(model["merges"]):
            left, right = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            rules.append((left, right))
            self.rank_of.setdefault(ids[left] * self.size + ids[right], rank)
            self.made.append(ids[left + right])
        self.lookahead = sufficient_lookahead(rules)


def sufficient_lookahead(rules: list[tuple[bytes, bytes]]) -> int:
    """The longest distance, in bytes, over which what follows can move a token boundary."""
    made: dict[bytes, tuple[bytes, bytes]] = {}  # token -> its two parts
    after: dict[bytes, int] = {}  # token -> reach of the rules so far that have it on the left
    inside: dict[bytes, int] = {}  # token -> reach, from its start, of the boundaries inside it
    longest = 0
    for left, right in rules:
        if any(len(side) > 1 and side not in made for side in (left, right)):
            raise ValueError(f"a rule uses a token that no earlier rule makes: {left!r} {right!r}")
        reach, edge = max(len(right), inside.get(right, 0)), right
        while True:  # down the right edge of the tree of what is merged on the right
            reach = max(reach, len(right) + after.get(edge, 0))
            if edge not in made:
                break
            edge = made[edge][1]
        after[left] = max(after.get(left, 0), reach)
        made.setdefault(left + right, (left, right))
        inside[left + right] = max(inside.get(left, 0), len(left) + reach, len(left) + inside.get(right, 0))
        longest = max(longest, reach)
    return longest


NONE = 1 << 60  # the rank of a pair that no rule merges


def merge_all(ids: list[int], model: BpeModel) -> list[int]:
    """The tokens of a run of byte ids: the best-ranked pair merges first, the leftmost of equals."""
    rank_of, made, size = model.rank_of.get, model.made, model.size
    if len(ids) > 48:
        return _merge_long(ids, model)
    ranks = [rank_of(a * size + b, NONE) for a, b in zip(ids, ids[1:])]
    while ranks and (best := min(ranks)) < NONE:
        at = ranks.index(best)
        ids[at : at + 2] = [made[best]]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = rank_of(ids[at] * size + ids[at + 1], NONE)
        if at:
            ranks[at - 1] = rank_of(ids[at - 1] * size + ids[at], NONE)
    return ids


def _merge_long(ids: list[int], model: BpeModel) -> list[int]:
    """``merge_all`` by a heap of (rank, place)."""
    rank_of, made, size, n = model.rank_of.get, model.made, model.size, len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, k) for k in range(n - 1) if (rank := rank_of(ids[k] * size + ids[k + 1], NONE)) < NONE]
    heapq.heapify(heap)
    while heap:
        rank, k = heapq.heappop(heap)
        j = after[k]
        if ids[k] < 0 or j >= n or rank_of(ids[k] * size + ids[j], NONE) != rank:
            continue  # one of the two has been merged meanwhile
        ids[k], ids[j] = made[rank], -1
        after[k] = after[j]
        if after[k] < n:
            before[after[k]] = k
            if (rank := rank_of(ids[k] * size + ids[after[k]], NONE)) < NONE:
                heapq.heappush(heap, (rank, k))
        if before[k] >= 0 and (rank := rank_of(ids[before[k]] * size + ids[k], NONE)) < NONE:
            heapq.heappush(heap, (rank, before[k]))
    return [x for x in ids if x >= 0]


class Transducer:
    """Tokens of one piece, fed block by block; holds at most the lookahead and one block of bytes."""

    def __init__(self, model: BpeModel, block: int = 2048):
        self.model, self.block, self.held = model, block, b""

    def feed(self, part: bytes) -> list[int]:
        out, step = [], self.block
        for k in range(0, len(part), step):
            self.held += part[k : k + step]
            if len(self.held) > self.model.lookahead:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        """Tokens that end before the lookahead; a final boundary parts the text, so the rest starts anew."""
        limit, at, out = len(self.held) - self.model.lookahead, 0, []
        for token in self._tokens():
            end = at + len(self.model.bytes_of[token])
            if end > limit:
                break
            out.append(token)
            at = end
        self.held = self.held[at:]
        return out

    def _tokens(self) -> list[int]:
        return merge_all([self.model.single[b] for b in self.held], self.model)

    def finish(self) -> list[int]:
        out, self.held = (self._tokens() if self.held else []), b""
        return out


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit integers. Remembers the tokens of recent short pieces:
    two generations of at most ``remember`` pieces each."""

    def __init__(self, model: BpeModel, window: int = 1 << 16, remember: int = 200_000):
        import regex

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise NotImplementedError("ids are written in this machine's byte order, which must be little-endian")
        self.model, self.window, self.remember = model, window, remember
        self.split = regex.compile(PIECES)
        self.added = re.compile("|".join(re.escape(x) for x in sorted(model.added, key=len, reverse=True)) or r"(?!)")
        self.recent, self.older = self._generation(), {}

    def _generation(self) -> dict:
        encoder = self

        class Recent(dict):
            def __missing__(self, piece: str) -> bytes:
                found = encoder.older.get(piece)
                if found is None:
                    found = b"".join(encoder.piece(piece))
                if len(piece) <= 64:
                    self[piece] = found
                return found

        return Recent()

    def piece(self, piece: str) -> Iterator[bytes]:
        if len(piece) <= 256:  # at most four bytes a character: it fits the transducer's buffer as a whole
            yield array("I", merge_all([self.model.single[b] for b in piece.encode()], self.model)).tobytes()
            return
        run = Transducer(self.model)
        for k in range(0, len(piece), self.window):
            yield np.array(run.feed(piece[k : k + self.window].encode()), "<u4").tobytes()
        yield np.array(run.finish(), "<u4").tobytes()

    def ordinary(self, text: str, start: int, end: int) -> Iterator[bytes]:
        """Ids of text[start:end], which holds no added token, window by window. A piece is known once three
        characters behind it have been read: no alternative of the split looks further."""
        window = self.window
        while start < end:
            stop = min(end, start + window)
            found = self.split.findall(text, start, stop)
            if stop < end:
                cut = stop
                while found and stop - cut < 3:
                    cut -= len(found.pop())
                if not found:  # one piece fills the window
                    window *= 2
                    continue
                stop = cut
            yield b"".join(map(self.recent.__getitem__, found))
            start, window = stop, self.window

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self.recent) > self.remember:
            self.older, self.recent = self.recent, self._generation()
        out, start = [], 0
        for hit in self.added.finditer(text):
            out += self.ordinary(text, start, hit.start())
            out.append(np.array([self.model.added[hit.group()]], "<u4").tobytes())
            start = hit.end()
        out += self.ordinary(text, start, len(text))
        return b"".join(out)


class Decoder:
    """Text of token ids: each id adds its bytes to a UTF-8 state machine that holds an unfinished character only."""

    def __init__(self, model: BpeModel, block: int = 1 << 16):
        self.table, self.block = model.bytes_of, block

    def decode(self, ids: bytes | None) -> str:
        machine, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        known, numbers = self.table.get, np.frombuffer(ids or b"", "<u4")
        for k in range(0, len(numbers), self.block):
            out.append(machine.decode(b"".join([known(i, b"") for i in numbers[k : k + self.block].tolist()])))
        out.append(machine.decode(b"", True))
        return "".join(out)


def read_model(path: str, limit: int = 64 << 20) -> str:
    """The tokenizer file, read on the driver; its size is checked, since it goes to every executor."""
    with open(path, encoding="utf-8") as file:
        text = file.read(limit + 1)
    if len(text) > limit:
        raise ValueError(f"{path} has more than {limit} characters")
    return text


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """``df`` with column ``name`` computed from ``source`` in Arrow batches; ``make`` gives a function per task."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])

    def run(batches):
        one = make()
        for batch in slices(batches):
            values = [one(x) for x in batch.column(batch.schema.get_field_index(source)).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, arrow)], [*kept, name])

    return df.mapInArrow(run, schema)


_CODERS: dict[int, tuple[Encoder, Decoder]] = {}


def _coders(shared) -> tuple[Encoder, Decoder]:
    """The coders of a broadcast file, built once per Python worker; later tasks find the pieces it remembers."""
    key = hash(shared.value)
    if key not in _CODERS:
        _CODERS.clear()
        model = BpeModel(shared.value)
        _CODERS[key] = Encoder(model), Decoder(model)
    return _CODERS[key]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text`` as column ``ids`` (binary: little-endian unsigned 32-bit)."""
    shared = df.sparkSession.sparkContext.broadcast(read_model(path))
    return _with_column(df, text, ids, T.BinaryType(), pa.binary(), lambda: _coders(shared)[0].encode)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids in column ``ids`` as column ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(read_model(path))
    return _with_column(df, ids, text, T.StringType(), pa.string(), lambda: _coders(shared)[1].decode)

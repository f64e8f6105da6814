"""Toxicity with noisy-channel deobfuscation.

Disguised words (letters replaced by digits or signs, spread out by blanks or points, or repeated) are read as a noisy
channel: each token, of any length, spans a lattice of letters and word edges it may stand for, and Viterbi decoding under a character
trigram model picks the likeliest reading, of one word or several. A plain token has one path only, itself, so nothing is decoded for it. The restored words are
scored by evidence weights of the word and its stems, learned from labelled documents, and a logistic
regression turns a document's evidence into a probability.

The character model counts every text. The weights and the regression are fitted on at most ``sample`` labelled rows
(the least hashes of their ids), on separate folds of them. Only the text is an input of a score.

Defined cases: null and empty texts have no words and get the score of a document without evidence; labels other than
0 and 1, and null ones, are not learned from; repeated labels of one id count as the highest; repeated rows are scored alike;
with no labelled rows of either class the score is the base rate (0.5 with none at all)."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listledger.llm.common import fold, fresh, joined, slices, text_rows, write_through

#: Letters of the character model, by code; 0 is a word's edge, 63 any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåæçèéêëìíîïñòóôöõøœùúûüýÿß"
CODES, OTHER = 64, 63
#: What signs are used for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "*": "aeiou",
}
JOINERS = ".-_~·'*"
PUNCTUATION = "!¡("  # signs that may also stand for nothing at a token's ends
COST_SIGN, COST_JOINER, COST_REPEAT, COST_EDGE = 1.0, 0.4, 0.7, 0.4  # of an edit, in nats
MARGIN, SPREAD_MARGIN = 4.0, 6.0  # a reading this much less likely than the best still counts, in nats
LONGEST = 24  # steps of a word among spread letters
STEMS = (4, 5, 6)  # lengths of the word beginnings that carry evidence
LEAST = min(STEMS)

_LETTER = r"[^\W\d_]"
_WORDS = re.compile(f"{_LETTER}+")
_DISGUISE = frozenset(STANDS_FOR) | frozenset(JOINERS)
_IDLE = ".,;:?\"“”„«»‘’)]}[{<>…"  # stand for nothing at a token's ends
_DOUBLE = re.compile(rf"([{re.escape(''.join(STANDS_FOR))}])\1")
_JOINERS = re.compile(f"[{re.escape(JOINERS)}]+")
_REPEATED = re.compile(rf"({_LETTER})\1\1")


def letter_codes() -> np.ndarray:
    """Code of each code point below 0x250; what is no letter is an edge."""
    table = np.array([OTHER if chr(c).isalpha() else 0 for c in range(0x250)], np.int64)
    for k, c in enumerate(LETTERS):
        table[ord(c)] = k + 1
    return table


@dataclass
class CharModel:
    """Character trigrams: interpolated log-probabilities of a letter after two others."""

    logp: np.ndarray  # [CODES, CODES, CODES]
    codes: dict[str, int] = field(default_factory=lambda: {" ": 0, **{c: k + 1 for k, c in enumerate(LETTERS)}})

    @cached_property
    def flat(self) -> list[float]:
        return self.logp.ravel().tolist()

    @staticmethod
    def of_counts(counts: np.ndarray) -> CharModel:
        three = counts.reshape(CODES, CODES, CODES).astype(float)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + CODES)
        p2 = (two + 2 * p1) / (two.sum(-1, keepdims=True) + 2)
        p3 = (three + 4 * p2[None]) / (three.sum(-1, keepdims=True) + 4)
        return CharModel(np.log(p3).astype(np.float32))

    def code(self, letter: str) -> int:
        return self.codes.get(letter, OTHER)


def signs(c: str, run: int, double: bool = False) -> list[tuple[str, float]]:
    """The letters that ``run`` equal signs may stand for: two (``double``: always, of two or more), or one for all."""
    return [(x * n, COST_SIGN * n) for x in STANDS_FOR.get(c, "") for n in ((2,) if double and run > 1 else sorted({1, min(run, 2)}))]


def arcs(token: str, double: bool = False) -> list[list[tuple[str, float]]]:
    """The lattice of a token: per step the letters it may stand for ("" for none, " " for a word's edge), with their costs.
    ``double``: two equal signs or more stand for two letters."""
    out: list[list[tuple[str, float]]] = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        c, run = m[1], len(m[0])
        if c.isalpha():
            if run == 1:
                out.append([(c, 0.0)])
            else:  # once or twice
                out.append([(c, COST_REPEAT * (run > 2) + COST_REPEAT), (c + c, COST_REPEAT * (run > 2))])
            continue
        read = signs(c, run, double)
        if c in JOINERS or c.isspace():
            read += [("", COST_JOINER), (" ", COST_JOINER + COST_EDGE)]
        elif c in PUNCTUATION and (m.start() == 0 or m.end() == len(token)):
            read.append(("", COST_JOINER))
        out.append(read or [("", COST_JOINER), (" ", COST_JOINER + COST_EDGE)])
    return out


def spread_arcs(run: list[str]) -> list[list[tuple[str, float]]]:
    """The lattice of spread letters, a step a letter; of a letter three times or more, two steps."""
    out = []
    for c, n in ((c, len(list(g))) for c, g in groupby(run)):
        read = [(c, 0.0)] if c.isalpha() else signs(c, 1) or [("", COST_JOINER)]
        out.append(read)
        if n > 1:
            out.append([*read, ("", COST_REPEAT)])
    return out


def advance(states: dict, step: list[tuple[str, float]], model: CharModel) -> dict:
    """Viterbi over one step. States are the codes of the last two letters in one number, with the score and reading of the best way to
    them. A reading is a chain of steps, so a step's work does not grow with the token; a letter ends all states alike, so there are few."""
    flat, code = model.flat, model.code
    after: dict[int, tuple[float, tuple | None]] = {}
    ways = [(letters, [code(c) for c in letters], cost) for letters, cost in step]
    for at, (score, read) in states.items():
        for letters, codes, cost in ways:
            to, total = at, score - cost
            for k in codes:
                if k or to % CODES:  # an edge beside an edge is one edge
                    total += flat[to * CODES + k]
                    to = to % CODES * CODES + k
            if to not in after or after[to][0] < total:
                after[to] = (total, (read, letters) if letters else read)
    return after


def ended(states: dict, model: CharModel) -> list[tuple[float, tuple | None]]:
    """Scores and readings with a word's edge after them, the best first."""
    return sorted(((score + (model.flat[at * CODES] if at % CODES else 0.0), read) for at, (score, read) in states.items()), key=lambda s: -s[0])


def spelled(read: tuple | None) -> str:
    out = []
    while read is not None:
        read, letters = read
        out.append(letters)
    return "".join(reversed(out))


def readings(token: str, model: CharModel, margin: float = MARGIN, double: bool = False) -> list[str]:
    """The likeliest reading of a token, then those of other last letters within ``margin`` nats of it."""
    states = {0: (0.0, None)}
    for step in arcs(token, double):
        states = advance(states, step, model)
    ends = ended(states, model)
    return [spelled(read) for score, read in ends if score >= ends[0][0] - margin]


def spread_words(run: list[str], model: CharModel, margin: float = SPREAD_MARGIN) -> list[str]:
    """The words of spread letters: those on a division of the run into words within ``margin`` nats of the likeliest. A word has up
    to LONGEST steps, so the work is linear in the run. A word that is over ``margin`` worse than another way to its end is on no such
    division and is not held."""
    steps = spread_arcs(run)
    arcs_from: list[list[tuple[int, float, tuple | None]]] = []
    left, right = [-math.inf] * (len(steps) + 1), [-math.inf] * (len(steps) + 1)
    left[0] = right[-1] = 0.0
    for i in range(len(steps)):
        states, found = {0: (0.0, None)}, []
        for j in range(i, min(i + LONGEST, len(steps))):
            states = advance(states, steps[j], model)
            for score, read in ended(states, model):
                if left[i] + score < left[j + 1] - margin:
                    break
                left[j + 1] = max(left[j + 1], left[i] + score)
                found.append((j + 1, score, read))
        arcs_from.append(found)
    for i in reversed(range(len(steps))):
        right[i] = max((score + right[j] for j, score, _ in arcs_from[i]), default=-math.inf)
    return [spelled(read) for i, found in enumerate(arcs_from) for j, score, read in found if left[i] + score + right[j] >= right[0] - margin]


def one_word(run: list[str], model: CharModel) -> str:
    """The likeliest reading of spread letters as a single word."""
    states = {0: (0.0, None)}
    for step in spread_arcs(run):
        states = advance(states, step, model)
    return spelled(ended(states, model)[0][1])


def joined_letters(token: str) -> list[list[str]]:
    """Runs of three or more single letters (or signs) of a token with joiners between them."""
    runs = ([single, list(run)] for single, run in groupby(_JOINERS.split(token), key=lambda piece: len(piece) == 1))
    return [run for single, run in runs if single and len(run) > 2]


def decode(token: str, model: CharModel) -> str:
    """The likeliest reading of a token."""
    return readings(token, model, 0.0)[0]


def restore(token: str, model: CharModel | None) -> list[str]:
    """The words of a lower-case token, after deobfuscation where it may be disguised: where it holds a letter and a sign that stands
    for one, a joiner or a letter three times in a row."""
    bare = token.rstrip(".,;:?")
    if bare.isalpha() and not _REPEATED.search(bare):  # most tokens: one path, themselves
        return [bare]
    plain = _WORDS.findall(token)
    core = token.strip(_IDLE)
    if model is None or not plain or not (" " in core or not _DISGUISE.isdisjoint(core) or _REPEATED.search(core)):
        return plain
    if " " in core:
        run = core.split(" ")
        return [*plain, *filter(None, [one_word(run, model), *spread_words(run, model)])]
    found = readings(core, model) + (readings(core, model, double=True) if _DOUBLE.search(core) else [])
    spread = (w for run in joined_letters(core) for w in [one_word(run, model), *spread_words(run, model)] if w)
    return [*plain, *(w for reading in found for w in _WORDS.findall(reading)), *spread]


def spread_letters(tokens: list[str]) -> list[str]:
    """Runs of three or more single letters (or signs), with a blank between them; punctuation at a letter is left out."""
    out, run = [], []
    for t in [*tokens, ""]:
        bare = t if len(t) == 1 else t.strip(_IDLE)
        if len(bare) == 1:
            run.append(bare)
            continue
        if len(run) > 2:
            out.append(" ".join(run))
        run = []
    return out


def tokens_of(text: str | None) -> set[str]:
    found = text.lower().split() if text else []
    return {*found, *spread_letters(found)}


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in STEMS if len(word) >= n)]


@dataclass
class ToxicModel:
    chars: CharModel | None
    weights: dict[str, float]
    coef: np.ndarray | None = None
    base: float = 0.5

    def __post_init__(self):
        self.starts = {f.lstrip("^")[:LEAST] for f in self.weights}

    def evidence(self, word: str) -> float:
        """Mean weight of the word and its stems: a stem that clean documents share speaks for the word."""
        if word[:LEAST] not in self.starts:
            return 0.0
        own = features_of(word)
        return sum(self.weights.get(f, 0.0) for f in own) / len(own)


class Scorer:
    """Evidence of texts; remembers that of recent tokens, in two bounded generations."""

    def __init__(self, model: ToxicModel, remember: int = 120_000):
        self.model, self.remember, self.older = model, remember, {}
        self.recent = self._generation()

    def _generation(self) -> dict:
        scorer, model = self, self.model

        class Recent(dict):
            def __missing__(self, token: str) -> float:
                found = scorer.older.get(token)
                if found is None:
                    found = max(map(model.evidence, restore(token, model.chars)), default=0.0)
                if len(token) <= 256:  # memory: longer ones are decoded anew
                    self[token] = found
                return found

        return Recent()

    def row(self, text: str | None) -> tuple[float, float, float, float]:
        """Largest evidence, log of the number of toxic tokens, their share, and sum of the largest three."""
        if len(self.recent) > self.remember:
            self.older, self.recent = self.recent, self._generation()
        found = tokens_of(text)
        high = sorted((x for x in map(self.recent.__getitem__, found) if x > 1.0), reverse=True)
        return (high[0] if high else 0.0, math.log1p(sum(x > 2.5 for x in high)), sum(x > 2.5 for x in high) / max(len(found), 1), sum(high[:3]))


def count_characters(df: DataFrame, text: str) -> np.ndarray:
    """Trigram counts over all texts: at most CODES ** 3 sums a task, and as many rows for the driver."""

    def run(batches):
        table, total = letter_codes(), np.zeros(CODES**3, np.int64)
        for (texts,) in text_rows(batches, text):
            for part in joined(texts, "  "):
                points = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), "<u4")
                codes = np.concatenate(([0, 0], np.where(points < 0x250, table[np.minimum(points, 0x24F)], 0), [0]))
                total += np.bincount((codes[:-2] * CODES + codes[1:-1]) * CODES + codes[2:], minlength=CODES**3)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    rows = df.select(text).mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n")).collect()
    out = np.zeros(CODES**3)
    for gram, n in rows:
        out[gram] = n
    return out


def count_features(sample: DataFrame, chars: CharModel) -> DataFrame:
    """Rows (feature, pos, neg): labelled documents of either class that hold the feature."""
    shared = sample.sparkSession.sparkContext.broadcast(chars)

    def run(batches):
        counts, model = (Counter(), Counter()), shared.value

        def rows():
            for f in counts[0].keys() | counts[1].keys():
                yield f, counts[1][f], counts[0][f]

        for texts, labels in text_rows(batches, "text", "label"):
            for t, y in zip(texts, labels):
                counts[y].update({f for token in tokens_of(t) for w in restore(token, model) for f in features_of(w)})
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield pa.RecordBatch.from_pylist([dict(zip(("feature", "pos", "neg"), r)) for r in rows()], schema)
                counts[0].clear(), counts[1].clear()
        found = list(rows())
        for k in range(0, len(found), 50_000):
            yield pa.RecordBatch.from_pylist([dict(zip(("feature", "pos", "neg"), r)) for r in found[k : k + 50_000]], schema)

    schema = pa.schema([("feature", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])
    parts = sample.select("text", "label").mapInArrow(run, "feature string, pos bigint, neg bigint")
    return parts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", id_col: str = "doc_id", sample: int = 50_000, least: int = 5) -> ToxicModel:
    """Learn from the labelled rows of ``docs``; the caller leaves out of ``labels`` what must not be learned from.
    ``sample``: most labelled rows used; ``least``: fewest toxic documents that a feature must be in."""
    ids = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("label"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # bounded by the parameter, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(ids), "_id").select("_id", "text", "label")
    rows = write_through(rows.dropDuplicates(["_id"]), "labelled")
    chars = CharModel.of_counts(count_characters(docs, text))
    part = fold("_id", 1000) % 4
    totals = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    base = (pos + 0.5) / (pos + neg + 1)
    if not pos or not neg:
        return ToxicModel(chars, {}, None, base)
    learn = rows.where(part != 0).dropDuplicates(["text"])  # copies of a document are one piece of evidence
    n_pos, n_neg = (learn.where(F.col("label") == y).count() for y in (1, 0))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n_neg + 1.0))
    found = count_features(learn, chars).where(F.col("pos") >= least).select("feature", odds.alias("w")).where("w > 1")
    model = ToxicModel(chars, {r[0]: min(float(r[1]), 8.0) for r in found.collect()}, None, base)
    held = np.array([(*r[1:], r[0]) for r in evidence(rows.where(part == 0), model, "text").select("label", "e").select("label", "e.*").collect()], float)
    if len(held) and 0 < held[:, -1].sum() < len(held):
        model.coef = fit_logistic(held[:, :-1], held[:, -1])
    return model


def evidence(df: DataFrame, model: ToxicModel, text: str, name: str = "e") -> DataFrame:
    """``df`` with the evidence of column ``text`` as a struct of four numbers."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != name]
    fields = ["top", "many", "share", "sum3"]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.StructType([T.StructField(f, T.DoubleType()) for f in fields]))])

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            values = np.array([scorer.row(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()], float).reshape(-1, 4)
            struct = pa.StructArray.from_arrays([pa.array(values[:, k]) for k in range(4)], fields)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), struct], [*kept, name])

    return df.mapInArrow(run, schema)


def score(df: DataFrame, model: ToxicModel, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability that its text is toxic."""
    if model.coef is None:
        return df.withColumn(name, F.lit(float(model.base)))
    own, (bias, *w) = fresh(df, "_evidence"), map(float, model.coef)
    line = F.lit(bias) + sum(F.lit(x) * F.col(f"{own}.{f}") for x, f in zip(w, ("top", "many", "share", "sum3")))
    return evidence(df, model, text, own).withColumn(name, 1 / (1 + F.exp(-line))).drop(own)

"""Personal data by candidate gradient boosting.

Four base detectors (email, ip, card, phone) find exact forms; their spans always stay. Beside them, high-recall generators propose
overlapping spans of the same kinds in looser forms (spelled-out addresses, numbers in other groupings, national phone numbers).
Boosted trees judge every candidate by its format and its context, and a threshold per kind, calibrated on held-out
candidates for a precision of at least ``precision``, selects the spans that are added. Of overlapping candidates the likeliest
stays, then the longest, then the first; none may touch a base span.

Labels come from the base detectors, as rewritten forms: every base finding is rewritten, where it stands, into each of the looser forms of its
kind (``loosened``). The candidate that is exactly the rewritten span is personal data; one of another kind or extent on it is not. A
candidate elsewhere whose form fails the kind's check, or is prose, a list or a part of a longer word, is not personal data; others are not learned
from. Trees are fitted on the candidates of some ``sample`` documents, chosen by a hash of the id. Thresholds come from a fold that the
trees never see: all candidates of a third of all documents, scored in tasks and summed to counts by (kind, score bin, label).

Defined cases: null and empty texts have no spans; repeated rows are judged alike; without candidates of both classes, or
of a kind, no spans of it are added. Offsets are code points, ends exclusive."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm import trees
from listledger.llm.common import slices, text_rows, write_through
from listledger.llm.secrets import sampled

KINDS = ("email", "ip", "card", "phone")

#: The base forms.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED, NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)*"), re.compile(r"[0-9]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: The looser forms of the generators.
SPELLED = re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\{at\}| at )\s?[\w-]{1,64}(?P<dot>\s?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot )\s?)[\w-]{2,24}(?:(?P=dot)[\w-]{2,24}){0,3}", re.I)
DIGITS = re.compile(r"[+(]?[0-9](?:[ ().,/·_-]{0,3}[0-9]){6,}")
QUAD = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\s?[.,·]\s?[0-9]{1,4}){3}(?![0-9])")
_SIGNS = re.compile(r"@|\(at\)|\[at\]|\{at\}| dot | at ", re.I)
#: Words that announce each kind, and words that announce other numbers.
CUES = {
    "email": frozenset("email mail e-mail contact write address".split()),
    "ip": frozenset("ip host server address login from addr".split()),
    "card": frozenset("card visa mastercard amex credit debit payment account".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax dial whatsapp".split()),
}
OTHER_CUES = frozenset("id order invoice isbn ref no number version part item serial tracking total usd eur price".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 14 <= len(d) <= 19 and luhn(d)


def is_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL, in time linear in the text: a name reaches back from its at sign as far as its characters go (to the at sign or the match
    before), and the domain is matched once, right behind the sign."""
    out, at, low = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            low = m.end()
        at = text.find("@", low)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Matches of IP, in time linear in the text: of numbers joined by points, each four in a row."""
    out = []
    for run in DOTTED.finditer(text) if text.count(".") > 2 else ():
        if "." not in run.group():
            continue
        ends = [m.end() for m in NUMBER.finditer(text, *run.span())]
        starts = [run.start(), *(e + 1 for e in ends)]
        out += [(starts[k], ends[k + 3]) for k in range(0, len(ends) - 3, 4)]
    return out


def base_spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base detectors, by start, then in the order of KINDS."""
    if not text:
        return []
    found = [(a, 0, b) for a, b in emails(text)]
    found += [(a, 1, b) for a, b in ips(text) if is_ip(text[a:b])]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def proposals(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the generators; they may overlap, and repeat base spans."""
    out = set()
    for sign in _SIGNS.finditer(text) if "@" in text or "at" in text else ():
        for m in SPELLED.finditer(text, max(0, sign.start() - 65), min(len(text), sign.end() + 200)):
            if m.start() <= sign.start() < m.end() and (sign.group() != " at " or " dot " in m.group().lower() or "." in m.group()):
                out.add((m.start(), "email", m.end()))
    for m in QUAD.finditer(text):
        out.add((m.start(), "ip", m.end()))
    for m in DIGITS.finditer(text):
        n = len(digits_of(m.group()))
        if 13 <= n <= 19:
            out.add((m.start(), "card", m.end()))
        if 7 <= n <= 15:
            out.add((m.start(), "phone", m.end()))
    return sorted(out)


#: How base findings are rewritten: (at, dot) of an address, what joins the parts of an address number and the fours of a card, how the
#: last ten digits of a phone number stand.
LOOSE = {
    "email": [(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" @ ", ".")],
    "ip": [" . ", "·", ". ", " ."],
    "card": [".", "/", "_", " - "],
    "phone": ["({}) {}-{}", "{}.{}.{}", "{}-{}-{}", "{} {} {}"],
}
VARIANTS = 4


def loosened(text: str, variant: int) -> tuple[str, list[tuple[int, str, int]]]:
    """``text`` with its base findings rewritten into the looser forms number ``variant``, and where these stand. Of overlapping findings the first is taken."""
    out, planted, at, size = [], [], 0, 0
    for a, kind, b in base_spans(text):
        if a < at:
            continue
        value, form = text[a:b], LOOSE[kind][variant]
        if kind == "email":
            name, _, domain = value.partition("@")
            value = name + form[0] + domain.replace(".", form[1])
        elif kind == "ip":
            value = value.replace(".", form)
        elif kind == "card":
            value = form.join(re.findall("[0-9]{1,4}", digits_of(value)))
        else:
            d = digits_of(value)[-10:]
            value = form.format(d[:3], d[3:6], d[6:])
        out += [text[at:a], value]
        size += a - at
        planted.append((size, kind, size + len(value)))
        size += len(value)
        at = b
    return "".join([*out, text[at:]]), planted


def denied(kind: str, value: str, before: str, after: str) -> bool:
    """Whether a form as it stands in a text cannot be personal data of the kind."""
    if before.isalnum() or after.isalnum():
        return True
    if kind == "email":
        return " at " in value.lower() and re.search(r"dot", value, re.I) is None
    if kind == "ip":
        return "," in value or not is_ip(re.sub(r"\s?[.·]\s?", ".", value))
    if kind == "card":
        return not is_card(value)
    groups = NUMBER.findall(value)
    return len(groups) == 1 or "," in value or len(digits_of(value)) < 9 or max(map(len, groups)) < 3 or re.match(r"\(?(19|20)[0-9]{2}[-./]?[0-9]{2}[-./ ]", value) is not None


def labelled(text: str | None) -> list[tuple[str, list[float], int]]:
    """(kind, features, label) of the candidates of a text, and of its rewritten forms, whose label is known."""
    out = []
    for variant in range(VARIANTS if text else 0):
        loose, planted = loosened(text, variant)
        if variant and not planted:
            break  # without base findings, all variants are the text itself
        meant, exact = Spans([(a, b) for a, _, b in planted]), Spans([(a, b) for a, _, b in base_spans(loose)])
        for a, kind, b, x in candidate_rows(loose):
            if (a, kind, b) in planted:
                out.append((kind, x, 1))
            elif meant.meets(a, b):
                out.append((kind, x, 0))
            elif not variant and not exact.meets(a, b) and denied(kind, loose[a:b], loose[a - 1 : a] if a else "", loose[b : b + 1]):
                out.append((kind, x, 0))
    return out


FEATURES = "email ip card phone digits groups longest shortest plus paren dots dashes blanks length luhn parts distinct lead before after cue other_cue near edge brackets spelled gap".split()


def features(text: str, start: int, kind: str, end: int, others: int) -> list[float]:
    value = text[start:end]
    groups = re.findall(r"[0-9]+", value)
    d = "".join(groups)
    words = [w.lower() for w in re.findall(r"[\w-]+", text[max(0, start - 40) : start])[-3:]]
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    parts = [int(g[:6]) for g in groups]
    return [
        *(float(kind == k) for k in KINDS),
        float(len(d)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float("+" in value),
        float("(" in value),
        float(value.count(".")),
        float(value.count("-")),
        float(value.count(" ")),
        float(len(value)),
        float(13 <= len(d) <= 19 and luhn(d)),
        float(len(parts) == 4 and max(parts) <= 255),
        float(len(set(d))),
        float(d[:1] == "0"),
        float(before.isalnum() or before in ("$", "#", "€", "£")),
        float(after.isalnum() or after in ("%",)),
        float(any(w in CUES[kind] for w in words)),
        float(any(w in OTHER_CUES for w in words)),
        float(others),
        float(not before or before == "\n"),
        float(sum(value.count(c) for c in "([{")),
        float(" dot " in value.lower()),
        float(". " in value),
    ]


def candidate_rows(text: str | None) -> list[tuple[int, str, int, list[float]]]:
    if not text:
        return []
    found = proposals(text)
    starts = [a for a, _, _ in found]
    return [(a, k, b, features(text, a, k, b, bisect_left(starts, a + 200) - bisect_right(starts, a - 200) - 1)) for a, k, b in found]


def learned_rows(docs: DataFrame, text: str) -> DataFrame:
    """Rows (kind, x, label) of the candidates whose label is known."""

    def run(batches):
        for (texts,) in text_rows(batches, text):
            columns = list(zip(*(row for t in texts for row in labelled(t)))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.float64())), pa.array(columns[2], pa.int32())], ["kind", "x", "label"])

    return docs.select(text).mapInArrow(run, "kind string, x array<double>, label int")


EDGES = np.arange(1000) / 1000  # lower edges of the score bins


def score_counts(docs: DataFrame, model: trees.Trees, text: str) -> DataFrame:
    """Rows (kind, bin, n, hits): how many labelled candidates of ``docs`` score in a bin, and how many of them are personal data."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for (texts,) in text_rows(batches, text):
            rows = [row for t in texts for row in labelled(t)]
            bins = np.searchsorted(EDGES, shared.value.probability(np.array([x for _, x, _ in rows])), side="right") - 1 if rows else []
            seen = Counter((k, int(i), y) for (k, _, y), i in zip(rows, bins))
            columns = list(zip(*((k, i, n, n * y) for (k, i, y), n in seen.items()))) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["kind", "bin", "n", "hits"])

    return docs.select(text).mapInArrow(run, "kind string, bin bigint, n bigint, hits bigint").groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


@dataclass
class PiiModel:
    trees: trees.Trees
    thresholds: dict[str, float]  # kinds without one get no added spans
    held: dict[str, tuple[float, float, int]] = field(default_factory=dict)  # per kind, on the held-out fold at its threshold: precision, recall, candidates taken


def calibrate(p: np.ndarray, y: np.ndarray, precision: float, least: int = 20, n: np.ndarray | None = None) -> float | None:
    """The lowest threshold of one half or more whose held-out candidates at or over it are personal data in a share of at least ``precision``,
    by the lower end of Wilson's interval, put halfway to the next candidate below; None if there is none. ``p``: scores; ``y``: labels, or
    with ``n`` hits among ``n`` candidates."""
    order = np.argsort(-p, kind="stable")
    p, hits, n = p[order], np.cumsum(y[order]), np.cumsum(np.ones(len(p)) if n is None else n[order])
    share, z = hits / n, 1.64
    lower = (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    last = np.append(p[:-1] > p[1:], True)  # a threshold takes all of equal scores
    good = np.nonzero(last & (p >= 0.5) & (lower >= precision) & (n >= least))[0]
    if not len(good):
        return None
    below = p[good[-1] + 1] if good[-1] + 1 < len(p) else 0.0
    return max(0.5, float(p[good[-1]] + below) / 2)


def train(docs: DataFrame, sample: int = 40_000, precision: float = 0.9, text: str = "text", id_col: str = "doc_id") -> PiiModel:
    held_out = F.pmod(F.coalesce(F.xxhash64(F.lit("held out"), F.col(id_col)), F.lit(0)), F.lit(3)) == 0
    rows = write_through(learned_rows(sampled(docs.where(~held_out), sample, id_col), text), "candidates")
    if not trees.both_classes(rows):
        return PiiModel(trees.constant(0.0), {})
    model = PiiModel(trees.boosted_trees(rows), {})
    counts = score_counts(docs.where(held_out), model.trees, text).collect()  # at most a row a kind and bin
    for kind in KINDS:
        own = [r for r in counts if r["kind"] == kind]
        p, n, hits = EDGES[[r["bin"] for r in own]], np.array([r["n"] for r in own]), np.array([r["hits"] for r in own])
        if own and (t := calibrate(p, hits, precision, n=n)) is not None:
            model.thresholds[kind], over = t, p >= t
            model.held[kind] = float(hits[over].sum() / n[over].sum()), float(hits[over].sum() / hits.sum()), int(n[over].sum())
    return model


class Spans:
    """Spans by their starts, where a span is looked up by its neighbours; spans that overlap are taken as one."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.add(a, b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def spans_of(text: str | None, model: PiiModel) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """The base spans, and all spans: base ones and those that the model adds."""
    base = base_spans(text)
    found = [c for c in candidate_rows(text) if c[1] in model.thresholds]
    if not found:
        return base, base
    p = model.trees.probability(np.array([c[3] for c in found]))
    exact, taken, added = Spans([(a, b) for a, _, b in base]), Spans([]), []
    for q, _, a, k, b in sorted((-q, a - b, a, k, b) for q, (a, k, b, _) in zip(p, found) if q >= model.thresholds[k]):
        if not exact.meets(a, b) and not taken.meets(a, b):
            taken.add(a, b)
            added.append((a, k, b))
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[1])))


def find(docs: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """``docs`` without its text, with base and spans: arrays of (kind, start, end)."""
    shared, kept = docs.sparkSession.sparkContext.broadcast(model), [c for c in docs.columns if c not in (text, "base", "spans")]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in slices(batches):
            found = [spans_of(t, shared.value) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            made = [pa.array([[{"kind": k, "start": a, "end": b} for a, k, b in f[i]] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *made], [*kept, "base", "spans"])

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.select(*kept, text).mapInArrow(run, ", ".join([*fields, f"base {span}", f"spans {span}"]))


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one mark, the first one's."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])

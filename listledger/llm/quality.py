"""Quality rules with risk-controlled thresholds.

Each rule measures one thing of a text (more is worse) and rejects what is over its cutoff. Cutoffs are chosen per stratum on
labelled good documents: from the mildest on, a cutoff is taken while the exact (Clopper-Pearson) upper bound of its share of
falsely rejected good documents stays under ``risk`` divided by the number of rules, so that all rules together reject at most a share
``risk`` of the good documents of a stratum. The bounds hold together with probability 1 - ``miss``: Bonferroni over strata
and rules, and the fixed order within a rule, which needs no further correction since testing stops at the first failure.
A rule without a safe cutoff in a stratum (too few labels) is off there.

Defined cases: null, empty and blank texts have no words and zeros throughout (and fail the base check on length); a null stratum is a
stratum of its own; labels other than 1 and null ones are no good documents, and of repeated labels of an id the least counts;
repeated rows are judged alike; without labels all rules are off and only the base check rejects."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import slices, text_rows, write_through

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_NO_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
_ENDS = (".", "!", "?", '"', "”", "»", "…", ":", ";")

#: Rules and their cutoffs, from the mildest on.
SHARES = (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02, 0.01)
CUTOFFS = {
    "symbols": (4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02, 0.01),
    "dup_lines": SHARES,
    "repetition": (0.98, 0.96, 0.94, 0.92, 0.9, 0.88, 0.85, 0.82, 0.8, 0.77, 0.74, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4),
    "long_words": (40.0, 30.0, 25.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.75, 6.5),
    "short_words": (-1.0, -1.5, -2.0, -2.5, -2.75, -3.0, -3.25, -3.5, -3.75, -4.0, -4.2, -4.4),
    "non_letters": SHARES,
    "capitals": SHARES,
    "open_lines": SHARES,
}


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the rules' values in the order of CUTOFFS."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * 5 + (0.0,) * len(CUTOFFS)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines, seen, dup, open_lines = 0, set(), 0, 0
    for line in text.split("\n"):
        bare = line.strip(SPACES)
        if bare:
            lines += 1
            dup += line in seen
            seen.add(line)
            open_lines += not bare.endswith(_ENDS)
    windows = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(windows)) < len(windows):
        often, upto = Counter(windows), 0
        for k, w in enumerate(windows):
            if often[w] > 1:
                repeat += k + 3 - max(k, upto)
                upto = k + 3
    letters = len(raw.translate(None, _NO_LETTERS))
    body = len(raw) - sum(raw.count(c.encode()) for c in SPACES)
    return (
        n, chars, symbols, dup, repeat,
        symbols / n, dup / lines, 1 - len(set(words)) / n, chars / n, -chars / n,
        1 - letters / body, len(raw.translate(None, _NO_CAPITALS)) / max(letters, 1), open_lines / lines,
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, *kept: str, text: str = "text") -> DataFrame:
    """The columns ``kept`` of ``docs`` with the counts and the rules' values of its texts."""
    names = [*COUNTS, *CUTOFFS]

    def run(batches):
        for batch in slices(batches):
            rows = list(zip(*map(measure, batch.column(batch.schema.get_field_index(text)).to_pylist()))) or [()] * len(names)
            made = [pa.array(r, pa.int64() if k < len(COUNTS) else pa.float64()) for k, r in enumerate(rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *made], [*kept, *names])

    fields = [*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} bigint" for c in COUNTS), *(f"{c} double" for c in CUTOFFS)]
    return docs.select(*kept, text).mapInArrow(run, ", ".join(fields))


def at_most(k: int, n: int, p: float) -> float:
    """Probability of at most k successes in n trials. Terms are summed from the likeliest one on, each from the one before it, until they
    no longer count: some sqrt(n) of them, whatever k is."""
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    start, odds = min(k, int((n + 1) * p)), p / (1 - p)
    first = math.exp(math.lgamma(n + 1) - math.lgamma(start + 1) - math.lgamma(n - start + 1) + start * math.log(p) + (n - start) * math.log1p(-p))
    total, term, i = 0.0, first, start
    while i >= 0 and term > total * 1e-17:
        total, term, i = total + term, term * i / ((n - i + 1) * odds), i - 1
    term, i = first * (n - start) * odds / (start + 1), start + 1
    while i <= k and term > total * 1e-17:
        total, term, i = total + term, term * (n - i) * odds / (i + 1), i + 1
    return min(total, 1.0)


def upper_bound(k: int, n: int, miss: float) -> float:
    """Exact upper confidence bound of a share, k of n seen, that is too low with probability ``miss`` at most."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if at_most(k, n, p) > miss else (low, p)
    return high


def cutoffs(good: DataFrame, risk: float = 0.08, miss: float = 0.05) -> DataFrame:
    """Rows (stratum, rule, cutoff) from the good documents' rows (stratum, and a column for each rule)."""
    each = risk / len(CUTOFFS)
    over = [F.sum((F.col(r) > c).cast("bigint")).alias(f"{r}_{k}") for r, cs in CUTOFFS.items() for k, c in enumerate(cs)]
    table = write_through(good.groupBy("stratum").agg(F.count("*").alias("n"), *over), "holdout")
    tests = max(1, table.count()) * len(CUTOFFS)

    def choose(parts):
        for rows in parts:
            found = []
            for row in rows.to_dict("records"):
                for rule, values in CUTOFFS.items():
                    safe = None
                    for k, cutoff in enumerate(values):
                        wrong = int(row[f"{rule}_{k}"])
                        if wrong > each * row["n"] or upper_bound(wrong, int(row["n"]), miss / tests) > each:
                            break
                        safe = cutoff
                    if safe is not None:
                        found.append((row["stratum"], rule, safe))
            yield pd.DataFrame(found, columns=["stratum", "rule", "cutoff"]).astype({"cutoff": float})

    return table.mapInPandas(choose, "stratum string, rule string, cutoff double")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", label: str = "quality", risk: float = 0.08, miss: float = 0.05, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, counts, rules' values, base_failed, failed: rules that reject, kept), one for each row of ``docs``."""
    rows = docs.select(F.col(id_col), F.col(stratum).cast("string").alias("_stratum"), "text")
    rows = write_through(measures(rows, id_col, "_stratum").withColumnRenamed("_stratum", "stratum"), "measures")
    good = labels.groupBy(id_col).agg(F.min(label).alias("_label")).where("_label = 1").select(id_col)
    limits = cutoffs(rows.join(good, id_col, "left_semi"), risk, miss)
    limits = write_through(limits.groupBy("stratum").pivot("rule", list(CUTOFFS)).agg(F.max("cutoff")), "cutoffs")
    limits = limits.select(F.col("stratum").alias("_of"), *(F.col(r).alias(f"{r}_cutoff") for r in CUTOFFS))
    out = rows.join(limits, F.col("stratum").eqNullSafe(F.col("_of")), "left").drop("_of")
    failed = F.array_compact(F.array(*(F.when(F.col(r) > F.col(f"{r}_cutoff"), r) for r in CUTOFFS)))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", base).withColumn("failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop(*(f"{r}_cutoff" for r in CUTOFFS))

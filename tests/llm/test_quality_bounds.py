"""Binomial tails against exact fractions, their cost, and strata that are null."""

import random
import time
from fractions import Fraction
from math import comb

import pytest

from listledger.llm import quality


def exact(k, n, p):
    p = Fraction(p)
    return float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1)))


@pytest.mark.parametrize("seed", range(60))
def test_tails_are_exact(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 7, 60, 250])
    k, p = rng.randrange(n + 1), rng.choice([rng.random(), rng.random() / 50, 1 - rng.random() / 50])
    assert quality.at_most(k, n, p) == pytest.approx(exact(k, n, p), rel=1e-9, abs=1e-300)


def test_bounds_of_large_holdouts_are_cheap():
    start = time.time()
    bound = quality.upper_bound(10_000, 1_000_000, 0.01)
    assert 0.0102 < bound < 0.0103  # 2.33 standard errors of a share of 1 %
    assert quality.upper_bound(300_000, 10_000_000, 1e-6) > 0.03
    assert time.time() - start < 3


def test_a_null_stratum_is_its_own(spark):
    clean = " ".join(f"plain{k} text" for k in range(40)) + "."
    odd = clean + " #$%" * 40
    docs = [(k, None if k % 2 else "", clean) for k in range(4000)] + [(4001, None, odd), (4002, "", odd)]
    labels = [(k, 1) for k in range(1, 4000, 2)]  # all of them in the null stratum
    got = quality.judge(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    verdicts = {r["doc_id"]: (r["stratum"], r["kept"]) for r in got.collect()}
    assert len(verdicts) == 4002
    assert verdicts[4001] == (None, False) and verdicts[4002] == ("", True)
    assert verdicts[1] == (None, True) and verdicts[2] == ("", True)

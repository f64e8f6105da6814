"""The template tree on deep paths: rounds follow the templates that divide, not the segments of a path."""

import random
import time

import pytest

from listledger.llm import urlfilter
from tests.llm.test_url_tree import check, hot_host


def deep_urls(rng):
    """Levels at which all children of a node are rare, one after the other; siblings at several levels, labelled and not; paths that
    end at every level of a chain."""
    urls = ["http://wild.net/" + "/".join(f"w{rng.randrange(10**9)}x" for _ in range(rng.choice([9, 9, 9, 14]))) for _ in range(90)]
    urls += [f"http://wild.net/es/{'/'.join(f'q{rng.randrange(10**9)}y' for _ in range(5))}" for _ in range(60)]
    urls += ["http://comb.net/" + "/".join("a" * k) + rng.choice(["", "/b", "/fr"]) for k in range(40) for _ in range(2)]
    for _ in range(700):
        middle = [rng.choice(["es", "fr", "en"]), rng.choice("ab"), "same", rng.choice("cd"), rng.choice([f"u{rng.randrange(99)}v", "top", "top"]), rng.choice("ef")]
        urls.append(f"http://{rng.choice(['s.net', 's.net', 'www.example.com', 'far.org'])}/{'/'.join(middle[: rng.choice([6, 6, 4])])}")
    return urls


@pytest.mark.parametrize("seed", [1, 2])
def test_deep_templates_with_back_off(spark, seed):
    assert {"allow", "block"} == set(check(spark, deep_urls(random.Random(seed)), backoff=True))


def test_long_labelled_siblings(spark):
    """Two templates of 300 segments with labels, which differ at two levels, beside a hot host."""
    path = [f"p{chr(97 + k % 26)}q" for k in range(300)]
    twin = [*path[:100], "x", *path[101:200], "y", *path[201:]]
    urls = hot_host()[:300] + [f"http://long.net/es/{'/'.join(p)}" for p in (path, twin) for _ in range(12)]
    check(spark, urls + [f"http://long.org/es/{'/'.join(path)}"] * 3, backoff=True)


def test_a_path_of_5000_segments(spark):
    short = [(k, f"http://a.net/{'es' if k % 2 else 'en'}/{k}") for k in range(200)]
    rows = [*short, (-1, "http://a.org/" + "/".join(f"s{k}t" for k in range(5000))), (-2, "http://a.net/es/" + "a/" * 5000)]
    times = []
    for given in (short, rows):
        start = time.time()
        got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark.createDataFrame(given, "page_id bigint, url string"), backoff=True).collect()}
        times.append(time.time() - start)
    assert len(got) == len(rows) and got[-2] == "block"
    assert times[1] < times[0] + 60  # not a round a segment

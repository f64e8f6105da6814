"""The template tree's verdicts against a plain Python tree, over whole tables and a made-up hot host."""

import random
import re
from collections import defaultdict

import pytest

from listledger.llm import urlfilter

SF = "/root/testdata/sf0.01"


def mask(segment):
    segment = re.sub(r"^[0-9]+(-[0-9]+)*(?=$|\.)", "{n}", segment)
    return re.sub(r"^(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F]{8,}(-[0-9a-fA-F]{4,})*(?=$|\.)", "{x}", segment)


def templates_of(urls, fan=20, rare=0.02):
    """The pages (host, segments, verdict of the rules), the counts of each leaf (pages, blocked, labelled) and its template."""
    rules = sorted(urlfilter.RULES, key=lambda r: -len(r[0]) - len(r[1]))
    pages = []
    for url in urls:
        m = re.fullmatch(r"(?s).*?://([^/?#]*)([^?#]*).*", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        verdict = next((v for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)), None)
        pages.append((host, tuple(mask(s) for s in path.split("/")), verdict))
    leaves = defaultdict(lambda: [0, 0, 0])
    for host, segments, verdict in pages:
        leaf = leaves[host, segments]
        leaf[0] += 1
        leaf[1] += verdict == "block"
        leaf[2] += verdict is not None
    template = {leaf: "" for leaf in leaves}
    for d in range(max((len(s) for _, s in leaves), default=0)):
        counts = defaultdict(lambda: defaultdict(int))
        for (host, segments), t in template.items():
            if len(segments) > d:
                counts[host, t][segments[d]] += leaves[host, segments][0]
        new = {}
        for (host, segments), t in template.items():
            if len(segments) > d:
                node = counts[host, t]
                wild = len(node) > fan and node[segments[d]] < rare * sum(node.values())
                t = f"{t}/{'{*}' if wild else segments[d]}"
            new[host, segments] = t
        template = new
    return pages, leaves, template


def plain(urls, z=2.0, least=10, prior=2.0, reject=0.8):
    """Verdict of each url (distinct urls count as often as they are given)."""
    pages, leaves, template = templates_of(urls)
    sums = defaultdict(lambda: [0, 0])
    for (host, segments), t in template.items():
        for k in (0, 1):
            sums[host, t][k] += leaves[host, segments][k + 1]
    rest = {t: re.sub(r"(?s)^/[^/]*/[^/]*", "", t, count=1) for _, t in sums}
    pool = defaultdict(lambda: [0, 0])
    for (host, t), (block, n) in sums.items():
        if n >= least:
            pool[host, rest[t]][0] += block
            pool[host, rest[t]][1] += n
    branch, total = {}, defaultdict(lambda: [0, 0])
    for (host, t), (block, n) in sums.items():
        branch[host, t] = t
        if n >= least:
            p = pool[host, rest[t]][0] / pool[host, rest[t]][1]
            if abs(block / n - p) <= z * (p * (1 - p) / n + 0.25 / n**2) ** 0.5:
                branch[host, t] = "/{+}" + rest[t]
        total[host, branch[host, t]][0] += block
        total[host, branch[host, t]][1] += n
    out = []
    for host, segments, verdict in pages:
        block, n = total[host, branch[host, template[host, segments]]]
        out.append(verdict or ("block" if (block + prior / 2) / (n + prior) > reject else "allow"))
    return out


def plain_backoff(urls, z=2.0, least=10, prior=2.0, doubt=0.05, reject=0.8):
    """The verdicts of the registered query: siblings merged at every level, templates that back off to their parents and to other hosts."""
    pages, leaves, template = templates_of(urls)
    sums = defaultdict(lambda: [0, 0, 0])
    for leaf, t in template.items():
        for k in range(3):
            sums[leaf[0], t][k] += leaves[leaf][k]
    branch = {key: key[1] for key in sums}
    for at in range(2, max((len(t.split("/")) for _, t in sums), default=0)):
        counts, pool = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for (host, t), (_, block, n) in sums.items():
            counts[host, branch[host, t]][0] += block
            counts[host, branch[host, t]][1] += n
        key = {}
        for (host, b), (block, n) in counts.items():
            parts = b.split("/")
            if len(parts) > at and n >= least:
                key[host, b] = "/".join([*parts[:at], "{+}", *parts[at + 1 :]])
                pool[host, key[host, b]][0] += block
                pool[host, key[host, b]][1] += n
        for (host, t), b in branch.items():
            if (host, b) in key:
                block, n = counts[host, b]
                share = pool[host, key[host, b]][0] / pool[host, key[host, b]][1]
                if abs(block / n - share) <= z * (share * (1 - share) / n + 0.25 / n**2) ** 0.5:
                    branch[host, t] = key[host, b]
    own, every = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0])
    paths = {t: ["/".join(t.split("/")[:k]) for k in range(2, len(t.split("/")) + 1)] for _, t in sums}
    for (host, t), (n, block, known) in sums.items():
        for node in paths[t]:
            for k, x in enumerate((n, block, known)):
                own[host, node][k] += x
            every[node][0] += block
            every[node][1] += known
    total = defaultdict(lambda: [0, 0, 0])
    for (host, t), counts in sums.items():
        for k in range(3):
            total[host, branch[host, t]][k] += counts[k]

    def back(host, t):
        here, others = None, 0.5
        for node in paths[t]:
            n, block, known = own[host, node]
            others = (every[node][0] - block + prior * others) / (every[node][1] - known + prior)
            share = ((others if here is None else here) + others) / 2
            weight = prior + doubt * (n - known)
            here = (block + weight * share) / (known + weight)
        return share

    out = []
    for host, segments, verdict in pages:
        t = template[host, segments]
        n, block, known = total[host, branch[host, t]]
        weight = prior + doubt * (n - known)
        out.append(verdict or ("block" if (block + weight * back(host, t)) / (known + weight) > reject else "allow"))
    return out


def check(spark, urls, backoff=False):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df, backoff=backoff).select("page_id", "verdict").collect()}
    want = plain_backoff(urls) if backoff else plain(urls)
    assert [got[k] for k in range(len(urls))] == want
    return want


def test_the_given_pages(spark):
    check(spark, [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()])


def hot_host():
    rng = random.Random(4)
    urls = [None, "x", "http://h"]
    for _ in range(900):  # a third and more on one host: rules, wild branches, unlabelled siblings
        host = rng.choice(["spam.net", "spam.net", "spam.net", "a.example.com", "b.org", "www.example.com", "c.net"])
        head = rng.choice(["es", "fr", "en", "de", f"user{rng.randrange(200)}", "es/offer", "en/offer"])
        urls.append(f"http://{host}/{head}/{rng.choice(['1', '77', 'deadbeef01', '2024-01-02', 'about', f'x{rng.randrange(60)}y'])}{rng.choice(['', '/', '.html', '?q=1'])}")
    return urls


def test_a_hot_host_with_many_branches(spark):
    assert {"allow", "block"} == set(check(spark, hot_host()))


def test_back_off_on_a_hot_host(spark):
    assert {"allow", "block"} == set(check(spark, hot_host(), backoff=True))


def test_the_registered_query(spark):
    from listledger.llm.queries import QUERIES

    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r["verdict"] for r in QUERIES["op6_urls"](spark, SF).select("page_id", "verdict").collect()}
    assert [got[r["page_id"]] for r in pages] == plain_backoff([r["url"] for r in pages])


@pytest.mark.parametrize("urls", [[], ["http://net/es/1"] * 3])
def test_small_tables(spark, urls):
    check(spark, urls) if urls else None

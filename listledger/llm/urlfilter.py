"""URL filters: host rules, and a path-template tree for the rest, on DataFrame functions only.

Rules (host, path prefix, verdict) fit their host and all its subdomains; the longest wins. Where none fits, the verdict is the
template tree's: per host, variable path segments become wildcards (by their form, and where a node has many rare
children), sibling branches of every level whose labelled shares are statistically alike are merged, and a template is
rejected if its smoothed share of blocked labelled pages is over a threshold. The pages decided by a rule are the labels, unless
others are given. With back-off, sparse and unlabelled templates are smoothed towards their parent and the same template on other hosts.

Pages are aggregated by (host, masked path) first, with partial sums, so a hot host costs a row for each of its templates; all further
steps work on that table, and pages meet it again in one equi-join.

Defined cases: a null url or one without ``://`` has empty host and path and fits no rule; such pages share one template; repeated rows
are judged alike and count each; without labels (and without back-off) a template's share is one half, which does not reject; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import fresh, write_through

#: The rules of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def masked(path: Column) -> Column:
    """The path's segments as an array, variable forms (numbers, dates, hexadecimal and UUID ids) as wildcards; an ending stays."""

    def mask(s: Column) -> Column:
        s = F.regexp_replace(s, r"^[0-9]+(-[0-9]+)*(?=$|\.)", "{n}")
        return F.regexp_replace(s, r"^(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F]{8,}(-[0-9a-fA-F]{4,})*(?=$|\.)", "{x}")

    return F.transform(F.split(path, "/"), mask)


def steps(segments: Column) -> Column:
    """Path segments as they are written in a template."""
    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")


def generalise(leaves: DataFrame, fan: int, rare: float) -> DataFrame:
    """Column ``template`` of ``leaves`` (host, segments, n, ...): where a node has more than ``fan`` children, those with less than a
    share ``rare`` of its pages become one wildcard.

    A node is the leaves of a host with one template up to segment ``at``. A wildcard needs more than ``fan`` different segments at a
    level, so a round takes a node to the first such level at once, copying the segments before it; a node without one is done. A node whose
    children are all rare stays one node, and passes all such levels that follow each other in one round. So rounds count the levels at
    which some node divides beside a wildcard, not the segments of a path."""
    node = ["host", "template", "at"]
    size, rest = F.size("segments"), F.slice("segments", F.col("at") + 1, F.size("segments"))
    names = leaves.columns
    live = write_through(leaves.withColumn("template", F.lit("")).withColumn("at", F.lit(0)), "templates")
    done = []
    while not live.isEmpty():
        each = live.where(size > F.col("at")).select(*node, "n", F.posexplode(rest).alias("level", "child"))
        each = each.groupBy(*node, "level", "child").agg(F.sum("n").alias("k"))
        levels = each.groupBy(*node, "level").agg(F.count("*").alias("children"), F.max("k").alias("most"), F.sum("k").alias("all"))
        levels = levels.join(live.groupBy(*node).agg(F.sum("n").alias("pages")), node)
        many = F.col("children") > fan
        whole = many & (F.col("most") < rare * F.col("all")) & (F.col("all") == F.col("pages"))
        plan = levels.groupBy(*node).agg(F.min(F.when(many, F.col("level"))).alias("first"), F.min(F.when(~whole, F.col("level"))).alias("stop"), F.max("level").alias("last"))
        plan = plan.withColumn("stop", F.coalesce("stop", F.col("last") + 1)).drop("last")
        out = write_through(live.join(plan, node, "left"), "templates")
        end = out.where("first is null")
        done.append(end.select(*names, F.when(size > F.col("at"), F.concat("template", steps(rest))).otherwise(F.col("template")).alias("template")))
        through = out.where("first is not null and stop > 0")
        through = through.select(*names, F.concat("template", F.repeat(F.lit("/{*}"), F.col("stop"))).alias("template"), (F.col("at") + F.col("stop")).alias("at"))
        part = out.where("first is not null and stop = 0")
        child = F.when(size > F.col("at") + F.col("first"), F.element_at("segments", F.col("at") + F.col("first") + 1))
        ahead = F.slice("segments", F.col("at") + 1, F.col("first"))
        part = part.select(*names, F.concat("template", steps(ahead)).alias("template"), (F.col("at") + F.col("first") + 1).alias("at"), child.alias("child"))
        done.append(part.where("child is null").select(*names, "template"))
        part = part.where("child is not null")
        counts = part.groupBy(*node, "child").agg(F.sum("n").alias("k"))
        sums = counts.groupBy(*node).agg(F.count("*").alias("children"), F.sum("k").alias("all"))
        wild = counts.join(sums, node).where((F.col("children") > fan) & (F.col("k") < rare * F.col("all"))).select(*node, "child", F.lit(True).alias("wild"))
        part = part.join(wild, [*node, "child"], "left")
        step = F.concat("template", F.lit("/"), F.when(F.col("wild"), "{*}").otherwise(F.col("child")))
        part = part.select(*names, step.alias("template"), "at")
        live = write_through(through.unionByName(part), "templates")
    out = live.select(*names, "template")
    for rows in done:
        out = out.unionByName(rows)
    return out


def dividing(able: DataFrame) -> DataFrame:
    """Rows (host, size, levels): the levels, in order, at which some branches of a host and a depth may meet as siblings, from rows
    (host, size, parts). Two that do are equal after that level and differ at it; so a level where no such two are can be passed over.
    (Endings are compared by hash: if two share one, a level too many is looked at.)"""
    at = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    each = able.where("size > 2").select("host", "size", "parts", at.alias("at"))
    after = F.xxhash64(F.slice("parts", F.col("at") + 2, F.col("size")))
    each = each.select("host", "size", "at", after.alias("after"), F.element_at("parts", F.col("at") + 1).alias("child"))
    meet = each.groupBy("host", "size", "at", "after").agg(F.min("child").alias("low"), F.max("child").alias("high")).where("low != high")
    return meet.groupBy("host", "size").agg(F.sort_array(F.collect_set("at")).alias("levels"))


def merged(templates: DataFrame, z: float, least: int) -> DataFrame:
    """``templates`` (host, template, block, labelled) with column ``branch``, level by level: siblings (branches of a host that differ in
    one segment only) with at least ``least`` labels whose share of blocked ones is within ``z`` standard errors of their pooled share
    fall into one branch, the others keep their own. A branch without siblings at a level has a wildcard there. Only levels with siblings
    take a round, so rounds count the labelled templates of a host that resemble each other, not the segments of a path."""
    rows = templates.withColumn("parts", F.split("template", "/")).withColumn("size", F.size("parts"))
    levels = dividing(rows.where(F.col("labelled") >= least).select("host", "size", "parts"))
    rows = rows.join(levels, ["host", "size"], "left").withColumn("levels", F.when(F.col("labelled") >= least, F.col("levels")))
    alone = F.array_join(F.transform("parts", lambda s, i: F.when((i >= 2) & ~F.array_contains("levels", i), "{+}").otherwise(s)), "/")
    rows = rows.withColumn("branch", F.when(F.col("levels").isNotNull(), alone).otherwise(F.col("template"))).drop("parts", "size")
    out = write_through(rows, "branches")
    for k in range(out.agg(F.max(F.size("levels"))).first()[0] or 0):
        at = F.when(F.size("levels") > k, F.element_at("levels", k + 1))
        sums = out.where(at.isNotNull()).groupBy("host", "branch", at.alias("at")).agg(F.sum("block").alias("b"), F.sum("labelled").alias("l"))
        masked_at = F.array_join(F.transform(F.split("branch", "/"), lambda s, i: F.when(i == F.col("at"), "{+}").otherwise(s)), "/")
        sums = sums.withColumn("key", masked_at)
        pool = sums.groupBy("host", "key").agg((F.sum("b") / F.sum("l")).alias("share"))
        error = F.sqrt(F.col("share") * (1 - F.col("share")) / F.col("l") + 0.25 / (F.col("l") * F.col("l")))
        alike = sums.join(pool, ["host", "key"]).where(F.abs(F.col("b") / F.col("l") - F.col("share")) <= z * error)
        out = out.join(alike.select("host", "branch", "key"), ["host", "branch"], "left")
        out = write_through(out.withColumn("branch", F.coalesce("key", "branch")).drop("key"), "branches")
    return out.drop("levels")


def backing(templates: DataFrame, prior: float, doubt: float) -> DataFrame:
    """Rows (host, template, back) from ``templates`` (host, template, n, block, labelled): the share a template backs off to, the mean of
    its parent's on the host and of the same template's on all other hosts. Both are smoothed down the path in the same way, from the
    root, whose share is that of other hosts; with no label anywhere it is one half."""
    counts = ("n", "block", "labelled")
    parts = F.split("template", "/")
    nodes = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda k: F.struct(k.alias("level"), F.md5(F.array_join(F.slice(parts, 1, k), "/")).alias("node")))
    paths = templates.select("host", "template", *counts, F.explode(nodes).alias("at")).select("host", "template", *counts, "at.*")
    own = write_through(paths.groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in counts)), "nodes")
    all_hosts = own.groupBy("node").agg(F.sum("block").alias("all_block"), F.sum("labelled").alias("all_labelled"))
    own = own.join(all_hosts, "node").withColumn("others_block", F.col("all_block") - F.col("block"))
    own = own.withColumn("others_labelled", F.col("all_labelled") - F.col("labelled"))
    step = F.struct("level", *counts, "others_block", "others_labelled")
    chain = paths.drop(*counts).join(own, ["host", "node"]).groupBy("host", "template").agg(F.sort_array(F.collect_list(step)).alias("chain"))

    def down(state: Column, x: Column) -> Column:
        others = (x["others_block"] + prior * state["others"]) / (x["others_labelled"] + prior)
        back = (F.coalesce(state["own"], others) + others) / 2
        weight = prior + doubt * (x["n"] - x["labelled"])
        return F.struct(((x["block"] + weight * back) / (x["labelled"] + weight)).alias("own"), others.alias("others"), back.alias("back"))

    start = F.struct(F.lit(None).cast("double").alias("own"), F.lit(0.5).alias("others"), F.lit(None).cast("double").alias("back"))
    return chain.select("host", "template", F.aggregate("chain", start, down)["back"].alias("back"))


def template_tree(
    pages: DataFrame, fan: int = 20, rare: float = 0.02, z: float = 2.0, least: int = 10, prior: float = 2.0, backoff: bool = False, doubt: float = 0.05
) -> DataFrame:
    """Rows (host, segments, template, branch, purity) from ``pages`` (host, segments, label: block, allow or null). Purity is the
    blocked share of a branch's labelled pages, smoothed by ``prior`` pages of which half are blocked. With ``backoff`` the prior's
    pages are blocked in the share that the template backs off to, and each unlabelled page adds ``doubt`` of a page to them, so that few labels
    do not speak for many pages without."""
    blocked, known = (F.sum(F.when(c, 1).otherwise(0)) for c in (F.col("label") == "block", F.col("label").isin("block", "allow")))
    leaves = write_through(pages.groupBy("host", "segments").agg(F.count("*").alias("n"), blocked.alias("block"), known.alias("labelled")), "leaves")
    leaves = write_through(generalise(leaves, fan, rare), "leaves")
    sums = write_through(leaves.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "block", "labelled"))), "sums")
    branches = write_through(merged(sums, z, least), "branches")
    scores = branches.groupBy("host", "branch").agg(*(F.sum(c).alias(c) for c in ("n", "block", "labelled")))
    of = branches.select("host", "template", "branch").join(scores, ["host", "branch"])
    back, weight = F.lit(0.5), F.lit(prior)
    if backoff:
        of = of.join(backing(sums, prior, doubt), ["host", "template"])
        back, weight = F.col("back"), prior + doubt * (F.col("n") - F.col("labelled"))
    of = of.select("host", "template", "branch", ((F.col("block") + weight * back) / (F.col("labelled") + weight)).alias("purity"))
    return leaves.select("host", "segments", "template").join(of, ["host", "template"])


def judge(pages: DataFrame, rules=RULES, reject: float = 0.8, url: str = "url", backoff: bool = False) -> DataFrame:
    """``pages`` with host, path, rule, template, purity and verdict. Columns of these names are replaced. ``backoff``: the template tree's."""
    made = ["host", "path", "rule", "template", "purity", "verdict"]
    rows = pages.select(*(c for c in pages.columns if c not in made or c == url))
    host, path = host_path(F.col(url))
    rows = rows.withColumn("host", host).withColumn("path", path)
    own, segments = fresh(rows, "rule_verdict"), fresh(rows, "segments")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn(own, verdict).withColumn(segments, masked(F.col("path")))
    tree = template_tree(rows.select("host", F.col(segments).alias("segments"), F.col(own).alias("label")), backoff=backoff)
    tree = write_through(tree.select("host", F.col("segments").alias(segments), "template", "purity"), "tree")
    out = rows.join(tree, ["host", segments], "left")
    learned = F.when(F.col("purity") > reject, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce(F.col(own), learned)).drop(own, segments)

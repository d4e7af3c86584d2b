"""URL filters: rules, and for what no rule covers, trust and distrust spread over the host graph.

Nodes are hosts and their parent domains of two labels or more. Edges are absolute links in pages from
one host to another (``//host`` in an ``href`` or ``src``), weighted by their number, and one edge each
way between a host and its parent domain, so hosts without links still belong to a site. Two
personalised PageRanks run together: trust starts at hosts whose pages the rules allow and follows the
links; distrust starts at hosts whose pages the rules block and follows them backwards (who links to a
blocked host is suspect). A host is blocked if its distrust is more than its trust.

Scores are whole parts of ``MASS``, 10^26, and every step divides downwards, so the result does not depend
on the order of the additions and reruns agree; no step adds mass. A host whose share of all mass falls under
10^-26 has none: with ten million seeds that is one behind nine links of a hundred each. The verdict compares the
scores as they are; ``trust`` and ``distrust`` report them in parts of ``REPORTED``, rounded up.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and verdict
``allow``; so has a host that no trust or distrust reaches, or as much of both. A null html has no
links. Rows with a null id and repeated rows are judged like any other; each counts as a page of its
host. Without pages there are no rows. Other columns are ignored. Of rules that fit, the longest
(host plus path) wins; of equally long ones the first in code point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from driftlog.llm.common import cut

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
STEPS = 10
DAMPING = 85  # hundredths
#: Room in 38 digits for a mass times the links between two hosts (under 10**12).
MASS = 10**26
REPORTED = 10**18
LINK = r"""(?:href|src|HREF|SRC)\s*=\s*["']?(?:[a-zA-Z]+:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """The host (A-Z folded) and path of a url column; empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(F.col(url), at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(rules=RULES) -> Column:
    """The winning rule of ``host`` and ``path`` as struct(rule, verdict), null if none fits."""
    out = None
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if out is None else out


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict (null if none fits)."""
    host, path = host_and_path()
    out = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("_rule", rule_of(rules))
    return out.select("page_id", "host", "path", "_rule.rule", F.col("_rule.verdict").alias("ruled"))


def parent(host: Column) -> Column:
    """The next domain up, if it has two labels at least."""
    up = F.regexp_extract(host, r"^[^.]*\.(.*)$", 1)
    return F.when(F.contains(up, F.lit(".")), up)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between hosts and, both ways, host and parent domain."""
    host, _ = host_and_path()
    found = pages.select(host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    links = found.select("src", F.translate("to", _UPPER, _LOWER).alias("dst")).where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    links = cut(links)  # pages are searched once
    hosts = pages.select(host.alias("host")).unionByName(links.select(F.col("dst").alias("host"))).where("host <> ''").distinct()
    # every suffix of a host that is a domain: a host has a handful of labels
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    names = hosts.select(F.explode(F.when(F.size(labels) > 1, suffixes).otherwise(F.array("host"))).alias("host")).distinct()
    up = names.select(F.col("host").alias("src"), parent(F.col("host")).alias("dst")).where("dst is not null")
    tree = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1).cast("long"))
    return links.unionByName(tree).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _whole(a: str, b: str) -> str:
    """a divided by b, downwards, for decimals without fraction (``div`` would give 64 bits, ``/`` alone rounds)."""
    return f"cast(({a} - {a} % {b}) / {b} as decimal(28, 0))"


def spread(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, damping: int = DAMPING) -> DataFrame:
    """(host, trust, distrust), parts of MASS as decimal, after ``steps`` steps from ``seeds`` (host, kind, n); kind 1
    runs against the edges."""
    edges, seeds = cut(edges), cut(seeds)
    both = edges.withColumn("kind", F.lit(0)).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit(1).alias("kind"))
    )
    total = both.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = cut(both.join(total, ["kind", "src"]).selectExpr("kind", "src", "dst", "cast(n as decimal(12, 0)) as n", "cast(out as decimal(18, 0)) as out"))
    all_seeds = seeds.groupBy("kind").agg(F.sum("n").cast("decimal(18, 0)").alias("all"))
    first = _whole(f"(cast({MASS} as decimal(27, 0)) * cast(n as decimal(12, 0)))", "all")
    start = cut(seeds.join(F.broadcast(all_seeds), "kind").selectExpr("kind", "host", f"{first} as mass"))
    part = lambda x, share: _whole(f"({x} * cast({share} as decimal(3, 0)))", "cast(100 as decimal(3, 0))")
    rest = start.selectExpr("kind", "host", f"{part('mass', 100 - damping)} as mass")
    rank = start
    for step in range(1, steps + 1):
        moved = rank.withColumnRenamed("host", "src").join(shares, ["kind", "src"]).selectExpr("kind", "dst as host", f"{_whole('(mass * n)', 'out')} as mass")
        moved = moved.selectExpr("kind", "host", f"{part('mass', damping)} as mass")
        rank = moved.unionByName(rest).groupBy("kind", "host").agg(F.sum("mass").cast("decimal(28, 0)").alias("mass"))
        if step % 5 == 0 or step == steps:
            rank = cut(rank)  # a lost executor costs a few steps at most
    none = F.lit(0).cast("decimal(28, 0)")
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), none).cast("decimal(28, 0)").alias("trust" if kind == 0 else "distrust")
    return rank.groupBy("host").agg(pick(0), pick(1))


def reported(name: str) -> Column:
    """A score of ``spread`` in parts of REPORTED, as bigint."""
    step = MASS // REPORTED
    return F.expr(_whole(f"({name} + cast({step - 1} as decimal(18, 0)))", f"cast({step} as decimal(18, 0))")).cast("long").alias(name)


def url_filter(pages: DataFrame, rules=RULES, steps: int = STEPS) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    judged = ruled(pages, rules)
    kind = F.when(F.col("ruled") == "allow", 0).otherwise(1)
    seeds = judged.where("ruled is not null and host <> ''").groupBy("host", kind.alias("kind")).agg(F.count("*").alias("n"))
    scores = spread(host_edges(pages), seeds, steps)
    none = F.lit(0).cast("decimal(28, 0)")
    out = judged.join(scores, "host", "left").withColumns({c: F.coalesce(c, none) for c in ("trust", "distrust")})
    own = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), reported("trust"), reported("distrust"))

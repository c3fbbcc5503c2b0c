"""URL filters: rules first, then trust propagated over the graph of hosts, in DataFrame operations only.

Rules name a host and a path; a rule fits its host and all subdomains where the url's path starts with the rule's,
and the longest that fits decides.  Pages without a rule are judged by their host: personalised PageRank spreads trust along links from the hosts of
allowed pages, and distrust against links from the hosts of blocked ones (Gyongyi et al., 2004; Krishnan and Raj, 2006).
Mass at hosts without links returns to the seeds; that multiplies all of a walk alike, so each is brought to a sum of 1 at its end.  Rounds go on until less than
``TOLERANCE`` of the mass still moves, which with the damping is sure to come.
A host is blocked when distrust is more than ``THRESHOLD`` of the sum of both (a tie is allowed); one that neither reaches is allowed.

A null url, or one without ``://``, has an empty host and path, and no part in the graph.  A null or empty html has
no links; links are counted once per pair of hosts, so very long or repeated pages add nothing.  Other columns are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.llm.shared import materialise

#: (verdict, host and path) of the production rules.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-6, 0.5
#: Rounds between two looks at what still moves.
STRIDE = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = "(?i)(?:href|src)\\s*=\\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s<>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules=RULES) -> Column:
    """The struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest ends up first
        own, _, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) hosts of absolute links; relative links stay on their host and are no edges."""
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("to"))
    links = links.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst"))
    return links.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).distinct()


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust), whose two sums are 1 or 0; so are those of the result.

    Each edge carries trust to its end and distrust to its start, so a round is one join and one aggregate.  Two numbers go to the driver each ``STRIDE`` rounds.
    """
    out = edges.groupBy("src").agg(F.count("*").alias("n_out"))
    into = edges.groupBy("dst").agg(F.count("*").alias("n_in"))
    ahead = edges.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), (1 / F.col("n_out")).alias("t"), F.lit(0.0).alias("d"))
    back = edges.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (1 / F.col("n_in")).alias("d"))
    lanes = materialise(ahead.unionByName(back), "lanes")
    start = materialise(seeds, "seeds")
    state, moves = start, lanes.take(1)
    own = start.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    while moves:
        before = state
        for _ in range(STRIDE):
            before = state
            sent = state.join(lanes, "host").select(F.col("to").alias("host"), (F.col("trust") * F.col("t") * damping).alias("trust"), (F.col("distrust") * F.col("d") * damping).alias("distrust"))
            state = own.unionByName(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        last = before.select("host", (-F.col("trust")).alias("trust"), (-F.col("distrust")).alias("distrust"), F.lit(0.0).alias("now_trust"), F.lit(0.0).alias("now_distrust"))
        both = last.unionByName(state.select("host", "trust", "distrust", F.col("trust").alias("now_trust"), F.col("distrust").alias("now_distrust")))
        both = materialise(both.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("trust", "distrust", "now_trust", "now_distrust"))), "walk")
        state = both.select("host", F.col("now_trust").alias("trust"), F.col("now_distrust").alias("distrust"))
        moves = (both.agg(F.sum(F.abs("trust") + F.abs("distrust"))).first()[0] or 0) > tolerance
    sums = state.agg(F.sum("trust"), F.sum("distrust")).first()
    return state.select("host", *((F.col(c) / F.lit(float(n or 1))).alias(c) for c, n in zip(("trust", "distrust"), sums)))


def url_filters(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE, threshold: float = THRESHOLD) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    read = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = read.withColumn("fit", fitting(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "fit.rule", "fit.verdict")
    named = judged.filter(F.col("verdict").isNotNull()).groupBy("host", "verdict").agg(F.count("*").alias("n"))
    sums = {r["verdict"]: r["n"] for r in named.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}  # two rows at most
    share = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, F.col("n")).otherwise(0)) / F.lit(float(sums.get(verdict, 1)))
    seeds = named.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    walked = propagate(host_edges(read.select("host", "html")), seeds, tolerance)
    blocked = walked.filter(F.col("distrust") > F.lit(threshold) * (F.col("trust") + F.col("distrust"))).select("host", F.lit("block").alias("by_host"))
    blocked = materialise(blocked, "blocked")  # of a known size, and so that Spark can split a host of very many pages
    return judged.join(blocked, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", "by_host", F.lit("allow")).alias("verdict"))

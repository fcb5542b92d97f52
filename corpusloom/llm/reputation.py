"""Url filter: fixed rules first, else the host's empirical-Bayes reputation.

Labelled page outcomes (bad or not) are counted by host. A host's rate of bad
pages is drawn towards its registered domain's, the domain's towards its
suffix's, the suffix's towards the rate of all: each level is a beta prior
whose strength is the beta-binomial fit, by moments, to how much the groups of
that level differ from their parent. A page without a rule is blocked if the
lower bound of its host's posterior rate is above ``MOST_BAD``; so a host
without outcomes is judged by its domain and is rarely blocked.

The suffix is a host's last label, the registered domain its last two. Urls
without "://" have an empty host and path, and no rule fits them. Repeated
pages are separate rows; of rival outcomes of a page bad holds; outcomes
without a page or a value do not count. Without outcomes nothing is blocked
but by rule. One row per host is joined to the pages, so a host with a third
of all pages is split by the join as it likes.
"""

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import kept

#: Fixed values: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MOST_RULES = 1_000
MOST_BAD = 0.5
BOUND_SD = 1.6448536269514722
WEAKEST, STRONGEST = 0.5, 1_000_000.0


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it has no "://"."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        row = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, row).otherwise(chosen)
    return chosen


def strength(groups: DataFrame) -> float:
    """Beta prior strength of groups (n, bad, mean), whose parent's rate is ``mean``, by moments."""
    p = F.least(F.greatest("mean", F.lit(1e-6)), F.lit(1 - 1e-6))
    excess = F.sum((F.col("bad") - F.col("n") * p) ** 2 / (p * (1 - p)) - F.col("n"))
    row = groups.agg(excess.alias("excess"), F.sum(F.col("n") * (F.col("n") - 1)).cast("double").alias("pairs")).first()
    if not row.pairs:
        return STRONGEST
    alike = min(max(row.excess / row.pairs, 1 / (1 + STRONGEST)), 1 / (1 + WEAKEST))
    return (1 - alike) / alike


def reputations(hosts: DataFrame) -> DataFrame:
    """(host, alpha, beta) of the posterior rate of bad pages, for rows (host, n, bad)."""
    named = kept(
        hosts.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2)), "hosts"
    )
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    rate = (total.bad + 1) / (total.n + 2)

    def level(groups, own):
        groups = kept(groups, own)
        m = strength(groups)
        return groups.select("*", ((F.col("bad") + m * F.col("mean")) / (F.col("n") + m)).alias(f"{own}_mean"))

    suffixes = level(named.groupBy("suffix").agg(*sums).withColumn("mean", F.lit(rate)), "suffix")
    domains = named.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", F.col("suffix_mean").alias("mean")), "suffix")
    domains = level(domains, "domain")
    own = kept(named.join(domains.select("domain", F.col("domain_mean").alias("mean")), "domain"), "host-priors")
    m = strength(own)
    return own.select(
        "host", (F.col("bad") + m * F.col("mean")).alias("alpha"), (F.col("n") - F.col("bad") + m * (1 - F.col("mean"))).alias("beta")
    )


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, bad_bound) of every page.

    ``outcomes``: (page_id, bad), bad 0 or 1.
    """
    host, path = host_and_path()
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    urls = urls.select("page_id", host.alias("host"), path.alias("path"))
    known = (
        outcomes.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad"))
        .filter("page_id IS NOT NULL AND bad IS NOT NULL")
        .groupBy("page_id")
        .agg(F.max("bad").alias("bad"))
    )
    hosts = urls.join(known, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    known_hosts = reputations(hosts)
    total = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / total
    low = mean - BOUND_SD * F.sqrt(mean * (1 - mean) / (total + 1))
    shown = urls.join(known_hosts.select("host", mean.alias("bad_rate"), low.alias("bad_bound")), "host")
    shown = shown.withColumn("ruled", longest_rule(F.col("host"), F.col("path"), rules))
    by_method = F.when(F.col("bad_bound") > MOST_BAD, "block").otherwise("allow")
    return shown.select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", by_method).alias("verdict"),
        F.round("bad_rate", 6).alias("bad_rate"), F.round("bad_bound", 6).alias("bad_bound"),
    )

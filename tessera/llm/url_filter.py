"""URL filter: fixed rules first, empirical-Bayes host reputation elsewhere.

A rule ``host/path`` fits a url whose host is the rule's or one of its
subdomains and whose path starts with the rule's; the longest fitting rule
decides. The pages that a rule decides are the labelled outcomes. For every
other page the share of blocked outcomes of its host is estimated by a
beta-binomial posterior: the counts of a host shrink towards its registered
domain, the domain's towards its suffix and the suffix's towards all pages.
The prior strength of each level comes from the spread of the shares among
its members (method of moments). A page is blocked when the lower posterior
bound of its host's share is above ``threshold``.

The registered domain is the last two labels of the host (three below a
two-label suffix given in ``long_suffixes``), the suffix what follows its
first label. Hosts are pre-aggregated before anything is joined, and the
join back to the pages is by host, whose hot keys adaptive execution splits.

Null url, or one without ``://``: host and path are empty, no rule fits.
Repeated rows are separate pages and separate outcomes. With no labelled
page every share is one half and nothing is blocked. An empty table gives an
empty result. Columns besides ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
THRESHOLD = 0.5
Z = 1.645            # one-sided 95 % bound
LONG_SUFFIXES = ("co.uk", "com.au", "co.jp", "com.br")
STRENGTH = (1.0, 1000.0)   # bounds of a level's prior strength

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """``(host, path)``, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UP, _LOW), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, else null; of two
    equally long ones the first in code-point order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, decision in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at = name.index("/")
        fits = (((host == name[:at]) | host.endswith("." + name[:at])) & path.startswith(name[at:]))
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def host_levels(host: Column, long_suffixes=LONG_SUFFIXES) -> tuple[Column, Column]:
    """``(registered domain, suffix)``."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*long_suffixes)
    domain = F.when(long, F.substring_index(host, ".", -3)).otherwise(two)
    suffix = F.when(long, two).otherwise(F.substring_index(host, ".", -1))
    return domain, suffix


def prior_strength(groups: DataFrame) -> DataFrame:
    """One row ``_k``: the beta-binomial prior strength of a level from its
    groups' ``(_n, _bad)``, by moments, within :data:`STRENGTH`."""
    some = groups.filter("_n > 0")
    total = some.agg(F.sum("_n").alias("_N"), F.sum("_bad").alias("_B"), F.count(F.lit(1)).alias("_g"),
                     F.sum(F.col("_n") * F.col("_n")).alias("_nn"),
                     F.sum(F.col("_bad") * F.col("_bad") / F.col("_n")).alias("_bb"))
    m = F.col("_B") / F.col("_N")
    between = F.col("_bb") - F.col("_N") * m * m
    binomial = m * (1 - m)
    spread = binomial * (F.col("_N") - F.col("_nn") / F.col("_N") - (F.col("_g") - 1))
    share = (between - binomial * (F.col("_g") - 1)) / F.when(spread > 1e-9, spread)
    k = F.when(share > 1e-9, 1 / share - 1)
    low, high = STRENGTH
    return total.select(F.least(F.greatest(F.coalesce(k, F.lit(high)), F.lit(low)), F.lit(high)).alias("_k"))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``(host, mean, bound)`` from ``(host, _n, _bad)``: the posterior mean and
    the lower bound of each host's share of bad pages."""
    domain, suffix = host_levels(F.col("host"))
    hosts = checkpointed(hosts.withColumns({"_domain": domain, "_suffix": suffix}))
    count = [F.sum("_n").alias("_n"), F.sum("_bad").alias("_bad")]
    domains = hosts.groupBy("_domain", "_suffix").agg(*count)
    suffixes = domains.groupBy("_suffix").agg(*count)

    def shrunk(prior: Column) -> Column:
        return (F.col("_bad") + F.col("_k") * prior) / (F.col("_n") + F.col("_k"))

    everything = suffixes.agg((F.sum("_bad") + 0.5).alias("_b"), (F.sum("_n") + 1).alias("_a")) \
        .select((F.col("_b") / F.col("_a")).alias("_all"))
    suffixes = (suffixes.withColumn("_k", prior_strength(suffixes).scalar())
                .withColumn("_suffix_mean", shrunk(everything.scalar())).select("_suffix", "_suffix_mean"))
    domains = (domains.withColumn("_k", prior_strength(domains).scalar()).join(suffixes, "_suffix")
               .withColumn("_domain_mean", shrunk(F.col("_suffix_mean"))).select("_domain", "_domain_mean"))
    joined = hosts.withColumn("_k", prior_strength(hosts).scalar()).join(domains, "_domain")
    size = F.col("_n") + F.col("_k")
    mean = shrunk(F.col("_domain_mean"))
    return (joined.withColumn("mean", mean)
            .withColumn("bound", F.col("mean") - F.lit(Z) * F.sqrt(
                F.col("mean") * (1 - F.col("mean")) / (size + 1)))
            .select("host", "mean", "bound"))


def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, host, path, rule, verdict, bound)`` for every page."""
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(path, F.lit("")).alias("path"))
    rule, decision = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = checkpointed(rows.withColumns({"rule": rule, "_decision": decision}))
    hosts = rows.groupBy("host").agg(
        F.count("_decision").alias("_n"),
        F.sum((F.col("_decision") == "block").cast("long")).alias("_bad")).fillna(0, ["_bad"])
    bounds = checkpointed(host_reputation(hosts).select("host", "bound"))
    verdict = F.coalesce("_decision", F.when(F.col("bound") > threshold, "block").otherwise("allow"))
    return (rows.join(bounds, "host").withColumn("verdict", verdict)
            .select("page_id", "host", "path", "rule", "verdict", "bound"))

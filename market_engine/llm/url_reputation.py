"""URL filters by empirical-Bayes host reputation, with an explicit rule list that comes first.

Labelled pages are bad or good outcomes of their host. A host's bad rate gets a beta prior whose
mean is its registered domain's shrunk rate, the domain's prior mean is its suffix's shrunk rate,
and the suffix's is the rate of all labelled pages. The strength of each prior (how many pages it
counts as) is the moment estimate of the beta-binomial over that level's groups. A host is blocked
when the lower bound of its posterior, mean minus ``z`` standard deviations, is above ``max_bad``:
few labels or mixed ones never block.

Built-in functions only. Counts per host are partially aggregated before the shuffle; what joins
back to the pages is one row per host, and the join is left to the measured size: broadcast where
small, else a sort-merge join whose hot host the skew handling splits.

Defined results: a null url, or one without ``://``, has empty host and path; a host without
labelled pages has its domain's prior, one in an unseen suffix the rate of all; without any label
the rate is 0 and nothing but rules blocks; several label rows of a page count once, bad if any is;
pages with the same id are judged each by its own url; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class UrlRule:
    """``block`` or ``allow`` for a host with its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[UrlRule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null: one expression for the whole list."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


def registered_domain(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(groups: DataFrame, n: str, k: str, mean: str, least: float, most: float) -> Column:
    """Scalar: pages that the prior of a level counts as, by moments over its groups."""
    p = F.col(k) / F.col(n)
    s = groups.filter(F.col(n) > 0).agg(
        F.sum(F.col(n) * (p - F.col(mean)) * (p - F.col(mean))).alias("s"), F.sum(n).alias("n"),
        F.sum(F.col(n) * F.col(n)).alias("n2"), F.count(F.lit(1)).alias("g"), F.sum(k).alias("k"))
    v = F.col("k") / F.col("n") * (1 - F.col("k") / F.col("n"))
    free = F.col("n") - F.col("n2") / F.col("n") - (F.col("g") - 1)
    rho = F.when((v > 0) & (free > 0), (F.col("s") - v * (F.col("g") - 1)) / (v * free))
    m = F.when(rho > 0, (1 - rho) / rho).otherwise(F.lit(most))
    return s.select(F.greatest(F.lit(least), F.least(F.lit(most), m)).alias("m")).scalar()


def reputation(outcomes: DataFrame, z: float = 1.645, least: float = 2.0, most: float = 1000.0) -> DataFrame:
    """``outcomes``: rows (host, bad boolean or null). One row per host: n_labelled, n_bad, prior_mean,
    prior_pages, post_mean, post_low. Totals are scalar subqueries over
    the stored counts of hosts, domains and suffixes; levels join on their key."""
    n, k = F.count("bad"), F.count(F.when(F.col("bad"), F.lit(1)))
    hosts = stored(outcomes.groupBy("host").agg(n.alias("n"), k.alias("k")).withColumns(
        {"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    total = suffixes.agg(F.sum("sn").alias("n"), F.sum("sk").alias("k")).select(
        F.when(F.col("n") > 0, F.col("k") / F.col("n")).otherwise(F.lit(0.0)).alias("rate"))
    suffixes = suffixes.withColumn("rate", total.scalar())
    suffixes = suffixes.withColumn("m", _strength(suffixes, "sn", "sk", "rate", least, most)).select("suffix", ((F.col("sk") + F.col("m") * F.col("rate")) / (F.col("sn") + F.col("m"))).alias("s_mean"))
    domains = domains.join(stored(suffixes, "suffixes"), "suffix")
    domains = domains.withColumn("m", _strength(domains, "dn", "dk", "s_mean", least, most)).select("domain", "suffix", ((F.col("dk") + F.col("m") * F.col("s_mean")) / (F.col("dn") + F.col("m"))).alias("d_mean"))
    hosts = hosts.join(stored(domains, "domains"), ["domain", "suffix"])
    hosts = hosts.withColumn("m", _strength(hosts, "n", "k", "d_mean", least, most))
    a = F.col("m") * F.col("d_mean") + F.col("k")
    b = F.col("m") * (1 - F.col("d_mean")) + F.col("n") - F.col("k")
    mean, var = a / (a + b), a * b / ((a + b) * (a + b) * (a + b + 1))
    return hosts.select(
        "host", F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"), F.col("d_mean").alias("prior_mean"),
        F.col("m").alias("prior_pages"), mean.alias("post_mean"), (mean - z * F.sqrt(var)).alias("post_low"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule] = RULES, max_bad: float = 0.5,
          page_id: str = "page_id", url: str = "url", label_id: str = "doc_id") -> DataFrame:
    """page_id, host, path, rule, verdict. A label row (quality, toxic) is a bad outcome if quality is 0
    or toxic is 1."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    lab = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("page_id")).agg(F.max(bad).alias("bad"))
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    p = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rep = reputation(p.select("page_id", "host").join(lab, "page_id", "left")).select("host", "post_low")
    h, q = F.col("host"), F.col("path")
    p = p.withColumns({"rule": matched_rule(h, q, rules, lambda r: r.name),
                       "ruled": matched_rule(h, q, rules, lambda r: r.verdict)}).join(rep, "host", "left")
    own = F.when(F.col("post_low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return p.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))

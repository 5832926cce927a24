"""URL filters: path rules, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted by host and shrunk through
beta-binomial priors: a suffix's rate towards the global rate, a registered
domain's towards its suffix, a host's towards its domain.  Prior strengths are
estimated by moments at each level.  A host is blocked when the lower posterior
bound of its bad rate passes ``threshold``; hosts without outcomes take their
domain's, suffix's or the global posterior.  Rules come first: of the rules
whose host equals the page's or one of its parents and whose path starts the
page's path, the longest decides.

Counts are partial aggregates, so a hot host adds one row a task; the few hosts of
many pages are joined with their pages by broadcast.  The rule list
is a parameter of a few entries and becomes one CASE expression.

Defined cases: a null url, or one without ``://``, has empty host and path; no
rule fits an empty host, and its verdict is ``allow``.  Null outcomes are
ignored, repeated rows count once each, no outcome at all allows every page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.skew import join_groups

from .common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Labels under which country registries let independent owners register: with a
# two-letter last label they make a suffix of two labels (co.uk, com.mx, or.jp, gov.cn).
REGISTRY_LABELS = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "id", "ltd", "me", "mil", "ne", "net",
                   "nhs", "nom", "or", "org", "plc", "sch")
# Further suffixes: hosts that give their users names of their own.
HOSTING = ("blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app",
           "web.app", "wordpress.com", "tumblr.com")
# Names reserved for examples: their subdomains stand for independent sites.
RESERVED = ("example.com", "example.net", "example.org")
SUFFIXES = (*HOSTING, *RESERVED)


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_levels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host: a suffix is a registry label before a
    two-letter country, one of ``suffixes`` (two labels each), or else the last label."""
    last = F.substring_index(host, ".", -2)
    long = F.coalesce(last.rlike("^(" + "|".join(REGISTRY_LABELS) + r")\.[a-z]{2}$") | last.isin(*suffixes), F.lit(False))
    return (F.when(long, F.substring_index(host, ".", -3)).otherwise(last),
            F.when(long, last).otherwise(F.substring_index(host, ".", -1)))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; nulls if none does.

    ``rules``: (host, path, verdict), e.g. ``("example.org", "/es/", "block")``.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _strength(table: DataFrame, parent_rate: str, name: str) -> DataFrame:
    """One row: the beta prior strength that explains how the children's rates
    (``n``, ``bad``) spread around their parents' (method of moments)."""
    m = F.col(parent_rate)
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - m, 2))
    noise = F.sum(m * (1 - m))
    weight = F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")
    between = F.greatest((spread - noise) / F.when(weight > 0, weight), F.lit(1e-6))
    inner = F.avg(m * (1 - m))
    return table.agg(F.coalesce(F.least(F.greatest(inner / between - 1, F.lit(2.0)), F.lit(1e4)),
                                F.lit(1e4)).alias(name))


def host_reputation(outcomes: DataFrame, hosts: DataFrame, *, z: float = 1.645,
                    suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``host, n, bad, alpha, beta, rate, lower`` for every host in ``hosts``.

    ``outcomes``: (host, bad 0/1), one row a labelled page.  ``hosts``: (host).
    """
    domain, suffix = host_levels(F.col("host"), suffixes)
    seen = (outcomes.where(F.col("bad").isNotNull() & (F.col("host") != ""))
            .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("double")).alias("bad"))
            .withColumn("domain", domain).withColumn("suffix", suffix))
    seen = stage(seen, "hosts-seen")  # read by every level below
    # an empty outcome table still has one row here: rate 0
    top = seen.agg(F.coalesce(F.sum("bad") / F.sum("n"), F.lit(0.0)).alias("rate0"))

    def posterior(rate: str, strength: str) -> Column:
        n, bad = F.coalesce(F.col("n"), F.lit(0)), F.coalesce(F.col("bad"), F.lit(0.0))
        return (F.col(strength) * F.col(rate) + bad) / (F.col(strength) + n)

    def sums(by: list[str]) -> DataFrame:
        return seen.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    # one-row tables joined without a key: each side of one row
    s = sums(["suffix"]).join(F.broadcast(top))
    s = s.join(F.broadcast(_strength(s, "rate0", "k"))).select("suffix", posterior("rate0", "k").alias("rate_s"))
    s = stage(s, "hosts-suffixes")
    d = sums(["domain", "suffix"]).join(s, "suffix")
    d = d.join(F.broadcast(_strength(d, "rate_s", "k"))).select("domain", posterior("rate_s", "k").alias("rate_d"))
    d = stage(d, "hosts-domains")
    h = seen.join(d, "domain")
    kh = _strength(h, "rate_d", "k")
    every = (hosts.select("host").where(F.col("host") != "").distinct()
             .withColumn("domain", domain).withColumn("suffix", suffix)
             .join(seen.select("host", "n", "bad"), "host", "left")
             .join(d, "domain", "left").join(s, "suffix", "left")
             .join(F.broadcast(top)).join(F.broadcast(kh))
             .withColumn("prior", F.coalesce("rate_d", "rate_s", "rate0")))
    n, bad = F.coalesce(F.col("n"), F.lit(0)), F.coalesce(F.col("bad"), F.lit(0.0))
    a = F.col("k") * F.col("prior") + bad
    b = F.col("k") * (1 - F.col("prior")) + n - bad
    out = every.select("host", n.alias("n"), bad.alias("bad"), a.alias("alpha"), b.alias("beta"))
    mean = F.col("alpha") / (F.col("alpha") + F.col("beta"))
    sd = F.sqrt(mean * (1 - mean) / (F.col("alpha") + F.col("beta") + 1))
    return out.withColumn("rate", mean).withColumn("lower", F.greatest(mean - z * sd, F.lit(0.0)))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], *,
               threshold: float = 0.5, z: float = 1.645, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Each page's id, host, path, rule, verdict, and the host's ``rate`` and ``lower``.

    ``pages``: page_id, url.  ``outcomes``: url, bad (0/1).
    """
    p = pages.select("page_id", "url")
    p = p.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    sizes = stage(p.groupBy("host").agg(F.count(F.lit(1)).alias("size")), "hosts-pages")
    rep = host_reputation(outcomes.select(url_host(F.col("url")).alias("host"), "bad"), sizes.select("host"),
                          z=z, suffixes=suffixes).select("host", "rate", "lower")
    rep = stage(sizes.join(rep, "host", "left"), "hosts-reputation")
    total = rep.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    own = F.when(F.col("lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return (join_groups(p, rep, "host", "size", total)
            .select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                    "rate", "lower"))

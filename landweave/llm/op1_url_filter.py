"""URL filter: path rules first, else empirical-Bayes host reputation.

Labelled outcomes of pages are shrunk from the top down: a suffix's rate towards the rate of all outcomes,
a registered domain's towards its suffix's, a host's towards its domain's. Each level is a beta-binomial
whose prior strength comes from the spread of its rates (method of moments). A host is blocked when the
upper bound of its posterior good rate lies below a threshold, so little evidence never blocks; the bound
is the normal approximation of the beta posterior's tail. Levels are taken without user and port.

Defined results: a null URL or one without `://` has empty host and path, and all of these share the empty
host's reputation; hosts without outcomes take their parents' prior; outcome rows that repeat count as often
as they occur, null outcomes not at all; repeated pages are judged each; very long URLs are handled whole;
empty tables give no rows. Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import lower_ascii, saved, table

#: Some public suffixes of two labels, below which names are registered; others are the last label. A whole table can be given, see public_suffixes.
SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query: fixed values.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def bare_host(host: Column) -> Column:
    """Host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def public_suffixes(spark: SparkSession, path: str, private: bool = True) -> DataFrame:
    """suffix of each rule in a file of the public suffix list's published format, wildcards (`*.`) and exceptions (`!`) as they stand.

    A rule ends at the first blank; comments and empty lines give none. private=False leaves out the list's section of
    private names. The file is a published list of fixed size, so it is one row before it is split. Names of other
    scripts stay as written: hosts in punycode meet only rules in punycode.
    """
    text = F.col("value") if private else F.substring_index("value", "===BEGIN PRIVATE DOMAINS===", 1)
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.split(text, r"\r?\n")).alias("line"))
    rule = F.regexp_extract("line", r"^\s*\.?(\S+)", 1)
    return lines.filter(~F.col("line").rlike(r"^\s*(//|$)")).select(lower_ascii(rule).alias("suffix")).distinct()


def with_levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """hosts (host) with suffix and domain: the suffix and one label more; an IPv4 address is its own domain.

    suffixes: a table of public suffixes (suffix). `*.x` stands for every name one label below x; `!y.x` says that y.x is
    no suffix but a domain, and goes before all others; of the rest that fit the longest counts, else the last label.
    """
    labels = F.split(F.col("__name"), r"\.")
    tail = lambda k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), F.greatest(k, F.lit(1))), ".")
    rows = hosts.withColumn("__name", bare_host(F.col("host")))
    if suffixes is None:
        rows = rows.withColumn("suffix", F.when(tail(F.lit(2)).isin(*SUFFIXES), tail(F.lit(2))).otherwise(tail(F.lit(1))))
    else:
        known = suffixes.select(F.col("suffix").alias("__rule")).distinct()
        # a rule that would fit, the labels of the suffix it gives, and whether it is an exception
        fits = lambda rule, size, over: F.struct(rule.alias("rule"), size.alias("size"), F.lit(over).alias("over"))
        each = lambda k: F.array(fits(tail(k), k, 0), fits(F.concat(F.lit("*."), tail(k)), k + 1, 0), fits(F.concat(F.lit("!"), tail(k)), k - 1, 1))
        tails = rows.select("host", F.size(labels).alias("__most"), F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.size(labels)), each))).alias("__fit"))
        tails = tails.filter("__fit.size BETWEEN 1 AND __most").withColumn("__rule", F.col("__fit.rule"))
        best = tails.join(known, "__rule").groupBy("host").agg(F.max_by("__fit.size", F.struct("__fit.over", "__fit.size")).alias("__best"))
        rows = rows.join(best, "host", "left").withColumn("suffix", tail(F.coalesce("__best", F.lit(1)))).drop("__best")
    domain = F.when(F.col("__name").rlike(r"^[0-9.]+$"), F.col("__name")).otherwise(tail(F.size(F.split("suffix", r"\.")) + 1))
    return rows.withColumn("domain", domain).drop("__name")


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does. rules is a policy in the code, so its size is fixed."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_reputation(outcomes: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior of every host in outcomes (host, good: 1, 0 or null): host, pages, n, good, rate, bound (upper).

    Driver: three numbers for each of three levels. Rows are added up on their own partitions before any
    shuffle, so a host with a third of all rows costs no more than another.
    """
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("pages"), F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"))
    hosts = saved(with_levels(hosts, suffixes), "hosts")
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    root = (total[1] + 1) / (total[0] + 2) if total[0] else 0.5

    def strength(df: DataFrame, prior: str) -> float:
        """Prior strength (pseudo-outcomes) of the rates good / n around prior."""
        p, m = F.col("good") / F.col("n"), F.col(prior)
        r = df.filter("n > 0").agg(F.sum(F.col("n") * (p - m) ** 2), F.sum(m * (1 - m)), F.sum(F.col("n") * m * (1 - m)), F.count("*")).first()
        if not r[3]:
            return 10.0
        spread = (r[0] - r[1]) / max(r[2] - r[1], 1e-9)
        return 1 / min(max(spread, 0.001), 0.5) - 1

    def shrunk(df: DataFrame, k: float) -> DataFrame:
        return df.withColumn("rate", (F.col("good") + k * F.col("prior")) / (F.col("n") + k))

    def level(key: str) -> DataFrame:
        return hosts.groupBy(key, *(["suffix"] if key == "domain" else [])).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))

    suffixes = level("suffix").withColumn("prior", F.lit(root))
    suffixes = shrunk(suffixes, strength(suffixes, "prior"))
    domains = level("domain").join(suffixes.select("suffix", F.col("rate").alias("prior")), "suffix")
    domains = shrunk(domains, strength(domains, "prior"))
    own = hosts.join(domains.select("domain", "suffix", F.col("rate").alias("prior")), ["domain", "suffix"])
    k = strength(own, "prior")
    rate, n = F.col("rate"), F.col("n") + k
    return shrunk(own, k).select("host", "pages", "n", "good", "rate", F.least(F.lit(1.0), rate + z * F.sqrt(rate * (1 - rate) / (n + 1))).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, suffixes: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, rate and bound of every page (page_id, url).

    outcomes: page_id, good (1, 0). A rule decides alone; else the host's bound does. Hosts with over a
    thousandth of all pages are under a thousand, so their bounds are broadcast; the others meet in a join.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = urls.select("page_id", "host").join(outcomes.select("page_id", "good"), "page_id", "left")
    known = saved(host_reputation(labelled, suffixes=suffixes).select("host", "pages", "rate", "bound"), "reputation")
    hot = F.col("pages") * 1000 > (known.agg(F.sum("pages")).first()[0] or 0)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_bound = F.when(F.col("bound") < threshold, "block").otherwise("allow")
    near = urls.join(F.broadcast(known.filter(hot).select("host", F.col("rate").alias("r"), F.col("bound").alias("b"))), "host", "left")
    out = near.filter("b IS NOT NULL").withColumnsRenamed({"r": "rate", "b": "bound"})
    out = out.unionByName(near.filter("b IS NULL").drop("r", "b").join(known.filter(~hot).drop("pages"), "host", "left"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_bound).alias("verdict"), "rate", "bound")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes)

"""URL filters: explicit rules first, else an empirical-Bayes host reputation.

Reputation: the share of bad pages of a host is shrunk towards its registered
domain, the domain towards its suffix, the suffix towards the whole table. Each
level is a beta-binomial whose strength is fitted by moments over all nodes of the
level (``fit_strength``). A host is blocked where the lower bound of its
posterior bad rate lies above ``threshold``. The suffix is the longest one of the table
``suffixes`` that ends the host (a parameter; else the last label), the registered domain
has one label more. Port, user part and closing dots count for neither; an address (IPv4 or in
brackets) is its own domain under the common suffix ``(address)``.

Rules: a rule fits its host and all subdomains if the url's path starts with the
rule's path; the longest fitting rule wins. Rules meet hosts by an equi-join on
the suffixes of the distinct hosts, so long rule lists never meet every page.

Defined cases: a null url, or one without ``://``, has empty host and path and
forms one host of its own; a host that is a suffix is its own domain; repeated pages count once each; a page with several
label rows is bad if any of them is; null outcomes are no label; hosts without
labels take their domain's posterior; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]   # host, path, verdict

# Common public suffixes of several labels; longer tables are passed as ``suffixes``.
PUBLIC_SUFFIXES = (
    "co.uk", "org.uk", "me.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "edu.au", "gov.au", "co.nz", "org.nz",
    "co.jp", "ne.jp", "or.jp", "ac.jp", "go.jp", "co.kr", "or.kr", "co.in", "net.in", "org.in", "co.za", "org.za",
    "com.br", "net.br", "org.br", "com.ar", "com.mx", "com.co", "com.cn", "net.cn", "org.cn", "com.tw", "org.tw",
    "com.hk", "com.sg", "com.my", "com.tr", "com.ua", "com.pl", "co.il", "co.id", "co.th", "com.vn", "com.eg",
    "github.io", "gitlab.io", "blogspot.com", "herokuapp.com", "netlify.app", "vercel.app", "pages.dev", "web.app",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered(hosts: DataFrame, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """``hosts`` (distinct column ``host``) with ``domain`` and ``suffix``.

    The endings of the hosts meet the table by an equi-join, so it may be long.
    """
    bare = F.regexp_replace(F.regexp_replace("host", r"^.*@|:[0-9]*$", ""), r"\.+$", "")
    rows = hosts.withColumn("_bare", bare)
    labels = F.split("_bare", r"\.")
    endings = (rows.select("host", "_bare", F.size(labels).alias("_all")).where("_all > 1")
               .select("host", "_bare", F.explode(F.sequence(F.lit(2), F.col("_all"))).alias("_labels"))
               .select("host", "_labels", F.expr("substring_index(_bare, '.', -_labels)").alias("_ending")))
    listed = hosts.sparkSession.createDataFrame([(x.lower(),) for x in sorted(set(suffixes))], "_ending string")
    longest = endings.join(listed, "_ending").groupBy("host").agg(F.max("_labels").alias("_labels"))
    address = F.col("_bare").rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$|^\[")
    rows = rows.join(longest, "host", "left").withColumn("_labels", F.coalesce("_labels", F.lit(1)))
    return rows.withColumns({
        "domain": F.when(address, F.col("_bare")).otherwise(F.expr("substring_index(_bare, '.', -_labels - 1)")),
        "suffix": F.when(address, F.lit("(address)")).otherwise(F.expr("substring_index(_bare, '.', -_labels)")),
    }).drop("_bare", "_labels")


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, bad) per distinct host of ``pages``; ``outcomes``: page_id, bad (boolean)."""
    known = (outcomes.where("page_id is not null and bad is not null")
             .groupBy("page_id").agg(F.max("bad").alias("bad")))
    return (pages.select("page_id", host_of(F.col("url")).alias("host"))
            .join(known, "page_id", "left")
            .groupBy("host").agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad")))


def fit_strength(nodes: DataFrame) -> float:
    """Prior strength of a level from columns n, bad and prior (the parent's mean).

    With intra-node correlation rho, ``sum(n (bad/n - m)^2 / (m (1 - m)))`` has
    mean ``sum(1 + (n - 1) rho)``; the strength is ``(1 - rho) / rho``. rho is kept
    between 0.0001 and 0.99.
    """
    m = F.col("prior")
    row = nodes.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - m, 2) / (m * (1 - m))).alias("z"),
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    if not row["k"] or row["n"] <= row["k"]:
        return 1.0
    rho = min(0.99, max(1e-4, (row["z"] - row["k"]) / (row["n"] - row["k"])))
    return (1 - rho) / rho


def _shrunk(nodes: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """Posterior of each node given its parent's mean (columns ``on``, mean)."""
    joined = settled(nodes.join(parents.select(on, F.col("mean").alias("prior")), on), "reputation")
    strength = fit_strength(joined)
    a = F.col("prior") * strength + F.col("bad")
    b = (1 - F.col("prior")) * strength + F.col("n") - F.col("bad")
    return joined.withColumns({"a": a, "b": b, "mean": a / (a + b)})


def reputation(counts: DataFrame, z: float = 1.645, threshold: float = 0.3,
               suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """Per host: posterior mean, lower bound of the bad rate, and ``blocked``."""
    # written first: the endings and the rows below read the counts, not the pages
    hosts = settled(registered(settled(counts, "host-counts"), suffixes), "host-names")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    root = (total["bad"] + 0.5) / (total["n"] + 1.0)
    sums = lambda *keys: hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = sums("suffix").select("suffix", F.lit(root).alias("mean"))
    suffixes = _shrunk(sums("suffix"), top, "suffix")
    domains = _shrunk(sums("suffix", "domain"), suffixes, "suffix")
    result = _shrunk(hosts, domains, "domain")
    a, b = F.col("a"), F.col("b")
    low = F.col("mean") - z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return result.select("host", "n", "bad", "mean", low.alias("low"), (low > threshold).alias("blocked"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): rules whose host is the host itself or a parent of it, longest first.

    ``rules``: rule_host, rule_path, rule_verdict.
    """
    labels = F.split("host", r"\.")
    suffixes = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."))).alias("rule_host"))
    text = F.concat("rule_host", "rule_path")
    return (suffixes.join(rules, "rule_host")
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
                F.length(text).alias("size"), text.alias("text"), F.col("rule_path").alias("path"),
                F.col("rule_verdict").alias("verdict"))), asc=False).alias("rules")))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule],
          z: float = 1.645, threshold: float = 0.3, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), mean and low of the host."""
    spark = pages.sparkSession
    scores = settled(reputation(host_counts(pages, outcomes), z, threshold, suffixes), "host-scores")
    known = spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    # written first: a plain table of known size, so that Spark can split a hot host in the join
    per_host = settled(scores.join(host_rules(scores.select("host"), known), "host", "left"), "host-verdicts")
    df = (pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
          .join(per_host, "host", "left"))
    hit = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    df = df.withColumn("hit", hit)
    return df.select(
        "page_id", "host", "path", F.col("hit")["text"].alias("rule"),
        F.coalesce(F.col("hit")["verdict"],
                   F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "mean", "low")

"""Verdicts on urls: rules first, else an empirical-Bayes reputation of the host.

Labelled pages are counted by host. Bad shares are shrunk from the whole to the suffix,
from there to the registered domain and to the host: each level's posterior mean is the
next level's beta prior, whose strength comes from the spread of that level's counts
(moments of the beta-binomial). What is unsure about a prior mean stays unsure in the
posterior, by the share the prior has in it. A host is blocked if the lower bound of its
posterior lies above the limit, so that few labels alone never block.

DataFrame functions only. Counts are aggregated before they are joined; a hot host's
pages meet its verdict through join_groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.grouping import join_groups
from riskflow.plans.shared import materialize

Rule = tuple[str, str, str]

#: Bad share above which a host goes, and the normal quantile of the bound.
LIMIT = 0.25
Z = 1.645
#: Bounds of the correlation of labels within a group; the prior counts as 1/rho - 1 pages.
RHO = (0.0001, 0.5)

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty for a null or a url without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, _URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, _URL, 2)


def _tail(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _strength(groups: DataFrame, prior: str) -> float:
    """Pages a prior counts as, from groups with bad of n labels and a prior mean each."""
    p = F.col(prior)
    sums = groups.where((p > 0) & (p < 1)).agg(
        F.sum((F.col("bad") - F.col("n") * p) ** 2 / (p * (1 - p))).alias("x"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    rho = (sums["x"] - sums["n"]) / sums["pairs"] if sums["pairs"] else RHO[1]
    return 1 / min(max(rho, RHO[0]), RHO[1]) - 1


def _posterior(strength: float) -> tuple[Column, Column]:
    """(mean, variance) of a group with bad of n labels and a prior's mean and variance."""
    total = F.col("n") + strength
    mean = (F.col("prior") * strength + F.col("bad")) / total
    weight = F.lit(strength) / total
    return mean, mean * (1 - mean) / (total + 1) + weight * weight * F.col("prior_var")


def host_bounds(pages: DataFrame) -> DataFrame:
    """(host, n_pages, n, bad, mean, bound) from (host, outcome): outcome 1 bad, 0 good, null unlabelled."""
    hosts = materialize(
        pages.groupBy("host").agg(
            F.count("*").alias("n_pages"),
            F.count("outcome").alias("n"),
            F.coalesce(F.sum("outcome"), F.lit(0)).cast("bigint").alias("bad"),
        ),
        "hosts",
    ).withColumns({"suffix": _tail(F.col("host"), 1), "domain": _tail(F.col("host"), 2)})
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    all_pages = hosts.agg(*sums).first()
    # half a page each way keeps the mean inside 0 and 1
    whole = ((all_pages["bad"] or 0) + 0.5) / ((all_pages["n"] or 0) + 1.0)
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumns({"prior": F.lit(whole), "prior_var": F.lit(0.0)})
    mean, variance = _posterior(_strength(suffixes, "prior"))
    suffixes = suffixes.select("suffix", mean.alias("prior"), variance.alias("prior_var"))
    domains = materialize(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix"), "domains")
    mean, variance = _posterior(_strength(domains, "prior"))
    domains = domains.select("domain", mean.alias("prior"), variance.alias("prior_var"))
    placed = materialize(hosts.join(domains, "domain"), "hosts")
    mean, variance = _posterior(_strength(placed, "prior"))
    return placed.select("host", "n_pages", "n", "bad", mean.alias("mean"), (mean - Z * F.sqrt(variance)).alias("bound"))


def _rules_of(hosts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per host the rules that fit it, longest first."""
    spark = hosts.sparkSession
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")
    labels = F.split("host", "\\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = hosts.select("host", F.explode(ends).alias("rule_host")).join(F.broadcast(table), "rule_host")
    length = F.length("rule_host") + F.length("rule_path")
    rule = F.struct(
        (-length).alias("rank"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_path").alias("path"),
        F.col("rule_verdict").alias("verdict"),
    )
    return fitting.groupBy("host").agg(F.array_sort(F.collect_set(rule)).alias("rules"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict: one row for each row of ``pages``.

    ``pages`` needs ``page_id`` and ``url``. ``labels`` has ``page_id`` and ``outcome`` (1
    bad, 0 good); rows with a null in either are not used, the largest outcome of a page
    counts. ``rules`` is a short list of (host, path, "allow" or "block") in the program's
    text, the only thing broadcast whole. A rule fits its host and all hosts below it if
    the path starts with the rule's; the longest wins, whatever the labels say. Without
    labels all hosts are allowed. Rows may repeat; a null page_id has no label.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.where("page_id is not null and outcome is not null").groupBy("page_id").agg(
        F.max("outcome").cast("bigint").alias("outcome")
    )
    parts = materialize(parts.join(known, "page_id", "left"), "urls")
    bounds = materialize(host_bounds(parts), "bounds")
    hosts = bounds.join(_rules_of(bounds, rules), "host", "left").select(
        "host", "n_pages", (F.col("bound") > LIMIT).alias("bad_host"), "rules"
    )
    judged = join_groups(parts, materialize(hosts, "hosts"), "host", "n_pages")
    fit = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    rule = F.when(F.size(F.coalesce(fit, F.array())) > 0, F.element_at(fit, 1))
    verdict = F.when(F.col("bad_host"), "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], verdict).alias("verdict"),
    )

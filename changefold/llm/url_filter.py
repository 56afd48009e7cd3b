"""URL filters: rules of hosts and paths, then the reputation of the host.

The reputation is an empirical-Bayes estimate from labelled page outcomes. The share of good
pages of a host is shrunk towards that of its registered domain, the domain's towards that
of its suffix, the suffix's towards that of all pages. Each step is a beta-binomial: the
level above gives the prior's mean, the spread of the level's own counts its strength. A
host is blocked if the upper bound of its posterior share is below ``MIN_GOOD``.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.operators.joins import splittable_join
from changefold.session import materialize

#: What a rule does, its host and the beginning of its paths.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
#: Second-level names under which countries register domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: A host goes if its share of good pages is below this by so many standard deviations.
MIN_GOOD = 0.5
SURE = 1.645
#: Bounds of the correlation between pages of one group, which is the prior's strength.
LEAST_RHO, MOST_RHO = 1e-6, 0.5


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, number sign or the end."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, number sign or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and what it does; else null.

    Of rules of one length the first in the order of their texts counts.
    """
    found = F.lit(None)
    verdict = F.lit(None).cast("string")
    for what, name, begin in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(begin))
        found, verdict = (F.when(fits, F.lit(x)).otherwise(y) for x, y in ((name + begin, found), (what, verdict)))
    return found.cast("string"), verdict


def above(host: Column) -> list[Column]:
    """The suffix and the registered domain of a host.

    The suffix is the last label, or the last two if they are a country and one of
    ``SECOND_LEVEL``; the domain has one label more. A host that is no longer is its own.
    """
    labels = F.split(host, r"\.", -1)
    two = (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL)
    two = F.coalesce(two, F.lit(False))
    return [F.when(two, F.substring_index(host, ".", -n - 1)).otherwise(F.substring_index(host, ".", -n)).alias(c)
            for n, c in ((1, "suffix"), (2, "domain"))]


def counted(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, y) for each host: labelled pages and good ones among them.

    ``pages``: page_id, host. ``outcomes``: page_id, good. Counts are pre-aggregated, so a host with a third of all pages
    is one row for each task.
    """
    told = outcomes.groupBy("page_id").agg(F.min("good").alias("good"))
    met = splittable_join(pages, told, "page_id", "left")
    return met.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("y"))


def strength(groups: DataFrame, mean: str) -> float:
    """The pages that a prior is worth, by the method of moments: from the excess of the
    spread of the groups' good pages around the mean above them over a binomial's."""
    m = F.col(mean)
    own = F.col("n") * m * (1 - m)
    found = groups.agg(
        F.sum(F.pow(F.col("y") - F.col("n") * m, 2) - own).alias("excess"),
        F.sum((F.col("n") - 1) * own).alias("most")).first()
    rho = found.excess / found.most if found.most else MOST_RHO
    rho = min(max(rho, LEAST_RHO), MOST_RHO)
    return 1 / rho - 1


def reputations(hosts: DataFrame, min_good: float = MIN_GOOD, sure: float = SURE) -> DataFrame:
    """(host, n_labelled, share, lowest, highest, verdict): the posterior of each host.

    ``hosts``: host, n, y. Three numbers come to the driver, one strength for each level.
    """
    hosts = materialize(hosts.select("*", *above(F.col("host"))), "hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    top = ((total.y or 0) + 1) / ((total.n or 0) + 2)

    def shrunk(groups: DataFrame) -> DataFrame:
        """``share`` is the posterior mean under a prior around ``mean``, ``weight`` its pages."""
        worth = strength(groups, "mean")
        return groups.withColumn("weight", F.col("n") + worth).withColumn(
            "share", (F.col("y") + worth * F.col("mean")) / F.col("weight"))

    suffixes = shrunk(materialize(suffixes.withColumn("mean", F.lit(top)), "suffixes"))
    means = suffixes.select("suffix", F.col("share").alias("mean"))
    domains = shrunk(materialize(splittable_join(domains, means, "suffix", "left").drop(means["suffix"]), "domains"))
    means = domains.select("domain", F.col("share").alias("mean"))
    hosts = shrunk(materialize(splittable_join(hosts, means, "domain", "left").drop(means["domain"]), "hosts"))
    spread = sure * F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("weight") + 1))
    highest = F.least(F.col("share") + spread, F.lit(1.0))
    return hosts.select(
        "host", F.col("n").alias("n_labelled"), "share", F.greatest(F.col("share") - spread, F.lit(0.0)).alias("lowest"),
        highest.alias("highest"), F.when(highest < min_good, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, outcomes: DataFrame, *, page_id: str = "page_id", url: str = "url",
          outcome_id: str = "page_id", good: str = "good",
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, share, highest) for each page.

    ``outcomes`` tells of some page ids whether they are good (1) or not (0); other values
    and rows without an id tell nothing, and an id with both is not good. A url that is null
    or has no ``://`` has an empty host and path; pages without a host are judged together,
    by the posterior of the empty host. Rows that repeat an id count one by one. Without
    outcomes, or where nothing is known of a host, its prior decides. No pages give no rows.
    """
    source = F.col(f"`{url}`")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(source).alias("host"), path_of(source).alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = materialize(rows.select("*", rule.alias("rule"), verdict.alias("ruled")), "urls")
    told = outcomes.select(F.col(f"`{outcome_id}`").alias("page_id"), F.col(f"`{good}`").cast("int").alias("good"))
    told = told.filter("good IN (0, 1) AND page_id IS NOT NULL")
    found = reputations(counted(rows.select("page_id", "host"), told)).select(
        F.col("host").alias("of_host"), "n_labelled", "share", "highest", F.col("verdict").alias("reputed"))
    met = splittable_join(rows, found.withColumnRenamed("of_host", "host"), "host", "left")
    return met.select("page_id", rows["host"], "path", "rule", F.coalesce("ruled", "reputed").alias("verdict"),
                      "n_labelled", "share", "highest")

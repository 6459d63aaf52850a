"""Judging web addresses: rules by host and path, and empirical-Bayes host reputation where no rule fits.

Reputation. Labelled pages say how often a host was bad. Few hosts have many labels, so a host's rate is shrunk
towards its registered domain's, that towards its suffix's, and that towards the overall rate. Each step is a
beta-binomial model: the parent's posterior mean and a strength form the prior of the child, and the strength of a
level is fitted by moments from how far children of that level differ beyond chance. A host is blocked if the lower
bound of its bad rate (posterior mean less `bound_sds` standard deviations) is above `limit`; hosts without labels
have their parent's posterior and are allowed unless that bound is exceeded there.

Labelled pages meet their labels by an inner join on their id and are summed by host, as are the distinct hosts of all
pages; all further work is on hosts. Verdicts come back to pages by an equi-join on host, which adaptive execution broadcasts if the table of hosts measures small and splits where a
host holds many pages.

Null addresses and those without `://` have an empty host and path; no rule fits them, and they are judged as the
host "". Labels that are null in every field count nothing. Repeated rows are judged alike. Without any labels all
hosts are allowed. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .words import LOWER, UPPER

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
# Suffixes of two parts under which names are registered.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "co.jp", "ne.jp", "or.jp", "com.au", "net.au", "org.au",
                     "co.nz", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")
MOST_SUFFIXES = 100_000
LEVELS = ("host", "domain", "suffix")


@dataclass(frozen=True)
class Reputation:
    limit: float = 0.5
    bound_sds: float = 1.645
    least_strength: float = 2.0
    most_strength: float = 1000.0


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written like `net/`, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for outcome, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, outcome).otherwise(verdict)
    return name, verdict


def suffix_list(suffixes: DataFrame | tuple[str, ...]) -> tuple[str, ...]:
    """The suffixes of a table (its first column) or a tuple, lower-cased. Lists of public suffixes have some ten
    thousand entries; a table of more than MOST_SUFFIXES is refused."""
    if isinstance(suffixes, DataFrame):
        column = F.lower(F.col(suffixes.columns[0]))
        found = suffixes.select(column.alias("s")).where("s IS NOT NULL").distinct().limit(MOST_SUFFIXES + 1).collect()
        suffixes = tuple(sorted(row["s"] for row in found))
    if len(suffixes) > MOST_SUFFIXES:
        raise ValueError(f"more than {MOST_SUFFIXES} suffixes")
    return suffixes


def suffix_of(host: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    """The longest listed suffix of two or more labels that the host ends in, else its last label."""
    parts = F.split(host, r"\.")
    found = F.element_at(parts, -1)
    by_labels: dict[int, list[str]] = {}
    for suffix in suffixes:
        by_labels.setdefault(suffix.count(".") + 1, []).append(suffix)
    for labels in sorted(by_labels.keys() - {1}):
        last = F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), F.lit(labels)), ".")
        found = F.when(last.isin(*by_labels[labels]), last).otherwise(found)
    return found


def domain_of(host: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    """The registered domain: one label more than the suffix. Numeric addresses stand for themselves."""
    parts = F.split(host, r"\.")
    labels = F.size(F.split(suffix_of(host, suffixes), r"\.")) + 1
    named = F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), labels), ".")
    return F.when(host.rlike(r"^[0-9.:]+$"), host).otherwise(named)


def host_reputation(hosts: DataFrame, settings: Reputation = Reputation(),
                    suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> DataFrame:
    """Posterior of each row of (host, n_labelled, n_bad): bad_mean, bad_sd and bad_low, its lower bound."""
    tree = hosts.select("host", domain_of(F.col("host"), suffixes).alias("domain"),
                        suffix_of(F.col("host"), suffixes).alias("suffix"), "n_labelled", "n_bad").checkpoint()
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_labelled", "n_bad")]
    whole = tree.agg(*sums).first()
    overall = (whole["n_bad"] + 0.5) / (whole["n_labelled"] + 1.0)
    domains = tree.groupBy("domain", "suffix").agg(*sums)
    suffixes = tree.groupBy("suffix").agg(*sums)
    strength = {level: _strength(counts, overall, settings)
                for level, counts in zip(LEVELS, (tree, domains, suffixes), strict=True)}
    mean, _ = _shrunk(F.lit(overall), strength["suffix"])
    by_suffix = suffixes.select("suffix", mean.alias("_prior"))
    mean, _ = _shrunk(F.col("_prior"), strength["domain"])
    by_domain = domains.join(by_suffix, "suffix").select("domain", "suffix", mean.alias("_prior"))
    mean, sd = _shrunk(F.col("_prior"), strength["host"])
    low = F.greatest(F.lit(0.0), F.col("bad_mean") - settings.bound_sds * F.col("bad_sd"))
    return (tree.join(by_domain, ["domain", "suffix"])
            .select("host", "n_labelled", "n_bad", mean.alias("bad_mean"), sd.alias("bad_sd"))
            .withColumn("bad_low", low))


def _strength(counts: DataFrame, overall: float, settings: Reputation) -> float:
    """Strength of the prior over the rows of one level: 1 / rho - 1, where rho is the correlation between the labels
    of one row, from sum n (p - m)^2 = m (1 - m) sum (1 + (n - 1) rho)."""
    off = F.col("n_bad") / F.col("n_labelled") - overall
    found = counts.filter("n_labelled > 0").agg(
        F.sum(F.col("n_labelled") * off * off / (overall * (1 - overall))).alias("spread"),
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("n_labelled") - 1).alias("pairs")).first()
    rho = (found["spread"] - found["rows"]) / found["pairs"] if found["pairs"] else 0.0
    low, high = 1 / (1 + settings.most_strength), 1 / (1 + settings.least_strength)
    return 1 / min(max(rho, low), high) - 1


def _shrunk(prior: Column, strength: float) -> tuple[Column, Column]:
    """Mean and standard deviation of the posterior."""
    weight = F.col("n_labelled") + strength
    mean = (prior * strength + F.col("n_bad")) / weight
    return mean, F.sqrt(mean * (1 - mean) / (weight + 1))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, settings: Reputation = Reputation(),
               suffixes: DataFrame | tuple[str, ...] = TWO_PART_SUFFIXES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, bad_low (bound of the host's bad rate) and n_labelled.

    `outcomes` holds labelled pages as (page_id, bad 0 or 1). Several labels of a page all count. `suffixes` lists the
    suffixes of several labels under which names are registered; hosts under others share their last label's domain.
    """
    suffixes = suffix_list(suffixes)
    addressed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = (outcomes.filter(F.col("bad").isNotNull()).groupBy("page_id")
                .agg(F.count("bad").alias("n_labelled"), F.sum(F.col("bad").cast("long")).alias("n_bad")))
    # Only labelled pages meet their labels; all others give no more than their host.
    known = addressed.select("page_id", "host").join(labelled, "page_id").select("host", "n_labelled", "n_bad")
    named = addressed.select("host", *[F.lit(0).cast("long").alias(c) for c in ("n_labelled", "n_bad")]).distinct()
    hosts = (known.unionByName(named).groupBy("host")
             .agg(F.sum("n_labelled").alias("n_labelled"), F.sum("n_bad").alias("n_bad")))
    reputation = host_reputation(hosts, settings, suffixes).select("host", "bad_low", "n_labelled")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_low") > settings.limit, "block").otherwise("allow")
    return (addressed.join(reputation, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                    F.round("bad_low", 4).alias("bad_low"), "n_labelled"))

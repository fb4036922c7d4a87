"""URL filters: given rules first, then the reputation that labelled pages have earned a host.

Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytables.sources.scratch import write_scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
    there up to ``?``, ``#`` or the end. Null, or no ``://``: both empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], of: str) -> Column:
    """``of`` ("rule" or "verdict") of the longest rule that fits, else null; the first of equals."""
    found = F.lit(None).cast("string")
    # A stable sort, applied from the shortest rule up: what is applied last is tried first.
    for rule in reversed(sorted(rules, key=lambda r: -len(r.host + r.path))):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, rule.host + rule.path if of == "rule" else rule.verdict).otherwise(found)
    return found


def suffix(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The longest of ``suffixes`` that the host is or ends in after a dot, else its last label.

    ``suffixes`` are plain names of two or more labels in lower case, such as ``co.uk``; they become a set within the
    plan, so they are to be a bounded list.
    """
    found = F.substring_index(host, ".", -1)
    for labels, names in _by_labels(suffixes):
        end = F.substring_index(host, ".", -labels)
        found = F.when(end.isin(names), end).otherwise(found)
    return found


def registered_domain(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The host's suffix and the label before it; a host without one is its own domain."""
    found = F.substring_index(host, ".", -2)
    for labels, names in _by_labels(suffixes):
        end = F.substring_index(host, ".", -labels)
        found = F.when(end.isin(names), F.substring_index(host, ".", -labels - 1)).otherwise(found)
    return found


def _by_labels(suffixes: Sequence[str]) -> list[tuple[int, list[str]]]:
    """By number of labels, fewest first: what is applied last is tried first."""
    grouped: dict[int, list[str]] = {}
    for name in sorted(set(suffixes)):
        if "." not in name or name != name.lower() or not all(name.split(".")):
            raise ValueError(f"{name!r} is no suffix of two or more labels in lower case")
        grouped.setdefault(name.count(".") + 1, []).append(name)
    return sorted(grouped.items())


def _prior(level: DataFrame, keys: list[str], strength: float) -> DataFrame:
    """Adds the posterior mean ``rate`` of a beta-binomial whose prior has mean ``prior`` and weighs
    ``strength`` observations."""
    return level.withColumn("rate", (F.col("good") + strength * F.col("prior")) / (F.col("n") + strength)).select(
        *keys, "good", "n", "prior", "rate"
    )


def _strength(level: DataFrame, least: float, most: float) -> float:
    """The method of moments for a beta-binomial: how many observations the prior of a level weighs.

    Squared differences of each group's rate from its prior, weighed by its observations, are set
    against what binomial noise alone would give. Three sums are all that reaches the driver.
    """
    p, n = F.col("prior"), F.col("n").cast("double")
    row = level.where((F.col("n") > 0) & (p > 0) & (p < 1)).agg(
        F.sum(F.round(n * F.pow(F.col("good") / n - p, F.lit(2.0)) / (p * (1 - p)), 9).cast("decimal(38,9)")).alias("chi"),
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("seen"),
    ).first()
    groups, seen = row["groups"], row["seen"] or 0
    if not groups or seen <= groups:
        return most
    # E[chi] = sum(1 + (n - 1) / (strength + 1))
    extra = float(row["chi"]) - groups
    return min(most, max(least, (seen - groups) / extra - 1)) if extra > 0 else most


def host_reputation(
    pages: DataFrame,
    outcomes: DataFrame,
    least_strength: float = 2.0,
    most_strength: float = 1000.0,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """One row per host of ``pages``: ``host, good, n, prior, rate, variance``.

    ``pages`` has ``page_id, url``; ``outcomes`` has ``page_id, good`` (boolean), each id once. A suffix's
    rate is shrunk to the rate of all, a domain's to its suffix's, a host's to its domain's, by a
    beta-binomial whose strength is estimated for each level. Hosts without labelled pages get their
    domain's rate, domains without any their suffix's. ``rate`` and ``variance`` are those of the
    host's beta posterior.

    ``suffixes`` names the suffixes of several labels (see ``suffix``); without any, a domain is a host's last two labels.
    A port is part of the last label, and an address in numbers is cut like a name.

    A null ``good`` or ``page_id`` counts for nothing. Without any outcome every rate is 0.5. The
    counts are added up per host before anything else, so a host with a third of all rows is a single row.
    """
    host, _ = host_and_path(F.col("url"))
    named = pages.select(F.col("page_id"), host.alias("host"))
    seen = named.join(outcomes.where(F.col("good").isNotNull()).select("page_id", "good"), on="page_id", how="left")
    hosts = write_scratch(
        seen.groupBy("host")
        .agg(
            F.count("good").alias("n"),
            F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"),
        )
        .withColumn("domain", registered_domain(F.col("host"), suffixes))
        .withColumn("suffix", suffix(F.col("host"), suffixes)),
        "reputation-hosts",
    )
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    base = total["good"] / total["n"] if total["n"] else 0.5

    sums = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    strengths = {"least": least_strength, "most": most_strength}
    domains = write_scratch(hosts.groupBy("domain", "suffix").agg(*sums), "reputation-domains")
    ends = domains.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(float(base)))
    ends = write_scratch(_prior(ends, ["suffix"], _strength(ends, **strengths)), "reputation-suffixes")
    of_suffix = ends.select("suffix", F.col("rate").alias("prior"))
    domains = domains.join(of_suffix, on="suffix")
    domains = _prior(domains, ["domain"], _strength(domains, **strengths))
    hosts = hosts.join(domains.select("domain", F.col("rate").alias("prior")), on="domain")
    strength = _strength(hosts, **strengths)
    a = F.col("good") + strength * F.col("prior")
    b = F.col("n") - F.col("good") + strength * (1 - F.col("prior"))
    return _prior(hosts, ["host"], strength).withColumn(
        "variance", a * b / ((a + b) * (a + b) * (a + b + 1))
    )


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    least_rate: float = 0.5,
    z: float = 1.0,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, reputation, bound``.

    The longest rule that fits decides. Else the page is allowed if the lower posterior bound of its
    host's good rate, ``rate - z * sqrt(variance)``, is at least ``least_rate``. ``suffixes`` are those of several
    labels, for :func:`host_reputation`. Columns of ``pages``
    with those names are replaced, all others are kept. Repeated rows are judged alike. A null url has an empty
    host, which has a reputation like any other.
    """
    own = ["host", "path", "rule", "verdict", "reputation", "bound"]
    pages = pages.drop(*own)
    host, path = host_and_path(F.col("url"))
    bounds = host_reputation(pages, outcomes, suffixes=suffixes).select(
        "host", F.col("rate").alias("reputation"), (F.col("rate") - z * F.sqrt("variance")).alias("bound")
    )
    named = pages.withColumn("host", host).withColumn("path", path)
    ruled = matching_rule(F.col("host"), F.col("path"), rules, "verdict")
    return (
        named.join(bounds, on="host", how="left")
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules, "rule"))
        .withColumn(
            "verdict",
            F.coalesce(ruled, F.when(F.col("bound") >= least_rate, "allow").otherwise("block")),
        )
        .select(*pages.columns, *own)
    )

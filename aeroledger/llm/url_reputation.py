"""URL filter by rules and by Empirical-Bayes host reputation.

Labelled page outcomes are counted per host. The good rate of a host is shrunk towards that of its registered domain, that of the domain
towards its suffix, and that of the suffix towards all labels. Each step is a beta-binomial model whose prior strength is fitted to the
spread of the children around their parents (method of moments). A host passes if a low quantile of its posterior reaches a bound.

Edge cases: a null url, or one without `://`, has an empty host and path and is judged like any unlabelled host. A page without a label, or
with a null one, counts for nothing. Repeated pages and repeated labels of one page each count as often as they occur. Empty inputs give
empty or prior-only results. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from aeroledger.llm.common import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Suffixes of two labels below which names are registered; all others have one label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str  # host and path, such as example.net/en/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)", 2)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def first_match(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """`field` of the longest fitting rule, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def beta_quantile(a: np.ndarray, b: np.ndarray, p: float, points: int = 1025) -> np.ndarray:
    """p-quantile of Beta(a, b), from the density of its logit on a grid of 12 deviations around the mode."""
    if not len(a):
        return np.zeros(0)
    width = np.sqrt(1 / a + 1 / b + 1 / (a * a) + 1 / (b * b))
    grid = np.log(a / b)[:, None] + width[:, None] * np.linspace(-12, 12, points)
    log_density = a[:, None] * grid - (a + b)[:, None] * np.logaddexp(0, grid)
    density = np.exp(log_density - log_density.max(1, keepdims=True))
    steps = np.cumsum((density[:, 1:] + density[:, :-1]) / 2, axis=1)
    steps = np.concatenate([np.zeros((len(a), 1)), steps / steps[:, -1:]], axis=1)
    at = np.minimum((steps < p).sum(1), points - 1)
    row = np.arange(len(a))
    lo, hi = steps[row, at - 1], steps[row, at]
    logit = grid[row, at - 1] + (grid[row, at] - grid[row, at - 1]) * (p - lo) / np.maximum(hi - lo, 1e-300)
    return 1 / (1 + np.exp(-logit))


def _strength(children: DataFrame) -> float:
    """Prior strength from columns n, good and parent_mean: one row of three sums reaches the driver."""
    m = F.col("parent_mean")
    gap = F.col("good") - F.col("n") * m
    row = children.agg(
        F.sum(gap * gap).alias("spread"),
        F.sum(F.col("n") * m * (1 - m)).alias("binomial"),
        F.sum(F.col("n") * (F.col("n") - 1) * m * (1 - m)).alias("pairs"),
    ).first()
    rho = (row.spread - row.binomial) / row.pairs if row.pairs else 0.1
    rho = min(max(rho, 1e-4), 0.5)
    return 1 / rho - 1


def host_reputation(pages: DataFrame, outcomes: DataFrame, lower_tail: float = 0.05) -> DataFrame:
    """One row per host of `pages` (page_id, url): counts, posterior and its lower quantile.

    `outcomes` (page_id, good boolean) are the labelled pages. Counting combines within each task before its shuffle, so a host with a third
    of all pages adds one row per task.
    """
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"))
    marks = outcomes.where(F.col("good").isNotNull()).groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good")
    )
    counts = hosts.join(marks, "page_id", "left").groupBy("host").agg(
        F.count("*").alias("n_pages"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
    )
    # one row per host, counted once for all sums below
    counts = durable(counts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}))

    domains = counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((total.good or 0) + 1) / ((total.n or 0) + 2)

    suffixes = suffixes.withColumn("parent_mean", F.lit(overall))
    shrunk = _shrunk(suffixes, _strength(suffixes)).select("suffix", F.col("mean").alias("parent_mean"))
    domains = domains.join(shrunk, "suffix")
    shrunk = _shrunk(domains, _strength(domains)).select("domain", F.col("mean").alias("parent_mean"))
    counts = counts.join(shrunk, "domain")
    strength = _strength(counts)

    @F.pandas_udf(DoubleType())
    def lower_bound(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            pieces = [beta_quantile(a.to_numpy()[i : i + 4096], b.to_numpy()[i : i + 4096], lower_tail) for i in range(0, len(a), 4096)]
            yield pd.Series(np.concatenate(pieces) if pieces else np.zeros(0))

    prior = F.lit(strength) * F.col("parent_mean")
    return (
        counts.withColumn("alpha", prior + F.col("good"))
        .withColumn("beta", F.lit(strength) - prior + F.col("n") - F.col("good"))
        .withColumn("good_rate", F.col("alpha") / (F.col("alpha") + F.col("beta")))
        .withColumn("good_rate_low", lower_bound("alpha", "beta"))
        .select("host", "domain", "suffix", "n_pages", "n", "good", "alpha", "beta", "good_rate", "good_rate_low")
    )


def _shrunk(children: DataFrame, strength: float) -> DataFrame:
    return children.withColumn("mean", (F.lit(strength) * F.col("parent_mean") + F.col("good")) / (F.lit(strength) + F.col("n")))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = (), min_good: float = 0.5, lower_tail: float = 0.05) -> DataFrame:
    """page_id, host, path, rule, verdict, good_rate and good_rate_low of every page.

    The longest fitting rule decides; else a page is allowed if the `lower_tail` quantile of its host's good rate is at least `min_good`.
    """
    hosts = host_reputation(pages, outcomes, lower_tail).select("host", "good_rate", "good_rate_low")
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).join(hosts, "host")
    by_method = F.when(F.col("good_rate_low") >= min_good, "allow").otherwise("block")
    host, path = F.col("host"), F.col("path")
    return judged.select(
        "page_id",
        "host",
        "path",
        first_match(host, path, rules, "text").alias("rule"),
        F.coalesce(first_match(host, path, rules, "verdict"), by_method).alias("verdict"),
        "good_rate",
        "good_rate_low",
    )

"""Document quality by hierarchical empirical Bayes.

A logistic classifier over a text's own statistics gives the evidence of a document. Labelled documents,
grouped by host and by path within the host, give counts of good and bad. Each level is a beta-binomial whose
prior mean is the posterior mean of the level above (all documents, host, path) and whose weight is fitted
to the spread between the groups, so sparse sites shrink towards the global share. A document's score joins
its evidence with the log-odds of its path.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import free_name, written


def statistics(text: Column) -> list[Column]:
    """Bounded statistics of a whole text: length, symbols, capitals, digits, shouting, repeated words and lines."""
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(F.char_length(text), F.lit(1))

    def share(removed: str) -> Column:
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, removed, ""))) / n

    words = F.split(text, r"\s+")
    lines = F.split(text, "\n")
    count = F.greatest(F.size(words), F.lit(1))
    return [
        F.least(F.log(F.lit(1.0) + F.char_length(text)) / 10, F.lit(1.5)),
        share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"), share(r"\p{Lu}"), share(r"\p{N}"), share("[!?|]"),
        F.size(F.array_distinct(words)) / count, F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        F.least(n / count / 20, F.lit(2.0)), F.least(F.size(lines) / count, F.lit(1.0)),
    ]


N_STATISTICS = 9


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the offset last, means, spreads) by Newton steps; one class or no rows: zero weights."""
    if not len(y) or y.min() == y.max():
        return np.zeros(N_STATISTICS + 1), np.zeros(N_STATISTICS), np.ones(N_STATISTICS)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * N_STATISTICS + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - y) + penalty @ w)
        w = w - np.clip(step, -2, 2)
    return w, mean, spread


def prior_weight(groups: DataFrame) -> float:
    """The pseudo-count of the prior by the method of moments over (good, n, mean), 1 to 1000.

    ``mean`` is the prior mean of each group. Groups that differ no more than chance leaves it at 1000.
    """
    row = groups.where("n >= 2").agg(
        F.sum("n"), F.count("*"),
        F.sum((F.col("good") - F.col("n") * F.col("mean")) ** 2 / F.col("n")),
        F.sum(F.col("mean") * (1 - F.col("mean"))), F.sum(F.col("n") * F.col("mean") * (1 - F.col("mean")))).first()
    total, count, spread, single, weighted = (float(v or 0) for v in row)
    if count < 2 or weighted <= 0:
        return 10.0
    # the mean of spread is single * (1 + (n - 1) * rho)
    rho = (spread - single) / max(weighted - single, 1e-9)
    return float(np.clip(1 / rho - 1, 1, 1000)) if rho > 0 else 1000.0


def posteriors(labelled: DataFrame, host: str, path: str) -> tuple[DataFrame, DataFrame, float, float]:
    """Host posteriors (host, host_mean), path posteriors (host, path, path_mean), the global mean, and the weight
    of the path level's prior.

    ``labelled`` has (host, path, good 0 or 1); groups are counted with partial sums. Null hosts and paths are
    groups of their own.
    """
    cells = written(labelled.groupBy(host, path).agg(F.sum("good").alias("good"), F.count("*").alias("n")), "quality-cells")
    good, n = cells.agg(F.sum("good"), F.sum("n")).first()
    mean = (float(good or 0) + 1) / (float(n or 0) + 2)
    hosts = cells.groupBy(host).agg(F.sum("good").alias("good"), F.sum("n").alias("n")).withColumn("mean", F.lit(mean))
    weight = prior_weight(hosts)
    hosts = hosts.select(host, ((F.col("good") + weight * F.col("mean")) / (F.col("n") + weight)).alias("host_mean"))
    own = cells.withColumnsRenamed({host: "h"}).join(hosts, F.col("h").eqNullSafe(F.col(host))).select(
        host, path, "good", "n", F.col("host_mean").alias("mean"))
    inner = prior_weight(own)
    paths = own.select(host, path, ((F.col("good") + inner * F.col("mean")) / (F.col("n") + inner)).alias("path_mean"))
    return hosts, paths, mean, inner


def score(docs: DataFrame, labels: DataFrame, usable: Column | None = None, host: str = "source", path: str = "lang",
          key: str = "doc_id", text: str = "text", most: int = 20_000, name: str = "score") -> DataFrame:
    """(key, score): the probability that a document is of good quality, one row per row of ``docs``.

    The classifier is fitted to at most about ``most`` labelled documents, chosen by a hash of the id; the
    counts of hosts and paths use every usable label. Contradicting labels count each. Hosts and paths without
    labels have the mean of the level above. Null texts are scored as empty ones. No labels: every score
    is one half.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & (F.lit(True) if usable is None else usable))
    marked = marked.select(F.col(key).alias("id"), F.col("quality").cast("int").alias("good"))
    rows = docs.select(F.col(key).alias("id"), F.col(host).alias("host"), F.col(path).alias("path"), *[
        c.cast("double").alias(f"x{k}") for k, c in enumerate(statistics(F.col(text)))])
    rows = written(rows, "quality-statistics")
    known = rows.join(marked, "id")
    n = marked.count()
    scale = 1 << 30
    sample = known.where(F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(scale)) < (scale if n <= most else int(scale * most / n)))
    found = sample.select("id", "good", *[f"x{k}" for k in range(N_STATISTICS)]).toPandas().sort_values("id")
    x, y = found[[f"x{k}" for k in range(N_STATISTICS)]].to_numpy(float), found["good"].to_numpy(float)
    weights, mean, spread = fit_logistic(x, y)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    logit = F.lit(float(weights[-1])) if weights.any() else F.lit(float(np.log(share / (1 - share))))
    for k in range(N_STATISTICS):
        logit = logit + F.lit(float(weights[k] / spread[k])) * (F.col(f"x{k}") - F.lit(float(mean[k])))
    evidence = logit - F.lit(float(np.log(share / (1 - share))))  # log-likelihood ratio: without the sample's own odds
    hosts, paths, overall, _ = posteriors(known.select("host", "path", "good"), "host", "path")
    placed = rows.select("id", "host", "path", evidence.alias("evidence")).join(
        paths.withColumnsRenamed({"host": "h", "path": "p"}), F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left"
    ).join(hosts.withColumnRenamed("host", "h2"), F.col("host").eqNullSafe(F.col("h2")), "left")
    prior = F.coalesce("path_mean", "host_mean", F.lit(overall))
    odds = F.col("evidence") + F.log(prior / (1 - prior))
    name = free_name([key], name)
    return placed.select(F.col("id").alias(key), (1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))))).alias(name),
                         prior.alias("site_prior"), "evidence")

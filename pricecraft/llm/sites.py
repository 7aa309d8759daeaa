"""Quality by hierarchical empirical Bayes (operator 5).

A document's own evidence is a naive Bayes log-likelihood ratio over intervals
of its text statistics, scaled to a calibrated log-odds.  Its host and its path
add what is known of their other documents: the share of good documents of a
host is shrunk towards the global share, that of a path towards its host's.
How strongly is estimated from the data, by the spread of shares between the
groups beyond what chance explains (method of moments for beta-binomial
counts); so sparse sites stay near the prior and large ones keep their share.

All fitting is grouped aggregation in Spark.  The driver sees interval counts
and a few totals; host and path tables are joined, not broadcast by hand, and
a host with a third of all documents is summed up in every task first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, save
from .statistics import rates, text_statistics

INTERVALS = 16
THRESHOLD = 0.5
STEP = 0.25                 # of the log-likelihood ratios that are calibrated
LIMIT = 40.0


@dataclass
class Prior:
    """Global share and the strengths of the priors of hosts and paths."""

    share: float
    host: float
    path: float


def strength(pooled: float, extra: float, groups: int, rows: int, squares: float) -> float:
    """Prior observations of a beta-binomial from the pooled spread
    ``extra`` = sum of n (p - expected)^2 / (expected (1 - expected))."""
    if groups < 2 or rows <= groups:
        return 1e4
    free = rows - squares / rows - (groups - 1)
    rho = (extra - (groups - 1)) / free if free > 0 else 0.0
    rho = min(max(rho, 1e-4), 0.999)
    return (1 - rho) / rho


def _spread(groups: DataFrame, expected: Column) -> tuple[float, int, int, float]:
    n, p = F.col("n"), F.col("good") / F.col("n")
    r = groups.agg(F.sum(n * (p - expected) ** 2 / (expected * (1 - expected))).alias("e"), F.count(F.lit(1)).alias("g"),
                   F.sum(n).alias("n"), F.sum((n * n).cast("double")).alias("s")).first()
    return float(r["e"] or 0), int(r["g"]), int(r["n"] or 0), float(r["s"] or 0)


def site_posteriors(rows: DataFrame) -> tuple[Prior, DataFrame, DataFrame]:
    """(prior, hosts (host, host_share), paths (host, path, path_share)) from
    rows (host, path, good 0 or 1).  Null hosts and paths are groups of their own."""
    paths = save(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")), "site-counts")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("g")).first()
    share = (float(total["g"] or 0) + 1) / (float(total["n"] or 0) + 2)
    e, g, n, s = _spread(hosts, F.lit(share))
    m1 = strength(share, e, g, n, s)
    host_table = hosts.select("host", ((F.col("good") + m1 * share) / (F.col("n") + m1)).alias("host_share"))
    with_host = paths.join(host_table.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    e, g, n, s = _spread(with_host, F.col("host_share"))
    m2 = strength(share, e, g, n, s)
    path_table = with_host.select("host", "path", ((F.col("good") + m2 * F.col("host_share")) / (F.col("n") + m2)).alias("path_share"))
    return Prior(share, m1, m2), host_table, path_table


def learn_evidence(rows: DataFrame, measures: list[str]) -> Column:
    """The calibrated log-odds of a good document as an expression of the
    measures; 0 slope and the base rate where a class is missing."""
    points = [i / INTERVALS for i in range(1, INTERVALS)]
    got = rows.agg(*(F.percentile_approx(m, points, 10_000).alias(m) for m in measures)).first()
    cuts = {m: sorted(set(got[m] or [])) for m in measures}
    place = {m: sum((F.when(F.col(m) > F.lit(c), 1).otherwise(0) for c in cuts[m]), F.lit(0)) for m in measures}
    counts = rows.select("good", F.explode(F.array(*(F.struct(F.lit(m).alias("m"), i.alias("i")) for m, i in place.items()))).alias("x")) \
        .groupBy("x.m", "x.i").agg(F.sum("good").alias("g"), F.count(F.lit(1)).alias("n")).collect()
    table = {(r["m"], r["i"]): (int(r["g"]), int(r["n"] - r["g"])) for r in counts}
    good = sum(table.get((measures[0], i), (0, 0))[0] for i in range(len(cuts[measures[0]]) + 1))
    bad = sum(table.get((measures[0], i), (0, 0))[1] for i in range(len(cuts[measures[0]]) + 1))
    base = float(np.log((good + 1) / (bad + 1)))
    if not good or not bad:
        return F.lit(base)
    ratio = F.lit(0.0)
    for m in measures:
        k = len(cuts[m]) + 1
        llr = []
        for i in range(k):
            g, b = table.get((m, i), (0, 0))
            llr.append(float(np.log((g + 1) / (good + k)) - np.log((b + 1) / (bad + k))))
        at = F.lit(llr[-1])
        for i in range(k - 2, -1, -1):
            at = F.when(F.col(m) <= F.lit(cuts[m][i]), F.lit(llr[i])).otherwise(at)
        ratio = ratio + at
    clipped = F.greatest(F.least(ratio, F.lit(LIMIT)), F.lit(-LIMIT))
    bins = rows.groupBy(F.round(clipped / STEP).cast("int").alias("x")).agg(F.sum("good").alias("g"), F.count(F.lit(1)).alias("n")).collect()
    slope, shift = fit_line([(r["x"] * STEP, int(r["g"]), int(r["n"])) for r in bins], base)
    return F.lit(slope) * clipped + F.lit(shift)


def fit_line(points: list[tuple[float, int, int]], base: float) -> tuple[float, float]:
    """Slope and shift of log-odds of good against x (Newton steps with a weak
    prior at slope 0.5; the slope is not negative)."""
    x, g, n = (np.array(v, np.float64) for v in zip(*points))
    w = np.array([0.5, base])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30)))
        grad = np.array([((g - n * p) * x).sum() - (w[0] - 0.5), (g - n * p).sum() - 0.01 * (w[1] - base)])
        h = n * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, learn: Column | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, doc_score, path_share, score double (probability of a good
    document), kept boolean (score >= threshold) of every row of ``docs``.

    ``labels`` (doc_id, quality 0 or 1) for which ``learn`` holds are used.
    Unknown paths take their host's share, unknown hosts the global one.  Null
    texts have no words and are scored as such; null hosts and paths are groups;
    repeated rows stay repeated; without labels every score is 1/2.
    """
    stats = save(text_statistics(docs, windows=False, keep={"host": host, "path": path}), "site-statistics")
    measures = {m: c.cast("double") for m, c in rates(stats).items() if m != "repeats"}
    stats = stats.select("doc_id", "host", "path", *(c.alias(m) for m, c in measures.items()))
    lab = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg((F.max(F.col("quality").cast("int")) > 0).cast("int").alias("good"))
    train = save(stats.dropDuplicates(["doc_id"]).join(lab.where(F.lit(True) if learn is None else learn), "doc_id"), "site-labels")
    evidence = learn_evidence(train, list(measures))
    prior, hosts, paths = site_posteriors(train)
    out = stats.select("doc_id", "host", "path", evidence.alias("own")) \
        .join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")), "left").drop("h") \
        .join(paths.select(F.col("host").alias("h"), F.col("path").alias("p"), "path_share"),
              F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
    share = F.coalesce("path_share", "host_share", F.lit(prior.share))
    score = 1 / (1 + F.exp(-(F.col("own") + logit(share) - logit(F.lit(prior.share)))))
    return out.select("doc_id", (1 / (1 + F.exp(-F.col("own")))).alias("doc_score"), share.alias("path_share"), score.alias("score"),
                      (score >= threshold).alias("kept"))


def held_out_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents, with their source as host and source and language as
    path; labels whose crc32(doc_id) mod 4 is 2 are held out."""
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    got = site_quality(docs, labels, F.col("source").cast("string"), F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")), ~held)
    return got.select("doc_id", held.alias("held_out"), "doc_score", "path_share", "score", "kept")

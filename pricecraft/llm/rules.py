"""Quality rules as a learned decision list (operator 3); Spark expressions only.

Sequential covering: rules that reject documents are learned one by one from
labelled statistics.  A rule grows by the threshold condition of greatest FOIL
gain on the grow part of the labels until it rejects no good document there,
and is pruned on the prune part by dropping its last conditions while the
share of bad minus good documents it rejects does not fall.  Rules that are
not precise enough on the prune part end the list.  Documents that a rule
covers are taken out before the next one is learned.

Thresholds are quantiles of the statistics.  The driver sees counts only:
measures x thresholds x 2 per grown condition, whatever the corpus.  The list
becomes one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, save
from .statistics import rates, text_statistics

THRESHOLDS = 64
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.85        # of a rule, on the prune part
MIN_COVERED = 5             # bad documents that a rule rejects there
MAX_LABELS = 200_000        # labelled rows used, first in order of a hash of their id


@dataclass(frozen=True)
class Condition:
    """measure <= threshold, or > if ``above``."""

    measure: str
    above: bool
    threshold: float
    cut: int = 0            # which of the measure's thresholds it is

    def column(self, intervals: bool = False) -> Column:
        """On the measure itself, or on the number of its interval."""
        c, t = F.col(self.measure), F.lit(self.cut if intervals else self.threshold)
        return c > t if self.above else c <= t

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def all_of(rule: Rule, intervals: bool = False) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(intervals)
    return out


def interval(c: Column, cuts: list[float]) -> Column:
    """How many of the rising cuts are less than c (a binary search)."""

    def place(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c <= F.lit(cuts[mid]), place(lo, mid)).otherwise(place(mid + 1, hi))
    return place(0, len(cuts))


def thresholds(rows: DataFrame, measures: list[str]) -> dict[str, list[float]]:
    """Distinct quantiles of each measure (approximate, bounded state)."""
    points = [i / THRESHOLDS for i in range(THRESHOLDS + 1)]
    got = rows.agg(*(F.percentile_approx(m, points, 10_000).alias(m) for m in measures)).first()
    return {m: sorted(set(got[m] or [])) for m in measures}


def _tally(rows: DataFrame, rule: Rule, measures: list[str]) -> dict[str, list[tuple[int, int, int]]]:
    """Per measure (interval, bad, good) of the rows that the rule covers;
    interval i is above i of the thresholds."""
    place = [F.struct(F.lit(m).alias("m"), F.col(m).alias("i")) for m in measures]
    out: dict[str, list[tuple[int, int, int]]] = {}
    for r in rows.where(all_of(rule, True)).select("bad", F.explode(F.array(*place)).alias("x")).groupBy("x.m", "x.i") \
            .agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        out.setdefault(r["m"], []).append((r["i"], int(r["b"]), int(r["n"] - r["b"])))
    return out


def best_condition(tally: dict[str, list[tuple[int, int, int]]], cuts: dict[str, list[float]]) -> tuple[float, Condition] | None:
    """The condition of greatest FOIL gain; ties go to the first in order of
    measure, side and threshold."""
    from math import log2
    best = None
    for m in sorted(tally):
        bad, good = sum(x[1] for x in tally[m]), sum(x[2] for x in tally[m])
        if not bad:
            return None
        was = log2(bad / (bad + good))
        for k, cut in enumerate(cuts[m]):
            low_b, low_g = sum(x[1] for x in tally[m] if x[0] <= k), sum(x[2] for x in tally[m] if x[0] <= k)
            for above, b, g in ((False, low_b, low_g), (True, bad - low_b, good - low_g)):
                if b and b + g < bad + good:
                    gain = b * (log2(b / (b + g)) - was)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, Condition(m, above, cut, k)
    return best


def learn_rules(stats: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> list[Rule]:
    """The ordered rules, from ``stats`` (doc_id and text_statistics) and
    ``labels`` (doc_id, quality 0 or 1).

    Labels without an id or a quality are left out; an id with several labels
    counts as good if one of them says so.  Without bad or good documents the
    list is empty and nothing is rejected.
    """
    lab = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col("quality").cast("int")).alias("quality")).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_labels)
    measures = rates(stats)
    rows = save(stats.dropDuplicates(["doc_id"]).select("doc_id", *(c.cast("double").alias(m) for m, c in measures.items())).join(lab, "doc_id")
                .select(*measures, (F.col("quality") <= 0).cast("int").alias("bad"),
                        (F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(3)) == 0).alias("prune")), "quality-labels")
    cuts = {m: c for m, c in thresholds(rows, list(measures)).items() if c}
    if not cuts:
        drop(rows)
        return []
    numbered = save(rows.select("bad", "prune", *(interval(F.col(m), c).alias(m) for m, c in cuts.items())), "quality-intervals")
    drop(rows)
    rows = numbered
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < MAX_RULES:
        grow = rows.where(left & ~F.col("prune"))
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            tally = _tally(grow, rule, list(cuts))
            if not tally or not any(g for _, _, g in next(iter(tally.values()))):
                break
            found = best_condition(tally, cuts)
            if found is None:
                break
            rule = (*rule, found[1])
        if not rule:
            break
        rule, bad, good = _prune(rows.where(left & F.col("prune")), rule)
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(rule)
        left = left & ~all_of(rule, True)
    drop(rows)
    return rules


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of the rule with the greatest (bad - good) / (bad + good)
    on these rows, the shortest among equals, and what it covers."""
    sums = []
    for k in range(1, len(rule) + 1):
        c = all_of(rule[:k], True)
        sums += [F.coalesce(F.sum(F.when(c, F.col("bad"))), F.lit(0)).alias(f"b{k}"),
                 F.coalesce(F.sum(F.when(c, 1 - F.col("bad"))), F.lit(0)).alias(f"g{k}")]
    got = rows.agg(*sums).first()
    worth = [((got[f"b{k}"] - got[f"g{k}"]) / max(1, got[f"b{k}"] + got[f"g{k}"]), -k) for k in range(1, len(rule) + 1)]
    k = -max(worth)[1]
    return rule[:k], int(got[f"b{k}"]), int(got[f"g{k}"])


def rejected_by(rules: list[Rule]) -> Column:
    """The ordered expression: the number (from 1) of the first rule that
    holds, null if none does."""
    out = None
    for i, r in enumerate(rules):
        out = F.when(all_of(r), F.lit(i + 1)) if out is None else out.when(all_of(r), F.lit(i + 1))
    return F.lit(None).cast("int") if out is None else out


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with base_failed, rule int (the first that rejects, null if
    none does) and kept."""
    measures = rates(stats)
    d = stats.select("*", *(c.cast("double").alias(m) for m, c in measures.items()))
    d = d.select(*stats.columns, base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"), rejected_by(rules).alias("rule"))
    return d.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, rule, kept of every row of ``docs`` (doc_id, text).

    Null and empty texts have no words, so they fail the base; repeated rows
    stay repeated; other columns are left behind; an empty table gives none.
    """
    return all_verdicts(docs, labels).drop("text_key")


def all_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``quality_verdicts`` with text_key, which tells rows of equal id apart."""
    stats = save(text_statistics(docs), "text-statistics")
    return judge(stats, learn_rules(stats, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                           "base_failed", "rule", "kept", "text_key")

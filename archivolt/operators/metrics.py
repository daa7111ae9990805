"""Evaluation metrics as DataFrame aggregates, and the small exact statistics that compare two systems."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.session import cut


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1(p: Column, r: Column) -> Column:
    """Harmonic mean, 0 where both are 0."""
    return ratio(2 * p * r, p + r)


def retrieval(ranked: DataFrame, gold: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, recall, mrr, ndcg, precision): ranked has (query_id, rank, id), gold (query_id, id).

    MRR looks at the whole ranking, the rest at the first k; nDCG has binary gain. A query without gold scores 0 recall; without
    results precision is 1, and nDCG is 1 only if there is no gold either."""
    g = gold.select("query_id", "id").distinct().withColumn("hit", F.lit(True))
    amount = g.groupBy("query_id").agg(F.count("*").alias("gold"))
    j = ranked.select("query_id", "rank", "id").join(g, ["query_id", "id"], "left")
    top = F.col("hit") & (F.col("rank") <= k)
    per = j.groupBy("query_id").agg(
        F.count_if(F.coalesce(top, F.lit(False))).alias("hits"),
        F.coalesce(F.max(F.when(F.col("hit"), 1 / F.col("rank"))), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.sum(F.when(top, 1 / F.log2(F.col("rank") + 1))), F.lit(0.0)).alias("dcg"),
        F.count_if(F.col("rank") <= k).alias("returned"),
    )
    out = per.join(amount, "query_id", "full_outer").na.fill({"hits": 0, "mrr": 0.0, "dcg": 0.0, "returned": 0, "gold": 0})
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(k), F.col("gold")))), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    ndcg = F.when(F.col("gold") == 0, F.when(F.col("returned") == 0, 1.0).otherwise(0.0)).otherwise(F.col("dcg") / ideal)
    precision = F.when(F.col("returned") == 0, 1.0).otherwise(F.col("hits") / F.col("returned"))
    return out.select("query_id", F.round(ratio(F.col("hits"), F.col("gold")), 6).alias("recall"), F.round("mrr", 6).alias("mrr"), F.round(ndcg, 6).alias("ndcg"), F.round(precision, 6).alias("precision"))


def covered_length(spans: DataFrame, keys: list[str], start: str = "start_char", end: str = "end_char") -> DataFrame:
    """(keys, covered): length of the union of each key's intervals."""
    w = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(end).over(w), F.lit(-1))
    new = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), reach))
    return spans.where(F.col(end) > F.col(start)).select(*keys, new.alias("new")).groupBy(*keys).agg(F.sum("new").alias("covered"))


def calibration_error(df: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """(ece): expected calibration error over equal bins, min(bins - 1, floor(confidence * bins))."""
    b = F.least(F.lit(bins - 1), F.floor(F.col(confidence) * bins))
    per = df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(confidence).alias("c"), F.avg(F.col(correct).cast("double")).alias("a"))
    return per.agg(F.round(F.sum(F.col("n") * F.abs(F.col("c") - F.col("a"))) / F.sum("n"), 6).alias("ece"))


def selective_coverage(df: DataFrame, confidence: str, correct: str, thresholds: tuple[float, ...] = (0.0, 0.5, 0.7, 0.9)) -> DataFrame:
    """(threshold, coverage, accuracy): how many rows pass each threshold, and how many of those are right; one pass."""
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    over = F.col(confidence) >= F.col("threshold")
    per = df.select(confidence, F.col(correct).cast("boolean").alias("ok"), t).groupBy("threshold").agg(F.count("*").alias("n"), F.count_if(over).alias("c"), F.count_if(over & F.col("ok")).alias("r"))
    return per.select("threshold", F.round(F.col("c") / F.col("n"), 6).alias("coverage"), F.round(ratio(F.col("r"), F.col("c")), 6).alias("accuracy"))


def linkage(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """(tp, fp, fn, precision, recall, f1) over unordered pairs (left, right)."""
    def pairs(d: DataFrame, name: str) -> DataFrame:
        return d.select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).where("a <> b").distinct().withColumn(name, F.lit(True))

    j = pairs(predicted, "p").join(pairs(gold, "g"), ["a", "b"], "full_outer")
    c = j.agg(F.count_if(F.col("p") & F.col("g")).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1(p, r), 6).alias("f1"))


def multiset_f1(a: DataFrame, b: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys, common, f1): multiset overlap of items per key."""
    ca, cb = a.groupBy(*keys, item).agg(F.count("*").alias("x")), b.groupBy(*keys, item).agg(F.count("*").alias("y"))
    per = ca.join(cb, [*keys, item], "full_outer").na.fill({"x": 0, "y": 0}).groupBy(*keys).agg(F.sum(F.least("x", "y")).alias("common"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    return per.select(*keys, "common", F.round(ratio(2 * F.col("common"), F.col("x") + F.col("y")), 6).alias("f1"))


def percentiles(df: DataFrame, keys: list[str], value: str, points: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Nearest-rank percentiles p50, p95, ... of each key."""
    return df.groupBy(*keys).agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})").alias(f"p{round(p * 100)}") for p in points])


def classification(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    """(class_id, tp, fp, fn, precision, recall, f1) for each class, from one aggregate of the confusion counts."""
    counts = df.groupBy(F.col(gold).alias("g"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    rows = counts.select(F.explode(F.array(F.struct(F.col("g").alias("class_id"), F.when(F.col("g") == F.col("p"), F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("fp"), F.when(F.col("g") != F.col("p"), F.col("n")).otherwise(0).alias("fn")), F.struct(F.col("p").alias("class_id"), F.lit(0).cast("long").alias("tp"), F.when(F.col("g") != F.col("p"), F.col("n")).otherwise(0).alias("fp"), F.lit(0).cast("long").alias("fn")))).alias("e")).select("e.*")
    c = rows.where("class_id is not null").groupBy("class_id").agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn")])
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("class_id", "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1(p, r), 6).alias("f1"))


def path_score(gold: Column, predicted: Column) -> Column:
    """Length of the common prefix of two class paths over the longer one."""
    same = F.zip_with(gold, predicted, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    common = F.when(first > 0, first - 1).otherwise(F.size(same))
    return ratio(common, F.greatest(F.size(gold), F.size(predicted)))


def sign_test(wins: int, losses: int) -> float:
    """Two-sided exact binomial tail, at most 1."""
    n, k = wins + losses, min(wins, losses)
    if n <= 1000:
        return 1.0 if not n else min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)
    # the tail from its largest term down, each a fraction of the one before, until they no longer count
    share, term = 0.0, 1.0
    while term > 1e-18 * share:
        share += term
        term *= k / (n - k + 1)
        k -= 1
    k = min(wins, losses)
    return min(1.0, 2 * share * math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) - n * math.log(2)))


def bootstrap(differences: list[float], resamples: int = 2000, confidence: float = 0.95, seed: int = 13) -> tuple[float, float]:
    """Seeded percentile interval of the mean of paired differences, a list of bounded length such as one per case."""
    rng, n = random.Random(seed), len(differences)
    means = sorted(sum(differences[rng.randrange(n)] for _ in range(n)) / n for _ in range(resamples))
    tail = (1 - confidence) / 2
    return means[round(tail * (resamples - 1))], means[round((1 - tail) * (resamples - 1))]


#: Up to so many cases are resampled on the driver, one by one.
_FEW = 1000


def _poisson_sums(resamples: int, seed: int):
    """(resample, total, cases): one partition's part of every resample, in which n equal differences count a Poisson(n) number of times."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, cases = np.zeros(resamples), np.zeros(resamples, np.int64)
        for pdf in batches:
            for d, n, key in zip(pdf["d"], pdf["n"], pdf["key"]):
                drawn = np.random.default_rng([seed, key & 0xFFFFFFFFFFFFFFFF]).poisson(n, resamples)
                total += d * drawn
                cases += drawn
        yield pd.DataFrame({"resample": np.arange(resamples), "total": total, "cases": cases})

    return run


def poisson_bootstrap(differences: DataFrame, resamples: int = 2000, confidence: float = 0.95, seed: int = 13) -> tuple[float, float]:
    """The interval of bootstrap for any number of cases: differences has (d, n), each d once; only the resamples reach the driver.

    Draws are seeded by the difference itself, so they don't depend on the partitions."""
    part = differences.select("d", "n", F.xxhash64("d").alias("key")).mapInPandas(_poisson_sums(resamples, seed), "resample int, total double, cases long")
    sums = part.groupBy("resample").agg(F.sum("total").alias("total"), F.sum("cases").alias("cases")).where("cases > 0").collect()
    means = sorted(r.total / r.cases for r in sums)
    tail = (1 - confidence) / 2
    return means[round(tail * (len(means) - 1))], means[round((1 - tail) * (len(means) - 1))]


def paired_verdict(pairs: DataFrame, resamples: int = 2000, seed: int = 13) -> dict:
    """adopt, retain or inconclusive for (candidate, baseline) scores per case, over all cases.

    Wins and losses are aggregates; a few cases are resampled on the driver, more by a distributed Poisson bootstrap."""
    spread = cut(pairs.select("candidate", "baseline").dropna().groupBy((F.col("candidate") - F.col("baseline")).alias("d")).agg(F.count("*").alias("n")))
    total = spread.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("d") > 0, F.col("n"))).alias("wins"), F.sum(F.when(F.col("d") < 0, F.col("n"))).alias("losses")).first()
    n, wins, losses = total.n or 0, total.wins or 0, total.losses or 0
    if n > _FEW:
        low, high = poisson_bootstrap(spread, resamples, seed=seed)
    else:
        d = [r.candidate - r.baseline for r in pairs.select("candidate", "baseline").dropna().orderBy("candidate", "baseline").collect()]
        low, high = bootstrap(d, resamples, seed=seed) if d else (0.0, 0.0)
    p = sign_test(wins, losses)
    verdict = "adopt" if low > 0 and p < 0.05 else "retain" if high < 0 and p < 0.05 else "inconclusive"
    return {"wins": wins, "losses": losses, "ties": n - wins - losses, "p": p, "low": low, "high": high, "verdict": verdict}

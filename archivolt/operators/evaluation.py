"""Evaluation of extraction, retrieval and comparisons beyond single ratios: spans, hard negatives, arms, gates and verdicts."""

from __future__ import annotations

import hashlib
import json
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.operators.metrics import f1, ratio


def span_scores(gold: DataFrame, predicted: DataFrame, keys: tuple[str, ...] = ("document_id", "start_char", "end_char", "kind")) -> DataFrame:
    """(tp, fp, fn, precision, recall, f1) of exact spans taken as sets; 1 for nothing expected and nothing found."""
    g = gold.select(*keys).distinct().withColumn("g", F.lit(1))
    p = predicted.select(*keys).distinct().withColumn("p", F.lit(1))
    c = g.join(p, list(keys), "full_outer").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    empty = (F.col("tp") + F.col("fp") + F.col("fn")) == 0
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    one = lambda x: F.when(empty, 1.0).otherwise(F.round(x, 6))
    return c.select("tp", "fp", "fn", one(precision).alias("precision"), one(recall).alias("recall"), one(f1(precision, recall)).alias("f1"))


def failure_agreement(gold: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """(both, only_gold, only_predicted, neither, agreement) of two tables (key, failed): whether the same items failed."""
    j = gold.select(key, F.col("failed").alias("g")).join(predicted.select(key, F.col("failed").alias("p")), key, "full_outer").na.fill({"g": False, "p": False})
    c = j.agg(F.count_if(F.col("g") & F.col("p")).alias("both"), F.count_if(F.col("g") & ~F.col("p")).alias("only_gold"), F.count_if(~F.col("g") & F.col("p")).alias("only_predicted"), F.count_if(~F.col("g") & ~F.col("p")).alias("neither"), F.count("*").alias("n"))
    return c.select("both", "only_gold", "only_predicted", "neither", F.round(ratio(F.col("both") + F.col("neither"), F.col("n")), 6).alias("agreement"))


def served(ranked: DataFrame, chunks: DataFrame, spans: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, intact, covered, served_chars): of each case's gold spans the share that lies whole in one of the first k chunks, the
    share of their characters in any of them, and the characters served.

    ranked has (query_id, rank, chunk_id), chunks (chunk_id, document_id, start_char, end_char), spans (query_id, document_id,
    start_char, end_char). A case without spans has both shares 1."""
    top = ranked.where(F.col("rank") <= k).select("query_id", "chunk_id").distinct().join(chunks.select("chunk_id", "document_id", F.col("start_char").alias("cs"), F.col("end_char").alias("ce")), "chunk_id")
    amount = top.groupBy("query_id").agg(F.sum(F.col("ce") - F.col("cs")).alias("served_chars"))
    s = spans.select("query_id", "document_id", F.col("start_char").alias("a"), F.col("end_char").alias("b")).distinct()
    # only the k chunks of a case meet its own spans
    j = s.join(top, ["query_id", "document_id"], "left")
    whole = F.coalesce(F.max((F.col("cs") <= F.col("a")) & (F.col("ce") >= F.col("b"))), F.lit(False))
    parts = F.sort_array(F.collect_list(F.when((F.col("cs") < F.col("b")) & (F.col("ce") > F.col("a")), F.struct(F.greatest("cs", "a").alias("x"), F.least("ce", "b").alias("y")))))
    per = j.groupBy("query_id", "document_id", "a", "b").agg(whole.alias("whole"), parts.alias("parts"))
    union = F.aggregate("parts", F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("n")), lambda st, x: F.struct(F.greatest(st["at"], x["y"].cast("long")).alias("at"), (st["n"] + F.greatest(F.lit(0), x["y"] - F.greatest(st["at"], x["x"].cast("long")))).cast("long").alias("n")))["n"]
    c = per.withColumn("n", union).groupBy("query_id").agg(F.avg(F.col("whole").cast("int")).alias("intact"), ratio(F.sum("n"), F.sum(F.col("b") - F.col("a"))).alias("covered"))
    cases = ranked.select("query_id").union(spans.select("query_id")).distinct()
    return cases.join(c, "query_id", "left").join(amount, "query_id", "left").select("query_id", F.round(F.coalesce("intact", F.lit(1.0)), 6).alias("intact"), F.round(F.coalesce("covered", F.lit(1.0)), 6).alias("covered"), F.coalesce("served_chars", F.lit(0)).alias("served_chars"))


def judged(ranked: DataFrame, judgements: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, relevant, hard_negative, forbidden, unjudged, false_positive, exact): what each case's first k hits were.

    judgements has (query_id, id, grade: relevant, hard-negative or forbidden). A false positive is any hit of a case without
    relevant items; exact is whether the first hit is relevant."""
    top = ranked.where(F.col("rank") <= k).select("query_id", "rank", "id").join(judgements.select("query_id", "id", "grade").distinct(), ["query_id", "id"], "left")
    n = lambda grade: F.count_if(F.col("grade") == grade)
    per = top.groupBy("query_id").agg(n("relevant").alias("relevant"), n("hard-negative").alias("hard_negative"), n("forbidden").alias("forbidden"), F.count_if(F.col("grade").isNull()).alias("unjudged"), F.count("*").alias("hits"), F.coalesce(F.max((F.col("rank") == 1) & (F.col("grade") == "relevant")), F.lit(False)).alias("exact"))
    wanted = judgements.where("grade = 'relevant'").select("query_id").distinct().withColumn("wanted", F.lit(True))
    cases = judgements.select("query_id").union(ranked.select("query_id")).distinct()
    j = cases.join(per, "query_id", "left").join(wanted, "query_id", "left").na.fill({"relevant": 0, "hard_negative": 0, "forbidden": 0, "unjudged": 0, "hits": 0, "exact": False})
    return j.select("query_id", "relevant", "hard_negative", "forbidden", "unjudged", (F.col("wanted").isNull() & (F.col("hits") > 0)).alias("false_positive"), "exact")


def arm_summary(scores: DataFrame, value: str = "score") -> DataFrame:
    """(arm, cohort, n, mean, median) of scores (arm, cohort, score), the median exact, by counts of the distinct scores."""
    per = scores.where(F.col(value).isNotNull()).groupBy("arm", "cohort", F.col(value).alias("v")).agg(F.count("*").alias("n"))
    return per.groupBy("arm", "cohort").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 6).alias("mean"), F.round(F.expr("percentile(v, 0.5, n)"), 6).alias("median"))


def protocol(arms: list[str], cases: list[str], repetitions: int, seed: int = 13) -> list[tuple[int, str, str, int]]:
    """(turn, arm, case, repetition) of a second opinion, in a seeded order that mixes the arms."""
    runs = [(a, c, r) for a in sorted(arms) for c in sorted(cases) for r in range(repetitions)]
    random.Random(seed).shuffle(runs)
    return [(k, *x) for k, x in enumerate(runs)]


def gates(report: dict[str, float], limits: dict[str, tuple[str, float]]) -> dict[str, bool]:
    """Which mandatory gates hold: limits are {metric: ("at least" or "at most", value)}; a missing metric never holds."""
    return {m: m in report and (report[m] >= v if side == "at least" else report[m] <= v) for m, (side, v) in sorted(limits.items())}


def verdict(paired: dict, passed: dict[str, bool]) -> str:
    """adopt only if the comparison says so and every gate holds; retain if a gate fails or the baseline won, else inconclusive."""
    if not all(passed.values()):
        return "retain"
    return paired["verdict"]


def seed_sensitivity(verdicts: list[str]) -> bool:
    """Whether verdicts of several seeds differ, so that none of them should be trusted."""
    return len(set(verdicts)) > 1


def load_split(rows: list[dict], fingerprint: str, least: dict[str, int]) -> list[dict]:
    """A frozen split of cases {id, cohort, query, ...}: refused unless its fingerprint is the stated one, ids and queries are
    distinct and every cohort has its least number of cases."""
    got = split_fingerprint(rows)
    if got != fingerprint:
        raise ValueError(f"the split is not as frozen: {got}")
    for name in ("id", "query"):
        if len({r[name] for r in rows}) != len(rows):
            raise ValueError(f"{name} repeats")
    for cohort, n in least.items():
        if sum(r["cohort"] == cohort for r in rows) < n:
            raise ValueError(f"cohort {cohort} has fewer than {n} cases")
    return rows


def split_fingerprint(rows: list[dict]) -> str:
    """SHA-256 of the cases in the order of their ids."""
    return hashlib.sha256(json.dumps(sorted(rows, key=lambda r: r["id"]), sort_keys=True, ensure_ascii=True).encode()).hexdigest()


def hierarchical(df: DataFrame, gold: str = "gold_path", predicted: str = "predicted_path") -> DataFrame:
    """(precision, recall, f1, distance): set overlap of class paths with their ancestors, and the mean number of steps between them."""
    common = F.size(F.array_intersect(gold, predicted))
    c = df.agg(F.sum(common).alias("c"), F.sum(F.size(gold)).alias("g"), F.sum(F.size(predicted)).alias("p"), F.avg(F.size(gold) + F.size(predicted) - 2 * common).alias("d"))
    p, r = ratio(F.col("c"), F.col("p")), ratio(F.col("c"), F.col("g"))
    return c.select(F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1(p, r), 6).alias("f1"), F.round("d", 6).alias("distance"))

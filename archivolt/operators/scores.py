"""Scores of single evaluation items as Column expressions, and the operators that need more than one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.operators.metrics import ratio


def close(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Whether two numbers agree within the tolerance; two nulls agree, one doesn't."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a.cast("double") - b.cast("double")) <= tolerance)


def set_f1(gold: Column, predicted: Column) -> Column:
    """F1 of two arrays as sets; 1 if both are empty."""
    g, p = F.array_distinct(gold), F.array_distinct(predicted)
    return F.when((F.size(g) == 0) & (F.size(p) == 0), 1.0).otherwise(ratio(2 * F.size(F.array_intersect(g, p)), F.size(g) + F.size(p)))


def bag_f1(gold: Column, predicted: Column) -> Column:
    """F1 of two arrays as bags: each item counts as often as it occurs in both."""
    common = F.aggregate(F.transform(F.array_distinct(gold), lambda w: F.least(F.size(F.filter(gold, lambda x: x == w)), F.size(F.filter(predicted, lambda x: x == w)))), F.lit(0), lambda s, x: s + x)
    return F.when((F.size(gold) == 0) & (F.size(predicted) == 0), 1.0).otherwise(ratio(2 * common, F.size(gold) + F.size(predicted)))


def interval_agreement(gold_start: Column, gold_end: Column, start: Column, end: Column) -> Column:
    """Whether both ends agree, nulls with nulls."""
    return gold_start.eqNullSafe(start) & gold_end.eqNullSafe(end)


def negative_case(expected_empty: Column, returned: Column) -> Column:
    """1 for a case without an answer exactly if nothing came back."""
    return F.when(expected_empty, (returned == 0).cast("double")).otherwise((returned > 0).cast("double"))


def review_precision(df: DataFrame, score: str, flagged: str, reviewed: str, budget: int) -> DataFrame:
    """(budget, precision): how many of the highest-scored budget rows reviewers agreed with; a top-k, the feature asked for."""
    if budget < 1:
        raise ValueError("a review budget is at least 1")
    top = df.where(F.col(flagged)).orderBy(F.desc(score)).limit(budget)
    return top.agg(F.count_if(F.col(reviewed)).alias("k"), F.count("*").alias("n")).select(F.lit(budget).alias("budget"), F.round(ratio(F.col("k"), F.col("n")), 6).alias("precision"))


def finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, bad): how many values of each metric column are null, NaN or infinite; such reports are refused."""
    bad = [F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))).alias(c) for c in columns]
    return df.agg(*bad).unpivot([], columns, "column", "bad")


def budgeted_text(parts: DataFrame, keys: list[str], order: list[str], text: str, budget: int) -> DataFrame:
    """Parts with the characters each keeps of a shared budget of its group, first come first served, and whether it was cut."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length(text)).over(w), F.lit(0))
    keep = F.greatest(F.lit(0), F.least(F.length(text), F.lit(budget) - before))
    return parts.withColumn("kept_chars", keep).withColumn("truncated", F.col("kept_chars") < F.length(text))


def reciprocal_links(ranked: DataFrame, k: int) -> DataFrame:
    """(left, right): pairs of which each ranks the other among its first k; ranked has (query_id, rank, id)."""
    near = ranked.where((F.col("rank") <= k) & (F.col("query_id") != F.col("id"))).select("query_id", "id")
    back = near.select(F.col("id").alias("query_id"), F.col("query_id").alias("id"))
    return near.join(back, ["query_id", "id"]).where("query_id < id").select(F.col("query_id").alias("left"), F.col("id").alias("right"))


def activation(report: DataFrame, blocking: list[str]) -> DataFrame:
    """(decision, blocking_failures, warnings): blocked if a blocking rule failed or never ran, quarantined on other failures, else active."""
    names = F.array(*[F.lit(b) for b in blocking])
    r = report.agg(F.collect_set(F.when(F.col("status").isin("pass", "not-applicable"), F.col("rule_id"))).alias("ok"), F.count_if(F.col("status") == "fail").alias("failed"), F.count_if((F.col("status") == "fail") & F.col("rule_id").isin(*blocking)).alias("hard"))
    missing = F.size(F.array_except(names, F.col("ok")))
    decision = F.when(missing > 0, "blocked").when(F.col("failed") > 0, "quarantined").otherwise("active")
    return r.select(decision.alias("decision"), missing.alias("blocking_failures"), (F.col("failed") - F.col("hard")).alias("warnings"))


def zipf_filler(spark, rows: int, words_each: int, vocabulary: int, seed: int = 7) -> DataFrame:
    """(id, text): seeded filler documents whose word ranks follow Zipf's law, made where they are used."""
    draws = F.transform(F.sequence(F.lit(1), F.lit(words_each)), lambda i: F.floor(F.pow(F.lit(float(vocabulary)), F.pmod(F.xxhash64(F.col("id"), i, F.lit(seed)), F.lit(1_000_003)) / 1_000_003.0)).cast("long"))
    return spark.range(rows).select("id", F.array_join(F.transform(draws, lambda r: F.concat(F.lit("w"), r.cast("string"))), " ").alias("text"))

"""Capacity forecasts: byte and time ranges of planned work, device budgets and the decision they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Planning bounds: output per input byte, seconds per GiB, factors of rotational devices.
AMPLIFY, SECONDS_GIB, ROTATIONAL = (2.5, 4.0), (20.0, 240.0), (1.5, 3.0)
GIB = 1 << 30


def ranges(work: DataFrame) -> DataFrame:
    """work (stage, input_bytes, truncated, rotational) with output and time ranges; truncated samples double the upper bound."""
    b = F.col("input_bytes").cast("double")
    twice = F.when(F.col("truncated"), 2.0).otherwise(1.0)
    low, high = (F.when(F.col("rotational"), x).otherwise(1.0) for x in ROTATIONAL)
    return work.select(
        "*",
        F.round(b * AMPLIFY[0]).cast("long").alias("output_low"),
        F.round(b * AMPLIFY[1] * twice).cast("long").alias("output_high"),
        F.round(b / GIB * SECONDS_GIB[0] * low, 6).alias("seconds_low"),
        F.round(b / GIB * SECONDS_GIB[1] * high * twice, 6).alias("seconds_high"),
    )


def device_budget(needs: DataFrame, devices: DataFrame, reserve: float = 0.1) -> DataFrame:
    """(device, peak, free, fits): summed peaks of the roots on each device against its free space less a reserve."""
    peak = needs.groupBy("device").agg(F.sum("output_high").alias("peak"))
    return peak.join(devices, "device", "left").select("device", "peak", "free", (F.col("peak") <= F.col("free") * (1 - reserve)).alias("fits"))


def decision(fits: Column, known: Column, degraded: Column) -> Column:
    """blocked, unknown, degraded or ready, the worst that holds."""
    return F.when(known & ~fits, "blocked").when(~known, "unknown").when(degraded, "degraded").otherwise("ready")


def gpu_placement(weights: Column, offload: Column, per_1k: Column, context: Column, batch: Column, overhead: Column) -> Column:
    """Bytes a model needs: weights less offload, key-value cache per thousand tokens of context and batch, overhead."""
    return weights - offload + per_1k * context / 1000 * batch + overhead


#: Output of each family of work per input byte, lower and upper bound.
FAMILIES = {"extract": (0.05, 0.6), "normalize": (0.9, 1.6), "dedupe": (0.02, 0.1), "chunk": (1.0, 1.8), "classify": (0.01, 0.05), "lexical": (0.8, 2.0), "vectors": (1.0, 6.0)}


def work_counts(inventory: DataFrame, plan: DataFrame) -> DataFrame:
    """(stage, family, files, input_bytes): the work of each planned stage (stage, family, media_prefix) over inventory files
    (media_type, size, cached): those whose type begins so, less what a cache holds."""
    todo = inventory.where(~F.coalesce(F.col("cached"), F.lit(False))).groupBy("media_type").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    # a few stages and media types
    j = plan.join(todo, F.col("media_type").startswith(F.col("media_prefix")), "left")
    return j.groupBy("stage", "family").agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("input_bytes"))


def family_ranges(work: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """work (stage, family, input_bytes) with output_low and output_high by family. measured has (family, input_bytes, output_bytes)
    of comparable earlier runs; where there are three or more, their least and greatest ratios replace the planning bounds."""
    low = F.create_map(*[F.lit(x) for k, v in FAMILIES.items() for x in (k, v[0])])[F.col("family")]
    high = F.create_map(*[F.lit(x) for k, v in FAMILIES.items() for x in (k, v[1])])[F.col("family")]
    if measured is not None:
        r = F.col("output_bytes") / F.col("input_bytes")
        seen = measured.where("input_bytes > 0").groupBy("family").agg(F.count("*").alias("runs"), F.min(r).alias("seen_low"), F.max(r).alias("seen_high")).where("runs >= 3")
        work = work.join(seen.drop("runs"), "family", "left")
        low, high = F.coalesce("seen_low", low), F.coalesce("seen_high", high)
    return work.select("stage", "family", "input_bytes", F.round(F.col("input_bytes") * F.coalesce(low, F.lit(AMPLIFY[0]))).cast("long").alias("output_low"), F.round(F.col("input_bytes") * F.coalesce(high, F.lit(AMPLIFY[1]))).cast("long").alias("output_high"))


def recheck(planned: dict, now: dict, needed: dict[str, int], free: dict[str, int]) -> list[str]:
    """Why a forecast no longer holds: inputs that changed since, and devices whose free space fell below what is needed."""
    out = [f"input {k} changed" for k in sorted(planned.keys() | now.keys()) if planned.get(k) != now.get(k)]
    return out + [f"device {d} lacks {n - free.get(d, 0)} bytes" for d, n in sorted(needed.items()) if free.get(d, 0) < n]

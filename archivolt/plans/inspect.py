"""Inspection of datasets and runs: reconciliation of projections, conformance, rebuild comparison, progress."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.contracts import Contract
from archivolt.functions.hashing import set_checksum
from archivolt.operators.quality import conforms
from archivolt.sources.files import footer_counts


def reconcile(source: DataFrame, projection: DataFrame, key: str) -> DataFrame:
    """(source_rows, projection_rows, missing, extra, same_ids): whether a projection holds exactly the source's keys.

    Checksums of both sides need one partial aggregate each; keys meet only in the anti joins."""
    a = source.agg(set_checksum(F.col(key)).alias("a"))
    b = projection.agg(set_checksum(F.col(key)).alias("b"))
    missing = source.select(key).join(projection.select(key), key, "left_anti").agg(F.count("*").alias("missing"))
    extra = projection.select(key).join(source.select(key), key, "left_anti").agg(F.count("*").alias("extra"))
    one = None
    for part in (a, b, missing, extra):  # four single rows, joined by a constant
        keyed = part.withColumn("one", F.lit(1))
        one = keyed if one is None else one.join(keyed, "one")
    return one.select(F.col("a.n").alias("source_rows"), F.col("b.n").alias("projection_rows"), "missing", "extra", (F.col("a") == F.col("b")).alias("same_ids"))


def same_content(a: DataFrame, b: DataFrame, without: tuple[str, ...] = ("generation_id",)) -> bool:
    """Whether two builds hold the same rows apart from generation tokens, whatever their order: counts and hash sums alone."""
    columns = sorted(c for c in a.columns if c not in without)
    if columns != sorted(c for c in b.columns if c not in without):
        return False
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    return a.agg(set_checksum(row).alias("c")).first() == b.agg(set_checksum(row).alias("c")).first()


def inspect_dataset(spark: SparkSession, path: str, contract: Contract | None = None) -> dict:
    """Files and rows by footer, partitions, and conformance: matching, drifted or unregistered. Reads no data."""
    counts = footer_counts(path)
    schema = spark.read.option("pathGlobFilter", "*.parquet").parquet(path).schema
    problems = conforms(spark.createDataFrame([], schema), contract.schema()) if contract else []
    parts: dict[str, int] = {}
    for name, n in counts:
        parts[os.path.dirname(name)] = parts.get(os.path.dirname(name), 0) + n
    return {"files": len(counts), "rows": sum(n for _, n in counts), "partitions": parts, "state": "unregistered" if contract is None else "drifted" if problems else "matching", "problems": problems}


def contract_files(contract: Contract) -> dict[str, str]:
    """Generated artifacts of a contract: Spark schema JSON and DDL, stable from run to run."""
    s = contract.schema()
    return {f"{contract.name}.schema.json": json.dumps(json.loads(s.json()), sort_keys=True, indent=2) + "\n", f"{contract.name}.ddl": ",\n".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in s) + "\n"}


@dataclass
class Progress:
    """Throttled progress of a stage: rate, time left, and whether it is slow or stalled; events go to every sink."""

    total: int
    sinks: list[Callable[[dict], None]] = field(default_factory=list)
    every: float = 1.0
    stalled_after: float = 60.0
    clock: Callable[[], float] = time.monotonic

    def __post_init__(self) -> None:
        self.began = self.moved = self.said = self.clock()
        self.done = 0

    def update(self, done: int) -> dict | None:
        """Note how much is done; returns the event if one was due."""
        now = self.clock()
        if done > self.done:
            self.done, self.moved = done, now
        if now - self.said < self.every and done < self.total:
            return None
        self.said = now
        speed = self.done / (now - self.began) if now > self.began else None
        state = "finished" if self.done >= self.total else "stalled" if now - self.moved > self.stalled_after else "running"
        event = {"done": self.done, "total": self.total, "rate": speed, "left_s": (self.total - self.done) / speed if speed else None, "state": state}
        for sink in self.sinks:
            sink(event)
        return event


def jsonl_sink(path: str) -> Callable[[dict], None]:
    """A sink that appends events to a JSON-lines file."""

    def write(event: dict) -> None:
        with open(path, "a") as f:
            f.write(json.dumps(event, sort_keys=True) + "\n")

    return write

"""Publication of datasets: staged writes with a sealed manifest, reuse by content, active pointers, and the stage graph."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions.hashing import canonical_json, set_checksum


class Files:
    """The few file operations of publication on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)

    def names(self, *parts: str) -> list[str]:
        """Names of the entries of a folder; none where there is no folder."""
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.path(*parts))) if self.exists(*parts) else []

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, text: str, *parts: str) -> None:
        """Write a small file so that readers see the old one or the new one, never a part."""
        target, fresh = self.path(*parts), self.path("/".join(parts) + ".new")
        stream = self.fs.create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        array = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        array[0] = options.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(fresh, target, array)


def _digests(spark: SparkSession, path: str) -> dict[str, str]:
    """SHA-256 of every Parquet file under a path, by relative name, hashed by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    name = F.regexp_extract("path", r"(data-[^/]+/.*)$", 1)
    return {r.name: r.digest for r in files.select(name.alias("name"), F.sha2("content", 256).alias("digest")).collect()}


def publish(df: DataFrame, path: str, keys: list[str], checks: Callable[[DataFrame], list[str]] | None = None, partition: str | None = None, max_parts: int = 10_000) -> dict:
    """Write df into a folder of its own under path, check it as written, then replace manifest.json, which names that folder.

    Readers follow the manifest, so they see the old data until the new is whole, and a failure leaves the old in place. Duplicate
    keys, failed checks and more than max_parts partition values raise. With a partition the manifest lists rows by its value."""
    spark = df.sparkSession
    fs = Files(spark, path)
    data = f"data-{uuid.uuid4().hex[:16]}"
    if partition:
        values = df.select(partition).distinct().limit(max_parts + 1).count()
        if values > max_parts:
            raise ValueError(f"not published: more than {max_parts} partitions")
    writer = (df.repartition(partition) if partition else df).write.option("compression", "zstd")
    try:
        (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/{data}")
        written = spark.read.schema(df.schema).parquet(f"{path}/{data}")
        bad = written.groupBy(*keys).count().where("count > 1").limit(1).count()
        problems = (["duplicate keys"] if bad else []) + (checks(written) if checks else [])
        if problems:
            raise ValueError(f"not published: {problems}")
        n = written.agg(set_checksum(F.concat_ws("|", *keys)).alias("c")).first().c
        manifest = {"rows": n.n, "checksum": f"{n.n}:{n.xored}:{n.summed}", "keys": keys, "data": data, "files": _digests(spark, f"{path}/{data}")}
        if partition:
            manifest["partitions"] = {str(r[0]): r[1] for r in written.groupBy(partition).count().orderBy(partition).collect()}
        fs.replace(canonical_json(manifest), path, "manifest.json")
    except BaseException:
        fs.delete(path, data)
        if not fs.names(path):
            fs.delete(path)
        raise
    for name in fs.names(path):  # what earlier manifests named, and what crashes left
        if name.startswith("data-") and name != data:
            fs.delete(path, name)
    return manifest


def _replace(path: str, text: str) -> None:
    with open(f"{path}.new", "w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.new", path)


def read_published(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """A published dataset; without a manifest, or with files other than it lists, it is refused."""
    fs = Files(spark, path)
    if not fs.exists(path, "manifest.json"):
        raise FileNotFoundError(f"{path} is not published")
    manifest = json.loads(fs.read(path, "manifest.json"))
    if verify:
        got = _digests(spark, f"{path}/{manifest['data']}")
        for name, digest in manifest["files"].items():
            if got.get(name) != digest:
                raise ValueError(f"{name} is not as published")
        if extra := sorted(got.keys() - manifest["files"].keys()):
            raise ValueError(f"{extra[0]} is not in the manifest")
    return spark.read.parquet(f"{path}/{manifest['data']}")


def activate(root: str, kind: str, projection: str, publishable: bool) -> dict:
    """Point kind at a projection, keeping the previous one; refused unless its quality is publishable."""
    if not publishable:
        raise ValueError(f"{projection} is not publishable")
    path = os.path.join(root, "active.json")
    state = json.load(open(path)) if os.path.exists(path) else {}
    state[kind] = {"active": projection, "previous": state.get(kind, {}).get("active")}
    _replace(path, canonical_json(state))
    return state[kind]


def reuse_key(stage: str, version: str, params: dict, inputs: list[str], upstream: list[str]) -> str:
    """Identity of a stage's output: equal keys mean the stored output can be reused."""
    return hashlib.sha256("|".join([stage, version, json.dumps(params, sort_keys=True), *sorted(inputs), "^", *sorted(upstream)]).encode()).hexdigest()


@dataclass(frozen=True)
class Stage:
    """A named step with the steps it needs and the function that makes its frame from theirs."""

    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]
    params: dict = field(default_factory=dict)
    inputs: Callable[[], list[str]] | None = None  # digests of what the stage reads beside its needs, asked before every run


class Plan:
    """A stage graph: order, ancestors, descendants, and execution with reuse of what is already stored."""

    def __init__(self, stages: list[Stage]):
        self.stages = {s.name: s for s in stages}
        self.order: list[str] = []
        state: dict[str, int] = {}

        def visit(name: str) -> None:
            if state.get(name) == 1:
                raise ValueError(f"cycle at {name}")
            if name not in state:
                state[name] = 1
                for n in self.stages[name].needs:
                    visit(n)
                state[name] = 2
                self.order.append(name)

        for s in stages:
            visit(s.name)

    def ancestors(self, name: str) -> set[str]:
        """All stages that name needs, near or far."""
        out: set[str] = set()
        todo = list(self.stages[name].needs)
        while todo:
            n = todo.pop()
            if n not in out:
                out.add(n)
                todo += self.stages[n].needs
        return out

    def descendants(self, name: str) -> set[str]:
        """All stages that need name: stale when it changes."""
        return {s for s in self.stages if name in self.ancestors(s)}

    def execute(self, spark: SparkSession, root: str, keys: dict[str, list[str]], versions: dict[str, str], upto: str | None = None) -> dict[str, str]:
        """Run stages in order up to one, each published under its reuse key; stored outputs with equal keys are read instead."""
        done: dict[str, tuple[str, DataFrame]] = {}
        said: dict[str, str] = {}
        for name in self.order:
            if upto and name != upto and name not in self.ancestors(upto):
                continue
            stage = self.stages[name]
            key = reuse_key(name, versions.get(name, "1"), stage.params, stage.inputs() if stage.inputs else [], [done[n][0] for n in stage.needs])
            path = "/".join((root, name, key))
            said[name] = "reused"
            if not Files(spark, path).exists(path, "manifest.json"):
                publish(stage.run(*(done[n][1] for n in stage.needs)), path, keys[name])
                said[name] = "made"
            done[name] = (key, read_published(spark, path))
        return said


def content_digest(df: DataFrame) -> str:
    """Digest of a frame's rows, whatever their order: the input of a reuse key."""
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(df.columns)])
    c = df.agg(set_checksum(row).alias("c")).first().c
    return f"{c.n}:{c.xored}:{c.summed}"


#: States of a stage's attempt and what may follow each.
TRANSITIONS = {
    "planned": ("running", "cancelled"),
    "running": ("published", "failed", "cancelled"),
    "failed": ("planned", "cancelled"),
    "published": ("superseded", "stale"),
    "stale": ("planned", "superseded"),
    "superseded": (),
    "cancelled": ("planned",),
}


def advance(state: str, to: str) -> str:
    """The next state of an attempt; a step that TRANSITIONS doesn't allow is refused."""
    if to not in TRANSITIONS.get(state, ()):
        raise ValueError(f"{state} can't become {to}")
    return to


def retry_class(error: str) -> str:
    """Whether an attempt is worth another: transient for lost machines and time-outs, resource for memory and disk, else permanent."""
    text = error.lower()
    if any(w in text for w in ("timeout", "timed out", "connection", "executor lost", "executorlost", "fetchfailed")):
        return "transient"
    return "resource" if any(w in text for w in ("outofmemory", "out of memory", "no space left")) else "permanent"


def knowledge_base(spark: SparkSession, families: dict[str, str], expected: dict[str, int]) -> DataFrame:
    """(family, status, rows, coverage, limitation, fingerprint): what a knowledge base is assembled from: for each family its published
    path, against the rows expected of it. A family without a manifest is missing, one short of rows partial."""
    rows = []
    for family, path in sorted(families.items()):
        fs = Files(spark, path)
        if not fs.exists(path, "manifest.json"):
            rows.append((family, "missing", 0, 0.0, "not published", None))
            continue
        m = json.loads(fs.read(path, "manifest.json"))
        want = expected.get(family, m["rows"])
        share = 1.0 if not want else min(1.0, m["rows"] / want)
        rows.append((family, "complete" if share == 1.0 else "partial", m["rows"], round(share, 6), None if share == 1.0 else f"{want - m['rows']} rows short", hashlib.sha256(f"{family}|{m['checksum']}".encode()).hexdigest()))
    return spark.createDataFrame(rows, "family string, status string, rows long, coverage double, limitation string, fingerprint string")


def publish_bundle(root: str, spec: dict, cases: list[dict], artifacts: dict[str, bytes] | None = None) -> str:
    """An immutable result bundle: scores.jsonl, artifacts and a canonical manifest with their digests, in a folder named by its
    content. An equal bundle is returned as it is; one that was tampered with is refused."""
    scores = "".join(json.dumps(c, sort_keys=True, ensure_ascii=True) + "\n" for c in cases)
    files = {"scores.jsonl": scores.encode(), **(artifacts or {})}
    manifest = canonical_json({"spec": spec, "cases": len(cases), "files": {n: hashlib.sha256(b).hexdigest() for n, b in sorted(files.items())}})
    path = os.path.join(root, hashlib.sha256(manifest.encode()).hexdigest()[:32])
    if os.path.exists(path):
        verify_bundle(path)
        return path
    staging = f"{path}.{uuid.uuid4().hex[:8]}"
    os.makedirs(staging)
    for name, body in files.items():
        with open(os.path.join(staging, name), "wb") as f:
            f.write(body)
    _replace(os.path.join(staging, "manifest.json"), manifest)
    os.rename(staging, path)  # fails if another got there first
    return path


def verify_bundle(path: str) -> dict:
    """The manifest of a bundle whose files are as it says."""
    with open(os.path.join(path, "manifest.json")) as f:
        manifest = json.load(f)
    for name, digest in manifest["files"].items():
        with open(os.path.join(path, name), "rb") as f:
            if hashlib.sha256(f.read()).hexdigest() != digest:
                raise ValueError(f"{name} is not as published")
    return manifest


def quarantine(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good, refused): rows without and with an error; none is dropped."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())

"""Identities derived by SHA-256, partition buckets and checksums, as Column expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sha(*parts: Column | str) -> Column:
    return F.sha2(F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]), 256)


def document_id(content_hash: Column) -> Column:
    """SHA-256 of "document:" and the content hash."""
    return _sha("document:", content_hash)


def normalized_document_id(document: Column, normalizer: Column) -> Column:
    """SHA-256 of "normalized-document:document:normalizer"."""
    return _sha("normalized-document:", document, ":", normalizer)


def chunk_id(document: Column, chunker: Column, kind: Column, start: Column, end: Column, ordinal: Column) -> Column:
    """SHA-256 of "chunk:document:chunker:kind:start:end:ordinal", in canonical offsets."""
    return _sha("chunk:", document, ":", chunker, ":", kind, ":", start, ":", end, ":", ordinal)


def group_id(family: str, members: Column) -> Column:
    """SHA-256 of the JSON list [family, [sorted members]]."""
    quoted = F.array_join(F.transform(F.array_sort(members), lambda m: F.concat(F.lit('"'), m, F.lit('"'))), ", ")
    return _sha(f'["{family}", [', quoted, "]]")


def membership_id(group: Column, document: Column) -> Column:
    """SHA-256 of "duplicate-membership:group:document"."""
    return _sha("duplicate-membership:", group, ":", document)


def occurrence_id(silo: str, path: str, members: list[str]) -> str:
    """SHA-256 of the JSON list [silo, path, [members]]."""
    return hashlib.sha256(json.dumps([silo, path, list(members)]).encode()).hexdigest()


def lake_bucket(identity: Column) -> Column:
    """First hex digit of an id: the partition of lake rows."""
    return F.substring(identity, 1, 1)


def store_bucket(identity: Column, buckets: int = 16) -> Column:
    """First seven hex digits of the id's SHA-256, modulo the buckets, as text: the partition of store rows."""
    return F.pmod(F.conv(F.substring(F.sha2(identity.cast("string"), 256), 1, 7), 16, 10).cast("long"), F.lit(buckets)).cast("string")


def ids_checksum(df, column: str):
    """(checksum): SHA-256 of a set of ids of any size: of the digests of 4,096 parts by the ids' own SHA-256, each over its sorted ids."""
    ids = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("n")).distinct().withColumn("p", F.substring(F.sha2("n", 256), 1, 3))
    parts = ids.groupBy("p").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("n")), "|"), 256).alias("c"))
    return parts.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat("p", F.lit(":"), "c"))), "|"), 256).alias("checksum"))


def set_checksum(identity: Column) -> Column:
    """Aggregate for sets of any size: (count, xor, sum) of hashes, whose partial aggregates are three numbers."""
    h = F.xxhash64(identity)
    return F.struct(F.count(identity).alias("n"), F.bit_xor(h).alias("xored"), F.sum(h.cast("decimal(38,0)")).alias("summed"))


def canonical_json(value) -> str:
    """Sorted keys, ASCII, two-space indent, a line end."""
    return json.dumps(value, sort_keys=True, ensure_ascii=True, indent=2) + "\n"


def policy_id(algorithm: str, policy: dict, length: int = 32) -> str:
    """Identity of a policy: hash of its algorithm version and settings."""
    return hashlib.sha256(f"{algorithm}:{json.dumps(policy, sort_keys=True)}".encode()).hexdigest()[:length]


def span_id(document: Column, index: Column, start: Column, end: Column, kind: Column) -> Column:
    """SHA-256 of the JSON list [document, index, start, end, kind]; nulls are null."""
    text = lambda c: F.coalesce(F.concat(F.lit('"'), c.cast("string"), F.lit('"')), F.lit("null"))
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return _sha("[", text(document), ", ", number(index), ", ", number(start), ", ", number(end), ", ", text(kind), "]")


def classification_id(occurrence: Column, scheme: Column, classifier: Column) -> Column:
    """SHA-256 of "classification:occurrence:scheme:classifier"."""
    return _sha("classification:", occurrence, ":", scheme, ":", classifier)


def evidence_id(projection: Column, check: Column) -> Column:
    """SHA-256 of "evidence:projection:check"."""
    return _sha("evidence:", projection, ":", check)


def projection_fingerprint(kind: str, version: str, checksum: str, profile: str) -> str:
    """Identity of what a projection is built from: kind, version, input checksum and profile."""
    return hashlib.sha256("|".join((kind, version, checksum, profile)).encode()).hexdigest()

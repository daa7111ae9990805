"""Duplicate grouping: exact, normalised and near duplicates, editions, and the suppression overlay.

Copies collapse before anything is compared, so a hot text is one row. Near duplicates are all pairs of texts whose shingle sets
have at least the stated Jaccard: texts are posted under their rarest shingles only, as many as a similar text cannot miss, and
those that meet there are proved by their whole sets. MinHash sketches serve as compact signatures.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions import hashing
from archivolt.functions.text import shingles, words
from archivolt.operators.components import connected_components
from archivolt.session import cut

_GOLDEN, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: Most bits of the buckets in which holders of shingles are counted, those of a block of buckets, and shingles held at once.
_BUCKET_BITS, _BLOCK_BITS, _HELD = 27, 16, 4_000_000
#: Most texts of candidate pairs whose ids are broadcast.
_CANDIDATES = 1_000_000


@dataclass(frozen=True)
class DedupePolicy:
    """Words of a shingle, registers, rows of a band, least similarity of duplicates and of editions, least shingles of a sketch.

    Registers, rows and least shingles are of sketches; near_links needs none of them."""

    shingle: int = 5
    registers: int = 128
    rows: int = 2
    similarity: float = 0.9
    edition: float = 0.45
    min_shingles: int = 5


#: The policy of the near-duplicate queries: five words, a similarity of 0.8.
NEAR = DedupePolicy(similarity=0.8)


def sketch(hashes: np.ndarray, registers: int) -> np.ndarray:
    """Register i is the least of (h * coefficient_i + i * mix) mod 2^64 over the hashes; wraps as unsigned numbers do."""
    i = np.arange(registers, dtype=np.uint64)
    coefficient = np.uint64(_GOLDEN) + np.uint64(2) * i + np.uint64(1)
    out = np.full(registers, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), 4096):  # long texts in steps of bounded memory
        out = np.minimum(out, (hashes[lo : lo + 4096, None] * coefficient + i * np.uint64(_MIX)).min(0))
    return out


def signature(hashes: str | Column, registers: int = 128) -> Column:
    """array<bigint> of the registers' bit patterns; empty for a text without shingles."""

    @F.pandas_udf("array<bigint>")
    def run(series: pd.Series) -> pd.Series:
        return series.map(lambda h: [] if h is None or not len(h) else sketch(np.asarray(h, np.int64).view(np.uint64), registers).view(np.int64))

    return run(hashes)


def agreement(a: Column, b: Column) -> Column:
    """Share of equal registers of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def jaccard(a: Column, b: Column) -> Column:
    """Exact Jaccard of two arrays taken as sets; 0 where both are empty."""
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(common, F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common), F.lit(0.0))


def normal_key(text: str | Column) -> Column:
    """A text without case and with single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\n\r]+", " "))


def exact_groups(df: DataFrame, key: Column, identity: str) -> DataFrame:
    """(key_hash, leader, members): keys shared by more than one row; the leader is the smallest id. Null keys are no copies."""
    return (
        df.where(key.isNotNull()).groupBy(F.sha2(key, 256).alias("key_hash")).agg(F.min(identity).alias("leader"), F.count("*").alias("members")).where("members > 1")
    )


def exact_edges(df: DataFrame, key: Column, identity: str) -> DataFrame:
    """(left, right): a star from the smallest id of each shared key."""
    keyed = df.where(key.isNotNull()).select(F.col(identity).alias("id"), F.sha2(key, 256).alias("k"))
    lead = keyed.groupBy("k").agg(F.min("id").alias("left"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(lead, "k").where("id <> left").select("left", F.col("id").alias("right"))


def _bucket(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _holders(bits: int):
    """(block, n): the buckets of shingles, one a holder, as places in their block of buckets."""

    def out(parts: list[np.ndarray]) -> pd.DataFrame:
        b = np.sort(_bucket(np.concatenate(parts), bits))
        block, first = np.unique(b >> _BLOCK_BITS, return_index=True)
        places = (b & ((1 << _BLOCK_BITS) - 1)).astype(np.uint16)
        return pd.DataFrame({"block": block, "n": [x.tobytes() for x in np.split(places, first[1:])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for pdf in batches:
            for g in pdf["grams"]:
                parts.append(np.asarray(g, np.int64))
                size += len(g)
                if size >= _HELD:
                    yield out(parts)
                    parts, size = [], 0
        if size:
            yield out(parts)

    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of a block in a byte each: as they are up to 128, by their logarithm beyond, so that their order stays."""
    n = np.zeros(1 << _BLOCK_BITS, np.int64)
    for x in pdf["n"]:
        n += np.bincount(np.frombuffer(x, np.uint16), minlength=len(n))
    coded = np.where(n <= 128, n, np.minimum(255, 128 + 6 * np.log2(np.maximum(n, 128) / 128))).astype(np.uint8)
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "n": [coded.tobytes()]})


def _posted(shared, bits: int, least: float):
    """(id, size, gram, place): the rarest shingles of each text that a text of that similarity must share one of."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for pdf in batches:
            for lo in range(0, len(pdf), 2000):
                grams, size, place = [], [], []
                for g in pdf["grams"].iloc[lo : lo + 2000]:
                    g = np.asarray(g, np.int64)
                    n = held[_bucket(g, bits)]
                    order = np.lexsort((g, n))[: len(g) - int(np.ceil(least * len(g) - 1e-9)) + 1]
                    at = np.flatnonzero(n[order] > 1)  # no other text holds the rest
                    grams.append(g[order[at]])
                    place.append(at)
                    size.append(len(g))
                many = [len(x) for x in grams]
                yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy()[lo : lo + 2000], many), "size": np.repeat(size, many), "gram": np.concatenate(grams), "place": np.concatenate(place)})

    return run


def near_links(distinct: DataFrame, policy: DedupePolicy = DedupePolicy(), least: float | None = None) -> DataFrame:
    """(left, right, score): every pair of different texts whose shingle sets have at least that Jaccard, with the Jaccard.

    distinct has `id` and `grams` (array<bigint> of different hashed shingles). Shingles are ordered by how many texts hold their
    bucket, then by hash; similar texts share one among their first few, and from the first one shared on enough must follow."""
    least = policy.similarity if least is None else least
    base = cut(distinct.where(F.size("grams") > 0).select("id", "grams"))
    total = base.agg(F.sum(F.size("grams").cast("long"))).first()[0] or 0
    bits = min(_BUCKET_BITS, max(_BLOCK_BITS, total.bit_length() + 2))
    held = np.zeros((1 << (bits - _BLOCK_BITS), 1 << _BLOCK_BITS), np.uint8)
    for r in base.select("grams").mapInPandas(_holders(bits), "block int, n binary").groupBy("block").applyInPandas(_added, "block int, n binary").toLocalIterator():  # a table of bounded size
        held[r.block] = np.frombuffer(r.n, np.uint8)
    shared = base.sparkSession.sparkContext.broadcast(held.ravel())
    posted = cut(base.mapInPandas(_posted(shared, bits, least), f"id {dict(base.dtypes)['id']}, size int, gram long, place int"))
    x = posted.select("gram", F.col("id").alias("left"), F.col("size").alias("m"), F.col("place").alias("i"))
    y = posted.select("gram", F.col("id").alias("right"), F.col("size").alias("n"), F.col("place").alias("j"))
    common = F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j"))  # at most, if this is the first shingle shared
    meet = x.join(y, "gram").where((F.col("left") < F.col("right")) & (common >= least / (1 + least) * (F.col("m") + F.col("n")) - 1e-6))
    p = cut(meet.select("left", "right").distinct())
    # only texts of candidate pairs move with their shingles
    ids = cut(p.select(F.explode(F.array("left", "right")).alias("id")).distinct())
    base = base.join(F.broadcast(ids) if ids.count() <= _CANDIDATES else ids, "id", "left_semi")
    p = p.join(base.select(F.col("id").alias("left"), F.col("grams").alias("a")), "left")
    p = p.join(base.select(F.col("id").alias("right"), F.col("grams").alias("b")), "right")
    return p.select("left", "right", jaccard(F.col("a"), F.col("b")).alias("score")).where(F.col("score") >= least)


def near_duplicates(df: DataFrame, identity: str = "doc_id", text: str = "text", policy: DedupePolicy = NEAR) -> DataFrame:
    """(id, class_id, links, copies): one row a document with its class and its number of proved links between different texts.

    class_id is the smallest id of the class. Null texts are classes of their own; texts equal but for case and spaces are copies."""
    # shingles are hashed where the text is read; copies have equal ones, so no text is shuffled
    grams = F.array_distinct(F.transform(shingles(words(F.col(text)), policy.shingle), lambda g: F.xxhash64(g)))
    rows = cut(df.select(F.col(identity).alias("id"), F.sha2(normal_key(text), 256).alias("key"), grams.alias("grams")))
    copies = cut(rows.where("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min_by("grams", "id").alias("grams")))
    links = cut(near_links(copies.select("id", "grams"), policy))
    comp = connected_components(copies.select("id"), links.select(F.col("left").alias("src"), F.col("right").alias("dst")))
    degree = links.select(F.explode(F.array("left", "right")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    per_key = copies.select("key", "id", "copies").join(comp, "id").join(degree, "id", "left").select("key", F.col("component").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), "copies")
    out = rows.select("id", "key").join(per_key, "key", "left")
    return out.select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("copies", F.lit(1)).alias("copies"))


def assemble(membership: DataFrame, lengths: DataFrame, family: str = "duplicate") -> DataFrame:
    """(group_id, document_id, role, suppressed): groups of more than one, led by the longest text, then the smallest id.

    membership has (document_id, root, method, score); editions are never suppressed."""
    m = membership.join(lengths, "document_id")
    lead = m.groupBy("root").agg(
        F.min_by("document_id", F.struct(-F.col("text_chars"), F.col("document_id"))).alias("leader"), F.sort_array(F.collect_set("document_id")).alias("members")
    )
    lead = lead.where(F.size("members") > 1).select("root", "leader", hashing.group_id(family, F.col("members")).alias("group_id"))
    out = m.join(lead, "root")
    role = F.when(F.col("document_id") == F.col("leader"), "representative").otherwise("member")
    return out.select("group_id", "document_id", role.alias("role"), (F.lit(family == "duplicate") & (F.col("document_id") != F.col("leader"))).alias("suppressed"))


def best_method(edges: DataFrame) -> DataFrame:
    """(id, method, score): each member's best incident edge, exact before normalized before lexical before edition, then score."""
    rank = F.array_position(F.array(*[F.lit(m) for m in ("exact", "normalized", "lexical", "edition")]), F.col("method"))
    both = edges.select(F.explode(F.array("left", "right")).alias("id"), "method", "score", rank.alias("rank"))
    best = F.min_by(F.struct("method", "score"), F.struct("rank", -F.col("score")))
    return both.groupBy("id").agg(best.alias("b")).select("id", "b.method", "b.score")


def suppress(documents: DataFrame, overlay: DataFrame, identity: str = "document_id") -> DataFrame:
    """Documents without those the overlay suppresses."""
    return documents.join(overlay.where("suppressed").select(identity).distinct(), identity, "left_anti")


def sketches(df: DataFrame, identity: str = "doc_id", text: str = "text", policy: DedupePolicy = DedupePolicy()) -> DataFrame:
    """(id, exact_key, normalized_key, text_chars, shingles, signature, bands): one row a document with a text.

    Signatures and bands, hashes of `rows` neighbouring registers with their place, are empty below min_shingles."""
    grams = F.array_distinct(F.transform(shingles(words(F.col(text)), policy.shingle), lambda g: F.xxhash64(g)))
    base = df.where(F.col(text).isNotNull()).select(F.col(identity).alias("id"), F.sha2(text, 256).alias("exact_key"), F.sha2(normal_key(text), 256).alias("normalized_key"), F.length(text).alias("text_chars"), grams.alias("grams"))
    long = F.when(F.size("grams") >= policy.min_shingles, F.col("grams")).otherwise(F.array().cast("array<bigint>"))
    signed = base.select("id", "exact_key", "normalized_key", "text_chars", F.size("grams").alias("shingles"), signature(long, policy.registers).alias("signature"))
    starts = F.sequence(F.lit(0), F.lit(policy.registers - policy.rows), F.lit(policy.rows))
    bands = F.transform(starts, lambda i: F.xxhash64(i, F.slice("signature", i + 1, policy.rows)))
    return signed.withColumn("bands", F.when(F.size("signature") > 0, bands).otherwise(F.array().cast("array<bigint>")))


def editions(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Edition links (left, right, score) without those inside one duplicate group; groups has (id, group_id), at most one an id."""
    a = groups.select(F.col("id").alias("left"), F.col("group_id").alias("ga"))
    b = groups.select(F.col("id").alias("right"), F.col("group_id").alias("gb"))
    j = links.join(a, "left", "left").join(b, "right", "left")
    return j.where(F.col("ga").isNull() | F.col("gb").isNull() | (F.col("ga") != F.col("gb"))).select("left", "right", "score")


def audit(links: DataFrame, policy: DedupePolicy = NEAR) -> DataFrame:
    """(left, right, method, score, family): every proposed pair with what it was taken for, for the record."""
    near = F.col("score") >= policy.similarity
    return links.where(F.col("score") >= policy.edition).select("left", "right", F.when(near, "lexical").otherwise("edition").alias("method"), "score", F.when(near, "duplicate").otherwise("edition").alias("family"))

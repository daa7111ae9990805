"""Problem 4: the best representative of each duplicate group, and its fields merged value by value.

Method: members' newest records are unpivoted to long rows (group, member, field, value); votes per normalised value are
the sum of source trust times recency decay; winners come by max_by, and a pivot turns them back to one row per group.
The surviving member is chosen over the same long rows: most filled fields, then trust, last event, length, id.

Defined cases: rows with a null group or document are no memberships; repeated memberships count once; a member without a
record has no filled field; a group of such members still gets a survivor and null fields; ties in votes go to the newer
value, then to the greater one; equal record versions are resolved by the greatest row, so repeats change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("title", "language", "media_type", "byte_size", "text_chars")
#: What counts as not filled, after trimming and lower-casing.
PLACEHOLDERS = ("", "und", "unk", "n/a", "untitled")
#: Trust weight is 1 / rank; a record without a ranked extractor votes with the weight of this rank.
UNRANKED = 8
#: Days after which a vote counts half.
HALF_LIFE_DAYS = 365.0


def newest_records(records: DataFrame) -> DataFrame:
    """One row per document: its newest record, by loaded_at. One partial-aggregated shuffle."""
    row = F.struct(F.col("loaded_at"), *[F.col(c) for c in ("extractor_profile", *FIELDS)])
    return records.where("document_id is not null").groupBy("document_id").agg(F.max(row).alias("r")).select("document_id", "r.*")


def _clean(name: str):
    text = F.trim(F.regexp_replace(F.col(name).cast("string"), r"(?U)^\s+|\s+$", ""))
    return F.when(~F.lower(text).isin(*PLACEHOLDERS), text)


def long_rows(groups: DataFrame, records: DataFrame, extractors: DataFrame, events: DataFrame) -> DataFrame:
    """(group_id, document_id, trust_rank, last_event, loaded_at, text_len, field, value); unfilled values are null."""
    members = groups.select("group_id", "document_id").dropna().distinct()
    last = events.where("document_id is not null").groupBy("document_id").agg(F.max("event_time").alias("last_event"))
    ranks = F.broadcast(extractors.groupBy("extractor_profile").agg(F.min("trust_rank").alias("trust_rank")))
    rec = newest_records(records).join(ranks, "extractor_profile", "left")
    wide = members.join(rec, "document_id", "left").join(last, "document_id", "left")
    wide = wide.select("group_id", "document_id", "trust_rank", "last_event", "loaded_at", F.col("text_chars").alias("text_len"), *[_clean(f).alias(f) for f in FIELDS])
    return wide.unpivot(["group_id", "document_id", "trust_rank", "last_event", "loaded_at", "text_len"], list(FIELDS), "field", "value")


def survivors(long: DataFrame) -> DataFrame:
    """(group_id, document_id): the member that survives, by the stated order of preference."""
    member = long.groupBy("group_id", "document_id").agg(
        F.count("value").alias("filled"), F.first("trust_rank").alias("trust_rank"), F.first("last_event").alias("last_event"), F.first("text_len").alias("text_len")
    )
    order = F.struct(
        -F.col("filled"),
        F.coalesce(F.col("trust_rank"), F.lit(2**62)),
        F.coalesce(-F.unix_micros("last_event"), F.lit(2**62)),
        F.coalesce(-F.col("text_len"), F.lit(2**62)),
        F.col("document_id"),
    )
    return member.groupBy("group_id").agg(F.min_by("document_id", order).alias("document_id"))


def golden_fields(long: DataFrame, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """One row per group with the winning value of each field. Votes are summed per value before anything else is shuffled."""
    # age counts from the group's newest record
    newest = long.groupBy("group_id").agg(F.max("loaded_at").alias("newest"))
    age = (F.unix_micros("newest") - F.unix_micros("loaded_at")) / F.lit(86_400e6)
    weight = F.pow(F.lit(0.5), age / F.lit(half_life_days)) / F.coalesce(F.col("trust_rank"), F.lit(UNRANKED))
    # votes are whole numbers, so that their sums don't depend on the order of addition
    votes = (
        long.where("value is not null and loaded_at is not null")
        .join(newest, "group_id")
        .withColumn("key", F.lower(F.regexp_replace("value", r"(?U)\s+", " ")))
        .groupBy("group_id", "field", "key")
        .agg(F.sum(F.round(weight * 1e9).cast("long")).alias("votes"), F.max(F.struct("loaded_at", "value")).alias("at"))
    )
    best = votes.groupBy("group_id", "field").agg(F.max_by("at.value", F.struct("votes", "at")).alias("value"))
    return best.groupBy("group_id").pivot("field", list(FIELDS)).agg(F.first("value"))


def golden(groups: DataFrame, records: DataFrame, extractors: DataFrame, events: DataFrame) -> DataFrame:
    """(group_id, document_id, title, language, media_type, byte_size, text_chars): one surviving record per group."""
    long = long_rows(groups, records, extractors, events)
    fields = golden_fields(long)
    out = survivors(long).join(fields, "group_id", "left")
    return out.select("group_id", "document_id", "title", "language", "media_type", F.col("byte_size").cast("long").alias("byte_size"), F.col("text_chars").cast("long").alias("text_chars"))


def found(groups: DataFrame, records: DataFrame, extractors: DataFrame, events: DataFrame) -> DataFrame:
    """(group_id, document_id) of the operator's surviving records."""
    return golden(groups, records, extractors, events).select("group_id", "document_id")

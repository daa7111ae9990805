"""Evidence lookup: from citations to every location that can still show them, and whether it matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(citations: DataFrame, documents: DataFrame, overlay: DataFrame) -> DataFrame:
    """(citation_id, document_id, locations, ambiguous): citations (citation_id, document_id) with the paths of their occurrences.

    overlay has (document_id, occurrence_id, relative_path). Unknown documents resolve to no location."""
    paths = overlay.where("relative_path is not null").groupBy("document_id").agg(F.sort_array(F.collect_set("relative_path")).alias("paths"))
    known = documents.select("document_id").distinct().withColumn("known", F.lit(True))
    j = citations.join(known, "document_id", "left").join(paths, "document_id", "left")
    n = F.when(F.col("known"), F.coalesce(F.size("paths"), F.lit(0))).otherwise(0)
    return j.select("citation_id", "document_id", n.alias("locations"), (n > 1).alias("ambiguous"), F.col("known").isNull().alias("unknown"))


def locations(citations: DataFrame, documents: DataFrame, overlay: DataFrame, facts: DataFrame | None = None, reports: DataFrame | None = None) -> DataFrame:
    """(citation_id, kind, document_id, occurrence_id, silo_id, relative_path, role, finding): a row for every place that can show a
    citation, or one with a finding.

    citations has (citation_id, kind, document_id, fact_id, report_id): of kind content they name the document, facts (fact_id,
    document_id) and reports (report_id, fact_id) lead to it. The first place by silo and path is the primary one."""
    c = citations
    if reports is not None:
        c = c.join(reports.select("report_id", F.col("fact_id").alias("_of_report")), "report_id", "left").withColumn("fact_id", F.coalesce("fact_id", "_of_report"))
    if facts is not None:
        c = c.join(facts.select("fact_id", F.col("document_id").alias("_of_fact")), "fact_id", "left").withColumn("document_id", F.coalesce("document_id", "_of_fact"))
    known = documents.select("document_id").distinct().withColumn("known", F.lit(True))
    places = overlay.where("relative_path is not null").select("document_id", "occurrence_id", "silo_id", "relative_path").distinct()
    first = places.groupBy("document_id").agg(F.min(F.struct("silo_id", "relative_path", "occurrence_id")).alias("first"))
    j = c.select("citation_id", "kind", "document_id").distinct().join(known, "document_id", "left").join(places, "document_id", "left").join(first, "document_id", "left")
    primary = F.struct("silo_id", "relative_path", "occurrence_id") == F.col("first")
    finding = F.when(F.col("document_id").isNull(), "unresolved").when(F.col("known").isNull(), "unknown-document").when(F.col("relative_path").isNull(), "no-location")
    return j.select("citation_id", "kind", "document_id", "occurrence_id", "silo_id", "relative_path", F.when(F.col("relative_path").isNotNull(), F.when(primary, "primary").otherwise("copy")).alias("role"), finding.alias("finding"))


def bind_members(occurrences: DataFrame) -> DataFrame:
    """(occurrence_id, physical_hash): the hash of the file on disk that holds each occurrence: its own, or that of its outermost
    container. occurrences has (occurrence_id, container_id, content_hash); containers may nest."""
    from archivolt.session import cut

    o = occurrences.select("occurrence_id", "container_id", "content_hash").dropDuplicates(["occurrence_id"])
    parent = o.select(F.col("occurrence_id").alias("up"), F.col("container_id").alias("next"), F.col("content_hash").alias("up_hash"))
    at = cut(o.select("occurrence_id", F.col("container_id").alias("up"), F.col("content_hash").alias("hash")))
    for _ in range(64):
        if at.where("up is not null").isEmpty():
            return at.select("occurrence_id", F.col("hash").alias("physical_hash"))
        at = cut(at.join(parent, "up", "left").select("occurrence_id", F.col("next").alias("up"), F.when(F.col("up").isNull(), F.col("hash")).otherwise(F.col("up_hash")).alias("hash")))
    raise ValueError("containers nest in a cycle")


def location_status(expected: DataFrame, current: DataFrame) -> DataFrame:
    """(silo, path, status): matching, changed, missing, escaped or unchecked (no silo scanned it), by the hash found at each expected path."""
    c = current.select("silo", "path", F.col("content_hash").alias("found"))
    status = F.when(F.col("path").contains("..") | F.col("path").startswith("/"), "escaped").when(F.col("scanned").isNull(), "unchecked").when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("content_hash"), "matching").otherwise("changed")
    scanned = current.select("silo").distinct().withColumn("scanned", F.lit(True))
    return expected.join(c, ["silo", "path"], "left").join(scanned, "silo", "left").select("silo", "path", status.alias("status"))


#: Characters of a bin in which spans and chunks of a document meet.
BIN = 4096


def spans_in_chunks(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """(span_id, chunk_id, overlap, intact): chunks that a span of the same document overlaps.

    Both are dealt to bins of the document's characters and meet in those they share; each pair counts in the first of them. So a
    document that holds most of the rows is spread over its length."""
    def bins(a: str, b: str):
        return F.explode(F.sequence(F.floor(F.col(a) / BIN), F.greatest(F.floor(F.col(a) / BIN), F.floor((F.col(b) - 1) / BIN)))).alias("bin")

    c = chunks.where("start_char is not null and end_char is not null").select("document_id", "chunk_id", F.col("start_char").alias("cs"), F.col("end_char").alias("ce"))
    c = c.select("*", bins("cs", "ce"))
    s = spans.where("start_char is not null and end_char is not null").select("*", bins("start_char", "end_char"))
    first = F.greatest(F.floor(F.col("start_char") / BIN), F.floor(F.col("cs") / BIN))
    j = s.join(c, ["document_id", "bin"]).where((F.col("start_char") < F.col("ce")) & (F.col("cs") < F.col("end_char")) & (F.col("bin") == first))
    overlap = F.least("end_char", "ce") - F.greatest("start_char", "cs")
    return j.select("span_id", "chunk_id", overlap.alias("overlap"), ((F.col("cs") <= F.col("start_char")) & (F.col("ce") >= F.col("end_char"))).alias("intact"))

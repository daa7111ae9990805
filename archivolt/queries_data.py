"""Queries of data quality, change, evidence, metrics, rules, forecasts, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.operators import changes, classify, evidence, forecast, metrics, quality, rules, vector
from archivolt.operators.quality import Rule
from archivolt.registry import query
from archivolt.session import table
from archivolt.sources.files import inventory_counts
from archivolt.streaming import windows


@query(
    "dq_row_rules",
    """WITH c AS (SELECT count(*) AS checked, count(*) FILTER (WHERE c_name IS NULL) AS a, count(*) FILTER (WHERE length(c_name) > 17) AS b,
 count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')) AS c, count(*) FILTER (WHERE NOT c_acctbal BETWEEN 0 AND 9000) AS d FROM customer),
u AS (SELECT 'name-null' AS rule_id, checked, a AS failed FROM c UNION ALL SELECT 'name-length', checked, b FROM c UNION ALL SELECT 'segment', checked, c FROM c UNION ALL SELECT 'balance', checked, d FROM c)
SELECT *, CASE WHEN checked = 0 THEN 'not-applicable' WHEN failed > 0 THEN 'fail' ELSE 'pass' END AS status FROM u""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    r = [Rule("name-null", "not_null", "c_name"), Rule("name-length", "max_length", "c_name", 17), Rule("segment", "accepted", "c_mktsegment", ("BUILDING", "MACHINERY", "AUTOMOBILE")), Rule("balance", "between", "c_acctbal", (0, 9000))]
    return quality.row_checks(table(spark, d, "customer"), r)


@query("dq_snapshot_unique", "WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT 'unique' AS rule_id, sum(n) AS checked, count(*) FILTER (WHERE n > 1) AS failed, CASE WHEN count(*) FILTER (WHERE n > 1) > 0 THEN 'fail' ELSE 'pass' END AS status FROM g")
def _(spark: SparkSession, d: str) -> DataFrame:
    return quality.snapshot_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_batch_unique", "WITH g AS (SELECT count(*) AS n FROM events GROUP BY event_id % 40, user_id) SELECT 'batch_unique' AS rule_id, sum(n) AS checked, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS failed, CASE WHEN coalesce(sum(n) FILTER (WHERE n > 1), 0) > 0 THEN 'fail' ELSE 'pass' END AS status FROM g")
def _(spark: SparkSession, d: str) -> DataFrame:
    return quality.batch_unique(table(spark, d, "events").withColumn("batch", F.col("event_id") % 40), "batch", ["user_id"])


@query(
    "dq_relationship",
    """WITH c AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -1 ELSE o_custkey END AS k FROM orders)
SELECT 'relationship' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE k NOT IN (SELECT c_custkey FROM customer)) AS failed, CASE WHEN count(*) FILTER (WHERE k NOT IN (SELECT c_custkey FROM customer)) > 0 THEN 'fail' ELSE 'pass' END AS status FROM c WHERE k IS NOT NULL""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    k = F.when(F.col("o_orderkey") % 97 == 0, None).when(F.col("o_orderkey") % 89 == 0, -1).otherwise(F.col("o_custkey"))
    return quality.relationship(table(spark, d, "orders").select(k.alias("k")), "k", table(spark, d, "customer"), "c_custkey")


@query("dq_relationship_documents", "SELECT 'relationship' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE document_id NOT IN (SELECT document_id FROM documents)) AS failed, CASE WHEN count(*) FILTER (WHERE document_id NOT IN (SELECT document_id FROM documents)) > 0 THEN 'fail' ELSE 'pass' END AS status FROM chunks WHERE document_id IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return quality.relationship(table(spark, d, "chunks"), "document_id", table(spark, d, "documents"), "document_id")


@query(
    "dq_unit_companion",
    """WITH c AS (SELECT o_totalprice AS amount, nullif(o_orderpriority, '5-LOW') AS currency FROM orders)
SELECT 'unit' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE amount IS NOT NULL AND currency IS NULL) AS failed, CASE WHEN count(*) FILTER (WHERE amount IS NOT NULL AND currency IS NULL) > 0 THEN 'fail' ELSE 'pass' END AS status FROM c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_totalprice").alias("amount"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("currency"))
    return quality.row_checks(o, [Rule("unit", "companion", "amount", "currency")])


@query("dq_provenance", "SELECT 'hash' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE NOT regexp_full_match(content_hash, '[0-9a-f]{64}')) AS failed, CASE WHEN count(*) FILTER (WHERE NOT regexp_full_match(content_hash, '[0-9a-f]{64}')) > 0 THEN 'fail' ELSE 'pass' END AS status FROM document_path_events")
def _(spark: SparkSession, d: str) -> DataFrame:
    return quality.row_checks(table(spark, d, "document_path_events"), [Rule("hash", "pattern", "content_hash", "^[0-9a-f]{64}$")])


@query("dq_publishable", "WITH r AS (SELECT 'id-null' AS rule_id, count(*) FILTER (WHERE chunk_id IS NULL) AS failed FROM chunks UNION ALL SELECT 'chunker-null', count(*) FILTER (WHERE chunker_id IS NULL) FROM chunks) SELECT (SELECT count(*) FROM r WHERE failed = 0) = 3 AS publishable, 3 - (SELECT count(*) FROM r WHERE failed = 0) AS failing")
def _(spark: SparkSession, d: str) -> DataFrame:
    report = quality.row_checks(table(spark, d, "chunks"), [Rule("id-null", "not_null", "chunk_id"), Rule("chunker-null", "not_null", "chunker_id")])
    return quality.publishable(report, ["id-null", "chunker-null", "never-run"])


@query("dq_failure_sample", "SELECT substr(chunk_id, 1, 64) AS chunk_id, substr(document_id, 1, 64) AS document_id FROM chunks WHERE chunker_id IS NULL ORDER BY chunks.chunk_id, chunks.document_id LIMIT 5")
def _(spark: SparkSession, d: str) -> DataFrame:
    return quality.failure_sample(table(spark, d, "chunks"), Rule("chunker-null", "not_null", "chunker_id"), ["chunk_id", "document_id"])


@query(
    "inventory_counts",
    """SELECT source AS silo, count(*) AS files, coalesce(sum(n_chars), 0) AS bytes, count(*) FILTER (WHERE text IS NULL) AS quarantined, count(text) - count(DISTINCT text) AS duplicates FROM documents GROUP BY ROLLUP (source)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("source").alias("silo"), F.col("n_chars").alias("size"), F.sha2("text", 256).alias("content_hash"))
    return inventory_counts(docs, quarantined=F.col("content_hash").isNull())


def _manifests(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("silo"))
    old = o.where("k % 11 <> 0").select("silo", F.concat(F.lit("p"), "k").alias("path"), F.concat(F.lit("h"), F.col("k") % 977).alias("content_hash"))
    path = F.when(F.col("k") % 17 == 0, F.concat(F.lit("q"), "k")).otherwise(F.concat(F.lit("p"), "k"))
    content = F.when(F.col("k") % 13 == 0, F.concat(F.lit("x"), "k")).otherwise(F.concat(F.lit("h"), F.col("k") % 977))
    return old, o.where("k % 7 <> 0").select("silo", path.alias("path"), content.alias("content_hash"))


_DIFF = """o AS (SELECT o_orderpriority AS silo, 'p' || o_orderkey AS path, 'h' || (o_orderkey % 977) AS h FROM orders WHERE o_orderkey % 11 <> 0),
n AS (SELECT o_orderpriority AS silo, CASE WHEN o_orderkey % 17 = 0 THEN 'q' ELSE 'p' END || o_orderkey AS path, CASE WHEN o_orderkey % 13 = 0 THEN 'x' || o_orderkey ELSE 'h' || (o_orderkey % 977) END AS h FROM orders WHERE o_orderkey % 7 <> 0),
g AS (SELECT silo, path, h, row_number() OVER (PARTITION BY silo, h ORDER BY path) AS rn FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.silo = o.silo AND n.path = o.path)),
c AS (SELECT silo, path, h, row_number() OVER (PARTITION BY silo, h ORDER BY path) AS rn FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.silo = o.silo AND n.path = o.path)),
diff AS (SELECT 'content-change' AS kind, silo, path, NULL AS previous_path, n.h AS content_hash FROM o JOIN n USING (silo, path) WHERE o.h <> n.h
UNION ALL SELECT CASE WHEN c.path IS NULL THEN CASE WHEN silo = '1-URGENT' THEN 'withheld' ELSE 'remove' END WHEN g.path IS NULL THEN 'add' ELSE 'path-rename' END, silo, coalesce(c.path, g.path), CASE WHEN c.path IS NOT NULL THEN g.path END, h FROM c FULL JOIN g USING (silo, h, rn))"""


def _diff(spark: SparkSession, d: str) -> DataFrame:
    old, new = _manifests(spark, d)
    return changes.manifest_diff(old, new, old.where("silo <> '1-URGENT'").select("silo"))


@query("manifest_diff", f"WITH {_DIFF} SELECT * FROM diff")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _diff(spark, d)


@query("tombstones_last_occurrence", f"WITH {_DIFF} SELECT silo, path, content_hash, content_hash IN (SELECT h FROM n) AS content_remains, content_hash NOT IN (SELECT h FROM n) AS last_occurrence FROM diff WHERE kind = 'remove'")
def _(spark: SparkSession, d: str) -> DataFrame:
    removed = _diff(spark, d).where("kind = 'remove'").select("silo", "path", "content_hash")
    return changes.tombstones(removed, _manifests(spark, d)[1])


@query("location_status", f"WITH {_DIFF} SELECT o.silo, o.path, CASE WHEN n.h IS NULL THEN 'missing' WHEN n.h = o.h THEN 'matching' ELSE 'changed' END AS status FROM o LEFT JOIN n USING (silo, path)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return evidence.location_status(*_manifests(spark, d))


@query(
    "upsert_latest",
    """WITH b AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey % 5000 AS k, o_totalprice + 1 AS v, o_orderkey AS ord FROM orders WHERE o_orderkey % 2 = 0),
f AS (SELECT k, arg_max(v, ord) AS v FROM n GROUP BY k) SELECT k, v FROM b WHERE k NOT IN (SELECT k FROM f) UNION ALL SELECT k, v FROM f""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    base = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    new = o.where("o_orderkey % 2 = 0").select((F.col("o_orderkey") % 5000).alias("k"), (F.col("o_totalprice") + 1).alias("v"), F.col("o_orderkey").alias("at"))
    return changes.upsert(base, changes.latest(new, ["k"], ["at"]).select("k", "v"), ["k"])


@query("newest_records", "SELECT document_id, language, title, byte_size FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY loaded_at DESC) AS rn FROM (SELECT DISTINCT document_id, language, title, byte_size, loaded_at FROM document_records)) WHERE rn = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "document_records").select("document_id", "language", "title", "byte_size", "loaded_at")
    return changes.latest(r, ["document_id"], ["loaded_at"]).select("document_id", "language", "title", "byte_size")


@query("retract_absent", "SELECT chunk_id FROM chunks WHERE document_id IN (SELECT document_id FROM documents)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return changes.retract_absent(table(spark, d, "chunks").select("chunk_id", "document_id"), table(spark, d, "documents"), ["document_id"]).select("chunk_id")


@query("not_in_tombstones", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return changes.not_in(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", table(spark, d, "lineitem").where("l_quantity > 49"), "l_orderkey")


@query("unindexed_chunks", "SELECT count(*) AS unindexed FROM chunks WHERE chunk_id NOT IN (SELECT target_id FROM vector_rows WHERE target_id IS NOT NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "vector_rows").select(F.col("target_id").alias("chunk_id")).dropna()
    return table(spark, d, "chunks").join(t, "chunk_id", "left_anti").agg(F.count("*").alias("unindexed"))


@query("key_sets", "SELECT 'added' AS kind, count(*) AS n FROM (SELECT document_id FROM document_records EXCEPT SELECT document_id FROM documents) UNION ALL SELECT 'removed', count(*) FROM (SELECT document_id FROM documents EXCEPT SELECT document_id FROM document_records) UNION ALL SELECT 'common', count(*) FROM (SELECT document_id FROM documents INTERSECT SELECT document_id FROM document_records)")
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "documents").select("document_id"), table(spark, d, "document_records").select("document_id")
    parts = [("added", b.subtract(a)), ("removed", a.subtract(b)), ("common", a.intersect(b))]
    out = None
    for name, rows in parts:
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("path_event_overlay")
def _(spark: SparkSession, d: str) -> DataFrame:
    return changes.path_overlay(table(spark, d, "document_path_events"))


@query("last_paths", "SELECT occurrence_id, arg_max(relative_path, (event_time, event_id)) AS relative_path FROM document_path_events WHERE occurrence_id IS NOT NULL GROUP BY occurrence_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "document_path_events").where("occurrence_id is not null")
    return e.groupBy("occurrence_id").agg(F.max_by("relative_path", F.struct("event_time", "event_id")).alias("relative_path"))


@query(
    "citation_resolution",
    """WITH o AS (SELECT document_id, count(DISTINCT relative_path) AS n FROM document_path_events WHERE relative_path IS NOT NULL GROUP BY document_id), k AS (SELECT DISTINCT document_id FROM documents)
SELECT c.chunk_id AS citation_id, c.document_id, CASE WHEN k.document_id IS NULL THEN 0 ELSE coalesce(o.n, 0) END AS locations, CASE WHEN k.document_id IS NULL THEN 0 ELSE coalesce(o.n, 0) END > 1 AS ambiguous, k.document_id IS NULL AS unknown
FROM chunks c LEFT JOIN k USING (document_id) LEFT JOIN o USING (document_id)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    cited = table(spark, d, "chunks").select(F.col("chunk_id").alias("citation_id"), "document_id")
    overlay = table(spark, d, "document_path_events").select("document_id", "occurrence_id", "relative_path")
    return evidence.resolve(cited, table(spark, d, "documents"), overlay)


@query(
    "span_overlap",
    """WITH s AS (SELECT 's' || chunk_id AS span_id, document_id, start_char + 10 AS a, end_char + 40 AS b FROM chunks WHERE ordinal % 7 = 0 AND start_char IS NOT NULL)
SELECT span_id, chunk_id, least(b, end_char) - greatest(a, start_char) AS overlap, start_char <= a AND end_char >= b AS intact FROM s JOIN chunks c USING (document_id) WHERE a < end_char AND start_char < b""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    s = c.where("ordinal % 7 = 0 and start_char is not null").select(F.concat(F.lit("s"), "chunk_id").alias("span_id"), "document_id", (F.col("start_char") + 10).alias("start_char"), (F.col("end_char") + 40).alias("end_char"))
    return evidence.spans_in_chunks(s, c)


@query(
    "span_union_coverage",
    """WITH s AS (SELECT document_id, start_char AS a, end_char AS b FROM chunks WHERE end_char > start_char),
r AS (SELECT *, max(b) OVER (PARTITION BY document_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s)
SELECT document_id, sum(greatest(0, b - greatest(a, coalesce(reach, -1)))) AS covered FROM r GROUP BY document_id""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return metrics.covered_length(table(spark, d, "chunks").select("document_id", "start_char", "end_char"), ["document_id"])


_NN = """q AS (SELECT vec_id AS query_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 50 = 0),
ds AS (SELECT query_id, e.vec_id AS id, q.label = e.label AS hit, round(list_distance(CAST(e.embedding AS DOUBLE[]), v), 6) AS dist FROM q, embeddings e),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS rank FROM ds)"""


@query(
    "retrieval_metrics",
    f"""WITH {_NN}, r AS (SELECT * FROM n WHERE rank <= 20), g AS (SELECT query_id, count(*) FILTER (WHERE hit) AS gold FROM ds GROUP BY query_id)
SELECT query_id, round(count(*) FILTER (WHERE hit AND rank <= 10) / max(gold), 6) AS recall, round(coalesce(max(1.0 / rank) FILTER (WHERE hit), 0), 6) AS mrr,
 round(coalesce(sum(1 / log2(rank + 1)) FILTER (WHERE hit AND rank <= 10), 0) / max(list_sum(list_transform(range(1, least(10, gold) + 1), lambda i: 1 / log2(i + 1)))), 6) AS ndcg,
 round(count(*) FILTER (WHERE hit AND rank <= 10) / 10, 6) AS precision FROM r JOIN g USING (query_id) GROUP BY query_id""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.col("label").alias("want"))
    ranked = vector.nearest_of_queries(e, asked, 20)
    gold = asked.select("query_id", "want").join(e.select(F.col("vec_id").alias("id"), "label"), F.col("want") == F.col("label")).select("query_id", "id")
    return metrics.retrieval(ranked, gold, 10)


_CONF = "c AS (SELECT least(1, greatest(0, n.language_confidence)) AS p, n.language = d.lang AS ok FROM normalized_documents n JOIN documents d USING (document_id) WHERE n.language_confidence IS NOT NULL AND n.language IS NOT NULL AND d.lang IS NOT NULL)"


def _confidences(spark: SparkSession, d: str) -> DataFrame:
    n, t = table(spark, d, "normalized_documents"), table(spark, d, "documents").select("document_id", "lang")
    j = n.join(t, "document_id").where("language_confidence is not null and language is not null and lang is not null")
    return j.select(F.least(F.lit(1.0), F.greatest(F.lit(0.0), "language_confidence")).alias("p"), (F.col("language") == F.col("lang")).alias("ok"))


@query("calibration_error", f"WITH {_CONF}, b AS (SELECT least(9, floor(p * 10)) AS bin, count(*) AS n, avg(p) AS c, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS a FROM c GROUP BY 1) SELECT round(sum(n * abs(c - a)) / sum(n), 6) AS ece FROM b")
def _(spark: SparkSession, d: str) -> DataFrame:
    return metrics.calibration_error(_confidences(spark, d), "p", "ok")


@query("selective_coverage", f"WITH {_CONF}, t AS (SELECT unnest([0.0, 0.5, 0.7, 0.9]) AS threshold) SELECT CAST(threshold AS DOUBLE) AS threshold, round(count(*) FILTER (WHERE p >= threshold) / count(*), 6) AS coverage, round(coalesce(count(*) FILTER (WHERE p >= threshold AND ok) / nullif(count(*) FILTER (WHERE p >= threshold), 0), 0), 6) AS accuracy FROM c, t GROUP BY threshold")
def _(spark: SparkSession, d: str) -> DataFrame:
    return metrics.selective_coverage(_confidences(spark, d), "p", "ok")


@query(
    "linkage_metrics",
    """WITH g AS (SELECT DISTINCT group_id, document_id FROM duplicate_groups WHERE group_id IS NOT NULL AND document_id IS NOT NULL),
p AS (SELECT DISTINCT a.document_id AS a, b.document_id AS b FROM g a JOIN g b ON a.group_id = b.group_id AND a.document_id < b.document_id),
t AS (SELECT DISTINCT a.document_id AS a, b.document_id AS b FROM documents a JOIN documents b ON a.text = b.text AND a.document_id < b.document_id),
c AS (SELECT count(*) FILTER (WHERE t.a IS NOT NULL AND p.a IS NOT NULL) AS tp, count(*) FILTER (WHERE t.a IS NULL) AS fp, count(*) FILTER (WHERE p.a IS NULL) AS fn FROM p FULL JOIN t ON p.a = t.a AND p.b = t.b)
SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "duplicate_groups").select("group_id", "document_id").dropna().distinct()
    # a fixture of labelled pairs: groups and copies here are small sets of a few members
    p = g.join(g.withColumnRenamed("document_id", "other"), "group_id").where("document_id < other").select(F.col("document_id").alias("left"), F.col("other").alias("right"))
    t = table(spark, d, "documents").where("text is not null").select("document_id", F.sha2("text", 256).alias("k"))
    t = t.join(t.withColumnRenamed("document_id", "other"), "k").where("document_id < other").select(F.col("document_id").alias("left"), F.col("other").alias("right"))
    return metrics.linkage(p, t)


@query("percentile_latency", "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY event_type")
def _(spark: SparkSession, d: str) -> DataFrame:
    return metrics.percentiles(table(spark, d, "events"), ["event_type"], "value")


@query(
    "multiset_f1",
    """WITH a AS (SELECT user_id, event_type, count(*) AS x FROM events WHERE event_id % 2 = 0 GROUP BY ALL), b AS (SELECT user_id, event_type, count(*) AS y FROM events WHERE event_id % 2 = 1 GROUP BY ALL),
j AS (SELECT user_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM a FULL JOIN b USING (user_id, event_type))
SELECT user_id, sum(least(x, y)) AS common, round(2 * sum(least(x, y)) / (sum(x) + sum(y)), 6) AS f1 FROM j GROUP BY user_id""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return metrics.multiset_f1(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id"], "event_type")


@query(
    "classification_metrics",
    """WITH j AS (SELECT d.lang AS g, n.language AS p FROM documents d JOIN normalized_documents n USING (document_id) WHERE d.lang IN ('eng', 'deu', 'rus', 'ukr') AND n.language IN ('eng', 'deu', 'rus', 'ukr')),
c AS (SELECT unnest(['eng', 'deu', 'rus', 'ukr']) AS class_id), k AS (SELECT class_id, (SELECT count(*) FROM j WHERE g = class_id AND p = class_id) AS tp, (SELECT count(*) FROM j WHERE g <> class_id AND p = class_id) AS fp, (SELECT count(*) FROM j WHERE g = class_id AND p <> class_id) AS fn FROM c)
SELECT class_id, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM k WHERE tp + fp + fn > 0""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    known = ("eng", "deu", "rus", "ukr")
    j = table(spark, d, "documents").select("document_id", "lang").join(table(spark, d, "normalized_documents").select("document_id", "language"), "document_id")
    return metrics.classification(j.where(F.col("lang").isin(*known) & F.col("language").isin(*known)), "lang", "language")


@query("paired_verdict")
def _(spark: SparkSession, d: str) -> DataFrame:
    v = metrics.paired_verdict(table(spark, d, "events").select(F.col("value").alias("candidate"), (F.col("value") * 0.98).alias("baseline")))
    return spark.createDataFrame([tuple(v.values())], "wins long, losses long, ties long, p double, low double, high double, verdict string")


@query("stratified_split", "WITH r AS (SELECT doc_id, class_id, (row_number() OVER (PARTITION BY class_id ORDER BY sha256('split:' || doc_id), doc_id) - 0.5) / count(*) OVER (PARTITION BY class_id) AS pos FROM subject_labels) SELECT doc_id, class_id, CASE WHEN pos < 0.6 THEN 'train' WHEN pos < 0.8 THEN 'dev' ELSE 'test' END AS split FROM r")
def _(spark: SparkSession, d: str) -> DataFrame:
    return classify.stratified_split(table(spark, d, "subject_labels"), "doc_id", "class_id")


@query(
    "taxonomy_classify",
    """WITH v AS (SELECT class_id, 0 AS variant, caption_en AS c FROM subjects UNION ALL SELECT class_id, 1, caption_ru FROM subjects UNION ALL SELECT class_id, 2, caption_uk FROM subjects), n AS (SELECT count(*) AS n FROM v WHERE c IS NOT NULL),
t AS (SELECT class_id, variant, term, count(*) AS w FROM (SELECT class_id, variant, unnest(regexp_extract_all(lower(c), '[\\p{L}\\p{N}]+')) AS term FROM v) GROUP BY ALL), i AS (SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf FROM t, n GROUP BY term, n),
o AS (SELECT class_id, variant, sum(w * idf) AS norm FROM t JOIN i USING (term) GROUP BY ALL), d AS (SELECT doc_id, term, count(*) * 3 AS weight FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
s AS (SELECT doc_id, class_id, variant, least(1, sum(least(weight, w) * idf) / greatest(max(norm), 1)) AS score, count(DISTINCT term) AS matched FROM d JOIN t USING (term) JOIN i USING (term) JOIN o USING (class_id, variant) GROUP BY ALL),
b AS (SELECT doc_id, class_id, max(score) AS score, arg_max(matched, (score, matched)) AS matched FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, class_id) AS k FROM b),
f AS (SELECT doc_id, max(class_id) FILTER (WHERE k = 1) AS best, max(score) FILTER (WHERE k = 1) AS s1, max(matched) FILTER (WHERE k = 1) AS m1, max(score) FILTER (WHERE k = 2) AS s2, coalesce(list(class_id ORDER BY k) FILTER (WHERE k BETWEEN 2 AND 4 AND round(score, 9) >= 0.35), []) AS alternates FROM r GROUP BY doc_id),
z AS (SELECT *, round(s1, 9) >= 0.45 AND m1 >= 2 AND (s2 IS NULL OR round(s1, 9) - round(s2, 9) >= 0.08) AS ok FROM f)
SELECT doc_id, CASE WHEN ok THEN best ELSE 'unclassified' END AS primary_class_id, round(CASE WHEN ok THEN s1 ELSE 1 - s1 END, 6) AS confidence, alternates FROM z""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    from archivolt.functions.text import words

    s = table(spark, d, "subjects")
    proto = classify.prototypes(s, ["caption_en", "caption_ru", "caption_uk"])
    w = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(words(F.col("text"))).alias("term"))
    docs = w.groupBy("doc_id", "term").agg((F.count("*") * classify.WEIGHTS["text"]).alias("weight"))
    return classify.decide(classify.class_scores(docs, proto), s.select("class_id", F.lit(1).alias("depth")))


@query("scheme_findings", "SELECT 'orphan' AS finding, class_id FROM (SELECT 'N' || n_nationkey AS class_id, 'R' || n_regionkey AS p FROM nation) WHERE p NOT IN (SELECT 'R' || r_regionkey FROM region WHERE r_regionkey < 3) UNION ALL SELECT 'no-caption', 'R' || r_regionkey FROM region WHERE r_regionkey = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("class_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_class_id"), F.col("n_name").alias("caption"))
    r = table(spark, d, "region").where("r_regionkey < 3").select(F.concat(F.lit("R"), "r_regionkey"), F.lit(None).cast("string"), F.when(F.col("r_regionkey") == 1, " ").otherwise(F.col("r_name")))
    return classify.scheme_findings(n.union(r))


@query(
    "allocation_findings",
    """WITH a AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS allocated FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey AS k, o_totalprice AS amount, allocated, o_orderstatus FROM orders JOIN a ON k = o_orderkey)
SELECT 'over-allocated' AS rule_id, CAST(k AS VARCHAR) AS subject FROM r WHERE allocated > amount UNION ALL SELECT 'match-state', CAST(k AS VARCHAR) FROM r WHERE o_orderstatus NOT IN ('O', 'F')""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(F.sum("l_extendedprice").alias("allocated"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderstatus").isin("O", "F"), "matched").otherwise("odd").alias("match_state"), F.lit("EUR").alias("currency"), F.lit("EUR").alias("counter_currency"))
    return rules.allocation_findings(o.join(a, "row_id")).select("rule_id", "subject")


@query("functional_violations", "SELECT 'functional' AS rule_id, CAST(l_orderkey AS VARCHAR) AS subject, 'ships:' || count(DISTINCT l_suppkey) AS detail FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.functional_violations(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("subject"), F.lit("ships").alias("predicate_id"), F.col("l_suppkey").alias("value")))


@query("conflict_pairs", "SELECT 'conflict part-of/references' AS rule_id, CAST(s AS VARCHAR) AS subject, CAST(o AS VARCHAR) AS detail FROM (SELECT l_orderkey AS s, l_partkey % 50 AS o FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey, l_partkey % 50 FROM lineitem WHERE l_returnflag = 'A')")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("l_returnflag") == "R", "part-of").when(F.col("l_returnflag") == "A", "references")
    return rules.conflicting_pairs(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("subject"), (F.col("l_partkey") % 50).alias("object"), p.alias("predicate_id")), "part-of", "references")


@query("confidence_findings", "SELECT 'confidence' AS rule_id, normalized_document_id AS subject FROM normalized_documents WHERE language_confidence IS NOT NULL AND (isnan(language_confidence) OR NOT language_confidence BETWEEN 0 AND 1)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.confidence_range(table(spark, d, "normalized_documents").withColumnRenamed("normalized_document_id", "fact_id"), "language_confidence").select("rule_id", "subject")


@query("unknown_predicates", "SELECT 'unknown-predicate' AS rule_id, CAST(event_id AS VARCHAR) AS subject, event_type AS detail FROM events WHERE event_type NOT IN ('click', 'view')")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = spark.createDataFrame([("click", "active"), ("view", "active"), ("error", "retired")], "predicate_id string, status string")
    return rules.unknown_predicates(table(spark, d, "events").select(F.col("event_id").alias("fact_id"), F.col("event_type").alias("predicate_id")), p)


@query("object_xor_literal", "SELECT 'object-xor-literal' AS rule_id, event_id AS subject FROM document_path_events WHERE (ledger_id IS NULL) = (occurrence_id IS NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "document_path_events").select(F.col("event_id").alias("fact_id"), F.col("ledger_id").alias("object"), F.col("occurrence_id").alias("literal"))
    return rules.object_xor_literal(f).select("rule_id", "subject")


@query("alternative_sums", "SELECT 'alternative-group' AS rule_id, CAST(l_orderkey AS VARCHAR) AS subject, CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_linestatus = 'F') > 1 AND bool_and(l_quantity IS NOT NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.alternative_sums(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("alternative_group_id"), (F.col("l_linestatus") == "F").alias("is_mandatory"), F.col("l_quantity").alias("quantity")))


@query(
    "cohort_anomalies",
    """WITH m AS (SELECT event_type, median(value) AS m, count(value) AS n FROM events GROUP BY 1), v AS (SELECT e.*, m.n, abs(value - m.m) AS dev FROM events e JOIN m USING (event_type)), a AS (SELECT event_type, median(dev) AS mad FROM v GROUP BY 1)
SELECT event_id, event_type, round(coalesce(0.6745 * dev / nullif(mad, 0), 0), 6) AS score, CASE WHEN n < 8 THEN 'insufficient-evidence' WHEN round(coalesce(0.6745 * dev / nullif(mad, 0), 0), 6) > 3.5 THEN 'anomaly' ELSE 'normal' END AS status FROM v JOIN a USING (event_type)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.cohort_anomalies(table(spark, d, "events"), "event_type", "event_id", "value")


@query("supplier_concentration", "WITH s AS (SELECT l_partkey % 100 AS family, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), t AS (SELECT *, q / sum(q) OVER (PARTITION BY family) AS share FROM s) SELECT family, count(*) AS suppliers, round(sum(share * share), 6) AS concentration FROM t GROUP BY family")
def _(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 100).alias("family"), "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    # sum of squares over squared sum: one pass, no window
    return s.groupBy("family").agg(F.count("*").alias("suppliers"), F.round(F.sum(F.col("q") * F.col("q")) / F.pow(F.sum("q"), F.lit(2)), 6).alias("concentration"))


@query(
    "forecast_ranges",
    """WITH w AS (SELECT source AS stage, sum(n_chars) AS input_bytes, count(*) % 2 = 0 AS truncated, count(*) % 3 = 0 AS rotational FROM documents GROUP BY source)
SELECT stage, input_bytes, truncated, rotational, CAST(round(input_bytes * 2.5) AS BIGINT) AS output_low, CAST(round(input_bytes * 4.0 * CASE WHEN truncated THEN 2 ELSE 1 END) AS BIGINT) AS output_high,
round(input_bytes / 1073741824 * 20 * CASE WHEN rotational THEN 1.5 ELSE 1 END, 6) AS seconds_low, round(input_bytes / 1073741824 * 240 * CASE WHEN rotational THEN 3 ELSE 1 END * CASE WHEN truncated THEN 2 ELSE 1 END, 6) AS seconds_high FROM w""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").groupBy(F.col("source").alias("stage")).agg(F.sum("n_chars").alias("input_bytes"), (F.count("*") % 2 == 0).alias("truncated"), (F.count("*") % 3 == 0).alias("rotational"))
    return forecast.ranges(w)


@query("device_budget", "WITH p AS (SELECT bucket AS device, sum(end_char - start_char) AS peak FROM chunks GROUP BY bucket) SELECT device, peak, 100000 AS free, peak <= 90000 AS fits FROM p")
def _(spark: SparkSession, d: str) -> DataFrame:
    needs = table(spark, d, "chunks").select(F.col("bucket").alias("device"), (F.col("end_char") - F.col("start_char")).alias("output_high"))
    free = spark.createDataFrame([(f"{i:x}", 100000) for i in range(16)], "device string, free long")
    return forecast.device_budget(needs, free)


@query("event_properties", "SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY event_type")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


@query("event_windows_batch", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return windows.tumbling(table(spark, d, "events"))


@query("event_windows_stream", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return windows.to_memory(windows.tumbling(windows.read_events(spark, f"{d}/events.parquet")), "event_windows")


@query("event_sessions", "WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS session_start, count(*) AS events FROM s GROUP BY user_id, k")
def _(spark: SparkSession, d: str) -> DataFrame:
    return windows.sessions(table(spark, d, "events"))

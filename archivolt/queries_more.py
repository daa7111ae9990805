"""Queries of boolean retrieval, item scores, budgets, reciprocal links, editions and activation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions.text import shingles, words
from archivolt.operators import dedupe, lexical, quality, scores, vector
from archivolt.operators.quality import Rule
from archivolt.queries_core import _SHINGLES
from archivolt.registry import query
from archivolt.session import table

_W = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "boolean_search",
    f"""WITH t AS (SELECT doc_id, lang, {_W} AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id FROM t WHERE (list_contains(w, 'greenhouse') AND contains(' ' || array_to_string(w, ' ') || ' ', ' cover letter ') AND NOT list_contains(w, 'orchard')) OR (len(list_filter(w, lambda x: starts_with(x, 'überg'))) > 0 AND lang = 'deu')""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text is not null").select("doc_id", "lang", words(F.col("text")).alias("w"))
    q = 'greenhouse AND "cover letter" AND NOT orchard OR (überg* AND lang:deu)'
    return t.where(lexical.query_filter(q, F.col("w"), {"lang": F.col("lang")})).select("doc_id")


@query(
    "shared_budget",
    """WITH b AS (SELECT chunk_id, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY document_id ORDER BY ordinal, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM chunks)
SELECT chunk_id, greatest(0, least(n, 5000 - before)) AS kept_chars, greatest(0, least(n, 5000 - before)) < n AS truncated FROM b""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return scores.budgeted_text(table(spark, d, "chunks").select("chunk_id", "document_id", "ordinal", "text"), ["document_id"], ["ordinal", "chunk_id"], "text", 5000).select("chunk_id", "kept_chars", "truncated")


_NN = """
WITH r AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS distance FROM embeddings q, embeddings e),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM r)"""


@query("reciprocal_links", _NN + ' SELECT a.query_id AS "left", a.id AS "right" FROM n a JOIN n b ON a.query_id = b.id AND a.id = b.query_id WHERE a.rank <= 4 AND b.rank <= 4 AND a.query_id < a.id')
def _(spark: SparkSession, d: str) -> DataFrame:
    """Both ranks are among all rows, every row being a query."""
    e = table(spark, d, "embeddings")
    ranked = vector.nearest_of_queries(e, e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 4)
    return scores.reciprocal_links(ranked, 4)


@query("edition_links", _SHINGLES + " SELECT l AS \"left\", r AS \"right\", round(c / (m + n - c), 6) AS score, CASE WHEN c / (m + n - c) >= 0.8 THEN 'lexical' ELSE 'edition' END AS method FROM p WHERE c / (m + n - c) >= 0.45")
def _(spark: SparkSession, d: str) -> DataFrame:
    grams = F.array_distinct(F.transform(shingles(words(F.col("text")), 5), lambda g: F.xxhash64(g)))
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text", grams.alias("grams"))
    copies = docs.groupBy(F.sha2(dedupe.normal_key("text"), 256).alias("key")).agg(F.min("doc_id").alias("id"), F.min_by("grams", "doc_id").alias("grams"))
    policy = dedupe.NEAR
    links = dedupe.near_links(copies, policy, least=policy.edition)
    return links.select("left", "right", F.round("score", 6).alias("score"), F.when(F.col("score") >= policy.similarity, "lexical").otherwise("edition").alias("method"))


@query(
    "activation_decision",
    """WITH r AS (SELECT count(*) FILTER (WHERE chunk_id IS NULL) AS a, count(*) FILTER (WHERE chunker_id IS NULL) AS b FROM chunks)
SELECT CASE WHEN a > 0 THEN 'blocked' WHEN b > 0 THEN 'quarantined' ELSE 'active' END AS decision, CASE WHEN a > 0 THEN 1 ELSE 0 END AS blocking_failures, CASE WHEN b > 0 THEN 1 ELSE 0 END AS warnings FROM r""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    report = quality.row_checks(table(spark, d, "chunks"), [Rule("id-null", "not_null", "chunk_id"), Rule("chunker-null", "not_null", "chunker_id")])
    return scores.activation(report, ["id-null"])


@query(
    "word_set_agreement",
    """WITH a AS (SELECT document_id, list_distinct(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+')) AS w FROM (SELECT document_id, max(title) AS title FROM document_records GROUP BY document_id) WHERE title IS NOT NULL),
b AS (SELECT document_id, list_distinct(regexp_extract_all(lower(min(title)), '[\\p{L}\\p{N}]+')) AS v FROM document_records GROUP BY document_id HAVING min(title) IS NOT NULL)
SELECT document_id, round(CASE WHEN len(w) + len(v) = 0 THEN 1 ELSE 2 * len(list_intersect(w, v)) / (len(w) + len(v)) END, 6) AS f1 FROM a JOIN b USING (document_id)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "document_records").groupBy("document_id").agg(F.max("title").alias("a"), F.min("title").alias("b")).where("a is not null")
    return t.select("document_id", F.round(scores.set_f1(words(F.col("a")), words(F.col("b"))), 6).alias("f1"))


@query("extension_counts", "SELECT lower(regexp_extract(relative_path, '\\.([A-Za-z0-9]+)$', 1)) AS extension, count(*) AS files, count(DISTINCT document_id) AS documents FROM document_path_events GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "document_path_events")
    return e.groupBy(F.lower(F.regexp_extract("relative_path", r"\.([A-Za-z0-9]+)$", 1)).alias("extension")).agg(F.count("*").alias("files"), F.count_distinct("document_id").alias("documents"))


@query("zipf_filler")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "documents").count()
    return scores.zipf_filler(spark, n, 20, 5000)


@query(
    "projection_reconciliation",
    """SELECT (SELECT count(document_id) FROM documents) AS source_rows, (SELECT count(DISTINCT document_id) FROM document_records) AS projection_rows,
 (SELECT count(*) FROM documents WHERE document_id NOT IN (SELECT document_id FROM document_records)) AS missing,
 (SELECT count(DISTINCT document_id) FROM document_records WHERE document_id NOT IN (SELECT document_id FROM documents)) AS extra,
 (SELECT count(*) FROM documents WHERE document_id NOT IN (SELECT document_id FROM document_records)) + (SELECT count(DISTINCT document_id) FROM document_records WHERE document_id NOT IN (SELECT document_id FROM documents)) = 0 AS same_ids""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    from archivolt.plans.inspect import reconcile

    return reconcile(table(spark, d, "documents").select("document_id"), table(spark, d, "document_records").select("document_id").distinct(), "document_id")


@query(
    "forecast_decision",
    """WITH p AS (SELECT bucket AS device, sum(end_char - start_char) * 4 AS peak FROM chunks GROUP BY bucket)
SELECT device, CASE WHEN device = 'f' THEN 'unknown' WHEN peak > 400000 THEN 'blocked' WHEN peak > 350000 THEN 'degraded' ELSE 'ready' END AS decision FROM p""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    from archivolt.operators.forecast import decision

    p = table(spark, d, "chunks").groupBy(F.col("bucket").alias("device")).agg((F.sum(F.col("end_char") - F.col("start_char")) * 4).alias("peak"))
    return p.select("device", decision(F.col("peak") <= 400000, F.col("device") != "f", F.col("peak") > 350000).alias("decision"))


@query("current_documents", "SELECT document_id, title, 'archive' AS source_schema, 'document_records' AS source_table FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY loaded_at DESC) AS rn FROM (SELECT DISTINCT document_id, trim(title) AS title, loaded_at FROM document_records)) WHERE rn = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    from archivolt.contracts import strip
    from archivolt.operators.changes import latest

    r = latest(table(spark, d, "document_records").select("document_id", strip("title").alias("title"), "loaded_at"), ["document_id"], ["loaded_at"])
    return r.select("document_id", "title", F.lit("archive").alias("source_schema"), F.lit("document_records").alias("source_table"))


@query("graph_projection_edges", "SELECT DISTINCT document_id AS src, group_id AS dst, method AS kind FROM duplicate_groups WHERE group_id IS NOT NULL AND role IN ('member', 'representative')")
def _(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "duplicate_groups").where(F.col("group_id").isNotNull() & F.col("role").isin("member", "representative"))
    return g.select(F.col("document_id").alias("src"), F.col("group_id").alias("dst"), F.col("method").alias("kind")).distinct()


@query(
    "bm25_all_cases",
    f"""WITH t AS (SELECT doc_id AS id, {_W} AS w FROM documents WHERE text IS NOT NULL), st AS (SELECT count(*) AS n, avg(len(w)) AS a FROM t),
q AS (SELECT evaluation_item_id AS query_id, unnest(list_distinct(regexp_extract_all(lower(query_text), '[\\p{{L}}\\p{{N}}]+'))) AS term FROM evaluation_items),
p AS (SELECT id, len(w) AS dl, unnest(w) AS term FROM t), f AS (SELECT id, term, count(*) AS tf, any_value(dl) AS dl FROM p WHERE term IN (SELECT term FROM q) GROUP BY id, term),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
s AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 6) AS score FROM f JOIN d USING (term) JOIN q USING (term), st GROUP BY query_id, id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) SELECT query_id, rank, id, score FROM r WHERE rank <= 10""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    cases = table(spark, d, "evaluation_items").select(F.col("evaluation_item_id").alias("query_id"), F.col("query_text").alias("query"))
    return lexical.batch_search(table(spark, d, "documents"), cases, 10)

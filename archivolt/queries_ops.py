"""Queries of classification schemes, contract rules, vocabulary rules, evaluation, evidence and publication planning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.contracts import Contract, Field
from archivolt.functions import hashing
from archivolt.functions.text import words
from archivolt.operators import changes, chunking, classify, evaluation, evidence, forecast, graph, lexical, quality, rules
from archivolt.registry import query
from archivolt.session import ensure_checkpoint_dir, table

_TREE = "t AS (SELECT 'N' || n_nationkey AS class_id, 'R' || n_regionkey AS parent_class_id, n_name AS caption FROM nation UNION ALL SELECT 'R' || r_regionkey, 'ALL', r_name FROM region UNION ALL SELECT 'ALL', NULL, 'everything')"


def _tree(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    out = n.select(F.concat(F.lit("N"), "n_nationkey").alias("class_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_class_id"), F.col("n_name").alias("caption"))
    out = out.union(r.select(F.concat(F.lit("R"), "r_regionkey"), F.lit("ALL"), "r_name"))
    return out.union(spark.createDataFrame([("ALL", None, "everything")], "class_id string, parent_class_id string, caption string"))


def _closure(tree: DataFrame) -> DataFrame:
    return graph.class_closure(tree.select("class_id", F.col("parent_class_id").alias("parent_id")))


@query("scheme_rows", f"WITH {_TREE} SELECT class_id, parent_class_id, caption, 'class' AS kind FROM t UNION ALL SELECT 'X' || p_size, 'ALL', p_type FROM (SELECT p_size, min(p_type) AS p_type FROM part GROUP BY 1) s(p_size, p_type) WHERE false UNION ALL SELECT o, NULL, o, 'outcome' FROM (VALUES ('unreadable'), ('unclassified')) v(o) UNION ALL SELECT 'X' || p_size, 'ALL', 'size', 'extension' FROM (SELECT DISTINCT p_size FROM part)".replace("UNION ALL SELECT 'X' || p_size, 'ALL', p_type FROM (SELECT p_size, min(p_type) AS p_type FROM part GROUP BY 1) s(p_size, p_type) WHERE false ", ""))
def _(spark: SparkSession, d: str) -> DataFrame:
    more = table(spark, d, "part").select(F.concat(F.lit("X"), "p_size").alias("class_id"), F.lit("ALL").alias("parent_class_id"), F.lit("size").alias("caption")).distinct()
    return classify.build_scheme(_tree(spark, d), more, ["unreadable", "unclassified"])[1].drop("scheme_id")


@query("scheme_validation", f"WITH {_TREE} SELECT 'unknown-namespace' AS finding, class_id FROM t WHERE left(class_id, 1) = 'A' UNION ALL SELECT 'licence', class_id FROM t WHERE left(class_id, 1) = 'R' UNION ALL SELECT 'orphan', class_id FROM t WHERE class_id = 'R3' AND false")
def _(spark: SparkSession, d: str) -> DataFrame:
    t = _tree(spark, d).withColumn("namespace", F.substring("class_id", 1, 1)).withColumn("licence", F.when(F.col("namespace") == "R", "unknown").otherwise("CC0"))
    return classify.validate(t, ["N", "R"], ["CC0"])


@query("crosswalk_coverage", "WITH m AS (SELECT DISTINCT n_regionkey AS c, n_nationkey % 7 AS code FROM nation), s AS (SELECT DISTINCT n_nationkey % 9 AS code FROM nation WHERE n_nationkey > 2) SELECT 'missing' AS finding, 'K' || code AS code FROM s WHERE code NOT IN (SELECT code FROM m) UNION ALL SELECT 'duplicate', 'K' || code FROM m GROUP BY code HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'unknown', 'K' || code FROM m WHERE code NOT IN (SELECT code FROM s)")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    classes = n.groupBy(F.col("n_regionkey").alias("class_id")).agg(F.collect_list(F.concat(F.lit("K"), F.col("n_nationkey") % 7)).alias("crosswalk"))
    return classify.crosswalk_coverage(classes, n.where("n_nationkey > 2").select(F.concat(F.lit("K"), F.col("n_nationkey") % 9).alias("code")))


@query("scheme_balance", f"WITH {_TREE} SELECT count(*) FILTER (WHERE left(class_id, 1) = 'N') AS leaves, 3 AS least_depth, 3 AS greatest_depth, (SELECT max(n) FROM (SELECT count(*) AS n FROM t GROUP BY parent_class_id)) AS greatest_fan_out FROM t")
def _(spark: SparkSession, d: str) -> DataFrame:
    t = _tree(spark, d)
    return classify.balance(t, _closure(t))


@query("captions_with_ancestors", f"WITH {_TREE} SELECT a.class_id, a.caption || CASE WHEN left(a.class_id, 1) = 'N' THEN ' ' || least(b.caption, 'everything') || ' ' || greatest(b.caption, 'everything') WHEN left(a.class_id, 1) = 'R' THEN ' everything' ELSE '' END AS caption FROM t a LEFT JOIN t b ON a.parent_class_id = b.class_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    t = _tree(spark, d)
    return classify.with_ancestors(t, _closure(t), "caption")


_FILES = "f AS (SELECT document_id AS file_id, min(relative_path) AS path FROM document_path_events WHERE document_id IS NOT NULL GROUP BY 1), n AS (SELECT document_id AS file_id, max(title) AS title FROM document_records WHERE document_id IS NOT NULL GROUP BY 1)"


@query(
    "file_features",
    f"""WITH {_FILES}, j AS (SELECT file_id, path, title FROM f LEFT JOIN n USING (file_id)),
w AS (SELECT file_id, unnest(regexp_extract_all(lower(path), '[\\p{{L}}\\p{{N}}]+')) AS term, 5 AS weight, 'path' AS field FROM j UNION ALL SELECT file_id, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}]+')), 4, 'title' FROM j)
SELECT file_id, term, sum(weight) AS weight, CASE WHEN bool_or(field = 'path') THEN 'path' ELSE 'title' END AS first_field FROM w GROUP BY file_id, term""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "document_path_events").where("document_id is not null").groupBy(F.col("document_id").alias("file_id")).agg(F.min("relative_path").alias("path"))
    n = table(spark, d, "document_records").where("document_id is not null").groupBy(F.col("document_id").alias("file_id")).agg(F.max("title").alias("title"))
    return classify.file_features(f.join(n, "file_id", "left").withColumn("text", F.lit(None).cast("string"))).drop("first_place")


@query(
    "physical_files",
    """WITH o AS (SELECT DISTINCT silo_id AS silo, split_part(relative_path, '/', 1) || '/' || split_part(relative_path, '/', 2) AS path, document_id FROM document_path_events WHERE relative_path IS NOT NULL AND document_id IS NOT NULL),
t AS (SELECT document_id, text FROM documents), j AS (SELECT o.*, text, coalesce(sum(length(text)) OVER (PARTITION BY silo, path ORDER BY document_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o LEFT JOIN t USING (document_id))
SELECT silo, path, CASE WHEN count(text) > 0 THEN 'read' ELSE 'empty' END AS status, count(text) AS documents, coalesce(bool_or(length(text) > greatest(0, 3000 - before)), false) AS truncated FROM j GROUP BY silo, path""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "document_path_events").where("relative_path is not null and document_id is not null")
    o = e.select(F.col("silo_id").alias("silo"), F.substring_index("relative_path", "/", 2).alias("path"), "document_id")
    none = spark.createDataFrame([], "silo string, path string, reason string")
    texts = table(spark, d, "documents").select("document_id", F.lit(None).cast("string").alias("title"), "text")
    return classify.physical_files(o, texts, none, 3000).select("silo", "path", "status", "documents", "truncated")


@query("accounting", "WITH i AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL), r AS (SELECT document_id, count(*) AS n FROM normalized_documents WHERE document_id IS NOT NULL GROUP BY 1), j AS (SELECT i.document_id AS i, r.document_id AS r, n FROM i FULL JOIN r USING (document_id)) SELECT count(i) AS inventory_rows, coalesce(sum(n), 0) AS rows, count(*) FILTER (WHERE r IS NULL) AS missing, count(*) FILTER (WHERE i IS NULL) AS extra, count(*) FILTER (WHERE n > 1) AS repeated, false AS equal FROM j")
def _(spark: SparkSession, d: str) -> DataFrame:
    return classify.accounting(table(spark, d, "normalized_documents").where("document_id is not null"), table(spark, d, "documents").where("document_id is not null"), ["document_id"])


@query("split_by_group", "WITH u AS (SELECT *, coalesce('g:' || (o_custkey % 50), '') AS unit FROM orders), m AS (SELECT unit, arg_min(o_orderpriority, o_orderkey) AS s, min(o_orderkey) AS k FROM u GROUP BY unit), p AS (SELECT unit, (row_number() OVER (PARTITION BY s ORDER BY sha256('split:' || k), k) - 0.5) / count(*) OVER (PARTITION BY s) AS pos FROM m) SELECT o_orderkey, CASE WHEN pos < 0.6 THEN 'train' WHEN pos < 0.8 THEN 'dev' ELSE 'test' END AS split FROM u JOIN p USING (unit)")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_custkey") % 50).alias("g"))
    return classify.split_groups(o, "o_orderkey", "o_orderpriority", "g").select("o_orderkey", "split")


_CHUNKS = Contract(
    "chunks",
    (Field("chunk_id", "string", primary=True, max_length=24), Field("document_id", "string", required=True, references=("documents", "document_id")), Field("chunker_id", "string"), Field("ordinal", "integer", required=True), Field("text", "string", max_length=4000), Field("start_char", "integer"), Field("end_char", "integer"), Field("generation_id", "string"), Field("contract_version", "string")),
    bindings={"accepted:contract_version": "1.0.0|1.1.0", "unit:start_char": "end_char"},
)


@query(
    "contract_rules",
    """WITH n AS (SELECT count(*) AS n FROM chunks), k AS (SELECT chunk_id, count(*) AS c FROM chunks GROUP BY 1)
SELECT 'chunks.chunk_id.not_null' AS rule_id, n AS checked, (SELECT count(*) FROM chunks WHERE chunk_id IS NULL) AS failed FROM n UNION ALL SELECT 'chunks.chunk_id.max_length', n, (SELECT count(*) FROM chunks WHERE length(chunk_id) > 24) FROM n
UNION ALL SELECT 'chunks.document_id.not_null', n, (SELECT count(*) FROM chunks WHERE document_id IS NULL) FROM n UNION ALL SELECT 'chunks.ordinal.not_null', n, (SELECT count(*) FROM chunks WHERE ordinal IS NULL) FROM n
UNION ALL SELECT 'chunks.text.max_length', n, (SELECT count(*) FROM chunks WHERE length(text) > 4000) FROM n UNION ALL SELECT 'chunks.contract_version.accepted', n, (SELECT count(*) FROM chunks WHERE contract_version NOT IN ('1.0.0', '1.1.0')) FROM n
UNION ALL SELECT 'chunks.start_char.unit', n, (SELECT count(*) FROM chunks WHERE start_char IS NOT NULL AND end_char IS NULL) FROM n UNION ALL SELECT 'chunks.unique', n, (SELECT count(*) FROM k WHERE c > 1) FROM n
UNION ALL SELECT 'chunks.document_id.reference', (SELECT count(document_id) FROM chunks), (SELECT count(*) FROM chunks WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL)) FROM n UNION ALL SELECT 'chunks.min_rows', n, 0 FROM n""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    report = quality.run_contract(table(spark, d, "chunks"), _CHUNKS, {"documents": table(spark, d, "documents")}, min_rows=1)
    return report.where(~F.col("rule_id").rlike(r"\.(type|extra_columns)$")).select("rule_id", "checked", "failed")


@query("merged_results", "WITH b AS (SELECT bucket, count(*) AS n, count(*) FILTER (WHERE chunker_id IS NULL) AS f FROM chunks GROUP BY 1) SELECT 'chunker' AS rule_id, sum(n) AS checked, sum(f) AS failed, CASE WHEN sum(f) > 0 THEN 'fail' ELSE 'pass' END AS status FROM b")
def _(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "chunks").groupBy("bucket").agg(F.count("*").alias("checked"), F.count_if(F.col("chunker_id").isNull()).alias("failed"))
    r = b.select(F.lit("chunker").alias("rule_id"), F.col("bucket").alias("batch"), "checked", "failed", F.when(F.col("failed") > 0, "fail").otherwise("pass").alias("status"), F.when(F.col("failed") > 0, F.array("bucket")).otherwise(F.array().cast("array<string>")).alias("samples"))
    return quality.merge_results(r).drop("samples")


@query("provenance_rules", "SELECT 'hash' AS rule_id, count(*) AS checked, count(*) FILTER (WHERE NOT regexp_matches(content_hash, '^[0-9a-f]{64}$')) AS failed FROM document_path_events UNION ALL SELECT 'reason', count(*), count(*) FILTER (WHERE kind <> 'initial' AND previous_relative_path IS NULL) FROM document_path_events UNION ALL SELECT 'inside', count(*), count(*) FILTER (WHERE list_contains(string_split(relative_path, '/'), '..') OR starts_with(relative_path, '/')) FROM document_path_events")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "document_path_events").select("content_hash", "relative_path", F.when(F.col("kind") == "initial", "file").otherwise(F.col("kind")).alias("status"), F.col("previous_relative_path").alias("reason"))
    return quality.provenance(e).select("rule_id", "checked", "failed")


_FACTS = "f AS (SELECT 'F' || l_orderkey || '-' || l_linenumber || '-' || row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS fact_id, 'S' || l_suppkey AS subject, 'P' || l_partkey AS object, l_returnflag AS flag, l_linestatus AS status FROM lineitem)"


def _facts(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.concat(F.lit("S"), "l_suppkey").alias("subject"), F.concat(F.lit("P"), "l_partkey").alias("object"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))


@query("exclusive_predicates", f"WITH {_FACTS} SELECT 'conflict A/N' AS rule_id, subject, object AS detail FROM f WHERE flag IN ('A', 'N') GROUP BY subject, object HAVING count(DISTINCT flag) > 1 UNION ALL SELECT 'conflict N/R', subject, object FROM f WHERE flag IN ('N', 'R') GROUP BY subject, object HAVING count(DISTINCT flag) > 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.exclusive_findings(_facts(spark, d).withColumnRenamed("flag", "predicate_id"), (("A", "N"), ("N", "R")))


@query("domain_range", "WITH t AS (SELECT n_nationkey AS n, 'R' || n_regionkey AS r FROM nation) SELECT 'domain' AS rule_id, CAST(s_suppkey AS VARCHAR) AS subject, 'N' || s_nationkey AS detail FROM supplier JOIN t ON n = s_nationkey WHERE r <> 'R1' UNION ALL SELECT 'range', CAST(s_suppkey AS VARCHAR), 'N' || (s_suppkey % 25) FROM supplier JOIN t ON n = s_suppkey % 25 WHERE r <> 'R2'")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    types = n.select(F.concat(F.lit("N"), "n_nationkey").alias("object_id"), F.concat(F.lit("N"), "n_nationkey").alias("class_id"))
    facts = table(spark, d, "supplier").select(F.col("s_suppkey").alias("fact_id"), F.lit("trades").alias("predicate_id"), F.concat(F.lit("N"), "s_nationkey").alias("subject"), F.concat(F.lit("N"), F.col("s_suppkey") % 25).alias("object"))
    predicates = spark.createDataFrame([("trades", "R1", "R2")], "predicate_id string, domain string, range string")
    return rules.domain_range(facts, types, predicates, _closure(_tree(spark, d)))


@query("disjoint_types", "SELECT 'disjoint' AS rule_id, CAST(s_suppkey AS VARCHAR) AS subject, 'disjoint types' AS detail FROM supplier JOIN nation a ON a.n_nationkey = s_nationkey JOIN nation b ON b.n_nationkey = s_suppkey % 25 WHERE (a.n_regionkey = 1 AND b.n_regionkey = 3) OR (a.n_regionkey = 3 AND b.n_regionkey = 1)")
def _(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    types = s.select(F.col("s_suppkey").alias("object_id"), F.concat(F.lit("N"), "s_nationkey").alias("class_id")).union(s.select("s_suppkey", F.concat(F.lit("N"), F.col("s_suppkey") % 25)))
    return rules.disjoint_types(types, _closure(_tree(spark, d)), spark.createDataFrame([("R1", "R3"), ("R3", "R1")], "a string, b string"))


@query("kind_findings", "SELECT 'kind-mismatch' AS rule_id, chunk_id AS subject, 'literal' AS detail FROM chunks WHERE ordinal % 3 = 0 AND chunker_id IS NOT NULL UNION ALL SELECT 'datatype', chunk_id, 'xsd:string' FROM chunks WHERE ordinal % 3 = 0 AND text IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "chunks").select(F.col("chunk_id").alias("fact_id"), F.when(F.col("ordinal") % 3 == 0, "length").otherwise("made-by").alias("predicate_id"), F.when(F.col("chunker_id").isNotNull(), F.col("chunker_id")).alias("object"), F.when(F.col("ordinal") % 3 == 0, F.col("text")).alias("literal"), F.lit(None).cast("string").alias("literal_datatype"))
    predicates = spark.createDataFrame([("length", "literal", "xsd:integer"), ("made-by", "object", None)], "predicate_id string, kind string, datatype string")
    return rules.kind_findings(facts, predicates)


@query("registry_findings", "SELECT 'failed-without-reason' AS rule_id, event_id AS subject, 'failed' AS detail FROM document_path_events WHERE kind = 'rename' AND coalesce(trim(ledger_id), '') = '' UNION ALL SELECT 'empty-with-reason', event_id, ledger_id FROM document_path_events WHERE kind = 'initial' AND coalesce(trim(ledger_id), '') <> ''")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "document_path_events")
    return rules.registry_findings(e.select(F.col("event_id").alias("row_id"), F.when(F.col("kind") == "rename", "failed").when(F.col("kind") == "initial", "empty").otherwise("ok").alias("status"), F.col("ledger_id").alias("reason")))


@query("stage_findings", "SELECT 'delivery-claim' AS rule_id, CAST(o_orderkey AS VARCHAR) AS subject, o_orderstatus AS detail FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'F'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return rules.stage_findings(table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("stage"), (F.col("o_totalprice") > 100000).alias("claims_delivery")), ("F",))


@query("span_ids", """SELECT chunk_id, sha256('["' || document_id || '", ' || ordinal || ', ' || coalesce(CAST(start_char AS VARCHAR), 'null') || ', ' || coalesce(CAST(end_char AS VARCHAR), 'null') || ', "text"]') AS span_id FROM chunks WHERE document_id IS NOT NULL""")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").where("document_id is not null")
    return c.select("chunk_id", hashing.span_id(F.col("document_id"), F.col("ordinal"), F.col("start_char").cast("long"), F.col("end_char").cast("long"), F.lit("text")).alias("span_id"))


@query("feature_counts", "WITH t AS (SELECT alias_id, regexp_extract_all(lower(alias_text), '[\\p{L}\\p{N}]+') AS w FROM aliases WHERE alias_text IS NOT NULL), x AS (SELECT alias_id, unnest(list_filter(w, lambda v: length(v) > 1)) AS v FROM t), f AS (SELECT alias_id, 'w:' || v AS feature FROM x UNION ALL SELECT alias_id, 'c:' || substring('^' || v || '$', i, 3) FROM (SELECT alias_id, v, unnest(range(1, length(v) + 1)) AS i FROM x WHERE length(v) >= 5)) SELECT alias_id, feature, count(*) AS n FROM f GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "aliases").where("alias_text is not null")
    return a.select("alias_id", F.explode(classify.features(words(F.col("alias_text")))).alias("feature")).groupBy("alias_id", "feature").agg(F.count("*").alias("n"))


@query("span_scores", "WITH g AS (SELECT document_id, start_char, end_char FROM chunks WHERE ordinal % 3 <> 0 AND start_char IS NOT NULL AND end_char IS NOT NULL), p AS (SELECT document_id, start_char, end_char FROM chunks WHERE ordinal % 2 = 0 AND start_char IS NOT NULL AND end_char IS NOT NULL), c AS (SELECT (SELECT count(*) FROM (SELECT * FROM g INTERSECT SELECT * FROM p)) AS tp, (SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM g)) AS fp, (SELECT count(*) FROM (SELECT * FROM g EXCEPT SELECT * FROM p)) AS fn) SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").where("start_char is not null and end_char is not null and document_id is not null").select("document_id", "start_char", "end_char", "ordinal")
    return evaluation.span_scores(c.where("ordinal % 3 <> 0"), c.where("ordinal % 2 = 0"), ("document_id", "start_char", "end_char"))


@query("failure_agreement", "WITH j AS (SELECT start_char IS NULL AS g, chunker_id IS NULL AS p FROM chunks) SELECT count(*) FILTER (WHERE g AND p) AS both, count(*) FILTER (WHERE g AND NOT p) AS only_gold, count(*) FILTER (WHERE p AND NOT g) AS only_predicted, count(*) FILTER (WHERE NOT g AND NOT p) AS neither, round(count(*) FILTER (WHERE g = p) / count(*), 6) AS agreement FROM j")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    return evaluation.failure_agreement(c.select("chunk_id", F.col("start_char").isNull().alias("failed")), c.select("chunk_id", F.col("chunker_id").isNull().alias("failed")), "chunk_id")


@query("arm_summary", "SELECT event_type AS arm, 'c' || (user_id % 3) AS cohort, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median FROM events WHERE value IS NOT NULL GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.arm_summary(table(spark, d, "events").select(F.col("event_type").alias("arm"), F.concat(F.lit("c"), F.col("user_id") % 3).alias("cohort"), F.col("value").alias("score")))


_RANKED = "r AS (SELECT user_id AS query_id, event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank, event_type FROM events)"


@query("judged_hits", f"WITH {_RANKED}, t AS (SELECT *, CASE event_type WHEN 'click' THEN 'relevant' WHEN 'view' THEN 'hard-negative' WHEN 'purchase' THEN 'forbidden' END AS grade FROM r), w AS (SELECT DISTINCT query_id FROM t WHERE grade = 'relevant') SELECT t.query_id, count(*) FILTER (WHERE grade = 'relevant') AS relevant, count(*) FILTER (WHERE grade = 'hard-negative') AS hard_negative, count(*) FILTER (WHERE grade = 'forbidden') AS forbidden, count(*) FILTER (WHERE grade IS NULL) AS unjudged, count(*) > 0 AND max(w.query_id) IS NULL AS false_positive, coalesce(bool_or(rank = 1 AND grade = 'relevant'), false) AS exact FROM t LEFT JOIN w USING (query_id) WHERE rank <= 10 GROUP BY t.query_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, d, "events").select(F.col("user_id").alias("query_id"), F.col("event_id").alias("id"), "value", "event_type")
    ranked = e.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("value"), "id")))
    grade = F.when(F.col("event_type") == "click", "relevant").when(F.col("event_type") == "view", "hard-negative").when(F.col("event_type") == "purchase", "forbidden")
    return evaluation.judged(ranked, e.select("query_id", "id", grade.alias("grade")).where("grade is not null"))


@query(
    "served_spans",
    """WITH c AS (SELECT chunk_id, document_id, start_char AS cs, end_char AS ce, ordinal FROM chunks WHERE start_char IS NOT NULL AND end_char IS NOT NULL AND document_id IS NOT NULL),
s AS (SELECT DISTINCT document_id, cs + 50 AS a, ce + 50 AS b FROM c WHERE ordinal % 5 = 0), t AS (SELECT * FROM c WHERE ordinal < 10),
j AS (SELECT s.*, cs, ce FROM s LEFT JOIN t USING (document_id)), w AS (SELECT document_id, a, b, coalesce(bool_or(cs <= a AND ce >= b), false) AS whole FROM j GROUP BY ALL),
i AS (SELECT document_id, avg(CASE WHEN whole THEN 1.0 ELSE 0.0 END) AS intact FROM w GROUP BY 1), n AS (SELECT document_id, sum(ce - cs) AS served FROM t GROUP BY 1), q AS (SELECT DISTINCT document_id FROM c WHERE ordinal < 10 OR ordinal % 5 = 0)
SELECT document_id AS query_id, round(coalesce(intact, 1), 6) AS intact, coalesce(served, 0) AS served_chars FROM q LEFT JOIN i USING (document_id) LEFT JOIN n USING (document_id)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").where("start_char is not null and end_char is not null and document_id is not null")
    ranked = c.where("ordinal < 10").select(F.col("document_id").alias("query_id"), (F.col("ordinal") + 1).alias("rank"), "chunk_id")
    spans = c.where("ordinal % 5 = 0").select(F.col("document_id").alias("query_id"), "document_id", (F.col("start_char") + 50).alias("start_char"), (F.col("end_char") + 50).alias("end_char"))
    return evaluation.served(ranked, c, spans).drop("covered")


@query("evidence_locations", "WITH p AS (SELECT DISTINCT document_id, occurrence_id, silo_id, relative_path FROM document_path_events WHERE relative_path IS NOT NULL), q AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY silo_id NULLS FIRST, relative_path, occurrence_id NULLS FIRST) AS rn FROM p), c AS (SELECT DISTINCT chunk_id, document_id FROM chunks) SELECT chunk_id AS citation_id, 'content' AS kind, c.document_id, occurrence_id, silo_id, relative_path, CASE WHEN relative_path IS NOT NULL THEN CASE WHEN rn = 1 THEN 'primary' ELSE 'copy' END END AS role, CASE WHEN c.document_id IS NULL THEN 'unresolved' WHEN c.document_id NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL) THEN 'unknown-document' WHEN relative_path IS NULL THEN 'no-location' END AS finding FROM c LEFT JOIN q ON c.document_id = q.document_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select(F.col("chunk_id").alias("citation_id"), F.lit("content").alias("kind"), "document_id", F.lit(None).cast("string").alias("fact_id"), F.lit(None).cast("string").alias("report_id"))
    return evidence.locations(c, table(spark, d, "documents"), table(spark, d, "document_path_events"))


@query("container_hashes", "WITH RECURSIVE o AS (SELECT DISTINCT n_nationkey AS id, CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey - 1 END AS up, 'h' || n_nationkey AS h FROM nation), w AS (SELECT id, up, h FROM o UNION ALL SELECT w.id, o.up, o.h FROM w JOIN o ON w.up = o.id) SELECT 'o' || id AS occurrence_id, h AS physical_hash FROM w WHERE up IS NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_nationkey")
    return evidence.bind_members(table(spark, d, "nation").select(F.concat(F.lit("o"), n).alias("occurrence_id"), F.when(n % 6 != 0, F.concat(F.lit("o"), n - 1)).alias("container_id"), F.concat(F.lit("h"), n).alias("content_hash")))


@query("invalidated", "WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS src, p_partkey * 2 AS dst FROM part), r(id) AS (SELECT DISTINCT p_partkey FROM part WHERE p_size = 7 UNION SELECT e.dst FROM r JOIN e ON e.src = r.id) SELECT id FROM r")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return changes.invalidation(p.where("p_size = 7").select(F.col("p_partkey").alias("content_hash")), p.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") * 2).alias("dst")))


@query("superseded_attempts", "SELECT bucket AS stage, generation_id AS attempt_id, CASE WHEN generation_id = 'gen-0029' OR bucket NOT IN (SELECT bucket FROM chunks WHERE generation_id = 'gen-0029') THEN 'published' ELSE 'superseded' END AS state FROM (SELECT DISTINCT bucket, generation_id FROM chunks WHERE bucket IS NOT NULL AND generation_id IS NOT NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "chunks").where("bucket is not null and generation_id is not null").select(F.col("bucket").alias("stage"), F.concat_ws("/", "bucket", "generation_id").alias("attempt_id")).distinct().withColumn("state", F.lit("published"))
    out = changes.supersede(a, a.where("attempt_id like '%gen-0029'").select("stage", "attempt_id"))
    return out.select("stage", F.substring_index("attempt_id", "/", -1).alias("attempt_id"), "state")


@query("prunable", "SELECT generation_id FROM (SELECT DISTINCT generation_id FROM document_records WHERE generation_id IS NOT NULL) WHERE CAST(right(generation_id, 2) AS INT) % 2 = 0 AND generation_id NOT IN (SELECT generation_id FROM chunks WHERE bucket = 'f' AND generation_id IS NOT NULL)")
def _(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "document_records").where("generation_id is not null").groupBy("generation_id").agg(F.min("loaded_at").alias("created_at"))
    g = g.withColumn("state", F.when(F.expr("cast(right(generation_id, 2) as int) % 2 = 0"), "stale").otherwise("active"))
    return changes.prune_plan(g, table(spark, d, "chunks").where("bucket = 'f'").select("generation_id", F.lit("ledger").alias("reason"))).select("generation_id")


@query("work_counts", "SELECT stage, family, count(media_type) AS files, coalesce(CAST(sum(byte_size) AS BIGINT), 0) AS input_bytes FROM (VALUES ('read', 'extract', 'text/'), ('scan', 'extract', 'image/'), ('pages', 'extract', 'application/pdf'), ('none', 'vectors', 'video/')) p(stage, family, prefix) LEFT JOIN document_records ON starts_with(media_type, prefix) GROUP BY stage, family")
def _(spark: SparkSession, d: str) -> DataFrame:
    inventory = table(spark, d, "document_records").select("media_type", F.col("byte_size").cast("long").alias("size"), F.lit(False).alias("cached"))
    plan = spark.createDataFrame([("read", "extract", "text/"), ("scan", "extract", "image/"), ("pages", "extract", "application/pdf"), ("none", "vectors", "video/")], "stage string, family string, media_prefix string")
    return forecast.work_counts(inventory, plan)


@query("family_ranges", "WITH w AS (SELECT bucket AS stage, 'chunk' AS family, CAST(sum(end_char - start_char) AS BIGINT) AS input_bytes FROM chunks WHERE start_char IS NOT NULL GROUP BY bucket) SELECT stage, family, input_bytes, CAST(round(input_bytes * 1.0) AS BIGINT) AS output_low, CAST(round(input_bytes * 1.8) AS BIGINT) AS output_high FROM w")
def _(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "chunks").where("start_char is not null").groupBy(F.col("bucket").alias("stage")).agg(F.sum(F.col("end_char") - F.col("start_char")).cast("long").alias("input_bytes"))
    return forecast.family_ranges(w.select("stage", F.lit("chunk").alias("family"), "input_bytes"))


@query("hierarchical_metrics", "WITH j AS (SELECT ['ALL', 'R' || a.n_regionkey, 'N' || a.n_nationkey] AS g, ['ALL', 'R' || b.n_regionkey, 'N' || b.n_nationkey] AS p FROM supplier JOIN nation a ON a.n_nationkey = s_nationkey JOIN nation b ON b.n_nationkey = s_suppkey % 25), c AS (SELECT sum(len(list_intersect(g, p))) AS c, sum(len(g)) AS g, sum(len(p)) AS p, avg(len(g) + len(p) - 2 * len(list_intersect(g, p))) AS d FROM j) SELECT round(c / p, 6) AS precision, round(c / g, 6) AS recall, round(2 * c / (p + g), 6) AS f1, round(d, 6) AS distance FROM c")
def _(spark: SparkSession, d: str) -> DataFrame:
    def path(key: str, name: str):
        return table(spark, d, "nation").select(F.col("n_nationkey").alias(key), F.array(F.lit("ALL"), F.concat(F.lit("R"), "n_regionkey"), F.concat(F.lit("N"), "n_nationkey")).alias(name))

    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("a"), (F.col("s_suppkey") % 25).alias("b"))
    return evaluation.hierarchical(s.join(path("a", "gold_path"), "a").join(path("b", "predicted_path"), "b"))


@query("partition_agreement", "WITH x AS (SELECT o_orderkey % 7 AS a, o_custkey % 5 AS b, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT sum(n) AS n, sum(n * (n - 1) / 2) AS pairs, sum(n * ln(n)) AS h FROM x), p AS (SELECT sum(n * (n - 1) / 2) AS pairs, sum(n * ln(n)) AS h FROM (SELECT a, sum(n) AS n FROM x GROUP BY a)), q AS (SELECT sum(n * (n - 1) / 2) AS pairs, sum(n * ln(n)) AS h FROM (SELECT b, sum(n) AS n FROM x GROUP BY b)), c AS (SELECT t.n, t.pairs, t.h, p.pairs AS pa, q.pairs AS pb, p.h AS ha, q.h AS hb, p.pairs * q.pairs / (t.n * (t.n - 1) / 2) AS e FROM t, p, q) SELECT n, round((pairs - e) / ((pa + pb) / 2 - e), 6) AS ari, round(2 * (ln(n) + (h - ha - hb) / n) / (2 * ln(n) - ha / n - hb / n), 6) AS nmi FROM c")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return graph.agreement(o.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7).alias("community")), o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 5).alias("community")))


_STEM = lexical.STEM.replace("'", "''")


@query(
    "bm25_fields",
    f"""WITH t AS (SELECT document_id, arg_max(title, loaded_at) AS title FROM (SELECT document_id, coalesce(title, '') AS title, loaded_at FROM document_records) GROUP BY 1),
d AS (SELECT doc_id, text AS body, title FROM documents LEFT JOIN t USING (document_id)),
w AS (SELECT doc_id, 'body' AS field, list_transform(list_filter(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+'), lambda x: NOT list_contains({list(lexical.STOP)!r}, x)), lambda x: regexp_replace(x, '{_STEM}', '\\1')) AS w FROM d WHERE body IS NOT NULL
 UNION ALL SELECT doc_id, 'title', list_transform(list_filter(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}]+'), lambda x: NOT list_contains({list(lexical.STOP)!r}, x)), lambda x: regexp_replace(x, '{_STEM}', '\\1')) FROM d WHERE title IS NOT NULL),
s AS (SELECT field, count(*) AS n, avg(len(w)) AS mean FROM w GROUP BY field), x AS (SELECT doc_id, field, len(w) AS dl, unnest(w) AS term FROM w),
f AS (SELECT doc_id, field, term, count(*) AS tf, max(dl) AS dl FROM x WHERE term IN (regexp_replace('bales', '{_STEM}', '\\1'), regexp_replace('contract', '{_STEM}', '\\1')) GROUP BY ALL), g AS (SELECT field, term, count(*) AS df FROM f GROUP BY ALL),
r AS (SELECT doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean)) * CASE field WHEN 'title' THEN 2.0 ELSE 1.0 END) AS score FROM f JOIN g USING (field, term) JOIN s USING (field) GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score FROM r ORDER BY round(score, 6) DESC, doc_id LIMIT 25""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """The index is written to the shared folder and read back, so that the query runs on saved postings."""
    titles = table(spark, d, "document_records").groupBy("document_id").agg(F.max_by(F.coalesce("title", F.lit("")), "loaded_at").alias("title"))
    docs = table(spark, d, "documents").select("doc_id", "document_id", F.col("text").alias("body")).join(titles, "document_id", "left")
    path = f"{ensure_checkpoint_dir(spark)}/lexical-{uuid.uuid4().hex}"
    lexical.save_fields(docs, path, {"body": "body", "title": "title"}, "doc_id")
    hits = lexical.search_fields(spark, path, "bales contract", {"title": 2.0})
    return hits.orderBy(F.desc("score"), "id").limit(25).select(F.col("id").alias("doc_id"), "score")


@query("normalized_texts")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = chunking.normalize(table(spark, d, "documents").select("doc_id", "text"))
    return n.select("doc_id", F.length("canonical").alias("canonical_chars"), F.length("search").alias("search_chars"), "language", "confidence", "error")


@query("original_chunks")
def _(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_originals(table(spark, d, "documents").select("doc_id", "text")).drop("text")

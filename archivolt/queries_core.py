"""Queries of text, duplicates, retrieval, vectors and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions import hashing
from archivolt.functions.language import detect_language, detect_sql
from archivolt.functions.text import canonical_view, normalize_for_scoring, search_view, shingles, to_source, words
from archivolt.operators import chunking, dedupe, graph, lexical, vector
from archivolt.operators.components import connected_components
from archivolt.registry import query
from archivolt.session import table

_W = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "retained_language_counts",
    """
WITH k AS (SELECT doc_id, lang, n_chars, trim(regexp_replace(lower(text), '[ \\t\\n\\r]+', ' ', 'g')) AS key FROM documents WHERE text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n_chars DESC, doc_id) AS rn FROM k)
SELECT lang, count(*) AS kept, sum(n_chars) AS chars FROM r WHERE rn = 1 GROUP BY lang""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null")
    longest = F.max_by(F.struct("lang", "n_chars"), F.struct("n_chars", -F.col("doc_id"))).alias("r")
    kept = docs.groupBy(F.sha2(dedupe.normal_key("text"), 256).alias("k")).agg(longest)
    return kept.groupBy(F.col("r.lang").alias("lang")).agg(F.count("*").alias("kept"), F.sum("r.n_chars").alias("chars"))


@query("exact_duplicates", "SELECT sha256(text) AS key_hash, min(doc_id) AS leader, count(*) AS members FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_groups(table(spark, d, "documents"), F.col("text"), "doc_id")


@query(
    "exact_edges",
    """WITH g AS (SELECT text, min(doc_id) AS l FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)
SELECT g.l AS "left", d.doc_id AS "right" FROM g JOIN documents d ON d.text = g.text AND d.doc_id <> g.l""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_edges(table(spark, d, "documents"), F.col("text"), "doc_id")


@query(
    "normalized_duplicates",
    """WITH k AS (SELECT doc_id, trim(regexp_replace(lower(text), '[ \\t\\n\\r]+', ' ', 'g')) AS key FROM documents WHERE text IS NOT NULL)
SELECT sha256(key) AS key_hash, min(doc_id) AS leader, count(*) AS members FROM k GROUP BY key HAVING count(*) > 1""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_groups(table(spark, d, "documents"), dedupe.normal_key("text"), "doc_id")



_SHINGLES = f"""WITH RECURSIVE k AS (SELECT doc_id, trim(regexp_replace(lower(text), '[ \\t\\n\\r]+', ' ', 'g')) AS key, text FROM documents WHERE text IS NOT NULL),
c AS (SELECT min(doc_id) AS id, count(*) AS copies, key, {_W.replace('lower(text)', 'lower(min(text))')} AS w FROM k GROUP BY key),
g AS (SELECT id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM c),
x AS (SELECT id, len(s) AS n, unnest(s) AS gram FROM g), p AS (SELECT a.id AS l, b.id AS r, count(*) AS c, max(a.n) AS m, max(b.n) AS n FROM x a JOIN x b ON a.gram = b.gram AND a.id < b.id GROUP BY ALL)"""


@query(
    "near_duplicates_minhash",
    _SHINGLES + """, e AS (SELECT l, r FROM p WHERE c / (m + n - c) >= 0.8), u AS (SELECT l AS a, r AS b FROM e UNION SELECT r, l FROM e), v(a, b) AS (SELECT id, id FROM c UNION SELECT v.a, u.b FROM v JOIN u ON u.a = v.b),
o AS (SELECT a AS id, min(b) AS class_id FROM v GROUP BY a), q AS (SELECT a AS id, count(*) AS links FROM u GROUP BY a)
SELECT d.doc_id AS id, coalesce(o.class_id, d.doc_id) AS class_id, coalesce(links, 0) AS links, coalesce(copies, 1) AS copies FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN c ON c.key = k.key LEFT JOIN o ON o.id = c.id LEFT JOIN q ON q.id = c.id""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.near_duplicates(table(spark, d, "documents"))


@query(
    "suppressed_anti_join",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS rn FROM documents WHERE text IS NOT NULL)
SELECT source, count(*) AS kept FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r WHERE rn > 1) GROUP BY source""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    keyed = docs.where("text is not null").select("doc_id", "n_chars", F.sha2("text", 256).alias("root"))
    overlay = dedupe.assemble(keyed.select(F.col("doc_id").alias("document_id"), "root"), keyed.select(F.col("doc_id").alias("document_id"), F.col("n_chars").alias("text_chars")))
    return dedupe.suppress(docs, overlay.withColumnRenamed("document_id", "doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("kept"))


@query(
    "duplicate_roles",
    """WITH m AS (SELECT DISTINCT group_id AS root, document_id FROM duplicate_groups WHERE group_id IS NOT NULL AND document_id IS NOT NULL),
l AS (SELECT document_id, max(n_chars) AS n FROM documents GROUP BY document_id), j AS (SELECT m.*, l.n FROM m JOIN l USING (document_id)),
s AS (SELECT root, count(*) AS c FROM j GROUP BY root HAVING count(*) > 1)
SELECT root, document_id, CASE WHEN row_number() OVER (PARTITION BY root ORDER BY n DESC, document_id) = 1 THEN 'representative' ELSE 'member' END AS role FROM j JOIN s USING (root)""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "duplicate_groups").select(F.col("group_id").alias("root"), "document_id").dropna().distinct()
    n = table(spark, d, "documents").groupBy("document_id").agg(F.max("n_chars").alias("text_chars"))
    a = dedupe.assemble(m, n)
    # groups are named by their members; the old name comes back through the membership
    return a.join(m, "document_id").join(a.where("role = 'representative'").select("group_id", F.col("document_id").alias("leader")), "group_id").join(m.select(F.col("root").alias("r"), F.col("document_id").alias("leader")), "leader").where("root = r").select("root", "document_id", "role")


@query(
    "best_incident_method",
    """WITH e AS (SELECT document_id, method, score, CASE method WHEN 'exact' THEN 1 WHEN 'normalized' THEN 2 WHEN 'lexical' THEN 3 WHEN 'edition' THEN 4 ELSE 0 END AS rk FROM duplicate_groups WHERE document_id IS NOT NULL AND method IS NOT NULL AND score IS NOT NULL)
SELECT document_id AS id, arg_min(method, (rk, -score)) AS method FROM e GROUP BY document_id""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "duplicate_groups").where("document_id is not null and method is not null and score is not null")
    return dedupe.best_method(g.select(F.col("document_id").alias("left"), F.col("document_id").alias("right"), "method", "score")).select("id", "method")


@query("stable_ids", "SELECT doc_id, sha256('document:' || coalesce(document_id, '')) AS a, sha256('normalized-document:' || document_id || ':norm-v2') AS b, sha256('chunk:' || document_id || ':ck:text:0:' || n_chars || ':0') AS c FROM documents")
def _(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("document_id")
    return table(spark, d, "documents").select("doc_id", hashing.document_id(F.coalesce(i, F.lit(""))).alias("a"), hashing.normalized_document_id(i, F.lit("norm-v2")).alias("b"), hashing.chunk_id(i, F.lit("ck"), F.lit("text"), F.lit(0), F.col("n_chars"), F.lit(0)).alias("c"))


@query("partition_bucket", "SELECT substr(document_id, 1, 1) AS lake, CAST(CAST('0x' || substr(sha256(document_id), 1, 7) AS BIGINT) % 16 AS VARCHAR) AS store, count(*) AS n FROM documents GROUP BY ALL")
def _(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("document_id")
    return table(spark, d, "documents").groupBy(hashing.lake_bucket(i).alias("lake"), hashing.store_bucket(i).alias("store")).agg(F.count("*").alias("n"))


@query("id_checksum", "WITH i AS (SELECT DISTINCT document_id AS n, left(sha256(document_id), 3) AS p FROM documents WHERE document_id IS NOT NULL), g AS (SELECT p, sha256(string_agg(n, '|' ORDER BY n)) AS c FROM i GROUP BY p) SELECT sha256(string_agg(p || ':' || c, '|' ORDER BY p)) AS checksum FROM g")
def _(spark: SparkSession, d: str) -> DataFrame:
    return hashing.ids_checksum(table(spark, d, "documents"), "document_id")


@query("word_counts", f"WITH w AS (SELECT unnest({_W}) AS term FROM documents WHERE text IS NOT NULL) SELECT term, count(*) AS n FROM w GROUP BY term ORDER BY n DESC, term LIMIT 100")
def _(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").select(F.explode(words(F.col("text"))).alias("term"))
    return w.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(100)


@query(
    "shingle_counts",
    f"""WITH w AS (SELECT doc_id, {_W} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w)
SELECT doc_id, len(g) AS shingles, len(list_distinct(g)) AS different FROM s""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").where("text is not null").select("doc_id", shingles(words(F.col("text")), 5).alias("g"))
    return g.select("doc_id", F.size("g").alias("shingles"), F.size(F.array_distinct("g")).alias("different"))


@query("language_detect", detect_sql("text", "documents", "doc_id"))
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", detect_language("text").alias("r")).select("doc_id", "r.language", "r.confidence")


@query("text_views")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").select("doc_id", canonical_view("text").alias("c"))
    s = c.select("doc_id", "c", search_view(F.col("c.text")).alias("s"))
    return s.select("doc_id", F.length("c.text").alias("canonical_chars"), F.length("s.text").alias("search_chars"), to_source(F.col("c.runs"), F.length("c.text")).alias("source_end"), F.sha2("s.text", 256).alias("normalized_sha256"))


@query("scoring_text")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "evaluation_items").select("evaluation_item_id", normalize_for_scoring("query_text").alias("text"))


@query("chunk_documents")
def _(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_documents(table(spark, d, "documents")).drop("text")


@query("table_chunks")
def _(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_documents(table(spark, d, "documents")).where("kind = 'table'").select("doc_id", "ordinal", "units", "prefix_chars")


def _bm25(terms: str, where: str = "") -> str:
    return f"""
WITH t AS (SELECT doc_id, {_W} AS w FROM documents WHERE text IS NOT NULL), st AS (SELECT count(*) AS n, avg(len(w)) AS a FROM t),
p AS (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM t), q AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM p WHERE term IN ({terms}) GROUP BY doc_id, term),
f AS (SELECT term, count(*) AS df FROM q GROUP BY term),
s AS (SELECT doc_id AS id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / a))) AS score, count(*) AS matched FROM q JOIN f USING (term), st {where} GROUP BY doc_id)"""


@query("bm25_search", _bm25("'seed', 'drill', 'annotation'") + " SELECT id, round(score, 6) AS score, matched FROM s ORDER BY round(s.score, 9) DESC, id LIMIT 20")
def _(spark: SparkSession, d: str) -> DataFrame:
    return lexical.search(table(spark, d, "documents"), lexical.Request("seed drill annotation", 20)).select("id", F.round("score", 6).alias("score"), "matched")


@query(
    "bm25_filtered_page",
    _bm25("'отчёт', 'служба'", "WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'rus')") + " SELECT id, round(score, 6) AS score, matched FROM s ORDER BY round(s.score, 9) DESC, id LIMIT 10 OFFSET 5",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return lexical.search(table(spark, d, "documents"), lexical.Request("отчёт служба", 10, 5, {"lang": "rus"})).select("id", F.round("score", 6).alias("score"), "matched")


@query("facet_counts", f"SELECT lang AS value, count(*) AS matched FROM documents WHERE list_contains({_W}, 'invoice') OR list_contains({_W}, 'ledger') GROUP BY lang ORDER BY matched DESC, value LIMIT 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return lexical.facets(docs, lexical.bm25(lexical.index_for(docs, ["invoice", "ledger"])), "lang")


@query("fuzzy_terms", f"WITH v AS (SELECT DISTINCT unnest({_W}) AS term FROM documents WHERE text IS NOT NULL) SELECT q AS wanted, term, levenshtein(term, q) AS distance FROM v, (VALUES ('anotation'), ('greenhose')) t(q) WHERE levenshtein(term, q) <= 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = table(spark, d, "documents").select(F.explode(F.array_distinct(words(F.col("text")))).alias("term")).distinct()
    return lexical.fuzzy_terms(vocabulary, ["anotation", "greenhose"], 2)


@query("staged_search")
def _(spark: SparkSession, d: str) -> DataFrame:
    stage, hits = lexical.staged(table(spark, d, "documents"), "ghjnjrjk", 10)  # "протокол" typed on the wrong layout
    return hits.withColumn("stage", F.lit(stage))


@query("snippets")
def _(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    hits = lexical.search(docs, lexical.Request("hay bale", 10))
    return docs.join(F.broadcast(hits), docs["doc_id"] == hits["id"]).select("doc_id", lexical.snippet(F.col("text"), ["hay", "bale"]).alias("snippet"))  # one page of hits


@query("identifier_lookup", "SELECT p_partkey, p_name, 0.0 AS score FROM part WHERE list_contains(string_split_regex(p_brand, '\\s+'), 'Brand#23') OR CAST(p_partkey AS VARCHAR) = 'Brand#23'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return lexical.lookup(table(spark, d, "part"), "Brand#23", "p_brand", "p_partkey").select("p_partkey", "p_name", "score")


@query("citations_resolved", "SELECT c.chunk_id, c.document_id, c.start_char, c.end_char FROM chunks c WHERE c.chunk_id IN (SELECT target_id FROM vector_rows WHERE target_kind = 'chunk')")
def _(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "vector_rows").where("target_kind = 'chunk'").select(F.col("target_id").alias("chunk_id"))
    return lexical.citations(hits, table(spark, d, "chunks"))[0].select("chunk_id", "document_id", "start_char", "end_char")


@query("citations_unresolved", "SELECT DISTINCT target_id AS chunk_id FROM vector_rows WHERE target_kind = 'document' AND target_id NOT IN (SELECT chunk_id FROM chunks)")
def _(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "vector_rows").where("target_kind = 'document' and target_id is not null").select(F.col("target_id").alias("chunk_id"))
    return lexical.citations(hits, table(spark, d, "chunks"))[1]


@query("lexical_rows", "SELECT c.chunk_id, c.document_id, d.language FROM chunks c LEFT JOIN (SELECT document_id, arg_max(language, loaded_at) AS language FROM (SELECT document_id, coalesce(language, '') AS language, loaded_at FROM document_records) GROUP BY document_id) d USING (document_id)")
def _(spark: SparkSession, d: str) -> DataFrame:
    newest = table(spark, d, "document_records").groupBy("document_id").agg(F.max_by(F.coalesce("language", F.lit("")), "loaded_at").alias("language"))
    return table(spark, d, "chunks").join(newest, "document_id", "left").select("chunk_id", "document_id", "language")


@query("vector_topk_l2", "SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)), 6) AS distance FROM embeddings ORDER BY distance, vec_id LIMIT 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vector.nearest(e, list(e.where("vec_id = 7").first().embedding), 10)


@query("vector_dimension_guard", "SELECT count(*) AS rows, min(len(embedding)) AS least, max(len(embedding)) AS greatest, count(DISTINCT len(embedding)) AS distinct, count(DISTINCT len(embedding)) > 1 AS mixed FROM embeddings WHERE embedding IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return vector.dimension_guard(table(spark, d, "embeddings"))


_NN = """
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 50 = 0),
r AS (SELECT query_id, e.vec_id AS id, round(list_distance(CAST(e.embedding AS DOUBLE[]), v), 6) AS distance FROM q, embeddings e),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM r)"""


@query("vector_nearest_of_queries", _NN + " SELECT query_id, rank, id, distance FROM n WHERE rank <= 5")
def _(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vector.nearest_of_queries(e, e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")))


@query(
    "vector_profile_violations",
    """SELECT DISTINCT v.embedding_id, v.profile_id, v.dimensions, m.dimensions AS want_dimensions FROM vector_rows v LEFT JOIN model_profiles m USING (profile_id)
WHERE m.dimensions IS NULL OR v.dimensions IS DISTINCT FROM m.dimensions OR v.model_digest IS DISTINCT FROM m.model_digest""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return vector.profile_violations(table(spark, d, "vector_rows"), table(spark, d, "model_profiles"))


def _hierarchy(spark: SparkSession, d: str) -> DataFrame:
    n, c = table(spark, d, "nation"), table(spark, d, "customer")
    return n.select(F.concat(F.lit("R"), "n_regionkey").alias("src"), F.concat(F.lit("N"), "n_nationkey").alias("dst")).union(c.select(F.concat(F.lit("N"), "c_nationkey"), F.concat(F.lit("C"), "c_custkey")))


_EDGES = "e AS (SELECT 'R' || n_regionkey AS src, 'N' || n_nationkey AS dst FROM nation UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey FROM customer)"


@query("graph_walk_bounded", f"WITH RECURSIVE {_EDGES}, w(depth, src, dst) AS (SELECT 1, src, dst FROM e WHERE src = 'R1' UNION ALL SELECT w.depth + 1, e.src, e.dst FROM w JOIN e ON w.dst = e.src WHERE w.depth < 3) SELECT depth, src, dst FROM w")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.bounded_walk(_hierarchy(spark, d), "R1", 3)


@query("graph_one_hop", f"WITH {_EDGES} SELECT src, dst FROM e WHERE src = 'R2'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.one_hop(_hierarchy(spark, d), "R2")


def _doubling(spark: SparkSession, d: str) -> DataFrame:
    """Each part leads to two others, numbers taken modulo one more than the greatest: every part is a vertex of its own."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("src"))
    n = (p.agg(F.max("src")).first()[0] or 0) + 1
    return p.select("src", (F.col("src") * 2 % n).alias("dst")).union(p.select("src", (F.col("src") * 3 % n).alias("dst"))).distinct()


_DOUBLE = "n AS (SELECT max(p_partkey) + 1 AS n FROM part), e AS (SELECT p_partkey AS src, p_partkey * 2 % n AS dst FROM part, n UNION SELECT p_partkey, p_partkey * 3 % n FROM part, n)"


@query("closure_reachability", f"WITH RECURSIVE {_DOUBLE}, r(id) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.dst FROM r JOIN e ON e.src = r.id) SELECT id FROM r")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.reachable(_doubling(spark, d), spark.createDataFrame([(5,)], "id long"))


# without SQL: a recursion over all pairs of vertices is too slow; tests compare with brute force
@query("cycle_core")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.cycle_core(_doubling(spark, d)).select(F.col("src").alias("vertex")).distinct()


@query("pagerank")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.pagerank(_hierarchy(spark, d)).select("id", F.round("rank", 9).alias("rank"))


@query("communities")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.label_communities(_hierarchy(spark, d))


@query(
    "connected_components",
    """WITH RECURSIVE m AS (SELECT DISTINCT 'g' || group_id AS a, 'd' || document_id AS b FROM duplicate_groups WHERE group_id IS NOT NULL AND document_id IS NOT NULL),
e AS (SELECT a, b FROM m UNION SELECT b, a FROM m), r(x, y) AS (SELECT a, a FROM e UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y)
SELECT x AS id, min(y) AS component FROM r GROUP BY x""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "duplicate_groups").select(F.concat(F.lit("g"), "group_id").alias("src"), F.concat(F.lit("d"), "document_id").alias("dst")).dropna().distinct()
    return connected_components(m.select(F.col("src").alias("id")).union(m.select("dst")), m)


@query(
    "class_closure",
    """WITH RECURSIVE p AS (SELECT 'N' || n_nationkey AS class_id, 'R' || n_regionkey AS parent_id FROM nation UNION ALL SELECT 'R' || r_regionkey, 'ALL' FROM region UNION ALL SELECT 'ALL', NULL),
c(class_id, ancestor) AS (SELECT class_id, class_id FROM p UNION SELECT c.class_id, p.parent_id FROM c JOIN p ON p.class_id = c.ancestor WHERE p.parent_id IS NOT NULL)
SELECT class_id, ancestor FROM c""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    p = n.select(F.concat(F.lit("N"), "n_nationkey").alias("class_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_id")).union(r.select(F.concat(F.lit("R"), "r_regionkey"), F.lit("ALL")))
    return graph.class_closure(p.union(spark.createDataFrame([("ALL", None)], "class_id string, parent_id string")))


@query("code_ancestors", "WITH c AS (SELECT DISTINCT replace(relative_path, '/', '.') AS code FROM document_path_events WHERE relative_path IS NOT NULL), p AS (SELECT code, string_split(code, '.') AS s FROM c) SELECT code, list_transform(range(1, len(s) + 1), lambda i: array_to_string(s[1:i], '.')) AS ancestors, len(s) AS depth FROM p")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "document_path_events").where("relative_path is not null").select(F.translate("relative_path", "/", ".").alias("code")).distinct()
    return graph.code_ancestors(c)


@query("graph_export", f"WITH {_EDGES} SELECT '<urn:archive:' || src || '> <urn:archive:linked> <urn:archive:' || dst || '> .' AS value FROM e")
def _(spark: SparkSession, d: str) -> DataFrame:
    return graph.exports(_hierarchy(spark, d))


@query("ranked_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(50).limit(25)


@query("strided_sample", "WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n FROM part) SELECT p_partkey FROM r WHERE i % greatest(1, n // 20) = 0 ORDER BY p_partkey LIMIT 20")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey").orderBy("p_partkey")
    step = max(1, p.count() // 20)
    # positions without a window over all rows: ids of one range partition are numbered from the rows before it
    ids = p.withColumn("part_no", F.spark_partition_id())
    from archivolt.session import cut

    ids = cut(ids)
    before = ids.groupBy("part_no").count().withColumn("before", F.sum("count").over(Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)))
    w = Window.partitionBy("part_no").orderBy("p_partkey")
    numbered = ids.join(F.broadcast(before.select("part_no", F.coalesce("before", F.lit(0)).alias("before"))), "part_no").withColumn("i", F.row_number().over(w) - 1 + F.col("before"))  # a row a partition
    return numbered.where(F.col("i") % step == 0).select("p_partkey").orderBy("p_partkey").limit(20)

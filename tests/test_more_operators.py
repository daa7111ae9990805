"""Operators of publication, governance, evaluation, planning and sources on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt import contracts
from archivolt.functions import text
from archivolt.operators import changes, chunking, classify, dedupe, evaluation, evidence, graph, lexical, quality, rules, vector
from archivolt.plans import publish as pub
from archivolt.session import cut
from archivolt.sources import files


def test_changed_source_is_made_anew(spark, tmp_path):
    data = {"rows": [(1, "a")]}

    def source():
        return spark.createDataFrame(data["rows"], "k int, v string")

    plan = pub.Plan([pub.Stage("a", (), source, inputs=lambda: [pub.content_digest(source())]), pub.Stage("b", ("a",), lambda a: a)])
    keys = {"a": ["k"], "b": ["k"]}
    assert plan.execute(spark, str(tmp_path), keys, {}) == {"a": "made", "b": "made"}
    assert plan.execute(spark, str(tmp_path), keys, {}) == {"a": "reused", "b": "reused"}
    data["rows"] = [(1, "changed")]
    assert plan.execute(spark, str(tmp_path), keys, {}) == {"a": "made", "b": "made"}


def test_failed_publication_keeps_the_old(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "set")
    pub.publish(d, path, ["k"], partition="v")
    with pytest.raises(ValueError):
        pub.publish(d.union(d), path, ["k"])
    assert pub.read_published(spark, path).count() == 2
    m = pub.publish(d.where("k = 1"), path, ["k"])
    assert pub.read_published(spark, path).count() == 1 and len([x for x in (tmp_path / "set").iterdir() if x.name.startswith("data-")]) == 1 and m["rows"] == 1
    kb = {r.family: r.status for r in pub.knowledge_base(spark, {"a": path, "b": str(tmp_path / "none")}, {"a": 2}).collect()}
    assert kb == {"a": "partial", "b": "missing"}
    with pytest.raises(ValueError):
        pub.advance("superseded", "running")
    assert pub.advance("planned", "running") == "running" and pub.retry_class("FetchFailed") == "transient"
    one = pub.publish_bundle(str(tmp_path / "b"), {"k": 1}, [{"id": "x"}])
    assert pub.publish_bundle(str(tmp_path / "b"), {"k": 1}, [{"id": "x"}]) == one
    with open(f"{one}/scores.jsonl", "a") as f:
        f.write("{}")
    with pytest.raises(ValueError):
        pub.verify_bundle(one)


def test_decisions_mind_branches(spark):
    s = spark.createDataFrame([("d", "child", 0.9, 3), ("d", "parent", 0.88, 2), ("d", "other", 0.5, 2), ("e", "child", 0.9, 1), ("f", "child", 0.6, 2), ("f", "other", 0.55, 2)], "doc_id string, class_id string, score double, matched int")
    tree = spark.createDataFrame([("parent", ["parent"]), ("child", ["parent", "child"]), ("other", ["other"])], "class_id string, path array<string>")
    got = {r.doc_id: (r.primary_class_id, r.alternates) for r in classify.decide(s, tree).collect()}
    # the parent is no competitor of its child; one matched word isn't enough; a rival off the branch is
    assert got == {"d": ("child", ["other"]), "e": ("unclassified", []), "f": ("unclassified", ["other"])}


def test_query_plans():
    assert lexical.transliterated("khleb i chasy") == "хлеб и часы" and lexical.transliterated("shchuka") == "щука"
    assert "синий цветок" in lexical.transliterations("siniy tsvetok") and lexical.transliterations("eto") == ["ето", "это"]
    assert lexical.homoglyphs("АB-1234X") == "АB-1234X" or "AB" in lexical.homoglyphs("АB1234X")
    assert lexical.query_plan('field:"x y"') == {"primary": ['field:"x y"'], "fallback": [], "fuzzy": []}
    assert lexical.query_plan("рынок", lexical.PROFILES["guarded"])["primary"] == ["рынок", "рынка"] and lexical.query_plan("abc", "literal")["fallback"] == []
    assert lexical.fold("«Ёлка!»") == "елка" and lexical.has_syntax("a +b") and not lexical.has_syntax("a b")


def test_fuzzy_stage_needs_all_words(spark):
    d = spark.createDataFrame([(1, "orchard rows here"), (2, "seeds only there"), (3, "orchard with seeds")], "doc_id int, text string")
    stage, hits = lexical.staged(d, "orchrd seedz", profile=lexical.PlanProfile(fallback=False))
    assert stage == "fuzzy" and [r.id for r in hits.collect()] == [3]


def test_snippets_fit(spark):
    d = spark.createDataFrame([("hay " * 200,)], "t string")
    s = d.select(lexical.snippet(F.col("t"), ["hay"], 60).alias("s")).first().s
    assert len(s) <= 60 and s.startswith("[[hay]]")


def test_chunks_in_original_offsets(spark):
    t = "# Title\r\n\r\nCafe\u0301 one.\u00a0Two is here.\r\n\r\nLast\u200b words end."
    rows = chunking.chunk_originals(spark.createDataFrame([(1, t), (2, ""), (3, None)], "doc_id int, text string")).collect()
    assert [t[r.start_char : r.end_char] for r in rows] == ["Cafe\u0301 one.\u00a0Two is here.", "Last\u200b words end."] and all(r.error is None for r in rows)
    n = {r.doc_id: r.error for r in chunking.normalize(spark.createDataFrame([(1, t), (2, " "), (3, None), (4, "\u200b")], "doc_id int, text string")).collect()}
    assert n == {1: None, 2: "empty", 3: "no-text", 4: "empty"}


def test_editions_and_sketches(spark):
    links = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.6), (4, 5, 0.95)], "left int, right int, score double")
    groups = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h")], "id int, group_id string")
    assert sorted((r.left, r.right) for r in dedupe.editions(links, groups).collect()) == [(1, 3), (4, 5)]
    assert {r.method for r in dedupe.audit(links).collect()} == {"edition", "lexical"}
    d = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "short"), (3, None)], "doc_id int, text string")
    s = {r.id: r for r in dedupe.sketches(d).collect()}
    assert len(s[1].signature) == 128 and len(s[1].bands) == 64 and s[2].bands == [] and 3 not in s


def test_rules_of_contracts(spark):
    c = contracts.Contract("t", (contracts.Field("k", "string", primary=True), contracts.Field("n", "number", precision=10, scale=2)), partition=None)
    d = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int").withColumn("n", F.col("n").cast("decimal(18,4)")).withColumn("more", F.lit(1))
    got = {r.rule_id: r.status for r in quality.run_contract(d, c, min_rows=5).collect()}
    assert got["t.k.not_null"] == got["t.unique"] == got["t.min_rows"] == "fail" and got["t.n.type"] == "pass" and got["t.extra_columns"] == "warning"
    f = spark.createDataFrame([("a", "s", "d")], "rule_id string, subject string, detail string")
    assert {r.rule_id: r.status for r in quality.findings_as_results(f, ["a", "b"], ("shacl",)).collect()} == {"a": "fail", "b": "pass", "shacl": "not-run"}
    b = spark.createDataFrame([("r", 1, 2, 1, "fail", ["x"]), ("r", 2, 3, 0, "pass", [])], "rule_id string, batch int, checked long, failed long, status string, samples array<string>")
    assert tuple(quality.merge_results(b).first()) == ("r", 5, 1, "fail", ["x"])


def test_governance(spark, tmp_path):
    assert contracts.projection_change({"columns": ["a"], "filter": None, "keys": ["a"]}, {"columns": ["a", "b"], "filter": None, "keys": ["a"]}) == "additive"
    assert contracts.merged_change("additive", "semantic") == "semantic"
    w = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    r = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("c", T.StringType(), False), T.StructField("b", T.DateType())])
    assert contracts.reader_problems(w, w) == [] and len(contracts.reader_problems(w, r)) == 3
    assert rules.evolution({"a": {"kind": "class"}}, {"a": {"kind": "class"}, "b": {}}) == ("additive", ["added b"])
    (tmp_path / "v.jsonl").write_text("\n".join(json.dumps(x) for x in ({"id": "C", "kind": "class"}, {"id": "p", "kind": "predicate", "domain": "C"})))
    classes, predicates = rules.load_vocabulary(spark, str(tmp_path / "v.jsonl"))
    assert classes.count() == 1 and predicates.first().status == "active"
    assert spark.range(1).select(rules.predicate_key(F.lit("partOfWhole")).alias("k")).first().k == "pred.part-of-whole"


def test_evaluation_protocol():
    rows = [{"id": "1", "cohort": "x", "query": "a"}, {"id": "2", "cohort": "x", "query": "b"}]
    assert evaluation.load_split(rows, evaluation.split_fingerprint(rows), {"x": 2}) == rows
    with pytest.raises(ValueError):
        evaluation.load_split(rows, "other", {})
    passed = evaluation.gates({"recall": 0.9}, {"recall": ("at least", 0.8), "forbidden": ("at most", 0)})
    assert passed == {"recall": True, "forbidden": False} and evaluation.verdict({"verdict": "adopt"}, passed) == "retain"
    assert evaluation.protocol(["a", "b"], ["1"], 2) == evaluation.protocol(["b", "a"], ["1"], 2) and evaluation.seed_sensitivity(["adopt", "retain"])


def test_retraction_and_evidence(spark):
    d = spark.createDataFrame([("h1", None, ["h2"]), ("h2", None, []), ("h3", "merged", []), ("h4", None, [])], "content_hash string, review_state string, shared_with array<string>")
    o = spark.createDataFrame([("s", "p1", "h1"), ("s", "p2", "h2"), ("s", "p4", "h4")], "silo string, path string, content_hash string")
    gone = spark.createDataFrame([("s", "p1"), ("s", "p4")], "silo string, path string")
    assert sorted(r.content_hash for r in changes.active_view(d, o, gone).collect()) == ["h1", "h2", "h3"]
    e = spark.createDataFrame([("s", "p", "h"), ("t", "q", "h")], "silo string, path string, content_hash string")
    assert {r.path: r.status for r in evidence.location_status(e, spark.createDataFrame([("s", "x", "h")], e.schema)).collect()} == {"p": "missing", "q": "unchecked"}


def test_graph_ends_and_escapes(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x&", "y<z")], "src string, dst string")
    assert {r.id: r.community for r in graph.label_communities(e).collect()}["a"] in ("a", "b", "c")
    lines = [r.value for r in graph.exports(e.where("src = 'x&'"), "graphml").collect()] + [r.value for r in graph.exports(e.where("src = 'x&'")).collect()]
    assert lines == ['<edge source="x&amp;" target="y&lt;z"/>', "<urn:archive:x%26> <urn:archive:linked> <urn:archive:y%3Cz> ."]
    same = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, community string")
    assert tuple(graph.agreement(same, same.withColumn("community", F.concat("community", F.lit("!")))).first())[1:] == (1.0, 1.0)
    assert graph.bounded_walk(e, "it's", 2).count() == 0 and graph.bounded_walk(e, "a", 4).count() == 4


def test_extraction_and_embedding(spark, tmp_path):
    f = spark.createDataFrame([("t", "text/plain", bytearray("Привет".encode("cp1251"))), ("h", "text/html", bytearray(b"<p>Hi</p>")), ("i", "image/png", bytearray(b"\x89"))], "document_id string, media_type string, content binary")
    got = {r.document_id: (r.kind, r.text) for r in files.extract(f).collect()}
    assert got == {"t": ("text", "Привет"), "h": ("text", "Hi"), "i": ("error", None)}
    e = vector.embed(spark.createDataFrame([("a b",), (" ",), (None,)], "text string")).collect()
    assert [r.status for r in e] == ["ok", "empty", "empty"] and abs(sum(x * x for x in e[0].embedding) - 1) < 1e-9
    w = spark.createDataFrame([("The Red, und red",), (None,)], "t string").select(text.word_spans("t").alias("w")).collect()
    assert [(x.word, x.start, x.end) for x in w[0].w] == [("red", 4, 7), ("red", 13, 16)] and w[1].w is None
    assert spark.createDataFrame([("password=abc x",)], "t string").select(text.redact_text("t").alias("r")).first().r == "password=<redacted> x"
    (tmp_path / "one" / "two").mkdir(parents=True)
    (tmp_path / "one" / "two" / "f.txt").write_text("x")
    assert [(r.relative_path, r.status) for r in files.walk_frame(spark, str(tmp_path), "s").collect()] == [("one/two/f.txt", "file")]


@pytest.mark.parametrize("block", [graph.BLOCK, 16])
def test_reachable_follows_long_paths_in_few_rounds(spark, monkeypatch, block):
    cuts = []
    monkeypatch.setattr(graph, "cut", lambda df: cuts.append(1) or cut(df))
    chain = [(k, k + 1) for k in range(40)] + [(40, 3), (50, 51), (51, 7)]
    e = spark.createDataFrame(chain + [(1, 2), (None, 60), (5, None)], "src long, dst long")
    got = graph.reachable(e, spark.createDataFrame([(2,), (70,), (None,)], "id long"), block=block)
    assert sorted(r.id for r in got.collect()) == [*range(2, 41), 70]
    assert len(cuts) < 5 if block > 16 else len(cuts) > 5
    names = e.select(F.concat(F.lit("v"), "src").alias("src"), F.concat(F.lit("v"), "dst").alias("dst"))
    got = graph.reachable(names, spark.createDataFrame([("v50",)], "id string"), block=8 * block)
    assert sorted(r.id for r in got.collect()) == sorted(["v50", "v51", *(f"v{k}" for k in range(3, 41))])


def test_shingles_of_one_text_are_not_posted(spark, monkeypatch):
    posted = []

    def kept(df):
        out = cut(df)
        posted.extend([out.count()] if "gram" in out.columns else [])
        return out

    monkeypatch.setattr(dedupe, "cut", kept)
    texts = spark.range(30).select("id", F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda i: F.xxhash64(F.when(i <= 100, i).otherwise(i + F.col("id") * 100_000))).alias("grams"))
    twin = texts.where("id = 3").select(F.lit(99).cast("long").alias("id"), F.slice("grams", 2, 39_999).alias("grams"))
    links = dedupe.near_links(texts.union(twin), least=0.45).select("left", "right", F.round("score", 6))
    assert [tuple(r) for r in links.collect()] == [(3, 99, 0.999975)]
    assert 0 < posted[0] < 0.1 * 31 * 40_000

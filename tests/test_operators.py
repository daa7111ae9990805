import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from archivolt import contracts as c
from archivolt.operators import changes, chunking, classify, dedupe, evidence, graph, lexical, metrics, quality, rules, vector
from archivolt.operators.components import connected_components
from archivolt.plans import publish as pub
from archivolt.sources import files
from archivolt.streaming import windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_components_chain_star_and_alone(spark):
    v = spark.createDataFrame([(i,) for i in range(1, 31)], "id long")
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(25, 22), (22, 25), (24, 24), (None, 3)], "src long, dst long")
    got = dict(rows(connected_components(v, e)))
    assert all(got[i] == 1 for i in range(1, 21)) and got[25] == 22 and got[24] == 24 and got[30] == 30
    assert connected_components(v.limit(0), e.limit(0)).count() == 0


def test_near_duplicates_find_every_class(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30", "x30")
    texts = [(1, base), (2, base.upper()), (3, near), (4, " ".join(f"z{i}" for i in range(60))), (5, None), (6, ""), (7, "one two"), (8, "one two")]
    got = {r.id: r for r in dedupe.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].class_id == got[2].class_id == got[3].class_id == 1 and got[1].links == 1
    assert got[4].class_id == 4 and got[5].class_id == 5 and got[7].class_id == got[8].class_id == 7
    # brute force over the distinct texts
    def grams(s):
        w = s.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    a, b = grams(base), grams(near)
    assert len(a & b) / len(a | b) >= 0.8


def test_chunks_keep_offsets_and_headers():
    text = "# One\n\n" + "A first sentence here. " * 120 + "\n\na | b\n--- | ---\n" + "\n".join(f"row {i} | {i}" for i in range(200)) + "\n\n2.1 Two\nMore prose."
    got, error = chunking.chunk_text(text)
    assert error is None and all(text[r[3] : r[4]] == r[2] for r in got if r[1] == "text")
    tables = [r for r in got if r[1] == "table"]
    assert len(tables) > 1 and all(r[2].startswith("a | b\n") for r in tables) and got[-1][9] == ["One", "2.1 Two"]
    assert chunking.chunk_text("# Only\n\n## Headings") == ([], "no-chunks") and chunking.chunk_text("  ") == ([], None)
    assert max(r[4] - r[3] for r in chunking.chunk_text("x" * 6000 + " end.")[0]) <= 2400


def test_bm25_by_hand(spark):
    d = spark.createDataFrame([(1, "a b"), (2, "a a c d"), (3, "e"), (4, None)], "doc_id long, text string")
    got = {r.id: r.score for r in lexical.bm25(lexical.index_for(d, ["a"])).collect()}
    import math

    idf, mean = math.log(1 + 1.5 / 2.5), 7 / 3
    assert abs(got[1] - idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / mean))) < 1e-9 and set(got) == {1, 2}
    with pytest.raises(ValueError):
        lexical.Request(" ")
    assert lexical.query_plan("ghbdtn")["fallback"][0] == "привет" and lexical.transliterated("shchuka") == "щука"


def test_quality(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "y"), (None, 4, "zzz")], "k string, n int, v string")
    r = {x.rule_id: x for x in quality.row_checks(d, [quality.Rule("null", "not_null", "k"), quality.Rule("len", "max_length", "v", 2)]).collect()}
    assert r["null"].failed == 2 and r["len"].failed == 1
    assert quality.snapshot_unique(d, ["k"]).first().failed == 2
    assert quality.relationship(d, "k", None, "k").first().status == "not-run"
    assert quality.relationship(d, "k", d.limit(0), "k").first().failed == 2
    assert quality.row_checks(d.limit(0), [quality.Rule("null", "not_null", "k")]).first().status == "not-applicable"
    assert not quality.publishable(quality.row_checks(d, [quality.Rule("len", "max_length", "v", 9)]), ["len", "other"]).first().publishable


def test_diff_and_overlay(spark):
    old = spark.createDataFrame([("s", "a", "1"), ("s", "b", "2"), ("s", "c", "3"), ("t", "d", "4")], "silo string, path string, content_hash string")
    new = spark.createDataFrame([("s", "a", "9"), ("s", "x", "2"), ("t", "c", "3")], "silo string, path string, content_hash string")
    got = rows(changes.manifest_diff(old, new, spark.createDataFrame([("s",)], "silo string")).select("kind", "path"))
    assert got == [("add", "c"), ("content-change", "a"), ("path-rename", "x"), ("remove", "c"), ("withheld", "d")]
    e = spark.createDataFrame([("e1", "d", "o", 1, "initial", "p", None), ("e2", "d", "o", 2, "rename", "q", "p"), ("e3", "d", "o", 3, "rename", "r", "nope"), ("e1", "d", "o", 1, "initial", "p", None)], "event_id string, document_id string, occurrence_id string, event_time int, kind string, relative_path string, previous_relative_path string")
    r = changes.path_overlay(e).first()
    assert (r.relative_path, r.events, r.consistent) == ("q", 3, False)


def test_not_in_null_semantics(spark):
    d = spark.createDataFrame([("a",), ("b",), (None,)], "h string")
    assert rows(changes.not_in(d, "h", spark.createDataFrame([("a",)], "h string"), "h")) == [("b",)]
    assert rows(changes.not_in(d, "h", spark.createDataFrame([("a",), (None,)], "h string"), "h")) == []


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 5)], "src long, dst long")
    assert graph.bounded_walk(e, 1, 4).count() == 5
    assert rows(graph.reachable(e, spark.createDataFrame([(2,)], "id long"))) == [(1,), (2,), (3,), (4,)]
    assert rows(graph.cycle_core(e)) == [(1, 2), (2, 3), (3, 1), (5, 5)]
    assert abs(sum(r.rank for r in graph.pagerank(e, 5).collect()) - 1) < 1e-9


def test_metrics(spark):
    ranked = spark.createDataFrame([("q", 1, "a"), ("q", 2, "b"), ("n", 1, "z")], "query_id string, rank int, id string")
    gold = spark.createDataFrame([("q", "b"), ("q", "c"), ("m", "x")], "query_id string, id string")
    r = {x.query_id: x for x in metrics.retrieval(ranked, gold).collect()}
    assert r["q"].recall == 0.5 and r["q"].mrr == 0.5 and r["n"].ndcg == 0.0 and r["m"].precision == 1.0
    assert metrics.sign_test(6, 0) == 0.03125 and metrics.sign_test(0, 0) == 1.0
    s = spark.createDataFrame([("d", 0, 5), ("d", 3, 8), ("d", 10, 12), ("d", 4, 4)], "k string, start_char int, end_char int")
    assert metrics.covered_length(s, ["k"]).first().covered == 10
    assert metrics.bootstrap([1.0, 1.0, 1.0]) == (1.0, 1.0)


def test_rules_and_classes(spark):
    types = spark.createDataFrame([("o", "cat"), ("o", "rock")], "object_id string, class_id string")
    closure = graph.class_closure(spark.createDataFrame([("cat", "animal"), ("rock", "thing"), ("animal", None), ("thing", None)], "class_id string, parent_id string"))
    assert rules.disjoint_types(types, closure, spark.createDataFrame([("animal", "thing")], "a string, b string")).count() == 1
    f = spark.createDataFrame([("f", "p", "o", "x")], "fact_id string, predicate_id string, subject string, object string")
    p = spark.createDataFrame([("p", "plant", "xsd:string")], "predicate_id string, domain string, range string")
    assert rows(rules.domain_range(f, types, p, closure)) == [("domain", "f", "o")]
    assert rows(classify.stratified_split(spark.createDataFrame([(i, "s") for i in range(10)], "k int, g string"), "k", "g").groupBy("split").count()) == [("dev", 2), ("test", 2), ("train", 6)]


def test_vectors(spark):
    d = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)] + [(99, None)], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(3, [3.0, 0.0])], "query_id long, query array<float>")
    assert [r.id for r in vector.nearest_of_queries(d, q, 3).orderBy("rank").collect()] == [3, 2, 4]
    assert vector.dimension_guard(d).first().mixed is False


def test_contracts(spark):
    a = c.Contract("t", (c.Field("id", "string", True, primary=True), c.Field("n", "number")))
    b = c.Contract("t", (*a.fields, c.Field("x", "integer")))
    assert c.field_change(a, b) == "additive" and c.field_change(b, a) == "breaking" and c.field_change(a, a) == "identical"
    assert c.version_allowed("1.0.0", "1.1.0", "additive") and not c.version_allowed("1.0.0", "1.0.1", "additive")
    assert a.schema().simpleString() == "struct<id:string,n:decimal(38,9),bucket:string>"
    assert c.integrity([c.Contract("u", (c.Field("k", "string", references=("none", "id")),))]) == ["u: no primary key", "u.k: no such target none.id"]
    assert quality.conforms(a.align(spark.createDataFrame([("1",)], "id string")), a.schema()) == []


def test_archives_and_scan(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "x")
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.txt", "hello")
        z.writestr("../evil", "no")
        z.writestr("in.zip", inner.getvalue())
    got = {json.loads(m[0])[-1][1]: m[4] for m in files.members(outer.getvalue())}
    assert got == {"a.txt": None, "../evil": "unsafe-path", "in.zip": None, "deep.txt": None}
    assert [m[4] for m in files.members(b"PK\x03\x04junk")] == ["unreadable-archive"]
    (tmp_path / "one.txt").write_bytes("текст".encode("cp1251"))
    (tmp_path / "two.pdf").write_bytes(b"%PDF-1.4 /Encrypt")
    (tmp_path / "link").symlink_to(tmp_path / "one.txt")
    assert sorted((r[0], r[1]) for r in files.walk(str(tmp_path))) == [("link", "link"), ("one.txt", "file"), ("two.pdf", "file")]
    s = {r.relative_path: r for r in files.scan(spark, str(tmp_path), "s").collect() if r.relative_path != "link"}
    assert s["two.pdf"].quarantine_reason == "encrypted" and s["one.txt"].media_type == "text/plain"
    assert files.charset_of("текст".encode("cp1251")) == "cp1251" and files.charset_of(b"\x00\x01") is None
    page = spark.createDataFrame([("<p>One&amp;</p><script>x</script>two",)], "h string")
    assert page.select(files.html_text("h")).first()[0] == "One&\ntwo"


def test_publish_and_plan(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "set")
    m = pub.publish(d, path, ["k"])
    assert m["rows"] == 2 and pub.read_published(spark, path).count() == 2
    with pytest.raises(ValueError):
        pub.publish(d.union(d), str(tmp_path / "bad"), ["k"])
    assert not (tmp_path / "bad").exists()
    with pytest.raises(ValueError):
        pub.activate(str(tmp_path), "lexical", "p1", False)
    assert pub.activate(str(tmp_path), "lexical", "p1", True) == {"active": "p1", "previous": None}
    plan = pub.Plan([pub.Stage("b", ("a",), lambda a: a.where("k = 1")), pub.Stage("a", (), lambda: d)])
    keys = {"a": ["k"], "b": ["k"]}
    assert plan.order == ["a", "b"] and plan.descendants("a") == {"b"}
    assert plan.execute(spark, str(tmp_path / "run"), keys, {}) == {"a": "made", "b": "made"}
    assert plan.execute(spark, str(tmp_path / "run"), keys, {"b": "2"}) == {"a": "reused", "b": "made"}


def test_streams_equal_batches(spark, tmp_path):
    d = spark.sql("select id as event_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as ts, 'x' as event_type, double(id) as value, id % 2 as user_id from range(50)")
    d.write.parquet(str(tmp_path / "e"))
    s = windows.to_memory(windows.tumbling(windows.read_events(spark, str(tmp_path / "e"))), "tumbling_test")
    assert rows(s) == rows(windows.tumbling(d))
    assert windows.sessions(d, gap="30 minutes").count() == 50


def test_evidence(spark):
    chunks = spark.createDataFrame([("d", "c1", 0, 10), ("d", "c2", 8, 20)], "document_id string, chunk_id string, start_char int, end_char int")
    spans = spark.createDataFrame([("s", "d", 5, 9)], "span_id string, document_id string, start_char int, end_char int")
    assert rows(evidence.spans_in_chunks(spans, chunks)) == [("s", "c1", 4, True), ("s", "c2", 1, False)]
    assert F is not None


def test_query_filter(spark):
    d = spark.createDataFrame([(1, ["red", "hay", "bale"], "a"), (2, ["hay", "cart"], "b"), (3, [], "a"), (4, None, "a")], "i int, w array<string>, f string")

    def hits(q):
        return [r.i for r in d.where(lexical.query_filter(q, F.col("w"), {"f": F.col("f")})).orderBy("i").collect()]

    assert hits('"hay bale"') == [1] and hits("hay AND NOT red") == [2] and hits("ca* OR red") == [1, 2] and hits("hay AND (f:b OR bale)") == [1, 2] and hits("red cart") == [1, 2]
    for bad in ("(a", "a)", "AND a", "x:y", "a AND"):
        with pytest.raises(ValueError):
            hits(bad)
    assert lexical.expand_aliases("buy IT now", {"it": ["information technology"]}) == ["buy IT now", 'buy "information technology" now']
    assert lexical.expand_aliases("buy it now", {"it": ["x"]}) == ["buy it now"]


def test_item_scores(spark):
    from archivolt.operators import scores

    d = spark.createDataFrame([(["a", "a", "b"], ["a", "b", "b"]), ([], [])], "g array<string>, p array<string>")
    assert [tuple(r) for r in d.select(F.round(scores.bag_f1(F.col("g"), F.col("p")), 4), scores.set_f1(F.col("g"), F.col("p"))).collect()] == [(0.6667, 1.0), (1.0, 1.0)]
    assert scores.finite(spark.createDataFrame([(1.0, float("nan"))], "x double, y double"), ["x", "y"]).orderBy("column").collect()[1].bad == 1
    assert scores.zipf_filler(spark, 3, 5, 100).collect() == scores.zipf_filler(spark, 3, 5, 100).collect()
    assert scores.reciprocal_links(spark.createDataFrame([(1, 1, 2), (2, 1, 1), (3, 1, 1)], "query_id int, rank int, id int"), 1).collect()[0].right == 2


def test_inspection(spark, tmp_path):
    from archivolt.plans import inspect as ins

    d = spark.createDataFrame([("a", 1, "g1"), ("b", None, "g1")], "id string, n long, generation_id string")
    assert ins.same_content(d, d.withColumn("generation_id", F.lit("g2")).orderBy(F.desc("id"))) and not ins.same_content(d, d.limit(1))
    d.write.parquet(str(tmp_path / "t"))
    contract = c.Contract("t", (c.Field("id", "string", True, primary=True), c.Field("n", "integer"), c.Field("generation_id", "string")), partition=None)
    seen = ins.inspect_dataset(spark, str(tmp_path / "t"), contract)
    assert seen["rows"] == 2 and seen["state"] == "matching" and ins.inspect_dataset(spark, str(tmp_path / "t"))["state"] == "unregistered"
    assert ins.contract_files(contract)["t.ddl"] == "id string NOT NULL,\nn bigint,\ngeneration_id string\n"
    now = [0.0]
    p = ins.Progress(100, [ins.jsonl_sink(str(tmp_path / "log"))], clock=lambda: now[0])
    assert p.update(1) is None
    now[0] = 10.0
    assert p.update(50)["left_s"] == 10.0
    now[0] = 200.0
    assert p.update(50)["state"] == "stalled" and p.update(100)["state"] == "finished"


def test_review_overlays(spark):
    d = spark.createDataFrame([("o1", "open"), ("o2", "open"), ("o3", "open")], "object_id string, review_state string")
    k = spark.createDataFrame([("o1", "split", None, 1), ("o1", "merge", "o2", 2), ("o3", "split", None, 1)], "object_id string, action string, target_id string, decided_at int")
    assert rows(changes.merge_review(d, k)) == [("o1", "merged", "o2"), ("o2", "open", "o2"), ("o3", "split", "o3")]
    m = spark.createDataFrame([("add", "h1"), ("path-rename", "h1"), ("path-rename", "h2"), ("remove", "h3")], "kind string, content_hash string")
    assert rows(changes.affected_hashes(m)) == [("h1", "affected"), ("h2", "renamed")]


def test_near_duplicates_against_brute_force(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    texts = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.where("text is not null").collect()}
    import re

    def grams(t):
        w = re.findall(r"[^\W_]+", t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    distinct = {}
    for k, t in sorted(texts.items()):
        distinct.setdefault(t, k)
    sets = {k: grams(t) for t, k in distinct.items()}
    got = {r.id: r for r in dedupe.near_duplicates(docs).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a]) >= 5 and len(sets[b]) >= 5 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert all(got[a].class_id == got[b].class_id for a, b in want)
    assert all(got[k].class_id == got[distinct[t]].class_id for k, t in texts.items())
    linked = {x for p in want for x in p}
    assert all(got[k].class_id == k or k in linked for k in sets)


def test_batch_search_equals_single(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, "a a c d"), (3, "e"), (4, None), (5, "")], "doc_id long, text string")
    cases = spark.createDataFrame([("x", "a c"), ("y", "e"), ("z", "nothing"), ("n", None)], "query_id string, query string")
    got = lexical.batch_search(d, cases).orderBy("query_id", "rank").collect()
    one = lexical.search(d, lexical.Request("a c")).collect()
    assert [(r.id, r.score) for r in got if r.query_id == "x"] == [(r.id, round(r.score, 6)) for r in one] and {r.query_id for r in got} == {"x", "y"}
    best = lexical.calibrate(d, cases, spark.createDataFrame([("x", 2), ("y", 3)], "query_id string, id long"), [(1.2, 0.75), (0.1, 0.0)])
    assert best.count() == 2 and lexical.fleeting_vowel("рынок") == "рынка" and lexical.fleeting_vowel("дом") is None


def test_near_links_against_brute_force(spark):
    # two texts that resemble the smallest id by half and each other much more; few shingles; a large cluster
    def cluster(base, tag, other):
        return [base, base[:20] + [f"{tag}{i}" for i in range(8)], base[:20] + [f"{tag}{i}" for i in range(7)] + [other]]

    sets = {}
    for c in range(3):
        for k, grams in enumerate(cluster([f"{c}w{i}" for i in range(28)], f"{c}x", f"{c}y")):
            sets[10 * c + k] = grams
    sets |= {100 + k: [f"big{i}" for i in range(30) if i % 15 != k] for k in range(15)} | {200: ["s"], 201: ["s"], 202: ["s", "t"], 203: list("stuvw"), 204: list("stuv")}
    df = spark.createDataFrame(list(sets.items()), "id long, g array<string>").select("id", F.transform("g", lambda g: F.xxhash64(g)).alias("grams"))
    for least in (0.8, 0.45):
        want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a < b}
        want = {p: round(s, 9) for p, s in want.items() if s >= least}
        assert {(r.left, r.right): round(r.score, 9) for r in dedupe.near_links(df, least=least).collect()} == want


def test_paired_verdict_takes_every_case(spark, smoke_dir):
    from archivolt import queries as q

    events = spark.read.parquet(f"{smoke_dir}/events.parquet").where("value is not null")
    got = q.queries()["paired_verdict"](spark, smoke_dir).first()
    assert got.wins + got.losses + got.ties == events.count()
    # many cases: the interval of the normal law, however they are partitioned
    pairs = spark.range(4000).select((F.col("id") % 7).cast("double").alias("candidate"), F.lit(2.9).alias("baseline"))
    v, w = metrics.paired_verdict(pairs), metrics.paired_verdict(pairs.repartition(7))
    assert v["wins"] + v["losses"] == 4000 and abs(v["low"] - w["low"]) < 1e-9
    mean, error = sum(k % 7 - 2.9 for k in range(4000)) / 4000, 2.0 / 4000**0.5
    assert abs(v["low"] - (mean - 1.96 * error)) < 0.2 * error and abs(v["high"] - (mean + 1.96 * error)) < 0.2 * error
    import math

    assert math.isclose(metrics.sign_test(560, 480), 2 * sum(math.comb(1040, i) for i in range(481)) / 2**1040, rel_tol=1e-9)


def test_reciprocal_links_rank_among_all_rows(spark, smoke_dir):
    import numpy as np

    from archivolt import queries as q

    e = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{smoke_dir}/embeddings.parquet").collect()}
    first = {a: sorted(e, key=lambda b: (round(float(np.linalg.norm(e[a] - e[b])), 6), b))[:4] for a in e}
    want = {(a, b) for a in e for b in first[a] if a < b and a in first[b]}
    assert {(r.left, r.right) for r in q.queries()["reciprocal_links"](spark, smoke_dir).collect()} == want


def test_whole_graphs_against_brute_force(spark, tmp_path):
    from archivolt import queries as q

    keys = [k for k in range(1, 1301) if k % 5]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    edges = {(k, k * m % 1300) for k in keys for m in (2, 3)}
    seen, todo = {5}, [5]
    out: dict = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    while todo:
        new = [b for b in out.get(todo.pop(), []) if b not in seen]
        seen.update(new)
        todo += new
    assert {r.id for r in q.queries()["closure_reachability"](spark, str(tmp_path)).collect()} == seen
    core = edges
    while True:
        heads, tails = {y for _, y in core}, {x for x, _ in core}
        left = {(a, b) for a, b in core if a in heads and b in tails}
        if left == core:
            break
        core = left
    got = {r.vertex for r in q.queries()["cycle_core"](spark, str(tmp_path)).collect()}
    assert got == {a for a, _ in core} and max(got) > 1009

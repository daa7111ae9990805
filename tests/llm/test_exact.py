"""Operators whose results can be compared with brute force or an exact invariant."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from archivolt.llm import golden, names, neighbours, packing, pieces


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab. ,\n\tё😀", max_size=400), st.integers(5, 60), st.integers(0, 70))
def test_pieces_cover_and_overlap(s, limit, overlap):
    spans = pieces.cut_text(s, limit, overlap)
    share = max(0, min(overlap, limit - 1))
    assert spans[0][0] == 0 and spans[-1][1] == len(s)
    assert all(0 <= b - a <= limit for a, b in spans)
    assert all(y[0] == max(0, x[1] - share) for x, y in zip(spans, spans[1:]))


def test_pieces_prefer_natural_places():
    s = "One sentence is here. Another one is there.\n\nA new paragraph begins now."
    assert [s[a:b] for a, b in pieces.cut_text(s, 46, 0)] == ["One sentence is here. Another one is there.\n\n", "A new paragraph begins now."]


def test_pieces_rows(spark):
    c = spark.createDataFrame([("a", "d", "k", "word " * 50, 7, "m"), ("b", "d", None, "x" * 300, None, "m"), ("c", "d", "unknown", "y" * 90, 0, "m"), ("e", "d", "k", None, 0, "m"), (None, "d", "k", "z" * 200, 0, "m"), ("a", "d", "k", "word " * 50, 7, "m")], "chunk_id string, document_id string, chunker_id string, text string, start_char long, max_chars string")
    p = spark.createDataFrame([("k", 100, 10, False), ("std", 80, 5, True)], "chunker_id string, max_chars long, overlap_chars long, is_default boolean")
    got = pieces.pieces(c, p).where("chunk_id is not null").dropDuplicates(["chunk_id", "ordinal"]).collect()
    assert {r.chunk_id for r in got} == {"a", "b", "c"} and max(len(r.text) for r in got) <= 100
    assert all(r.start_char == 7 + r.piece_start for r in got if r.chunk_id == "a") and all(r.start_char is None for r in got if r.chunk_id == "b")
    assert pieces.pieces(c.limit(0), p).count() == 0 and {r[0] for r in pieces.found(c, p).collect()} == {"a", "b", "c"}


def _brute(rows, k=5):
    out = set()
    for p in {r[1] for r in rows}:
        us = sorted({(r[0], r[2]) for r in rows if r[1] == p})
        for e, v in us:
            near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), f) for f, w in us if f != e)[:k]
            out |= {(min(e, f), max(e, f)) for _, f in near}
    return out


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 8))
    rows = [(f"{i:05d}", "p" if i % 3 else "q", tuple(int(x * 100) for x in centre[i % 12] + rng.normal(size=8) / 3)) for i in range(900)]
    rows += [(f"c{i:03d}", "p", rows[1][2]) for i in range(40)]  # copies: ties at distance 0
    ref = [(e, p, "[" + ",".join(f"{x / 100:.2f}" for x in v) + "]", 8) for e, p, v in rows]
    bad = [("z1", "p", "[nan,1,1,1,1,1,1,1]", 8), ("z2", "p", None, 8), ("z3", "p", "[1,2]", 8), ("z4", "none", ref[0][2], 8), (None, "p", ref[0][2], 8), ("z5", "p", ref[0][2], None), ("z6", "p", "", 8), ref[5]]
    df = spark.createDataFrame(ref + bad, "embedding_id string, profile_id string, vector_ref string, dimensions long").withColumn("target_kind", F.lit("chunk")).withColumn("target_id", F.lit(None).cast("string")).withColumn("nums", F.lit(1)).withColumn("profile_dims", F.lit(3))
    prof = spark.createDataFrame([("p", "embedding", 8), ("q", "embedding", 8), ("pack", "packing", None)], "profile_id string, purpose string, dimensions long")
    got = {tuple(r) for r in neighbours.found(df, prof).collect()}
    want = _brute(rows)
    assert len(got & want) / len(want) >= 0.97 and len(got & want) / len(got) >= 0.97
    assert neighbours.found(df.limit(0), prof).count() == 0


def test_hilbert_neighbours_are_adjacent():
    g = np.array(list(itertools.product(range(8), range(8))))
    order = g[np.argsort(neighbours.hilbert(g, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_names_links_against_brute_force(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdegiklmnorst") for _ in range(rng.randint(4, 20))) for _ in range(120)]
    for w in words[:80]:
        for _ in range(3):
            v = list(w)
            for _ in range(rng.randint(1, 3)):
                v[rng.randrange(len(v))] = rng.choice("abcxyz")
            words.append("".join(v))
    words = sorted(set(words))
    got = {tuple(sorted(r)) for r in names.links(spark.createDataFrame([(w,) for w in words], "core string"), block=60).collect()}
    want = {(a, b) for a, b in itertools.combinations(words, 2) if names.distance(a, b) <= int(names.radius(np.array(min(len(a), len(b)))))}
    assert got == want


def _invented_archive(rng):
    """(alias_id, alias_text, entity): people and firms of another invented archive, with slips, short forms, initials and reordered parts."""
    given = {"Fernando": "Nando", "Guadalupe": "Lupe", "Antoine": "Toine", "Isabella": "Bella", "Giovanni": "Gianni", "Beatrice": "Bice", "Konstantin": "Kostja", "Josephine": "Fifi", "Leopold": "Poldi", "Marcellus": "", "Apollonia": "", "Hyacinth": ""}
    lines = {"Bakery": "Bky.", "Shipping": "Shpg.", "Vineyards": "Vyds.", "Fisheries": "Fish.", "Printworks": "Prtwks.", "Observatory": "Obs."}
    legal = [("Ltd", "Limited"), ("GmbH", "G.m.b.H."), ("Inc.", "Incorporated")]
    parts = ["bru", "dok", "fim", "gry", "huv", "kaz", "lyt", "moq", "nej", "pux", "rov", "syd", "tob", "vek", "wip", "zun", "chal", "thor", "quim", "oste"]

    def core():
        return "".join(rng.choice(parts) for _ in range(rng.randint(3, 4))).capitalize()

    def slip(t):
        k = rng.randrange(1, len(t) - 1)
        return rng.choice([t[:k] + t[k + 1] + t[k] + t[k + 2 :], t[:k] + t[k + 1 :], t[:k] + t[k] + t[k:]])

    rows = []
    for e in range(260):
        if e % 2:
            surname = core()
            for g in rng.sample(sorted(given), rng.choice([1, 1, 2])):
                for _ in range(6):
                    first = rng.choice([g, g, given[g] or g, g[0] + "."])
                    s = slip(surname) if rng.random() < 0.2 else surname
                    rows.append((rng.choice([f"{first} {s}", f"{s}, {first}", f"Dr. {first} {s}", f"{first} {s}".upper()]), f"{e}{g}"))
        else:
            name, form = f"{core()} {core()}", rng.choice(legal)
            for line in rng.sample(sorted(lines), rng.choice([1, 1, 2])):
                for _ in range(6):
                    n = slip(name) if rng.random() < 0.2 else name
                    w = rng.choice([line, line, lines[line]])
                    rows.append((rng.choice([f"{n} {w}", f"{w} {n}", f"{n} {w} {rng.choice(form)}", f"{w} {n} {rng.choice(form)}"]), f"{e}{line}"))
    return [(f"a{k:05d}", t, x) for k, (t, x) in enumerate(rows)]


def test_names_entities_by_statistics_alone(spark):
    rows = _invented_archive(random.Random(4))
    df = spark.createDataFrame([r[:2] for r in rows] + [("x1", None), ("x2", ""), ("x3", "???"), (None, "Ghost Name")], "alias_id string, alias_text string").withColumn("core", F.lit("c")).withColumn("n", F.lit(1))
    e = {r.alias_id: r.entity_id for r in names.entities(df).collect()}
    assert set(e) == {r[0] for r in rows} | {"x1", "x2", "x3"} and all(e[x] == x for x in ("x1", "x2", "x3"))
    of = {r[0]: r[2] for r in rows}
    by = {side: {(a, b) for g in _groups(side).values() for a, b in itertools.combinations(sorted(g), 2)} for side in (tuple(of.items()), tuple((k, v) for k, v in e.items() if k in of))}
    want, got = by.values()
    assert len(want & got) >= 0.9 * len(want) and len(want & got) >= 0.9 * len(got)
    assert names.found(df.limit(0)).count() == 0


def _groups(pairs):
    out = {}
    for k, v in pairs:
        out.setdefault(v, []).append(k)
    return out


def test_names_without_statistics(spark):
    groups = [["Erika Schneiderlinger", "Schneiderlinger, Erika", "Erika Schneiderlingr"], ["Acme Logistics", "Logistics Acme", "Acme Log. GmbH"], ["Dr. Johannes Bolavacalibus", "JOHANNES BOLAVACALIBUS"], ["ЗАО Машзавод Нелнелгаллемраук", "Нелнелгаллемраук Машзавод, З.А.О."]]
    rows = [(f"{g}{k}", t) for g, ts in enumerate(groups) for k, t in enumerate(ts)]
    e = {r.alias_id: r.entity_id for r in names.entities(spark.createDataFrame(rows, "alias_id string, alias_text string")).collect()}
    assert e == {f"{g}{k}": f"{g}0" for g, ts in enumerate(groups) for k in range(len(ts))}


def test_names_nicknames_are_a_parameter():
    lex = names.Lexicon({"margaret": 40, "peggy": 8}, set(), {"peggy": "margaret"})
    assert lex.parse("Peggy Bolavacalibus")[1:3] == lex.parse("Bolavacalibus, Margaret")[1:3] == ("bolavacalibus", ["margaret"])
    assert lex.parse("Margarte Bolavacalibus")[2] == ["margaret"]
    assert names.spelt_from("mfg", "manufacturing") and not names.spelt_from("hans", "johannes")


def test_golden(spark):
    g = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "a"), ("h", "zz"), (None, "a"), ("i", None)], "group_id string, document_id string").withColumn("filled", F.lit(9))
    r = spark.createDataFrame([("a", "docling", "Title", "eng", None, 10, 5, 1), ("a", "docling", "Old", "eng", "x", 10, 5, 0), ("b", "tesseract", "Title B", " UND ", "text/plain", 11, 5, 3), (None, "docling", "No", "eng", "x", 1, 1, 9)], "document_id string, extractor_profile string, title string, language string, media_type string, byte_size long, text_chars long, at int")
    r = r.withColumn("loaded_at", F.timestamp_seconds(F.col("at") * 100000)).withColumn("trust_rank", F.lit(5))
    x = spark.createDataFrame([("docling", 1), ("tesseract", 4)], "extractor_profile string, trust_rank long")
    e = spark.createDataFrame([("b", 5)], "document_id string, at int").withColumn("event_time", F.timestamp_seconds("at"))
    got = {row.group_id: row for row in golden.golden(g, r, x, e).collect()}
    assert got["g"].document_id == "a" and got["g"].title == "Title" and got["g"].language == "eng" and got["g"].media_type == "text/plain"
    assert got["h"].document_id == "zz" and got["h"].title is None and set(got) == {"g", "h"}
    assert golden.found(g.limit(0), r.limit(0), x, e).count() == 0


@pytest.mark.skipif(not __import__("os").path.exists("/opt/tokenizers"), reason="no tokenizer files")
def test_packing(spark, archive):
    docs, _, _ = archive
    p = spark.createDataFrame([("s", "packing", 128), ("l", "packing", 1000), ("e", "embedding", None), ("bad", "packing", 0)], "profile_id string, purpose string, capacity_tokens long")
    packed = packing.pack(docs, p, open_windows=16, partition_items=60).cache()
    counts = {r.doc_id: r.n for r in packing.token_counts(docs.dropDuplicates(["doc_id"])).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    for profile, cap in (("s", 128), ("l", 1000)):
        rows = packed.where(F.col("profile_id") == profile)
        used = rows.groupBy("container_id").agg(F.sum("n_tokens").alias("u")).collect()
        assert max(r.u for r in used) <= cap
        per = {r.doc_id: r.u for r in rows.where("doc_id <> 0").groupBy("doc_id").agg(F.sum("n_tokens").alias("u")).collect()}
        assert per == {k: v for k, v in counts.items() if k != 0}
        split = rows.where("part > 0").select("doc_id").distinct().collect()
        assert all(counts[r.doc_id] > cap for r in split)
    assert packing.pack(docs.limit(0), p).count() == 0
    fill = {r.profile_id: r.unused_share for r in packing.fill(packing.pack(docs, p)).collect()}
    assert fill["s"] < 0.01
    # no more containers than offline best fit, longest first, and one
    rooms: list[int] = []
    each = [r.n_tokens for r in packing.token_counts(docs).collect()]
    for n in sorted((x for t in each for x in [1000] * (t // 1000) + [t % 1000] if x), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 1000) - n)
    assert len(rooms) <= packing.pack(docs, p).where("profile_id = 'l'").select("container_id").distinct().count() <= len(rooms) + 1


def test_leaks_find_a_third_of_an_item_in_foreign_text():
    import numpy as np

    from archivolt.functions import wordhash
    from archivolt.llm import leaks

    item = [f"item{k}" for k in range(60)]
    page = [f"page{k}" for k in range(64)]
    text = " ".join(page[:32] + item[:20] + page[32:])
    h = np.unique(wordhash.words([" ".join(item + page)])[0])
    v = np.zeros((leaks.BUCKETS, len(h)), np.float32)  # each word an axis, so a third of the item has cosine 20 / 32 at most
    v[leaks._bucket(h), np.arange(len(h))] = 1
    matcher = leaks.Matcher([("i", " ".join(item))], np.ones(leaks.BUCKETS, np.float32), v, np.ones(leaks.BUCKETS, np.int64), 100)
    assert [(t, i) for t, i, *_ in matcher.search([text, " ".join(page)])] == [(0, 0)]


def test_words_of_scripts_without_spaces():
    from archivolt.functions import wordhash

    h, owner, a, b = wordhash.words(["这是测试 text。", "Ünd x", "測試Testテスト", "한국어 문서"])
    assert [(int(o), int(x), int(y)) for o, x, y in zip(owner, a, b)] == [(0, 0, 1), (0, 1, 2), (0, 2, 3), (0, 3, 4), (0, 5, 9), (1, 0, 3), (1, 4, 5), (2, 0, 1), (2, 1, 2), (2, 2, 6), (2, 6, 7), (2, 7, 8), (2, 8, 9), (3, 0, 3), (3, 4, 6)]


def test_tokens_of_long_texts_are_those_of_the_whole():
    from archivolt.llm import packing

    rng = random.Random(1)
    encode = packing.encoder("/opt/tokenizers/byte_bpe_multi_50k.tiktoken").encode_ordinary
    for _ in range(100):
        t = "".join(rng.choice(["ab", " ", "\n", "  ", ".", "12", "ж", "-", " c"]) for _ in range(400))
        assert encode(t) == [x for s in packing.stretches(t, 50) for x in encode(s)]
    long = "".join(rng.choice(["word ", "слово ", "x" * 90 + " ", "1 2\n"]) for _ in range(12_000))
    assert len(long) > 200_000 and len(encode(long)) == sum(len(encode(s)) for s in packing.stretches(long))


def test_many_profiles(spark):
    """The 1,001st profile counts, and no packing profile is an empty result."""
    from archivolt.llm import packing, pieces

    docs = spark.createDataFrame([(k, "some words here") for k in range(20)], "doc_id long, text string")
    many = spark.createDataFrame([(f"p{k:05d}", "packing", 8) for k in range(1001)], "profile_id string, purpose string, capacity_tokens long")
    assert packing.pack(docs, many).select("profile_id").distinct().count() == 1001
    assert packing.pack(docs, many.where("purpose = 'none'")).collect() == []
    chunks = spark.createDataFrame([("a", "d", "one two three four", 0, "k01000"), ("b", "d", "one two three four", 0, "k00001")], "chunk_id string, document_id string, text string, start_char long, chunker_id string")
    limits = spark.createDataFrame([(f"k{k:05d}", 5 if k == 1000 else 100, 0, k == 0) for k in range(1001)], "chunker_id string, max_chars long, overlap_chars long, is_default boolean")
    assert [r.chunk_id for r in pieces.found(chunks, limits).collect()] == ["a"]


def test_items_meet_passages_by_cells():
    """Cells skip no pair above the least cosine, with some thousand items."""
    from archivolt.llm import leaks

    rng = np.random.default_rng(2)
    words = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 24)) for _ in range(2001)]
    v = rng.normal(size=(leaks.BUCKETS, 16)).astype(np.float32)
    m = leaks.Matcher([(f"i{k}", t) for k, t in enumerate(words)], np.ones(leaks.BUCKETS, np.float32), v, np.ones(leaks.BUCKETS, np.int64), 100)
    vec = rng.normal(size=(300, 16)).astype(np.float32)
    vec[:100] = m.query[:100] + 0.2 * vec[:100]
    vec /= np.linalg.norm(vec, axis=1, keepdims=True)
    p, q, _ = m._near(vec)
    assert set(zip(p.tolist(), q.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(vec @ m.query.T > leaks.COSINE))))


def test_top_terms_are_spelt_from_all_texts():
    import numpy as np
    import pandas as pd

    from archivolt.functions import wordhash
    from archivolt.llm import subjects

    texts = [f"filler{k} words" for k in range(2500)] + ["Only here: Läuse, läuse"]
    wanted = np.unique(wordhash.words(["läuse words"])[0])
    got = pd.concat(subjects._spelt(wanted)(iter([pd.DataFrame({"text": texts})])))
    assert dict(zip(got["term"], got["n"])) == {"läuse": 2, "words": 2500}


def test_firm_of_common_words():
    lex = names.Lexicon({"nicholas": 8, "trading": 40, "transport": 20}, {"trading", "transport"})
    assert lex.parse("Nicholas Trading Ltd")[:3] == ("firm", "nicholas", ["trading"])  # the core may be no line of business
    assert lex.parse("Trading Transport")[:3] == ("firm", "transport", ["trading"])


def test_longest_run_keeps_a_bit_a_cell():
    import tracemalloc

    from archivolt.llm.leaks import Matcher

    equal = np.zeros((2000, 6000), bool)
    equal[np.arange(500, 900), np.arange(3000, 3400)] = True
    tracemalloc.start()
    got = Matcher._longest(equal, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got is not None and got[1:3] == (3010, 3409) and got[0] == 0.2
    assert peak < 10e6  # a table of the lengths takes 24 MB
    assert Matcher._longest(np.zeros((5, 0), bool), 0) is None and Matcher._longest(np.zeros((5, 9), bool), 0) is None

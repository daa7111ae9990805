"""Operators that fit a model: accuracy on held-out rows of a small archive, exact round trips, and awkward rows."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from llm_samples import text
from pyspark.sql import functions as F

from archivolt.functions import wordhash
from archivolt.llm import encoding, language, leaks, scans, subjects


def test_language(spark, archive):
    docs, recs, truth = archive
    got = {r.document_id: r for r in language.labels(docs, recs).collect()}
    right = sum(got[f"d{k:03d}"].language == lang for k, (lang, _) in truth.items())
    assert right / len(truth) >= 0.99 and got["n1"].language == got["n2"].language == got["n3"].language == "und"
    assert all(0 <= r.confidence <= 1 for r in got.values())


def test_language_cases(spark, archive):
    docs, recs, truth = archive
    mixed = docs.where("document_id = 'd000'").select("text").first().text + "\n\n" + docs.where("document_id = 'd002'").select("text").first().text
    extra = spark.createDataFrame([(5000, "mix", mixed, "eng", "x")], "doc_id long, document_id string, text string, lang string, label string").withColumn("code", F.lit("c")).withColumn("r", F.lit(1)).withColumn("count", F.lit(2))
    wrong = recs.select("document_id", F.when(F.col("document_id") == "d004", "fra").when(F.col("document_id") == "d008", " ").otherwise(F.col("language")).alias("language"), "loaded_at").union(spark.createDataFrame([("mix", "en-GB", 1)], "document_id string, language string, loaded_at int"))
    normal = spark.createDataFrame([("d012", "de"), ("d016", "EN")], "document_id string, language string")
    got = sorted(tuple(r) for r in language.found(docs.unionByName(extra), wrong, normal).collect() if r.document_id and r.document_id[0] in "dm")
    assert got == [("d004", "eng"), ("d008", "eng"), ("d012", "eng"), ("mix", "eng"), ("mix", "rus")]
    runs = [r for r in language.stretches(docs.unionByName(extra), recs).collect() if r.document_id == "mix"]
    assert [r.language for r in sorted(runs, key=lambda r: r.start_char)] == ["eng", "rus"]


@pytest.fixture(scope="module")
def decoder(archive):
    rows = [r.text for r in archive[0].where("length(text) between 1 and 3000").collect()]
    return encoding.Decoder.fit(rows)


@pytest.mark.parametrize("chain", encoding.CHAINS, ids=[encoding._name(c) for c in encoding.CHAINS])
def test_encoding_round_trip(decoder, chain):
    rng = random.Random(7)
    langs = ["rus", "ukr"] if chain[0] in encoding._CYRILLIC else ["eng", "deu"] if chain[0] in ("mac-roman", "cp1252") else ["eng", "deu", "rus", "ukr"]
    found = same = n = 0
    for _ in range(12):
        for lang in langs:
            clean = text(rng, lang, "S1", 1)
            bad = clean.translate(encoding._TABLES[chain])
            if bad == clean:
                continue
            n += 1
            got = decoder.repair([bad])[0]
            found += got is not None
            same += got is not None and got[0] == clean
    assert found >= 0.9 * n
    if chain[2] == 1 and "koi8" not in "".join(chain[:2]) and chain[0] != "cp866" and chain[1:] != ("cp1251", 1):
        assert same >= 0.6 * n


def test_offsets_of_restored_texts():
    import pandas as pd

    clean = "Für Heuballen gilt künftig der größere Wert.\nDas Gerät fährt später. The end is near here."
    raw = clean.encode().decode("cp1252")
    ends = [(clean.index(x), clean.index(x) + len(x)) for x in ("Für Heuballen gilt künftig der größere Wert.", "Das Gerät fährt später.", "The end is near here.")]
    judged = pd.DataFrame({"text": [0, 0, 0], "start": [a for a, _ in ends], "end": [b for _, b in ends]})
    language._to_raw(judged, [raw], [clean])
    got = [raw[a:b].encode("cp1252").decode() for a, b in zip(judged["start"], judged["end"])]
    assert got == [clean[a:b] for a, b in ends]


def test_encoding_clean_and_odd(decoder):
    rng = random.Random(8)
    clean = [text(rng, lang, "S2", 1) for lang in ("eng", "deu", "rus", "ukr") for _ in range(10)]
    assert sum(r is not None for r in decoder.repair(clean)) <= 1
    assert decoder.repair(["", "plain", None and "" or "x" * 100_000]) == [None, None, None]
    lost = decoder.repair(["F�r Heuballen"])[0]
    assert lost is not None and lost[2] is False


def test_encoding_rows(spark, archive):
    docs, recs, _ = archive
    chunks = docs.select(F.col("document_id").alias("chunk_id"), F.when(F.col("doc_id") == 1, F.expr("translate(text, 'ü', 'x')")).otherwise(F.col("text")).alias("text"), F.lit("k").alias("record_kind"))
    broken = spark.createDataFrame([("bad", "FÃ¼r Heuballen gilt kÃ¼nftig der grÃ¶ÃŸere Wert.", "k")], "chunk_id string, text string, record_kind string")
    got = {(r.record_kind, r.record_id): r for r in encoding.repaired(chunks.union(broken), recs).collect()}
    assert got[("chunk", "bad")].text == "Für Heuballen gilt künftig der größere Wert." and len(got) <= 3


def test_scans(spark):
    rng = random.Random(4)
    clean = [text(rng, lang, s, 2) for lang in ("eng", "deu") for s in ("S1", "S2") for _ in range(40)]
    page = "Nobody at Boholm could explain why the orchard row differed from the seed drill by more than 7\nCONTRACT AB-123/4\n- 12 -\nunits and why it was agreed that the hay bale was not deli-\nvered together with the wcrking group’s annual index card."
    rows = [(f"c{k}", t) for k, t in enumerate(clean)] + [("page", page), ("ocr", clean[0].replace("working", "vvorking").replace("noted", "n0ted").replace("that", "thaf")), ("wrap", clean[1].replace(" ", "\n", 3)), ("hyphen", "Both the pre-\nand the working group compared the seed drill with the index card."), ("null", None), ("empty", ""), ("long", "word " * 50_000)]
    df = spark.createDataFrame(rows, "chunk_id string, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).withColumn("document_id", F.lit("d"))
    titles = spark.createDataFrame([("Contract AB-1: x",)] * 5 + [(None,)], "title string")
    got = {r.chunk_id: r for r in scans.repaired(df, titles).collect()}
    assert {"page", "ocr"} <= set(got) and not {"wrap", "hyphen", "null", "empty", "long"} & set(got)
    assert "CONTRACT" not in got["page"].text and "- 12 -" not in got["page"].text and "delivered" in got["page"].text and "\n" not in got["page"].text
    assert sum(k.startswith("c") for k in got) == 0
    assert scans.found(df.limit(0), titles.limit(0)).count() == 0


def test_scans_beyond_the_list(spark):
    rng = random.Random(5)
    clean = [text(rng, lang, s, 2) for lang in ("eng", "deu") for s in ("S1", "S2") for _ in range(60)]
    rows = [(f"c{k}", f"d{k}", t) for k, t in enumerate(clean)]
    wrong = {"explain": "explxin", "delivered": "delivred", "working": "worknig", "deviation": "deviotion", "supplier": "supqlier"}
    for k, (right, read) in enumerate(wrong.items()):
        if right != "working":  # two letters that change places are two edits
            rows.append((f"e{k}", f"e{k}", "It was known at once that nobody could explain why it was delivered and noted a deviation of the supplier by the working group.".replace(right, read)))
    # a header without a code, in five chunks of one document, and a heading that recurs as well but breaks no sentence
    for k in range(5):
        rows.append((f"h{k}", "book", f"Results {k}\n\nNobody at Boholm could explain why the orchard row differed from the seed drill by\nHandbook of Irrigation   Part {k}\nmore than 7 units and why it was agreed that the hay bale was late."))
    rows.append(("double", "x", "Nobody could explain why the contractt for the seed drill was late. The contract was noted."))
    df = spark.createDataFrame(rows, "chunk_id string, document_id string, text string")
    titles = spark.createDataFrame([(None,)], "title string")
    got = {r.chunk_id: r for r in scans.repaired(df, titles).collect()}
    assert {f"h{k}" for k in range(5)} <= set(got) and all("Handbook" not in got[f"h{k}"].text and f"Results {k}" in got[f"h{k}"].text for k in range(5))
    for k, (right, read) in enumerate(wrong.items()):
        if right != "working":
            assert right in got[f"e{k}"].text and read not in got[f"e{k}"].text
    assert not {"double"} & set(got) and not any(k.startswith("c") for k in got)


def test_automaton_is_complete():
    vocabulary = {"".join(w): 100 for w in {("a", "b", "c"), ("a", "c"), ("b", "c", "d"), ("m", "a", "p"), ("o", "n", "l", "y")}}
    lex = scans.Lexicon(vocabulary, 5)
    from archivolt.llm.names import distance

    for read in ("abc", "abd", "bc", "rnap", "0nly", "xabc", "onl"):
        found = {w for _, w in lex.candidates(read)}
        assert {w for w in vocabulary if w != read and distance(w, read) <= 1} <= found
    assert lex.readings("rnap")[0][1] == "map" and lex.readings("0nly")[0][1] == "only"


def test_leaks(spark, archive):
    docs, _, _ = archive
    rng = random.Random(12)
    items = [(f"i{k}", " ".join(f"{w}{k}" if rng.random() < 0.4 else w for w in text(rng, "eng", "S1", 1).split())) for k in range(12)]
    words = [t.split() for _, t in items]
    cases = {10_000: " ".join(words[0]), 10_001: "Start here. " + " ".join(words[1][10:40]).upper() + " and more.", 10_002: "A " + " ".join(words[2][:8]) + " too short", 10_003: " ".join(w if j % 9 else "other" for j, w in enumerate(words[3])), 10_004: " ".join(words[4][:30]) + "\n- 7 -\nREPORT AB-1\n" + " ".join(words[4][30:])}
    extra = spark.createDataFrame([(k, f"x{k}", v, None, None) for k, v in cases.items()], "doc_id long, document_id string, text string, lang string, label string").withColumn("code", F.lit("c")).withColumn("r", F.lit(1)).withColumn("count", F.lit(2))
    table = spark.createDataFrame([*items, ("null", None), ("none", ""), items[0], (None, "text")], "evaluation_item_id string, query_text string").withColumn("text", F.lit("t"))
    got = sorted(tuple(r) for r in leaks.found(docs.unionByName(extra), table).collect())
    assert got == [(10_000, "i0"), (10_001, "i1"), (10_003, "i3"), (10_004, "i4")]
    chinese = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    asian = spark.createDataFrame([(20_000, "z", "开头。" + chinese[10:50] + "。结尾"), (20_001, "y", chinese[::-1])], "doc_id long, document_id string, text string")
    one = spark.createDataFrame([("cn", chinese)], "evaluation_item_id string, query_text string")
    assert [tuple(r) for r in leaks.found(docs.select("doc_id", "document_id", "text").unionByName(asian), one).collect()] == [(20_000, "cn")]
    assert leaks.found(docs.limit(0), table).count() == 0 and leaks.found(docs, table.limit(0)).count() == 0


def test_subjects(spark, archive):
    docs, _, truth = archive
    labels = spark.createDataFrame([(k, s) for k, (_, s) in truth.items() if k < 64] + [(1, "none"), (777_777, "S1"), (None, "S1"), (2, None)], "doc_id long, class_id string").withColumn("text", F.lit("t"))
    items = spark.createDataFrame([(None, None), ("S1", ""), ("nope", "x")], "label string, query_text string")
    classes = spark.createDataFrame([("S1",), ("S2",), (None,), ("S1",)], "class_id string")
    got = {}
    # an archive of two subjects: their words are in more documents than in one of many
    for r in subjects.found(docs, labels, items, classes, stop_share=0.2).collect():
        got.setdefault(r.doc_id, set()).add(r.class_id)
    held = {k: s for k, (_, s) in truth.items() if k >= 64}
    assert sum(got.get(k) == {s} for k, s in held.items()) / len(held) >= 0.95
    assert 900 not in got and 901 not in got
    assert subjects.found(docs.limit(0), labels, items, classes).count() == 0
    assert subjects.found(docs, labels.limit(0), items, classes, stop_share=0.2).count() == 0
    many = spark.createDataFrame([(f"T{k}",) for k in range(1001)] + [("S1",), ("S2",)], "class_id string")
    got = subjects.found(docs, labels, items, many, stop_share=0.2).groupBy("class_id").count().collect()
    assert {r.class_id for r in got} == {"S1", "S2"}


def test_topics_are_learned(spark, archive):
    """The rounds matter: documents are likelier under the fitted topics than under those they start from."""
    docs, _, truth = archive
    likelihood = []
    for epochs in (0, 2):
        vocab, mass, bags = subjects.topics(docs, epochs=epochs, stop_share=0.2)
        phi, alpha = subjects._shares(mass), np.full(mass.shape[1], subjects.ALPHA, np.float32)
        total = words = 0
        for r in bags.collect():
            w = np.frombuffer(r.words, np.int32)
            theta = subjects.infer(w, np.zeros(len(w), int), phi, alpha).sum(0) + alpha
            total += np.log(phi[w] @ (theta / theta.sum())).sum()
            words += len(w)
        likelihood.append(total / words)
    assert likelihood[1] > likelihood[0] + 0.1


def test_subject_paragraphs():
    phi = np.array([[0.9, 0.01, 0.09], [0.01, 0.9, 0.09]], np.float32)
    r = subjects.infer(np.array([0, 0, 1, 1]), np.array([0, 0, 0, 1]), phi, np.array([0.1, 0.1, 0.5], np.float32))
    assert r[0, 0] > 0.5 and r[3, 1] > 0.5 and np.allclose(r.sum(1), 1)


def test_subject_counts_in_small_blocks():
    """Expected counts are those of the plain formula; no array of words x topics is formed for it."""
    rng = np.random.default_rng(5)
    phi = rng.random((400, 96)).astype(np.float32)
    phi, alpha = phi / phi.sum(0), np.full(96, 0.05, np.float32)
    docs = [rng.integers(0, 400, 3 + k % 300).astype(np.int32) for k in range(900)]
    parts = [np.sort(rng.integers(0, 4, len(d))).astype(np.int32) for d in docs]
    pdf = pd.DataFrame({"words": [d.tobytes() for d in docs], "paragraphs": [p.tobytes() for p in parts]})
    expected = np.zeros(phi.shape)
    for d, p in zip(docs, parts):
        for k in np.unique(p):
            w, theta = d[p == k], alpha.astype(float)
            for _ in range(subjects.STEPS):
                theta = theta * (phi[w] / (phi[w] @ theta)[:, None]).sum(0) + alpha
            np.add.at(expected, w, phi[w] * theta / (phi[w] @ theta)[:, None])
    tracemalloc.start()
    (got,) = subjects._expect(SimpleNamespace(value=(phi, alpha)))(iter([pdf]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(np.frombuffer(got.z[0], np.float32).reshape(phi.shape), expected, rtol=1e-3, atol=1e-4)
    assert peak < sum(map(len, docs)) * 96 * 4 / 2


def test_subject_document_frequencies():
    """A word counts once a text, whatever blocks the texts fall into; what a block needs doesn't grow with the texts."""
    texts = [f"alpha alpha beta{'' if k % 2 else ' gamma'} x_1 " + "delta " * (k % 50) + "\n" for k in range(6000)] + ["", None]
    tracemalloc.start()
    got = pd.concat(subjects._df(iter([pd.DataFrame({"text": texts[:2000]}), pd.DataFrame({"text": texts[2000:]})])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    h = wordhash.words(["alpha beta gamma delta"])[0].view(np.int64).tolist()
    counts = dict(zip(got["word"], got["n"]))
    assert [counts[w] for w in h] == [6000, 6000, 3000, 5880] and counts[0] == 6002 and len(counts) == 5
    assert peak < 25e6
    empty = pd.concat(subjects._df(iter([pd.DataFrame({"text": ["", "1 2"]})])))
    assert empty.to_dict("list") == {"word": [0], "n": [2]}

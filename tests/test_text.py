from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from archivolt.functions import text as t
from archivolt.functions.language import detect_language


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_canonical_runs_cover_the_view(s):
    out, runs = t.canonical_text(s)
    assert runs == sorted(runs) and (runs[-1][3] if runs else 0) == len(out)
    assert all(a[3] == b[2] for a, b in zip(runs, runs[1:]))
    assert t.canonical_text(out)[0] == out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB ёЁß\t\nИ.", max_size=40))
def test_search_view_is_stable(s):
    once = t.search_text(s)[0]
    assert t.search_text(once)[0] == once and once == once.strip() and "  " not in once


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="Ab. !?\n\"«1", max_size=60))
def test_sentences_lose_nothing(s):
    assert "".join(s[a:b] for a, b in t.sentence_spans(s)) == s


def test_sentences_keep_initials():
    s = "Dr. A. Smith came. He left at 5 p.m. today. Then"
    assert [s[a:b] for a, b in t.sentence_spans(s)] == ["Dr. ", "A. Smith came. ", "He left at 5 p.m. today. ", "Then"]


def test_offsets_and_tokens(spark):
    df = spark.createDataFrame([("a\r\nb  c",), (None,), ("",)], "s string")
    v = df.select(t.canonical_view("s").alias("v")).select("v.text", t.to_source("v.runs", F.lit(2)).alias("at")).collect()
    assert v[0].text == "a\nb  c" and v[0].at == 3 and v[1].text is None
    x = df.select(t.tokens("s").alias("k"), t.shingles(t.words(F.col("s")), 2).alias("g")).collect()
    assert x[0].g == ["a b", "b c"] and x[1].g is None and x[2].g == []
    assert t.decode_token(t.encode_token("ё/a b")) == "ё/a b"


def test_language(spark):
    texts = ["Der Bericht wurde von der Stelle geprüft und ist für die Akten nicht mehr von Bedeutung", "Это письмо было написано для того, чтобы объяснить причину отказа и предложить решение", "short", None, "", "1 2 3"]
    got = [tuple(r.r) for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(detect_language("t").alias("r")).collect()]
    assert [g[0] for g in got[:2]] == ["deu", "rus"] and got[2:] == [("und", 0.0)] * 4

"""Small archives made of the same kind of sentences as the test tables, with every awkward row."""

import random

import pytest
from llm_samples import SENTENCES, text
from pyspark.sql import functions as F

@pytest.fixture(scope="session")
def archive(spark):
    """documents, records and chunks of four languages and two subjects, with the truth."""
    rng = random.Random(3)
    rows, truth = [], {}
    for k in range(160):
        lang, subject = list(SENTENCES)[k % 4], "S1" if k // 4 % 2 else "S2"
        rows.append((k, f"d{k:03d}", text(rng, lang, subject), lang, "other"))
        truth[k] = (lang, subject)
    odd = [(900, "n1", None, None, "x"), (901, "n2", "", "eng", "x"), (902, "n3", "12 | 13\n14 | 15", None, "x"), (903, None, "No id here.", "eng", "x"), (None, "n5", "No number here.", "eng", "x"), (904, "n6", "x" * 30000 + " " + "word " * 20000, "eng", "x"), (0, "d000", rows[0][2], "eng", "x")]
    # columns that clash with names used inside the operators
    docs = spark.createDataFrame(rows + odd, "doc_id long, document_id string, text string, lang string, label string").withColumn("code", F.lit("c")).withColumn("r", F.lit(1)).withColumn("count", F.lit(2)).cache()
    recs = spark.createDataFrame([(r[1], r[3], f"Report AB-{r[0]}: x", "docling", r[0] or 0) for r in rows + odd], "document_id string, language string, title string, extractor_profile string, loaded_at int").withColumn("label", F.lit("z")).cache()
    return docs, recs, truth

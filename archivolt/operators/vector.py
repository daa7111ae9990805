"""Vector operators: dimension guards, exact nearest neighbours of given queries, and distances as Column expressions."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut


def dot(a: Column, b: Column) -> Column:
    """Scalar product of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 where a vector is all zero."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def dimension_guard(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(rows, least, greatest, distinct, mixed): one row that tells whether a projection would mix dimensions."""
    d = F.size(vector)
    return df.where(F.col(vector).isNotNull()).agg(F.count("*").alias("rows"), F.min(d).alias("least"), F.max(d).alias("greatest"), F.count_distinct(d).alias("distinct")).withColumn("mixed", F.col("distinct") > 1)


def nearest(df: DataFrame, query: list[float], k: int = 10, identity: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of one query vector, by L2 then id: a distributed top-k over a single scan."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return df.where(F.size(vector) == len(query)).select(identity, F.round(l2(F.col(vector), q), 6).alias("distance")).orderBy("distance", identity).limit(k)


def nearest_of_queries(df: DataFrame, queries: DataFrame, k: int = 5, identity: str = "vec_id", vector: str = "embedding", block: int = 4096) -> DataFrame:
    """(query_id, rank, id, distance): every stated query against all rows.

    The queries, (query_id, query), are a stated set matched in blocks: each task scores its own rows and keeps k per query, so
    what is shuffled is k rows a query and task, never the pairs."""
    spark = df.sparkSession
    kind, qkind = dict(df.dtypes)[identity], dict(queries.dtypes)["query_id"]
    rows = df.where(F.col(vector).isNotNull()).select(identity, vector)

    def score(shared):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, q = [i for i, _ in shared.value], np.array([v for _, v in shared.value], np.float64)
            for pdf in batches:
                x = np.stack(pdf[vector].to_numpy()).astype(np.float64)
                names = pdf[identity].to_numpy()
                for a in range(0, len(q), 256):
                    part = q[a : a + 256]
                    d = np.round(np.sqrt(np.maximum(0, (part**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * part @ x.T)), 6)
                    for i, row in enumerate(d):
                        kth = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1]
                        at = np.flatnonzero(row <= kth)
                        at = at[np.lexsort((names[at], row[at]))][:k]
                        yield pd.DataFrame({"query_id": ids[a + i], "id": names[at], "distance": row[at]})

        return run

    near = None
    # the driver holds one block of queries at a time; a further block starts when the one before is written
    for chunk in itertools.batched(((r.query_id, list(r.query)) for r in queries.select("query_id", "query").toLocalIterator()), block):
        found = rows.mapInPandas(score(spark.sparkContext.broadcast(list(chunk))), f"query_id {qkind}, id {kind}, distance double")
        near = cut(found) if near is None else near.unionByName(cut(found))
    if near is None:
        near = spark.createDataFrame([], f"query_id {qkind}, id {kind}, distance double")
    best = near.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("distance", "id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("rank", "b")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.id").alias("id"), F.col("b.distance").alias("distance"))


def profile_violations(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rows whose dimensions or digest differ from their profile's; rows without a known profile are violations too."""
    p = F.broadcast(profiles.select("profile_id", F.col("dimensions").alias("want_dimensions"), F.col("model_digest").alias("want_digest")))  # a fixed table of profiles
    j = rows.join(p, "profile_id", "left")
    return j.where(F.col("want_dimensions").isNull() | ~F.col("dimensions").eqNullSafe(F.col("want_dimensions")) | ~F.col("model_digest").eqNullSafe(F.col("want_digest"))).select("embedding_id", "profile_id", "dimensions", "want_dimensions").distinct()


def embed(df: DataFrame, provider=None, text: str = "text", dimensions: int = 64) -> DataFrame:
    """df with embedding (array<double>) and status: ok, empty for texts without words, or error where the provider failed.

    provider maps a list of texts to a list of vectors of one size, a batch at a time; without one the vectors are signed sums of
    hashed words, of unit length."""
    from archivolt.functions import wordhash

    def hashed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dimensions))
        h, owner, _, _ = wordhash.words(texts)
        np.add.at(out, (owner, (h % np.uint64(dimensions)).astype(int)), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0))
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).tolist()

    @F.pandas_udf("embedding array<double>, status string")
    def run(texts: pd.Series) -> pd.DataFrame:
        filled = [t for t in texts if t and t.strip()]
        try:
            vectors, status = iter((provider or hashed)(filled) if filled else []), "ok"
        except Exception:  # a provider's failure marks its rows, it doesn't end the job
            vectors, status = iter([None] * len(filled)), "error"
        return pd.DataFrame([(next(vectors), status) if t and t.strip() else (None, "empty") for t in texts], columns=["embedding", "status"])

    return df.withColumn("_e", run(text)).withColumns({"embedding": F.col("_e.embedding"), "status": F.col("_e.status")}).drop("_e")

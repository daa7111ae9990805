"""Problem 2: the most similar vectors of every vector.

Method: shifted space-filling curves. Vectors are projected by several seeded random rotations of their principal
axes, shifted, quantised and numbered along a Hilbert curve; each curve's order is range-partitioned by Spark, and every
vector is compared exactly with the blocks before, around and after it. The candidates of all curves merge, the
neighbours of the neighbours found join them once, and the best are ranked by exact distance. The number of curves grows with
the logarithm of the number of vectors, so that the loss doesn't.

Equal vectors are one point with a list of ids, so copies cost nothing and a hot group stays one row until the end. Points are
numbered in the order of their smallest id and travel as packed bytes.
Components are counted in hundredths; whole ones give exact distances, and ties go to the smaller embedding_id.

Defined cases: unusable rows (null, not `dimensions` finite numbers, a dimension other than the profile's) are left out;
a repeated embedding_id counts once (the smallest row); profiles with fewer than k + 1 rows give fewer neighbours.
Loss: measured recall against brute force is kept in tests (at least 0.9 asked, about 0.99 or more seen).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivolt.session import cut

K = 5
#: Curves for up to FEW points, and more for each doubling beyond; rows of a block, projected dimensions, bits of each, rows of a
#: Spark partition of one curve.
CURVES, FEW, MORE, BLOCK, PROJECTED, BITS, PARTITION_ROWS = 8, 8_000, 2.0, 160, 8, 7, 60_000
SEED = 1234


def usable(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """(embedding_id, profile_id, vec array<double> in hundredths, targets) of the usable rows, each embedding_id once."""
    dims = F.broadcast(profiles.where("purpose = 'embedding' and dimensions is not null").groupBy("profile_id").agg(F.min("dimensions").alias("profile_dims")))
    bare = F.regexp_replace(F.trim("vector_ref"), r"^[\[{(]\s*|\s*[\]})]$", "")
    parts = F.split(bare, r"\s*[,;]\s*|\s+")
    nums = F.transform(parts, lambda x: x.try_cast("double"))
    fine = F.forall("nums", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select("embedding_id", "profile_id", "dimensions", "vector_ref", "target_kind", "target_id")
    return (
        rows.where("embedding_id is not null and vector_ref is not null and dimensions is not null")
        .join(dims, "profile_id")
        .where("dimensions = profile_dims")
        .withColumn("nums", nums)
        .where((F.size("nums") == F.col("dimensions")) & fine)
        .groupBy("embedding_id")
        .agg(F.min(F.struct("profile_id", F.transform("nums", lambda x: F.when(F.abs(x * 100 - F.round(x * 100)) < 1e-6, F.round(x * 100)).otherwise(x * 100) + F.lit(0.0)).alias("vec"), "target_kind", "target_id")).alias("r"))
        .select("embedding_id", "r.*")
    )


def points(vectors: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: (profile_id, vec, pid = smallest id, ids = the keep smallest ids). Partial aggregation first."""
    one = vectors.groupBy("profile_id", "vec", F.pmod(F.xxhash64("embedding_id"), F.lit(16)).alias("salt")).agg(F.slice(F.sort_array(F.collect_list("embedding_id")), 1, keep).alias("ids"))
    return one.groupBy("profile_id", "vec").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids")).select("profile_id", "vec", F.col("ids")[0].alias("pid"), "ids")


def pack(vector: np.ndarray) -> bytes:
    """A vector as bytes, the first of which tells their kind: whole numbers of one or two bytes, else doubles."""
    whole = vector == np.rint(vector)
    top = np.abs(vector).max(initial=0)
    for mark, kind, limit in ((b"b", np.int8, 127), (b"h", np.int16, 32767)):
        if top <= limit and whole.all():
            return mark + vector.astype(kind).tobytes()
    return b"d" + vector.astype(np.float64).tobytes()


_KIND = {98: np.int8, 104: np.int16, 100: np.float64}


def unpack(codes) -> np.ndarray:
    """The vectors of packed rows, of equal dimension, as a matrix of doubles."""
    first = codes[0][0]
    if all(c[0] == first for c in codes):
        raw = np.frombuffer(b"".join(bytes(c)[1:] for c in codes), _KIND[first])
        return raw.reshape(len(codes), -1).astype(np.float64)
    return np.stack([np.frombuffer(bytes(c)[1:], _KIND[c[0]]).astype(np.float64) for c in codes])


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    acc: dict[int, list] = {}
    for pdf in batches:
        for profile, part in pdf.groupby("p"):
            x = unpack(part["code"].to_numpy())
            a = acc.setdefault(int(profile), [0, np.zeros(x.shape[1]), np.zeros((x.shape[1],) * 2)])
            a[0] += len(x)
            a[1] += x.sum(0)
            a[2] += x.T @ x
    yield pd.DataFrame([(p, n, list(s), list(q.ravel())) for p, (n, s, q) in acc.items()], columns=["p", "n", "s", "q"])


def axes(pts: DataFrame) -> dict[int, tuple]:
    """For each profile its count, mean, and leading principal axes with their spreads, from sums over all points."""
    rows = pts.select("p", "code").mapInPandas(_moments, "p int, n long, s array<double>, q array<double>")
    total = rows.groupBy("p").agg(
        F.sum("n").alias("n"),
        F.expr("aggregate(collect_list(s), array_repeat(0D, size(first(s))), (a, x) -> zip_with(a, x, (u, v) -> u + v))").alias("s"),
        F.expr("aggregate(collect_list(q), array_repeat(0D, size(first(q))), (a, x) -> zip_with(a, x, (u, v) -> u + v))").alias("q"),
    )
    out = {}
    for r in total.collect():  # a row per embedding profile, a fixed table
        mean = np.array(r.s) / r.n
        cov = np.array(r.q).reshape(len(mean), -1) / r.n - np.outer(mean, mean)
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1]
        out[r.p] = (r.n, mean, vectors[:, order], np.sqrt(np.maximum(values[order], 1e-9)))
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of whole numbers under 2**bits, by Gray-code transposition, all rows at once."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] = np.where(high, x[:, 0] ^ p, x[:, 0] ^ swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _curve_keys(stats: dict[int, tuple], curves: int, projected: int, bits: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for profile, part in pdf.groupby("p"):
                _, mean, vectors, spread = stats[profile]
                x = (unpack(part["code"].to_numpy()) - mean) @ vectors
                d = min(projected, x.shape[1])
                wide = min(x.shape[1], 3 * d)
                for c in range(curves):
                    rng = np.random.default_rng(seed + c)
                    # the leading axes, turned at random: nearly orthogonal views that keep most of the distance
                    turn = np.linalg.qr(rng.normal(size=(wide, wide)))[0][:, :d]
                    y = x[:, :wide] @ turn
                    scale = np.sqrt(((spread[:wide, None] * turn) ** 2).sum(0)).max() * 6
                    shift = rng.uniform(0, 1, d) / 4
                    cells = np.clip(((y / scale + 0.5) * 0.75 + shift) * (1 << bits), 0, (1 << bits) - 1)
                    yield pd.DataFrame({"p": np.int32(profile), "curve": np.int32(c), "key": hilbert(cells, bits), "num": part["num"].to_numpy(), "code": part["code"].to_numpy()})

    return run


def _best(own: np.ndarray, other: np.ndarray, own_ids: np.ndarray, other_ids: np.ndarray, k: int):
    """Numbers and squared distances of the k nearest others of each own row; ties by number, the row itself left out."""
    d = (own**2).sum(1)[:, None] + (other**2).sum(1)[None, :] - 2 * own @ other.T
    d[own_ids[:, None] == other_ids[None, :]] = np.inf
    rank = np.empty(len(other_ids))
    rank[np.argsort(other_ids, kind="stable")] = np.arange(len(other_ids))
    # whole distances differ by one at least, so the rank only parts equal ones
    key = d + rank / (2 * len(rank))
    k = min(k, d.shape[1])
    near = np.argpartition(key, k - 1, axis=1)[:, :k]
    return other_ids[near], np.take_along_axis(d, near, 1)


_PAIR = np.dtype([("d", "<f8"), ("num", "<i8")])


def _windows(block: int, k: int):
    """Compare each row of the sorted partition with the blocks before, around and after it, inside its curve."""

    def compare(own: pd.DataFrame, window: list[pd.DataFrame]) -> pd.DataFrame:
        other = pd.concat(window) if len(window) > 1 else window[0]
        ids, others = own["num"].to_numpy(), other["num"].to_numpy()
        near, d = _best(unpack(own["code"].to_numpy()), unpack(other["code"].to_numpy()), ids, others, k)
        found = np.empty(near.shape, _PAIR)
        found["d"], found["num"] = d, near
        return pd.DataFrame({"num": ids, "near": [r.tobytes() for r in found]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # up to two blocks of the current run
        rest: pd.DataFrame | None = None
        at = None

        def push(b: pd.DataFrame):
            held.append(b)
            if len(held) == 2:
                yield compare(held[0], held)
            elif len(held) == 3:
                yield compare(held[1], held)
                held.pop(0)

        def close():
            if len(held) >= 1:
                yield compare(held[-1], held)
            held.clear()

        for pdf in batches:
            for run_key, part in pdf.groupby(["p", "curve"], sort=False):
                if run_key != at:
                    if rest is not None and len(rest):
                        yield from push(rest)
                    yield from close()
                    rest, at = None, run_key
                rest = part if rest is None else pd.concat([rest, part])
                while len(rest) >= 2 * block:
                    yield from push(rest.iloc[:block])
                    rest = rest.iloc[block:]
        if rest is not None and len(rest):
            yield from push(rest)
        yield from close()

    return run


_NEAR = "num long, near array<struct<d: double, num: long>>"


def _merge(k: int):
    """The k best of the lists of one point, a list a curve."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for lists in pdf["lists"]:
                x = np.unique(np.frombuffer(b"".join(lists), _PAIR))
                out.append([{"d": float(d), "num": int(n)} for d, n in x[np.isfinite(x["d"])][:k]])
            yield pd.DataFrame({"num": pdf["num"], "near": out})

    return run


def _closer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the neighbours of a neighbour those that are closer than the last of the point's own list."""
    for batch in batches:
        for _, pdf in batch.groupby("p"):  # profiles differ in dimensions
            many = pdf["others"].str.len().to_numpy()
            row = np.repeat(np.arange(len(pdf)), many)
            own, other = unpack(pdf["code"].to_numpy())[row], unpack(np.concatenate(pdf["codes"].to_numpy()))
            num, others = pdf["num"].to_numpy()[row], np.concatenate(pdf["others"].to_numpy())
            d = ((own - other) ** 2).sum(1)
            keep = (num != others) & (d <= pdf["worst"].to_numpy()[row])
            yield pd.DataFrame({"num": num[keep], "other": others[keep], "d": d[keep]})


def curves_for(n: int) -> int:
    """CURVES for few points, MORE for each doubling."""
    return CURVES + round(MORE * max(0.0, np.log2(max(1, n) / FEW)))


def nearest_points(pts: DataFrame, k: int = K, curves: int | None = None, block: int = BLOCK, seed: int = SEED, refine: bool = True) -> DataFrame:
    """(num, near): the k nearest distinct vectors of each point (p, num, code), by (distance, number)."""
    stats = axes(pts)
    n = sum(s[0] for s in stats.values())
    curves = curves or curves_for(n)
    parts = max(1, -(-n * curves // PARTITION_ROWS))
    keyed = pts.select("p", "num", "code").mapInPandas(_curve_keys(stats, curves, PROJECTED, BITS, seed), "p int, curve int, key long, num long, code binary")
    ordered = keyed.repartitionByRange(int(parts), "p", "curve", "key", "num").sortWithinPartitions("p", "curve", "key", "num")
    lists = ordered.mapInPandas(_windows(block, k), "num long, near binary").groupBy("num").agg(F.collect_list("near").alias("lists"))  # as many as curves
    near = cut(lists.mapInPandas(_merge(k), _NEAR))
    if not refine:
        return near
    links = near.select("num", F.explode("near.num").alias("via"))
    both = links.union(links.select(F.col("via").alias("num"), F.col("num").alias("via"))).distinct()
    worst = near.select("num", F.when(F.size("near") < k, float("inf")).otherwise(F.array_max("near")["d"]).alias("worst"))
    lists = links.join(pts.select(F.col("num").alias("via"), "code"), "via").groupBy(F.col("num").alias("via")).agg(F.collect_list(F.struct("via", "code")).alias("l"))
    lists = lists.select("via", F.col("l.via").alias("others"), F.col("l.code").alias("codes"))  # k at most
    mine = both.join(pts.select("num", "p", "code").join(worst, "num"), "num")
    more = mine.join(lists, "via").select("p", "num", "code", "worst", "others", "codes").mapInPandas(_closer, "num long, other long, d double")
    own = near.select("num", F.explode("near").alias("n")).select("num", F.col("n.num").alias("other"), F.col("n.d").alias("d"))
    every = own.unionByName(more).groupBy("num", "other").agg(F.min("d").alias("d"))
    # a rank by window streams over its rows, however many point at one vector
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("num").orderBy("d", "other"))).where(F.col("rank") <= k)
    return ranked.groupBy("num").agg(F.array_sort(F.collect_list(F.struct("d", F.col("other").alias("num")))).alias("near"))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"p": pdf["p"], "num": pdf["num"], "code": [pack(np.asarray(v)) for v in pdf["vec"]]})


def nearest_rows(rows: DataFrame, profiles: DataFrame, k: int = K, **options) -> tuple[DataFrame, DataFrame]:
    """The usable rows, and (embedding_id, profile_id, rank, neighbour_id, squared): the k nearest rows of each."""
    vectors = cut(usable(rows, profiles))
    grouped = points(vectors, k + 1)
    pts = cut(grouped.orderBy("profile_id", "pid").withColumn("num", F.monotonically_increasing_id()))  # numbers in the order of ids
    names = sorted(r.profile_id for r in pts.select("profile_id").distinct().collect())  # a fixed table of profiles
    index = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("profile_id")).cast("int") if names else F.lit(0)
    near = nearest_points(cut(pts.select(index.alias("p"), "num", "vec").mapInPandas(_packed, "p int, num long, code binary")), k, **options)
    other = pts.select(F.col("num").alias("other"), F.slice("ids", 1, k).alias("other_ids"))
    expanded = (
        near.select("num", F.explode("near").alias("n"))
        .select("num", F.col("n.d").alias("d"), F.col("n.num").alias("other"))
        .join(other, "other")
        .groupBy("num")
        .agg(F.flatten(F.collect_list(F.transform("other_ids", lambda e: F.struct(F.col("d").alias("d"), e.alias("id"))))).alias("far"))
    )
    best = pts.join(expanded, "num", "left").select(
        "profile_id",
        "vec",
        F.slice(F.sort_array(F.concat(F.transform("ids", lambda e: F.struct(F.lit(0.0).alias("d"), e.alias("id"))), F.coalesce("far", F.expr("cast(array() as array<struct<d: double, id: string>>)")))), 1, k + 1).alias("best"),
    )
    mine = F.slice(F.filter("best", lambda b: b["id"] != F.col("embedding_id")), 1, k)
    found = (
        vectors.select("embedding_id", "profile_id", "vec")
        .join(best, ["profile_id", "vec"])
        .select("embedding_id", "profile_id", F.posexplode(mine).alias("rank", "b"))
        .select("embedding_id", "profile_id", (F.col("rank") + 1).alias("rank"), F.col("b.id").alias("neighbour_id"), F.col("b.d").alias("squared"))
    )
    return vectors, found


def neighbours(rows: DataFrame, profiles: DataFrame, k: int = K, **options) -> DataFrame:
    """(embedding_id, target_kind, target_id, profile_id, rank, neighbour_id, neighbour_kind, neighbour_target, squared): the k
    nearest rows of every usable row with both rows' targets; squared counts hundredths."""
    vectors, found = nearest_rows(rows, profiles, k, **options)
    target = vectors.select("embedding_id", "target_kind", "target_id")
    other = target.toDF("neighbour_id", "neighbour_kind", "neighbour_target")
    return found.join(target, "embedding_id").join(other, "neighbour_id").select("embedding_id", "target_kind", "target_id", "profile_id", "rank", "neighbour_id", "neighbour_kind", "neighbour_target", "squared")


def found(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """(embedding_id_a, embedding_id_b): pairs of which one is among the other's five nearest."""
    _, n = nearest_rows(rows, profiles)
    return n.select(F.least("embedding_id", "neighbour_id").alias("embedding_id_a"), F.greatest("embedding_id", "neighbour_id").alias("embedding_id_b")).distinct()

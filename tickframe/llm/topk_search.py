"""Exact top-k inner-product search by norm buckets.

Candidates are cut into buckets of similar length, each of bounded size (a range of equal norms is dealt over
several).  A first pass over the longest vectors gives every query a lower bound of its k-th best score.  A
query meets a bucket only if its bound can be reached by the bucket's longest vector.  Within a bucket, the bound
becomes a local cosine threshold: if it is high, the query's largest coordinates bound the candidates' (coordinate
pruning), otherwise candidates too short to reach it are cut off (length pruning).  What is left is verified by
exact products of integers.

Defined cases: vectors that are NULL or hold NULL, NaN or infinite components take no part; missing components
of shorter vectors count as 0; rows with a query's own id are not its candidates; repeated rows are candidates of
their own; ties go to the smaller id; an empty table gives an empty result; extra columns are ignored.
Components are exact up to a sum of products of 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import releasing, stage_table

SCALE = 256
K = 5
BUCKET_ROWS = 4096
QUERY_ROWS = 2048
NORM_RANGES = 256
SEED_ROWS = 2048
FOCUS = 3
HIGH_COSINE = 0.6
SLACK = 1e-9


#: Sums of products up to here are exact in doubles.
EXACT = 2.0 ** 53


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec, norm) of the vectors that take part: ``floor(scale * x)`` of every component."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    vec = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return (rows.filter(x.isNotNull() & finite & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
            .withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, padded with 0 to ``width``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_bucket(queries: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """For each query, its top k of the bucket among those that reach its bound: (query index, ids, scores)."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    by = np.argsort(-norms, kind="stable")
    vectors, ids, norms = vectors[by], ids[by], norms[by]
    unit = vectors / np.maximum(norms, 1e-300)[:, None]
    query_norms = np.sqrt((queries * queries).sum(axis=1))
    longest = norms[0] if len(norms) else 0.0
    cosine = np.where(bounds > 0, bounds / np.maximum(query_norms * longest, 1e-300), -1.0) - SLACK
    shortest = np.where(bounds > 0, bounds / np.maximum(query_norms, 1e-300), 0.0) * (1 - SLACK)
    reach = np.searchsorted(-norms, -shortest, side="right")  # candidates long enough
    by_coordinate = cosine >= HIGH_COSINE
    plain = np.flatnonzero(~by_coordinate & (cosine <= 1))
    for lo in range(0, len(plain), 256):
        some = plain[lo:lo + 256]
        products = queries[some] @ vectors[:reach[some].max()].T
        for q, row in zip(some, products):
            ok = np.flatnonzero((row[:reach[q]] >= bounds[q]) & (ids[:reach[q]] != query_ids[q]))
            top = ok[best(row[ok], ids[ok], k)]
            yield q, ids[top], row[top]
    for q in np.flatnonzero(by_coordinate & (cosine <= 1)):
        direction = queries[q] / query_norms[q]
        left = np.arange(reach[q])
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            middle = direction[f] * cosine[q]
            spread = np.sqrt(max(0.0, 1 - cosine[q] ** 2) * max(0.0, 1 - direction[f] ** 2)) + SLACK
            value = unit[left, f]
            top_side = 1.0 if direction[f] >= cosine[q] else middle + spread
            low_side = -1.0 if -direction[f] >= cosine[q] else middle - spread
            left = left[(value <= top_side + SLACK) & (value >= low_side - SLACK)]
        row = vectors[left] @ queries[q]
        ok = np.flatnonzero((row >= bounds[q]) & (ids[left] != query_ids[q]))
        top = ok[best(row[ok], ids[left][ok], k)]
        yield q, ids[left][top], row[top]


def top_k(rows: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, bucket_rows: int = BUCKET_ROWS,
          query_rows: int = QUERY_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``queries`` (a condition on ``vec_id``) holds."""
    base = stage_table(integer_vectors(rows, id_col, vector_col), "topk-vectors")
    spark = rows.sparkSession
    total, width, longest_vector, cuts = base.agg(F.count("*"), F.max(F.size("vec")), F.max("norm"), F.percentile_approx(
        "norm", [i / NORM_RANGES for i in range(1, NORM_RANGES)], 10_000)).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], result)
    if longest_vector * longest_vector > EXACT:
        raise ValueError("inner products of these vectors are too large to be exact")
    width = max(width, 1)
    ranges = min(NORM_RANGES, -(-total // bucket_rows))
    cuts = sorted({cuts[i * NORM_RANGES // ranges - 1] for i in range(1, ranges)})
    # the first bound: the longest vectors, a bounded number of them
    seeds = base.orderBy(F.desc("norm"), "vec_id").limit(seed_rows).select("vec_id", "vec").toArrow()
    seed_ids, seed_vectors = seeds.column("vec_id").to_numpy(), _matrix(seeds.column("vec"), width)

    def bound(batches):
        for b in batches:
            own, products = b.column("vec_id").to_numpy(), _matrix(b.column("vec"), width) @ seed_vectors.T
            products[own[:, None] == seed_ids[None, :]] = -np.inf
            products = np.concatenate([products, np.full((len(own), k), -np.inf)], axis=1)
            kth = -np.partition(-products, k - 1, axis=1)[:, k - 1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kth)], ["vec_id", "vec", "norm", "bound"])

    asked = base.filter(queries)
    parts = max(1, -(-asked.count() // query_rows))
    asked = stage_table(asked.mapInArrow(releasing(bound), "vec_id long, vec array<double>, norm double, bound double")
                        .select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), "vec", "norm", "bound", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")), "topk-queries")
    band = F.lit(0)
    for c in cuts:
        band = band + (F.col("norm") > c).cast("int")
    banded = base.withColumn("band", band)
    sizes = {r[0]: (r[1], r[2]) for r in banded.groupBy("band").agg(F.count("*"), F.max("norm")).collect()}  # at most NORM_RANGES rows
    salts = F.array(*[F.lit(-(-sizes.get(b, (0, 0.0))[0] // bucket_rows)) for b in range(len(cuts) + 1)])
    longest = F.array(*[F.lit(float(sizes.get(b, (0, 0.0))[1])) for b in range(len(cuts) + 1)])
    dealt = (banded.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.get(salts, F.col("band"))).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("band", "salt", "part", "vec_id", "vec"))
    reached = F.filter(F.sequence(F.lit(0), F.lit(len(cuts))), lambda b: F.col("bound") <= F.col("norm") * F.get(longest, b) * (1 + SLACK) + SLACK)
    met = (asked.withColumn("band", F.explode(reached)).withColumn("salts", F.get(salts, F.col("band"))).filter("salts > 0")
           .withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).select("band", "salt", "part", "query", "query_id", "vec", "bound"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [] if not left.num_rows or not right.num_rows else list(search_bucket(
            _matrix(right.column("vec"), width), right.column("query_id").to_numpy(), right.column("bound").to_numpy(),
            _matrix(left.column("vec"), width), left.column("vec_id").to_numpy(), k))
        own, query = right.column("query_id").to_numpy(), right.column("query").to_numpy()
        return pa.table({"query": np.concatenate([np.full(len(i), query[q], np.int64) for q, i, _ in found] or [np.empty(0, np.int64)]),
                         "query_id": np.concatenate([np.full(len(i), own[q], np.int64) for q, i, _ in found] or [np.empty(0, np.int64)]),
                         "vec_id": np.concatenate([i for _, i, _ in found] or [np.empty(0, np.int64)]).astype(np.int64),
                         "score": np.concatenate([s for _, _, s in found] or [np.empty(0)]).astype(np.int64)})

    keys = ["band", "salt", "part"]
    hits = dealt.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(search, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

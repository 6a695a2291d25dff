"""Vector neighbours, their gate, and fusion with lexical results (FT-14 to FT-17)."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules["gristmill"])

K = 40
CEILING, MARGIN, UNANCHORED = 0.92, 0.16, 0.74  # distances of the gate: tuned to one embedding, so parameters
LEXICAL_WEIGHT, VECTOR_WEIGHT, RRF_K = 0.30, 1.0, 60


def distance(a: Column, b: Column) -> Column:
    """L2 distance in doubles."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, d: s + d))


def nearest(vectors: DataFrame, query: list[float], k: int = K, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k nearest by brute force: a scan and a top-k, no exchange of vectors."""
    rows = vectors.select(key, distance(F.col(vector), F.array(*(F.lit(float(x)) for x in query))).alias("dist"))
    return rows.orderBy("dist", key).limit(k)


TILE = 4_000_000  # approximate distances that a task holds at a time: 32 MB of doubles


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows of doubles. NaN stands where one has no such element; a null vector has none."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), np.nan)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def exact(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """L2 distances of one vector to many, summed in order of the elements; those that either lacks don't count, and with none in common there is no distance (NaN)."""
    total, common = np.zeros(len(rows)), np.zeros(len(rows), bool)
    for j in range(min(len(q), rows.shape[1])):
        d = rows[:, j] - q[j]
        there = ~np.isnan(d)
        total += np.where(there, d * d, 0.0)
        common |= there
    return np.where(common, np.sqrt(total), np.nan)


def nearest_in(q: np.ndarray, v: np.ndarray, keys: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows of `v`, distances) of the k nearest by exact distance, then key; vectors without a distance come last.

    A product of matrices bounds each distance; those within its error of the k-th are computed again one by one.
    """
    out, width = [], max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=np.nan) for x in (q, v))
    whole = np.isfinite(v).all(axis=1)
    odd, even = np.flatnonzero(~whole), np.flatnonzero(whole)
    plain = v[even]
    squares, step = (plain * plain).sum(axis=1), max(1, TILE // max(1, len(v)))
    for begin in range(0, len(q), step):
        tile = q[begin : begin + step]
        own = (tile * tile).sum(axis=1)
        near = own[:, None] + squares - 2.0 * (tile @ plain.T)
        some = len(even) > k
        border = np.partition(near, k - 1, axis=1)[:, k - 1] if some else None
        slack = 1e-13 * (width + 8) * (own + squares.max(initial=0.0))
        for i in range(len(tile)):
            sure = some and np.isfinite(own[i]) and np.isfinite(border[i])
            at = np.concatenate((even[near[i] <= border[i] + slack[i]], odd)) if sure else np.arange(len(v))
            dist = exact(tile[i], v[at])
            best = np.lexsort((keys[at], dist))[:k]  # NaN is last
            out.append((begin + i, at[best], dist[best]))
    return out


def nearest_to_each(queries: DataFrame, vectors: DataFrame, k: int = K, block: int = 8_192, share: int = 8_192) -> DataFrame:
    """(query_id, vec_id, dist, rank), exact for any number of queries: a task holds a block of queries against a share of the vectors, and sends k for each query on. What a task holds is bounded by both."""
    blocks, shares = max(1, -(-queries.count() // block)), max(1, -(-vectors.count() // share))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("query_id", F.col("embedding").alias("q"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")).withColumn("share", each(shares))
    v = vectors.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(shares)).cast("int").alias("share")).withColumn("block", each(blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, keys = left["query_id"], right["vec_id"]
        order = np.argsort(pa.compute.sort_indices(keys).to_numpy())  # a key's place among the keys
        found = nearest_in(matrix(left["q"]), matrix(right["embedding"]), order, k) if left.num_rows and right.num_rows else []
        of = np.repeat([i for i, _, _ in found], [len(at) for _, at, _ in found]).astype(np.int64)
        at, dist = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in (1, 2))
        return pa.table({"query_id": ids.take(pa.array(of)), "vec_id": keys.take(pa.array(at.astype(np.int64))), "dist": pa.array(dist, pa.float64(), from_pandas=True)})

    schema = T.StructType([T.StructField("query_id", q.schema["query_id"].dataType), T.StructField("vec_id", v.schema["vec_id"].dataType), T.StructField("dist", T.DoubleType())])
    near = q.groupBy("block", "share").cogroup(v.groupBy("block", "share")).applyInArrow(run, schema)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.asc_nulls_last("dist"), "vec_id"))).where(F.col("rank") <= k)


def gated(hits: DataFrame, ceiling: float = CEILING, margin: float = MARGIN, unanchored: float = UNANCHORED, anchored: Column | None = None) -> DataFrame:
    """Hits near enough, near the best one, and with a query term in sight unless they are very near (FLT-16, FLT-17). Hits are k rows."""
    best = F.min("dist").over(Window.partitionBy(F.lit(0)))
    out = hits.withColumn("best", best).where((F.col("dist") <= ceiling) & (F.col("dist") - F.col("best") <= margin))
    return out if anchored is None else out.where(anchored | (F.col("dist") <= unanchored))


def filled(lexical: DataFrame, vector: DataFrame, limit: int) -> DataFrame:
    """Lexical order first, free places filled by vector rank (FT-16). Both (doc_id, pos)."""
    both = lexical.select("doc_id", "pos", F.lit(0).alias("src")).unionByName(vector.select("doc_id", "pos", F.lit(1).alias("src")))
    first = both.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("src", "pos"))).where("n = 1")
    return first.orderBy("src", "pos").limit(limit).select("doc_id", "src", "pos")


def fused(lexical: DataFrame, vector: DataFrame, limit: int, k: int = RRF_K) -> DataFrame:
    """Weighted reciprocal ranks (FT-17); on ties lexical rows come first. Both (doc_id, pos) from 0."""
    a, b = lexical.select("doc_id", F.col("pos").alias("lex")), vector.select("doc_id", F.col("pos").alias("vec"))
    score = F.coalesce(LEXICAL_WEIGHT / (k + F.col("lex")), F.lit(0.0)) + F.coalesce(VECTOR_WEIGHT / (k + F.col("vec")), F.lit(0.0))
    rows = a.join(b, "doc_id", "full").withColumn("score", score)
    return rows.orderBy(F.desc("score"), F.asc_nulls_last("lex"), F.asc_nulls_last("vec")).limit(limit)

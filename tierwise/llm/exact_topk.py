"""Operator 8: exact top-k by integer inner product with norm-bucketed retrieval.

Components become ``floor(1024 * x)``. Vectors are grouped into length classes (an eighth of a power of two wide), and each class
into buckets of a bounded number of bytes; a bucket keeps its greatest length. Queries are taken in blocks.

1. Each query block meets the few longest buckets; its k-th best scores there are lower bounds ``theta``.
2. A bucket is paired with a query block only if its greatest length times a query's length can reach ``theta``. Within a pair,
   ``theta / (|q| * bucket length)`` is the cosine a vector must reach: from :data:`COORDINATE_FROM` up, vectors are first
   cut by the range which that cosine leaves for the query's largest coordinates; below, by their length alone.
   What is left is verified by exact integer products.
3. The k best per query of all buckets are merged, ties to the smaller id.

Edge cases: vectors that are NULL, empty or hold a NULL or non-finite component take no part; zero vectors score 0; only
vectors of equal dimension are compared; rows alike in id and vector count once, and rows that share an id are one vector
with several readings (best score counts; a row never meets its own id); NULL ids take no part; components are kept as 32-bit integers
where a whole vector fits in them, else as 64-bit ones, and products that may pass 63 bits are summed as Python's integers; a component or
score beyond 64 bits has no place in the result and fails the job; fewer candidates than k give fewer rows; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, read_table
from .graph import SALTS
from .vectors import by_dimension

SCALE = 1024
CLASSES_PER_DOUBLING = 8
BUCKET_BYTES, QUERY_BYTES = 1 << 16, 1 << 15    # of 32-bit components in one bucket, one query block
FIRST_BUCKETS = 4
COORDINATE_FROM = 0.8
FOCUS = 3


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("vec_id").to_numpy(zero_copy_only=False)
        for rows, x in by_dimension(b.column("embedding")):
            q = np.floor(SCALE * x)
            if np.abs(q).max() >= 2.0 ** 63:
                raise OverflowError("a scaled component doesn't fit in 64 bits")
            q = q.astype(np.int64)
            length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
            group = np.where(length > 0, np.floor(CLASSES_PER_DOUBLING * np.log2(np.maximum(length, 1))), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[rows].astype(np.int64)), pa.array(np.full(len(rows), x.shape[1], np.int32)),
                pa.array(group.astype(np.int32)), pa.array([_bytes(v) for v in q], pa.binary())],
                names=["id", "dim", "class", "v"])


def _bytes(v: np.ndarray) -> bytes:
    """Integers in 32 bits each where all fit, else in 64."""
    small = v.astype(np.int32)
    return (small if (small == v).all() else v).tobytes()


def _matrix(raw, n: int, dim: int) -> np.ndarray:
    """``n`` vectors written by :func:`_bytes`, all of one width."""
    return np.frombuffer(raw, dtype=np.int32 if len(memoryview(raw)) == 4 * n * dim else np.int64).reshape(n, dim)


def _block(table: pa.Table) -> pa.Table:
    """All rows of one (dim, class, part) in one row, rows alike only once."""
    key = [table.column(n)[0].as_py() for n in ("dim", "class", "part")]
    rows = sorted(set(zip(*(table.column(n).to_pylist() for n in ("id", "v", "theta")))), key=lambda r: r[:2])
    ids, theta = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.float64)
    q = np.concatenate([_matrix(r[1], 1, key[0]) for r in rows])          # of the wider type if widths differ
    v = q.tobytes()
    length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    # The least bucket length with which some query of the block can reach its bound.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(theta > 0, theta / length, -np.inf)
    return pa.table({**{n: pa.array([x], pa.int32()) for n, x in zip(("dim", "class", "part"), key)},
                     "longest": pa.array([float(length.max())]), "need": pa.array([float(np.min(need))]),
                     "ids": pa.array([ids.tobytes()], pa.binary()), "m": pa.array([v], pa.binary()),
                     "theta": pa.array([theta.tobytes()], pa.binary())})


_BLOCK = "dim int, class int, part int, longest double, need double, ids binary, m binary, theta binary"


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, dim, class, v, theta) gathered into blocks of about ``size`` bytes within equal (dim, class)."""
    parts = rows.groupBy("dim", "class").agg(F.ceil(F.count(F.lit(1)) * F.first("dim") * 4 / F.lit(size)).cast("int")
                                             .alias("parts"))
    keyed = rows.join(parts, ["dim", "class"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return keyed.select("dim", "class", "part", "id", "v", "theta").groupBy("dim", "class", "part").applyInArrow(_block, _BLOCK)


def _exact(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer products: in doubles where every partial sum is below 2**53, in 64-bit integers where it is below 2**63, else
    in Python's integers."""
    bound = np.abs(q.astype(np.float64)).max(initial=0) * np.abs(p.astype(np.float64)).max(initial=0) * q.shape[1]
    if bound >= 2.0 ** 62:
        return (q.astype(object) @ p.T.astype(object)).astype(np.int64)
    if bound < 2.0 ** 53:
        return (q.astype(np.float64) @ p.T.astype(np.float64)).astype(np.int64)
    return q.astype(np.int64) @ p.T.astype(np.int64)


def survivors(q: np.ndarray, p: np.ndarray, plen: np.ndarray, theta: float) -> np.ndarray:
    """Rows of a bucket that may score ``theta`` or more with query ``q`` (a superset, by the bucket's own way of pruning)."""
    qlen = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
    if theta <= 0 or qlen == 0:
        return np.arange(len(p))
    reach = qlen * float(plen.max(initial=0))
    if reach < theta:
        return np.zeros(0, dtype=np.int64)
    keep = plen * qlen >= theta * (1 - 1e-12)
    cosine = theta / reach
    if cosine >= COORDINATE_FROM:
        # A vector within angle a of the query has an angle to any axis within a of the query's own.
        unit = q / qlen
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            half = np.sqrt(max(0.0, 1 - unit[f] ** 2)) * np.sqrt(max(0.0, 1 - cosine ** 2)) + 1e-9
            x = p[:, f] / np.maximum(plen, 1e-300)
            if unit[f] >= -cosine:
                keep &= x >= unit[f] * cosine - half
            if unit[f] <= cosine:
                keep &= x <= unit[f] * cosine + half
    return np.flatnonzero(keep)


def _score(k: int):
    """Pairs of a bucket (ids, m) and a query block (qids, qm, theta) -> each query's k best of the bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for j in range(b.num_rows):
                dim = b.column("dim")[j].as_py()
                pid, qid = (np.frombuffer(b.column(x)[j].as_buffer(), dtype=np.int64) for x in ("ids", "qids"))
                p, q = (_matrix(b.column(x)[j].as_buffer(), len(of), dim) for x, of in (("m", pid), ("qm", qid)))
                theta = np.frombuffer(b.column("theta")[j].as_buffer(), dtype=np.float64)
                plen = np.sqrt((p.astype(np.float64) ** 2).sum(axis=1))
                for i in range(len(qid)):
                    at = survivors(q[i], p, plen, theta[i])
                    at = at[pid[at] != qid[i]]
                    s = _exact(q[i: i + 1], p[at])[0]
                    ok = s >= theta[i]
                    at, s = pid[at][ok], s[ok]
                    if len(s) > 4 * k:
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        at, s = at[s >= least], s[s >= least]
                    order = np.lexsort((at, -s))[:k]
                    out[0].append(np.full(len(order), qid[i]))
                    out[1].append(at[order])
                    out[2].append(s[order])
            cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols],
                                             names=["query_id", "vec_id", "score"])
    return run


def _best(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    one = scores.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _meet(pairs: DataFrame, blocks: DataFrame, buckets: DataFrame, k: int) -> DataFrame:
    """Score pairs (dim, block, class, part) of query blocks and buckets."""
    full = pairs.join(blocks, ["dim", "block"]).join(buckets.select("dim", "class", "part", "ids", "m"),
                                                     ["dim", "class", "part"])
    return full.select("dim", "ids", "m", "qids", "qm", "theta").mapInArrow(_score(k), "query_id long, vec_id long, score long")


def _query_blocks(queries: DataFrame, name: str) -> DataFrame:
    return materialise(_blocks(queries.withColumn("class", F.lit(0)), QUERY_BYTES).select(
        "dim", F.col("part").alias("block"), F.col("ids").alias("qids"), F.col("m").alias("qm"), "theta", "need"), name)


def top_k(vectors: DataFrame, k: int, is_query: Column) -> DataFrame:
    """(query_id, rank, vec_id, score): the exact ``k`` best of every row for which ``is_query`` (on column ``id``) holds."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = materialise(rows.mapInArrow(_quantise, "id long, dim int, class int, v binary"), "quantised") \
        .withColumn("theta", F.lit(float("-inf")))
    buckets = materialise(_blocks(rows, BUCKET_BYTES), "buckets")
    queries = rows.where(is_query)

    blocks = _query_blocks(queries, "query_blocks")
    longest = Window.partitionBy("dim").orderBy(F.col("longest").desc(), "class", "part")
    first = buckets.select("dim", "class", "part", "longest").withColumn("_r", F.row_number().over(longest)) \
        .where(F.col("_r") <= FIRST_BUCKETS).select("dim", "class", "part")
    seen = _meet(blocks.select("dim", "block").join(first, "dim"), blocks, buckets, k)
    theta = _best(seen, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"),
                                                            F.col("score").cast("double").alias("theta"))
    # A query with fewer than k candidates so far has no bound.
    queries = queries.drop("theta").join(theta, "id", "left").fillna({"theta": float("-inf")})

    blocks = _query_blocks(queries, "bounded_query_blocks")
    heads = blocks.select("dim", "block", "need", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    tails = buckets.select("dim", "class", "part", "longest", F.pmod(F.xxhash64("class", "part"), F.lit(SALTS)).cast("int")
                           .alias("_salt"))
    # The stated query set meets all buckets that its bounds leave, block by block.
    pairs = heads.join(tails, ["dim", "_salt"]).where(F.col("longest") * (1 + 1e-12) >= F.col("need")) \
        .select("dim", "block", "class", "part")
    return _best(_meet(pairs, blocks.drop("need"), buckets, k), k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), 10, F.col("id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

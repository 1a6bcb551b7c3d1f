"""Exact top-k inner products over norm-sorted blocks.

Vectors become integers ``floor(scale * x)``. Rows are range-partitioned by
descending length and packed into blocks; the stated queries are packed into
blocks too. Every query block meets the longest block first, which gives each
query a threshold: a score that k candidates reach. It then meets the other
blocks, where candidates are left out

* by length: ``|q| |c|`` is below the threshold (blocks and rows are sorted by
  length, so this cuts a tail), or
* by residual: the products of the first rotated dimensions plus the product of
  the residual lengths (Cauchy-Schwarz) are below it. The rotation is the SVD of
  all vectors, so the first dimensions hold most of the length.

What is left is scored with exact integers, so pruning never changes the result.
A task holds one query block and one candidate block; blocks have a fixed size.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; shorter vectors count as padded with zeros; rows that
share an id are rows of their own: each is a candidate of the others, and each query row has
its own ranking; rows without an id are candidates (and queries where ``is_query`` says so);
ties go to the smaller id (null last), then to the smaller vector;
fewer than k candidates give them all; an empty table gives no rows; extra columns
are ignored. Scores are 64-bit integers, as long as the true sums are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotplan.sinks.publish import dense_ids

from .common import settled

BLOCK_ROWS = 8192
QUERY_ROWS = 512
STRIP = 512          # candidates scored between two updates of the thresholds
_SLACK = 1e-6        # relative slack of floating-point bounds; scores are exact


def usable(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(row, vec_id, v): usable rows under a key of their own, components ``floor(scale * x)``.

    ``row`` counts from 1 in the order of (vec_id, null last; vector), so ties by ``row`` are
    ties by id.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    raw = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    good = raw.where(F.coalesce((F.size("x") > 0) & F.forall("x", finite), F.lit(False)))
    vecs = good.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"), F.col("vec_id").isNull().alias("_none"))
    return dense_ids(vecs, ["_none", "vec_id", "v"], "row").select("row", "vec_id", "v")


def _matrix(col, dims: int) -> np.ndarray:
    """Arrow list column of longs as a matrix with ``dims`` columns (zeros to the right)."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes = np.diff(col.offsets.to_numpy(zero_copy_only=False))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first (dims x dims).

    Tasks send one dims x dims sum each; Spark adds them up, and dims**2 numbers
    reach the driver.
    """
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            m = _matrix(b.column(0), dims).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["pos", "x"])

    sums = (vectors.select("v").mapInArrow(gram, "pos long, x double")
            .groupBy("pos").agg(F.sum("x").alias("x")).collect())
    full = np.zeros(dims * dims)
    for r in sums:
        full[r["pos"]] = r["x"]
    return np.linalg.eigh(full.reshape(dims, dims))[1][:, ::-1].copy()


def _packed(df: DataFrame, dims: int, rows: int) -> DataFrame:
    """Partitions as blocks of at most ``rows`` rows, in the order of the partition."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, ids, mats, have = TaskContext.get().partitionId(), 0, [], [], 0

        def block(i, m):
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k]), pa.array([len(i)], pa.int32()),
                 pa.array([float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max()))]),
                 pa.array([i.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                ["block", "n", "longest", "ids", "vecs"])

        for b in batches:
            ids.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            mats.append(_matrix(b.column(1), dims))
            have += b.num_rows
            while have >= rows:
                i, m = np.concatenate(ids), np.concatenate(mats)
                yield block(i[:rows], m[:rows])
                k, ids, mats, have = k + 1, [i[rows:]], [m[rows:]], have - rows
        if have:
            yield block(np.concatenate(ids), np.concatenate(mats))

    return df.mapInArrow(pack, "block long, n int, longest double, ids binary, vecs binary")


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; floating point only where every sum is exact in it."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2.0 ** 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def best_of(q_ids, q, theta, c_ids, c, rot: np.ndarray, head: int, k: int):
    """Per query of one block pair: the candidates that can be among its best k.

    Returns (query row, id, score) arrays, at most k per query. ``c`` is sorted by
    descending length; ``theta`` are scores that k other candidates already reach
    (-inf where none is known).
    """
    qr, cr = q.astype(np.float64) @ rot, c.astype(np.float64) @ rot
    q_len, c_len = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_rest, c_rest = np.linalg.norm(qr[:, head:], axis=1), np.linalg.norm(cr[:, head:], axis=1)
    theta = theta.astype(np.float64).copy()
    best: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q_ids]
    for lo in range(0, len(c), STRIP):
        hi = min(lo + STRIP, len(c))
        slack = _SLACK * (1 + q_len * c_len[lo:hi].max())
        live = np.flatnonzero(q_len * c_len[lo:hi].max() + slack >= theta)     # length bound
        if not len(live):
            continue
        bound = (qr[live, :head] @ cr[lo:hi, :head].T + np.outer(q_rest[live], c_rest[lo:hi])
                 + slack[live, None])
        keep = (bound >= theta[live, None]) & (q_ids[live, None] != c_ids[None, lo:hi])
        rows = np.flatnonzero(keep.any(axis=1))
        cols = np.flatnonzero(keep.any(axis=0))
        if not len(rows):
            continue
        live, keep = live[rows], keep[np.ix_(rows, cols)]
        scores = _products(q[live], c[lo:hi][cols])
        keep &= scores >= theta[live, None]
        ids = c_ids[lo:hi][cols]
        for r, at in enumerate(live):
            mine = keep[r]
            if not mine.any():
                continue
            s = np.concatenate([best[at][1], scores[r][mine]])
            i = np.concatenate([best[at][0], ids[mine]])
            if len(s) > k:
                order = np.lexsort((i, -s))[:k]
                s, i = s[order], i[order]
                theta[at] = max(theta[at], s[-1])
            elif len(s) == k:
                theta[at] = max(theta[at], s.min())
            best[at] = (i, s)
    size = [len(i) for i, _ in best]
    if not sum(size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (np.repeat(np.arange(len(q_ids)), size), np.concatenate([i for i, _ in best]),
            np.concatenate([s for _, s in best]))


def _scored(pairs: DataFrame, dims: int, rot: np.ndarray, head: int, k: int) -> DataFrame:
    """Rows (query_id, vec_id, score) of joined query and candidate blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q_ids = np.frombuffer(r["q_ids"], dtype=np.int64)
                q = np.frombuffer(r["q_vecs"], dtype=np.int64).reshape(-1, dims)
                theta = (np.full(len(q_ids), -np.inf) if r["q_theta"] is None
                         else np.frombuffer(r["q_theta"], dtype=np.float64))
                c_ids = np.frombuffer(r["ids"], dtype=np.int64)
                c = np.frombuffer(r["vecs"], dtype=np.int64).reshape(-1, dims)
                at, ids, scores = best_of(q_ids, q, theta, c_ids, c, rot, head, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    cols = ["q_ids", "q_vecs", "q_theta", "ids", "vecs"]
    return pairs.select(cols).mapInArrow(run, "query_id long, vec_id long, score long")


def _with_thetas(dims: int):
    """Adds to query blocks their thresholds and ``need``: the length a useful candidate has at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                known = {t["query_id"]: t["theta"] for t in r["thetas"] or [] if t["theta"] is not None}
                ids = np.frombuffer(r["q_ids"], dtype=np.int64)
                theta = np.array([known.get(i, -np.inf) for i in ids.tolist()], dtype=np.float64)
                size = np.linalg.norm(np.frombuffer(r["q_vecs"], dtype=np.int64).reshape(-1, dims).astype(np.float64), axis=1)
                need = np.where((theta > 0) & (size > 0), theta / np.maximum(size, 1e-300) * (1 - _SLACK) - _SLACK, -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["qb"]], pa.int64()), pa.array([r["q_ids"]], pa.binary()),
                     pa.array([r["q_vecs"]], pa.binary()), pa.array([theta.tobytes()], pa.binary()),
                     pa.array([float(need.min())])], ["qb", "q_ids", "q_vecs", "q_theta", "need"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 1024.0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row that ``is_query`` marks.

    ``is_query`` is an expression over ``vec_id``. All rows but the query's own are
    candidates.
    """
    spark = vectors.sparkSession
    named = settled(usable(vectors, id_col, vec_col, scale).withColumn("asked", F.coalesce(is_query, F.lit(False))), "topk-vectors")
    kind = named.schema["vec_id"].dataType.simpleString()
    n, dims, asked = named.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("asked")).first()
    if not n or not asked:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    names = named.select("row", "vec_id")
    rows, is_query = named.select(F.col("row").alias("vec_id"), "v", "asked"), F.col("asked")
    rot, head = rotation(rows, dims), max(1, dims // 4)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    blocks = settled(_packed(
        rows.select("vec_id", "v", length.alias("sq"))
        .repartitionByRange(max(1, -(-n // block_rows)), F.desc("sq"), "vec_id")
        .sortWithinPartitions(F.desc("sq"), "vec_id").select("vec_id", "v"), dims, block_rows), "topk-blocks")
    queries = settled(_packed(
        rows.where(is_query).repartition(max(1, -(-asked // query_rows)), "vec_id").select("vec_id", "v"),
        dims, query_rows).select(F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")),
        "topk-queries")
    # number the blocks by descending length (one light row per block_rows vectors)
    order = Window.orderBy(F.desc("longest"), "block")
    numbers = settled(blocks.select("block", "longest").withColumn("nr", F.row_number().over(order) - 1), "topk-numbers")
    n_blocks = numbers.count()

    # first the longest vectors: their k-th best score is a threshold for the rest
    top = blocks.join(F.broadcast(numbers.where("nr = 0").select("block")), "block", "left_semi").withColumn("nr", F.lit(0))
    seed = queries.withColumn("nr", F.lit(0)).withColumn("q_theta", F.lit(None).cast("binary")).join(F.broadcast(top), "nr")
    first = settled(_scored(seed, dims, rot, head, k), "topk-first")
    found = first
    if n_blocks > 1:
        kth = (first.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("least"))
               .select("query_id", F.when(F.col("c") >= k, F.col("least")).alias("theta")))
        thetas = (queries.select("qb", "q_ids").mapInArrow(_members, "qb long, query_id long")
                  .join(kth, "query_id", "left").groupBy("qb")
                  .agg(F.collect_list(F.struct("query_id", "theta")).alias("thetas")))      # query_rows at most
        ready = settled(queries.join(thetas, "qb", "left").mapInArrow(
            _with_thetas(dims), "qb long, q_ids binary, q_vecs binary, q_theta binary, need double"), "topk-ready")
        # pairs of block names first; pairs that the length bound rules out move no vectors
        block_names = (ready.select("qb", "need", F.explode(F.sequence(F.lit(1), F.lit(n_blocks - 1))).alias("nr"))
                 .join(numbers, "nr").where("longest >= need").select("qb", "block"))
        pairs = block_names.join(blocks, "block").join(ready, "qb")
        found = first.unionByName(_scored(pairs, dims, rot, head, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # back from row keys to ids
    asker = names.select(F.col("row").alias("query_id"), F.col("vec_id").alias("_q"))
    return (ranked.join(asker, "query_id").select(F.col("_q").alias("query_id"), "rank", F.col("vec_id").alias("row"), "score")
            .join(names, "row").select("query_id", "rank", "vec_id", "score"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for qb, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            i = np.frombuffer(ids, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), qb)), pa.array(i)], ["qb", "query_id"])


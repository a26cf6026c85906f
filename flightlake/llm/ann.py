"""Nearest neighbours by a block matrix join (operator 1).

Queries and candidates are dealt into groups of bounded size, and every pair of a
query group and a candidate group is one task input.  Inside it the vectors are
quantised to int8 with a scale of their own; tiles of integer products give every
approximate distance, and the quantisation errors bound the true one from both
sides (triangle inequality).  Only pairs whose lower bound reaches the k-th best
upper bound are recomputed from the original vectors in double precision.  A heap
per query keeps the best of all tiles of the task, and a window over
``(query, score, id)`` merges the tasks' heaps.  The result is exact.

Defined results: a vector that is null, empty, all zero, or holds a null or
non-finite component takes no part, neither does a row without id; vectors are only compared
with vectors of the same length; rows with the query's own id are never its
neighbours; repeated rows of other ids count once each; equal distances go to the
smaller id; fewer candidates than ``k`` give fewer rows; empty tables an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a query group and of a candidate group (a task input holds one of each).
QUERY_GROUP = 2048
CANDIDATE_GROUP = 8192
#: Candidates of one product tile.
TILE = 1024
#: int8 products are summed in float32, which is exact up to so many components.
EXACT_WIDTH = 1024

_OUT = "query_id long, vec_id long, score double"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows whose vector takes part, as ``(vec_id, embedding, width)``."""
    v = F.col(vector_col).cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) \
        & F.exists(v, lambda x: x != 0)
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(good)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding"),
                    F.size(v).alias("width")))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the coded vectors and lengths of the errors."""
    scale = np.abs(x).max(axis=1) / 127.0
    tiny = scale < 1e-290  # a scale that would underflow: code 0, the whole vector is error
    codes = np.rint(x / np.where(tiny, 1.0, scale)[:, None])
    codes[tiny] = 0
    coded = codes * scale[:, None]
    error = np.linalg.norm(x - coded, axis=1)
    return codes.astype(np.int8), scale, np.linalg.norm(coded, axis=1), error


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, as doubles."""
    out = np.zeros((len(a), len(b)))
    for j in range(0, a.shape[1], EXACT_WIDTH):
        out += a[:, j:j + EXACT_WIDTH].astype(np.float32) @ b[:, j:j + EXACT_WIDTH].astype(np.float32).T
    return out


def exact_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, components added in order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - y[:, j]
        total += d * d
    return np.sqrt(total)


def search_group(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[list]:
    """The ``k`` nearest candidates of every query: lists of ``(-score, -id)`` heaps."""
    heaps: list[list] = [[] for _ in q_ids]
    limit = np.full(len(q_ids), np.inf)
    qc, qs, qn, qe = quantise(q)
    for lo in range(0, len(c_ids), TILE):
        ids, part = c_ids[lo:lo + TILE], c[lo:lo + TILE]
        cc, cs, cn, ce = quantise(part)
        sq = qn[:, None] ** 2 + cn[None, :] ** 2 - 2.0 * (qs[:, None] * cs[None, :]) * int8_products(qc, cc)
        # rounding of the three terms, then of the root
        slack = 1e-12 * (qn[:, None] ** 2 + cn[None, :] ** 2)
        err = (qe[:, None] + ce[None, :]) * (1 + 1e-12)
        low = np.sqrt(np.maximum(sq - slack, 0.0)) - err
        high = np.sqrt(np.maximum(sq + slack, 0.0)) + err
        own = q_ids[:, None] == ids[None, :]
        high[own] = np.inf
        if len(ids) > k:
            limit = np.minimum(limit, np.partition(high, k - 1, axis=1)[:, k - 1] * (1 + 1e-12))
        rows, cols = np.nonzero((low <= limit[:, None]) & ~own)
        if not len(rows):
            continue
        scores = exact_distance(q[rows], part[cols])
        for r, s, i in zip(rows.tolist(), scores.tolist(), ids[cols].tolist(), strict=True):
            item, heap = (-s, -i), heaps[r]
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        for r in np.unique(rows).tolist():
            if len(heaps[r]) == k:
                limit[r] = min(limit[r], -heaps[r][0][0] * (1 + 1e-12))
    return heaps


def _matrix(table: pa.Table) -> np.ndarray:
    col = table.column("embedding").combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _tiles(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    q_out: list[int] = []
    v_out: list[int] = []
    s_out: list[float] = []
    if left.num_rows and right.num_rows:
        q_ids, c_ids = (t.column("vec_id").to_numpy() for t in (left, right))
        for qid, heap in zip(q_ids.tolist(), search_group(q_ids, _matrix(left), c_ids, _matrix(right), k), strict=True):
            for s, i in heap:
                q_out.append(qid)
                v_out.append(-i)
                s_out.append(-s)
    return pa.table({"query_id": pa.array(q_out, pa.int64()), "vec_id": pa.array(v_out, pa.int64()),
                     "score": pa.array(s_out, pa.float64())})


def block_matrix_join(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id",
                      vector_col: str = "embedding", query_group: int = QUERY_GROUP,
                      candidate_group: int = CANDIDATE_GROUP) -> DataFrame:
    """The ``k`` nearest rows of ``candidates`` for every row of ``queries``.

    Returns ``query_id, rank, vec_id, score``.  Two counts size the groups; a group
    holds about ``query_group`` or ``candidate_group`` vectors at any input size.
    Query ids are taken as distinct (a repeated query row is one query).
    """
    q = usable(queries, id_col, vector_col).dropDuplicates(["vec_id"])
    c = usable(candidates, id_col, vector_col)
    n_q = max(1, -(-queries.count() // query_group))
    n_c = max(1, -(-candidates.count() // candidate_group))
    own_q = F.pmod(F.xxhash64("vec_id"), F.lit(n_q)).cast("int")
    own_c = F.pmod(F.xxhash64("vec_id"), F.lit(n_c)).cast("int")
    q = q.withColumn("qg", own_q).withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    c = c.withColumn("cg", own_c).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    keys = ("width", "qg", "cg")
    best = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(partial(_tiles, k=k), schema=_OUT)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

"""Exact top-k inner products over a vector-approximation file.

Vectors are packed into blocks. A block keeps, for each dimension, a grid of equal cells between the block's least and
largest component, the cell number of every component in one byte, and the exact components. A task holds a few blocks,
and blocks of queries stream past them. A search scans the cells, which bound every score from below and above, and then
reads exact vectors in the order of their upper bounds until the k-th exact score beats every bound that is left. Each
block gives its own k best, and a window merges those of a query. The work is the stated query set against all rows.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do rows with a null id.
Rows that share the query's id are the query's own. Repeated rows are candidates each. A query is an id with a vector:
one that repeats with the same vector counts once, and an id with several vectors is a query for each of them, told
apart by ``query_hash``. Vectors of different lengths do not compare; a vector may be as long as a row can be. Ties go to
the smaller id. Scores are exact while they fit 63 bits. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import met, table, written

#: Rows in a block of vectors, in a block of queries, and cells for each dimension.
BLOCK_ROWS, QUERY_ROWS, CELLS = 4096, 512, 64
#: Blocks that a task holds while queries stream past them, about, and rows of queries that are packed by one task.
LANE_BLOCKS, PACKED_QUERIES = 4, 16_384

_BLOCK = "lane int, dim int, n int, kind string, ids binary, low binary, width binary, cells binary, exact binary"
_QUERIES = "dim int, n int, kind string, ids binary, hashes binary, exact binary"


def usable(vec: Column) -> Column:
    """Whether a vector takes part: no null, NaN or infinite component, and not null itself."""
    inf = float("inf")
    return F.coalesce(~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (x == inf) | (x == -inf)), F.lit(False))


def _small(x: np.ndarray) -> np.ndarray:
    for kind in ("i1", "i2", "i4"):
        info = np.iinfo(kind)
        if not x.size or (x.min() >= info.min and x.max() <= info.max):
            return x.astype(f"<{kind}")
    return x.astype("<i8")


def _groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, hashes and components of at most ``rows`` rows with vectors of one length."""
    for batch in batches:
        ids, hashes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        sizes = np.diff(ends)
        for dim in np.unique(sizes):
            (at,) = np.nonzero(sizes == dim)
            for i in range(0, len(at), rows):
                part = at[i : i + rows]
                yield ids[part], hashes[part], flat[ends[part][:, None] + np.arange(dim)].astype(np.int64).reshape(len(part), dim)


def _pack_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    lane = TaskContext.get().partitionId()
    for ids, _, x in _groups(batches, BLOCK_ROWS):
        low = x.min(axis=0)
        width = np.maximum(1, -(-(x.max(axis=0) - low + 1) // CELLS))
        cells, exact = ((x - low) // width).astype(np.uint8), _small(x)
        row = [lane, x.shape[1], len(ids), exact.dtype.str, ids.astype("<i8").tobytes(), low.tobytes(), width.tobytes(), cells.tobytes(), exact.tobytes()]
        names = ["lane", "dim", "n", "kind", "ids", "low", "width", "cells", "exact"]
        kinds = [pa.int32()] * 3 + [pa.string()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, hashes, x in _groups(batches, QUERY_ROWS):
        exact = _small(x)
        row = [x.shape[1], len(ids), exact.dtype.str, ids.astype("<i8").tobytes(), hashes.astype("<i8").tobytes(), exact.tobytes()]
        kinds = [pa.int32()] * 2 + [pa.string()] + [pa.binary()] * 3
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["dim", "n", "kind", "ids", "hashes", "exact"])


def _best(q: np.ndarray, own: int, bounds: np.ndarray, slack: float, ids: np.ndarray, exact: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of a block for one query; ``bounds`` are mid-cell scores, ``slack`` their error."""
    others = ids != own
    n = int(others.sum())
    if n == 0:
        return ids[:0], np.zeros(0, dtype=np.int64)
    mid = np.where(others, bounds, -np.inf)
    if n > k:
        floor = np.partition(mid, len(mid) - k)[len(mid) - k] - slack  # k rows score at least this
        (near,) = np.nonzero(mid + slack >= floor)
    else:
        (near,) = np.nonzero(others)
    near = near[np.argsort(-mid[near], kind="stable")]
    got_ids, got = ids[:0], np.zeros(0, dtype=np.int64)
    for i in range(0, len(near), 4 * k):
        if len(got) >= k and got[k - 1] > mid[near[i]] + slack:
            break  # the k-th exact score beats all bounds that are left
        part = near[i : i + 4 * k]
        got_ids = np.concatenate([got_ids, ids[part]])
        got = np.concatenate([got, exact[part].astype(np.int64) @ q])
        order = np.lexsort((got_ids, -got))[:k]
        got_ids, got = got_ids[order], got[order]
    return got_ids, got


def _scan(k: int):
    def scan(block: dict, asked: dict) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        q_ids, q_hashes = np.frombuffer(asked["ids"], "<i8"), np.frombuffer(asked["hashes"], "<i8")
        if block["dim"] == asked["dim"]:
            d, n, m = block["dim"], block["n"], asked["n"]
            ids, exact = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["exact"], block["kind"]).reshape(n, d)
            q = np.frombuffer(asked["exact"], asked["kind"]).reshape(m, d).astype(np.int64)
            low, width = np.frombuffer(block["low"], "<i8"), np.frombuffer(block["width"], "<i8")
            middle = np.frombuffer(block["cells"], np.uint8).reshape(n, d) * width.astype(float) + (low + (width - 1) / 2)
            scores = q.astype(float) @ middle.T
            slack = np.abs(q).astype(float) @ ((width - 1) / 2)
            # rounding of the float sums, which are exact for small components
            slack = slack + (np.abs(q).astype(float) @ np.abs(middle).max(axis=0, initial=0)) * 1e-12
            out = [_best(q[i], q_ids[i], scores[i], slack[i], ids, exact, k) for i in range(m)]
        else:
            q_ids, q_hashes = q_ids[:0], q_hashes[:0]
        times = [len(a) for a, _ in out]
        flat = lambda parts: pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *parts]).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(q_ids, times).astype(np.int64)), pa.array(np.repeat(q_hashes, times).astype(np.int64)), flat([a for a, _ in out]), flat([s for _, s in out])], names=["query_id", "query_hash", "id", "score"]
        )

    return scan


def _rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vector = F.col(vec_col).cast("array<bigint>")
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.xxhash64(vector).alias("h"))


def build(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """The blocks of every usable row; ``vec_col`` holds integers. Written to the shared folder."""
    rows = _rows(df, id_col, vec_col)
    lanes = max(1, math.ceil(rows.count() / (BLOCK_ROWS * LANE_BLOCKS)))
    return written(rows.repartition(lanes).mapInArrow(_pack_vectors, _BLOCK), "va-file")


def search(index: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """query_id, query_hash, rank, id, score: the ``k`` best rows of ``index`` for every different row of ``queries``."""
    q = _rows(queries, id_col, vec_col).distinct()
    packed = written(q.repartition(max(1, math.ceil(q.count() / PACKED_QUERIES))).mapInArrow(_pack_queries, _QUERIES), "va-queries")
    last = index.agg(F.max("lane").alias("last")).first()["last"]
    found = met(index, packed, 1 if last is None else last + 1, _scan(k), "query_id long, query_hash long, id long, score long")
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "query_hash", "rank", "id", "score")


def op9_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best rows by integer inner product for each row of ``embeddings`` whose vec_id is divisible by 20.

    A vec_id with several vectors has a ranking for each of them.
    """
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").where(usable(F.col("embedding")))
    whole = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double"))).alias("v"))
    found = search(build(whole, "vec_id", "v"), whole.where(F.col("vec_id") % 20 == 0), "vec_id", "v", 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP9_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, q.v AS query, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT vec_id, v FROM e WHERE vec_id % 20 = 0) q JOIN e c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

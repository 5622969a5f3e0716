"""Exact top-k search by inner product with block-at-a-time pruning.

Components become integers floor(scale * x). The rows are an index of tiles;
a tile is a range of at most ``TILE_ROWS`` documents, kept as one row: ids, the
vectors as one binary matrix (the forward index) and, for blocks of ``BLOCK``
documents, the largest and smallest component per dimension. Inside a tile the
documents are put in an order in which neighbours are alike (halved again and
again along the widest dimension), so that blocks are tight.

A query's terms are its components: a positive one is worth at most itself
times a block's largest component, a negative one itself times the smallest.
Summed up, that bounds every score in the block. Per query the blocks of a
tile are visited by falling bound, in waves; a wave scores whole blocks through
their forward index against all queries that need them (one matrix product),
and a query stops when the next bound is below its k-th score so far. A block
whose bound equals that score is visited while it may hold an id smaller than
the k-th's, because ties go to the smaller id.

Queries are gathered into chunks of ``CHUNK`` and meet every tile once, by an
equi-join on the tile's slot; nothing passes the driver. Slots are searched in
rounds, each ``GROWTH`` times the one before: the k-th score over all earlier
rounds travels with the query as its threshold, so later tiles prune by the
corpus found so far and send only what can still be among the first k. Results
are exact whatever the rounds, tiles and blocks.

Products are exact: 32- or 64-bit floats where every partial sum fits their
integer range, else 64-bit integers.

Defined cases: vectors that are null, hold null or non-finite components or one
so large that a score might not fit 64 bits take no part; shorter vectors count
as padded with zeros; a null id is no query, as a candidate it comes last among
equal scores; rows of one id are queries (and candidates) each, and each leaves
out one row equal to itself; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fishladder.llm.common import prepare_workers, work_dir, write_table
from fishladder.llm.vector_codes import _buffered, _column, as_integers

SCALE, K, QUERY_STEP = 64, 20, 20
TILE_ROWS, LEAST_TILE, BLOCK, CHUNK = 1 << 16, 1 << 11, 64, 1024
GROWTH = 8
PENDING = 1 << 20
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


def packed(x: np.ndarray) -> tuple[bytes, int]:
    """A matrix of integers as bytes of the narrowest type that holds them, and its width."""
    largest = int(np.abs(x).max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if largest < 1 << (8 * w - 1))
    return np.ascontiguousarray(x, f"<i{width}").tobytes(), width


def unpacked(data: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(rows, -1)


def similar_order(x: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Order of rows in which blocks are alike: ranges are halved along their widest dimension."""
    order, work = np.arange(len(x)), [(0, len(x))]
    while work:
        lo, hi = work.pop()
        if hi - lo <= block or not x.shape[1]:
            continue
        own = x[order[lo:hi]]
        dim = int(np.argmax(own.astype(np.float64).var(axis=0)))
        half = -(-(hi - lo) // (2 * block)) * block          # cuts fall between blocks
        order[lo:hi] = order[lo:hi][np.argsort(own[:, dim], kind="stable")]
        work += [(lo, lo + half), (lo + half, hi)]
    return order


def maxima(x: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest component per block and dimension."""
    first = np.arange(0, len(x), block)
    return np.maximum.reduceat(x, first, axis=0), np.minimum.reduceat(x, first, axis=0)


class Best:
    """The k best (score, id) of some queries, smaller ids first among equals.

    Only a score above ``floor``, or equal to it with an id below ``last``, can
    still be among the first k."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor, self.last = k, floor.copy(), np.full(n, NO_ID)
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def open(self, query, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        floor = self.floor[query]
        return (score > floor) | ((score == floor) & (ids < self.last[query]))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        kth = rank == self.k - 1
        q, s, i = query[kth], score[kth], ids[kth]
        self.last[q] = np.where(s > self.floor[q], i, np.where(s == self.floor[q], np.minimum(i, self.last[q]), self.last[q]))
        self.floor[q] = np.maximum(self.floor[q], s)
        keep = rank < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]


def search_tile(queries: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, hi: np.ndarray, lo: np.ndarray,
                k: int, block: int = BLOCK) -> tuple[Best, int]:
    """The k best documents of a tile per query, as far as they reach ``floor``,
    and the number of (query, block) pairs scored."""
    top = int(np.abs(queries).max(initial=0)) * max(int(np.abs(hi).max(initial=0)), int(np.abs(lo).max(initial=0)))
    sums = top * max(1, queries.shape[1])
    kind = np.float32 if sums < 1 << 24 else np.float64 if sums < 1 << 53 else np.int64
    q, docs = queries.astype(kind), x.astype(kind)
    bounds = (np.maximum(q, 0) @ hi.astype(kind).T + np.minimum(q, 0) @ lo.astype(kind).T).astype(np.int64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, axis=1)
    least_id = np.minimum.reduceat(ids, np.arange(0, len(ids), block))[order]
    best, at, scored, every = Best(len(q), k, floor), 0, 0, np.arange(len(q))[:, None]
    while at < order.shape[1]:
        upto = max(at + max(1, -(-k // block)), 3 * at)
        need = best.open(every, ranked[:, at:upto], least_id[:, at:upto])
        if not (ranked[:, at] >= best.floor).any():
            break                                         # bounds fall along a row
        who, what = np.nonzero(need)
        what = order[:, at:upto][who, what]
        by_block = np.argsort(what, kind="stable")
        who, what = who[by_block], what[by_block]
        starts = np.flatnonzero(np.r_[True, what[1:] != what[:-1]][:len(what)])
        found, pending = [], 0
        for s, e in zip(starts, np.r_[starts[1:], len(what)]):
            own, b = who[s:e], slice(what[s] * block, (what[s] + 1) * block)
            scores = (q[own] @ docs[b].T).astype(np.int64)
            r, c = np.nonzero(best.open(own[:, None], scores, ids[b][None, :]))
            found.append((own[r], scores[r, c], ids[b][c]))
            pending += len(r)
            if pending > PENDING or e == len(what):       # many equal scores: keep the best of them before going on
                best.add(*(np.concatenate(f) for f in zip(*found)))
                found, pending = [], 0
        scored += len(who)
        at = upto
    return best, scored


# --- jobs -----------------------------------------------------------------------------------

def limit_for(dims: int) -> int:
    """Largest component with which no score of ``dims`` products leaves 64 bits."""
    return math.isqrt((1 << 62) // max(1, dims))


def _tables(df: DataFrame, is_query: Column, id_col: str, vec_col: str, scale: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(index, queries): one row per tile and per chunk of queries, written."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))

    def tiles(batches):
        from pyspark import TaskContext
        task, made = TaskContext.get().partitionId(), 0
        for t in _buffered(batches, tile_rows):
            rows, x = as_integers(_column(t, "v"), scale)
            small = np.abs(x).max(axis=1, initial=0) <= limit_for(x.shape[1])
            rows, x = rows[small], x[small]
            ids = _column(t, "id").fill_null(NO_ID).to_numpy()[rows]
            asked = np.flatnonzero(_column(t, "q").to_numpy(zero_copy_only=False)[rows] & (ids != NO_ID))
            out = [(False, *part) for part in _slices(x, ids, tile_rows, similar_order(x))]
            out += [(True, *part) for part in _slices(x, ids, CHUNK, asked)]
            for asks, i, v in out:
                hi, lo = maxima(v)
                data, width = packed(v)
                yield pa.RecordBatch.from_pydict({
                    "asks": [asks], "key": [(task << 32) + made], "n": pa.array([len(i)], pa.int32()), "dims": pa.array([v.shape[1]], pa.int32()),
                    "ids": [i.astype("<i8").tobytes()], "width": pa.array([width], pa.int32()), "x": [data],
                    "hi": [hi.astype(f"<i{width}").tobytes()], "lo": [lo.astype(f"<i{width}").tobytes()]})
                made += 1

    schema = "asks boolean, key long, n int, dims int, ids binary, width int, x binary, hi binary, lo binary"
    both = write_table(src.mapInArrow(tiles, schema), work_dir(spark, "topk-index"))
    return both.where("NOT asks").drop("asks"), both.where("asks").select("key", "n", "dims", "ids", "width", "x")


def _slices(x: np.ndarray, ids: np.ndarray, rows: int, order: np.ndarray):
    for at in range(0, len(order), rows):
        own = order[at:at + rows]
        yield ids[own], x[own]


def _pad(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dims - x.shape[1]))) if x.shape[1] < dims else x


FOUND = "chunk long, query int, query_id long, self_score long, vec_id long, score long"


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Candidates of every (chunk of queries, tile)."""
    def scan(batches):
        for b in batches:
            for r in b.to_pylist():
                dims = max(r["dims"], r["q_dims"])
                x, q = _pad(unpacked(r["x"], r["width"], r["n"]), dims), _pad(unpacked(r["q_x"], r["q_width"], r["q_n"]), dims)
                hi, lo = (_pad(unpacked(r[c], r["width"], -(-r["n"] // BLOCK)), dims) for c in ("hi", "lo"))
                floor = np.full(r["q_n"], LEAST) if r["floor"] is None else np.array(r["floor"], np.int64)
                best, _ = search_tile(q, floor, x, np.frombuffer(r["ids"], "<i8"), hi, lo, k)
                own = (q.astype(np.int64) ** 2).sum(axis=1)
                asks = np.frombuffer(r["q_ids"], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.query), r["chunk"])), pa.array(best.query.astype(np.int32)), pa.array(asks[best.query]),
                     pa.array(own[best.query]), pa.array(best.id, mask=best.id == NO_ID), pa.array(best.score)],
                    names=["chunk", "query", "query_id", "self_score", "vec_id", "score"])

    return pairs.mapInArrow(scan, FOUND)


def top_k(df: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
          tile_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner product
    with every row for which ``is_query`` holds, the row itself left out."""
    spark = df.sparkSession
    prepare_workers(spark)
    if tile_rows is None:           # tiles enough for all cores; results do not depend on it
        tile_rows = min(TILE_ROWS, max(LEAST_TILE, df.count() // (4 * spark.sparkContext.defaultParallelism)))
    index, queries = _tables(df, is_query, id_col, vec_col, scale, tile_rows)
    slots = max(1, index.count())
    asked = queries.select(F.col("key").alias("chunk"), *[F.col(c).alias(f"q_{c}") for c in ("n", "dims", "ids", "width", "x")])
    slot = F.pmod(F.xxhash64("key"), F.lit(slots))
    first = Window.partitionBy("chunk", "query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    bounds = [0] + [b for b in (slots // GROWTH ** i for i in range(int(math.log(slots, GROWTH)) + 1, -1, -1)) if b]
    found = None
    for lo, hi in zip(bounds, bounds[1:]):
        if found is None:
            chunks = asked.withColumn("floor", F.lit(None).cast("array<long>"))
        else:                       # the k-th score so far of the queries of a chunk, in their order
            kth = found.groupBy("chunk", "query").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c"))
            kth = kth.withColumn("s", F.when(F.col("c") > k, F.col("s")).otherwise(F.lit(LEAST)))
            kth = kth.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("query", "s"))), lambda x: x["s"]).alias("floor"))
            chunks = asked.join(kth, "chunk", "left")
        parts = 2 * (hi - lo)
        sent = chunks.withColumn("slot", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi - 1).cast("long")))).repartition(parts, "slot")
        tiles = index.withColumn("slot", slot).where((F.col("slot") >= lo) & (F.col("slot") < hi)).repartition(parts, "slot")
        pairs = sent.join(tiles.hint("merge"), "slot")
        new = _searched(pairs, k + 1)
        both = new if found is None else found.unionByName(new)
        both = both.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).drop("place")
        found = write_table(both, work_dir(spark, "topk-found"))

    group = Window.partitionBy("chunk", "query")
    itself = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("self_score"))
    out = found.withColumn("place", F.row_number().over(first))
    out = out.withColumn("own", F.min(F.when(itself, F.col("place"))).over(group))
    out = out.where(F.col("own").isNull() | (F.col("place") != F.col("own")))
    rank = F.col("place") - F.when(F.col("place") > F.col("own"), 1).otherwise(0)
    return out.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_STEP == 0)


OP13_SQL = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i]))::BIGINT AS score
  FROM kept q JOIN kept d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

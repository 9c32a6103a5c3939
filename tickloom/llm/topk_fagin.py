"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.chunks import parts_for
from tickloom.llm.units import release
from tickloom.session import written

#: Vectors of one block of candidates, and queries of one block.
BLOCK = 4096
QUERY_BLOCK = 512
#: Below every score.
NO_FLOOR = -(2**62)
#: Rows that the first round reads of each list; each further round reads twice as many.
FIRST_DEPTH = 64


def _pack_block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    release()
    ids = rows["id"].to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    dims = key[1].as_py()
    values = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), dims)
    return pa.table(
        {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "dims": pa.array([dims], pa.int32()),
            "ids": pa.array([ids[order].tobytes()], pa.binary()),
            "vectors": pa.array([values[order].tobytes()], pa.binary()),
            "floors": pa.array([rows["floor"].to_numpy().astype(np.int64)[order].tobytes()], pa.binary()),
        }
    )


def _unpack(rows: pa.Table, i: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(rows["ids"][i].as_py(), np.int64)
    return ids, np.frombuffer(rows["vectors"][i].as_py(), np.int64).reshape(len(ids), dims)


class SortedLists:
    """The vectors of a block, with one list of rows for each dimension in descending order of its component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.rows_read = 0
        self.lists = np.argsort(-vectors, axis=0, kind="stable")
        # products and sums of such components are whole numbers that a double holds exactly
        small = not vectors.size or int(np.abs(vectors).max()) < 1 << 20
        self.numbers = vectors.astype(np.float64) if small and vectors.shape[1] < 1 << 12 else vectors

    def top(self, query_id: int, query: np.ndarray, k: int, floor: int = NO_FLOOR) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows other than the query's own, ties to the smaller id: ids and scores.

        Each round goes further down the list of each dimension (from its end where the query's component is negative),
        scores the rows not seen before, and stops when no unseen row can score as much as the kth, or as floor: k rows
        elsewhere have that much, so a row below it is none of the best, and a block that cannot reach it is not read.
        """
        n, dims = self.vectors.shape
        exact = self.numbers.dtype == np.float64 and (not dims or int(np.abs(query).max()) < 1 << 20)
        numbers, q = (self.numbers, query.astype(np.float64)) if exact else (self.vectors, query)
        seen = self.ids == query_id
        used = np.flatnonzero(query)
        if n and len(used):
            tops = [self.lists[0, j] if query[j] > 0 else self.lists[n - 1, j] for j in used]
            if (self.vectors[tops, used] * query[used]).sum() < floor:
                return self.ids[:0], np.zeros(0, np.int64)
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, numbers.dtype)
        depth = 0
        while depth < n:
            upto = min(n, 2 * depth + FIRST_DEPTH)
            rows = [self.lists[depth:upto, j] if query[j] > 0 else self.lists[n - upto : n - depth, j] for j in used]
            mark = np.zeros(n, bool)
            if rows:
                mark[np.concatenate(rows)] = True
            else:
                mark[depth:upto] = True  # every score is 0 and ids ascend: what comes later cannot win
            mark &= ~seen
            new = np.flatnonzero(mark)
            self.rows_read += len(new)
            seen |= mark
            best, scores = np.concatenate([best, new]), np.concatenate([scores, numbers[new] @ q])
            if len(best) > k:
                order = np.lexsort((self.ids[best], -scores))[:k]
                best, scores = best[order], scores[order]
            depth = upto
            at = [self.lists[depth - 1, j] if query[j] > 0 else self.lists[n - depth, j] for j in used]
            bound = (self.vectors[at, used] * query[used]).sum() if rows else 0
            if depth < n and (bound < floor or len(best) == k and (bound < scores.min() or not rows)):
                break
        best, scores = best[scores >= floor], scores[scores >= floor]
        order = np.lexsort((self.ids[best], -scores))[:k]
        return self.ids[best[order]], scores[order].astype(np.int64)


def _search(k: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        release()
        out: list[tuple[int, int, int]] = []
        if rows.num_rows and asked.num_rows:
            dims = rows["dims"][0].as_py()
            lists = SortedLists(*_unpack(rows, 0, dims))
            floors = np.frombuffer(asked["floors"][0].as_py(), np.int64)
            for query_id, query, floor in zip(*_unpack(asked, 0, dims), floors, strict=True):
                ids, scores = lists.top(int(query_id), query, k, int(floor))
                out += [(int(query_id), int(i), int(s)) for i, s in zip(ids, scores, strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def _in_blocks(vectors: DataFrame, each: int) -> tuple[DataFrame, int]:
    n = parts_for(vectors.count(), each)
    blocks = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    packed = blocks.groupBy("block", "dims").applyInArrow(_pack_block, "block int, dims int, ids binary, vectors binary, floors binary")
    return packed, n


def _found(blocks: DataFrame, blocks_no: Column, asked: DataFrame, n_asked: int, k: int) -> DataFrame:
    """query_id, vec_id, score: the best rows of each block for each query, a group for each pair of blocks."""
    left = blocks.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    right = asked.withColumnRenamed("block", "ask").withColumn("block", F.explode(blocks_no))
    pair = ["block", "ask", "dims"]
    return (
        left.groupBy(*pair)
        .cogroup(right.select("block", "ask", "dims", "ids", "vectors", "floors").groupBy(*pair))
        .applyInArrow(_search(k), "query_id long, vec_id long, score long")
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k highest integer inner products of each query with all other vectors.

    A component x counts as floor(scale * x). Candidates are dealt into blocks of about BLOCK vectors and queries into
    blocks of about QUERY_BLOCK; each pair of blocks is one task's group, which runs the threshold algorithm for each of
    its queries over the block's sorted lists and hands on at most k rows; those meet by query. First the queries are
    answered from one block alone: a query's kth score there is a floor for all other blocks, which stop at it, or are not
    read at all where their bound is below it. Ties go to the smaller id.

    Vectors that are null or hold null or non-finite components, and null ids, take no part. Vectors of different
    lengths are not compared. Rows that share the query's id are not its candidates; other repeated rows count as often
    as they occur, and of a repeated query id the least vector is asked, once. Scores must fit 64 bits. Returns query_id,
    rank (from 1), id_col, score.
    """
    ok = F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    whole = vectors.withColumn("__query", F.coalesce(is_query, F.lit(False))).filter(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ok
    )
    ints = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    slim = whole.select(
        F.col(id_col).cast("long").alias("id"), ints.alias("v"), F.size(vector_col).alias("dims"), F.col("__query").alias("asks")
    )
    slim = written(slim, "topk-vectors")
    blocks, n_blocks = _in_blocks(slim.select("id", "v", "dims", F.lit(NO_FLOOR).alias("floor")), BLOCK)
    blocks = written(blocks, "topk-blocks")
    queries = slim.filter("asks").groupBy("id").agg(F.min(F.struct("v", "dims")).alias("q")).select("id", "q.v", "q.dims")
    first, n_asked = _in_blocks(queries.withColumn("floor", F.lit(NO_FLOOR)), QUERY_BLOCK)
    begun = written(_found(blocks.filter("block = 0"), F.array(F.lit(0)), first, n_asked, k), "topk-first")
    floors = begun.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    asked, _ = _in_blocks(queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR))), QUERY_BLOCK)
    rest = F.sequence(F.lit(1), F.lit(n_blocks - 1)) if n_blocks > 1 else F.array().cast("array<int>")
    found = _found(blocks.filter("block > 0"), rest, asked, n_asked, k).unionByName(begun)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")

"""Exact top-k by inner product: term-at-a-time accumulation.

Vectors are quantised to integers and cut into blocks of ``BLOCK`` rows, sorted
by id; each row of the block table holds a block's matrix, in the narrowest
integer type that holds its values. Query blocks and candidate blocks meet on a
grid: query blocks are dealt to its rows and candidate blocks to its columns,
and a cell joins the blocks of its row with those of its column. The grid has a
cell per ``CELL_SCORES`` scores, but one per ``SPAN_ROWS`` candidates up to
``CELLS`` for small tables, and as many rows and columns as make the copies of
either side equal. What is shuffled thus grows with queries times rows over the
root of ``CELL_SCORES``, not over a fixed group of candidates.

There the sparse query rows are taken
term by term: for each dimension the candidates' posting list (rows with a
non-zero weight) is scaled by the queries' weights and scattered into a dense
score array. A partition selection takes each block's k best, and a window
merges them. Every query meets every candidate, whatever its score; memory is
one block of each kind and their score array.

Nulls and odd rows: a vector that is null, or holds a null or a non-finite
component, takes no part. Rows without id can't be named and take no part.
Rows that repeat an id and a vector count once; a query's own are all rows with
its id. Shorter vectors count as padded with zeros. Ties go to the smaller id.
Other columns of the input, whatever their names, are left behind. An empty
table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.common import written

BLOCK = 1024
#: Scores that a cell of the grid aims at.
CELL_SCORES = 2**30
#: Small tables: candidates that a cell aims at, until there are ``CELLS`` cells.
SPAN_ROWS = 4096
CELLS = 64


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec, v array<long>) of the usable rows, repeated ones once:
    floor(scale * x) with x as double."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    kept = vectors.select(F.col(id_col).alias("vec"), x.alias("x")).where(F.col("vec").isNotNull() & F.col("x").isNotNull())
    kept = kept.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return kept.select("vec", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v")).distinct()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``BLOCK`` rows: ids and a matrix of integers, as bytes;
    ``width`` is the bytes of one."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            ids = part.column(0).to_numpy()
            lists = part.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            matrix = np.zeros((len(ids), max(1, int(lengths.max()))), np.int64)
            inside = np.arange(matrix.shape[1]) < lengths[:, None]
            matrix[inside] = lists.flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            least = min(int(matrix.min()), -int(matrix.max()) - 1)  # under zero, so that the type has a sign
            matrix = matrix[order].astype(np.min_scalar_type(least))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[order].tobytes()]), pa.array([matrix.tobytes()]), pa.array([len(ids)], pa.int32()), pa.array([matrix.itemsize], pa.int32())],
                names=["ids", "matrix", "n", "width"],
            )


def _matrix(block: pa.Scalar, n: pa.Scalar, width: pa.Scalar) -> np.ndarray:
    return np.frombuffer(block.as_buffer(), f"i{width.as_py()}").reshape(n.as_py(), -1).astype(np.int64)


def grid(n_queries: int, n_candidates: int) -> tuple[int, int]:
    """Rows (groups of query blocks) and columns (groups of candidate blocks)."""
    if not n_queries:
        return 1, 1
    cells = max(math.ceil(n_queries * n_candidates / CELL_SCORES), min(CELLS, math.ceil(n_candidates / SPAN_ROWS)))
    columns = min(cells, math.ceil(math.sqrt(cells * n_candidates / n_queries)))
    return math.ceil(cells / columns), columns


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores (queries x candidates), accumulated one term at a time."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights = queries[:, term]
        asking = np.flatnonzero(weights)
        posting = np.flatnonzero(candidates[:, term])
        if not len(asking) or not len(posting):
            continue
        values = np.outer(weights[asking], candidates[posting, term])
        if len(posting) == len(candidates) and len(asking) == len(queries):
            scores += values
        else:
            scores[np.ix_(asking, posting)] += values
    return scores


def select(scores: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query the columns of the k best scores, ties to the left, without
    the columns that ``own`` marks."""
    out = []
    for row, mine in zip(scores, own, strict=True):
        usable = np.flatnonzero(~mine) if mine.any() else np.arange(len(row))
        values = row[usable]
        if len(values) > k:
            least = -np.partition(-values, k - 1)[k - 1]
            over = np.flatnonzero(values > least)
            ties = np.flatnonzero(values == least)[: k - len(over)]
            usable = usable[np.concatenate([over, ties])]
        out.append(usable)
    return out


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best among all other
    rows. ``is_query`` is a condition on the id column."""
    data = written(quantised(vectors, id_col, vector_col, scale).repartition("vec"), "vectors")
    asked = data.withColumnRenamed("vec", id_col).where(is_query).withColumnRenamed(id_col, "vec")
    rows, columns = grid(asked.count(), data.count())
    schema = "ids binary, matrix binary, n int, width int"

    def blocks(part: DataFrame, groups: int, name: str) -> DataFrame:
        return written(part.mapInArrow(_blocks, schema).withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")), name)

    def copied(part: DataFrame, copies: int, prefix: str) -> DataFrame:
        named = part.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("ids", "matrix", "n", "width", "group")])
        return named.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    asking = copied(blocks(asked.coalesce(max(1, rows, columns // 8)), rows, "query-blocks"), columns, "q")
    holding = copied(blocks(data, columns, "candidate-blocks"), rows, "c")
    met = (F.col("q_group") == F.col("c_copy")) & (F.col("q_copy") == F.col("c_group"))
    pairs = asking.withColumnRenamed("copy", "q_copy").join(holding.withColumnRenamed("copy", "c_copy"), met)
    pairs = pairs.select("q_ids", "q_matrix", "q_n", "q_width", "c_ids", "c_matrix", "c_n", "c_width")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q, q_n, q_width, c_ids, c, c_n, c_width = (batch.column(i)[row] for i in range(8))
                q_ids, c_ids = (np.frombuffer(x.as_buffer(), np.int64) for x in (q_ids, c_ids))
                scores = accumulate(_matrix(q, q_n, q_width), _matrix(c, c_n, c_width))
                best = select(scores, q_ids[:, None] == c_ids[None, :], k)
                rows = np.repeat(np.arange(len(best)), [len(b) for b in best])
                columns = np.concatenate(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[rows]), pa.array(c_ids[columns]), pa.array(scores[rows, columns])], names=["query_id", "vec_id", "score"]
                )

    found = pairs.mapInArrow(score, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

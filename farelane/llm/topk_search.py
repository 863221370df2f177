"""Exact top-k search by inner product, a term at a time.

Vectors are lists of (term, weight). The rows of a task form postings per term; the
queries, in blocks of bounded size, are sparse rows. Each term scatters the products of its
query weights and its postings into a dense array of scores; a partition of each score row
selects the best of the task, and the best of all tasks are merged by key.

Cases, by definition:

* vectors that are null, empty or hold null or non-finite components take no part;
* vectors of other lengths meet in their common terms, as missing terms weigh nothing;
* a query's own row is every row of its id; rows without an id are no queries and come
  last among equal scores; rows that repeat an id are candidates each, and queries once
  (the least vector of the id asks);
* ties go to the smaller id; fewer candidates than k give fewer rows; no row, no result;
* scores beyond 62 bits raise an error rather than wrap; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import land, map_batches

SCALE = 256
EVERY = 50
K = 5
#: Queries that are sent to the executors at once.
QUERY_BLOCK = 4096
_SCORES = 1 << 19
_NO_ID = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, weights): integer weights floor(scale * x) of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    vector = F.col(vector_column).cast("array<double>")
    fine = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, bad), F.lit(True))
    weights = F.transform(vector, lambda x: F.floor(x * scale).cast("long"))
    return vectors.where(fine).select(F.col(id_column).cast("long").alias("id"), weights.alias("weights"))


def _matrix(weights: pa.ListArray) -> np.ndarray:
    """Rows of weights, padded with zero."""
    sizes = weights.value_lengths().to_numpy(zero_copy_only=False)
    flat = weights.flatten().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    found = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    found[np.arange(found.shape[1]) < sizes[:, None]] = flat
    return found


def scores_by_term(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Dense scores (query, row), accumulated term by term over the postings of the rows."""
    terms = min(queries.shape[1], rows.shape[1])
    most = lambda a: int(np.abs(a[:, :terms]).max(initial=0))
    if most(queries) * most(rows) * max(1, terms) >= 1 << 62:
        raise OverflowError("scores beyond 62 bits")
    scores = np.zeros((len(queries), len(rows)), np.int64)
    for term in range(terms):
        asks, posts = queries[:, term], rows[:, term]
        asking, posted = np.flatnonzero(asks), np.flatnonzero(posts)
        if len(asking) == len(asks) and len(posted) == len(posts):
            scores += np.multiply.outer(asks, posts)
        elif len(asking) and len(posted):
            scores[np.ix_(asking, posted)] += np.multiply.outer(asks[asking], posts[posted])
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k best per row; ``ids`` rise, so a place breaks ties."""
    n = scores.shape[1]
    hidden = own[:, None] == ids
    if n > k:
        # The k-th best score by partition; all above it, then the first of its equals.
        masked = np.where(hidden, np.iinfo(np.int64).min, scores)
        kth = np.partition(masked, n - k, axis=1)[:, n - k]
        above, equal = masked > kth[:, None], masked == kth[:, None]
        room = k - above.sum(axis=1)
        chosen = (above | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))) & ~hidden
    else:
        chosen = ~hidden
    q, r = np.nonzero(chosen)
    return q, ids[r], scores[q, r]


def _search_block(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each task for each query of one bounded block."""
    table = queries.toArrow().combine_chunks()
    ids = table.column("id").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast((ids, _matrix(table.column("weights").combine_chunks())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask_ids, asks = shared.value
        best: list[list[np.ndarray]] = [[], [], []]

        def shrink() -> list[np.ndarray]:
            """The k best per query of what the task has found so far."""
            q, i, s = (np.concatenate(x) if x else np.empty(0, np.int64) for x in best)
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            new = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
            rank = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0)) if len(q) else q
            return [x[rank < k] for x in (q, i, s)]

        for batch in batches:
            names = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            order = np.argsort(names, kind="stable")
            names, held = names[order], _matrix(batch.column("weights"))[order]
            for at in range(0, len(names), 1024):
                part, part_names = held[at : at + 1024], names[at : at + 1024]
                step = max(1, _SCORES // len(part))
                for first in range(0, len(asks), step):
                    scores = scores_by_term(asks[first : first + step], part)
                    q, i, s = _best(scores, part_names, ask_ids[first : first + step], k)
                    for x, found in zip(best, (q + first, i, s)):
                        x.append(found)
            best = [[x] for x in shrink()]
        q, i, s = shrink()
        yield pa.RecordBatch.from_arrays([pa.array(ask_ids[q]), pa.array(np.where(i == _NO_ID, None, i) if (i == _NO_ID).any() else i, pa.int64()), pa.array(s)], ["query_id", "vec_id", "score"])

    return map_batches(rows, run, "query_id long, vec_id long, score long")


def search(vectors: DataFrame, k: int = K, every: int = EVERY, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (id, weights) whose id ``every`` divides.

    Queries go out in blocks of about ``query_block`` rows, one pass over the vectors each, so
    neither the driver nor a task holds more than a block of them.
    """
    vectors = land(vectors, "vectors")
    asking = vectors.where(F.col("id") % every == 0).groupBy("id").agg(F.min("weights").alias("weights"))
    asking = land(asking, "queries")
    blocks = -(-asking.count() // query_block)
    found = []
    for block in range(blocks):
        part = asking.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        found.append(land(_search_block(vectors, part, k), "found"))
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    everything = found[0]
    for part in found[1:]:
        everything = everything.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return everything.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

"""Exact top-k by inner product over an impact-ordered index, score at a time (operator 1).

Vectors are dealt into blocks of about ``BLOCK_ROWS``; an index block keeps, for each level of quantised impact, the
postings (dimension, vector, component) whose absolute component lies in that level. A batch of queries meets a
block once: levels are processed from the highest impact down, each adding its scores to the accumulators. What
the levels not yet processed can still add to a vector is at most their highest impact times the sum of the
query's absolute components over that vector's unprocessed postings. A vector whose accumulator plus that bound is
below the k-th best of accumulator minus bound cannot be among the top k; once few others are left for a query,
which is the proof, it stops and its possible members are rescored exactly. If the bounds prove
nothing, all levels are processed, and the accumulators are the exact scores.

Blocks and batches are of bounded size, so a task's memory is bounded; ties and repeated vectors spread over blocks,
as rows are dealt by their number. The k best of each block are merged by a window that cuts before it shuffles.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part; vectors of different
length are compared as if padded with zeros; repeated rows are candidates of their own, and a query's own row is
left out by row, not by id; rows with a NULL id are candidates (ordered last among ties) but no queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm.common import keep

BLOCK_ROWS = 16_384
BATCH_QUERIES = 1_024
RESCORED = 8  # stop when at most this many times k possible members are left
LEVELS = (64, 32, 16, 8, 4, 2, 1)  # lower bounds of the impact levels, highest first; zeros have no posting
HITS = "query_row long, query_id long, vec_id long, vec_row long, score long"


def quantised(embedding: str = "embedding", scale: int = 64) -> Column:
    """floor(scale * x) per component; NULL where the vector takes no part."""
    vector = F.col(embedding)
    limit = float("inf")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(limit)))
    return F.when(vector.isNotNull() & ~odd, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class ImpactBlock:
    """Index of one block: the matrix split into one sparse layer per impact level."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.size = np.abs(vectors)
        highest = int(self.size.max(initial=0))
        bounds = [b for b in LEVELS if b <= highest]
        self.levels = []
        above = np.inf
        for low in bounds:
            self.levels.append((low, np.where((self.size >= low) & (self.size < above), vectors, 0)))
            above = low

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query: places of vectors among which its k best are for sure, and their exact scores.

        ``own`` has the place of each query in this block, or -1; it is never among them.
        """
        n = len(self.vectors)
        largest = int(self.size.sum(axis=1).max(initial=0)) * int(np.abs(queries).max(initial=0))
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object
        going = np.arange(len(queries))  # queries without a proof yet
        asked, scores = queries.astype(kind), np.zeros((len(queries), n), kind)
        for place, (low, layer) in enumerate(self.levels):
            scores += asked @ layer.T.astype(kind)
            if place + 1 == len(self.levels) or low > 4 or n <= RESCORED * k:
                continue
            bound = (np.abs(asked) @ ((self.size < low) & (self.size > 0)).T.astype(kind)) * (low - 1)
            here = np.flatnonzero(own[going] >= 0)
            floor, most = scores - bound, scores + bound
            floor[here, own[going][here]] = most[here, own[going][here]] = -np.inf
            least = np.partition(floor, n - k, axis=1)[:, n - k]
            members = most >= least[:, None]
            proven = members.sum(axis=1) <= RESCORED * k
            for q in np.flatnonzero(proven):
                places = np.flatnonzero(members[q])
                yield going[q], places, self.vectors[places] @ queries[going[q]]
            going, asked, scores = going[~proven], asked[~proven], scores[~proven]
        for q, row in zip(going, scores):
            places = np.delete(np.arange(n), own[q]) if own[q] >= 0 else np.arange(n)
            found = row[places]
            if len(found) > k:
                chosen = found >= np.partition(found, len(found) - k)[len(found) - k]
                places, found = places[chosen], found[chosen]
            yield q, places, found.astype(np.int64)

    def top(self, queries: np.ndarray, own: np.ndarray, order: np.ndarray, k: int) -> Iterator[tuple]:
        """Per query: places of its k best vectors and their scores; ties go to the smaller ``order``."""
        for q, places, found in self.search(queries, own, k):
            best = np.lexsort((order[places], -found))[:k]
            yield q, places[best], found[best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _search(k: int):
    def search(key, found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(asked):
            return pd.DataFrame({n: pd.Series(dtype="Int64") for n in ("query_row", "query_id", "vec_id", "vec_row", "score")})
        width = max(found["vector"].map(len).max(), asked["vector"].map(len).max())
        block, queries = ImpactBlock(_matrix(found["vector"], width)), _matrix(asked["vector"], width)
        places = pd.Series(np.arange(len(found)), index=found["vec_row"])
        own = places.reindex(asked["vec_row"]).fillna(-1).to_numpy(np.int64)
        ids = found["vec_id"].astype("Int64").fillna(2**63 - 1).to_numpy(np.int64)
        rank = np.empty(len(found), np.int64)
        rank[np.lexsort((found["vec_row"], ids))] = np.arange(len(found))
        parts = []
        for q, chosen, scores in block.top(queries, own, rank, k):
            hits = found.iloc[chosen]
            parts.append(pd.DataFrame({
                "query_row": asked["vec_row"].iat[q], "query_id": asked["vec_id"].iat[q],
                "vec_id": hits["vec_id"].astype("Int64").to_numpy(), "vec_row": hits["vec_row"].to_numpy(), "score": scores,
            }))
        return pd.concat(parts)

    return search


def top_k(vectors: DataFrame, k: int, queries: Column, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best rows of ``vectors`` (vec_id, embedding) for each row that fulfils ``queries``.

    Returns query_id, rank (from 1), vec_id, score. Scores are sums of 64-bit integers.
    """
    rows = keep(
        vectors.select(F.col("vec_id").cast("long"), quantised().alias("vector"))
        .filter(F.col("vector").isNotNull())
        .withColumn("vec_row", F.monotonically_increasing_id()),
        "quantised",
    )
    asked = rows.filter(queries & F.col("vec_id").isNotNull())
    blocks = -(-rows.count() // block_rows) or 1
    batches = -(-asked.count() // BATCH_QUERIES) or 1
    # Row numbers are consecutive within a partition, so a hash of them deals rows out evenly.
    block, batch = F.pmod(F.xxhash64("vec_row"), F.lit(blocks)), F.pmod(F.xxhash64("vec_row"), F.lit(batches))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long")))
    found = rows.withColumn("block", block).withColumn("batch", everywhere)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    asked = asked.withColumn("batch", batch).withColumn("block", everywhere)
    hits = (
        found.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch")).applyInPandas(_search(k), HITS)
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return (
        hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

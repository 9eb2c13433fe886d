"""Exact top-k search by inner product with MaxScore.

Components are the terms of a query. In each shard of candidates the range of a component bounds
what it adds to a score. A first shard shows each query its k-th best score so far; that score goes
with the query to all other shards. Components are non-essential as long as all of them together
can't lift a candidate that has the least of all others to that score; the rest are essential: their
postings are summed for all candidates of the shard. Candidates that can't reach the k-th best score
with the non-essential components' bounds are dropped; the others are probed, a few components at a
time, while they stay competitive. Shards give their k best to a merge.

Candidates are dealt to shards by a hash of their row; queries, in parts of bounded size, meet every
shard (queries against all rows, in blocks; no pairs are made but the k best).

Defined results: vectors that are null, or hold a null or non-finite component, take no part, nor do
rows without an id; rows that share an id, equal or not, are vectors of their own, each a candidate
for the others; vectors of unequal length score over the components both have; fewer candidates than k give fewer
rows; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postroom.llm import common

K = 5
SCALE = 256
EVERY = 50
SHARD_ROWS, QUERY_ROWS = 8192, 8192
#: Non-essential components probed at a time.
PROBES = 8


def quantized(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v, row`` of the rows that take part; row tells rows of one id apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    counted = valid.select("vec_id", quantized(F.col("embedding"), scale).alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("n"))
    each = counted.select("vec_id", "v", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    return each.select("vec_id", "v", F.xxhash64("vec_id", "v", "copy").alias("row"))


def _matrix(held: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(held), width))
    for i, v in enumerate(held):
        out[i, : len(v)] = v[:width]
    return out


def best(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best candidates, ties to the smaller id. ``ids`` ascend; a row of
    ``columns`` holds one component of all candidates, low and high its range; reach is a score that
    k candidates elsewhere have."""
    most, least = np.maximum(query * low, query * high), np.minimum(query * low, query * high)
    order = np.argsort(least - most, kind="stable")
    # non-essential: the smallest ranges, so long as all of them together can't lead to the reach
    spare = np.cumsum((most - least)[order][::-1])
    cut = len(order) - int(np.searchsorted(spare, reach - least.sum()))
    score = query[order[:cut]] @ columns[order[:cut]]
    at = np.arange(len(ids))
    if len(mine := np.flatnonzero(rows == own)):
        at = np.delete(at, mine)
    score = score[at]
    rest = order[cut:]
    if len(rest) and len(at) > k:
        # whole scores of the best so far may raise the score to reach
        lead = np.argpartition(-score, k - 1)[:k]
        reach = max(reach, (score[lead] + query[rest] @ columns[np.ix_(rest, at[lead])]).min())
    for i in range(0, len(rest), PROBES):
        near = score + most[rest[i:]].sum() >= reach
        at, score = at[near], score[near]
        part = rest[i : i + PROBES]
        score = score + query[part] @ columns[np.ix_(part, at)]
    near = score >= reach
    at, score = at[near], score[near]
    order = np.lexsort((ids[at], -score))[:k]
    return at[order], score[order]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for tables ``vec_id, v, row`` of whole numbers."""
    shards = max(1, -(-candidates.count() // shard_rows))
    parts = max(1, -(-queries.count() // query_rows))
    each = lambda first, last: F.explode(F.sequence(F.lit(first), F.lit(last)))
    asked = queries.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts)).cast("int"))
    held = candidates.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(shards)).cast("int")).withColumn("part", each(0, parts - 1))

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(q) and len(c):
            c = c.sort_values(["vec_id", "row"])
            ids, rows = c["vec_id"].to_numpy(), c["row"].to_numpy()
            width = max(map(len, c["v"]))
            columns = np.ascontiguousarray(_matrix(c["v"], width).T)
            low, high = columns.min(1, initial=0), columns.max(1, initial=0)
            for query_id, own, reach, query in zip(q["vec_id"], q["row"], q["reach"], _matrix(q["v"], width)):
                if np.abs(query) @ np.maximum(np.abs(low), np.abs(high)) >= 2.0**53:
                    raise OverflowError("scores beyond 2^53 are not exact")
                to, score = best(query, own, ids, rows, columns, low, high, k, reach)
                found.extend(zip([query_id] * len(to), [own] * len(to), ids[to].tolist(), rows[to].tolist(), score.tolist()))
        out = pd.DataFrame(found, columns=["query_id", "query", "vec_id", "row", "score"])
        return out.astype({"query_id": "int64", "query": "int64", "vec_id": "int64", "row": "int64", "score": "int64"})

    def near(questions: DataFrame, some: DataFrame) -> DataFrame:
        both = questions.groupBy("shard", "part").cogroup(some.groupBy("shard", "part"))
        return both.applyInPandas(search, "query_id long, query long, vec_id long, row long, score long")

    # the first shard shows each query a score to reach, which goes with it to all others
    begun = common.staged(near(asked.withColumn("shard", F.lit(0)).withColumn("reach", F.lit(float("-inf"))), held.where("shard = 0")), "first-shard")
    found = begun
    if shards > 1:
        reach = begun.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("reach"))
        told = asked.join(reach.withColumnRenamed("query", "row"), "row", "left").withColumn("reach", F.coalesce("reach", F.lit(float("-inf"))))
        told = common.staged(told, "queries")
        found = begun.unionByName(near(told.withColumn("shard", each(1, shards - 1)), held.where("shard > 0")))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = common.staged(vectors(common.table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(held.where(F.col("vec_id") % EVERY == 0), held)


OP6_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row AS query, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % {EVERY} = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""

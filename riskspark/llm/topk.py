"""Exact top-k inner-product search: tiled matrix products, partial selection per tile, tree merging.

Every component x becomes floor(scale * x) (x as double); scores are exact integer inner
products. Queries are the rows whose id is divisible by ``every``; each is scored
against every other row of the same length (rows with the query's id are its own and
never candidates).

Plan: the valid rows are written once with a row key. Candidates are dealt into shards
of about ``shard`` rows and queries into groups of about ``query_block`` rows by a hash of
the row key, so that no id, vector or group of copies can make one tile large. A tile is
one (shard, query group) pair; both sides meet in one cogroup, the only place where the
query set and the candidates are joined, block against block. Each tile multiplies its
two matrices (float64 BLAS where every partial sum is an integer below 2^53, so exact;
int64 beyond that; Python integers where even int64 could overflow) and keeps the k best
candidates per query. The lists of the shards are then merged in a tree, ``fan_in``
shards per level, so that no merge holds more than fan_in * k entries.

Defined results: rows with a null id, a null vector, or a null, NaN or infinite component
take no part; vectors of another length than the query's are never its candidates; empty
vectors score 0 against each other; ties go to the smaller id; a query with fewer than k
candidates gets them all; a query row repeated gives its list once per row; scores
beyond the long range are clamped to it; an empty table gives no rows. Only the id and
the vector are read, so other columns never clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import discard, materialize

K = 10
EVERY = 100
SCALE = 1024
QUERY_BLOCK = 1024
SHARD = 8192
FAN_IN = 16
EXACT_FLOAT = 1 << 53
LONG_MAX = (1 << 63) - 1

PARTS = "qrow long, query_id long, cs long, vec_id long, score long"


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > kth)
        level = np.flatnonzero(scores == kth)
        if len(above) + len(level) > k:
            need = k - len(above)
            level = level[np.argpartition(ids[level], need - 1)[:need]] if need else level[:0]
        keep = np.concatenate([above, level])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))]


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of q and c, clamped to the long range."""
    if q.shape[1] == 0:
        return np.zeros((len(q), len(c)), np.int64)
    bound = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < EXACT_FLOAT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound <= LONG_MAX:
        return q @ c.T
    exact = q.astype(object) @ c.astype(object).T
    return np.vectorize(lambda s: max(-LONG_MAX - 1, min(LONG_MAX, s)), otypes=[np.int64])(exact)


def tile(k: int, rows_per_step: int):
    def run(cands: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qrow": [], "query_id": [], "cs": [], "vec_id": [], "score": []}, dtype="int64")
        if cands.empty or queries.empty:
            return empty
        c_ids = cands["id"].to_numpy(np.int64)
        c = np.array(cands["v"].tolist(), np.int64).reshape(len(cands), -1) if len(cands["v"].iloc[0]) else np.zeros((len(cands), 0), np.int64)
        shard = int(cands["cs"].iloc[0])
        out = []
        for lo in range(0, len(queries), rows_per_step):
            part = queries.iloc[lo : lo + rows_per_step]
            q = np.array(part["v"].tolist(), np.int64).reshape(len(part), c.shape[1])
            scores = products(q, c)
            for qrow, qid, line in zip(part["row"].to_numpy(np.int64), part["id"].to_numpy(np.int64), scores):
                own = c_ids == qid
                ids, sc = (c_ids[~own], line[~own]) if own.any() else (c_ids, line)
                pick = best(sc, ids, k)
                out.append(pd.DataFrame({"qrow": qrow, "query_id": qid, "cs": shard, "vec_id": ids[pick], "score": sc[pick]}))
        return pd.concat(out, ignore_index=True) if out else empty

    return run


def merge_level(parts: DataFrame, k: int, fan_in: int) -> DataFrame:
    """One level of the tree: the lists of ``fan_in`` neighbouring shards become one."""
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("vec_id")))), 1, k)
    merged = parts.groupBy("qrow", "query_id", F.floor(F.col("cs") / fan_in).alias("cs")).agg(ranked.alias("top"))
    return merged.select("qrow", "query_id", "cs", F.posexplode("top").alias("pos", "hit")).select("qrow", "query_id", "cs", "pos", F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).alias("score"))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, query_block: int = QUERY_BLOCK, shard: int = SHARD, fan_in: int = FAN_IN) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query, rank from 1."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != F.lit(math.inf)))
    valid = materialize(
        vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))
        .withColumn("dim", F.size("v"))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    n_rows = valid.count()
    n_queries = valid.where(F.col("id") % every == 0).count()
    shards = max(1, -(-n_rows // shard))
    groups = max(1, -(-n_queries // query_block))
    cands = valid.select("row", "id", "dim", "v", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("long").alias("cs")).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    asked = (
        valid.where(F.col("id") % every == 0)
        .select("row", "id", "dim", "v", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("long").alias("qg"))
        .withColumn("cs", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    )
    parts = materialize(
        cands.groupBy("dim", "cs", "qg").cogroup(asked.groupBy("dim", "cs", "qg")).applyInPandas(tile(k, 256), PARTS),
        "tiles",
    )
    discard(valid)
    level, width, last = parts, shards, parts
    while True:
        level = merge_level(level, k, fan_in)
        width = -(-width // fan_in)
        if width <= 1:
            break
        level = materialize(level, "merged")
        discard(last)
        last = level
    return level.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "vec_id", "score")

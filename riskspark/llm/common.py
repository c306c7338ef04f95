"""Helpers that the operators share: words, shingle hashes, row keys, pruned look-ups, connected components.

Words are runs of bytes outside white space (0x09-0x0D, 0x20); only A-Z are
lower-cased. Both are defined on UTF-8 bytes, so no text is ever decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import materialize

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = bytes.maketrans(UPPER, UPPER.lower())
SHINGLE = 5
# Odd multipliers of the polynomial and of the final mix of shingle hashes.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
CACHE_WORDS = 400_000
BITMAP_BITS = 1 << 26


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for the words a task meets again; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


def words(raw: bytes | None, lower: bool = True) -> list[bytes]:
    """The words of a text; none for null."""
    if not raw:
        return []
    return (raw.translate(LOWER) if lower else raw).split()


def hash_words(tokens: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash per window of ``size`` words; the whole sequence is one window if it is shorter."""
    if len(h) == 0:
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * STEP + h[i : i + n]
    return mixed(out + np.uint64(size))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64, copy=False).view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]]):
    """A mapInArrow function: ``make`` runs once per task, what it returns once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return run


def keyed(docs: DataFrame, id_col: str, tag: str) -> DataFrame:
    """``docs`` with a unique key per row, ``_row``.

    Unique ids serve as keys themselves. Where ids are null or repeated, the rows
    are numbered in the order of the ids, nulls last, and written once, so that every later
    pass sees the same numbers.
    """
    named = docs.withColumn("_row", F.col(id_col).cast("long"))
    odd = named.groupBy("_row").count().where("_row is null or count > 1").limit(1).count()
    return materialize(docs.orderBy(F.asc_nulls_last(id_col)).withColumn("_row", F.monotonically_increasing_id()), tag) if odd else named


def with_rows(docs: DataFrame, id_col: str, text_col: str, tag: str) -> DataFrame:
    """(row, id, text) with a unique row key, see ``keyed``."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return keyed(slim, "id", tag).select(F.col("_row").alias("row"), "id", "text")


def marked(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: whether the key may be in ``wanted``, a column of the same name.

    A bitmap of hashed keys with a fixed size (2^26 bits, 8 MB) is broadcast, so
    the bound holds for any input. Keys that share a bit are marked too, others never.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))
    bits = (
        wanted.select(F.bitmap_bucket_number(spot).alias("_bucket"), F.bitmap_bit_position(spot).alias("_bit"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_map"))
    )
    bit = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_map", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return rows.withColumn("_bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(bits), "_bucket", "left").withColumn("_maybe", found).drop("_bucket", "_map")


def among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose key may be in ``wanted``, before any shuffle; callers join exactly afterwards."""
    return marked(rows, key, wanted).where("_maybe").drop("_maybe")


def without(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``rows`` whose key is not in ``dropped``; only rows that may be are shuffled."""
    split = marked(rows, key, dropped)
    sure, maybe = split.where("not _maybe").drop("_maybe"), split.where("_maybe").drop("_maybe")
    return sure.unionByName(maybe.join(dropped.select(key), key, "left_anti").select(*rows.columns))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b), for every node with a link.

    Alternating large-star and small-star steps. Each node hands its neighbours to
    the smallest one, so a star stays a star and no neighbour list is collected; each
    round is written, which cuts the lineage.
    """

    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: larger neighbours of a move to the smallest of its neighbourhood.
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("far")).join(low, "a").select(F.col("far").alias("a"), F.col("low").alias("b"))
        # Small star: smaller neighbours and the node itself move to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(least.select("a", F.col("low").alias("b")))
        after = materialize(small.where("a <> b").distinct(), "edges")
        # Stars only: every node hangs on one other, which hangs on none.
        ends = after.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(after.select("b", F.lit(0), F.lit(1)))
        open_nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs + holds > 1 and hangs > 0").limit(1).count()
        edges = after
        if not open_nodes:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""N-gram Jaccard self-join: rare-first prefix filtering, each pair verified once.

1. A counting sketch of all shingles (2^18 counters, so a bounded broadcast) gives
   each shingle a rarity. Rarity, then hash, is one order for all documents; any
   such order keeps prefix filtering exact, and hot passages end up last.
2. Every document keeps the first ``n - ceil(0.8 n) + 1`` shingles of its set in that
   order. Two sets that link share one of them. Documents with the same set are one class.
3. Lists of a prefix shingle with two classes or more yield candidates, after the
   length filter and the positional filter; the suffix filter compares how both sets
   spread over fixed ranges of the hash. Survivors are verified on the whole texts.
4. Not all pairs of a list are emitted. First each class meets the list's hub, the class
   with most shared shingles; then, in lists that still hold several components, classes
   outside the largest one meet the classes of other components. Pairs left out lie in one
   component already, so components are exact and a list of n near copies costs n pairs.

Null and empty texts have no shingles and link with nothing. Repeated ids, null ids
and equal rows are rows of their own. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm import common as K
from riskspark.session import discard, materialize

SLOTS = 1 << 18
BINS = 256  # ranges of the hash over which the suffix filter compares two sets
PER_CENT = 80
SLICE = 250  # texts that a task turns into Python objects and hashes at once


def shingle_set(raw: bytes | None, cache: K.WordHashes, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(K.window_hashes(K.hash_words(K.words(raw), cache), size))


def slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)) & np.uint64(SLOTS - 1)


def counted(batches, size: int):
    """(slot, n) of the counters that the texts of a task meet; ``SLICE`` texts are hashed at once."""
    cache, total = K.WordHashes(), np.zeros(SLOTS, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            met = [slots(shingle_set(raw, cache, size)) for raw in batch.column(0).slice(at, SLICE).to_pylist()]
            total += np.bincount(np.concatenate(met).astype(np.int64), minlength=SLOTS)
    found = np.flatnonzero(total)
    for at in range(0, len(found), 1 << 16):
        part = found[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["slot", "n"])


def rarity(rows: DataFrame, size: int) -> np.ndarray:
    """How often each counter of the sketch is met, over every document."""

    def count(batches):
        yield from counted(batches, size)

    table = rows.select(F.col("text").cast("binary")).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    out = np.zeros(SLOTS, np.int64)
    out[table["slot"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return out


def prefix_length(n: int, per_cent: int) -> int:
    """Sets that link share one of so many first shingles."""
    return n - -(-per_cent * n // 100) + 1


def signatures(rows: DataFrame, size: int, per_cent: int) -> DataFrame:
    """(row, id, cls, n, bins, prefix) of every row; cls stands for the whole set, null if that is empty."""
    counts = rows.sparkSession.sparkContext.broadcast(rarity(rows, size))

    def make():
        cache = K.WordHashes()

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                cls, sizes, bins, prefixes = [], [], [], []
                for raw in part.column(2).to_pylist():
                    h = shingle_set(raw, cache, size)
                    n = len(h)
                    cls.append(int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())))) if n else None)
                    sizes.append(n)
                    bins.append(np.bincount((h >> np.uint64(56)).astype(np.int64), minlength=BINS))
                    first = h[np.lexsort((h, counts.value[slots(h).astype(np.int64)]))][: prefix_length(n, per_cent)] if n else h
                    prefixes.append(K.signed(first))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(cls, pa.int64()), pa.array(sizes, pa.int64()), K.lists(bins, pa.int32()), K.lists(prefixes, pa.int64())],
                    names=["row", "id", "cls", "n", "bins", "prefix"],
                )

        return step

    schema = "row long, id long, cls long, n long, bins array<int>, prefix array<long>"
    return materialize(rows.select("row", "id", F.col("text").cast("binary")).mapInArrow(K.per_batch(make), schema), "signatures")


def needed(na: Column, nb: Column, per_cent: int) -> Column:
    """Shared shingles that a link takes, times (100 + per_cent)."""
    return per_cent * (na + nb)


def passing(pairs: DataFrame, per_cent: int, complete: bool) -> DataFrame:
    """Length, prefix and positional filter on (a, na, pa, b, nb, pb); then one row per pair, a < b.

    For two given sizes a link takes ``least`` shared shingles, so one of them lies
    among the first ``n - least + 1`` of both sets: a shorter prefix than that of step 2.
    With ``complete``, the rows hold all lists that a pair shares there. Then what comes
    after the last one bounds the intersection of the pair as a whole.
    """
    least = F.ceil(F.expr(f"({per_cent} * (na + nb)) / {100 + per_cent}"))
    after = F.least(F.col("na") - 1 - F.col("pa"), F.col("nb") - 1 - F.col("pb"))
    long_enough = 100 * F.least("na", "nb") >= per_cent * F.greatest("na", "nb")
    early = (F.col("pa") <= F.col("na") - least) & (F.col("pb") <= F.col("nb") - least)
    kept = pairs.where("a <> b").where(long_enough & early & (F.least("pa", "pb") + 1 + after >= least))
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    if not complete:
        return kept.select(*pair).distinct()
    met = kept.select(*pair, (least - after).alias("before")).groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("before").alias("before"))
    return met.where("shared >= before").select("a", "b")


def hub_pairs(lists: DataFrame, per_cent: int) -> DataFrame:
    """Each class of a list with the list's hub: the class that meets others most often, so the middle of a group."""
    share = lists.groupBy("cls").agg(F.count("*").alias("met"))
    hubs = lists.join(share, "cls").groupBy("shingle").agg(F.max(F.struct("met", "cls", "n", "pos")).alias("hub"))
    met = lists.join(hubs, "shingle").select(
        F.col("cls").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("hub.cls").alias("b"), F.col("hub.n").alias("nb"), F.col("hub.pos").alias("pb")
    )
    return passing(met, per_cent, complete=False)


def rest_pairs(lists: DataFrame, roots: DataFrame, per_cent: int) -> DataFrame:
    """All pairs of a list that lie in different components: classes outside the list's largest component with any other."""
    placed = lists.join(roots, lists.cls == roots.node, "left").withColumn("comp", F.coalesce("root", "cls")).drop("node", "root")
    parts = placed.groupBy("shingle", "comp").agg(F.count("*").alias("held"))
    top = parts.groupBy("shingle").agg(F.max(F.struct("held", "comp")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    open_lists = placed.join(top.select("shingle", F.col("top.comp").alias("largest")), "shingle")
    one = open_lists.where("comp <> largest").select("shingle", F.col("comp").alias("ca"), F.col("cls").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    two = open_lists.select("shingle", "largest", F.col("comp").alias("cb"), F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    return passing(one.join(two, "shingle").where("ca <> cb and (cb = largest or a < b)"), per_cent, complete=True)


def verified(pairs: DataFrame, rows: DataFrame, signs: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Links (a, b): the suffix filter, then the exact sizes of intersection and union from both texts."""
    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select(F.col("b").alias("cls"))).distinct()
    # One row stands for a class; it is picked before any bins are moved, as a class may have very many copies.
    picked = materialize(signs.where("n > 0").groupBy("cls").agg(F.min("row").alias("row")).join(wanted, "cls"), "picked")
    chosen = materialize(K.among(signs.select("row", "n", "bins"), "row", picked.select("row")).join(picked, "row"), "chosen")
    left, right = (chosen.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("bins").alias(f"bins{x}")) for x in "ab")
    both = F.aggregate(F.zip_with("binsa", "binsb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    close = pairs.join(left, "a").join(right, "b").where((100 + per_cent) * both >= needed(F.col("na"), F.col("nb"), per_cent)).select("a", "b")
    close = materialize(close, "close")
    asked = close.select(F.col("a").alias("cls")).unionAll(close.select(F.col("b").alias("cls"))).distinct()
    asked = materialize(chosen.select("cls", "row").join(asked, "cls"), "asked")
    texts = K.among(rows.select("row", F.col("text").cast("binary").alias("text")), "row", asked.select("row")).join(asked, "row").select("cls", "text")
    joined = close.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")

    def make():
        cache = K.WordHashes()
        kept: dict[bytes, np.ndarray] = {}

        def of(raw: bytes) -> np.ndarray:
            if raw not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[raw] = shingle_set(raw, cache, size)
            return kept[raw]

        def step(batch: pa.RecordBatch):
            good = []
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for ta, tb in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = of(ta), of(tb)
                    shared = len(x) + len(y) - len(np.union1d(x, y))
                    good.append(100 * shared >= per_cent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

        return step

    return materialize(joined.select("a", "b", "ta", "tb").mapInArrow(K.per_batch(make), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = K.SHINGLE, per_cent: int = PER_CENT) -> DataFrame:
    """(row, id, n_shingles, component_id, component_row) for every row of ``docs``.

    component_id is the smallest id of all rows reachable by links, component_row
    the row to keep of the group. Rows without words are alone.
    """
    rows = K.with_rows(docs, id_col, text_col, "jaccard")
    signs = signatures(rows, size, per_cent)
    postings = signs.where("n > 0").select("cls", "n", F.posexplode("prefix").alias("pos", "shingle"))
    shared = postings.groupBy("shingle").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("shingle")
    lists = materialize(postings.join(shared.hint("shuffle_hash"), "shingle").distinct(), "lists")
    whole, signs = signs, materialize(signs.drop("prefix"), "signatures")
    discard(whole)
    links = verified(hub_pairs(lists, per_cent), rows, signs, size, per_cent)
    roots = K.components(links)
    more = verified(rest_pairs(lists, roots, per_cent), rows, signs, size, per_cent)
    roots = K.components(links.unionAll(more))
    discard(lists)

    key = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    classes = signs.where("n > 0").groupBy("cls").agg(F.min(key).alias("least")).join(roots, F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("root", "cls").alias("root"), "least")
    classes = materialize(classes, "classes")
    groups = classes.groupBy("root").agg(F.min("least").alias("least"))
    placed = classes.select("cls", "root").join(groups, "root").select("cls", F.col("least.id").alias("component_id"), F.col("least.row").alias("component_row"))
    out = signs.select("row", "id", "n", "cls").join(placed, "cls", "left")
    return out.select(
        "row", "id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("component_row", "row").alias("component_row")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = K.SHINGLE, per_cent: int = PER_CENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id."""
    rows = K.keyed(docs, id_col, "one")
    found = near_duplicates(rows.select(F.col("_row").alias("id"), F.col(text_col).alias("text")), "id", "text", size, per_cent)
    dropped = materialize(found.where("row <> component_row").select(F.col("row").alias("_row")), "dropped")
    return K.without(rows, "_row", dropped).select(*docs.columns)

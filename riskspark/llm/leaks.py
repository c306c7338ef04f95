"""Benchmark decontamination: item-sized windows of documents whose SimHash is near an item's, then verified exactly.

Shingles are five words (a shorter item or document is one shingle). Every window as long
as an item gets a 64-bit SimHash: each shingle occurrence votes on each bit. The
fingerprints of items of one length lie in a multi-index of ``BLOCKS`` blocks: two
fingerprints within ``RADIUS`` bits differ by ``RADIUS // BLOCKS`` bits at most in some
block, and a block lists every item that near, so no fingerprint within the radius is
missed. Candidates are verified by the weighted Jaccard similarity of both shingle bags
(sum of the smaller over sum of the larger counts), 0.8 or more.

Windows that hold no shingle of an item have similarity 0 with it, so only the surroundings
of item shingles are fingerprinted; that loses nothing. Items go to the tasks in blocks of
at most ``BLOCK_BYTES`` of text, one pass over the documents each.

Null and empty texts and items match nothing. Equal items each report. Rows with null or
repeated ids are reported with their id as it is.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import common as K

RADIUS = 19
BLOCKS = 10
SIMILARITY = 0.8
BLOCK_BYTES = 32 << 20
FILTER_BITS = 1 << 22
EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
SHIFTS = np.arange(64, dtype=np.uint64)


def votes(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 per shingle and bit."""
    bits = (shingles[:, None] >> SHIFTS) & np.uint64(1)
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << SHIFTS).sum(axis=1, dtype=np.uint64)


def simhash(shingles: np.ndarray) -> int:
    return int(packed(votes(shingles).sum(axis=0)[None, :])[0])


def window_simhashes(shingles: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of ``size`` shingles."""
    total = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(votes(shingles), axis=0, dtype=np.int32)))
    return packed(total[size:] - total[:-size])


class MultiIndex:
    """Fingerprints found by the blocks in which a query is near them."""

    def __init__(self, prints: list[int]):
        self.prints = np.array(prints, np.uint64)
        near = RADIUS // BLOCKS
        self.tables: list[dict[int, list[int]]] = []
        for b in range(BLOCKS):
            width = EDGES[b + 1] - EDGES[b]
            table: dict[int, list[int]] = {}
            for i, p in enumerate(prints):
                value = (p >> EDGES[b]) & ((1 << width) - 1)
                for v in self.ball(value, width, near):
                    table.setdefault(v, []).append(i)
            self.tables.append(table)

    @staticmethod
    def ball(value: int, width: int, near: int) -> set[int]:
        out = {value}
        for _ in range(near):
            out |= {v ^ (1 << k) for v in out for k in range(width)}
        return out

    def query(self, prints: np.ndarray) -> list[tuple[int, int]]:
        """(query number, item number) of all within the radius."""
        out = []
        values = [((prints >> np.uint64(EDGES[b])) & np.uint64((1 << (EDGES[b + 1] - EDGES[b])) - 1)).tolist() for b in range(BLOCKS)]
        for q in range(len(prints)):
            found = {i for b in range(BLOCKS) for i in self.tables[b].get(values[b][q], ())}
            if found:
                items = np.fromiter(found, np.int64, len(found))
                apart = np.bitwise_count(self.prints[items] ^ prints[q])
                out.extend((q, int(i)) for i in items[apart <= RADIUS])
        return out


def bag_similarity(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


@dataclass
class Item:
    item_id: int
    length: int
    shingles: np.ndarray
    bag: Counter = field(init=False)

    def __post_init__(self) -> None:
        self.bag = Counter(self.shingles.tolist())


class Catalogue:
    """A block of items, by length in words."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        cache = K.WordHashes()
        self.by_length: dict[int, list[Item]] = {}
        for item_id, raw in rows:
            h = K.hash_words(K.words(raw), cache)
            if len(h):
                self.by_length.setdefault(len(h), []).append(Item(item_id, len(h), K.window_hashes(h)))
        self.index = {n: MultiIndex([simhash(i.shingles) for i in items]) for n, items in self.by_length.items()}
        self.sizes = sorted({min(n, K.SHINGLE) for n in self.by_length})
        self.lengths_of: dict[int, set[int]] = {}
        for n, items in self.by_length.items():
            for i in items:
                for s in i.bag:
                    self.lengths_of.setdefault(s, set()).add(n)
        self.filter = np.zeros(FILTER_BITS, bool)
        self.filter[[s % FILTER_BITS for s in self.lengths_of]] = True

    def search(self, h: np.ndarray, least: float) -> list[tuple[int, int, int, float]]:
        """(item, start, end, similarity) of the best window per item in a document of word hashes."""
        best: dict[int, tuple[float, int, int]] = {}
        for size in self.sizes:
            if len(h) < size:
                continue
            shingles = K.window_hashes(h, size)
            hits = np.flatnonzero(self.filter[(shingles % np.uint64(FILTER_BITS)).astype(np.int64)])
            by_length: dict[int, list[int]] = {}
            for p in hits.tolist():
                for n in self.lengths_of.get(int(shingles[p]), ()):
                    if min(n, K.SHINGLE) == size:
                        by_length.setdefault(n, []).append(p)
            for n, places in by_length.items():
                self.windows(h, shingles, n, size, places, least, best)
        return [(item, start, end, s) for item, (s, start, end) in sorted(best.items())]

    def windows(self, h, shingles, n, size, places, least, best) -> None:
        """Fingerprints of the windows of n words (or the whole shorter text) around the places."""
        span = min(n - size + 1, len(shingles))
        runs: list[list[int]] = []
        for p in places:
            low, high = max(0, p - span + 1), min(p + span, len(shingles))
            if runs and low <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], high)
            else:
                runs.append([low, high])
        items = self.by_length[n]
        for low, high in runs:
            for at in range(low, high - span + 1, 1 << 15):
                part = shingles[at : min(high, at + (1 << 15) + span - 1)]
                for q, i in self.index[n].query(window_simhashes(part, span)):
                    item, start = items[i], at + q
                    s = bag_similarity(item.bag, Counter(part[q : q + span].tolist()))
                    if s >= least:
                        key, old = item.item_id, best.get(item.item_id)
                        if old is None or (s, -start) > (old[0], -old[1]):
                            best[key] = (s, start, min(start + n, len(h)))


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The items in blocks of bounded size; a stated query set, searched block by block."""
    slim = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    total = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_BYTES)
    return [slim.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b) for b in range(blocks)] if blocks > 1 else [slim]


def item_rows(block: DataFrame) -> list[tuple[int, bytes]]:
    """The rows of a block, whose size ``item_blocks`` bounds; items without an id share the id -1."""
    return sorted((-1 if r["item_id"] is None else r["item_id"], bytes(r["text"])) for r in block.collect())


SCHEMA = "id long, item_id long, start int, end int, similarity double"


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, item_id, start, end, similarity): the best window of each document for each item it leaks."""
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    out = []
    for block in item_blocks(items, item_col, item_text):
        catalogue = docs.sparkSession.sparkContext.broadcast(item_rows(block))

        def make(catalogue=catalogue):
            known, cache = Catalogue(catalogue.value), K.WordHashes()

            def step(batch: pa.RecordBatch):
                found = []
                for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    found.extend((row, *m) for m in known.search(K.hash_words(K.words(raw), cache), least))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kinds[k]) for k in range(5)], names=["id", "item_id", "start", "end", "similarity"])

            return step

        out.append(texts.mapInArrow(K.per_batch(make), SCHEMA))
    return reduce(DataFrame.unionAll, out)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that leak an item; all columns as they are."""
    where = docs.columns.index(text_col)
    for block in item_blocks(items, item_col, item_text):
        catalogue = docs.sparkSession.sparkContext.broadcast(item_rows(block))

        def make(catalogue=catalogue):
            known, cache = Catalogue(catalogue.value), K.WordHashes()

            def step(batch: pa.RecordBatch):
                keep = [not known.search(K.hash_words(K.words((t or "").encode()), cache), least) for t in batch.column(where).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

            return step

        docs = docs.mapInArrow(K.per_batch(make), docs.schema)
    return docs

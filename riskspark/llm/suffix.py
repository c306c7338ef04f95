"""Suffix-array dedup: bytes covered by a string of 400 bytes that also starts anywhere else.

1. Anchors: of the 32-byte grams in a window of 400 bytes the one with the least hash
   (the leftmost of equals) owns the window. Equal windows choose the same gram at the
   same offset, so windows can only repeat among the owners of one gram.
2. Grams with one owner are dropped. The rest ship their context, the owned windows in one
   piece, to the partition of the gram. A gram with more than ``CHUNK`` owners is dealt out
   over several partitions by a hash; equal contexts of a partition are held once.
3. Contexts are laid end to end in blocks and their suffixes sorted in two stages: suffixes
   smaller than their successors are sorted directly, bucket by bucket; scanning the buckets
   in order induces all others. Neighbours with a common prefix of 400 bytes repeat.
4. Only grams dealt out over several partitions send their windows, one row per distinct
   window and partition (128-bit hashes), to be counted once more.

Null and shorter texts keep all bytes. Matches never cross documents; overlaps within one
document count. Rows with null or repeated ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import common as K
from riskspark.session import materialize

LENGTH = 400
GRAM = 32
CHUNK = 8192
BLOCK = 1 << 18
SEGMENT = 1 << 20
LETTERS = K.mixed(np.arange(1, 257, dtype=np.uint64) * K.STEP)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash per run of GRAM bytes, by doubling."""
    h, width, step = LETTERS[raw], 1, int(K.STEP)
    while width < GRAM:
        h = h[:-width] * np.uint64(step) + h[width:]
        step, width = step * step % (1 << 64), 2 * width
    return K.mixed(h)


def owners(raw: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(gram hash, first, last) of the runs of window starts that one gram owns."""
    span = length - GRAM + 1
    for base in range(0, max(0, len(raw) - length + 1), SEGMENT):
        part = np.frombuffer(raw, np.uint8, min(SEGMENT + length - 1, len(raw) - base), base)
        h = gram_hashes(part)
        low = ((h >> np.uint64(24)) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate(([0], cuts))
        last = np.concatenate((cuts, [len(at)])) - 1
        keys = K.signed(h[at[first]])
        yield from zip(keys.tolist(), (first + base).tolist(), (last + base).tolist(), strict=True)


def suffix_array(raw: bytes, depth: int) -> np.ndarray:
    """Starts of all suffixes in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int32)
    t = np.frombuffer(raw, np.uint8)
    after = np.append(t[1:].astype(np.int16), -1)
    # Where a run of one letter ends decides whether its suffixes are smaller than their successors.
    ends = np.where(t != after, np.arange(n, dtype=np.int32), n)
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    small = t[ends] < after[ends]
    direct = np.flatnonzero(small).astype(np.int32)
    # Stage one: sort the smaller ones, bucket by bucket of their first two letters.
    pair = (t[direct].astype(np.int32) << 8) | after[direct].astype(np.int32)
    direct = direct[np.argsort(pair, kind="stable")]
    sizes = np.bincount(pair, minlength=1 << 16)
    at = 0
    for size in sizes[sizes > 0].tolist():
        if size > 1:
            direct[at : at + size] = sorted(direct[at : at + size].tolist(), key=lambda i: raw[i : i + depth])
        at += size
    bounds = np.concatenate(([0], np.cumsum(np.bincount(t[direct], minlength=256))))
    # Stage two: scan the buckets in order; what precedes a suffix and is larger goes to its own bucket.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[n - 1]].append(np.array([n - 1], np.int32))
    out = []
    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int32)
        larger = []
        while len(front):  # runs of one letter are induced within their bucket
            larger.append(front)
            before = front[front > 0] - 1
            front = before[t[before] == c]
        bucket = np.concatenate([*larger, direct[bounds[c] : bounds[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        letters = t[before]
        before, letters = before[letters > c], letters[letters > c]
        order = np.argsort(letters, kind="stable")
        before, letters = before[order], letters[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for piece in np.split(before, cuts) if len(before) else []:
            waiting[t[piece[0]]].append(piece)
    return np.concatenate(out)


def common_prefixes(raw: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, counted up to ``most``; 0 for the first."""
    t = np.frombuffer(raw + bytes(most + 8), np.uint8)
    n = len(raw)
    words = np.zeros(n + most, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | t[k : k + n + most]
    out = np.zeros(len(order), np.int32)
    left, right, at = order[:-1].astype(np.int64), order[1:].astype(np.int64), np.arange(1, len(order))
    for depth in range(0, most, 8):
        apart = words[left + depth] ^ words[right + depth]
        same = apart == 0
        # Leading zero bytes of the difference are the shared bytes of the last word.
        odd = apart[~same]
        shared = np.zeros(len(odd), np.int32)
        for k in range(1, 8):
            shared += (odd >> np.uint64(64 - 8 * k)) == 0
        out[at[~same]] = depth + shared
        left, right, at = left[same], right[same], at[same]
        if not len(at):
            break
    out[at] = most
    ends = n - np.maximum(order[:-1], order[1:])
    out[1:] = np.minimum(np.minimum(out[1:], ends), most)
    return out


def repeated_windows(contexts: list[bytes], copies: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """Which window starts of each context repeat; ``copies`` tells how often the context itself occurs."""
    starts = np.cumsum([0, *map(len, contexts)])
    raw = b"".join(contexts)
    owned = np.zeros(len(raw), bool)
    again = np.zeros(len(raw), bool)
    for at, context, n in zip(starts.tolist(), contexts, copies, strict=False):
        owned[at : at + len(context) - length + 1] = True
        again[at : at + len(context) - length + 1] = n > 1
    order = suffix_array(raw, length)
    order = order[owned[order]]
    equal = common_prefixes(raw, order, length) >= length
    again[order[equal]] = True
    again[order[np.flatnonzero(equal) - 1]] = True
    return [again[at : at + len(c) - length + 1] for at, c in zip(starts.tolist(), contexts, strict=False)]


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """(start, end) byte runs covered by windows at the ascending ``starts``."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length)
    first = starts[np.concatenate(([0], cuts + 1))]
    last = starts[np.concatenate((cuts, [len(starts) - 1]))] + length
    return list(zip(first.tolist(), last.tolist(), strict=True))


SPAN = "array<struct<start:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, spans): byte runs to remove, for every row that has some. ``rows`` is (row, id, text)."""
    texts = rows.select("row", F.col("text").cast("binary").alias("text"))

    def anchors(batches):
        for batch in batches:
            ids, raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 1000):
                found = [(i, *o) for i, raw in zip(ids[at : at + 1000], raws[at : at + 1000], strict=True) if raw for o in owners(raw, length)]
                if found:
                    table = np.array(found, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(table[:, k]) for k in range(4)], names=["row", "key", "first", "last"])

    found = materialize(texts.mapInArrow(anchors, "row long, key long, first long, last long"), "anchors")
    # Written, so that the join that follows is one of two plain exchanges, whose hot keys Spark can split.
    shared = materialize(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("lots")), "shared-keys")
    wanted = materialize(found.join(shared, "key"), "shared-anchors")
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "first", "last", "lots")).alias("marks"))
    held = K.among(texts, "row", wanted.select("row")).join(per_row, "row").select("row", "text", "marks")

    def cut(batches):
        names = ["key", "lot", "lots", "row", "first", "context"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            out, size = [], 0
            for row, raw, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for m in marks:
                    context = raw[m["first"] : m["last"] + length]
                    lot = xxhash.xxh3_64_intdigest(f"{row} {m['first']}") % m["lots"] if m["lots"] > 1 else 0
                    out.append((m["key"], lot, m["lots"], row, m["first"], context))
                    size += len(context)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    contexts = held.mapInArrow(cut, "key long, lot long, lots int, row long, first long, context binary")
    dealt = contexts.repartition("key", "lot").sortWithinPartitions("key", "lot")

    def search(batches):
        """Runs of repeated window starts; for grams in several partitions also every window, to be counted once more."""
        names = ["row", "start", "stop", "high", "low", "seen"]
        kinds = [pa.int64()] * 5 + [pa.bool_()]

        def flush(block):
            done = []
            contexts, holders = [c for g in block for c in g[1]], [h for g in block for h in g[1].values()]
            open_groups = [g[0] > 1 for g in block for _ in g[1]]
            # A context alone in its group, or groups of contexts that all occur twice, need no order.
            flags = repeated_windows(contexts, [len(h) for h in holders], length) if any(len(g[1]) > 1 for g in block) else [np.full(len(c) - length + 1, len(h) > 1) for c, h in zip(contexts, holders, strict=True)]
            for context, places, again, many in zip(contexts, holders, flags, open_groups, strict=True):
                starts = np.flatnonzero(again)
                for begin, end in spans_of(starts, 1):
                    done.extend((row, first + begin, first + end, None, None, True) for row, first in places)
                if many:
                    for s, seen in enumerate(again.tolist()):
                        high, low = divmod(xxhash.xxh3_128_intdigest(context[s : s + length]), 1 << 64)
                        row, first = places[0]
                        done.append((row, first + s, first + s + 1, high - (1 << 63), low - (1 << 63), seen))
            for at in range(0, len(done), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done[at : at + 20_000], strict=True), kinds, strict=True)], names=names)

        alone, block, size, key, group = [], [], 0, None, None
        for batch in batches:
            for k, lot, lots, row, first, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k, lot) != key:
                    if group is not None:
                        (block if len(group[1]) > 1 else alone).append(group)
                        size += sum(map(len, group[1]))
                    if size >= BLOCK:
                        yield from flush(block)
                        yield from flush(alone)
                        alone, block, size = [], [], 0
                    key, group = (k, lot), (lots, {})
                group[1].setdefault(context, []).append((row, first))
        if group is not None:
            (block if len(group[1]) > 1 else alone).append(group)
        yield from flush(block)
        yield from flush(alone)

    schema = "row long, start long, stop long, high long, low long, seen boolean"
    marks = materialize(dealt.mapInArrow(search, schema), "windows")
    windows = marks.where("high is not null")
    twice = windows.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1")
    late = windows.where("not seen").join(twice, ["high", "low"]).select("row", "start", "stop")
    starts = marks.where("high is null").select("row", "start", "stop").unionAll(late)
    per_row = starts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("runs"))

    def join_runs(batches):
        for batch in batches:
            out = []
            for runs in batch.column(1).to_pylist():
                spans: list[list[int]] = []
                for r in runs:
                    end = r["stop"] - 1 + length
                    if spans and r["start"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([r["start"], end])
                out.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, SPAN_TYPE)], names=["row", "spans"])

    return materialize(per_row.mapInArrow(join_runs, f"row long, spans {SPAN}"), "spans")


def without(raw: bytes, spans: list[dict]) -> bytes:
    """What is left of a text outside its spans."""
    at, out = 0, []
    for s in spans:
        out.append(raw[at : s["start"]])
        at = s["end"]
    return b"".join([*out, raw[at:]])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(row, id, spans, kept binary) for rows with repeated bytes; all other rows keep their text."""
    rows = K.with_rows(docs, id_col, text_col, "suffix")
    spans = repeated_spans(rows, length)
    held = K.among(rows.select("row", "id", F.col("text").cast("binary").alias("text")), "row", spans.select("row")).join(spans, "row").select("row", "id", "text", "spans")

    def make():
        def step(batch: pa.RecordBatch):
            kept = [without(raw, s) for raw, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(kept, pa.binary())], names=["row", "id", "spans", "kept"])

        return step

    return held.mapInArrow(K.per_batch(make), f"row long, id long, spans {SPAN}, kept binary")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    rows = K.with_rows(docs, id_col, text_col, "suffix")
    cut = deduplicated(rows.select(F.col("row").alias("id"), "text"), "id", "text", length).select(
        F.col("row").alias("cut"), F.size("spans").cast("long").alias("n_spans"), F.octet_length("kept").cast("long").alias("n_kept"), F.sha2("kept", 256).alias("sha")
    )
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    whole = rows.select("row", "id", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    joined = whole.join(cut, F.col("row") == F.col("cut"), "left")
    removed = F.coalesce(F.col("n_bytes") - F.col("n_kept"), F.lit(0).cast("long"))
    return joined.select("id", "n_bytes", removed.alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))

"""Language-model scoring with Brown class-based bigrams.

A text is its words (A-Z lower-cased) and one end. Every text is split and hashed once: chunks of
about ``CHUNK_BYTES`` are written as places in the chunk's own list of words, and
all later passes read those numbers. Over the training rows:

1. Counts of every word, by 64-bit hash, in one aggregation that grows with the corpus.
2. Exchange clustering: the ``CLUSTERED`` most frequent words start in classes by rank; each
   word in turn moves to the class that raises the likelihood of the class bigrams most,
   until no word moves. It needs the bigram counts of these words only, a table of bounded size.
3. Every other training word is placed in the class that raises the likelihood most, first by its neighbours
   among the clustered words, then once more by all its neighbours, whose classes are known by
   then. Chunks send the counts of their words by range of the hash, each range places its words
   and answers every chunk; no task and no table holds the vocabulary.
4. Class bigrams over all tokens. P(word | before) = P(class | class before) P(word | class),
   the first smoothed by 0.1 per class, the second by 0.1 per word and one unknown word.
   The end is a class of its own. An unknown word takes the class that holds most of the words
   met once of its shape, told by its letters.

Scoring adds up per text what the answers say of its words; no vocabulary is
ever collected. The base score is the unigram log-probability of the contract.

Null texts are empty: one end token. Without training tokens every probability is that of
smoothing alone. Rows with null or repeated ids are scored as rows of their own; a null
id is a training row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import common as K
from riskspark.session import discard, materialize

HEAD = 1 << 16  # the most words that are clustered by exchange, collected and broadcast
CLUSTERED = 1024
CLASSES = 48
END = b" "  # no word holds a blank
END_HASH = int(np.uint64(K.WordHashes()[END]).view(np.int64))
SMOOTH = 0.1
SHAPES = 24
CHUNK_BYTES = 6 << 20
BUCKET_TOKENS = 1 << 20
# Context entries of words whose gains are computed at once.
AT_ONCE = 1 << 15


def shape(word: bytes) -> int:
    """The class of a word outside the clustered ones: how it ends, whether it has digits or other signs, its length."""
    last = word[-1:]
    ending = 0 if last.isalnum() or last >= b"\x80" else 1 if last in b".!?" else 2
    kind = 3 if any(c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c < 0x80 for c in word[:-1]) or any(0x30 <= c <= 0x39 for c in word) else min(2, len(word) // 5)
    long = len(word) >= 12
    return (ending * 4 + kind) * 2 + long


class Known(dict):
    """Word -> (hash, shape), remembered for the words a task meets again; emptied when full."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= K.CACHE_WORDS:
            self.clear()
        self[word] = value = (xxhash.xxh3_64_intdigest(word), shape(word))
        return value


CODED = "chunk long, size long, distinct long, rows array<long>, ids array<long>, taught binary, words binary, sizes binary, codes binary, shapes binary, counts binary"


def packed(x: np.ndarray, kind: type) -> bytes:
    """Numbers in few bytes: all first bytes first, compressed."""
    return pa.compress(np.frombuffer(x.astype(kind).tobytes(), np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def unpacked(raw: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(raw, n * size, codec="zstd"), np.uint8).reshape(size, n).T.copy().view(kind).ravel()


def split(texts: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(words per text, place of every word, the distinct words); as ``K.words``, for many texts at once."""
    sizes, parts = [], []
    for part in texts:
        part = pc.fill_null(part, b"")
        made = pc.ascii_split_whitespace(pc.ascii_lower(pa.Array.from_buffers(pa.string(), len(part), part.buffers(), offset=part.offset)))
        flat = made.flatten()
        real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(part)), np.diff(made.offsets.to_numpy()))
        sizes.append(np.bincount(owner[real], minlength=len(part)))
        parts.append(flat.filter(pa.array(real)).cast(pa.binary()))
    listed = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    return np.concatenate(sizes), listed.indices.to_numpy(), listed.dictionary.to_pylist()


def coded(rows: DataFrame) -> DataFrame:
    """Chunks of (row, id, text, taught): the tokens of their texts as places in ``words`` (hashes), the end first.

    ``counts`` are tokens in taught texts, per word.
    """

    def code(batches):
        known = Known()

        def chunk(held):
            rows_, ids, texts, taught = zip(*held, strict=True)
            rows_, ids = (pa.chunked_array(x).combine_chunks() for x in (rows_, ids))
            taught = np.concatenate([x.to_numpy(zero_copy_only=False) for x in taught]).astype(bool)
            sizes, found, words = split(texts)
            ends = np.cumsum(sizes + 1)
            codes = np.zeros(ends[-1], np.int32)
            inside = np.ones(len(codes), bool)
            inside[ends - 1] = False
            codes[inside] = found + 1
            pairs = [known[w] for w in [END, *words]]
            hashes, shapes = np.array([h for h, _ in pairs], np.uint64), np.array([x for _, x in pairs], np.int8)
            counts = np.bincount(codes[np.repeat(taught, sizes + 1)], minlength=len(pairs))
            held_arrays = [packed(x, t) for x, t in ((sizes, np.int32), (codes, np.int32), (shapes, np.int8), (counts, np.int32))]
            row = [rows_[0], pa.scalar(len(codes)), pa.scalar(len(pairs)), pa.ListArray.from_arrays([0, len(rows_)], rows_), pa.ListArray.from_arrays([0, len(ids)], ids), taught.tobytes(), hashes.tobytes(), *held_arrays]
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.ListArray) else pa.array([x.as_py() if isinstance(x, pa.Scalar) else x], t) for x, t in zip(row, CODED_ARROW.types, strict=True)], schema=CODED_ARROW)

        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                # Texts up to the end of the chunk, one at least.
                before = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES - size)))
                held.append(batch.slice(at, stop - at).columns)
                size += int(ends[stop - 1]) - before
                at = stop
                if at < batch.num_rows or size >= CHUNK_BYTES:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    return materialize(rows.select("row", "id", F.col("text").cast("binary"), "taught").mapInArrow(code, CODED), "coded")


CODED_ARROW = pa.schema(
    [("chunk", pa.int64()), ("size", pa.int64()), ("distinct", pa.int64()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("taught", "words", "sizes", "codes", "shapes", "counts")]
)


class Chunk:
    """The arrays of a row of ``coded``, as far as it holds them."""

    def __init__(self, row: dict):
        self.key, n, self.rows, self.ids = row["chunk"], row["distinct"], row.get("rows"), row.get("ids")
        self.taught = np.frombuffer(row["taught"], bool)
        self.sizes = unpacked(row["sizes"], len(self.taught), np.int32).astype(np.int64) + 1
        self.ends = np.cumsum(self.sizes)
        self.codes = unpacked(row["codes"], row["size"], np.int32)
        self.shapes = unpacked(row["shapes"], n, np.int8)
        if "words" in row:
            self.words = np.frombuffer(row["words"], np.uint64)
            self.counts = unpacked(row["counts"], n, np.int32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(place before, place) of the tokens of taught texts; a text begins after an end."""
        before = np.concatenate(([0], self.codes[:-1]))
        before[self.ends[:-1]] = 0
        chosen = np.repeat(self.taught, self.sizes)
        return before[chosen], self.codes[chosen]


def chunks(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield Chunk(batch.slice(k, 1).to_pylist()[0])


def word_counts(table: DataFrame) -> DataFrame:
    """(word, n): every distinct token of the taught texts by its hash."""

    def spread(batches):
        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1), strict=True):
                words = np.frombuffer(words.as_py(), np.int64)
                counts = unpacked(counts.as_py(), len(words), np.int32)
                met = counts > 0
                yield pa.RecordBatch.from_arrays([pa.array(words[met]), pa.array(counts[met].astype(np.int64))], names=["word", "n"])

    return materialize(table.select("words", "counts").mapInArrow(spread, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def summed(found: DataFrame, size: int) -> np.ndarray:
    """Counts (cell, n) as a (size, size) matrix."""
    rows = found.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(size, size)


def places_of(words: np.ndarray, listed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each word among the sorted ``listed`` ones, -1 for others."""
    if not len(listed):
        return np.full(len(words), -1, np.int64)
    at = np.minimum(np.searchsorted(listed, words), len(listed) - 1)
    return np.where(listed[at] == words, values[at], -1)


def bigram_counts(table: DataFrame, listed: np.ndarray) -> np.ndarray:
    """Counts of neighbouring tokens among the words ``listed`` (hashes)."""
    size, order = len(listed), np.argsort(listed)
    shared = table.sparkSession.sparkContext.broadcast((listed[order], order))

    def count(batches):
        total = np.zeros(size * size, np.int64)
        for chunk in chunks(batches):
            rank = places_of(chunk.words, *shared.value)
            left, right = (rank[c] for c in chunk.pairs())
            both = (left >= 0) & (right >= 0)
            total += np.bincount(left[both] * size + right[both], minlength=size * size)
        cells = np.flatnonzero(total)
        for at in range(0, len(cells), 1 << 16):
            part = cells[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])

    return summed(table.mapInArrow(count, "cell int, n long"), size)


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(counts: np.ndarray, k: int) -> np.ndarray:
    """Class per word: words move one by one to the class that raises the likelihood most.

    The likelihood of class bigrams is sum N(c,d) log N(c,d) - sum N(c.) log N(c.) -
    sum N(.c) log N(.c). Ties go to the lower class; a word that gains nothing stays. It ends
    when a sweep over all words moves none; every move raises the likelihood, so none comes back.
    """
    n = len(counts)
    k = min(k, n)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = np.arange(n) % k
    member = np.zeros((n, k))
    member[np.arange(n), cls] = 1
    counts = counts.astype(float)
    pair = member.T @ counts @ member
    rows, cols = counts.sum(axis=1), counts.sum(axis=0)
    left, right = member.T @ rows, member.T @ cols
    to, come = counts @ member, counts.T @ member  # per word: counts to and from each class
    least = max(1e-9, 1e-13 * float(xlogx(counts.sum())))  # smaller gains may be rounding, and would go round for ever
    moved = 1
    while moved:
        moved = 0
        for w in range(n):
            a, self_n = cls[w], counts[w, w]
            out, into = to[w].copy(), come[w].copy()
            out[a] -= self_n
            into[a] -= self_n
            base = pair.copy()
            base[a, :] -= out
            base[:, a] -= into
            base[a, a] -= self_n
            l0, r0 = left.copy(), right.copy()
            l0[a] -= rows[w]
            r0[a] -= cols[w]
            # Adding the word to class b changes row b, column b and the cell (b, b).
            row_gain = (xlogx(base + out[None, :]) - xlogx(base)).sum(axis=1)
            col_gain = (xlogx(base + into[:, None]) - xlogx(base)).sum(axis=0)
            d = np.arange(k)
            diag = base[d, d]
            both = xlogx(diag + out + into + self_n) - xlogx(diag + out) - xlogx(diag + into) + xlogx(diag)
            gains = row_gain + col_gain + both - (xlogx(l0 + rows[w]) - xlogx(l0)) - (xlogx(r0 + cols[w]) - xlogx(r0))
            b = int(gains.argmax())
            if gains[b] <= gains[a] + least:
                continue
            pair = base
            pair[b, :] += out
            pair[:, b] += into
            pair[b, b] += self_n
            left, right = l0, r0
            left[b] += rows[w]
            right[b] += cols[w]
            to[:, a] -= counts[:, w]
            to[:, b] += counts[:, w]
            come[:, a] -= counts[w, :]
            come[:, b] += counts[w, :]
            cls[w] = b
            moved += 1
    return cls


# Messages between chunks and ranges of hashes. Bucket -1 holds the class bigrams of a chunk as entries.
MESSAGE = "bucket int, chunk long, n int, entries int, places binary, words binary, shapes binary, counts binary, cls binary, sizes binary, cells binary, times binary"
MESSAGE_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("entries", pa.int32()), *[(c, pa.binary()) for c in ("places", "words", "shapes", "counts", "cls", "sizes", "cells", "times")]])
# What a range answers a chunk; with a null chunk, the words of the range themselves.
ANSWER = "chunk long, n int, places binary, words binary, shapes binary, counts binary, cls binary"
ANSWER_ARROW = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("places", "words", "shapes", "counts", "cls")]])


def messages(chunk: Chunk, cls: np.ndarray, n: int, buckets: int) -> pa.RecordBatch:
    """Per range of hashes, the words of a chunk with their counts in taught texts and the classes beside them.

    Entries of a word: class ``c`` after it (cell c), class ``c`` before it (n + c), itself after itself (2 n).
    Neighbours without a class (-1) are left out.
    """
    before, after = chunk.pairs()
    left, right = cls[before].astype(np.int64), cls[after].astype(np.int64)
    same = before == after
    width = 2 * n + 1
    ends = np.concatenate([before[(right >= 0) & ~same] * width + right[(right >= 0) & ~same], after[(left >= 0) & ~same] * width + n + left[(left >= 0) & ~same], before[same] * width + 2 * n])
    entries, times = np.unique(ends, return_counts=True)
    owner, cell = np.divmod(entries, width)
    sizes = np.bincount(owner, minlength=len(chunk.words))
    begin = np.cumsum(sizes) - sizes
    bucket = ((chunk.words >> np.uint64(44)).astype(np.int64) * buckets) >> 20
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    out = []
    for some in np.split(order, first[1:]):
        size = sizes[some]
        at = np.repeat(begin[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out.append(
            (int(bucket[some[0]]), chunk.key, len(some), len(at), packed(np.diff(some, prepend=0), np.int32), chunk.words[some].tobytes(), packed(chunk.shapes[some], np.int8), packed(chunk.counts[some], np.int32))
            + (packed(cls[some], np.int16), packed(size, np.int32), packed(cell[at], np.int16), packed(times[at], np.int32))
        )
    known = (left >= 0) & (right >= 0)
    moves = np.bincount(left[known] * n + right[known], minlength=n * n)
    cells = np.flatnonzero(moves)
    out.append((-1, chunk.key, 0, len(cells), b"", b"", b"", b"", b"", b"", packed(cells, np.int32), packed(moves[cells], np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), MESSAGE_ARROW.types, strict=True)], schema=MESSAGE_ARROW)


def class_bigrams(sent: DataFrame, n: int) -> np.ndarray:
    def spread(batches):
        for batch in batches:
            for size, *found in zip(*batch.columns, strict=True):
                cells, times = (unpacked(x.as_py(), size.as_py(), np.int32) for x in found)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(times.astype(np.int64))], names=["cell", "n"])

    return summed(sent.where("bucket = -1").select("entries", "cells", "times").mapInArrow(spread, "cell int, n long"), n).astype(float)


def gains(pair: np.ndarray, out: np.ndarray, into: np.ndarray, same: np.ndarray, now: np.ndarray) -> np.ndarray:
    """(words, classes): the likelihood of the class bigrams ``pair`` with a word in a class, but for a number per word.

    ``out`` and ``into`` count the classes after and before each word, without the word itself, ``same`` the word
    after itself; ``now`` is the class whose bigrams hold the word already, or -1.
    """
    n = len(pair)
    held = np.flatnonzero(now >= 0)
    total = np.zeros(out.shape)
    # Adding a word to class b changes row b, column b and the cell (b, b).
    for counts, others, table in ((out, into, pair.T), (into, out, pair)):
        w, d = np.nonzero(counts)
        for at in range(0, len(w), AT_ONCE):
            word, other = w[at : at + AT_ONCE], d[at : at + AT_ONCE]
            more = counts[word, other]
            base = table[other]
            mine = now[word]
            hit = np.flatnonzero(mine == other)
            base[hit] -= others[word[hit]]
            base[hit, mine[hit]] -= same[word[hit]]
            has = np.flatnonzero(mine >= 0)
            base[has, mine[has]] -= more[has]
            change = xlogx(base + more[:, None]) - xlogx(base)
            first = np.flatnonzero(np.concatenate(([True], np.diff(word) != 0)))
            total[word[first]] += np.add.reduceat(change, first, axis=0)
    diag = np.tile(np.diag(pair), (len(out), 1))
    diag[held, now[held]] -= out[held, now[held]] + into[held, now[held]] + same[held]
    total += xlogx(diag + out + into + same[:, None]) - xlogx(diag + out) - xlogx(diag + into) + xlogx(diag)
    for counts, others, side in ((out, into, pair.sum(axis=1)), (into, out, pair.sum(axis=0))):
        own = counts.sum(axis=1) + same
        rest = side + np.where(now[:, None] < 0, others, 0)  # the neighbours' bigrams with the word
        rest[held, now[held]] -= own[held]
        total -= xlogx(rest + own[:, None]) - xlogx(rest)
    return total


def placed(sent: DataFrame, pair: np.ndarray, fixed: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Answers to the chunks: per word its count and the class that raises the likelihood most, -1 if it has no taught token.

    ``fixed`` words (sorted hashes, classes) keep their class. Ties go to the lower class; a word that gains nothing stays.
    """
    n = len(pair)
    shared = sent.sparkSession.sparkContext.broadcast((pair, fixed))

    def place(table: pa.Table) -> pa.Table:
        pair, fixed = shared.value
        sizes, entries = table["n"].to_pylist(), table["entries"].to_pylist()
        kinds = {"shapes": np.int8, "counts": np.int32, "cls": np.int16, "sizes": np.int32, "cells": np.int16, "times": np.int32}
        held = {c: [unpacked(x.as_py(), n, t) for x, n in zip(table[c], entries if c in ("cells", "times") else sizes, strict=True)] for c, t in kinds.items()}
        held["words"] = [np.frombuffer(x.as_py(), np.uint64) for x in table["words"]]
        words, first, back = np.unique(np.concatenate(held["words"]), return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate(held["counts"]).astype(float), len(words)).astype(np.int64)
        shapes, now = np.concatenate(held["shapes"])[first], np.concatenate(held["cls"])[first].astype(np.int64)
        key = np.repeat(back, np.concatenate(held["sizes"])) * (2 * n + 1) + np.concatenate(held["cells"])
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.concatenate(held["times"])[order].astype(float)
        starts = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0))) if len(key) else np.zeros(0, np.int64)
        owner, cell = np.divmod(key[starts], 2 * n + 1)
        times = np.add.reduceat(times, starts) if len(key) else times
        cls = places_of(words, *fixed)
        for at in range(0, len(words), 4096):
            some = slice(at, min(at + 4096, len(words)))
            lo, hi = np.searchsorted(owner, (some.start, some.stop))
            matrix = np.zeros((some.stop - some.start, 2 * n + 1))
            matrix[owner[lo:hi] - some.start, cell[lo:hi]] = times[lo:hi]
            found = gains(pair, matrix[:, :n], matrix[:, n : 2 * n], matrix[:, 2 * n], now[some])[:, : n - 1]  # the end is a class of its own
            best = found.argmax(axis=1)
            mine = np.clip(now[some], 0, n - 2)
            each = np.arange(len(best))
            stays = (now[some] >= 0) & (found[each, best] <= found[each, mine] + 1e-9)
            best = np.where(stays, mine, best)
            free = (cls[some] < 0) & (counts[some] > 0)
            cls[some] = np.where(free, best, cls[some])
        out = [(None, len(words), b"", words.tobytes(), packed(shapes, np.int8), packed(counts, np.int64), packed(cls, np.int16))]
        at = np.cumsum([0, *sizes])
        for k, (chunk, places) in enumerate(zip(table["chunk"].to_pylist(), table["places"], strict=True)):
            some = back[at[k] : at[k + 1]]
            out.append((chunk, sizes[k], places.as_py(), b"", b"", packed(counts[some], np.int64), packed(cls[some], np.int16)))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), ANSWER_ARROW.types, strict=True)], schema=ANSWER_ARROW)

    return materialize(sent.where("bucket >= 0").groupBy("bucket").applyInArrow(place, ANSWER), "placed")


def answered(chunk: Chunk, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(count, class) per word of a chunk; 0 and -1 for words without an answer."""
    counts, cls = np.zeros(len(chunk.shapes), np.int64), np.full(len(chunk.shapes), -1, np.int64)
    for size, *found in zip(*(answers[c] for c in ("n", "places", "counts", "cls")), strict=True):
        places, n, c = (unpacked(x.as_py(), size.as_py(), t) for x, t in zip(found, (np.int32, np.int64, np.int16), strict=True))
        at = np.cumsum(places)
        counts[at], cls[at] = n, c
    return counts, cls


def with_answers(table: DataFrame, answers: DataFrame, step, schema: str) -> DataFrame:
    """``step(chunk, counts, classes)`` of every chunk, a record batch each."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left.to_pylist()[0])
        return pa.Table.from_batches([step(chunk, *answered(chunk, right))])

    replies = answers.where("chunk is not null").select("chunk", "n", "places", "counts", "cls")
    return table.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


@dataclass
class Model:
    n_classes: int  # the last one is the end
    tokens: int
    distinct: int
    class_tokens: np.ndarray  # per class, tokens
    class_words: np.ndarray  # per class, distinct words
    unknown: np.ndarray  # class of an unknown word, per shape
    transitions: np.ndarray | None = None  # log10 P(class | class before)


def transition_counts(texts: DataFrame, n: int) -> np.ndarray:
    def count(batches):
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                cls = np.frombuffer(raw.as_py(), np.uint16).astype(np.int64)
                total += np.bincount(np.concatenate(([n - 1], cls[:-1])) * n + cls, minlength=n * n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * n, dtype=np.int32)), pa.array(total)], names=["cell", "n"])

    return summed(texts.where("taught").select("cls").mapInArrow(count, "cell int, n long"), n)


def classified(table: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """(row, id, taught, n_tokens, n_known, base_score, emitted, cls) per text: its classes, and the log10 P(word | class) summed."""
    shared = table.sparkSession.sparkContext.broadcast(model)
    names = ["row", "id", "taught", "n_tokens", "n_known", "base_score", "emitted", "cls"]

    def step(chunk: Chunk, counts: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
        model = shared.value
        end = model.n_classes - 1
        cls = np.where(cls >= 0, cls, model.unknown[chunk.shapes])
        cls[0] = end
        below = np.log10(model.class_tokens + SMOOTH * (model.class_words + 1))
        emit = np.log10(counts + SMOOTH) - below[cls]
        emit[0] = 0.0  # its class holds nothing else
        base = np.log10(counts + SMOOTH) - np.log10(model.tokens + SMOOTH * (model.distinct + 1))
        first = chunk.ends - chunk.sizes
        sums = [np.add.reduceat(x[chunk.codes], first) for x in ((counts > 0).astype(np.int64), base, emit)]
        listed = cls[chunk.codes].astype(np.uint16)
        raw = [listed[a:b].tobytes() for a, b in zip(first.tolist(), chunk.ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(chunk.rows, pa.int64()), pa.array(chunk.ids, pa.int64()), pa.array(chunk.taught), pa.array(chunk.sizes), *map(pa.array, sums), pa.array(raw, pa.binary())], names=names)

    schema = "row long, id long, taught boolean, n_tokens long, n_known long, base_score double, emitted double, cls binary"
    return materialize(with_answers(table.drop("words", "counts"), answers, step, schema), "classified")


def spread_words(answers: DataFrame) -> DataFrame:
    """(word, shape, n, cls) of the training words."""

    def spread(batches):
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                size = row[0].as_py()
                words = np.frombuffer(row[1].as_py(), np.int64)
                shapes, n, cls = (unpacked(x.as_py(), size, t) for x, t in zip(row[2:], (np.int8, np.int64, np.int16), strict=True))
                met = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(words[met]), pa.array(shapes[met].astype(np.int32)), pa.array(n[met]), pa.array(cls[met].astype(np.int32))], names=["word", "shape", "n", "cls"])

    return answers.where("chunk is null").select("n", "words", "shapes", "counts", "cls").mapInArrow(spread, "word long, shape int, n long, cls int")


def learned(table: DataFrame, classes: int, clustered: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the taught texts of the chunks, the answers to the chunks, and their texts as ``classified``."""
    words = word_counts(table)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    top = words.orderBy(F.desc("n"), "word").limit(min(clustered, HEAD)).toArrow()
    listed = top["word"].to_numpy().view(np.uint64)
    counts = bigram_counts(table, listed) if len(listed) else np.zeros((0, 0), np.int64)
    cls = exchange(counts, classes)
    end = max(int(cls.max(initial=-1)) + 1, 1)
    n = end + 1
    cls = np.where(listed == np.uint64(np.int64(END_HASH).view(np.uint64)), end, cls)
    if END_HASH not in top["word"].to_pylist():  # no training rows, or ends rarer than all clustered words
        listed, cls = np.append(listed, np.int64(END_HASH).view(np.uint64)), np.append(cls, end)
        counts = np.pad(counts, ((0, 1), (0, 1)))
    member = np.zeros((len(cls), n))
    member[np.arange(len(cls)), cls] = 1
    order = np.argsort(listed)
    fixed = (listed[order], cls[order])
    shared = table.sparkSession.sparkContext.broadcast(fixed)
    size = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = min(1 << 20, -(-int(size) // BUCKET_TOKENS) or 1)

    def near(batches):
        for chunk in chunks(batches):
            yield messages(chunk, places_of(chunk.words, *shared.value), n, buckets)

    # First by the clustered neighbours, then by all.
    answers = placed(table.mapInArrow(near, MESSAGE), member.T @ counts @ member, fixed)
    nearest = answers
    sent = materialize(with_answers(table.drop("rows", "ids"), answers, lambda chunk, _, cls: messages(chunk, cls, n, buckets), MESSAGE), "contexts")
    answers = placed(sent, class_bigrams(sent, n), fixed)
    discard(words, nearest, sent)
    per = spread_words(answers).groupBy("cls", "shape").agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("once")).toArrow()
    kind, form, tokens, held, once = (per[c].to_numpy() for c in ("cls", "shape", "n", "v", "once"))
    of_shape = np.zeros((SHAPES, n))
    np.add.at(of_shape, (form, kind), once + held / (1 + held.sum()))
    of_shape[:, end] = -1
    of_shape += of_shape.sum(axis=0) / (1 + of_shape.sum()) * (of_shape.sum(axis=1, keepdims=True) <= 0)
    model = Model(n, int(totals["tokens"]), int(totals["distinct"]), np.bincount(kind, tokens, n), np.bincount(kind, held, n), of_shape[:, :end].argmax(axis=1))
    texts = classified(table, answers, model)
    moves = transition_counts(texts, n)
    model.transitions = np.log10(moves + SMOOTH) - np.log10(moves.sum(axis=1, keepdims=True) + SMOOTH * n)
    return model, answers, texts


def train(rows: DataFrame, classes: int = CLASSES, clustered: int = CLUSTERED) -> tuple[Model, DataFrame]:
    """The model of the training rows (text), and (word, shape, n, cls) of all their words."""
    table = coded(rows.select(F.monotonically_increasing_id().alias("row"), F.lit(None).cast("long").alias("id"), "text", F.lit(True).alias("taught")))
    model, answers, _ = learned(table, classes, clustered)
    return model, spread_words(answers)


def from_words(table: DataFrame, words: DataFrame) -> DataFrame:
    """Answers to chunks of any rows from the words of a training."""

    def ask(batches):
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = np.frombuffer(raw.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), key, np.int64)), pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)], names=["chunk", "place", "word"])

    def pack(found: pa.Table) -> pa.Table:
        columns = [packed(x, t) for x, t in ((np.diff(found["place"].to_numpy(), prepend=0), np.int32), (found["n"].to_numpy(), np.int64), (found["cls"].to_numpy(), np.int16))]
        return pa.Table.from_arrays([pa.array([found["chunk"][0].as_py()]), pa.array([len(found)], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]], names=["chunk", "n", "places", "counts", "cls"])

    met = table.select("chunk", "words").mapInArrow(ask, "chunk long, place int, word long").join(words, "word").select("chunk", "place", "n", "cls")
    return met.groupBy("chunk").applyInArrow(pack, "chunk long, n int, places binary, counts binary, cls binary")


def scored(texts: DataFrame, model: Model) -> DataFrame:
    """(row, id, n_tokens, n_known, base_score, score) of ``classified`` texts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def add(batches):
        for batch in batches:
            moves, n = shared.value.transitions.ravel(), shared.value.n_classes
            found = []
            for raw in batch.column(6):
                cls = np.frombuffer(raw.as_py(), np.uint16).astype(np.int64)
                found.append(moves[np.concatenate(([n - 1], cls[:-1])) * n + cls].sum())
            score = np.array(found) + batch.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(score, pa.float64())], names=["row", "id", "n_tokens", "n_known", "base_score", "score"])

    return texts.select("row", "id", "n_tokens", "n_known", "base_score", "emitted", "cls").mapInArrow(add, "row long, id long, n_tokens long, n_known long, base_score double, score double")


def scores(rows: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """(row, id, n_tokens, n_known, base_score, score) of (row, id, text)."""
    table = coded(rows.select("row", "id", "text", F.lit(False).alias("taught")))
    return scored(classified(table, from_words(table, words), model), model)


def held_out(id_col: str = "id", folds: int = 10) -> F.Column:
    return F.coalesce(F.expr(f"crc32(cast(`{id_col}` as string)) % {folds} = 0"), F.lit(False))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row; held-out rows teach nothing."""
    rows = K.with_rows(docs, id_col, text_col, "brown")
    table = coded(rows.select("row", "id", "text", (~held_out("id", folds)).alias("taught")))
    model, answers, texts = learned(table, CLASSES, CLUSTERED)
    discard(table, answers)
    out = scored(texts, model)
    return out.select(
        "id", held_out("id", folds).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )

"""Cross-tokenizer alignment: where the tokens of two tokenizers of the same bytes end together, and which overlap.

A encodes " " + text with a byte-level BPE vocabulary (as the tokenizers library does with
its ``.json`` file, without special tokens: their strings are plain text; here by tiktoken
over the same vocabulary as ranks, which the tests hold equal); B encodes the text with a sentencepiece model, which adds
the space itself. A token's bytes: A's vocabulary entry, byte-level decoded; B's piece in
UTF-8 with U+2581 as a space and <0xHH> as the byte HH. A text is aligned only if both
sequences join to exactly the bytes of " " + text; otherwise it has no tokens.

Method, per text: the end offsets of both sequences are sorted lists. A galloping
intersection, driven by the shorter list, finds the common ends: each key of the shorter
list starts from a hint, doubles its step into the longer list until it passes the key,
then halves back (exponential, then binary search; numpy runs all keys at once). The
indices of the common ends slice both sequences into groups. The same pass gives every
token of the shorter list the rank of its end among the longer list's ends; differences of
consecutive ranks are the ranges of longer tokens that overlap it, which are the links.

Corpus-wide, links are pre-aggregated per text as (A id, B id) -> occurrences, summed per
pair (map-side partial aggregation), the highest count per B id is taken, and the pair
table goes back to the texts by a broadcast join if its counted size allows, a shuffle
join otherwise.

Defined results: null, empty and unalignable texts have zeros and groups_sha256 '';
repeated rows are aligned each (a row key tells them apart) and each counts corpus-wide;
an empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.bpe import PIECES
from riskspark.llm.common import per_batch, with_rows
from riskspark.session import discard, lookup, materialize

# Pair codes: A id times this plus B id (B ids are below it).
PAIR_BASE = 1 << 20
SPACE = "▁"

ALIGNED = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, mult array<long>"


def gallop(keys: np.ndarray, into: np.ndarray) -> np.ndarray:
    """For each of the sorted ``keys``, how many of the sorted ``into`` are smaller."""
    n = len(into)
    if n == 0 or len(keys) == 0:
        return np.zeros(len(keys), np.int64)
    first, last = int(into[0]), int(into[-1])
    spread = max(last - first, 1)
    hint = np.clip(((keys - first) * (n - 1)) // spread, 0, n - 1).astype(np.int64)
    # Exponential phase: bracket each key as into[lo] < key <= into[hi] (lo = -1, hi = n at the edges);
    # only keys not yet bracketed take part in the next step.
    up = into[hint] < keys
    lo = np.where(up, hint, -1).astype(np.int64)
    hi = np.where(up, n, hint).astype(np.int64)
    active, step = np.arange(len(keys)), 1
    while active.size:
        h, u, k = hint[active], up[active], keys[active]
        at = np.where(u, h + step, h - step)
        inside = (at >= 0) & (at < n)
        value = into[np.minimum(np.maximum(at, 0), n - 1)]
        passed = ~inside | np.where(u, value >= k, value < k)
        for chosen, bound in ((u & passed & inside, hi), (u & ~passed, lo), (~u & passed & inside, lo), (~u & ~passed, hi)):
            bound[active[chosen]] = at[chosen]
        active, step = active[~passed], step * 2
    # Binary phase within (lo, hi], again only where the bracket is still open.
    active = np.flatnonzero(hi - lo > 1)
    while active.size:
        mid = (lo[active] + hi[active]) // 2
        smaller = into[mid] < keys[active]
        lo[active[smaller]] = mid[smaller]
        hi[active[~smaller]] = mid[~smaller]
        active = active[hi[active] - lo[active] > 1]
    return hi


def overlaps(short_end: np.ndarray, long_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One galloping pass of the shorter list's ends into the longer's.

    Per token of the shorter list: whether its end is common, the index of that end in the
    longer list, and the range [first, past) of longer tokens it overlaps, from rank
    differences: past is one more than the ends below its end, first the ends up to its start.
    """
    rank = gallop(short_end, long_end)
    hit = rank < len(long_end)
    hit[hit] = long_end[rank[hit]] == short_end[hit]
    first = np.zeros(len(short_end), np.int64)
    first[1:] = rank[:-1] + hit[:-1]
    past = np.minimum(rank + 1, len(long_end))
    return hit, rank, first, past


class Tables:
    """Both tokenizers and, per id, its bytes as a flat array with offsets; built once per task.

    A is encoded by tiktoken over the same vocabulary given as ranks (``.tiktoken``), which
    gives the ids of the tokenizers library on the ``.json`` file (tested) four times faster.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, "rb") as handle:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, handle)}
        self.a = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b_bytes = [self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_flat, self.a_off, self.a_len = self.flat(a_bytes)
        self.b_flat, self.b_off, self.b_len = self.flat(b_bytes)
        # Decimal texts of all ids of both sides, A's first, for the digest of the groups.
        self.dec_flat, self.dec_off, self.dec_len = self.flat([str(i).encode() for i in range(len(a_bytes))] + [str(i).encode() for i in range(len(b_bytes))])
        self.b_shift = len(a_bytes)

    @staticmethod
    def flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in tokens], np.int64)
        offsets = np.zeros(len(tokens), np.int64)
        np.cumsum(lengths[:-1], out=offsets[1:])
        return np.frombuffer(b"".join(tokens), np.uint8), offsets, lengths

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()


def joined_equal(ids: np.ndarray, flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, raw: np.ndarray) -> bool:
    """Whether the bytes of the tokens, in order, are exactly ``raw``; gathered by numpy."""
    sizes = lengths[ids]
    if sizes.sum() != len(raw):
        return False
    at = np.repeat(offsets[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(raw))
    return bool(np.array_equal(flat[at], raw))


def align_one(tables: Tables, a_ids: list[int], b_ids: list[int], raw: bytes) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pair codes, occurrences) of one text."""
    nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not a_ids or not b_ids:
        return nothing
    a, b = np.asarray(a_ids, np.int64), np.asarray(b_ids, np.int64)
    data = np.frombuffer(raw, np.uint8)
    if not joined_equal(a, tables.a_flat, tables.a_off, tables.a_len, data) or not joined_equal(b, tables.b_flat, tables.b_off, tables.b_len, data):
        return nothing
    a_end, b_end = np.cumsum(tables.a_len[a]), np.cumsum(tables.b_len[b])
    a_short = len(a) <= len(b)
    short, long_ = (a_end, b_end) if a_short else (b_end, a_end)
    hit, rank, first, past = overlaps(short, long_)
    short_cut, long_cut = np.flatnonzero(hit), rank[hit]
    a_cut, b_cut = (short_cut, long_cut) if a_short else (long_cut, short_cut)
    # Links: every token of the shorter list with the range of longer tokens it overlaps.
    width = np.maximum(past - first, 0)
    s_of = np.repeat(np.arange(len(short)), width)
    l_of = np.repeat(first, width) + (np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width))
    a_of, b_of = (s_of, l_of) if a_short else (l_of, s_of)
    codes, counts = np.unique(a[a_of] * PAIR_BASE + b[b_of], return_counts=True)
    # Groups: A tokens up to each common end, then the B tokens up to it.
    group_a = np.searchsorted(a_cut, np.arange(len(a)), "left")
    group_b = np.searchsorted(b_cut, np.arange(len(b)), "left")
    order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
    element = np.concatenate([a, b + tables.b_shift])[order]
    key = np.concatenate([group_a * 2, group_b * 2 + 1])[order]
    # Every id in decimal, then ',' within a side, '|' before the B ids of a group, ';' before the next group.
    digits = tables.dec_len[element]
    sep = np.full(len(element), ord(","), np.uint8)
    sep[:-1][key[1:] != key[:-1]] = ord(";")
    sep[:-1][(key[1:] != key[:-1]) & (key[1:] % 2 == 1)] = ord("|")
    span = digits + 1
    span[-1] -= 1
    start = np.cumsum(span) - span
    out = np.empty(int(span.sum()), np.uint8)
    out[np.repeat(start - (np.cumsum(digits) - digits), digits) + np.arange(int(digits.sum()))] = tables.dec_flat[
        np.repeat(tables.dec_off[element] - (np.cumsum(digits) - digits), digits) + np.arange(int(digits.sum()))
    ]
    out[(start + digits)[:-1]] = sep[:-1]
    joined = out.tobytes()
    digest = hashlib.sha256(joined).hexdigest()
    return len(a), len(b), len(a_cut), int(width.sum()), digest, codes, counts.astype(np.int64)


def aligned_rows(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: counts, the groups' digest and the (pair, occurrences) lists; one map stage."""

    def make():
        tables = Tables(a_path, b_path)

        def step(batch: pa.RecordBatch):
            # One text at a time: the tokenizers' objects of a text are dropped before the next is encoded.
            out = []
            for t in batch.column(2).to_pylist():
                if not t:
                    out.append(align_one(tables, [], [], b""))
                    continue
                a_ids = tables.a.encode_ordinary(" " + t)
                out.append(align_one(tables, a_ids, tables.b.encode(t), (" " + t).encode()))
            cols = [pa.array([o[k] for o in out], pa.int64()) for k in range(4)]
            digests = pa.array([o[4] for o in out], pa.string())
            pairs = pa.array([o[5] for o in out], pa.list_(pa.int64()))
            mult = pa.array([o[6] for o in out], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols, digests, pairs, mult], ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "mult"])

        return step

    return rows.mapInArrow(per_batch(make), ALIGNED)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``."""
    rows = with_rows(docs, id_col, text_col, "align-rows")
    done = materialize(aligned_rows(rows, a_path, b_path), "aligned")
    links = done.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("mult").alias("mult"))))
    counts = materialize(links.groupBy("pair").agg(F.sum("mult").alias("count")), "pair-counts")
    top = counts.groupBy((F.col("pair") % PAIR_BASE).alias("b")).agg(F.max("count").alias("top"))
    stats = materialize(counts.join(top, (counts["pair"] % PAIR_BASE) == top["b"]).select("pair", "count", (F.col("count") == F.col("top")).alias("best")), "pair-stats")
    discard(counts)
    per_row = (
        links.join(lookup(stats), "pair")
        .groupBy("row")
        .agg(F.sum(F.col("mult") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("mult")).otherwise(0)).alias("n_best"))
    )
    return (
        done.drop("pairs", "mult")
        .join(per_row, "row", "left")
        .select("id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
    )

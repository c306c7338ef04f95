"""Byte-level BPE as a streaming transducer with bounded look-ahead, and an incremental decoder.

A sequence of tokens is what the merge list makes of its bytes exactly if every
adjacent pair is, so every prefix of a piece has one last token, found from the
last tokens of shorter prefixes. The transducer keeps, per open position, that
token and its start. Its look-ahead is the longest token of the vocabulary: however
the text goes on, some boundary falls within so many last bytes, hence tokens that
all paths from there share are stable and are emitted. Only open positions are kept.

Decoding feeds the bytes of one token at a time to a UTF-8 state machine, which
holds back at most three bytes of an unfinished character; bytes that are no UTF-8
become U+FFFD.

Null texts are empty: no tokens. Texts that hold the string of a special token get
its id, as the vocabulary file asks. The file's contents, not its path, go to the tasks.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import per_batch

# Fixed value: the pattern that splits text into pieces before any merge.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_PIECES = 500_000
NEVER = 1 << 60
CACHE_PAIRS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file; built on the driver and broadcast."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = byte_letters()
        self.key = xxhash.xxh3_64_intdigest(content.encode())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        merges = [tuple(bytes(letters[c] for c in side) for side in pair) for pair in pairs]
        self.ranks = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.lookahead = max(map(len, self.ids))
        # A token counts only if the merges really make it of its bytes; ``made`` has the last of these merges.
        self.whole: dict[bytes, int] = {}
        self.made: dict[int, tuple[int, int]] = {}
        for t, i in self.ids.items():
            parts, last = self.merge(t)
            if parts == [i]:
                self.whole[t] = i
                if last:
                    self.made[i] = last
        # A trie of the tokens from their last byte on: node << 8 | byte -> node, and the token that ends at a node.
        self.back: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for t, i in self.whole.items():
            node = 0
            for b in reversed(t):
                node = self.back.setdefault(node << 8 | b, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i

    def merge(self, raw: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """The merge list applied to a short string, lowest rank first; and the last pair merged."""
        parts, last = [self.ids[raw[i : i + 1]] for i in range(len(raw))], None
        while len(parts) > 1:
            best, at = NEVER, 0
            for i in range(len(parts) - 1):
                rank = self.ranks.get((parts[i], parts[i + 1]), (NEVER, 0))[0]
                if rank < best:
                    best, at = rank, i
            if best == NEVER:
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [self.ranks[last][1]]
        return parts, last

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that uses it up) of the parts that once stood at the token's right (1) or left (0) end."""
        out = [(token, NEVER)]
        while token in self.made:
            pair = self.made[token]
            rank, token = self.ranks[pair][0], pair[side]
            out.append((token, rank))
        return out


class Pairs(dict):
    """Whether two tokens may stand side by side, by left << 32 | right; remembered.

    Merges happen in the order of their ranks. The border between both falls if some part at
    the end of the left and some part at the start of the right token merge before
    they are used up inside; of equal ranks the one further left comes first.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.ends: dict[int, list[tuple[int, int]]] = {}
        self.starts: dict[int, list[tuple[int, int]]] = {}

    def __missing__(self, key: int) -> bool:
        if len(self) >= CACHE_PAIRS:
            self.clear()
        left, right = key >> 32, key & 0xFFFFFFFF
        if left not in self.ends:
            self.ends[left] = self.v.edge(left, 1)
        if right not in self.starts:
            self.starts[right] = self.v.edge(right, 0)
        ranks, stands = self.v.ranks, True
        for x, until_x in self.ends[left]:
            for y, until_y in self.starts[right]:
                met = ranks.get((x, y))
                if met is not None and met[0] < until_x and met[0] <= until_y:
                    stands = False
        self[key] = stands
        return stands


class Transducer:
    """Bytes of one piece in, stable tokens out."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs = Pairs(vocabulary)
        self.reset()

    def reset(self) -> None:
        self.base = 0  # all before it is emitted
        self.buffer = bytearray()  # the bytes from base on
        self.last: list[int] = [-1]  # last token of the prefix that ends at base + i
        self.start: list[int] = [-1]  # where that token begins, relative to base
        self.before = -1  # the token emitted last

    def push(self, raw: bytes) -> None:
        back, token_at, pairs, before = self.v.back, self.v.token_at, self.pairs, self.before
        self.buffer += raw
        buffer, last, start = self.buffer, self.last, self.start
        for end in range(len(buffer) - len(raw) + 1, len(buffer) + 1):
            node, at = 0, end
            while at:
                at -= 1
                node = back.get(node << 8 | buffer[at], -1)
                if node < 0:
                    at = -1
                    break
                token = token_at[node]
                if token >= 0 and start[at] != -2:
                    left = last[at] if at else before
                    if left < 0 or pairs[left << 32 | token]:
                        break
            else:
                at = -1
            if at < 0:  # a token reaches back over what is emitted: no boundary here
                last.append(-1)
                start.append(-2)
            else:
                last.append(token)
                start.append(at)

    def path(self, end: int) -> list[tuple[int, int]]:
        out = []
        while end > 0:
            out.append((self.last[end], end))
            end = self.start[end]
        return out[::-1]

    def stable(self) -> list[int]:
        """Tokens that every way to go on shares; they leave the buffer."""
        n = len(self.buffer)
        open_ends = [e for e in range(max(0, n - self.v.lookahead + 1), n + 1) if e == 0 or self.start[e] != -2]
        at = set(open_ends)
        while len(at) > 1:  # the paths meet where only one position is left
            top = max(at)
            at.discard(top)
            at.add(self.start[top])
        meet = at.pop()
        if meet <= 0:
            return []
        done = self.path(meet)
        self.before = done[-1][0]
        del self.buffer[:meet]
        self.last = [-1, *self.last[meet + 1 :]]
        self.start = [-1, *(s - meet if s >= meet else -2 for s in self.start[meet + 1 :])]
        self.base += meet
        return [t for t, _ in done]

    def finish(self) -> list[int]:
        out = [t for t, _ in self.path(len(self.buffer))]
        self.reset()
        return out


class Pieces(dict):
    """Piece -> its tokens, remembered for the short pieces that a task meets again."""

    FEED = 1024

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.transducer = Transducer(vocabulary)

    def stream(self, piece: str) -> Iterator[int]:
        """The tokens of one piece, emitted as they become stable."""
        raw, t = piece.encode("utf-8", "surrogatepass"), self.transducer
        t.reset()
        for at in range(0, len(raw), self.FEED):
            t.push(raw[at : at + self.FEED])
            if at + self.FEED < len(raw):
                yield from t.stable()
        yield from t.finish()

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.stream(piece))
        if len(piece) <= 64:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pattern = regex.compile(PIECES)
        self.known = Pieces(vocabulary)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for i, part in enumerate(self.split.split(text) if self.split else [text]):
            if i % 2:
                out.append(self.v.special[part])
            else:
                out.extend(chain.from_iterable(map(self.known.__getitem__, self.pattern.findall(part))))
        return out

    def decode_stream(self, ids: Iterable[int], lot: int = 4096) -> Iterator[str]:
        """Text as it becomes certain; an unfinished character waits for its next bytes."""
        state, table, held = codecs.getincrementaldecoder("utf-8")(errors="replace"), self.v.bytes, []
        for i in ids:
            held.append(table.get(i, b""))
            if len(held) >= lot:
                yield state.decode(b"".join(held))
                held = []
        yield state.decode(b"".join(held), final=True)

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_stream(ids))


_CODECS: dict[int, Codec] = {}


def codec_of(vocabulary: Vocabulary) -> Codec:
    """One codec per worker, so that what it remembers serves its next tasks too."""
    if vocabulary.key not in _CODECS:
        _CODECS[vocabulary.key] = Codec(vocabulary)
    return _CODECS[vocabulary.key]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, ids array<int>, decoded) per row of ``docs``; with ``digest`` (id, n_tokens, ids_sha256, decoded_sha256).

    ``vocabulary`` is the content of the file; it has a fixed size and is broadcast.
    """
    from hashlib import sha256

    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))

    def make():
        codec = codec_of(shared.value)

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, first, second = [], [], []
                for text in part.column(1).to_pylist():
                    ids = codec.encode(text)
                    counts.append(len(ids))
                    if digest:
                        first.append(sha256(",".join(map(str, ids)).encode()).hexdigest())
                        state = sha256()
                        for piece in codec.decode_stream(ids):
                            state.update(piece.encode("utf-8"))
                        second.append(state.hexdigest())
                    else:
                        first.append(np.array(ids, np.int32))
                        second.append(codec.decode(ids))
                if digest:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(first), pa.array(second)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tolist() for x in first], pa.list_(pa.int32())), pa.array(second)], names=["id", "ids", "decoded"])

        return step

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "id long, ids array<int>, decoded string"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(per_batch(make), schema)

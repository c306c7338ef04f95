"""Fill-in-the-middle: each text cut at two unit boundaries into prefix, middle and suffix, then reordered.

Units are runs of white space (0x09-0x0D, 0x20) followed by a word, or a last run of
white space, matched left to right over code points. The cuts and the form come from
the sha256 of ``f"{seed}:{doc_id}"``: its first four groups of eight hex digits h1-h4.
The prefix ends after min(h1, h2) mod (n + 1) units, the middle after the max; the
form is plain for empty texts, for texts that hold a marker, and where h3 mod 100 is
``plain_percent`` or more; otherwise spm where h4 mod 100 < ``spm_percent``, else psm.

Method: the text is split into blocks of BLOCK code points. A Fenwick tree over the
blocks holds, per block, how many units end in it and how many code points it has. A
binary-lifting descent finds the block in which the k-th unit ends together with the
code points before that block; the boundary is then found within that block alone.

Defined results: a null text is empty (n = 0, plain); a null id hashes as the empty
decimal (``"42:"``); repeated rows give equal rows; an empty table gives none. Only the
id and the text are read, so other columns never clash with the output.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import per_batch

# The markers of the three parts and the seed of the cut hash.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
BLOCK = 1024

OUTPUT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Blocks:
    """A Fenwick tree over the blocks of one text: unit ends and code points per block."""

    def __init__(self, ends: np.ndarray, length: int, block: int = BLOCK):
        self.block = block
        self.ends = ends
        count = -(-length // block)
        units = np.bincount(np.flatnonzero(ends) // block, minlength=count).astype(np.int64)
        points = np.full(count, block, np.int64)
        if count:
            points[-1] = length - block * (count - 1)
        self.units, self.points = self._tree(units), self._tree(points)
        self.top = 1 << max(count.bit_length() - 1, 0) if count else 0

    @staticmethod
    def _tree(values: np.ndarray) -> np.ndarray:
        tree = np.zeros(len(values) + 1, np.int64)
        tree[1:] = values
        for i in range(1, len(tree)):
            j = i + (i & -i)
            if j < len(tree):
                tree[j] += tree[i]
        return tree

    def cut(self, k: int) -> int:
        """The code-point offset just after the k-th unit (0 before the first)."""
        if k <= 0:
            return 0
        # Binary lifting: the largest block prefix with fewer than k unit ends.
        at, seen, before, step = 0, 0, 0, self.top
        while step:
            nxt = at + step
            if nxt < len(self.units) and seen + self.units[nxt] < k:
                at, seen, before = nxt, seen + self.units[nxt], before + self.points[nxt]
            step >>= 1
        # Block ``at`` (0-based) holds the boundary; only its code points are scanned.
        local = np.flatnonzero(self.ends[before : before + self.block])
        return before + int(local[k - seen - 1]) + 1


def unit_ends(text: str) -> np.ndarray:
    """A flag per code point: whether a unit ends with it."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    after = np.append(space[1:], True)
    ends = ~space & after
    if len(space) and space[-1]:
        ends[-1] = True
    return ends


def hashes(doc_id: int | None, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def split(doc_id: int | None, text: str | None, seed: int = SEED, plain_percent: int = 50, spm_percent: int = 80) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    ends = unit_ends(text)
    n = int(ends.sum())
    h1, h2, h3, h4 = hashes(doc_id, seed)
    marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= plain_percent:
        return n, "plain", None, None, text
    blocks = Blocks(ends, len(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = blocks.cut(a), blocks.cut(b)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < spm_percent:
        return n, "spm", i, j - i, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", i, j - i, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fim(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, plain_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row of ``docs``; one map stage, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch):
            rows = [split(i, t, seed, plain_percent, spm_percent) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            names = ["n", "form", "prefix_chars", "middle_chars", "output"]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

        return step

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(per_batch(make), OUTPUT)


def restored(output: Column | str, form: Column | str) -> Column:
    """The text rebuilt from a formatted output: markers occur in it only as markers."""
    out, kind = F.col(output) if isinstance(output, str) else output, F.col(form) if isinstance(form, str) else form
    s, p, m = F.instr(out, SUFFIX), F.instr(out, PREFIX), F.instr(out, MIDDLE)
    psm = F.concat(out.substr(F.lit(4), s - 4), F.substring_index(out, MIDDLE, -1), out.substr(s + 3, m - s - 3))
    spm = F.concat(out.substr(p + 3, m - p - 3), F.substring_index(out, MIDDLE, -1), out.substr(F.lit(4), p - 4))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(out)

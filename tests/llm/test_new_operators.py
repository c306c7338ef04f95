"""Fill-in-the-middle, cross-tokenizer alignment and exact top-k search against brute force, and on odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskspark.llm import align, fim, topk

UNITS = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, row long, id string, n int, form string, output string, pairs int, mult int, qrow long"
ODD = [(None, "a b c"), (None, None), (1, None), (1, ""), (2, " \n\t "), (3, "one two"), (3, "one two"), (4, "é ü 漢字 🤯 \x00 x"), (5, "word " * 30_000), (6, "a <P> b"), (7, "A" * 100_000), (8, "  lead and trail  "), (9, "<|endoftext|> x")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "f", "o", 3, 4, 5) for i, t in rows], COLUMNS)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def fim_brute(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(st.integers(-(10**12), 10**12), st.text(alphabet=st.sampled_from(["a", "é", "漢", " ", "\n", "\t", "\r", "🤯", "<", "P", "S", "M", ">"]), max_size=3000))
def test_fim_cuts_equal_brute_force(doc_id, text):
    assert fim.split(doc_id, text) == fim_brute(doc_id, text)


def test_fim_blocks_find_every_cut():
    rng = random.Random(3)
    text = "".join(rng.choice("ab \n") for _ in range(10_000))
    ends = fim.unit_ends(text)
    blocks = fim.Blocks(ends, len(text), block=64)
    offsets = np.flatnonzero(ends) + 1
    assert [blocks.cut(k) for k in range(len(offsets) + 1)] == [0, *offsets.tolist()]


def test_fim_query_rows_round_trip_and_odd_rows(spark):
    from riskspark.llm.queries import op11_fim  # noqa: F401

    out = fim.fim(frame(spark, ODD))
    got = out.select("id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored("output", "form").alias("back")).collect()
    assert len(got) == len(ODD)
    by_row = Counter((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got)
    assert by_row == Counter((i, *fim_brute(i, t)) for i, t in ODD)
    assert all(r.back == r.output if r.form == "plain" else True for r in got)
    texts = Counter(t or "" for _, t in ODD)
    assert Counter(r.back for r in got) == texts
    assert fim.fim(frame(spark, [])).count() == 0


# --- alignment -------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=60), st.lists(st.integers(0, 500), max_size=60))
def test_gallop_ranks_equal_binary_search(keys, into):
    keys, into = np.array(sorted(keys), np.int64), np.array(sorted(set(into)), np.int64)
    assert align.gallop(keys, into).tolist() == np.searchsorted(into, keys, "left").tolist()


@pytest.fixture(scope="module")
def tokenizers_():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def a_bytes(a, i):
    letters = {c: x for c, x in __import__("riskspark.llm.bpe", fromlist=["byte_letters"]).byte_letters().items()}
    token = a.id_to_token(i)
    return token.encode() if token == "<|endoftext|>" else bytes(letters[c] for c in token)


def b_bytes(b, i):
    p = b.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()


def align_brute(a, b, texts):
    """Nested loops over all token pairs; corpus counts by a Counter."""
    per, counts = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        ta, tb = [a_bytes(a, i) for i in ids_a], [b_bytes(b, i) for i in ids_b]
        if not t or b"".join(ta) != raw or b"".join(tb) != raw:
            per.append(None)
            continue
        sa, sb, pos = [], [], 0
        for x in ta:
            sa.append((pos, pos + len(x)))
            pos += len(x)
        pos = 0
        for x in tb:
            sb.append((pos, pos + len(x)))
            pos += len(x)
        links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(sa) for j, (s2, e2) in enumerate(sb) if s < e2 and s2 < e]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, ia, ib = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while ia < len(sa) and sa[ia][1] <= c:
                ga.append(ids_a[ia])
                ia += 1
            while ib < len(sb) and sb[ib][1] <= c:
                gb.append(ids_b[ib])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        counts.update(links)
        per.append((len(ids_a), len(ids_b), len(cuts), links, sha(";".join(groups))))
    top = Counter()
    for (x, y), c in counts.items():
        top[y] = max(top[y], c)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_g, links, digest = p
            out.append((n_a, n_b, n_g, len(links), sum(counts[l] == top[l[1]] for l in links), sum(counts[l] for l in links), digest))
    return out


def test_alignment_equals_brute_force(spark, tokenizers_):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column("text").to_pylist()[:40]
    rng = random.Random(2)
    rows = [(i, t[: rng.choice([50, 400, 3000])] if t else t) for i, t in enumerate(texts)] + [(100 + i, t) for i, (_, t) in enumerate(ODD) if t is None or len(t) < 1000]
    got = align.align(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")).collect()
    want = align_brute(*tokenizers_, [t for _, t in rows])
    assert Counter((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == Counter(want)
    assert sum(w[0] > 0 for w in want) > 20


def test_alignment_odd_rows_and_empty_table(spark):
    paths = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    got = {(r.id, r.n_a > 0) for r in align.align(frame(spark, ODD), *paths).collect()}
    assert (1, False) in got and (None, True) in got and (9, True) in got
    assert align.align(frame(spark, ODD), *paths).count() == len(ODD)
    assert align.align(frame(spark, []), *paths).count() == 0


# --- top-k -----------------------------------------------------------------------------


def topk_brute(rows, k=10):
    valid = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, qv in valid:
        if qi % 100:
            continue
        clamp = lambda s: max(-(2**63), min(2**63 - 1, s))
        cands = sorted(((-clamp(sum(a * b for a, b in zip(qv, cv))), ci) for ci, cv in valid if ci != qi and len(cv) == len(qv)))[:k]
        out += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(cands)]
    return Counter(out)


def test_topk_equals_brute_force_over_many_tiles_and_levels(spark):
    rng = random.Random(7)
    rows = []
    for i in range(700):
        v = [round(rng.gauss(0, 1), 3) for _ in range(6)]
        if i % 9 == 0:
            v = [0.5] * 6  # many exact ties
        rows.append((i * 3, v))
    rows += [(None, [1.0] * 6), (1000, None), (1100, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1200, [float("nan")] * 6), (1300, [float("inf")] * 6), (1400, [1.0, 2.0]), (1500, [2.0, 1.0]), (1600, []), (1700, []), (300, [9.0] * 6), (300, [9.0] * 6), (77, [5e6] * 6), (88, [-5e6] * 6), (400, [4e6] * 6), (500, [3e4] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, row int, cs int, qrow int")
    got = topk.top_k(df, shard=37, query_block=3, fan_in=2).collect()
    assert Counter(tuple(r) for r in got) == topk_brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])


def test_topk_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_best_breaks_ties_by_id():
    scores = np.array([5, 5, 5, 5, 9, 1], np.int64)
    ids = np.array([40, 30, 20, 10, 50, 0], np.int64)
    assert ids[topk.best(scores, ids, 3)].tolist() == [50, 10, 20]

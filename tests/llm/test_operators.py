"""Each operator against brute force, and on odd rows: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import hashlib
import json
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskspark.llm import bpe, brown, chains, chat, common, jaccard, leaks, licenses, rules, suffix, toxicity
from riskspark.session import materialize

WORDS = [f"w{i}" for i in range(400)]
COLUMNS = "doc_id long, text string, row long, id string, cls int, n int, pos int, seed long, term string, key long, start int"


def text_of(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "x", 1, 2, 3, 4, "t", 5, 6) for i, t in rows], COLUMNS)


def corpus(seed: int = 5, n: int = 60) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = []
    shared = text_of(rng, 70)
    for i in range(n):
        kind = rng.random()
        if kind < 0.25 and len(rows) > 3:
            words = (rng.choice(rows[3:])[1] or "").split(" ")
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((i, " ".join(words)))
        elif kind < 0.45:
            rows.append((i, f"{text_of(rng, rng.randrange(20, 80))} {shared} {text_of(rng, rng.randrange(20, 80))}"))
        else:
            rows.append((i, text_of(rng, rng.choice([1, 3, 5, 30, 120, 300]))))
    return rows


ODD = [(None, "a b c d e f g"), (None, None), (1, None), (1, ""), (2, " \n\t "), (3, "one two"), (3, "one two"), (3, "one two"), (4, "é ü 漢字 🤯 \x00 x"), (5, "word " * 30_000), (6, "word " * 30_000), (7, "A" * 100_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 3 and 1, int(i % 4 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")


def shingle_sets(rows, size=5):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


# --- 5 ------------------------------------------------------------------------------


def components_by_force(sets):
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def check_jaccard(spark, rows):
    got = {r["id"]: r for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    sets = shingle_sets(rows)
    groups = components_by_force(sets)
    for i, (doc, _) in enumerate(rows):
        assert got[doc]["n_shingles"] == len(sets[i])
        assert got[doc]["component_id"] == min(rows[j][0] for j in range(len(rows)) if groups[j] == groups[i])


def test_jaccard_join_by_force(spark):
    check_jaccard(spark, corpus())


def test_jaccard_join_of_a_large_near_group(spark):
    rng = random.Random(2)
    base = text_of(rng, 60).split(" ")
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(60)] = rng.choice(WORDS)
        rows.append((i, " ".join(words)))
    check_jaccard(spark, rows)


def test_jaccard_join_on_odd_rows(odd, none):
    got = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(odd).collect()), key=str)
    assert len(got) == len(ODD)
    assert (3, 1, 3) in got and (6, 1, 5) in got and (2, 0, 2) in got and (None, 0, None) in got and (1, 0, 1) in got
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in links)}


# --- 10 -----------------------------------------------------------------------------


def suffix_by_force(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(t, mask, strict=True) if not m)
        out.append((len(t), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [suffix.CHUNK, 3])
def test_suffix_dedup_by_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    rows = [(i, t) for i, t in corpus(9)] + [(100, "ab" * 700), (101, "x" + "ab" * 400), (102, "z" * 399), (103, "z" * 399)]
    got = {r["id"]: tuple(r)[1:] for r in suffix.digests(frame(spark, rows)).collect()}
    want = suffix_by_force([(t or "").encode() for _, t in rows], 400)
    assert [got[i] for i, _ in rows] == want


def test_suffix_dedup_on_odd_rows(odd, none):
    got = suffix.digests(odd).collect()
    want = suffix_by_force([(t or "").encode() for _, t in ODD[:9]], 400)
    assert len(got) == len(ODD) and suffix.digests(none).count() == 0
    assert {r["n_removed"] for r in got if r["id"] in (5, 6)} == {150_000} and {r["n_removed"] for r in got if r["id"] == 7} == {100_000}
    assert Counter(tuple(r)[1:] for r in got if r["id"] not in (5, 6, 7)) == Counter(want)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=120) | st.text("ab", max_size=120).map(str.encode))
def test_suffix_array_and_prefixes(raw):
    order = suffix.suffix_array(raw, 1000).tolist()
    assert order == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix.common_prefixes(raw, suffix.suffix_array(raw, 1000), 16).tolist() if raw else []
    for k, (a, b) in enumerate(zip(order, order[1:], strict=False)):
        n = 0
        while n < min(16, len(raw) - max(a, b)) and raw[a + n] == raw[b + n]:
            n += 1
        assert shared[k + 1] == n


# --- 3 ------------------------------------------------------------------------------


def chain_by_force(matches):
    matches = sorted(set(matches))
    best = {}
    for x, y in matches:
        before = [best[m] - chains.GAP_COST * (x - m[0] + y - m[1]) for m in best if m[0] < x and m[1] < y]
        best[(x, y)] = chains.KMER + max([0.0, *before])
    return max(best.values())


def chain_score(path):
    return chains.KMER * len(path) - chains.GAP_COST * sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(path, path[1:], strict=False))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25))
def test_chain_is_the_best(matches):
    assert math.isclose(max(map(chain_score, chains.chain(matches, least=1))), chain_by_force(matches))


def planted(spark):
    rng = random.Random(11)
    passage = text_of(rng, 80).split(" ")
    changed = list(passage)
    for i in (17, 40, 61):
        changed[i] = "other"
    rows = [(i, text_of(rng, 200)) for i in range(30)]
    rows[4] = (4, " ".join([text_of(rng, 50), *passage, text_of(rng, 50)]))
    rows[9] = (9, " ".join([text_of(rng, 90), *changed, text_of(rng, 20)]))
    rows[20] = (20, " ".join([*passage, text_of(rng, 33)]))
    rows[25] = (25, " ".join([text_of(rng, 30), *passage[:40], text_of(rng, 33)]))
    return rows


def test_passages_are_found_and_cut(spark):
    rows = planted(spark)
    passages = chains.repeated_passages(frame(spark, rows)).collect()
    assert {(r["id"], r["source_id"]) for r in passages} == {(9, 4), (20, 4), (20, 9)}
    found = {r["id"]: r for r in passages if r["source_id"] == 4}
    assert (found[9]["source_id"], found[9]["start"], found[9]["end"], found[9]["matched"]) == (4, 90, 170, 77)
    assert (found[20]["start"], found[20]["end"], found[20]["source_start"]) == (0, 80, 50)
    kept = {r["doc_id"]: r for r in chains.without_repeats(frame(spark, rows), length_col="n").collect()}
    assert kept[4]["text"] == rows[4][1] and kept[25]["text"] == rows[25][1]
    assert kept[20]["text"].split() == rows[20][1].split()[80:] and kept[20]["n"] == len(kept[20]["text"])
    assert kept[9]["text"].split() == rows[9][1].split()[:90] + rows[9][1].split()[170:]


@pytest.mark.parametrize("every", [5, 6, 7, 10, 20])
def test_passages_with_a_change_in_every_few_words_are_found(spark, every):
    rng = random.Random(every)
    rows = []
    for i in range(20):
        passage = text_of(rng, 60).split(" ")
        changed = [f"new{i}x{k}" if k % every == every - 1 else w for k, w in enumerate(passage)]
        rows += [(2 * i, " ".join([text_of(rng, 30), *passage, text_of(rng, 30)])), (2 * i + 1, " ".join([text_of(rng, 25), *changed, text_of(rng, 25)]))]
    found = {(r["id"], r["source_id"]) for r in chains.repeated_passages(frame(spark, rows)).collect()}
    assert {(2 * i + 1, 2 * i) for i in range(20)} <= found


@pytest.mark.parametrize("n", [3, 40])
def test_passages_of_frequent_lines_are_found(spark, n):
    rng = random.Random(n)
    a, b, c = (text_of(rng, 20) for _ in range(3))
    # Earlier documents hold two of the three lines, which is too short for a passage.
    rows = [(i, " ".join([text_of(rng, 40), *((a, b) if i % 2 else (b, c)), text_of(rng, 40)])) for i in range(2 * n)]
    rows += [(i, " ".join([text_of(rng, 30), a, b, c, text_of(rng, 30)])) for i in range(2 * n, 3 * n)]
    whole = {r["id"] for r in chains.repeated_passages(frame(spark, rows)).collect() if r["start"] <= 30 and r["end"] >= 90}
    assert whole == set(range(2 * n + 1, 3 * n))


def test_fuzzy_passages_of_frequent_phrases_meet_every_holder(spark):
    """All equal 4-mers of the passage have more than 16 occurrences, and its first holder is not among the first two of any."""
    rng = random.Random(3)
    phrases = [[f"p{i}x{k}" for k in range(5)] for i in range(10)]

    def spaced(chosen, tag):
        return [w for i, phrase in enumerate(chosen) for w in (*phrase, f"{tag}y{i}")]

    rows = [(20 * i + k, " ".join([text_of(rng, 10), *spaced(phrases[i : i + 4], f"d{i}x{k}"), text_of(rng, 10)])) for i in range(7) for k in range(20)]
    rows += [(900 + k, " ".join([text_of(rng, 10), *spaced(phrases, f"f{k}"), text_of(rng, 10)])) for k in range(3)]
    found = {(r["id"], r["source_id"]): r for r in chains.repeated_passages(frame(spark, rows)).collect()}
    assert set(found) == {(901, 900), (902, 900), (902, 901)}
    assert all((r["start"], r["end"], r["source_start"], r["matched"]) == (10, 69, 10, 50) for r in found.values())


def test_tiles_and_their_parts_find_the_same(spark, monkeypatch):
    rng = random.Random(8)
    line = text_of(rng, 45)
    rows = []
    for i in range(40):
        tail = text_of(rng, 12).split(" ")
        rows += [(2 * i, " ".join([text_of(rng, 15), line, *tail])), (2 * i + 1, " ".join([line, f"new{i}", *tail[1:], text_of(rng, 9)]))]
    names = chains.NAMES[2:]
    whole = {(r["id"], r["source_id"], *[r[c] for c in names]) for r in chains.repeated_passages(frame(spark, rows)).collect()}
    monkeypatch.setattr(chains, "TILE_WORDS", 1500)
    assert whole == {(r["id"], r["source_id"], *[r[c] for c in names]) for r in chains.repeated_passages(frame(spark, rows)).collect()}
    assert {(2 * i + 1, 2 * i) for i in range(40)} <= {r[:2] for r in whole}
    texts = [np.array([zlib.crc32(w.encode()) >> 1 for w in t.split(" ")], np.int32) for _, t in rows]
    sides = [chains.Side(np.arange(80), np.zeros(80, np.int32), texts, pad) for pad in (0, 1)]
    at_once = sorted(chains.compared(*sides, True, 50, 80))
    monkeypatch.setattr(chains, "TILE_RUNS", 300)
    assert at_once and sorted(chains.compared(*sides, True, 50, 80)) == at_once
    halves = [chains.Side(np.arange(80)[s], np.zeros(40, np.int32), texts[s], pad) for pad, s in enumerate((slice(0, 80, 2), slice(1, 80, 2)))]
    apart = sorted(chains.compared(*halves, False, 50, 80))
    assert apart == [p for p in at_once if (p[0] + p[1]) % 2]


def test_shared_seeds_are_packed_and_complete(spark, monkeypatch):
    """Seeds travel once, packed; a bucket does not grow with a seed that one text, or every text, holds very often."""
    rng = random.Random(2)
    line = text_of(rng, 8)
    texts = [" ".join([text_of(rng, 30), line, text_of(rng, 20)]) for _ in range(60)] + ["again " * 300, "again " * 40, "alone " * 300, None, "", "a b c", text_of(rng, 9)]
    texts += [texts[0], texts[-1]]
    held: dict[tuple[str, ...], list[tuple[int, int]]] = {}
    for i, text in enumerate(texts):
        words = (text or "").split()
        for pos in range(len(words) - 3):
            held.setdefault(tuple(words[pos : pos + 4]), []).append((i, pos))
    wanted = Counter((i, pos, len(places) <= chains.FEW) for places in held.values() if len({i for i, _ in places}) > 1 for i, pos in places)
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").coalesce(1)
    monkeypatch.setattr(chains, "CHUNK_WORDS", 200)
    monkeypatch.setattr(chains, "BUCKET_BYTES", 4000)
    shared = materialize(chains.shared_seeds(rows), "shared")
    assert Counter(tuple(r) for r in chains.occurrences(shared).collect()) == wanted
    packs = chains.packed(rows, 4).collect()
    assert sum(len(p["places"]) // 4 for p in packs if p["kind"] != chains.OFTEN) == sum(map(len, held.values()))
    # Six bytes of a hash, and places of rows that take no room where they are equal.
    assert all(len(p["seeds"]) == 6 * len(p["places"]) // 4 for p in packs if p["kind"] != chains.LOOSE)


def test_texts_of_many_copies_meet_their_first(spark):
    rng = random.Random(4)
    text, other = text_of(rng, 70), text_of(rng, 70)
    rows = [(i, text) for i in range(18)] + [(30, " ".join([text_of(rng, 20), text])), (31, other), (32, other)] + [(40 + i, text_of(rng, 20)) for i in range(3)] * 9
    found = [(r["id"], r["source_id"], r["start"], r["end"], r["matched"]) for r in chains.repeated_passages(frame(spark, rows[:21])).collect()]
    assert sorted(found) == [*[(i, 0, 0, 70, 70) for i in range(1, 18)], (30, 0, 20, 90, 70), (32, 31, 0, 70, 70)]
    assert chains.repeated_passages(frame(spark, rows)).where("id >= 40").count() == 0


def test_steps_over_edits_by_force():
    import numpy as np

    rng = np.random.default_rng(2)
    met = 0
    for _ in range(3000):
        a, b = (rng.integers(0, 3, rng.integers(0, 15)) for _ in range(2))
        held = [(dx, dy) for dx in range(9) for dy in range(9) if dx or dy if len(a[dx : dx + 3]) == 3 == len(b[dy : dy + 3]) and (a[dx : dx + 3] == b[dy : dy + 3]).all()]
        wanted = min(held, key=lambda s: (max(s), abs(s[0] - s[1]), sum(s), s[0]), default=None)
        assert chains.step_over(a[:11], b[:11]) == wanted
        same = next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
        assert chains.equal_words(a, b) == same
        met += wanted is not None
    assert 500 < met < 3000
    x, y = np.arange(5_000), np.arange(5_000)
    y[4_321] = -1
    assert (chains.equal_words(x, y), chains.equal_words(x, x), chains.equal_words(x, x[:100])) == (4_321, 5_000, 100)


def test_tiles_meet_all_texts_however_they_are_cut(spark, monkeypatch):
    """Groups are compared where they lie: the same passages for any size of groups and broadcasts, and when matches overflow."""
    rng = random.Random(12)
    phrase = text_of(rng, 70)
    rows = [(i, " ".join([text_of(rng, rng.randrange(5, 40)), phrase, text_of(rng, 10)])) for i in range(24)]

    def found():
        return sorted((r["id"], r["source_id"], r["start"], r["end"], r["matched"]) for r in chains.repeated_passages(frame(spark, rows)).collect())

    whole = found()
    assert {(a, b) for a, b, *_ in whole} == {(a, b) for a in range(24) for b in range(a)}
    for words, at_once, matches in ((400, 2, 1 << 22), (700, 9, 40), (1 << 20, 1, 20)):
        monkeypatch.setattr(chains, "TILE_WORDS", words)
        monkeypatch.setattr(chains, "TILES_AT_ONCE", at_once)
        monkeypatch.setattr(chains, "TILE_RUNS", matches)
        assert found() == whole


def test_long_periodic_texts_are_aligned_run_by_run(monkeypatch):
    import time

    import numpy as np

    def pair(a, b):
        sides = [chains.Side(np.array([1, 2]), np.array([0, 0]), [a, b], pad) for pad in (0, 1)]
        return list(chains.compared(*sides, True, 50, 80))

    same = np.full(8_000, 7, np.int64)
    begun = time.monotonic()
    found = pair(same, same)
    assert time.monotonic() - begun < 30  # eight million matches, chained one by one, took minutes
    shifts = {(2, 1, max(0, d), 8_000 + min(0, d), max(0, -d), 8_000 - max(0, d), 8_000 - abs(d)) for d in range(-7_950, 7_951)}
    assert set(found) == shifts and len(found) == len(shifts)
    # A change of a word: the alignment goes on beyond it and no run within it is aligned again.
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 30, 400)
    b = a.copy()
    b[[100, 250]] += 1
    monkeypatch.setattr(chains, "PAIR_MATCHES", 0)
    assert pair(a, b) == [(2, 1, 0, 400, 0, 400, 398)]


def test_passages_on_odd_rows(odd, none):
    chains.repeated_passages(odd).collect()
    assert chains.without_repeats(odd).count() == len(ODD)
    assert chains.repeated_passages(none).count() == 0 and chains.without_repeats(none).count() == 0


def test_rarity_holds_few_texts_at_once():
    """One Arrow batch may hold ten thousand texts; their shingles are not held together."""
    rng = random.Random(6)
    texts = [None, "", *[text_of(rng, 300).encode() for _ in range(2500)]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    wanted = Counter(int(s) for raw in texts for s in jaccard.slots(jaccard.shingle_set(raw, common.WordHashes(), 5)))
    tracemalloc.start()
    batches = list(jaccard.counted([batch], 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = [out.to_pydict() for out in batches]
    assert {s: n for out in found for s, n in zip(out["slot"], out["n"], strict=True)} == wanted
    assert peak < 12 << 20


# --- 2 ------------------------------------------------------------------------------


def leaks_by_force(rows, items):
    out = {}
    for doc, t in rows:
        w = (t or "").split()
        for item, it in items:
            iw = (it or "").split()
            if not iw or not w:
                continue
            for i in range(max(1, len(w) - len(iw) + 1)):
                a, b = (Counter(tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))) for x in (w[i : i + len(iw)], iw))
                s = sum((a & b).values()) / sum((a | b).values())
                if s >= 0.8:
                    out[doc, item] = max(s, out.get((doc, item), 0))
    return out


def test_leaks_by_force(spark):
    rng = random.Random(4)
    items = [(i, text_of(rng, rng.choice([3, 8, 14, 30, 55]))) for i in range(20)] + [(30, None), (31, "")]
    rows = [(i, text_of(rng, 80)) for i in range(60)]
    for i in range(0, 40, 2):
        words = items[i // 2][1].split()
        if len(words) >= 30 and i % 4 == 0:
            words[rng.randrange(len(words))] = "zz"
        rows[i] = (i, " ".join([text_of(rng, 20), *words, text_of(rng, 20)]))
    rows.append((90, items[3][1]))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["id"], r["item_id"]): r["similarity"] for r in leaks.leaks(frame(spark, rows), table).collect()}
    want = leaks_by_force(rows, items)
    assert want and got == pytest.approx(want)
    kept = leaks.clean(frame(spark, rows), table)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {d for d, _ in want}


def test_leaks_in_blocks_and_on_odd_rows(spark, odd, none, monkeypatch):
    items = spark.createDataFrame([(1, "one two"), (2, "a b c d e f g"), (None, "q r s"), (3, None)], "item_id long, text string")
    whole = sorted(tuple(r) for r in leaks.leaks(odd, items).select("item_id", "similarity").collect())
    assert whole == [(1, 1.0)] * 3 + [(2, 1.0)]
    monkeypatch.setattr(leaks, "BLOCK_BYTES", 5)
    assert sorted(tuple(r) for r in leaks.leaks(odd, items).select("item_id", "similarity").collect()) == whole
    assert leaks.leaks(none, items).count() == 0 and leaks.leaks(odd, items.limit(0)).count() == 0 and leaks.clean(odd, items.limit(0)).count() == len(ODD)


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(40)]
    index = leaks.MultiIndex(prints)
    for _ in range(200):
        p, flips = rng.randrange(40), rng.sample(range(64), rng.randrange(0, leaks.RADIUS + 1))
        query = prints[p]
        for f in flips:
            query ^= 1 << f
        import numpy as np

        want = {i for i, x in enumerate(prints) if (x ^ query).bit_count() <= leaks.RADIUS}
        assert {i for _, i in index.query(np.array([query], np.uint64))} == want and p in want


# --- 1 ------------------------------------------------------------------------------


def test_license_scan(spark, odd, none):
    rng = random.Random(3)
    mit = licenses.TEMPLATES["MIT"][1]
    rows = [
        (1, f"{text_of(rng, 40)}\nReleased under the MIT License.\n{text_of(rng, 40)}"),
        (2, mit.upper().replace(",", " ;")),
        (3, text_of(rng, 300)),
        (4, "This work is licensed under the GNU General Public License, version 2.\n" + text_of(rng, 9)),
        (5, f"{text_of(rng, 10)} {mit.replace('merge', 'combine')} {text_of(rng, 10)} Licensed under CC BY-NC 4.0."),
    ]
    got = sorted((r["id"], r["license"], r["dice"] == 1) for r in licenses.scan(frame(spark, rows)).collect())
    assert got == [(1, "MIT", True), (2, "MIT", True), (4, "GPL-2.0", True), (5, "CC-BY-NC-4.0", True), (5, "MIT", False)]
    assert licenses.scan(odd).count() == 0 and licenses.scan(none).count() == 0


@pytest.mark.parametrize("name,text", [(n, t) for n, ts in sorted(licenses.TEMPLATES.items()) for t in ts])
def test_each_template_is_its_own_license(name, text):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    raw = text.encode()
    assert scanner.scan(b"some words before " + raw + b" and behind") == [(name, 1.0, 3, 3 + len(licenses.normalised(raw)))]


def test_license_with_edits_in_its_last_clause():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    text = licenses.TEMPLATES["BSD-3-Clause"][1].replace("the copyright holder nor", "Example Inc nor")
    assert [m[0] for m in scanner.scan(text.encode())] == ["BSD-3-Clause"]
    assert [m[0] for m in scanner.scan(f"{text} {licenses.BSD_TERMS} {text}".encode())] == ["BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause"]


def test_license_scan_by_force():
    rng = random.Random(6)
    scanner = licenses.Scanner({"A": ["a b c d e f g h"]}, 0.8)
    template = Counter(zip("abcdefg", "bcdefgh", strict=True))
    for _ in range(300):
        words = [rng.choice("abcdefgh") if rng.random() < 0.4 else "abcdefgh"[i % 8] for i in range(rng.randrange(1, 16))]
        best = 0.0
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                bag = Counter(zip(words[i:j], words[i + 1 : j + 1], strict=True))
                best = max(best, 2 * sum((bag & template).values()) / (sum(bag.values()) + 7))
        got = scanner.scan(" ".join(words).encode())
        assert (max(m[1] for m in got) if got else 0) == pytest.approx(best if best >= 0.8 else 0)


# --- 4 ------------------------------------------------------------------------------


def rule_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_rule_features_by_force(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(["a", "b", "cc", " ", " ", "\n", "\t", "#", "é", "🤯", "<|"]) for _ in range(rng.randrange(0, 120)))) for i in range(200)]
    got = {r["id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rules.features(frame(spark, rows)).collect()}
    assert got == {i: rule_counts(t) for i, t in rows}


def test_rules_are_learned_and_applied(spark):
    rng = random.Random(1)
    good = [(i, text_of(rng, 90)) for i in range(150)]
    bad = [(i, " ".join(w + "###" for w in text_of(rng, 90).split())) for i in range(150, 300)]
    docs = frame(spark, good + bad)
    marks = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 300, 2)], "doc_id long, quality int")
    measured = rules.features(docs)
    learned = rules.learn(measured, marks)
    assert 1 <= len(learned) <= 2 and "symbols" in {c.feature for c in learned[0]} | {"symbols"}
    kept = {r["id"] for r in rules.judge(docs, marks).where("kept").collect()}
    assert kept == {i for i, t in good if 100 * rule_counts(t)[4] <= 50 * 90}


def test_rules_on_odd_rows(odd, none, labels):
    got = rules.judge(odd, labels).collect()
    assert len(got) == len(ODD) and all(r["kept"] is False or r["kept"] is True for r in got)
    assert all(not r["kept"] for r in got if r["n_words"] < 50)
    assert rules.judge(none, labels).count() == 0
    assert rules.judge(odd, labels.limit(0)).where("kept").count() == 0


def test_rules_need_no_python(odd, labels):
    plan = rules.judge(odd, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 6 ------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, old = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (c != d)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcde", max_size=12))
def test_automaton_by_force(word):
    terms = {"abcde": False, "bcdea": True, "abcdeabcd": False, "ab": False, "edcba": True}
    options = []
    for term, stem in terms.items():
        costs = [distance(word[:n], term) for n in range(1, len(word) + 1)] if stem else [distance(word, term)] if word else []
        options += [(c, term) for c in costs if c <= toxicity.edits_of(term)]
    got = toxicity.Automaton(terms).match(word)
    assert got == ((min(options)[1], min(options)[0]) if options else None)


def test_toxicity_learns_terms_and_spellings(spark):
    rng = random.Random(2)
    slurs = ["grubbel", "nastoid", "flurmox"]
    rows, marks = [], []
    for i in range(400):
        words = text_of(rng, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                slur = rng.choice(slurs)
                words[rng.randrange(40)] = slur
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    rows += [(1000, "this is grubel and nastoyd"), (1001, "nothing to see here"), (1002, None), (1003, "")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r["id"]: r for r in toxicity.toxicity(frame(spark, rows), labels).collect()}
    assert all(out[i]["predicted"] == int(i % 4 == 0) for i in range(400) if out[i]["held_out"])
    assert out[0]["held_out"] == (zlib.crc32(b"0") % 5 == 0)
    assert out[1000]["score"] > out[1001]["score"] == out[1002]["score"] == out[1003]["score"]


def test_quoted_hits_are_told_apart():
    finder = toxicity.Finder({"grubbel": False})
    assert [h[3] for h in finder.hits('he said you grubbel')] == [True]
    assert [h[3] for h in finder.hits('they call "grubbel" a word')] == [True]
    assert [h[3] for h in finder.hits('you are a grubbel')] == [False]


def test_toxicity_on_odd_rows(odd, none, labels):
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == len(ODD)


# --- 7 ------------------------------------------------------------------------------


def test_scores_by_force(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 150)
    monkeypatch.setattr(brown, "CLUSTERED", 60)
    rng = random.Random(3)
    rows = [(i, t) for i, t in corpus(13)] + [(200, None), (201, ""), (202, text_of(rng, 50) + " unseen")]
    got = {r["id"]: r for r in brown.score_documents(frame(spark, rows)).collect()}
    lists = {i: (t or "").lower().encode().split() + [b" "] for i, t in rows}
    counts = Counter(w for i, ws in lists.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in lists.items():
        r = got[i]
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame([("a b a c",), ("b a b d e f",), (None,), ("a b c 12 x!",)], "text string")
    model, words = brown.train(rows, classes=3, clustered=4)
    known = [w.encode() for w in "a b c d e f 12 x!".split()] + [brown.END]
    unseen = [b"zz", b"zzzzzz", b"zz!"]
    candidates = known + unseen
    table = spark.createDataFrame([(i, i, "a " + w.decode().strip()) for i, w in enumerate(candidates)], "row long, id long, text string")
    scored = {r["row"]: r for r in brown.scores(table, model, words).collect()}
    assert len(scored) == len(candidates) and all(math.isfinite(r["score"]) for r in scored.values())
    assert (10**model.transitions).sum(axis=1) == pytest.approx([1] * model.n_classes)


def test_exchange_finds_classes_that_alternate():
    import numpy as np

    counts = np.zeros((6, 6))
    for a in (0, 2, 4):
        for b in (1, 3, 5):
            counts[a, b] = counts[b, a] = 10
    cls = brown.exchange(counts, 2)
    assert len({cls[0], cls[2], cls[4]}) == 1 and len({cls[1], cls[3], cls[5]}) == 1 and cls[0] != cls[1]


def test_gains_are_differences_of_the_likelihood():
    import numpy as np

    rng = np.random.default_rng(5)
    counts = rng.integers(0, 4, (9, 9)) * (rng.random((9, 9)) < 0.6)
    cls = np.array([0, 1, 2, 0, 1, 2, 0, 3, -1])  # the last word has no class yet

    def likelihood(of):
        member = np.zeros((9, 4))
        member[np.flatnonzero(of >= 0), of[of >= 0]] = 1
        pair = member.T @ counts @ member
        return brown.xlogx(pair).sum() - brown.xlogx(pair.sum(axis=0)).sum() - brown.xlogx(pair.sum(axis=1)).sum()

    member = np.zeros((9, 4))
    member[np.arange(8), cls[:8]] = 1
    words = np.array([0, 1, 4, 7, 8])
    bare = counts - np.diag(np.diag(counts))
    found = brown.gains(member.T @ counts @ member, (bare @ member)[words], (bare.T @ member)[words], np.diag(counts)[words].astype(float), cls[words])
    for w, row in zip(words, found, strict=True):
        wanted = [likelihood(np.where(np.arange(9) == w, b, cls)) for b in range(4)]
        assert row - row[0] == pytest.approx(np.array(wanted) - wanted[0])


def test_words_outside_the_clustered_are_placed_by_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(brown, "CHUNK_BYTES", 600)
    monkeypatch.setattr(brown, "BUCKET_TOKENS", 200)
    rng = random.Random(8)
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(2, 7)):
            words += [rng.choice(["la", "lo", "li"]), rng.choice(["ta", "to", "ti"])]
        texts.append(" ".join(words))
    # Words of one shape; which slot they stand in tells their class. The last two stand beside each other only.
    texts += [f"la {w} li" for w in ("fex", "fix", "fox") for _ in range(3)] + [f"ta {w} to" for w in ("gex", "gix", "gox") for _ in range(3)] + ["fex hex", "gex hix"]
    model, words = brown.train(spark.createDataFrame([(t,) for t in texts], "text string"), classes=2, clustered=7)
    cls = {r["word"]: r["cls"] for r in words.collect()}
    of = lambda w: cls[int(common.signed(common.hash_words([w.encode()], common.WordHashes()))[0])]
    assert {of(w) for w in ("la", "lo", "li", "gex", "gix", "gox", "hex")} == {of("la")}
    assert {of(w) for w in ("ta", "to", "ti", "fex", "fix", "fox", "hix")} == {of("ta")}
    assert of("la") != of("ta") and cls[brown.END_HASH] == 2 == model.n_classes - 1
    # The score, by hand.
    counts = Counter(w for t in texts for w in t.split())
    place = lambda w: of(w) if counts[w] else int(model.unknown[brown.shape(w.encode())])
    tokens, held, moves = Counter(), Counter(), Counter()
    for w, n in counts.items():
        tokens[of(w)] += n
        held[of(w)] += 1
    for t in texts:
        listed = [2, *[of(w) for w in t.split()], 2]
        moves.update(zip(listed, listed[1:]))
    asked = ["la fex lo", "gox ta unseen", "", "hix hex !?"]
    table = spark.createDataFrame([(i, i, t) for i, t in enumerate(asked)], "row long, id long, text string")
    got = {r["row"]: r["score"] for r in brown.scores(table, model, words).collect()}
    for i, t in enumerate(asked):
        listed = [2, *[place(w) for w in t.split()], 2]
        want = sum(math.log10((moves[a, b] + 0.1) / (sum(moves[a, c] for c in range(3)) + 0.3)) for a, b in zip(listed, listed[1:]))
        want += sum(math.log10((counts[w] + 0.1) / (tokens[place(w)] + 0.1 * (held[place(w)] + 1))) for w in t.split())
        assert got[i] == pytest.approx(want)


def test_scores_on_odd_rows(odd, none):
    got = brown.score_documents(odd).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r["score"]) for r in got)
    assert brown.score_documents(none).count() == 0


# --- 8 ------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("<|\\im_startend>\nl a", max_size=12), st.text("<|\\im_startend>\n x", max_size=20)), max_size=4))
def test_chat_is_read_back(turns):
    text, spans = chat.render(chat.CHAT, [{"role": r, "text": t} for r, t in turns])
    assert list(chat.Reader().feed(text)) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def test_templates_fold_and_are_closed():
    tree = chat.fold(chat.parse("{% if 1 == 1 %}a{{ 'b' + 'c' | upper }}{% else %}{{ x }}{% endif %}d"))
    assert tree == ("seq", ("text", "aBCd"))
    out, _ = chat.render("{% set s = 'x' %}{% for m in messages %}{% if loop.first and not m.skip %}{{ s }}{% elif m.text == 'q' %}?{% endif %}{{ loop.index }}{% endfor %}", [{"text": "p"}, {"text": "q"}])
    assert out == "x1?2"
    for bad in ("{{ a.__class__ }}{{ f() }}", "{% for x %}{% endfor %}", "{% if a %}", "{{ 'a' | nothing }}", "{% import os %}", "{{ a[0] }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    with pytest.raises(chat.TemplateError):
        chat.render("{{ messages.__class__ }}", [])


def test_chat_on_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (1, None, "assistant", None), (1, 2, None, "x"), (1, 2, None, "x"), (2, 1, "assistant", "é<|🤯" * 5000)]
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, spans int, formatted string")
    got = {r["conv_id"]: r for r in chat.digests(table).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 0 and got[2]["loss_chars"] == 20_000
    assert got[2]["loss_sha256"] == hashlib.sha256(("é<|🤯" * 5000).encode()).hexdigest()
    assert got[1]["turns_sha256"] == hashlib.sha256(b"assistant\n\n\nx\n\nx\n").hexdigest()
    whole = {r["conv_id"]: r for r in chat.formatted(table).collect()}
    assert {c: len(r["formatted"]) for c, r in whole.items()} == {c: r["formatted_chars"] for c, r in got.items()}
    assert chat.digests(table.limit(0)).count() == 0


# --- 9 ------------------------------------------------------------------------------

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def content():
    with open(FILE, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def vocabulary(content):
    return bpe.Vocabulary(content)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text("ab \n'ts<|endoftext|>0é", max_size=80))
def test_codec_equals_the_library(vocabulary, text):
    codec, library = bpe.codec_of(vocabulary), Tokenizer.from_file(FILE)
    ids = codec.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["a", "ab", "abehnrt", "the", "=-"])
def test_transducer_emits_the_same_in_bounded_memory(vocabulary, letters):
    rng = random.Random(letters)
    piece = "".join(rng.choice(letters) for _ in range(6000))
    t, out, held = bpe.Transducer(vocabulary), [], 0
    for at in range(0, len(piece), 16):
        t.push(piece[at : at + 16].encode())
        out += t.stable()
        held = max(held, len(t.buffer))
    out += t.finish()
    whole = bpe.Transducer(vocabulary)
    whole.push(piece.encode())
    assert out == whole.finish() and held <= 2 * vocabulary.lookahead
    assert b"".join(vocabulary.bytes[i] for i in out).decode() == piece


def test_decoder_replaces_broken_bytes(vocabulary):
    codec = bpe.codec_of(vocabulary)
    broken = [vocabulary.ids[b"\xe6"], vocabulary.ids[b"\xbc"], vocabulary.ids[b"a"], vocabulary.ids[b"\xff"]]
    assert codec.decode(broken) == bytes([0xE6, 0xBC, 0x61, 0xFF]).decode("utf-8", "replace")


def test_bpe_on_odd_rows(spark, odd, none, content):
    library = Tokenizer.from_file(FILE)
    got = bpe.encode(odd, content).collect()
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in ODD)
    assert Counter((r["id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
    assert bpe.encode(none, content, digest=True).count() == 0
    digests = {r["ids_sha256"] for r in bpe.encode(odd, content, digest=True).collect()}
    assert digests == {hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for _, i, _ in want}


def test_vocabulary_file_has_the_expected_form(content):
    assert json.loads(content)["model"]["type"] == "BPE"

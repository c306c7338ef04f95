"""Toxicity: Levenshtein automata intersected with a lexicon trie, weighed by context.

Learning, from labelled rows only:

1. Lexicon: over at most ``sample`` labelled rows (expected; a hash of the id decides), the
   documents that hold a word or a beginning of a word are counted per label. Terms are
   those held almost only by toxic documents; of the beginnings of one term the longest
   that keeps its documents is taken. A term with several endings is a stem.
2. Weights: a logistic model on counts of hits by kind, fitted to the grouped counts.

Scoring, over whole texts: every word runs through one automaton, the product of the
trie of all terms and the Levenshtein automata of up to ``edits`` edits, made
deterministic as words ask for it. A hit is a term met within its edits; a stem is met
by the beginning of a word. Hits that stand in quotation marks or after a word that reports
speech within a few words are counted apart, so learning decides how much they tell.

Null and empty texts have no hits and get the base rate. Without labels of both kinds
nothing is learned: no terms, and the score is the smoothed base rate.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import among, per_batch

SAMPLE = 20_000
STRIP = ".,;:!?\"'`()[]{}<>|*#$%&_-~/\\“”„«»‘’¿¡…"
QUOTES = "\"“”„«»"
# Words that report what somebody else said.
REPORTS = frozenset("said says wrote writes quote quoted quotes called reads sagte schrieb zitat dijo escribió cita dit écrit citation".split())
NEAR = 4
MOST = 3
FEATURES = ("word", "stem", "fuzzy_word", "fuzzy_stem", "quoted")
STATES = 200_000
CANDIDATES = 5000
IMPURE = 0.05
CHANCE = 1e-8  # a term that is no sign of toxicity reaches the least number of documents at most this likely


def core(word: str) -> str:
    return word.strip(STRIP).lower()


@dataclass
class Automaton:
    """The product of a lexicon trie and Levenshtein automata, as a lazily built deterministic automaton.

    A state is the set of (trie node, edits so far) that the characters read can
    have reached, with fewer edits preferred; missing characters of the word are
    closed over at once.
    """

    terms: dict[str, bool]  # term -> whether it is a stem
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, str] = field(default_factory=dict)
    limit: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        deepest: dict[int, int] = {0: 0}
        for term in sorted(self.terms):
            at, path = 0, [0]
            for c in term:
                if c not in self.children[at]:
                    self.children.append({})
                    self.children[at][c] = len(self.children) - 1
                at = self.children[at][c]
                path.append(at)
            self.ends[at] = term
            for node in path:
                deepest[node] = max(deepest.get(node, 0), edits_of(term))
        self.limit = [deepest[i] for i in range(len(self.children))]
        self.reset()

    def reset(self) -> None:
        first = self.close({0: 0})
        self.states: list[tuple[tuple[int, int], ...]] = [first]
        self.numbers = {first: 0}
        self.moves: list[dict[str, int]] = [{}]
        self.found = [self.outcome(first)]

    def close(self, reached: dict[int, int]) -> tuple[tuple[int, int], ...]:
        """With the term's characters that the word may have left out."""
        todo = list(reached.items())
        while todo:
            node, cost = todo.pop()
            for child in self.children[node].values():
                if cost < self.limit[child] and reached.get(child, 99) > cost + 1:
                    reached[child] = cost + 1
                    todo.append((child, cost + 1))
        return tuple(sorted(reached.items()))

    def outcome(self, state: tuple[tuple[int, int], ...]) -> tuple[tuple[str, int], ...]:
        """Terms complete in a state, with their edits."""
        return tuple((self.ends[n], cost) for n, cost in state if n in self.ends and cost <= edits_of(self.ends[n]))

    def move(self, number: int, c: str) -> int:
        """The state after one more character; -1 if no term can be met any more."""
        reached: dict[int, int] = {}
        for node, cost in self.states[number]:
            exact = self.children[node].get(c)
            if exact is not None:
                reached[exact] = min(cost, reached.get(exact, 99))
            if cost < self.limit[node]:  # a character too many
                reached[node] = min(cost + 1, reached.get(node, 99))
            for child in self.children[node].values():  # another character
                if child != exact and cost < self.limit[child]:
                    reached[child] = min(cost + 1, reached.get(child, 99))
        if not reached:
            self.moves[number][c] = -1
            return -1
        state = self.close(reached)
        after = self.numbers.get(state)
        if after is None:
            after = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.found.append(self.outcome(state))
        self.moves[number][c] = after
        return after

    def match(self, word: str) -> tuple[str, int] | None:
        """The term with the fewest edits that the word meets, and those edits."""
        if len(self.states) > STATES:
            self.reset()
        best: tuple[int, str] | None = None
        state, end = 0, len(word) - 1
        for i, c in enumerate(word):
            after = self.moves[state].get(c)
            state = self.move(state, c) if after is None else after
            if state < 0:
                break
            for term, cost in self.found[state]:
                if (i == end or self.terms[term]) and (best is None or (cost, term) < best):
                    best = (cost, term)
        return (best[1], best[0]) if best else None


def edits_of(term: str) -> int:
    """Edits allowed: none for short terms, two for long ones."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Finder:
    """Hits of a lexicon in texts; remembers the words it has met."""

    def __init__(self, terms: dict[str, bool]):
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[str, int] | None] = {}

    def of(self, word: str) -> tuple[str, int] | None:
        if word not in self.known:
            if len(self.known) >= 400_000:
                self.known.clear()
            self.known[word] = self.automaton.match(core(word))
        return self.known[word]

    def hits(self, text: str | None) -> list[tuple[int, str, int, bool]]:
        """(word number, term, edits, quoted) of every hit."""
        tokens = (text or "").split()
        of = self.of
        found = [(i, m) for i, w in enumerate(tokens) if (m := of(w)) is not None]
        out = []
        for i, (term, cost) in found:
            before = tokens[max(0, i - NEAR) : i + 1]
            after = tokens[i : i + NEAR + 1]
            opened = any(w[0] in QUOTES for w in before) and any(w.rstrip(".,;:!?")[-1:] in QUOTES and w.rstrip(".,;:!?")[-1:] for w in after)
            out.append((i, term, cost, opened or any(core(w) in REPORTS for w in before[:-1])))
        return out

    def counts(self, text: str | None) -> tuple[int, ...]:
        """Hits by kind, each up to a few: more of one kind tell no more."""
        n: Counter[str] = Counter()
        for _, term, cost, quoted in self.hits(text):
            kind = "stem" if self.automaton.terms[term] else "word"
            n["quoted" if quoted else f"fuzzy_{kind}" if cost else kind] += 1
        return tuple(min(MOST, n[x]) for x in FEATURES)


def inputs(counts: tuple[int, ...]) -> list[float]:
    """What the weights apply to: a fuzzy hit counts like an exact one, plus what learning finds to be different about it."""
    word, stem, fuzzy_word, fuzzy_stem, quoted = counts
    return [1, word + fuzzy_word, stem + fuzzy_stem, fuzzy_word, fuzzy_stem, quoted]


@dataclass
class Model:
    terms: dict[str, bool]
    weights: list[float]

    def score(self, counts: Iterable[int]) -> float:
        z = sum(w * x for w, x in zip(self.weights, inputs(tuple(counts)), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def beginnings(words: Iterable[str], shortest: int = 4, longest: int = 12) -> set[str]:
    """Words and their beginnings that can be terms; a trailing blank marks the whole word."""
    out = set()
    for w in words:
        if shortest <= len(w) <= 40 and any(c.isalpha() for c in w):
            out.add(w + " ")
            out.update(w[:n] for n in range(shortest, min(len(w), longest) + 1))
    return out


def choose_terms(stats: list[tuple[str, int, int]], least: int, most_terms: int = 2000) -> dict[str, bool]:
    """Terms of (candidate, toxic documents, other documents): the widest that are pure, no term inside another."""
    pure = sorted((t for t in stats if t[1] >= least and t[2] <= IMPURE * t[1]), key=lambda t: (-t[1], -len(t[0].rstrip()), t[0]))
    held = {t: n for t, n, _ in stats if n >= least}
    chosen: dict[str, bool] = {}
    taken: set[str] = set()
    for text, n, _ in pure:
        bare = text.rstrip()
        if any(bare[:i] in taken for i in range(1, len(bare) + 1)) or any(t.startswith(bare) for t in taken):
            continue
        whole = max((t for t in held if t.endswith(" ") and t.startswith(bare) and held[t] >= 0.95 * n), key=lambda t: held[t], default=None)
        term = whole.rstrip() if whole else bare
        chosen[term] = whole is None
        taken.add(bare)
        taken.add(term)
        if len(chosen) >= most_terms:
            break
    return chosen


def fit(groups: list[tuple[tuple[int, ...], int, int]], rounds: int = 50, ridge: float = 0.5) -> list[float]:
    """Weights of a ridge logistic model from (counts, toxic rows, all rows)."""
    x = np.array([inputs(g[0]) for g in groups], float).reshape(len(groups), 1 + len(FEATURES))
    pos, n = (np.array([g[i] for g in groups], float) for i in (1, 2))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (pos - n * p) - penalty * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max(initial=0) < 1e-8:
            break
    return w.tolist()


def learn(marked: DataFrame) -> Model:
    """A model of (text, toxic) rows, see ``labelled``."""
    rows = marked.select("text", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")

    def candidates(batches):
        pos: Counter[str] = Counter()
        neg: Counter[str] = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (pos if toxic else neg).update(beginnings({core(w) for w in (text or "").split()}))
        names = sorted(set(pos) | set(neg))
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([pos[t] for t in part], pa.int64()), pa.array([neg[t] for t in part], pa.int64())], names=["term", "pos", "neg"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    yes, no = totals.get(1, 0), totals.get(0, 0)
    if not yes or not no:
        return Model({}, [math.log((yes + 0.5) / (no + 0.5)), *[0.0] * len(FEATURES)])
    least = max(3, math.ceil(math.log(CHANCE) / math.log(yes / (yes + no))), yes // 200)
    stats = rows.mapInArrow(candidates, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # The lexicon comes from the most frequent pure candidates; with ``least`` tied to the sample they are few.
    found = stats.where((F.col("pos") >= least) & (F.col("neg") <= IMPURE * F.col("pos"))).orderBy(F.desc("pos"), "term").limit(CANDIDATES).collect()
    terms = choose_terms([(r["term"], r["pos"], r["neg"]) for r in found], least)
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def make():
        finder = Finder(shared.value)

        def step(batch: pa.RecordBatch):
            counts = [list(finder.counts(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.list_(pa.int32())), batch.column(1)], names=["counts", "toxic"])

        return step

    groups = rows.mapInArrow(per_batch(make), "counts array<int>, toxic int").groupBy("counts").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).collect()
    return Model(terms, fit(sorted((tuple(r["counts"]), r["pos"], r["n"]) for r in groups)))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, folds: int = 5) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold; the hash of an id decides which ``sample`` of them."""
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).where(f"id is not null and toxic in (0, 1) and not (crc32(cast(id as string)) % {folds} = 0)")
    n = max(1, marks.count())
    marks = marks.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(n)) < sample)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    return among(texts, "id", marks.select("id")).join(marks, "id").select("text", "toxic")


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``_toxicity``; all other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    where = names.index(text_col)

    def make():
        finder, held = Finder(shared.value.terms), shared.value

        def step(batch: pa.RecordBatch):
            scores = pa.array([held.score(finder.counts(t)) for t in batch.column(where).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, "_toxicity"])

        return step

    schema = docs.select("*", F.lit(0.0).alias("_toxicity")).schema
    return docs.mapInArrow(per_batch(make), schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``; a null id is not held out."""
    model = learn(labelled(docs, labels, id_col, text_col, label_col, sample))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = scored(slim, model)
    held = F.coalesce(F.expr("crc32(cast(id as string)) % 5 = 0"), F.lit(False))
    return out.select("id", held.alias("held_out"), F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))

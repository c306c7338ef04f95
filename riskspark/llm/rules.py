"""Quality rules: a decision list learned by sequential covering, as one Spark conditional expression.

Everything is DataFrame or SQL functions. ``features`` measures whole texts in one
projection without a shuffle. ``learn`` grows conjunctions of thresholds that single out
documents labelled as poor: each step is one aggregation of the labelled rows into counts
per feature, bin and label, from which the condition with the best gain is taken; a rule
grown on two thirds of the rows is cut back on the last third and accepted if it is precise
there. Covered rows leave, and the next rule is grown. ``decide`` turns the list into
nested conditions in order.

Null and empty texts have all counts 0. Without labels of both kinds the list is empty and
every document passes. Labels with null ids or values are left out; repeated ones count each.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import materialize

SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals", "n_digits"]
RATIOS = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "marks": ("n_marks", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "digits": ("n_digits", "word_chars"),
}
BINS = 48


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, although the body uses it often."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more.

    Windows are compared by 64-bit hashes. Most texts repeat none, which a hash set tells;
    else windows are sorted with their places, and the runs of equal ones give the
    places whose union of three words each is counted. No step is quadratic.
    """

    def places(windows: Column) -> Column:
        marked = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def met(s: Column) -> Column:
            def same(x: Column, at: Column) -> Column:
                return F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))

            return F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])

        return F.sort_array(let(F.sort_array(marked), met))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, start, lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(places(windows)))

    def windows_of(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) < 4, F.lit(0).cast("long")).otherwise(let(windows_of(h), counted)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts) of every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    word_counts = let(F.regexp_extract_all(text, F.lit(WORD), 0), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again")))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    out = docs.select(
        F.col(id_col).cast("long").alias("id"),
        word_counts.alias("w"),
        line_counts.alias("l"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        count_of(text, MARKS).cast("long").alias("n_marks"),
        capitals.cast("long").alias("n_capitals"),
        count_of(text, "0123456789").cast("long").alias("n_digits"),
    )
    return out.select("id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("w.again").alias("n_repeat_words"), F.col("l.n").alias("n_lines"), "n_marks", "n_capitals", "n_digits")


def ratio(name: str) -> Column:
    top, below = RATIOS[name]
    return F.col(top).cast("double") if below is None else F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(below)), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        return ratio(self.feature) > self.threshold if self.above else ratio(self.feature) <= self.threshold

    def binned(self) -> str:
        return f"`{self.feature}` {'>' if self.above else '<='} {self.bin}"

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def decide(rules: list[Rule]) -> Column:
    """Whether a document is kept: the first rule that holds rejects it."""
    out = F.lit(True)
    for rule in reversed(rules):
        held = rule[0].column()
        for c in rule[1:]:
            held = held & c.column()
        out = F.when(held, F.lit(False)).otherwise(out)
    return out


def gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained per covered poor document when (p0, n0) is narrowed to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


def grow(rows: DataFrame, cuts: dict[str, list[float]], most: int, precise: float) -> Rule:
    """The conjunction found greedily, one aggregation per condition."""
    rule: list[Condition] = []
    names = list(cuts)
    pairs = ", ".join(f"{i}, `{name}`" for i, name in enumerate(names))
    now = rows
    while len(rule) < most:
        counts = now.selectExpr("poor", f"stack({len(names)}, {pairs}) as (f, b)").groupBy("f", "b").agg(F.sum("poor").alias("p"), F.count("*").alias("n")).collect()
        if not counts:
            break
        p0 = sum(r["p"] for r in counts if r["f"] == 0)
        n0 = sum(r["n"] - r["p"] for r in counts if r["f"] == 0)
        if not p0 or (rule and p0 / (p0 + n0) >= precise):
            break
        best: tuple[float, Condition] | None = None
        for f, name in enumerate(names):
            p = n = 0
            held = {r["b"]: (r["p"], r["n"] - r["p"]) for r in counts if r["f"] == f}
            for b in range(len(cuts[name])):
                p, n = p + held.get(b, (0, 0))[0], n + held.get(b, (0, 0))[1]
                for above, got in ((False, gain(p, n, p0, n0)), (True, gain(p0 - p, n0 - n, p0, n0))):
                    if got > 1e-9 and (best is None or got > best[0] + 1e-9):
                        best = (got, Condition(name, above, cuts[name][b], b))
        if best is None:
            break
        rule.append(best[1])
        now = now.where(best[1].binned())
    return tuple(rule)


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of the rule that does best on fresh rows, with its poor and other documents there."""
    tests = [" and ".join(c.binned() for c in rule[: k + 1]) for k in range(len(rule))]
    found = rows.agg(*[F.expr(f"coalesce(sum(int({t}) * poor), 0)").alias(f"p{k}") for k, t in enumerate(tests)], *[F.expr(f"count_if({t})").alias(f"n{k}") for k, t in enumerate(tests)]).first()
    scores = [(found[f"p{k}"], found[f"n{k}"] - found[f"p{k}"]) for k in range(len(rule))]
    best = max(range(len(rule)), key=lambda k: ((scores[k][0] - scores[k][1]) / max(1, sum(scores[k])), scores[k][0], -k))
    return rule[: best + 1], *scores[best]


def learn(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most_rules: int = 10, most_conditions: int = 3, precise: float = 0.98, least: float = 0.9) -> list[Rule]:
    """Rules that reject documents labelled 0, from counts of the measured documents with a label."""
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), (F.col(label_col) == 0).cast("int").alias("poor")).where("_id is not null and poor is not null")
    marked = measured.join(marks, measured.id == marks._id).select("poor", "_id", *[ratio(n).alias(n) for n in RATIOS])
    marked = materialize(marked, "labelled")
    shares = [i / BINS for i in range(BINS + 1)]
    quantiles = marked.agg(*[F.percentile_approx(n, shares, 2000).alias(n) for n in RATIOS], F.sum("poor").alias("poor"), F.count("*").alias("all")).first()
    if not quantiles["all"] or not 0 < quantiles["poor"] < quantiles["all"]:
        return []
    # Thresholds lie half-way between neighbouring quantiles, the ends included, so a rule keeps its distance from both sides.
    cuts = {}
    for n in RATIOS:
        marks = sorted(set(quantiles[n]))
        cuts[n] = [(a + b) / 2 for a, b in zip(marks, marks[1:], strict=False)]
    bins = [F.expr(f"aggregate(cast(array({', '.join(f'{t!r}D' for t in cuts[n])}) as array<double>), 0, (k, t) -> k + int(`{n}` > t))").alias(n) for n in RATIOS]
    binned = materialize(marked.select("poor", F.pmod(F.xxhash64("_id", F.lit(29)), F.lit(3)).alias("part"), *bins), "binned")
    rules: list[Rule] = []
    left = binned
    while len(rules) < most_rules:
        rule = grow(left.where("part > 0"), cuts, most_conditions, precise)
        if not rule:
            break
        rule, p, n = prune(left.where("part = 0"), rule)
        if p < 5 or p / (p + n) < least:
            break
        rules.append(rule)
        left = left.where(f"not ({' and '.join(c.binned() for c in rule)})")
    return rules


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, counts, base_failed, kept) per row of ``docs``."""
    measured = materialize(features(docs, id_col, text_col), "features")
    rules = learn(measured, labels, id_col, label_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select("id", *COUNTS, failed.alias("base_failed"), (~failed & decide(rules)).alias("kept"))

"""Boosted trees grown level by level, each level one aggregation of (node, feature, bin) sums.

Two kinds of tree, for squared error (gradient g = prediction - y, hessian h = 1):

* ``second_order``: a node's split maximises
  GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda) over features and bin
  borders (bin <= b goes left); leaves get -G / (H + lambda), times the learning rate.
* ``random``: per (node, feature) one border only, drawn by a hash of (seed, tree, node,
  feature) among the borders that leave at least ``min_hessian`` on both sides; the best
  of these drawn borders wins (randomised trees). Leaves as above.

Features are cut into equal-frequency bins (exact quantiles over all rows, repeats
removed); a null value is bin -1 and so always goes left. Ties of gain go to the
smaller feature name, then the smaller bin. A node splits only with gain > 0 and
``min_hessian`` on both sides. Rows with a null target take no part; an empty table
gives trees without splits and the base value 0. Other columns are not read.

Per level only the histogram (nodes x features x bins rows, partial sums before the
shuffle) and the chosen splits (at most 2^depth rows, depth at most ``MAX_DEPTH``) meet
on the driver. Rows are never rewritten: a row's node comes from the path conditions
of the splits so far, so each level is one scan of the binned table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.columns import quoted
from riskspark.functions.ordering import bin_edges, bin_index
from riskspark.session import materialize

MAX_DEPTH = 10


@dataclass
class Tree:
    """Splits {node: (feature, bin)} and leaves {node: value}; node 1 is the root, children 2n and 2n + 1."""

    splits: dict[int, tuple[str, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)


def _bin(feature: str, prefix: str = "_bin_") -> str:
    return f"{prefix}{feature}"


def binned(df: DataFrame, features: list[str], target: str, bins: int) -> tuple[DataFrame, dict[str, list[float]]]:
    """(bins of the features, y) for rows with a target, written once."""
    rows = df.where(F.col(quoted(target)).isNotNull())
    edges = bin_edges(rows, features, bins)
    cols = [F.coalesce(bin_index(F.col(quoted(f)).cast("double"), edges[f]), F.lit(-1)).alias(_bin(f)) for f in features]
    return materialize(rows.select(*cols, F.col(quoted(target)).cast("double").alias("_y")), "boost-binned"), edges


def _paths(tree: Tree, prefix: str = "_bin_") -> dict[int, Column]:
    """The condition of every node that the splits reach, by the path from the root."""
    out = {1: F.lit(True)}
    for node in sorted(tree.splits):
        feature, border = tree.splits[node]
        left = F.col(quoted(_bin(feature, prefix))) <= F.lit(border)
        out[2 * node] = out[node] & left
        out[2 * node + 1] = out[node] & ~left
    return out


def node_of(tree: Tree, frontier: Iterable[int]) -> Column:
    paths = _paths(tree)
    nodes = sorted(frontier)
    out = F.lit(None).cast("long")
    for node in reversed(nodes):
        out = F.when(paths[node], F.lit(node)).otherwise(out)
    return out


def predict_tree(tree: Tree, prefix: str = "_bin_") -> Column:
    paths = _paths(tree, prefix)
    out = F.lit(0.0)
    for node in sorted(tree.leaves, reverse=True):
        out = F.when(paths[node], F.lit(tree.leaves[node])).otherwise(out)
    return out


def histogram(rows: DataFrame, features: list[str], node: Column, gradient: Column) -> DataFrame:
    """(node, feature, bin, g, h): sums per cell; one row per cell present."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(_bin(f)).alias("bin")) for f in features])
    return (
        rows.select(node.alias("node"), gradient.alias("g"), F.explode(cells).alias("c"))
        .where(F.col("node").isNotNull())
        .groupBy("node", "c.feature", "c.bin")
        .agg(F.sum("g").alias("g"), F.count(F.lit(1)).cast("double").alias("h"))
    )


def best_splits(
    hist: DataFrame, lam: float, min_hessian: float, kind: str = "second_order", seed: int = 0, tree: int = 0
) -> DataFrame:
    """(node, feature, bin, gain, left, right): the chosen border of every node that splits."""
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("node", "feature")
    sums = hist.select(
        "node", "feature", "bin",
        F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht"),
    )
    score = lambda g, h: g * g / (h + F.lit(lam))
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
    cand = sums.where((F.col("hl") >= min_hessian) & (hr >= min_hessian)).select(
        "node", "feature", "bin",
        (score(F.col("gl"), F.col("hl")) + score(gr, hr) - score(F.col("gt"), F.col("ht"))).alias("gain"),
        F.col("hl").alias("left"), hr.alias("right"),
    )
    if kind == "random":
        order = Window.partitionBy("node", "feature").orderBy("bin")
        draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(tree), F.col("node"), F.col("feature")), F.col("_n"))
        cand = (
            cand.withColumn("_rank", F.row_number().over(order) - 1)
            .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("node", "feature")))
            .where(F.col("_rank") == draw)
            .drop("_rank", "_n")
        )
    elif kind != "second_order":
        raise ValueError(f"unknown kind of tree: {kind}")
    first = Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "bin")
    return cand.where(F.col("gain") > 0).withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def grow(
    rows: DataFrame, features: list[str], gradient: Column, depth: int, lam: float, min_hessian: float,
    rate: float, kind: str, seed: int, index: int,
) -> Tree:
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must lie in 0..{MAX_DEPTH}")
    tree, frontier = Tree(), [1]
    for _ in range(depth):
        hist = histogram(rows, features, node_of(tree, frontier), gradient)
        # At most one row per frontier node, 2^depth at most.
        chosen = best_splits(hist, lam, min_hessian, kind, seed, index).collect()
        if not chosen:
            break
        for r in chosen:
            tree.splits[int(r["node"])] = (r["feature"], int(r["bin"]))
        frontier = [c for n in frontier for c in ((2 * n, 2 * n + 1) if n in tree.splits else (n,))]
    leaves = rows.select(node_of(tree, frontier).alias("node"), gradient.alias("g")).groupBy("node").agg(
        F.sum("g").alias("g"), F.count(F.lit(1)).alias("h")
    )
    for r in leaves.collect():  # one row per leaf
        tree.leaves[int(r["node"])] = -rate * float(r["g"]) / (float(r["h"]) + lam)
    return tree


@dataclass
class Booster:
    features: list[str]
    edges: dict[str, list[float]]
    base: float
    trees: list[Tree]

    def prediction(self, prefix: str = "_bin_") -> Column:
        """Over columns of bins named ``prefix`` + feature (see :func:`binned`)."""
        out = F.lit(self.base)
        for tree in self.trees:
            out = out + predict_tree(tree, prefix)
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with ``output`` added; its own columns, whatever their names, are kept as they are."""
        prefix = "_bin_"
        while any(c.startswith(prefix) for c in df.columns):
            prefix = "_" + prefix
        names = [_bin(f, prefix) for f in self.features]
        bins = [F.coalesce(bin_index(F.col(quoted(f)).cast("double"), self.edges[f]), F.lit(-1)).alias(n) for f, n in zip(self.features, names)]
        return df.select("*", *bins).withColumn(output, self.prediction(prefix)).drop(*names)


def fit_booster(
    df: DataFrame, features: Iterable[str], target: str, trees: int = 20, depth: int = 3, bins: int = 32,
    lam: float = 1.0, min_hessian: float = 1.0, rate: float = 0.3, kind: str = "second_order", seed: int = 7,
) -> Booster:
    features = list(features)
    rows, edges = binned(df, features, target, bins)
    mean = rows.agg(F.avg("_y")).first()[0]
    model = Booster(features, edges, float(mean) if mean is not None else 0.0, [])
    for index in range(trees):
        gradient = model.prediction() - F.col("_y")
        model.trees.append(grow(rows, features, gradient, depth, lam, min_hessian, rate, kind, seed, index))
    return model


def root_split(df: DataFrame, features: Iterable[str], target: str, bins: int = 8, lam: float = 1.0,
               min_hessian: float = 1.0, kind: str = "second_order", seed: int = 7) -> DataFrame:
    """The first split of the first tree: (node, feature, bin, left_rows, right_rows, gain_share), gain over all squared error."""
    features = list(features)
    rows, _ = binned(df, features, target, bins)
    mean = rows.agg(F.avg("_y")).first()[0] or 0.0
    gradient = F.lit(float(mean)) - F.col("_y")
    sse = rows.agg(F.sum(gradient * gradient)).first()[0] or 0.0
    hist = histogram(rows, features, F.lit(1).cast("long"), gradient)
    chosen = best_splits(hist, lam, min_hessian, kind, seed, 0)
    return chosen.select(
        "node", "feature", "bin", F.col("left").cast("long").alias("left_rows"), F.col("right").cast("long").alias("right_rows"),
        (F.col("gain") / F.lit(sse if sse > 0 else 1.0)).alias("gain_share"),
    )

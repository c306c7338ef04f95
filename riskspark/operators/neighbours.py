"""Mutual information by the k-th neighbour estimator (Kraskov, Stoegbauer, Grassberger 2004, first form).

For each feature x and the target y, on coordinates u = (x - mean) / std and
v = (y - mean) / std (population std, 1 where it is 0; translation does not change
the estimate), each rounded to 9 decimals so that every later comparison is exact:

* eps_i: the k-th smallest max-norm distance max(|u_j - u_i|, |v_j - v_i|) over all
  other rows j (copies of the same point count, at distance 0);
* n_x(i): the rows j != i with u_i - eps_i < u_j < u_i + eps_i (with eps_i = 0: u_j = u_i),
  n_y(i) alike on v;
* MI = psi(N) + psi(k) - mean(psi(n_x + 1)) - mean(psi(n_y + 1)), at least 0.

Rows with a null, NaN or infinite value of the feature or the target take no part in that
feature. A feature with at most k such rows gets a null estimate. Other columns of
the input, whatever their names, are not read. The result is deterministic (the
library this replaces adds random noise of 1e-10 to break ties; here ties are kept
and counted as above).

How it runs, for any table size:

1. Rows collapse to distinct points with counts (partial aggregation), so a value
   held by a third of all rows is one point of large weight.
2. Neighbours by grids of growing cell width w (w0 = sqrt(k / N) / 2 in std units,
   times 4 a level): every still open point is sent to its own and the 8 adjacent
   cells (the halo); points stay in their cell. A join on (feature, cell) pairs them;
   per point the weights are added in order of distance. A point is settled once its
   k-th distance is at most w (times 0.999 against rounding at cell borders): every
   point outside the 3 x 3 block is farther than w. At the level where a point
   settles, its block holds about (3 w / eps)^2 k <= 150 k points where the density is
   smooth around it, so the work per point does not grow with the table. Open points
   go on to the next level; at the last level one cell spans all values.
3. Marginal counts are range counts on one axis: the distinct values with their
   counts and, per point, its two bounds as zero-weight markers are put in one order
   (markers of the upper bound before equal values, of the lower bound after them) and
   :func:`running_total` adds the counts before each marker, by value ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.columns import quoted
from riskspark.functions.ordering import running_total
from riskspark.session import discard, materialize

# Fixed values of the estimator: neighbours counted, decimals of the scaled coordinates,
# growth of the cell width per level and the share of the width a settled distance may take.
NEIGHBOURS = 3
DECIMALS = 9
GROWTH = 4.0
MARGIN = 0.999
EULER = 0.5772156649015329


def digamma(n: Column) -> Column:
    """psi(n) for n >= 1: six steps of the recurrence, then the asymptotic series."""
    m = n.cast("double") + F.lit(6.0)
    series = F.log(m) - F.lit(0.5) / m - F.lit(1.0 / 12) / (m * m) + F.lit(1.0 / 120) / F.pow(m, 4) - F.lit(1.0 / 252) / F.pow(m, 6)
    steps = sum((F.lit(1.0) / (n.cast("double") + F.lit(float(j))) for j in range(6)), F.lit(0.0))
    return series - steps


def _points(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, u, v, m): distinct scaled points with their numbers of rows."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(quoted(f)).cast("double").alias("x")) for f in features]
    )
    long = (
        df.select(F.explode(pairs).alias("p"), F.col(quoted(target)).cast("double").alias("y"))
        .select("p.feature", "p.x", "y")
        .where((F.abs("x") < F.lit(math.inf)) & (F.abs("y") < F.lit(math.inf)))
    )
    # Distinct points with counts first, so that a hot value weighs once; means, then
    # squared deviations from them (two passes, no cancellation of large squares).
    counted = materialize(long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("m")), "mi-points")
    means = counted.groupBy("feature").agg(
        (F.sum(F.col("m") * F.col("x")) / F.sum("m")).alias("mx"),
        (F.sum(F.col("m") * F.col("y")) / F.sum("m")).alias("my"),
    )
    # One row per feature: broadcast.
    spread = lambda c, mean: F.sum(F.col("m") * (F.col(c) - F.col(mean)) * (F.col(c) - F.col(mean))) / F.sum("m")
    moments = counted.join(F.broadcast(means), "feature").groupBy("feature", "mx", "my").agg(
        F.sqrt(spread("x", "mx")).alias("dx"), F.sqrt(spread("y", "my")).alias("dy")
    )
    scales = moments.select(
        "feature", "mx", "my",
        F.when(F.col("dx") > 0, F.col("dx")).otherwise(1.0).alias("sx"),
        F.when(F.col("dy") > 0, F.col("dy")).otherwise(1.0).alias("sy"),
    )
    scaled = counted.join(F.broadcast(scales), "feature").select(
        "feature",
        F.round((F.col("x") - F.col("mx")) / F.col("sx"), DECIMALS).alias("u"),
        F.round((F.col("y") - F.col("my")) / F.col("sy"), DECIMALS).alias("v"),
        "m",
    )
    # Two raw points may meet at the same rounded point: add them up.
    return scaled.groupBy("feature", "u", "v").agg(F.sum("m").alias("m"))


def _radii(points: DataFrame, k: int, start: float, levels: int) -> DataFrame:
    """(feature, u, v, eps) for every point of a feature with more than k rows."""
    open_ = points.select("feature", "u", "v", "m")
    settled: list[DataFrame] = []
    for level in range(levels + 1):
        w = start * GROWTH**level
        cell = lambda c: F.floor(F.col(c) / F.lit(w)).cast("long")
        halo = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
        queries = open_.select(
            "feature", F.col("u").alias("qu"), F.col("v").alias("qv"), F.col("m").alias("qm"), F.explode(halo).alias("h")
        ).select(
            "feature", "qu", "qv", "qm",
            (cell("qu") + F.col("h.a")).alias("cx"), (cell("qv") + F.col("h.b")).alias("cy"),
        )
        data = points.select("feature", "u", "v", "m", cell("u").alias("cx"), cell("v").alias("cy"))
        pairs = queries.join(data, ["feature", "cx", "cy"]).select(
            "feature", "qu", "qv",
            F.greatest(F.abs(F.col("u") - F.col("qu")), F.abs(F.col("v") - F.col("qv"))).alias("d"),
            (F.col("m") - F.when((F.col("u") == F.col("qu")) & (F.col("v") == F.col("qv")), 1).otherwise(0)).alias("w"),
        )
        nearer = Window.partitionBy("feature", "qu", "qv").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
        found = (
            pairs.withColumn("upto", F.sum("w").over(nearer))
            .groupBy("feature", "qu", "qv")
            .agg(F.min(F.when(F.col("upto") >= k, F.col("d"))).alias("eps"))
            .where(F.col("eps").isNotNull() & (F.col("eps") <= F.lit(w * MARGIN)))
            .select("feature", F.col("qu").alias("u"), F.col("qv").alias("v"), "eps")
        )
        done = materialize(found, f"mi-radii-{level}")
        settled.append(done)
        rest = open_.join(done, ["feature", "u", "v"], "left_anti")
        if level < levels:
            previous = open_
            open_ = materialize(rest, f"mi-open-{level}")
            if level > 0:
                discard(previous)
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def _within(points: DataFrame, radii: DataFrame, axis: str) -> DataFrame:
    """(feature, u, v, n_<axis>): rows j != i whose coordinate lies within eps_i of the point's."""
    values = points.groupBy("feature", F.col(axis).alias("value")).agg(F.sum("m").alias("weight")).select(
        "feature", "value", F.lit(1).alias("tie"), "weight"
    )
    wide = F.col("eps") > 0
    upper = radii.select(
        "feature", "u", "v", (F.col(axis) + F.col("eps")).alias("value"), F.when(wide, 0).otherwise(2).alias("tie")
    )
    lower = radii.select(
        "feature", "u", "v", (F.col(axis) - F.col("eps")).alias("value"), F.when(wide, 2).otherwise(0).alias("tie")
    )
    marks = upper.unionByName(lower).select("feature", "value", "tie").distinct().select(
        "feature", "value", "tie", F.lit(0).cast("long").alias("weight")
    )
    table = materialize(
        values.unionByName(marks).groupBy("feature", "value", "tie").agg(F.sum("weight").alias("weight"))
        .select("feature", F.struct("value", "tie").alias("key"), "weight"),
        f"mi-axis-{axis}",
    )
    before = materialize(running_total(table, "weight", order="key", group="feature"), f"mi-before-{axis}").select(
        "feature", F.col("key.value").alias("value"), F.col("key.tie").alias("tie"), "before"
    )
    hi = upper.join(before, ["feature", "value", "tie"]).select("feature", "u", "v", F.col("before").alias("hi"))
    lo = lower.join(before, ["feature", "value", "tie"]).select("feature", "u", "v", F.col("before").alias("lo"))
    return hi.join(lo, ["feature", "u", "v"]).select(
        "feature", "u", "v", (F.col("hi") - F.col("lo") - 1).alias(f"n_{axis}")
    )


def neighbour_information(
    df: DataFrame, features: Iterable[str], target: str, k: int = NEIGHBOURS
) -> DataFrame:
    """(feature, mutual_information, rows): the k-th neighbour estimate in nats per feature.

    See the module text for the definition, null rows, ties and features with too few rows.
    """
    features = list(features)
    spark = df.sparkSession
    points = materialize(_points(df, features, target), "mi-scaled")
    sizes = points.groupBy("feature").agg(
        F.sum("m").alias("rows"),
        F.greatest(F.max("u") - F.min("u"), F.max("v") - F.min("v")).alias("span"),
    )
    # One row per feature.
    stats = sizes.collect()
    rows = {r["feature"]: int(r["rows"]) for r in stats}
    big = max(rows.values(), default=0)
    span = max((float(r["span"]) for r in stats), default=0.0)
    usable = points.where(F.col("feature").isin([f for f, n in rows.items() if n > k]))
    answers = []
    if big > k:
        start = math.sqrt(k / big) / 2
        levels = max(0, math.ceil(math.log(max(span, start) / start, GROWTH))) + 1
        radii = materialize(_radii(usable, k, start, levels), "mi-radii")
        nx = _within(usable, radii, "u").withColumnRenamed("n_u", "nx")
        ny = _within(usable, radii, "v").withColumnRenamed("n_v", "ny")
        per_point = usable.join(nx, ["feature", "u", "v"]).join(ny, ["feature", "u", "v"])
        answers.append(
            per_point.groupBy("feature").agg(
                (F.sum(F.col("m") * digamma(F.col("nx") + 1)) / F.sum("m")).alias("px"),
                (F.sum(F.col("m") * digamma(F.col("ny") + 1)) / F.sum("m")).alias("py"),
                F.sum("m").alias("rows"),
            ).select(
                "feature",
                F.greatest(
                    digamma(F.col("rows")) + digamma(F.lit(k)) - F.col("px") - F.col("py"), F.lit(0.0)
                ).alias("mutual_information"),
                F.col("rows").cast("long").alias("rows"),
            )
        )
    few = [(f, None, rows.get(f, 0)) for f in features if rows.get(f, 0) <= k]
    if few:
        answers.append(spark.createDataFrame(few, "feature string, mutual_information double, rows long"))
    if not answers:
        return spark.createDataFrame([], "feature string, mutual_information double, rows long")
    out = answers[0]
    for a in answers[1:]:
        out = out.unionByName(a)
    return out

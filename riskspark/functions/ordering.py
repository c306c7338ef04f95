"""Exact order statistics over a whole table without a one-task sort.

All of them rest on one idea: collapse a column to its distinct values with
counts (partial aggregation absorbs hot values), spread these by value range
and add up counts range by range. Only the per-range totals, one row per range,
ever meet in a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.columns import quoted
from riskspark.session import is_small, lookup, materialize

# Up to this many distinct values, counted beforehand, a plain window per column is used.
SMALL_DISTINCT = 200_000
# Tables estimated above this size get their quantiles bracketed first.
DIRECT_BYTES = 10 << 30


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(name, value, n) of the non-null, non-NaN values of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(quoted(c)).cast("double").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.name", "p.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_total(
    table: DataFrame,
    weight: str,
    order: str = "value",
    group: str = "name",
    small: int = SMALL_DISTINCT,
    few: bool | None = None,
) -> DataFrame:
    """Add ``before``: the sum of ``weight`` over smaller ``order`` values of the same group.

    ``table`` must hold distinct (group, order) pairs and be a written table. ``few``
    tells whether it holds at most ``small`` rows, if the caller has counted already.
    """
    if is_small(table, small) if few is None else few:
        below = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumn("before", F.coalesce(F.sum(weight).over(below), F.lit(0)))

    ranged = materialize(
        table.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    totals = ranged.groupBy(group, "_range").agg(F.sum(weight).alias("_total"))
    before_range = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group, "_range", F.coalesce(F.sum("_total").over(before_range), F.lit(0)).alias("_offset")
    )
    in_range = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per (group, range): bounded by the number of partitions.
    return (
        ranged.join(F.broadcast(offsets), [group, "_range"])
        .withColumn("before", F.col("_offset") + F.coalesce(F.sum(weight).over(in_range), F.lit(0)))
        .drop("_range", "_offset")
    )


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, Iterable[float]],
    small: int = SMALL_DISTINCT,
    direct_bytes: int = DIRECT_BYTES,
) -> dict[str, dict[float, float | None]]:
    """Exact linear-interpolated quantiles of several columns.

    Returns ``{column: {p: value}}``; a column without values gives None. Large
    tables are first narrowed to the neighbourhood of each quantile, so that their
    distinct values need not be shuffled.
    """
    wanted = {c: [float(p) for p in ps] for c, ps in wanted.items()}
    found: dict[str, dict[float, float | None]] = {c: {p: None for p in ps} for c, ps in wanted.items()}
    if not wanted:
        return found
    direct = wanted
    if estimated_bytes(df) > direct_bytes:
        narrowed = _narrowed_quantiles(df, wanted, small)
        direct = {c: ps for c, ps in wanted.items() if c not in narrowed}
        found |= narrowed
    if direct:
        counts = materialize(value_counts(df, direct), "counts")
        totals = counts.groupBy("name").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct")).collect()
        sizes = {r["name"]: r["rows"] for r in totals}
        few = sum(r["distinct"] for r in totals) <= small
        needed = {(c, r) for c, n in sizes.items() for p in direct[c] for r in _ranks(n, p)}
        at = _values_at(running_total(counts, "n", few=few), needed)
        for c, n in sizes.items():
            found[c] = {p: _interpolated(n, p, lambda r, c=c: at[c, r]) for p in direct[c]}
    return found


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan, without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _ranks(rows: int, p: float) -> tuple[int, int]:
    low = int((rows - 1) * p)
    return low, min(low + 1, rows - 1)


def _interpolated(rows: int, p: float, value_at: Callable[[int], float]) -> float:
    low, high = _ranks(rows, p)
    a, b = value_at(low), value_at(high)
    return a + (b - a) * ((rows - 1) * p - low)


def _values_at(ranked: DataFrame, needed: Iterable[tuple[str, int]]) -> dict[tuple[str, int], float]:
    """The value at each (name, rank): one or two rows per quantile."""
    needed = sorted(needed)
    if not needed:
        return {}
    targets = ranked.sparkSession.createDataFrame(needed, "name string, rank long")
    hits = (
        ranked.join(F.broadcast(targets), "name")
        .where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("name", "rank", "value")
        .collect()
    )
    return {(r["name"], r["rank"]): r["value"] for r in hits}


def _narrowed_quantiles(
    df: DataFrame, wanted: Mapping[str, list[float]], small: int, accuracy: int = 10_000
) -> dict[str, dict[float, float | None]]:
    """Exact quantiles from the values near each one; columns where that failed are left out.

    A first pass of bounded sketches brackets every quantile, a second one counts
    the rows below each bracket, a third collapses the rows inside. No pass shuffles
    more than the brackets hold. If a bracket misses its ranks the column is not
    answered here and takes the direct way.
    """
    margin = 3.0 / accuracy
    marks = {c: [q for p in ps for q in (max(p - margin, 0.0), min(p + margin, 1.0))] for c, ps in wanted.items()}
    known = {c: F.when(~F.isnan(F.col(quoted(c)).cast("double")), F.col(quoted(c)).cast("double")) for c in wanted}
    first = df.agg(
        *[F.count(known[c]).alias(f"{c}|n") for c in wanted],
        *[F.percentile_approx(known[c], marks[c], accuracy).alias(f"{c}|m") for c in wanted],
    ).first()
    brackets = []  # (group, column, p, low, high)
    for c, ps in wanted.items():
        if first[f"{c}|n"]:
            edges = first[f"{c}|m"]
            brackets += [(f"{c}|{i}", c, p, edges[2 * i], edges[2 * i + 1]) for i, p in enumerate(ps)]
    if not brackets:
        return {}
    below = df.agg(*[F.count_if(known[c] < F.lit(low)).alias(g) for g, c, _, low, _ in brackets]).first()
    inside = F.array(
        *[
            F.when(known[c].between(low, high), F.struct(F.lit(g).alias("name"), known[c].alias("value")))
            for g, c, _, low, high in brackets
        ]
    )
    counts = (
        df.select(F.explode(F.array_compact(inside)).alias("p"))
        .groupBy("p.name", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_total(materialize(counts, "brackets"), "n", small=small)
    local = lambda g, c, r: (g, r - below[g])
    needed = {local(g, c, r) for g, c, p, _, _ in brackets for r in _ranks(first[f"{c}|n"], p)}
    at = _values_at(ranked, needed)
    out: dict[str, dict[float, float | None]] = {}
    for g, c, p, _, _ in brackets:
        rows = first[f"{c}|n"]
        if all(local(g, c, r) in at for r in _ranks(rows, p)):
            out.setdefault(c, {})[p] = _interpolated(rows, p, lambda r, g=g, c=c: at[local(g, c, r)])
    return {c: {p: out[c][p] for p in ps} for c, ps in wanted.items() if set(out.get(c, {})) >= set(ps)}


def medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float | None]:
    """Exact median per column."""
    return {c: q[0.5] for c, q in quantiles(df, {c: [0.5] for c in columns}).items()}


def average_percent_rank(df: DataFrame, column: str, output: str, small: int = SMALL_DISTINCT) -> DataFrame:
    """Share of the average rank (ties share their mean rank) among non-null rows; null stays null."""
    counts = materialize(value_counts(df, [column]), "ranks")
    rows = counts.agg(F.sum("n")).first()[0]
    if not rows:
        return df.withColumn(output, F.lit(None).cast("double"))
    ranked = materialize(
        running_total(counts, "n", small=small).select(
            F.col("value").alias("_value"),
            ((F.col("before") + (F.col("n") + 1) / 2) / F.lit(float(rows))).alias(output),
        ),
        "ranks",
    )
    # A hot value is no problem when broadcast; beyond that bound AQE splits the skewed partition,
    # and rows without a value, which would all meet in one, stay out of the join.
    match = F.col(column).cast("double") == F.col("_value")
    table = lookup(ranked)
    if table is not ranked:
        return df.join(table, match, "left").drop("_value")
    known = df.where(F.col(column).isNotNull()).join(ranked, match, "left").drop("_value")
    return known.unionByName(df.where(F.col(column).isNull()).withColumn(output, F.lit(None).cast("double")))


def bin_edges(df: DataFrame, columns: Iterable[str], bins: int) -> dict[str, list[float]]:
    """Inner edges of equal-frequency bins, repeats removed."""
    steps = [i / bins for i in range(1, bins)]
    found = quantiles(df, {c: steps for c in columns})
    return {c: sorted({v for v in qs.values() if v is not None}) for c, qs in found.items()}


def bin_index(value: Column, edges: list[float]) -> Column:
    """Number of edges below ``value``."""
    out = F.lit(0)
    for edge in edges:
        out = out + (value > F.lit(edge)).cast("int")
    return out

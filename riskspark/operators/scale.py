"""MinMax, standard and robust scaling learned once and applied as literals."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import numeric_columns, present, quoted
from riskspark.functions.ordering import quantiles

SCALER_SCHEMA = "column string, kind string, shift double, scale double"


@dataclass(frozen=True)
class Scaler:
    """Per column (kind, shift, scale); a value becomes (value - shift) / scale."""

    params: dict[str, tuple[str, float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale the columns the table has; null stays null."""
        new = {
            c: (F.col(quoted(c)).cast("double") - F.lit(shift)) / F.lit(scale)
            for c, (_, shift, scale) in self.params.items()
            if c in df.columns
        }
        return df.withColumns(new) if new else df

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(c, *p) for c, p in self.params.items()]
        spark.createDataFrame(rows, SCALER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scaler:
        rows = spark.read.schema(SCALER_SCHEMA).parquet(path).collect()
        return Scaler({r["column"]: (r["kind"], r["shift"], r["scale"]) for r in rows})


def or_one(spread: float) -> float:
    """A constant column has no spread and is only shifted."""
    return spread if spread else 1.0


def fit_scaler(
    df: DataFrame,
    minmax: Iterable[str] = tuple(C.MINMAX_COLUMNS),
    standard: Iterable[str] = tuple(C.STANDARD_COLUMNS),
) -> Scaler:
    """Learn both column groups in one aggregate."""
    minmax, standard = present(df, minmax), present(df, standard)
    wanted = [(c, n, f) for c in minmax for n, f in (("lo", F.min), ("hi", F.max))]
    wanted += [(c, n, f) for c in standard for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]
    if not wanted:
        return Scaler({})
    row = df.agg(*[f(F.col(quoted(c)).cast("double")).alias(f"{c}|{n}") for c, n, f in wanted]).first().asDict()
    params = {}
    for c in minmax:
        if row[f"{c}|lo"] is not None:
            params[c] = ("minmax", row[f"{c}|lo"], or_one(row[f"{c}|hi"] - row[f"{c}|lo"]))
    for c in standard:
        if row[f"{c}|mean"] is not None:
            params[c] = ("standard", row[f"{c}|mean"], or_one(row[f"{c}|dev"]))
    return Scaler(params)


def scaler_from_moments(assets: DataFrame, minmax: Iterable[str], standard: Iterable[str]) -> Scaler:
    """The scaler :func:`fit_scaler` would learn from all rows, from their per-asset moments.

    Group means and squared deviations add up to the overall ones without loss of
    accuracy: within-group deviation plus the spread of the group means.
    """
    minmax, standard = list(minmax), list(standard)
    total = lambda c: F.sum(F.col(f"_{c}_avg") * F.col(f"_{c}_n")) / F.sum(f"_{c}_n")
    ends = [F.min(f"_{c}_lo").alias(f"{c}|lo") for c in minmax] + [F.max(f"_{c}_hi").alias(f"{c}|hi") for c in minmax]
    row = assets.agg(*ends, *[total(c).alias(f"{c}|mean") for c in standard]).first().asDict()
    means = {c: row[f"{c}|mean"] for c in standard if row[f"{c}|mean"] is not None}
    params = {
        c: ("minmax", row[f"{c}|lo"], or_one(row[f"{c}|hi"] - row[f"{c}|lo"]))
        for c in minmax
        if row[f"{c}|lo"] is not None
    }
    if means:
        between = lambda c: F.col(f"_{c}_n") * F.pow(F.col(f"_{c}_avg") - F.lit(means[c]), F.lit(2.0))
        spread = lambda c: F.sqrt(F.sum(F.col(f"_{c}_dev") + between(c)) / F.sum(f"_{c}_n"))
        row = assets.agg(*[spread(c).alias(c) for c in means]).first()
        params |= {c: ("standard", m, or_one(row[c])) for c, m in means.items()}
    return Scaler(params)


def fit_robust(df: DataFrame, exclude: Iterable[str] = ()) -> Scaler:
    """Median and interquartile range of every number column, exact."""
    found = quantiles(df, {c: [0.25, 0.5, 0.75] for c in numeric_columns(df, exclude)})
    return Scaler({c: ("robust", q[0.5], or_one(q[0.75] - q[0.25])) for c, q in found.items() if q[0.5] is not None})


def robust_scale(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[DataFrame, Scaler]:
    """(scaled table, fitted scaler)."""
    scaler = fit_robust(df, exclude)
    return scaler.transform(df), scaler


def rescale_aggregates(assets: DataFrame, scaler: Scaler) -> DataFrame:
    """Per-asset aggregates of the scaled rows, from the aggregates of the unscaled rows.

    Scaling is a rising straight line per column, so min, max and mean move with
    it and a sum of n values becomes (sum - n * shift) / scale. This saves the
    pass over all rows that fitting and scaling before the roll-up would cost.
    Sums need the number of non-null values, ``_<column>_n``.
    """
    new = {}
    for source, (_, shift, scale) in scaler.params.items():
        for fn in C.ASSET_AGGREGATES.get(source, []):
            name = f"{source}_{fn}"
            if name in assets.columns:
                base = F.col(f"_{source}_n") * F.lit(shift) if fn == "sum" else F.lit(shift)
                new[name] = (F.col(name) - base) / F.lit(scale)
    return assets.withColumns(new)

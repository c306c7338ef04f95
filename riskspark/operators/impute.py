"""Missing values: nearest neighbours, medians and domain defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.functions.columns import numeric_columns, present
from riskspark.functions.ordering import SMALL_DISTINCT, medians, running_total
from riskspark.session import BROADCAST_ROWS, is_small, materialize


@dataclass
class NeighbourModel:
    """Mean of the k nearest donors over a pair of columns.

    With two columns a row that misses one sees the others only through the
    column it has, so the search is along one line: donors collapse to one row
    per distinct value, however many rows share it. ``donors`` holds both
    directions: (name = column to fill, value = known neighbour, n, total).
    """

    pair: tuple[str, str]
    k: int
    means: dict[str, float | None]
    donors: DataFrame = field(repr=False)
    small: int = SMALL_DISTINCT
    broadcast_rows: int = BROADCAST_ROWS

    def fill_table(self, df: DataFrame) -> DataFrame:
        """(name, key, fill) for every known value that occurs next to a missing one."""
        a, b = self.pair
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        gap = F.when(x.isNull(), F.struct(F.lit(a).alias("name"), y.alias("value"))).otherwise(
            F.struct(F.lit(b).alias("name"), x.alias("value"))
        )
        asked = df.where(x.isNull() != y.isNull()).select(gap.alias("g")).select("g.*").distinct()
        merged = (
            self.donors.withColumn("asked", F.lit(False))
            .unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
            .groupBy("name", "value")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("asked").alias("asked"))
            .withColumn("is_donor", F.col("n").isNotNull().cast("int"))
        )
        ranked = running_total(materialize(merged, "keys"), "is_donor", small=self.small)
        ranked = ranked.withColumn("place", F.col("before") + F.col("is_donor"))
        donors = ranked.where("is_donor = 1").select(
            "name", F.col("place").alias("near"), F.col("value").alias("donor"), "n", "total"
        )
        # k distinct donor values on each side always contain the k nearest rows.
        near = F.explode(F.sequence(F.col("place") - (self.k - 1), F.col("place") + self.k))
        pairs = (
            ranked.where("asked")
            .select("name", "value", near.alias("near"))
            .join(donors, ["name", "near"])
            .withColumn("gap", F.abs(F.col("donor") - F.col("value")))
        )
        closest = (
            Window.partitionBy("name", "value").orderBy("gap", "donor").rowsBetween(Window.unboundedPreceding, -1)
        )
        left = self.k - F.coalesce(F.sum("n").over(closest), F.lit(0))
        filled = (
            pairs.withColumn("take", F.greatest(F.least(F.col("n"), left), F.lit(0)))
            .groupBy("name", "value")
            .agg((F.sum(F.col("take") * F.col("total") / F.col("n")) / F.sum("take")).alias("fill"))
        )
        return materialize(filled.withColumnRenamed("value", "key"), "fill")

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill both columns; rows that miss both get the column means."""
        a, b = self.pair
        fills = self.fill_table(df)
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        one_gap = x.isNull() != y.isNull()
        asks = df.withColumns(
            {
                "_name": F.when(one_gap, F.when(x.isNull(), F.lit(a)).otherwise(F.lit(b))),
                "_key": F.when(one_gap, F.coalesce(x, y)),
            }
        )
        table = fills.select(F.col("name").alias("_name"), F.col("key").alias("_key"), F.col("fill").alias("_fill"))
        if is_small(fills, self.broadcast_rows):
            joined = asks.join(F.broadcast(table), ["_name", "_key"], "left")
        else:
            # Only the rows with a gap are shuffled; complete rows have no key and stay put.
            gaps = asks.where(one_gap).join(table, ["_name", "_key"], "left")
            joined = asks.where(~one_gap).unionByName(gaps, allowMissingColumns=True)
        both = x.isNull() & y.isNull()
        new = {
            c: F.coalesce(e, F.when(both, F.lit(self.means[c]).cast("double")).otherwise(F.col("_fill")))
            for c, e in ((a, x), (b, y))
        }
        return joined.withColumns(new).select(*df.columns)


def fit_neighbours(
    df: DataFrame, pair: tuple[str, str] = tuple(C.NEIGHBOUR_COLUMNS), k: int = 5, small: int = SMALL_DISTINCT
) -> NeighbourModel:
    """Learn donor values (rows with both columns, both directions in one pass) and column means."""
    a, b = pair
    both = df.select(*[F.col(c).cast("double").alias(c) for c in pair])
    means = both.agg(*[F.avg(c).alias(c) for c in pair]).first().asDict()

    def side(target: str, given: str) -> Column:
        return F.struct(F.lit(target).alias("name"), F.col(given).alias("value"), F.col(target).alias("known"))

    complete = both.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    grouped = (
        complete.select(F.explode(F.array(side(a, b), side(b, a))).alias("s"))
        .groupBy("s.name", "s.value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("s.known").alias("total"))
    )
    return NeighbourModel(tuple(pair), k, means, materialize(grouped, "donors"), small)


@dataclass(frozen=True)
class FillModel:
    """Constant per column for missing values."""

    values: dict[str, object]

    def transform(self, df: DataFrame) -> DataFrame:
        # A fractional fill widens whole numbers to double.
        known = {c: v for c, v in self.values.items() if c in df.columns and v is not None}
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()}) if known else df


def fit_medians(df: DataFrame, columns: Iterable[str] = tuple(C.MEDIAN_COLUMNS)) -> FillModel:
    """Exact medians as fill values."""
    return FillModel(medians(df, present(df, columns)))


def domain_defaults(df: DataFrame, defaults: Mapping[str, object] = C.DOMAIN_DEFAULTS) -> DataFrame:
    """Last resort values per column."""
    return FillModel(dict(defaults)).transform(df)


@dataclass(frozen=True)
class ThreatImputer:
    """Neighbours, then medians, then defaults."""

    neighbours: NeighbourModel | None
    medians: FillModel

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.neighbours.transform(df) if self.neighbours else df
        return domain_defaults(self.medians.transform(out))


def fit_imputer(df: DataFrame, k: int = 5, median_columns: Iterable[str] = tuple(C.MEDIAN_COLUMNS)) -> ThreatImputer:
    """Fit on a table. Pass no ``median_columns`` for tables without gaps there to save the pass."""
    pair = present(df, C.NEIGHBOUR_COLUMNS)
    neighbours = fit_neighbours(df, tuple(pair), k) if len(pair) == 2 else None
    return ThreatImputer(neighbours, fit_medians(df, median_columns))


def null_report(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column with nulls, from one aggregate."""
    number = set(numeric_columns(df))
    missing = lambda c: F.col(c).isNull() | (F.isnan(c) if c in number else F.lit(False))
    counts = df.agg(*[F.count_if(missing(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*").where("nulls > 0")

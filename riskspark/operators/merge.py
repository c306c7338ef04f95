"""Asset-keyed joins and integrity checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_key(df: DataFrame, key: str = "asset_id") -> None:
    """Raise unless the key column exists and is never null."""
    if key not in df.columns:
        raise ValueError(f"Required key column not found: {key}")
    if df.where(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"Null values found in key column: {key}")


def has_rows(df: DataFrame, key: str = "asset_id") -> bool:
    """Whether a table has rows, whose keys must be there: one aggregate over the key alone,
    or none for a table written with counts of that key (``materialize(..., key=)``)."""
    stats = getattr(df, "stats", None)
    if stats is not None and getattr(df, "_stats_key", None) == key:
        if stats["missing_key"]:
            raise ValueError(f"Null values found in key column: {key}")
        return stats["rows"] > 0
    if key not in df.columns:
        if df.isEmpty():
            return False
        raise ValueError(f"Required key column not found: {key}")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("missing")).first()
    if found["missing"]:
        raise ValueError(f"Null values found in key column: {key}")
    return found["n"] > 0


def merge_on_asset_id(
    tables: Iterable[DataFrame | None], how: str = "left", key: str = "asset_id", check: bool = True
) -> DataFrame | None:
    """Join tables on the key; on a name clash the earlier table's column stays.

    Empty tables and None are passed over; without any table the result is None.
    ``check=False`` skips the emptiness and key tests for tables known to be sound,
    which keeps the whole merge lazy. The join strategy is left to Spark, which
    knows the sizes at run time and splits skewed keys.
    """
    kept = [t for t in tables if t is not None]
    if check:
        kept = [t for t in kept if has_rows(t, key)]
    if not kept:
        return None
    merged = kept[0]
    for table in kept[1:]:
        clash = [c for c in table.columns if c in merged.columns and c != key]
        merged = merged.join(table.drop(*clash), key, how)
    return merged


def integrity_report(df: DataFrame, key: str = "asset_id") -> DataFrame:
    """One row: rows, columns, missing keys, repeated keys, null cells.

    Null keys count as one group, so repeated keys are rows minus groups.
    The rows are first counted per key, so the distinct count has no hot task.
    """
    cells = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    if key not in df.columns:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).cast("long").alias("columns"),
            F.lit(None).cast("long").alias("missing_key"),
            F.lit(None).cast("long").alias("duplicate_keys"),
            F.coalesce(F.sum(cells), F.lit(0)).alias("null_cells"),
        )
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(cells).alias("_cells"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return per_key.agg(
        total("_n").alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        total(F.when(F.col(key).isNull(), F.col("_n"))).alias("missing_key"),
        (total("_n") - F.count(F.lit(1))).alias("duplicate_keys"),
        total("_cells").alias("null_cells"),
    )

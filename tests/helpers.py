"""Short ways to build small tables and read them back."""

from pyspark.sql import DataFrame


def rows(df: DataFrame, *order: str) -> list[dict]:
    """All rows of a small result as dicts, sorted."""
    found = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(found, key=lambda r: tuple(str(r[c]) for c in order)) if order else found


def by(df: DataFrame, key: str) -> dict:
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

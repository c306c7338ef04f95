"""Readers and writers chosen by file suffix."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import constants as C
from riskspark.functions.columns import lenient_double, nan_to_null, present
from riskspark.sources.splitcsv import read_csv_split

# Number columns of raw threat rows that no later step reads leniently itself.
THREAT_NUMBERS = ["days_since_published", "days_since_first_seen", "days_active", "asset_exposure_score"]


def suffix_of(path: str) -> str:
    return PurePosixPath(str(path).rstrip("/")).suffix.lower()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def require_path(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}")


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """parquet, csv, json (one array per file) or jsonl.

    Prefer parquet or jsonl for large inputs: an array file is read by one task. A csv file
    with a schema is read by many tasks even where quoted cells hold line breaks (see
    ``splitcsv``); without one, types are inferred in a read of whole files. With an explicit
    schema text formats need no extra pass to infer types. NaN is read as null.
    """
    suffix = suffix_of(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if suffix == ".parquet":
        return nan_to_null(reader.parquet(path))
    if suffix == ".csv":
        if schema:
            return nan_to_null(read_csv_split(spark, path, schema))
        return nan_to_null(reader.csv(path, header=True, inferSchema=True, escape='"', multiLine=True))
    if suffix in {".json", ".jsonl"}:
        return nan_to_null(reader.json(path, multiLine=suffix == ".json"))
    raise ValueError(f"Unsupported table format: {path}")


def write_table(df: DataFrame, path: str) -> str:
    """parquet, csv or jsonl, overwriting; folders are created by the writer."""
    suffix = suffix_of(path)
    writer = df.write.mode("overwrite")
    if suffix == ".parquet":
        writer.parquet(path)
    elif suffix == ".csv":
        writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    elif suffix == ".jsonl":
        writer.json(path, ignoreNullFields=False)
    else:
        raise ValueError(f"Unsupported table format: {path}")
    return path


def save_bucketed(df: DataFrame, name: str, key: str = "asset_id", buckets: int = 64) -> DataFrame:
    """Save as a table of the session's warehouse, bucketed and sorted by ``key``.

    Tables saved with the same key and bucket count join without an exchange: each task
    reads one bucket of every side, already in key order. Choose ``buckets`` so that a
    bucket fits a task at the expected size; a hot key stays in its one bucket.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def load_threats(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Raw threat CSV. Without a schema cells are read as text, in one pass, and numbers are cast leniently."""
    require_path(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.csv(path, header=True, escape='"', multiLine=True)
    numbers = {c: lenient_double(F.col(c)) for c in present(df, THREAT_NUMBERS)}
    return df.withColumns(numbers) if numbers else df


def detect_format(path: str, fmt: str | None = None) -> str:
    """json, csv or parquet, from ``fmt`` or the suffix."""
    name = (fmt or suffix_of(path).lstrip(".")).lower()
    if name not in {"json", "csv", "parquet"}:
        raise ValueError(f"Unsupported extension '.{name}' for '{path}'. Supported formats: json, csv, parquet")
    return name


RAW_ASSET_SCHEMA = (
    "asset_id string, host string, domain string, ports string, services string, tags string, "
    "discovered_by string, internet_exposed string, last_seen string"
)


def read_assets(spark: SparkSession, path: str, fmt: str | None = None, **options: Any) -> DataFrame:
    """Raw asset rows. JSON must be an array of objects; nested values are kept as JSON text."""
    require_path(spark, path)
    name = detect_format(path, fmt)
    if name == "parquet":
        return spark.read.options(**options).parquet(path)
    if name == "csv":
        return spark.read.options(**options).csv(path, header=True, escape='"', multiLine=True)
    first = spark.read.text(path).select(F.ltrim("value").alias("line")).where("line <> ''").first()
    if first and not first["line"].startswith("["):
        raise ValueError("Expected a JSON array at the top level")
    return spark.read.options(**options).schema(RAW_ASSET_SCHEMA).json(path, multiLine=True)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Lists and structs as JSON text, for formats without nesting."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def save_assets(df: DataFrame, path: str) -> str:
    """Parquet with native nested columns, CSV with JSON text."""
    return write_table(nested_to_json(df) if suffix_of(path) == ".csv" else df, path)


def load_ml_dataset(
    spark: SparkSession, path: str, target: str = C.TARGET, source_target: str = C.SOURCE_TARGET
) -> DataFrame:
    """Model table from parquet or csv; a missing target is copied from the source target."""
    require_path(spark, path)
    if suffix_of(path) not in {".parquet", ".csv"}:
        raise ValueError(f"Unsupported dataset format: {path}")
    return with_target(read_table(spark, path), target, source_target)


def with_target(df: DataFrame, target: str = C.TARGET, source_target: str = C.SOURCE_TARGET) -> DataFrame:
    """Make sure the target column exists."""
    if target in df.columns:
        return df
    if source_target not in df.columns:
        raise ValueError(f"Neither {target!r} nor {source_target!r} exists in dataset.")
    return df.withColumn(target, F.col(source_target))


def load_yaml(path: str) -> dict[str, Any]:
    """Nested constants from a small YAML file on the driver."""
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError("Reading YAML needs the yaml package; pass a dict instead") from exc
    with open(path, encoding="utf-8") as fh:
        return yaml.safe_load(fh) or {}


def write_json_report(spark: SparkSession, report: Mapping[str, Any], path: str) -> str:
    """A small report as one JSON text file in folder ``path``."""
    text = json.dumps(report, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


PREDICTION_COLUMNS = [
    "predicted_loss", "currency", "risk_level", "confidence_score", "prediction_interval_lower",
    "prediction_interval_upper", "top_feature_1", "top_feature_2", "top_feature_3", "timestamp",
]


def order_prediction_columns(df: DataFrame, last: Iterable[str] = tuple(PREDICTION_COLUMNS)) -> DataFrame:
    """Feature columns first, the ten result columns last."""
    last = list(last)
    return df.select(*[c for c in df.columns if c not in last], *last)

"""CSV with line breaks inside quoted cells, read by many tasks instead of one per file.

A line starts a record exactly when the quotes before it in its file are even in number
(an escaped quote is two quotes, so it keeps the parity). The files are read as lines,
split as the text reader splits them, in three steps:

1. one aggregation counts the quotes of every split (file, block start): a table with a
   row per split, whose size is the number of tasks of the read;
2. from it, the parity at each split's start (a running sum over the splits of a file,
   on that small table); then each task walks its own lines in order and joins them into
   records: lines at a split's start that continue a record of the split before, and an
   open record at its end, are border pieces;
3. border pieces, two per split at most, are grouped per file and stitched in block order;
   the records they make join the others. Each record is parsed by ``from_csv``.

The first record of each file is its header and is dropped; columns come by position from
the schema. Defined results: line ends inside quoted cells come back as ``\\n`` (the text
reader drops ``\\r``); a quote inside an unquoted cell is not RFC 4180 and changes the
parity; a file whose quotes never close ends with its last record as read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import materialize

PIECES = "file string, block long, kind string, first boolean, text string"


def _quotes(line: str) -> int:
    return line.count('"')


def _walk(starts: dict[tuple[str, int], int]):
    """Per task: lines in read order become whole records and border pieces."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        key, parity, lines, head, first_of_block = None, 0, [], True, True

        def close_block():
            if key is not None and lines:
                kind = ("middle" if head else "tail") if parity else ("head" if head else "record")
                out.append((key[0], key[1], kind, first_of_block and key[1] == 0, "\n".join(lines)))

        for frame in frames:
            for value, file, block in zip(frame["value"], frame["file"], frame["block"]):
                if (file, block) != key:
                    close_block()
                    key, lines = (file, block), []
                    parity = starts[key] % 2
                    head = parity == 1
                    first_of_block = True
                if not parity and lines:
                    out.append((file, block, "head" if head else "record", first_of_block and block == 0, "\n".join(lines)))
                    lines, head, first_of_block = [], False, False
                lines.append(value)
                parity = (parity + _quotes(value)) % 2
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["file", "block", "kind", "first", "text"])
                out = []
        close_block()
        if out:
            yield pd.DataFrame(out, columns=["file", "block", "kind", "first", "text"])

    return run


def _stitch(pieces: pd.DataFrame) -> pd.DataFrame:
    """The border pieces of one file in block order: a tail and the heads after it are one record."""
    rows, open_ = [], None
    for block, kind, first, text in sorted(zip(pieces["block"], pieces["kind"], pieces["first"], pieces["text"]), key=lambda r: (r[0], r[1] != "head")):
        if kind in ("head", "middle"):  # goes on from the block before; a head also ends there
            open_ = (open_[0], open_[1] + "\n" + text) if open_ else (first, text)
            if kind == "head":
                rows.append(open_)
                open_ = None
        else:  # tail: a record that goes on in the next block
            if open_:
                rows.append(open_)
            open_ = (first, text)
    if open_:
        rows.append(open_)
    return pd.DataFrame({"first": [r[0] for r in rows], "text": [r[1] for r in rows]})


def read_csv_split(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The records of CSV files with a header, parsed by position with ``schema``; quotes escape as ``""``."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    per_block = lines.groupBy("file", "block").agg(F.sum(F.length("value") - F.length(F.regexp_replace("value", '"', ""))).alias("quotes"))
    blocks = sorted((r["file"], r["block"], r["quotes"]) for r in per_block.collect())
    starts, running, last_file = {}, 0, None
    for file, block, quotes in blocks:
        running = 0 if file != last_file else running
        starts[(file, block)] = running
        running, last_file = running + quotes, file
    walked = materialize(lines.mapInPandas(_walk(starts), PIECES), "csv-pieces")
    whole = walked.where("kind = 'record'").select("first", "text")
    border = walked.where("kind <> 'record'").groupBy("file").applyInPandas(_stitch, "first boolean, text string")
    records = whole.unionByName(border).where(~F.col("first") & (F.col("text") != ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)
    parsed = records.select(F.from_csv("text", ddl, {"escape": '"', "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")

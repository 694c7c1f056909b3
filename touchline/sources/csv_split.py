"""CSV files with quoted line breaks, read in splits.

The multi-line reader makes a file one task, because only its start tells whether a line break ends a record. Here a
file is read as lines, split as usual:

1. Every split is scanned under both assumptions, that it starts at a record and that it starts inside quotes. Its
   outcome is a pair: the state it ends in under either.
2. The pairs of a file's splits, in order, give the true state at the start of each (a row for each split).
3. The lines are read again from the true state. Records inside a split are whole; what a split holds of a record that
   began before it, or ends after it, goes on as a fragment, and the fragments of a record are joined in order.
   At most two fragments leave a split.

Records are parsed by Spark's own CSV expression. A quote opens a field only as its first character; doubled quotes
stand for one.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings whose line breaks and quotes are single bytes that occur nowhere else.
SPLITTABLE = {"utf-8", "utf8", "utf-8-sig", "us-ascii", "ascii"}
RECORDS = "file string, start long, part int, record string"
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a line that starts inside quotes, or at a record, ends inside quotes."""
    if '"' not in line:
        return inside
    at, end = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0 or at >= end:
            return False
        at += 1


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("long").alias("start"), "value")


def by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(file, start, lines) of runs of lines of one split; a split may come as several runs."""
    for batch in batches:
        files, starts, values = (c.to_pylist() for c in batch.columns)
        at = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or starts[i] != starts[at] or files[i] != files[at]:
                yield files[at], starts[at], values[at:i]
                at = i


def split_states(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """(file, start) of the splits that start inside quotes: at most a row a split."""
    schema = "file string, start long, from_record boolean, from_quotes boolean"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (False, True)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([state[0]]), pa.array([state[1]])],
                                              names=["file", "start", "from_record", "from_quotes"])

        for file, start, lines in by_split(batches):
            if key is not None and key != (file, start):
                yield out()
                state = (False, True)
            key = (file, start)
            for line in lines:
                if '"' in line:
                    state = tuple(ends_inside(line, s, sep) for s in state)
        if key is not None:
            yield out()

    def prefix(pdf: pd.DataFrame) -> pd.DataFrame:
        inside, found = False, []
        for row in pdf.sort_values("start").itertuples():
            if inside:
                found.append(row.start)
            inside = bool(row.from_quotes if inside else row.from_record)
        return pd.DataFrame({"file": pd.Series([pdf["file"].iloc[0]] * len(found), dtype=object), "start": pd.Series(found, dtype="int64")})

    return lines_of(spark, paths).mapInArrow(scan, schema).groupBy("file").applyInPandas(prefix, "file string, start long")


def records(spark: SparkSession, paths: Sequence[str], header: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """(file, start, record): every record of the files, ``start`` being that of the split it begins in. With
    ``header`` the first record of every file must have these names and is left out."""
    inside = split_states(spark, paths, sep).withColumn("inside", F.lit(True)).checkpoint(eager=True)
    # a row for each split that starts inside quotes: no more than input bytes / split bytes
    lines = lines_of(spark, paths).join(F.broadcast(inside), ["file", "start"], "left").select(
        "file", "start", F.when(F.col("inside"), F.concat(F.lit("1"), "value")).otherwise(F.concat(F.lit("0"), "value")).alias("value"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, part, held = None, False, WHOLE, []
        out: list[tuple] = []

        def emit(kind: int) -> None:
            text = "\n".join(held)
            if kind == WHOLE and key[1] == 0 and header is not None and not out_first[0]:
                out_first[0] = True
                names = next(csv.reader([text.removeprefix("﻿").removesuffix("\r")], delimiter=sep), [])
                if [n.strip().lower() for n in names] != [h.strip().lower() for h in header]:
                    raise ValueError(f"{key[0]}: header {names} differs from {list(header)}")
                return
            out.append((*key, kind, text))

        out_first = [False]

        def close() -> None:
            if held:
                emit(MIDDLE if part == HEAD else TAIL)
            held.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                                               pa.array(columns[3], pa.string())], names=["file", "start", "part", "record"])

        for file, start, lines in by_split(batches):
            if key != (file, start):
                if key is not None:
                    close()
                key, state = (file, start), lines[0][0] == "1"
                part, out_first = (HEAD if state else WHOLE), [False]
            for line in lines:
                held.append(line[1:])
                state = ends_inside(line[1:], state, sep)
                if not state:
                    emit(part)
                    held.clear()
                    part = WHOLE
            yield batch_of()
            out.clear()
        if key is not None:
            close()
            yield batch_of()

    pieces = lines.mapInArrow(assemble, RECORDS)
    whole = pieces.filter(F.col("part") == WHOLE).select("file", "start", "record")
    # fragments: a tail begins a record, middles and the next head belong to the last tail before them
    origin = F.max(F.when(F.col("part") == TAIL, F.col("start"))).over(Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0))
    split = pieces.filter(F.col("part") != WHOLE).withColumn("origin", origin)
    ordered = F.array_sort(F.collect_list(F.struct("start", "part", "record")))
    joined = split.groupBy("file", F.col("origin").alias("start")).agg(F.array_join(F.transform(ordered, lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined)


def read_records(spark: SparkSession, paths: Sequence[str], header: Sequence[str], schema: T.StructType, sep: str = ",", corrupt_col: str | None = None) -> DataFrame:
    """The columns of ``schema`` (text, in the order of ``header``) of every record."""
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE"}
    if corrupt_col:
        options["columnNameOfCorruptRecord"] = corrupt_col
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    text = F.regexp_replace("record", "\r$", "")
    rows = records(spark, paths, header, sep).select(text.alias("record")).filter(F.col("record") != "")
    return rows.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")


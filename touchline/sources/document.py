"""Report documents of any size.

A document is one JSON object with an array for each table. It is written as text fragments: every task writes its
part of the arrays, in the order of the rows, and the fragments one after the other, by file name, are the document.
No task and not the driver holds a table, and a lost task writes its fragment again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.windows import row_index


def document_lines(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(section, place, value): the lines of the document with their order. Each table comes with the columns that
    order its rows uniquely; a table's lines lie between one that opens its array and one that closes it."""
    spark = next(iter(tables.values()))[0].sparkSession
    marks, out = [], None
    for i, (name, (df, order)) in enumerate(tables.items()):
        marks += [(3 * i, 0, ("{" if i == 0 else ",") + json.dumps(name, ensure_ascii=False) + ": ["), (3 * i + 2, 0, "]" + ("}" if i + 1 == len(tables) else ""))]
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        rows = row_index(df, list(order), "_place").select(
            F.lit(3 * i + 1).alias("section"), F.col("_place").alias("place"), F.concat(F.when(F.col("_place") > 0, ",").otherwise(""), text).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out.unionByName(spark.createDataFrame(marks, "section int, place long, value string"))


def write_document(tables: dict[str, tuple[DataFrame, Sequence[str]]], path: str, partitions: int | None = None) -> None:
    """Write ``tables`` (name: rows and their order columns) as the fragments of one JSON document in ``path``."""
    if not tables:
        raise ValueError("a document needs a table")
    lines = document_lines(tables)
    count = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(count, "section", "place").sortWithinPartitions("section", "place")
    ordered.select("value").write.mode("overwrite").text(path)

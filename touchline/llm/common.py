"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage as ``checkpoint()`` does (the files outlive any executor) and stores columns
    compressed. Partition-dependent values (task ids, positions) are frozen by it, so later reads agree.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``materialise`` as a table bucketed by ``key``, so that a later join or cogroup on it shuffles only
    the other side. Its name leaves the catalog at once; the files stay."""
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("compression", "zstd")
       .option("path", f"{shared_folder(spark)}/{own}").saveAsTable(own))
    found = spark.table(own)
    found.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {own}")
    return found


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that clash with no column of ``df`` (Spark ignores case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def id_bucket(doc_id, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def blank(text):
    """Text with null read as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


#: Rows of a group that ``spread_join`` gives one task, and the number of larger groups it names in a broadcast.
GROUP_ROWS, HOT_GROUPS = 1000, 16_384


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """``rows`` with the columns of their group. ``groups`` has one row for each ``key`` and the number of its
    rows, ``size``.

    A group larger than both ``GROUP_ROWS`` and one in ``HOT_GROUPS`` of all rows is repeated, and its rows are dealt
    over the repeats by ``spread``. There are fewer than ``HOT_GROUPS`` such groups, so their names are broadcast.
    """
    limit = max(GROUP_ROWS, (groups.agg(F.sum(size)).first()[0] or 0) // HOT_GROUPS)
    parts, part = fresh(rows.join(groups.limit(0), key), "parts", "part")
    count = F.ceil(F.col(size) / limit).cast("int")
    hot = groups.filter(F.col(size) > limit).select(key, count.alias(parts))
    dealt = (rows.join(F.broadcast(hot), key, "left")
             .withColumn(part, F.coalesce(F.pmod(F.xxhash64(spread), F.col(parts)), F.lit(0)).cast("int")).drop(parts))
    repeated = groups.withColumn(part, F.explode(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)))
    return dealt.join(repeated, [key, part]).drop(part)


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level BPE vocabularies write for each byte: printable ones stand for themselves,
    the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def batches_of_texts(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of at most ``chars`` characters at a time; a longer text alone."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            if texts and held + len(text) > chars:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            held += len(text) + 1
    if texts:
        yield ids, texts

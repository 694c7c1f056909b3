"""Uploaded batches scored as they arrive.

The reference scores one uploaded CSV per request. Here a folder of uploaded CSV files is a file
stream; every micro-batch goes through the same batch operators (``score_xg_batch`` or the match
cascade) inside ``foreachBatch`` and is written to a Parquet sink. The checkpoint location records
which files were processed, so a restarted job (or a lost executor) neither skips nor repeats a file.
No state is kept across batches: each upload is scored on its own, as in the reference. Each
micro-batch lands in its own ``batch_id=N`` folder written in overwrite mode, so a replayed batch
replaces its own output instead of appending a duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.operators import scoring as SC
from touchline.sources.io import read_csv

XG_UPLOAD = T.StructType([T.StructField(c, T.StringType(), True) for c in
                          ("x", "y", "is_big_chance", "is_header", "is_penalty", "first_touch", "is_volley", "is_counter",
                           "from_corner")])
MATCH_UPLOAD = T.StructType([T.StructField(c, T.StringType(), True) for c in ("row_id", "home_team", "away_team")])


def _upload_paths(spark: SparkSession, upload_dir: str, max_files: int) -> DataFrame:
    """New uploads as a stream of (path, header line): the files themselves are read per micro-batch."""
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
                  .option("maxFilesPerTrigger", max_files).load(upload_dir))
    head = F.substring_index(F.decode(F.col("content"), "UTF-8"), "\n", 1)
    return files.select("path", F.rtrim(head).alias("header"))


def _read_uploads(batch: DataFrame, schema: T.StructType) -> DataFrame | None:
    """The rows of a micro-batch, mapped by each file's own header; other columns pass through. Files with
    the same header are read together (at most ``max_files`` paths reach the driver)."""
    out = None
    for row in batch.groupBy("header").agg(F.collect_list("path").alias("paths")).collect():
        part = read_csv(batch.sparkSession, sorted(row["paths"]), schema, keep_extra=True).withColumn("upload_file", F.input_file_name())
        absent = [c for c in schema.fieldNames() if c not in [h.strip().strip('"').lower() for h in row["header"].split(",")]]
        part = part.drop(*absent)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _start(uploads: DataFrame, score, output_dir: str, checkpoint_dir: str, available_now: bool) -> StreamingQuery:
    def run(batch: DataFrame, epoch: int) -> None:
        scored = score(batch)
        if scored is not None:
            # one folder per micro-batch, overwritten on replay: a retried batch cannot duplicate rows
            scored.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch_id={epoch}")

    writer = uploads.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_xg_scoring(spark: SparkSession, upload_dir: str, output_dir: str, checkpoint_dir: str,
                      available_now: bool = True, max_files_per_trigger: int = 100) -> StreamingQuery:
    """Score every uploaded xg CSV (columns of ``XG_UPLOAD`` by header name, any order, optional ones may be
    missing, others pass through) into ``output_dir/batch_id=N``."""
    def score(batch: DataFrame) -> DataFrame | None:
        rows = _read_uploads(batch, XG_UPLOAD)
        return None if rows is None else SC.score_xg_batch(rows)

    return _start(_upload_paths(spark, upload_dir, max_files_per_trigger), score, output_dir, checkpoint_dir, available_now)


def stream_match_scoring(spark: SparkSession, upload_dir: str, output_dir: str, checkpoint_dir: str, task: str,
                         sources: dict[str, DataFrame], league: DataFrame, available_now: bool = True,
                         max_files_per_trigger: int = 100) -> StreamingQuery:
    """Score uploaded match CSVs through the cascade; ``sources`` are static tables keyed by
    ``row_id`` (a bad id becomes null and falls through to the league average)."""
    def score(batch: DataFrame) -> DataFrame | None:
        rows = _read_uploads(batch, MATCH_UPLOAD)
        return None if rows is None else SC.score_match_batch(rows.withColumn("row_id", F.col("row_id").try_cast("long")), task, sources, league)

    return _start(_upload_paths(spark, upload_dir, max_files_per_trigger), score, output_dir, checkpoint_dir, available_now)

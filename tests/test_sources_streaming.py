"""Sources, sinks and the file-stream batch scoring."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from touchline.schemas import SchemaError
from touchline.sources import io as IO
from touchline.streaming.batch_scoring import stream_xg_scoring


def test_json_wrapped_and_bare(spark):
    d = tempfile.mkdtemp(prefix="tl-json-", dir="/tmp")
    with open(os.path.join(d, "bare.json"), "w") as f:
        json.dump([{"referee": "A", "matches": 3}], f)
    with open(os.path.join(d, "wrapped.json"), "w") as f:
        json.dump({"data": [{"referee": "B", "matches": 4}, {"referee": "C", "matches": 1}]}, f)
    from touchline.schemas import REFEREES
    bare = IO.read_json_records(spark, os.path.join(d, "bare.json"), REFEREES)
    wrapped = IO.read_json_records(spark, os.path.join(d, "wrapped.json"), REFEREES, root_key="data")
    assert [r.referee for r in bare.collect()] == ["A"]
    assert sorted(r.referee for r in wrapped.collect()) == ["B", "C"]


def test_tolerant_read_and_empty_check(spark):
    from touchline.schemas import PLAYERS
    empty = IO.read_or_empty(spark, "/tmp/does-not-exist-touchline", PLAYERS)
    assert empty.count() == 0 and empty.columns == PLAYERS.fieldNames()
    try:
        IO.require_non_empty(empty, "upload")
        raise AssertionError("expected an error")
    except SchemaError:
        pass


def test_write_table_counts_rows_and_manifest(spark):
    d = tempfile.mkdtemp(prefix="tl-out-", dir="/tmp")
    df = spark.range(0, 37).withColumn("x", F.col("id") * 2)
    n = IO.write_table(df, os.path.join(d, "t"))
    assert n == 37
    man = IO.manifest(spark, {"t": (os.path.join(d, "t"), df, n)}, ["range"])
    assert man.first().rows == 37 and man.first().columns == ["id", "x"]


def test_streaming_scores_each_upload_once(spark):
    d = tempfile.mkdtemp(prefix="tl-stream-", dir="/tmp")
    up, out, ck = (os.path.join(d, x) for x in ("up", "out", "ck"))
    os.makedirs(up)
    with open(os.path.join(up, "a.csv"), "w") as f:
        f.write("x,y,is_big_chance,is_header,is_penalty\n90,50,1,0,0\nbad,50,0,0,0\n")
    q = stream_xg_scoring(spark, up, out, ck)
    q.awaitTermination(120)
    with open(os.path.join(up, "b.csv"), "w") as f:
        f.write("x,y,is_big_chance,is_header,is_penalty\n70,30,0,1,0\n")
    q = stream_xg_scoring(spark, up, out, ck)   # restart: only the new file is scored
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert res.count() == 3
    bad = res.filter(F.col("x") == "bad").first()
    assert bad.xg_prediction == 0.0 and bad.source == "fallback"
    good = res.filter(F.col("x") == "90").first()
    assert 0.001 <= good.xg_prediction <= 0.999 and good.shot_quality_label in ("alta", "media", "baja")


def test_payload_has_no_row_limit(spark):
    from touchline.operators import ensemble as EN
    doc = EN.payload({"big": spark.range(3000), "small": spark.range(2)}).first()
    assert len(doc.big) == 3000 and len(doc.small) == 2


def test_uri_paths_and_missing_tables(spark):
    d = tempfile.mkdtemp(prefix="tl-uri-", dir="/tmp")
    spark.range(25).write.parquet(os.path.join(d, "t"))
    schema = spark.range(1).schema
    for path in (os.path.join(d, "t"), f"file://{d}/t"):
        assert IO.read_or_empty(spark, path, schema).count() == 25
    assert IO.read_or_empty(spark, f"file://{d}/none", schema).count() == 0
    assert IO.first_existing(spark, [f"file://{d}/none", f"file://{d}/t"]).endswith("/t")
    assert IO.column_cascade(spark, f"{d}/none", spark.range(3), schema).count() == 3
    assert IO.column_cascade(spark, f"{d}/none", None, schema).count() == 0


def test_csv_line_breaks_and_malformed_lines(spark):
    from pyspark.sql import types as T
    d = tempfile.mkdtemp(prefix="tl-csv-", dir="/tmp")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('Name , B\n"one\ntwo",1\nthree,4,5,6\nfour,x\n')
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("c", T.StringType())])
    rows = IO.read_csv(spark, d, schema, corrupt_col="_bad").collect()
    assert [(r.name, r.b, r.c) for r in rows if r._bad is None] == [("one\ntwo", 1, None), ("four", None, None)]
    assert [r._bad for r in rows if r._bad] == ["three,4,5,6"]


def test_stream_maps_headers_by_name(spark):
    d = tempfile.mkdtemp(prefix="tl-stream-", dir="/tmp")
    up, out, ck = (os.path.join(d, x) for x in ("up", "out", "ck"))
    os.makedirs(up)
    for name, text in (("a.csv", "y,x,is_penalty,note\n50,95,1,first\n"), ("b.csv", "x,y\n95,50\n")):
        with open(os.path.join(up, name), "w") as f:
            f.write(text)
    stream_xg_scoring(spark, up, out, ck).awaitTermination(120)
    rows = {r.note: r for r in spark.read.parquet(out).collect()}
    assert rows["first"].x == "95" and rows["first"].is_penalty == "1" and rows[None].is_penalty is None
    assert rows["first"].xg_prediction > rows[None].xg_prediction

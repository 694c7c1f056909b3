"""Report documents written by many tasks."""

import glob
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from touchline.sources.document import write_document


def joined(path):
    parts = sorted(glob.glob(f"{path}/part-*"))
    return len(parts), "".join(open(p, encoding="utf-8").read() for p in parts)


def test_fragments_of_many_tasks_are_one_document(spark):
    path = tempfile.mkdtemp(prefix="tl-doc-", dir="/tmp") + "/report"
    big = spark.range(200_000).select("id", (F.col("id") * 7 % 1000).alias("score"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit('é "q"\n')).alias("note"))
    write_document({"rows": (big.repartition(9), ["score", "id"]), "señal": (spark.createDataFrame([("H", [1, 2])], "k string, n array<int>"), ["k"]),
                    "none": (big.filter("id < 0"), ["id"])}, path, 12)
    parts, text = joined(path)
    doc = json.loads(text)
    assert parts >= 8 and list(doc) == ["rows", "señal", "none"] and doc["señal"] == [{"k": "H", "n": [1, 2]}] and doc["none"] == []
    want = sorted(range(200_000), key=lambda i: (i * 7 % 1000, i))
    assert [r["id"] for r in doc["rows"]] == want
    assert doc["rows"][0] == {"id": 0, "score": 0, "note": None} and {r["note"] for r in doc["rows"]} == {None, 'é "q"\n'}
    sizes = [len(open(p, encoding="utf-8").read()) for p in sorted(glob.glob(f"{path}/part-*"))]
    assert max(sizes) < len(text) / 4


def test_a_document_needs_a_table():
    with pytest.raises(ValueError, match="needs a table"):
        write_document({}, "/tmp/never-written")

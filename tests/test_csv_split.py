"""CSV read in splits against the multi-line reader and Python's csv module."""

import csv
import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

from touchline.sources import csv_split as C
from touchline.sources import io as IO

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("note", T.StringType())])


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(rows, ending="\n", folder=None, name="t.csv"):
    folder = folder or tempfile.mkdtemp(prefix="tl-csv-", dir="/tmp")
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=ending).writerows([["Id ", "name", "NOTE"], *rows])
    return folder


def noisy(n, seed):
    rng = random.Random(seed)
    marks = ["a", "é", '"', '""', ",", "\n", "\n\n", " ", "long text of a field", "x" * 150]
    return [[i, "".join(rng.choices(marks, k=rng.randrange(0, 6))), "".join(rng.choices(marks, k=rng.randrange(0, 9)))] for i in range(n)]


def read(spark, folder, **options):
    return sorted((r.id, r.name or "", r.note or "") for r in IO.read_csv(spark, folder, SCHEMA, **options).collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_csv_module_over_many_splits(spark, small_splits, seed):
    rows = noisy(120, seed)
    folder = write(rows)
    assert C.lines_of(spark, [folder]).rdd.getNumPartitions() > 20
    want = sorted((i, a, b) for i, a, b in rows)
    assert read(spark, folder) == want


def test_breaks_on_split_borders_and_records_longer_than_splits(spark, small_splits):
    rows = [[1, "x" * 60, 'a "quoted" word\nand a break'], [2, "y\n" * 200, "z"], [3, "", '"'], [4, '""\n""', ",,\n,"], [5, "plain", "end"]]
    folder = write(rows)
    write([[6, "other\nfile", '"\n"']], folder=folder, name="u.csv")
    want = sorted([*((i, a, b) for i, a, b in rows), (6, "other\nfile", '"\n"')])
    assert read(spark, folder) == want == read(spark, folder, split=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    assert read(spark, folder) == want


def test_windows_line_ends_quotes_inside_plain_fields_and_headers(spark, small_splits):
    folder = write([[1, "a", "b\r\nc"], [2, "d", "e"]], ending="\r\n")
    assert read(spark, folder) == [(1, "a", "b\r\nc"), (2, "d", "e")]
    with open(os.path.join(folder, "t.csv"), "w") as f:
        f.write('id,name,note\n1,5" pipe,x\n\n2,it"s,"y\n"\n')
    assert read(spark, folder) == [(1, '5" pipe', "x"), (2, 'it"s', "y\n")]
    with open(os.path.join(folder, "t2.csv"), "w") as f:
        f.write("id,note,name\n1,a,b\n")
    with pytest.raises(Exception, match="differs from"):
        read(spark, folder)


@pytest.mark.parametrize("line, inside, want", [('a,b', True, True), ('a",b', True, False), ('a"",b', True, True), ('"a', False, True), ('"a""', False, True),
                                                ('"a"', False, False), ('x"y', False, False), (',"', False, True), ('"",""', False, False), ('b","c', True, True)])
def test_state_of_a_line(line, inside, want):
    assert C.ends_inside(line, inside) is want

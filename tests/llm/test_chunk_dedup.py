"""Exact dedup by chunk recipes (op13)."""

import hashlib
import re

import pytest

from touchline.llm import chunk_dedup, common, queries

SF001 = "/root/testdata/sf0.001"
LONG = "The long text has words enough, and some more. " * 9000
TEXTS = [None, "", " ", "A b", "a B", "Ä b", "ä b", "İ", "i̇", "x" * 5000, "X" * 5000, "x" * 5001, "日本語。" * 900, "😀a" * 4000, "😀A" * 4000,
         LONG, LONG.upper(), LONG + "!", "line\nLine\r\n", "line\nline\r\n", "\x00a", "\x00A"]


def expected(rows):
    groups = {}
    for at, (key, text) in enumerate(rows):
        norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(norm, []).append((key is not None, key or 0, at))
    out = []
    for norm, own in groups.items():
        known, keep, _ = max(own)
        for has, key, _ in own:
            out.append((key if has else None, keep if known else None, len(own), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def check(out, rows):
    out = out.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out], key=str) == expected(rows)
    assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("widths", [chunk_dedup.WIDTHS, (3, 7, 128)])
def test_equals_brute_force_also_when_identifiers_collide(spark, widths):
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS[::2])] + [(None, "a b"), (None, "only null"), (None, "only null"), (3, "A b"), (3, "a b")]
    check(chunk_dedup.exact_duplicates(frame(spark, rows), widths), rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op13_chunk_recipe_dedup(spark, SF001)
    check(out, rows)
    assert dict(out.dtypes) == {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"}


def test_identifiers_that_stay_ambiguous_are_refused(spark):
    with pytest.raises(ValueError, match="2 bits"):
        chunk_dedup.exact_duplicates(frame(spark, [(i, str(i)) for i in range(9)]), (1, 2))


def test_chunks_join_to_the_text_and_survive_an_edit(spark):
    words = [w for t in spark.read.parquet(f"{SF001}/documents.parquet").filter("text is not null").limit(40).collect() for w in t.text.lower().split()]
    text = " ".join(words)
    edited = text[:2000] + "inserted here" + text[2000:]
    own, other = (r[0] for r in frame(spark, [(0, text), (1, edited)]).orderBy("doc_id").select(chunk_dedup.chunks(chunk_dedup.F.col("text"))).collect())
    assert "".join(own) == text and "".join(other) == edited and len(own) > 20
    assert len(set(own) & set(other)) >= len(own) - 15
    assert max(map(len, own)) <= chunk_dedup.MOST + 10 and own == re.findall(chunk_dedup.LETTERS_CHUNK[4:], text, re.S)


def test_store_and_recipes_restore_every_text(spark):
    docs = frame(spark, list(enumerate(TEXTS)))
    found, store = chunk_dedup.recipes(docs), chunk_dedup.chunk_store(docs)
    back = chunk_dedup.restore(found, store).join(found, "recipe_id").select("doc_id", "text").collect()
    assert {r.doc_id: r.text for r in back} == {i: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") for i, t in enumerate(TEXTS)}
    assert store.count() == store.select("id").distinct().count() == store.select("chunk").distinct().count()


def test_one_text_in_a_third_of_all_rows_is_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(common, "GROUP_ROWS", 10)
    rows = [(i, "same" if i % 3 == 0 else f"text {i}") for i in range(600)]
    check(chunk_dedup.exact_duplicates(frame(spark, rows)), rows)


def test_empty_table_clashing_columns_and_deduplicate(spark):
    assert chunk_dedup.exact_duplicates(frame(spark, [])).count() == 0
    rows = [(1, "A", 5, "x"), (2, "a", 6, "y"), (2, "a", 6, "y"), (None, "b", 7, "z"), (9, None, 8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, recipe_id string")
    check(chunk_dedup.exact_duplicates(docs), [r[:2] for r in rows])
    left = chunk_dedup.deduplicate(docs)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)

"""Best-fit packing (op2) and SimHash near-dedup (op10)."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import packing, queries, simhash_dedup

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " ", "A  b\tc\n\nd", "don't WON'T it's", "x" * 500, "Straße ΟΔΟΣ ΟΔΟΣ. é é ́a", "a,b;c!! 12,5 (x) #tag <|endoftext|>", "日本語 テスト 12３",
       "a b c\x1cd\x85e", "İstanbul ſ ǅ", "'s 'S ''re", "​‍👍🏽 ok", "word " * 3000,
       "x <|endoftext|> y", "a<|startoftext|>b, <|ENDOFTEXT|> <|endoftext|>.", "'the 's ('tis don't_x", "µ ª º ß Ÿ ÿ É!", "<|endoftext|>" * 700, "日" * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check_packing(out, texts, tokenizer, capacity=2048):
    for key, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = out[out.doc_id == key].sort_values("piece")
        assert list(own.start) == list(range(0, len(ids), capacity)) and own.length.sum() == len(ids)
        for row in own.itertuples():
            assert row.ids_crc32 == zlib.crc32(np.array(ids[row.start:row.start + row.length], "<u4").tobytes()), text
    for _, group in out.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group.offset) == [0, *np.cumsum(group.length)[:-1]] and group.length.sum() <= capacity
    return out.sequence_id.nunique(), -(-out.length.sum() // capacity)


def test_packing_equals_whole_text_encoding(spark, tokenizer):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    used, least = check_packing(queries.op2_best_fit_packing(spark, SF001).toPandas(), docs, tokenizer)
    assert used <= least * 1.02 + 1


def test_packing_odd_texts_over_many_partitions(spark, tokenizer):
    texts = list(enumerate(ODD))
    df = spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id long, text string, bin string").repartition(11)
    check_packing(packing.pack(df, PATH).toPandas(), texts, tokenizer)
    twice = packing.pack(df.unionByName(df), PATH).toPandas()
    assert len(twice) == 2 * len(packing.pack(df, PATH).toPandas())
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_residual_tree_merges_underfull_bins(spark, tokenizer):
    rows = [(i, "a " * (300 + i % 7)) for i in range(96)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    used, least = check_packing(packing.pack(df, PATH, fan_in=3).toPandas(), rows, tokenizer)
    assert used <= least + 2  # 6 documents fill a sequence; each partition alone would need its own


def test_rounds_of_the_tree_report_sequences_against_the_bound(spark, tokenizer):
    """A table sorted by length: what fits a node's long pieces lies many nodes away."""
    rows = [(i, "a " * n) for i, n in enumerate([1299] * 300 + [699] * 200 + [89] * 800)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 26), "doc_id long, text string")
    report = []
    out = packing.pack(df, PATH, fan_in=3, part_rows=40, report=report).toPandas()
    used, least = check_packing(out, rows, tokenizer)
    assert len(out) == len(rows) and used <= least * 1.02 + 1
    assert [r["round"] for r in report] == [0, 1, 2, 3] and report[-1]["going_on"] == 0
    assert sum(r["sequences"] for r in report) == used and sum(r["tokens"] for r in report) == out.length.sum()
    for r in report[:-1]:  # what a round emits is nearly full
        assert r["tokens"] >= r["sequences"] * (packing.CAPACITY - 16)
    assert all(a["going_on"] >= b["going_on"] for a, b in zip(report, report[1:]))


def test_random_words_equal_the_library(tokenizer):
    rng = np.random.default_rng(12)
    marks = list("aAbé'\"-_.0½ßÜ̈ﬁİσς<|>\u2009\t") + ["the", "LL", " ", " ", "\n", "<|endoftext|>", "日本"]
    texts = ["".join(rng.choice(marks, rng.integers(1, 30))) for _ in range(3000)]
    ids, bounds = packing.WordIds(PATH).encode(texts, 0)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0], text


def test_null_ids_and_long_ids_survive_the_tree(spark):
    rows = [(None, "a " * 600), (2 ** 62 + 1, "b " * 500), (None, None), (-5, "c " * 1500)] * 3
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), PATH, fan_in=2)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(k) for k, _ in rows)


def test_every_underfull_bin_is_merged(spark, tokenizer):
    long, short = "a " * 1099, "a " * 899  # 1,100 and 900 tokens with the end id, sorted by length
    rows = [(i, long if i < 2500 else short) for i in range(5000)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    assert df.rdd.getNumPartitions() == 2
    out = packing.pack(df, PATH).toPandas()
    assert len(out) == 5000 and sorted(set(out.length)) == [900, 1100]
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() == 2500  # one of each a sequence


def test_best_fit_of_counts_equals_best_fit():
    rng = np.random.default_rng(8)
    for high in (40, 300, 2049):
        lengths = rng.integers(1, high, 3000)
        sizes, numbers = np.unique(lengths, return_counts=True)
        plan = packing.best_fit_counts(dict(zip(sizes.tolist(), numbers.tolist())), 2048)
        spans = {}  # every item of every length once, next to each other from offset 0 on
        for i, (size, rank, first, per_bin, offset) in enumerate(plan):
            end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == size else numbers[sizes == size][0]
            for k in range(end - rank):
                spans.setdefault(first + k // per_bin, []).append((offset + k % per_bin * size, size))
        assert sorted(n for own in spans.values() for _, n in own) == sorted(lengths)
        for own in spans.values():
            own.sort()
            assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(own[-1]) <= 2048
        assert len(spans) == len({b for b, _ in packing.best_fit(lengths.tolist(), 2048)})
    assert packing.best_fit_counts({}, 2048) == []


def test_best_fit_never_overfills():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 2049, 500).tolist()
    placed = packing.best_fit(lengths, 2048)
    totals = np.bincount([b for b, _ in placed], weights=lengths)
    assert totals.max() <= 2048 and len(totals) <= 1.1 * sum(lengths) / 2048 + 1
    assert packing.best_fit([], 2048) == []


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(fps, ids, distance=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        least[find(i)] = min(key, least.get(find(i), key))
    return [least[find(i)] for i in range(len(fps))]


def test_near_dedup_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    out = queries.op10_simhash_near_dedup(spark, SF001).toPandas().set_index("doc_id").loc[[d.doc_id for d in docs]]
    fps = [naive_fingerprint(d.text) for d in docs]
    assert list(out.fingerprint) == [f"{f:016x}" for f in fps]
    assert list(out.component_id) == naive_components(fps, [d.doc_id for d in docs])


def test_trie_links_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = list(centres)
    for c in centres[:30]:  # chains and dense groups
        for _ in range(12):
            c = c ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 5))))
            fps.append(c)
    fps = np.unique(np.array(fps + [0, 1, (1 << 64) - 1], dtype=np.uint64))
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in simhash_dedup.components(simhash_dedup.link_fingerprints(df)).collect()}
    got = [roots.get(int(v), int(v)) for v in fps.view(np.int64)]
    assert got == naive_components([int(v) for v in fps], [int(v) for v in fps.view(np.int64)])


def test_near_dedup_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, " \t"), (7, "a b c"), (7, "a b c"), (8, "A B C"), (None, "x y z w v"), (None, "x y z w v"), (9, "other words here now"), (4, "q " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    out = {(r.doc_id, r.component_id) for r in simhash_dedup.near_duplicates(df).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (None, None), (9, 9), (4, 4)}
    kept = simhash_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, 7, 9, None]
    assert simhash_dedup.deduplicate(df.limit(0)).count() == 0

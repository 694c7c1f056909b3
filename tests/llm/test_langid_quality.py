"""Language ID (op7) and the quality classifier (op1)."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from touchline.llm import langid, quality, queries

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def naive_grams(text):
    words = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split()
    spaced = " " + "".join(w + " " for w in words)
    grams = Counter(spaced[i:i + n] for n in (2, 3) for i in range(len(spaced) - n + 1)) if words else Counter()
    grams.update(c for w in words for c in w)
    return grams


def test_ngrams_equal_a_plain_count(monkeypatch):
    text = "Über die Straße, l'été — ДОМ 12 x.\n日本"
    want = naive_grams(text)
    for part in (1 << 20, 5):
        monkeypatch.setattr(langid, "PART", part)
        codes, counts = langid.ngram_counts(text)
        got = {}
        for code, n in zip(codes.tolist(), counts.tolist()):
            points = []
            while code:
                points.append(chr(code & 0x1FFFFF))
                code >>= 21
            got["".join(reversed(points))] = n
        assert got == dict(want)


def test_language_of_held_out_documents(spark):
    out = queries.op7_rank_order_language_id(spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in both.doc_id]).all()
    assert (both[both.held_out].lang == both[both.held_out].lang_pred).mean() > 0.98


def test_out_of_place_distance_by_hand():
    ranks = langid.Ranks({"aa": langid.top(*langid.ngram_counts("a"), 300).tolist()}, 300)
    assert ranks.predict("a") == ("aa", 1.0)
    lang, score = ranks.predict("b")
    own = len(langid.ngram_counts("b")[0])
    assert lang == "aa" and score == 0.0 and own == 4


def test_language_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", "de"), (4, "the cat and the dog", "en"), (5, "der hund und die katze", "de"), (6, "the cat", None), (4, "the cat and the dog", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_lang_pred", F.lit(0))
    found = langid.profiles(df)
    out = {r.doc_id: r for r in langid.with_language(df, found).collect()}
    assert [out[i].lang_pred for i in range(1, 7)] == ["und", "und", "und", "en", "de", "en"]
    kept = langid.keep_languages(df, found)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 5, 6]
    assert langid.keep_languages(df, found, accepted=["de"]).count() == 1
    assert langid.profiles(df.limit(0)) == {} and langid.with_language(df, {}).filter("lang_pred = 'und'").count() == 7


def test_quality_of_held_out_documents(spark):
    out = queries.op1_ftrl_quality(spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id").toPandas()
    assert sorted(out.doc_id) == sorted(docs.doc_id) and out.score.between(0, 1).all()
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()
    assert (out.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in out.doc_id]).all()
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    held = out[out.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert np.mean(good[:, None] > bad[None, :]) > 0.95


def test_features_do_not_depend_on_the_part_size(monkeypatch):
    text = "Aa bb, bb, THE!! ### 12 " * 40
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PART", 7)
    parts = quality.features(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])
    at, x = quality.features("")
    assert list(at) == [0] and list(x) == [1.0]
    assert np.isclose(np.square(quality.features("one two")[1][1:]).sum(), 1.0)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "||| ### |||", "c") for i in range(40)] + [(None, None, "c"), (40, "", "c"), (41, "w " * 200_000, "c")],
                                 "doc_id long, text string, _quality string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(0, None), (1, 1), (None, 1), (99, 0)], "doc_id long, quality long")
    weights = quality.train(quality.labelled_documents(docs, labels))
    scores = {r.doc_id: r.score for r in quality.with_score(docs, weights).collect()}
    assert min(scores[i] for i in range(1, 40, 2)) > max(scores[i] for i in range(0, 40, 2))
    kept = quality.keep_good(docs, weights, 0.5)
    assert kept.columns == docs.columns and {1, 3, 5} <= {r.doc_id for r in kept.collect()}
    assert quality.train(quality.labelled_documents(docs, labels.limit(0))) is None
    assert quality.keep_good(docs, None).count() == docs.count() and {r.score for r in quality.with_score(docs, None).collect()} == {0.5}


def test_the_whole_of_a_text_without_white_space_counts():
    rng = np.random.default_rng(8)
    text = "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 900, 16_000))
    changed = text[:8_000] + "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 900, 8_000))
    own, other = (dict(zip(*map(np.ndarray.tolist, quality.features(t)))) for t in (text, changed))
    assert len(own) > 500 and len(set(own) & set(other)) > 250 and len(set(own) ^ set(other)) > 250
    weights = rng.normal(size=1 << quality.BITS)
    score = [sum(weights[b] * v for b, v in f.items()) for f in (own, other)]
    assert score[0] != score[1] and quality.pieces("a " + "b" * 130) == ["a", "b" * 64, "b" * 64, "bb"] and quality.pieces("") == []

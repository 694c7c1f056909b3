"""The corpus pipeline: every stage against a plain version of its own, on the stage's own input."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import langid, quality
from touchline.llm.common import id_bucket, materialise

from test_packing_dedup import check_packing, naive_components, naive_fingerprint

SF001 = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "language id", "simhash near-dedup", "best-fit packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("score", F.lit("clash"))
    good = materialise(stages["quality classifier"](spark, docs, SF001), "t")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").filter(id_bucket(F.col("doc_id"), 4) != 2)
    weights = quality.train(quality.labelled_documents(docs.select("doc_id", "text"), labels))
    want = {r.doc_id for r in docs.collect() if quality.sigmoid(float(weights[quality.features(r.text)[0]] @ quality.features(r.text)[1])) >= 0.7}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == want

    known = materialise(stages["language id"](spark, good, SF001), "t")
    ranks = langid.Ranks(langid.profiles(good.filter(id_bucket(F.col("doc_id"), 3) != 1).select("text", "lang")), langid.SIZE)
    told = {r.doc_id: ranks.predict(r.text) for r in good.collect()}
    assert known.columns == docs.columns
    assert {r.doc_id for r in known.collect()} == {d for d, (lang, score) in told.items() if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}

    single = materialise(stages["simhash near-dedup"](spark, known, SF001), "t")
    rows = sorted((r.doc_id, r.text) for r in known.collect())
    groups = naive_components([naive_fingerprint(t) for _, t in rows], [d for d, _ in rows])
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(set(groups))

    packed = stages["best-fit packing"](spark, single, SF001).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_packing(packed, [(r.doc_id, r.text) for r in single.collect()], tokenizer)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF001).count() == 0

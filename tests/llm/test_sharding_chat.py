"""Sharding (op6) and chat formatting (op5)."""

import hashlib

from pyspark.sql import functions as F

from touchline.llm import chat, queries, sharding

SF001 = "/root/testdata/sf0.001"


def test_shards_are_contiguous_balanced_and_gapless(spark):
    out = queries.op6_byte_prefix_sharding(spark, SF001).toPandas()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()
    assert sorted(out.doc_id) == sorted(docs.doc_id)
    sizes = {d: len((t or "").encode()) + 1 for d, t in zip(docs.doc_id, docs.text)}
    assert all(sizes[d] == s for d, s in zip(out.doc_id, out["size"]))
    per, target = out.groupby("shard")["size"].sum(), out["size"].sum() / 16
    assert set(per.index) <= set(range(16)) and (abs(per - target) <= max(sizes.values()) + 0.01 * target).all()
    for _, group in out.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))


def test_shards_of_nulls_ties_clashes_and_nothing(spark):
    rows = [(i % 2 or None, None if i % 5 == 0 else 3, i // 4, "x") for i in range(40)]
    df = spark.createDataFrame(rows, "shard long, size long, ord long, slot string")
    out = sharding.balanced_shards(df, "size", ["ord"], shards=4)
    assert out.columns == ["shard", "size", "ord", "slot", "shard_", "slot_"]
    pdf = out.toPandas()
    assert len(pdf) == 40 and pdf.groupby("shard_")["size"].sum().sub(24).abs().max() <= 3
    by_order = pdf.groupby("ord")["shard_"].agg(["min", "max"])
    assert (by_order["max"].shift(fill_value=0) <= by_order["min"]).all()
    assert sharding.balanced_shards(df.limit(0), "size", ["ord"], shards=4).count() == 0


def test_equal_groups_stay_whole_when_that_is_near(spark):
    df = spark.range(10_000).select(F.col("id"), F.lit(1).cast("long").alias("size"), (F.col("id") / 3).cast("long").alias("grp"))
    out = sharding.balanced_shards(df, "size", ["grp", "id"], shards=8, group="grp")
    assert out.groupBy("grp").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


LOG = "conv_id long, turn long, msg long, seq long, kind string, role string, text string"


def folded(spark, rows):
    found = chat.reconstruct(spark.createDataFrame(rows, LOG)).collect()
    return sorted((r.conv_id, r.turn, r.role, r.text) for r in found)


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, 0, "message", "user", "hi"), (1, 1, 1, 2, "delta", "assistant", "wor"), (1, 1, 1, 1, "delta", "assistant", "he"),
        (1, 1, 1, 3, "regenerate", None, None), (1, 1, 1, 4, "delta", "assistant", "new "), (1, 1, 1, 5, "delta", None, "text"),
        (1, 2, 2, 6, "message", "user", "old branch"), (1, 0, 0, 7, "edit", "user", "hello"), (1, 1, 3, 8, "delta", "assistant", "again"),
        (2, 0, 4, 9, None, None, None)]
    assert folded(spark, rows) == [(1, 0, "user", "hello"), (1, 1, "assistant", "again"), (2, 0, "", "")]
    assert folded(spark, rows[:6]) == [(1, 0, "user", "hi"), (1, 1, "assistant", "new text")]
    assert folded(spark, []) == []


def test_escape_is_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|>", "<~|", "<~~|end|>", "<", "[", "<~", "[~/INST]<s><~s>", "", "plain ~ text", "<|" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    rows = df.withColumn("back", chat.unescape(F.col("e"))).collect()
    assert all(r.t == r.back for r in rows)
    assert not any(mark in r.e for r in rows for mark in ("<|", "</s>", "[INST]", "[/INST]"))


def test_read_back_equals_the_turns(spark):
    rows = [(1, 1, "assistant", "b <|end|> é"), (1, 0, "user", "<|turn|>a"), (1, 1, "assistant", "b <|end|> é"), (2, None, None, None),
            (None, 3, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.reconstruct(chat.events_from_turns(turns)))).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", "<|turn|>a"), ("assistant", "b <|end|> é"), ("assistant", "b <|end|> é")]
    assert back[1].loss_text == "b <|end|> é" * 2 and back[2].loss_text == "" and back[None].n_turns == 1
    assert all(sum(m.head + m.loss + m.tail for m in r.loss_mask) == len(r.formatted) for r in back.values())


def test_query_has_the_probe_conversation(spark):
    row = queries.op5_chat_formatting(spark, SF001).filter("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()

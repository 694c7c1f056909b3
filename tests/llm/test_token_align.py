"""Cross-tokenizer alignment (op12) against whole texts and a plain loop over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from touchline.llm import common, queries, token_align

SF001 = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "   ", "a", "a  b", "a   b\n\n  c", "\n \n", "\n\t \n b", " lead", "trail ", "trail\n", "tab\t and  nbsp 　wide", "don't we'll 'S",
       "x <|endoftext|> y", "<s> </s> <unk> <0x41>", "a▁b", "▁", "日本語 テスト。", "👍🏽 é 🇩🇪 ‍", "x" * 3000, "ü" * 700, "12 3.5%%% &&&", "\x00 \x1c \x85 end", "a b c",
       "word " * 2000 + "end"]


@pytest.fixture(scope="module")
def whole():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = common.byte_alphabet()

    def encode(text):
        if not text:
            return [], []
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b.id_to_piece, b_ids)]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return [], []
        return list(zip(a_ids, a_bytes)), list(zip(b_ids, b_bytes))

    return encode


def spans(tokens):
    at, out = 0, []
    for number, data in tokens:
        out.append((number, at, at + len(data)))
        at += len(data)
    return out


def plain(texts, encode):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text by comparing spans."""
    found, links = [], Counter()
    for text in texts:
        a, b = (spans(t) for t in encode(text))
        own = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else list(overlaps(a, b))
        links.update(own)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [[",".join(str(n) for n, _, e in side if low < e <= high) for side in (a, b)] for low, high in zip([0, *cuts], cuts)] if len(a) < 400 else listed(a, b, cuts)
        text = ";".join("|".join(g) for g in groups)
        found.append((len(a), len(b), len(cuts), own, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, n_groups, len(own), sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own), digest) for n_a, n_b, n_groups, own, digest in found]


def overlaps(a, b):
    """As the comparison of all spans, for long texts."""
    i = 0
    for number, start, end in a:
        while b[i][2] <= start:
            i += 1
        k = i
        while k < len(b) and b[k][1] < end:
            yield number, b[k][0]
            k += 1


def listed(a, b, cuts):
    sides = []
    for side in (a, b):
        bound = np.searchsorted(np.array(cuts), [e for _, _, e in side])
        groups = [[] for _ in cuts]
        for (number, _, _), g in zip(side, bound):
            groups[g].append(str(number))
        sides.append([",".join(g) for g in groups])
    return list(zip(*sides))


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def test_equals_a_plain_loop(spark, whole):
    rng = random.Random(4)
    marks = [" ", "  ", "\n", "\t", " ", "ab", "the", "é", "日本", ".", "<s>", "▁", "0"]
    texts = ODD + ["".join(rng.choices(marks, weights=[6] + [1] * 10 + [0.05, 1], k=rng.randrange(1, 60))) for _ in range(400)] + ODD
    want = plain(texts, whole)
    for batch, block in ((2_000_000, 4_000_000), (300, 50)):
        out = token_align.digests(frame(spark, texts), A, B, batch, block).orderBy("doc_id").collect()
        assert [tuple(r[c] for c in COLUMNS) for r in out] == want and [r.doc_id for r in out] == list(range(len(texts)))


def test_query_equals_a_plain_loop(spark, whole):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    out = queries.op12_lockstep_alignment(spark, SF001)
    assert out.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in COLUMNS[:-1]), ("groups_sha256", "string")]
    assert [(r.doc_id, *(r[c] for c in COLUMNS)) for r in out.orderBy("doc_id").collect()] == [
        (d.doc_id, *w) for d, w in zip(docs, plain([d.text for d in docs], whole))]


def test_alignments_give_tokens_groups_and_links(spark, whole):
    out = token_align.alignments(frame(spark, ODD), A, B).orderBy("doc_id").collect()
    for row, text in zip(out, ODD):
        a, b = whole(text)
        assert (row.a_ids, row.b_ids) == ([n for n, _ in a], [n for n, _ in b])
        a, b = spans(a), spans(b)
        if len(a) < 400:
            assert [tuple(x) for x in row.links] == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        assert row.a_groups == list(np.searchsorted(ends, [e for _, _, e in a])) and row.b_groups == list(np.searchsorted(ends, [e for _, _, e in b]))


def test_lanes_of_one_long_text_and_cache_renewal(spark, whole, monkeypatch):
    tokens = token_align.WordTokens(A, B)
    words = " ".join(f"w{i % 977}x{i % 31}" for i in range(5000))
    monkeypatch.setattr(token_align, "CACHE_WORDS", 50)
    results = []
    for lane in (1, 7, 10 ** 6):
        monkeypatch.setattr(token_align, "LANE_WORDS", lane)
        found = token_align.Aligned(tokens, ["", words, "a b"])
        results.append((found.listed()[0].tobytes(), found.pairs().tolist(), found.of_links.tolist()))
    assert results[0] == results[1] == results[2] and len(tokens.exact) < 6000


def test_empty_table_null_ids_repeats_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.digests(empty, A, B).count() == 0 and token_align.alignments(empty, A, B).count() == 0
    rows = [(None, "one two", 1, "x"), (5, "one two", 2, "y"), (5, "one two", 2, "y"), (6, None, 3, None)]
    out = token_align.digests(spark.createDataFrame(rows, "doc_id long, text string, block long, pairs string"), A, B).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_a) for r in out) == [(False, 5, 2), (False, 5, 2), (False, 6, 0), (True, 0, 2)]
    assert {r.count_sum for r in out} == {0, 6}

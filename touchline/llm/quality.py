"""Quality classifier: hashed word n-gram logistic regression trained with follow-the-regularised-leader
updates, scored as sparse dot products.

Features of a text: its white-space separated words give word unigrams and bigrams, and their shapes
(letters, digits and capitals collapsed to runs, other marks kept) give unigrams to trigrams; a word that
repeats the one before it is marked as such. All are hashed to ``2 ** BITS`` buckets; a feature's value is the
square root of its count, and a text's vector has length one, so long and short texts score alike. Words are
invented freely in noisy corpora; shapes carry what single words cannot.

Training: a bounded sample of labelled rows (``max_rows``, by hash of the id) lies in ``shards`` groups. In
every round each shard makes one pass of FTRL-proximal updates from the shared state, over each text and, for
label 1, a window of a few of its words; the states are averaged by coordinate over the shards that touched it. The model has at most ``2 ** BITS`` weights.

Scoring reads every whole text in one pass without a shuffle.

Defined results: null and empty texts have only the bias; a document labelled several times counts by its
mean label, 0.5 and above as 1; null labels are ignored; without any usable label the model is None
and every score 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import blank, fresh, materialise

BITS = 18
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 1e-3
THRESHOLD = 0.7
#: Most words of the short extra example that each training row gives.
WINDOW = 8
#: Characters of a word that are hashed as one.
LONGEST = 64
#: Words kept per worker; a full cache starts anew. Words of a text that are hashed at once.
CACHE_WORDS, PART = 400_000, 1 << 17
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SAME = np.uint64(0x27D4EB2F165667C5)


def shape(word: str) -> str:
    out: list[str] = []
    for ch in word:
        kind = ("A" if ch.isupper() else "a") if ch.isalpha() else "0" if ch.isdigit() else ch
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def pieces(text: str) -> list[str]:
    """The words of a text; a longer one than ``LONGEST`` (a text without white space is one word) as consecutive
    pieces, all of which count."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [word[at:at + LONGEST] for word in words for at in range(0, len(word), LONGEST)]


class Words(dict):
    """Word -> row of its hashes (word, shape)."""

    def __init__(self):
        super().__init__()
        self.hashes = np.empty((1 << 12, 2), dtype=np.uint64)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        self.hashes[row] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")), xxhash.xxh64_intdigest(shape(word).encode("utf-8", "surrogatepass"), 1)
        self[word] = row
        return row

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return self.hashes[rows]


_words = Words()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a whole text, bucket 0 being the bias."""
    words = pieces(text)
    buckets, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for at in range(0, len(words), PART):
        hashes = _words.of(words[at:at + PART + 2])
        own = min(PART, len(words) - at)
        word, form = hashes[:, 0].copy(), hashes[:, 1]
        repeat = np.concatenate([[False], word[1:] == word[:-1]])
        with np.errstate(over="ignore"):
            pair = (word[:-1] * MIX[0]) ^ (word[1:] * MIX[1])
            pair[repeat[1:]] = SAME
            forms = (form[:-1] * MIX[1]) ^ (form[1:] * MIX[2])
            three = (forms[:-1] * MIX[0]) ^ (form[2:] * MIX[1])
            codes = np.concatenate([word[:own], form[:own], pair[:own], forms[:own], three[:own]]) * MIX[2]
        found, n = np.unique((codes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
        if len(buckets):
            found, back = np.unique(np.concatenate([buckets, found]), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([counts, n])).astype(np.int64)
        buckets, counts = found, n
    values = np.sqrt(counts)
    if len(values):
        values /= np.sqrt(counts.sum())
    return np.concatenate([[0], buckets[buckets > 0]]), np.concatenate([[1.0], values[buckets > 0]])


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights in closed form."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def window(text: str, pick: int) -> str:
    """A few words in a row from the text: short texts are rare in a sample, so each row with label 1 also
    trains one (a few words of a bad text need not be bad)."""
    words = text.split()
    start = pick % max(len(words), 1)
    return " ".join(words[start:start + 1 + (pick >> 40) % WINDOW])


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def train(labelled: DataFrame, rounds: int = 4, max_rows: int = 16_000, shards: int = 8) -> np.ndarray | None:
    """Weights learned from ``labelled`` (doc_id, text, label 0 or 1), or None if it has no row."""
    rows = (labelled.filter("label IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
            .select(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).alias("shard"), "doc_id", blank(F.col("text")).alias("text"), F.col("label").cast("double")))
    sample = materialise(rows, "labelled")
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    context = labelled.sparkSession.sparkContext
    for turn in range(rounds):
        state = context.broadcast((z, n))

        def one_pass(pdf: pd.DataFrame) -> pd.DataFrame:
            z, n = (a.copy() for a in state.value)
            touched = np.zeros(len(z), dtype=bool)
            order = pdf["doc_id"].map(lambda d: xxhash.xxh64_intdigest(f"{turn}:{d}")).argsort(kind="stable")
            for doc_id, text, label in zip(pdf["doc_id"].iloc[order], pdf["text"].iloc[order], pdf["label"].iloc[order]):
                short = [window(text, xxhash.xxh64_intdigest(f"{doc_id}/{turn}"))] if label else []
                for example in (text, *short):
                    at, x = features(example)
                    w = weights_of(z[at], n[at])
                    g = (sigmoid(w @ x) - label) * x
                    z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
                    n[at] += g * g
                    touched[at] = True
            return pd.DataFrame({"touched": [np.packbits(touched).tobytes()], "z": [z[touched].tobytes()], "n": [n[touched].tobytes()]})

        # a row per shard, each of at most 2 ** BITS coordinates
        moved = sample.groupBy("shard").applyInPandas(one_pass, "touched binary, z binary, n binary").collect()
        if not moved:
            return None
        count, sums = np.zeros(1 << BITS), [np.zeros(1 << BITS), np.zeros(1 << BITS)]
        for row in moved:
            touched = np.unpackbits(np.frombuffer(row["touched"], dtype=np.uint8)).astype(bool)
            count += touched
            for total, name in zip(sums, ("z", "n")):
                total[touched] += np.frombuffer(row[name])
        seen = count > 0
        z, n = (np.where(seen, total / np.maximum(count, 1), old) for total, old in zip(sums, (z, n)))
        state.unpersist()
    return weights_of(z, n)


def labelled_documents(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents, picked by hash of the id; the picked
    ids are bounded, so the documents are filtered where they are read."""
    picked = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
              .agg((F.avg("quality") >= 0.5).cast("double").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    return docs.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")


def with_score(docs: DataFrame, weights: np.ndarray | None, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus the probability of label 1."""
    kept = [docs.columns.index(c) for c in (docs.columns if keep is None else keep)]
    schema = T.StructType([docs.schema.fields[i] for i in kept] + [T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(None if weights is None else weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            scores = []
            for value in batch.column(batch.schema.get_field_index(text)):
                if weights is None:
                    scores.append(0.5)
                else:
                    at, x = features(value.as_py() or "")
                    scores.append(sigmoid(weights[at].astype(np.float64) @ x))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``; without a model nothing is rejected."""
    if weights is None:
        return docs
    name, = fresh(docs, "_quality")
    return with_score(docs, weights, out=name).filter(F.col(name) >= threshold).drop(name)

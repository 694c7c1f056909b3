"""SimHash document fingerprints: weighted term hashes vote on signed bits; permuted block tables find all
fingerprints within a chosen Hamming radius.

Terms are three-word sequences of the lower-cased text (fewer words: the whole sequence), weighted by
1 + ln(count). Every term's 128 hash bits vote plus or minus its weight; a bit of the fingerprint is 1 where the
votes are positive. The likeness of two fingerprints is the cosine that their differing bits imply, at least 0.

Search: fingerprints are cut into ``radius + 1`` blocks. Two within the radius agree on one block at least,
so a table per block, keyed by that block, holds every pair; a pair counts in the first table that has it.
Only distinct fingerprints meet, queries against all.

The next document in id order comes from one range partitioning: each task streams its sorted rows, and one
boundary row per task carries its first text on to the task before.

Defined results: null texts are empty; a text without a word has fingerprint 0; documents with equal ids
are ordered by text, null ids first; a single document is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import blank, materialise

BITS = 128
TERM = 3
#: Words kept per worker; a full cache starts anew. Words that are hashed, and terms that vote, at once.
CACHE_WORDS, PART, VOTE = 400_000, 1 << 19, 1 << 13
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_words = Words()


def spread(x: np.ndarray, by: np.uint64) -> np.ndarray:
    """A well-mixed 64-bit value of each term hash."""
    x = (x ^ (x >> np.uint64(31))) * by
    x = (x ^ (x >> np.uint64(29))) * MIX[3]
    return x ^ (x >> np.uint64(32))


def fingerprint(text: str) -> bytes:
    """``BITS`` bits of a whole text."""
    words = text.lower().split()
    if not words:
        return bytes(BITS // 8)
    votes = np.zeros(BITS)
    with np.errstate(over="ignore"):
        terms, counts = None, None
        size = min(TERM, len(words))
        for at in range(0, len(words) - size + 1, PART):
            part = words[at:at + PART + size - 1]
            hashes = np.fromiter(map(_words.__getitem__, part), dtype=np.uint64, count=len(part))
            code = np.zeros(len(part) - size + 1, dtype=np.uint64)
            for k in range(size):
                code = (code ^ hashes[k:k + len(code)]) * MIX[0]
                code ^= code >> np.uint64(30)
            found, n = np.unique(code, return_counts=True)
            if terms is not None:
                found, back = np.unique(np.concatenate([terms, found]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([counts, n])).astype(np.int64)
            terms, counts = found, n
        weights = 1.0 + np.log(counts)
        for at in range(0, len(terms), VOTE):
            some = terms[at:at + VOTE]
            bits = np.unpackbits(np.stack([spread(some, m) for m in MIX[1:1 + BITS // 64]], axis=1).view(np.uint8), axis=1)
            votes += 2.0 * (weights[at:at + VOTE].astype(np.float32) @ bits.astype(np.float32)) - weights[at:at + VOTE].sum()
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Cosine of the angle that the differing bits stand for, 0 if it is obtuse."""
    apart = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return 1.0 if not apart else max(0.0, float(np.cos(np.pi * apart / BITS)))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def described(doc_id, text: str, own: bytes, following: str, next_print: bytes) -> tuple:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), changed_print.hex(),
            likeness(own, changed_print), likeness(own, next_print))


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """``RESULT`` for every row of ``docs`` (doc_id, text) in ascending doc_id order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank(F.col("text")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    edge = pa.struct([pa.field("doc_id", pa.int64()), pa.field("text", pa.string())])
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}

    def batch_of(found: list[tuple], task: int | None, first=None, last=None) -> pa.RecordBatch:
        columns = [pa.array(list(c), kinds[k.split()[1]]) for c, k in zip(zip(*found), RESULT.split(", "))] if found else [
            pa.nulls(1, kinds[k.split()[1]]) for k in RESULT.split(", ")]
        n = len(found) or 1
        columns += [pa.array([task] * n, pa.int64()), pa.array([first] * n, edge), pa.array([last] * n, edge)]
        return pa.RecordBatch.from_arrays(columns, names=[*NAMES, "task", "head", "tail"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = None, None
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py()
                own = fingerprint(text)
                if held is None:
                    first = {"doc_id": doc_id, "text": text}
                else:
                    found.append(described(*held, text, own))
                held = (doc_id, text, own)
            if found:
                yield batch_of(found, None)
        if held is not None:
            yield batch_of([], TaskContext.get().partitionId(), first, {"doc_id": held[0], "text": held[1]})

    streamed = materialise(ordered.mapInArrow(run, RESULT + ", task long, head struct<doc_id:long,text:string>, tail struct<doc_id:long,text:string>"), "prints")
    edges = streamed.filter("task IS NOT NULL")
    turn = edges.select("task").withColumn("next_task", F.lead("task").over(Window.orderBy("task")))  # a row per task
    turn = turn.crossJoin(F.broadcast(edges.agg(F.min("task").alias("lowest")))).select("task", F.coalesce("next_task", "lowest").alias("next_task"))
    pairs = (edges.select("task", "tail").join(turn, "task")
             .join(edges.select(F.col("task").alias("next_task"), "head"), "next_task").select("tail", "head"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [described(t["doc_id"], t["text"], fingerprint(t["text"]), h["text"], fingerprint(h["text"]))
                     for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            if found:
                yield pa.RecordBatch.from_arrays(batch_of(found, None).columns[:len(NAMES)], names=NAMES)

    return streamed.filter("task IS NULL").select(*NAMES).unionByName(pairs.mapInArrow(close, RESULT))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """(query, found, apart): all distinct fingerprints (hex, column ``fingerprint``) of ``prints`` within
    ``radius`` bits of a distinct fingerprint of ``queries``, itself included."""
    tables = radius + 1
    step = -(-BITS // 4 // tables)  # hex digits of a block

    def keyed(df: DataFrame, name: str) -> DataFrame:
        blocks = F.array(*[F.struct(F.lit(t).alias("tab"), F.substring("fingerprint", t * step + 1, step).alias("key")) for t in range(tables)])
        return df.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.explode(blocks).alias("b")).select(name, "b.tab", "b.key")

    pairs = keyed(queries, "query").join(keyed(prints, "found"), ["tab", "key"])
    words = [F.bit_count(F.conv(F.substring("query", at, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("found", at, 8), 16, 10).cast("long")))
             for at in range(1, BITS // 4 + 1, 8)]
    apart = sum(words[1:], words[0])
    earlier = [(F.lit(t) < F.col("tab")) & (F.substring("query", t * step + 1, step) == F.substring("found", t * step + 1, step)) for t in range(tables)]
    seen = earlier[0]
    for e in earlier[1:]:
        seen = seen | e
    return pairs.filter(~seen).withColumn("apart", apart).filter(F.col("apart") <= radius).select("query", "found", "apart")

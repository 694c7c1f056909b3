"""Byte-level BPE encoding and decoding over globally distinct words.

1. Every text is split into pre-tokens. The rows of a task form blocks; a block holds its distinct words, and
   its documents as word numbers in text order (the positions), so that the explode yields one row per
   (word, block) instead of one per occurrence. Blocks are written once, as a table bucketed by block.
2. (word, block, number) rows are shuffled by word and sorted; each distinct word of the whole corpus is
   encoded once, and its ids go back to its blocks, packed per task and block.
3. Each block meets its words' ids in a join whose block side needs no shuffle (it is bucketed), and
   reassembles its documents by position. Decoding joins the ids of a document with the table of token bytes,
   which is bounded by the vocabulary.

A block holds at most ``block_chars`` characters of text (a longer single text is a block of its own), so no
task holds more than a block. A word that occurs in every block (a hot key) gives one row per block, which
its task streams.

Defined results: null texts are empty, with no ids; repeated rows come back as often as they went in;
an empty table gives an empty table; other columns are ignored. Lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import blank, bucketed

BLOCK_CHARS = 32_000_000
#: (word, block) rows whose ids a task packs at a time.
PACKED_ROWS = 1_000_000
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    if ranks_path not in _encodings:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[ranks_path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[ranks_path]


class Splitter:
    """Pre-tokens of texts as numbers within a block; ``words`` lists them.

    A text may be cut before a single space: no match of the pattern crosses one, except that it begins
    there. Texts with two spaces in a row are matched as a whole. A chunk that is a word already is its own
    only match; the matches of other chunks are kept in ``several``.
    """

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.several: dict[str, tuple[int, ...]] = {}

    def numbers(self, text: str) -> tuple[int, ...]:
        words = self.words
        return tuple(words.setdefault(word, len(words)) for word in self.find(text))

    def split(self, text: str, out: array) -> None:
        if "  " in text:
            out.extend(self.numbers(text))
            return
        known, several, append = self.words.get, self.several, out.append
        lead = ""
        for chunk in text.split(" "):
            chunk = lead + chunk
            lead = " "
            number = known(chunk)
            if number is not None:
                append(number)
            elif chunk in several:
                out.extend(several[chunk])
            else:
                found = self.numbers(chunk)
                out.extend(found)
                if len(found) > 1 and len(chunk) < 100:
                    several[chunk] = found


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers, compressed byte by byte place."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), dtype=np.uint8)
    return np.ascontiguousarray(plain.reshape(4, -1).T).view("<u4").ravel()


BLOCKS = "block long, words array<string>, doc_ids array<long>, lengths binary, numbers binary"


def blocks(docs: DataFrame, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block of (doc_id, text): its distinct words, and its documents as word numbers."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        splitter, ids, lengths, numbers, held = Splitter(pattern), [], [], array("i"), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([list(splitter.words)], pa.list_(pa.string())), pa.array([ids], pa.list_(pa.int64())),
                pa.array([packed(np.array(lengths))], pa.binary()), pa.array([packed(np.frombuffer(numbers, dtype=np.int32))], pa.binary())], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if held and held + len(text) > block_chars:
                    yield out()
                    block += 1
                    splitter, ids, lengths, numbers, held = Splitter(pattern), [], [], array("i"), 0
                ids.append(doc_id.as_py())
                before = len(numbers)
                splitter.split(text, numbers)
                lengths.append(len(numbers) - before)
                held += len(text) + 1
        if ids:
            yield out()

    return docs.select(F.col("doc_id").cast("long"), blank(F.col("text")).alias("text")).mapInArrow(run, BLOCKS)


def encode_words(words: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(block, numbers, lengths, ids) from (word, block, number) rows: every task gets all rows of its words,
    sorted, encodes each word once, and packs the ids by block."""
    schema = "block long, numbers binary, lengths binary, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks_path, pattern)._core_bpe.encode_single_piece  # a word is one match of the pattern
        held: dict[int, tuple[array, array, array]] = {}
        rows, last, ids = 0, None, []

        def out() -> pa.RecordBatch:
            columns: list[list] = [[], [], [], []]
            for block, found in held.items():
                for column, value in zip(columns, (block, *(packed(np.frombuffer(x, dtype=np.uint32)) for x in found))):
                    column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                              names=["block", "numbers", "lengths", "ids"])

        for batch in batches:
            for word, block, number in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if word != last:
                    last, ids = word, encode(word)
                if block not in held:
                    held[block] = (array("I"), array("I"), array("I"))
                numbers, lengths, flat = held[block]
                numbers.append(number)
                lengths.append(len(ids))
                flat.extend(ids)
            rows += batch.num_rows
            if rows >= PACKED_ROWS:
                yield out()
                held, rows = {}, 0
        if held:
            yield out()

    return words.select("word", "block", "number").repartition("word").sortWithinPartitions("word").mapInArrow(run, schema)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``docs``, and the ids of each block's words."""
    dealt = bucketed(blocks(docs, pattern, block_chars), "block", "blocks")
    words = dealt.select("block", F.posexplode("words").alias("number", "word"))
    return dealt, encode_words(words, ranks_path, pattern)


def reassemble(dealt: DataFrame, ids: DataFrame, finish, schema: str) -> DataFrame:
    """``finish(doc_id, ids)`` of every document, ids being its token ids in text order."""
    names = [c.split()[0] for c in schema.split(", ")]

    def block(words: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        parts = [[unpacked(x) for x in words[c]] for c in ("numbers", "lengths", "ids")]
        numbers, lengths, flat = (np.concatenate(p) if p else np.empty(0, dtype=np.uint32) for p in parts)
        size, start = np.zeros(len(numbers), dtype=np.int64), np.zeros(len(numbers), dtype=np.int64)
        size[numbers] = lengths
        start[numbers] = np.cumsum(lengths, dtype=np.int64) - lengths
        out = []
        for doc_ids, rows, at in zip(held["doc_ids"], held["lengths"], held["numbers"]):
            at, begin = unpacked(at), 0
            for doc_id, count in zip(doc_ids, unpacked(rows).tolist()):
                own = at[begin:begin + count]
                begin += count
                n = size[own]
                ends = np.cumsum(n)
                within = np.arange(ends[-1] if count else 0) - np.repeat(ends - n, n)
                out.append(finish(None if pd.isna(doc_id) else int(doc_id), flat[np.repeat(start[own], n) + within]))
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"doc_id": "Int64"})

    held = dealt.select(F.col("block").alias("held_block"), "doc_ids", "lengths", "numbers")
    return ids.groupBy("block").cogroup(held.groupBy("held_block")).applyInPandas(block, schema)


def token_bytes(ranks_path: str, pattern: str) -> list[bytes]:
    """The token-byte table, by id."""
    found = encoding(ranks_path, pattern)
    return [found.decode_single_token_bytes(i) for i in range(found.n_vocab)]


_tables: dict[str, list[bytes]] = {}


def decode(ids: np.ndarray, ranks_path: str, pattern: str) -> bytes:
    if ranks_path not in _tables:
        _tables[ranks_path] = token_bytes(ranks_path, pattern)
    return b"".join(map(_tables[ranks_path].__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 32-bit numbers."""
    dealt, ids = encoded(docs, ranks_path, pattern, block_chars)
    return reassemble(dealt, ids, lambda doc_id, found: (doc_id, found.tobytes()), "doc_id long, ids binary")


def decode_documents(encoded_docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids), the inverse of ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(np.frombuffer(ids, dtype="<u4"), ranks_path, pattern) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return encoded_docs.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every document encoded, and its ids decoded again."""
    dealt, ids = encoded(docs, ranks_path, pattern, block_chars)

    def finish(doc_id, found: np.ndarray) -> tuple:
        return doc_id, len(found), hashlib.sha256(found.tobytes()).hexdigest(), hashlib.sha256(decode(found, ranks_path, pattern)).hexdigest()

    return reassemble(dealt, ids, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

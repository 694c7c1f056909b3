"""Cross-tokenizer alignment by lockstep merging of two token streams.

Two tokenizers cut the same bytes, a space and the text, into tokens A and B. Where tokens of both end at one
byte there is a cut; cuts part the tokens into groups, and every pair of an A and a B token whose bytes overlap
is a link.

1. Each task encodes its texts word by word through a bounded cache. A text may be cut before a single space
   between two other characters than white space: neither tokenizer has a token across it (tested against
   whole texts). A batch's words become flat token arrays by one gather.
2. **Lockstep.** The texts of a batch are merged at once. The state is one A and one B pointer per text, in two
   NumPy vectors. Every step emits the link under each text's pointers, marks a cut where both tokens end at the
   same byte, advances the pointers whose token ends first (both, at a cut), and takes finished texts out of the
   vectors. Texts of more than ``LANE_WORDS`` words are several lanes of the state, so one long text does not
   keep the others' vectors short.
3. **Counts of all links.** A block of texts holds its distinct id pairs and their numbers of links; only these
   (pair, block) rows are shuffled, summed over the corpus, compared with the best of their B id (at most one row
   for each A id), and sent back to their blocks. A pair that every text has is one row a block.
4. Blocks are written once, bucketed by block, and meet the counts without being shuffled.

A block holds at most ``BLOCK_LINKS`` links (a text with more is a block of its own).

Defined results: a text that is null or empty, or whose bytes a tokenizer does not give back (such as one with
U+2581, which B reads as a space), has no tokens; repeated rows come back as often as they went in; equal counts
are all the highest; long texts are read whole, but a text without white space is one word and one lane, whose
steps are its links; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.byte_bpe import packed, unpacked
from touchline.llm.common import batches_of_texts, blank, bucketed, byte_alphabet

LANE_WORDS = 256
#: Characters that are encoded and merged at a time, and links of a block. They bound memory only.
BATCH_CHARS, BLOCK_LINKS = 2_000_000, 4_000_000
#: Words kept per worker, and the longest one that is kept.
CACHE_WORDS, CACHE_CHARS = 400_000, 100
#: A pair is A's id above these bits and B's id.
PAIR_BITS = 20
#: Places at which a text with unusual white space may be cut.
SAFE = re.compile(r"(?<=\S) (?=\S)")
_pairs: dict[tuple[str, str], "WordTokens"] = {}


class ByteTokens:
    """Tokenizer A: byte-level BPE; strings of special tokens are plain text. A text is encoded with a space before it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(alphabet[c] for c in token if c in alphabet)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """Tokenizer B: BPE pieces with byte fallback, which itself puts a space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [self.piece(i) for i in range(self.model.get_piece_size())]

    def piece(self, number: int) -> bytes:
        if self.model.is_control(number) or self.model.is_unknown(number):
            return b""
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pool:
    """Token ids of numbered words, one after the other."""

    def __init__(self, tokens):
        self.tokens, self.sizes = tokens, np.array([len(b) for b in tokens.bytes], dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids, self.start, self.count = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, words: list[str]) -> list[bool]:
        """Encode words under the next numbers; whether the tokens of each give its bytes."""
        found, table = self.tokens.encode(words), self.tokens.bytes
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(count.sum()))])
        return [b"".join([table[i] for i in own]) == b" " + word.encode() for own, word in zip(found, words)]

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in order, and the number of ids of each."""
        count = self.count[numbers]
        ends = np.cumsum(count)
        return self.ids[np.repeat(self.start[numbers] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)], count


class WordTokens:
    """Both tokenizers over texts cut at safe places, with the words seen so far."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Pool(ByteTokens(a_path)), Pool(PieceTokens(b_path))
        self.clear()

    def clear(self) -> None:
        #: Words between single spaces, and stretches of texts with other white space; both to their number.
        self.words: dict[str, int] = {}
        self.stretches: dict[str, int] = {}
        self.exact: list[bool] = []
        self.a.clear()
        self.b.clear()

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in order, and how many each text has."""
        if len(self.exact) > CACHE_WORDS:
            self.clear()
        fresh: dict[str, int] = {}
        lists: list[tuple[bool, list[str]]] = []
        for text in texts:
            parts = text.split(" ")
            unseen = [p for p in set(parts).difference(self.words) if p not in fresh]
            plain = all(p and not p[0].isspace() and not p[-1].isspace() for p in unseen)
            if not plain:
                parts = SAFE.split(text)
                unseen = [p for p in dict.fromkeys(parts) if p not in self.stretches]
            target = fresh if plain else self.stretches
            for part in unseen:
                target[part] = -1
            lists.append((plain, parts))
        new_words, new_stretches = list(fresh), [s for s, n in self.stretches.items() if n < 0]
        first = len(self.exact)
        self.words.update(zip(new_words, range(first, first + len(new_words))))
        self.stretches.update(zip(new_stretches, range(first + len(new_words), first + len(new_words) + len(new_stretches))))
        new = new_words + new_stretches
        self.exact += [x and y for x, y in zip(self.a.add(new), self.b.add(new))]
        numbers = [list(map((self.words if plain else self.stretches).__getitem__, parts)) for plain, parts in lists]
        for part in new:  # long ones keep their number for this batch only
            if len(part) > CACHE_CHARS:
                self.words.pop(part, None)
                self.stretches.pop(part, None)
        counts = np.fromiter(map(len, numbers), dtype=np.int64, count=len(numbers))
        return np.fromiter(chain.from_iterable(numbers), dtype=np.int64, count=int(counts.sum())), counts


def word_tokens(a_path: str, b_path: str) -> WordTokens:
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = WordTokens(a_path, b_path)
    return _pairs[a_path, b_path]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
             stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge the token streams of all lanes at once. ``ends_a`` and ``ends_b`` are the byte ends of the tokens of
    all lanes one after the other; a lane's tokens start at ``first_a`` and ``first_b``, and its A tokens end
    before ``stop_a``. Returns the links as positions (a, b), in order, and which A and B tokens end at a cut."""
    cut_a, cut_b = np.zeros(len(ends_a), dtype=bool), np.zeros(len(ends_b), dtype=bool)
    a, b, stop = first_a.copy(), first_b.copy(), stop_a
    steps_a, steps_b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    while len(a):
        steps_a.append(a)
        steps_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        running = a < stop
        if not running.all():
            a, b, stop = a[running], b[running], stop[running]
    link_a, link_b = np.concatenate(steps_a), np.concatenate(steps_b)
    # a step moves on one token, or two at a cut, so the place of a link follows from its tokens
    place = link_a + link_b - (np.cumsum(cut_a) - cut_a)[link_a]
    in_order_a, in_order_b = np.empty_like(link_a), np.empty_like(link_b)
    in_order_a[place], in_order_b[place] = link_a, link_b
    return in_order_a, in_order_b, cut_a, cut_b


class Aligned:
    """The merged tokens of a batch of texts; ``of_a``, ``of_b``, ``of_links`` and ``of_groups`` bound what belongs to each text."""

    def __init__(self, tokens: WordTokens, texts: list[str]):
        numbers, words = tokens.cut(texts)
        ends = np.cumsum(words)
        wrong = np.concatenate([[0], np.cumsum(~np.fromiter(map(tokens.exact.__getitem__, numbers.tolist()), dtype=bool, count=len(numbers)))])
        keep = (wrong[ends] == wrong[ends - words]) & (np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) > 0)
        numbers, words = numbers[np.repeat(keep, words)], np.where(keep, words, 0)
        (self.a, count_a), (self.b, count_b) = tokens.a.gather(numbers), tokens.b.gather(numbers)
        at_a, at_b = (np.concatenate([[0], np.cumsum(c)]) for c in (count_a, count_b))  # bounds of the words
        text_ends = np.concatenate([[0], np.cumsum(words)])
        place = np.arange(len(numbers)) - np.repeat(text_ends[:-1], words)
        lane = np.flatnonzero(place % LANE_WORDS == 0)
        self.ends_a, self.ends_b = np.cumsum(tokens.a.sizes[self.a]), np.cumsum(tokens.b.sizes[self.b])
        self.link_a, self.link_b, self.cut_a, self.cut_b = lockstep(
            self.ends_a, self.ends_b, at_a[lane], at_b[lane], at_a[np.append(lane[1:], len(numbers))] if len(lane) else lane)
        self.of_a, self.of_b = at_a[text_ends], at_b[text_ends]
        self.of_groups = np.concatenate([[0], np.cumsum(self.cut_a)])[self.of_a]
        self.of_links = self.of_a + self.of_b - self.of_groups

    def pairs(self) -> np.ndarray:
        return (self.a[self.link_a] << PAIR_BITS) | self.b[self.link_b]

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` of all texts as bytes, and the bounds of each text in it."""
        last_a, last_b = np.flatnonzero(self.cut_a), np.flatnonzero(self.cut_b)
        before_b = np.concatenate([[0], last_b + 1])[:-1] if len(last_b) else last_b
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        mark = np.empty(len(ids), dtype=np.uint8)
        place_a, place_b = np.arange(len(self.a)) + before_b[group_a], np.arange(len(self.b)) + last_a[group_b] + 1
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(self.cut_a, ord("|"), ord(","))
        mark[place_b] = np.where(self.cut_b, ord(";"), ord(","))
        width = np.ones(len(ids), dtype=np.int64)
        for power in range(1, 7):
            width += ids >= 10 ** power
        ends = np.cumsum(width + 1)
        out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
        out[ends - 1] = mark
        at, rest = ends - 2, ids
        while len(rest):
            rest, digit = np.divmod(rest, 10)
            out[at] = digit + ord("0")
            more = rest > 0
            at, rest = at[more] - 1, rest[more]
        return out, np.concatenate([[0], ends])[self.of_a + self.of_b]


BLOCKS = ("block long, pairs array<long>, links array<long>, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups array<string>, codes binary")


def blocks(docs: DataFrame, a_path: str, b_path: str, batch_chars: int = BATCH_CHARS, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per block of (doc_id, text): its distinct pairs and their links, what is known of its texts, and
    their links as numbers of pairs. ``groups`` is the hash of the listed groups, empty without tokens."""
    schema = [c.split() for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block = word_tokens(a_path, b_path), TaskContext.get().partitionId() << 32
        held: list[list] = [[] for _ in range(6)]
        pairs: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            codes, distinct = pd.factorize(np.concatenate(pairs))
            columns = [pa.array([block], pa.int64()), *(pa.array([c], pa.list_(pa.int64())) for c in (distinct, np.bincount(codes, minlength=len(distinct)))),
                       *(pa.array([c], pa.list_(pa.int64())) for c in held[:5]), pa.array([held[5]], pa.list_(pa.string())),
                       pa.array([packed(codes)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in schema])

        for ids, texts in batches_of_texts(batches, batch_chars):
            found = Aligned(tokens, texts)
            listed, bounds = found.listed()
            listed = memoryview(listed)
            digests = [hashlib.sha256(listed[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            sizes = [np.diff(b).tolist() for b in (found.of_a, found.of_b, found.of_groups, found.of_links)]
            if pairs and sum(map(len, pairs)) + len(found.link_a) > block_links:
                yield out()
                block, held, pairs = block + 1, [[] for _ in range(6)], []
            for column, values in zip(held, (ids, *sizes, digests)):
                column.extend(values)
            pairs.append(found.pairs())
        if pairs:
            yield out()

    return docs.select(F.col("doc_id").cast("long"), blank(F.col("text")).alias("text")).mapInArrow(run, BLOCKS)


def pair_counts(dealt: DataFrame) -> DataFrame:
    """(pair, b, count, best): links of every id pair over all blocks, and whether no pair of its B id has more."""
    rows = dealt.select(F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("x.*")
    totals = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("count")).withColumn("b", F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1))
    return totals.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def digests(docs: DataFrame, a_path: str, b_path: str, batch_chars: int = BATCH_CHARS, block_links: int = BLOCK_LINKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    dealt = bucketed(blocks(docs, a_path, b_path, batch_chars, block_links), "block", "aligned")
    held = dealt.select(F.col("block").alias("held_block"), "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups", "codes")
    rows = dealt.select("block", F.posexplode("pairs").alias("number", "pair"))
    known = rows.join(pair_counts(dealt).select("pair", "count", "best"), "pair").select("block", "number", "count", "best")
    known = known.unionByName(dealt.select("block", F.lit(-1).alias("number"), F.lit(0).cast("long").alias("count"), F.lit(False).alias("best")))

    def finish(counts: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        counts = counts.sort_values("number")[1:]  # without the row that stands for the block itself
        out = []
        for row in block.itertuples():
            codes, n_links = unpacked(row.codes), np.asarray(row.n_links, dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(n_links)])
            sums = [np.concatenate([[0], np.cumsum(counts[c].to_numpy(dtype=np.int64)[codes])]) for c in ("best", "count")]
            n_best, count_sum = (s[starts[1:]] - s[starts[:-1]] for s in sums)
            out.append(pd.DataFrame({"doc_id": pd.array(row.doc_ids, dtype="Int64"), "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": n_links,
                                     "n_best": n_best, "count_sum": count_sum, "groups_sha256": row.groups}))
        return pd.concat(out)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return known.groupBy("block").cogroup(held.groupBy("held_block")).applyInPandas(finish, schema)


def alignments(docs: DataFrame, a_path: str, b_path: str, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_groups, b_groups, links): the tokens of every document, the group of each token
    from 0, and the links as (a, b) positions among the document's tokens."""
    schema = "doc_id long, a_ids array<long>, b_ids array<long>, a_groups array<long>, b_groups array<long>, links array<struct<a:long,b:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(a_path, b_path)
        for ids, texts in batches_of_texts(batches, batch_chars):
            found = Aligned(tokens, texts)
            group_a, group_b = (np.cumsum(c) - c for c in (found.cut_a, found.cut_b))
            columns: list[list] = [[] for _ in range(5)]
            for i in range(len(texts)):
                (a0, a1), (b0, b1), (k0, k1) = (bound[i:i + 2] for bound in (found.of_a, found.of_b, found.of_links))
                links = [{"a": x, "b": y} for x, y in zip((found.link_a[k0:k1] - a0).tolist(), (found.link_b[k0:k1] - b0).tolist())]
                own = (found.a[a0:a1], found.b[b0:b1], group_a[a0:a1] - found.of_groups[i], group_b[b0:b1] - found.of_groups[i], links)
                for column, value in zip(columns, own):
                    column.append(value)
            longs, link = pa.list_(pa.int64()), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, longs) for c in columns[:4]), pa.array(columns[4], link)],
                                             names=["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "links"])

    return docs.select(F.col("doc_id").cast("long"), blank(F.col("text")).alias("text")).mapInArrow(run, schema)

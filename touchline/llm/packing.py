"""Best-fit packing: hierarchical residual packing of tokenised documents into fixed-length sequences.

1. Every document becomes its token ids plus an end id; only documents above the capacity are cut, into
   full pieces and one shorter last piece. Full pieces are sequences of their own.
2. Each partition packs its remaining pieces by best fit, longest first, and emits bins whose free space is at
   most ``slack``. What lies in underfull bins, all of it, goes on as items: small bins of at most an eighth of
   the capacity (a longer piece alone).
3. **Tree.** Round by round, groups of ``fan_in`` nodes merge. A group packs the items of its nodes by best fit,
   longest first, emits its nearly full bins and takes the underfull ones apart again: their items go up to the
   next round. The last round has one group, which emits all its bins, so no piece is dropped and no underfull
   bin is closed early.

A group knows its items by their number for each length (at most ``capacity`` numbers for each of its nodes, however
many items there are); best fit of the numbers says which ranks of a length go to which bin. Items get their rank
from the numbers of the nodes before their own, and are placed in parts of ``part_rows``, so neither a task nor
the driver holds the items of a group.

Token ids come from the word-level tokenizer. White space separates its words, so the distinct words of a batch are
encoded once, kept in a bounded cache, and every text is one gather of its words' ids; the result equals encoding
the whole text with the library (tested), also where a text holds the strings of special tokens.

Defined results: null text is empty, so the document is the end id alone; repeated rows are packed as
documents of their own; pieces of equal length go in any order; a long text is encoded whole and cut only into pieces;
an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import batches_of_texts, byte_alphabet, materialise

CAPACITY = 2048
#: Words kept per worker, and the longest one kept; a full cache starts anew. Bounds memory only.
CACHE_WORDS, CACHE_CHARS = 600_000, 200
#: Characters that are encoded at a time, and pieces that a partition packs at a time.
BATCH_CHARS, CHUNK_PIECES = 4_000_000, 1 << 18
#: A bin's number has its round above these bits, then its node above the next ones.
ROUND_BITS, NODE_BITS = 60, 38
#: Bits of a node below a size, and of a rank below a size, in the keys that are looked up.
RANK_BITS = 44
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
_encoders: dict[str, "WordIds"] = {}


class Numbers(dict):
    """The number of every word; one that is not known gets the next."""

    def __init__(self):
        super().__init__({"": 0})
        self.next = 1

    def __missing__(self, word: str) -> int:
        self[word] = number = self.next
        self.next += 1
        return number


class WordIds:
    """Ids of texts, word by word, through a numbered cache of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge, self.id_of = self.merger()
        self.marks: dict[str, list[int]] = {"": []}
        self.clear()

    def clear(self) -> None:
        self.words = Numbers()
        self.ids, self.start, self.count = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def merger(self):
        """The tokenizer's merges as ranks of byte strings, a byte 0xFF (never in UTF-8) standing for the end of a
        word; it joins the byte before it ahead of all merges. Returns the encoder of a word, and ids by rank."""
        import json

        model = json.loads(self.tokenizer.to_str())["model"]
        alphabet, end = byte_alphabet(), model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            return bytes(alphabet[c] for c in token.removesuffix(end)) + (b"\xff" if token.endswith(end) else b"")

        lone = {bytes([b]): c for c, b in alphabet.items()}
        ordered = [c + end for c in lone.values()] + ["".join(m) for m in model["merges"]] + list(lone.values())
        ranks: dict[bytes, int] = {}
        for token in ordered:
            ranks.setdefault(raw(token), len(ranks))
        ranks[b"\xff"] = len(ranks)
        id_of = [model["vocab"].get(t, 0) for t in dict.fromkeys(ordered)] + [0]
        return tiktoken.Encoding("words", pat_str="x", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece, id_of

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def mark(self, text: str) -> list[int]:
        if text not in self.marks:
            if len(self.marks) > CACHE_WORDS:
                self.marks = {"": []}
            self.marks[text] = self.library([text])[0]
        return self.marks[text]

    def simple(self, word: str) -> list[int] | None:
        """Ids of a run of Latin letters between ASCII marks, which splits into exactly these; None for other words."""
        if word.isalpha():
            if not word.isascii() and max(word) > "\u00ff" or word in self.special:
                return None
            return [self.id_of[r] for r in self.merge(word.lower().encode() + b"\xff")]
        core = word.strip(PUNCTUATION)
        if not core.isalpha() or max(core) > "\u00ff" or any(s in word for s in self.special):
            return None
        at = word.index(core)
        if at and word[0] == "'":  # may begin a contraction
            return None
        return self.mark(word[:at]) + [self.id_of[r] for r in self.merge(core.lower().encode() + b"\xff")] + self.mark(word[at + len(core):])

    def add(self, words: list[str]) -> None:
        """Ids of the words whose numbers follow those known."""
        found = [self.simple(w) for w in words]
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(others, self.library([words[i] for i in others])):
            found[i] = ids
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(count.sum()))])

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end_id``, and the bounds of the texts in them."""
        if len(self.count) > CACHE_WORDS:
            self.clear()
        lists = [text.replace("\n", " ").split(" ") for text in texts]
        per_text = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        known = len(self.count)
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(lists)), dtype=np.int64, count=int(per_text.sum()))
        new = list(islice(reversed(self.words), self.words.next - known))[::-1]
        self.add(new)
        for word in new:  # long ones are known for this batch only
            if len(word) > CACHE_CHARS:
                del self.words[word]
        count = self.count[numbers]
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(self.start[numbers] - ends[:-1], count) + np.arange(ends[-1])
        inner = ends[np.concatenate([[0], np.cumsum(per_text)])]  # bounds without the end ids
        out = np.full(ends[-1] + len(texts), end_id, dtype="<u4")
        out[np.arange(ends[-1]) + np.repeat(np.arange(len(texts)), np.diff(inner))] = self.ids[at]
        return out, inner + np.arange(len(texts) + 1)


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item, packing the longest first into the fullest bin that still has room."""
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    open_at: dict[int, list[int]] = {}  # free space -> bins
    free_sizes: list[int] = []  # sorted keys of open_at
    bins = 0
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        at = bisect.bisect_left(free_sizes, size)
        if at < len(free_sizes):
            free = free_sizes[at]
            target = open_at[free].pop()
            if not open_at[free]:
                del open_at[free], free_sizes[at]
        else:
            free, target, bins = capacity, bins, bins + 1
        placed[item] = (target, capacity - free)
        if left := free - size:
            if left not in open_at:
                open_at[left] = []
                bisect.insort(free_sizes, left)
            open_at[left].append(target)
    return placed


def loosened(placed: np.ndarray, lengths: np.ndarray, goes_on: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins that go on, taken apart into small bins: (bin, offset) per item, length per bin, and whether the
    bin goes on."""
    bins, offsets = placed[:, 0].copy(), placed[:, 1].copy()
    moved = np.flatnonzero(goes_on[bins])
    moved = moved[np.lexsort((offsets[moved], bins[moved]))]
    count, last, used = len(goes_on), -1, 0
    for item in moved.tolist():
        size = int(lengths[item])
        if bins[item] != last or used + size > small:
            last, used, count = bins[item], 0, count + 1
        bins[item], offsets[item] = count - 1, used
        used += size
    totals = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
    return np.stack([bins, offsets], 1), totals, np.arange(count) >= len(goes_on)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, node long, size long, rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(ids: np.ndarray, bounds: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Text, piece, start, length and crc32 of every piece of texts whose ids lie between ``bounds``."""
    n = np.diff(bounds)
    pieces = -(-n // capacity)
    text = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(n[text] - start, capacity)
    data, at = memoryview(ids.tobytes()), 4 * (bounds[:-1][text] + start)
    crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())), dtype=np.int64, count=len(at))
    return text, piece, start, length, crc


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, slack: int) -> DataFrame:
    """Pieces of every document with their place in a bin of their own partition. ``rank`` is that of the bin among
    the partition's bins of its ``size`` that go on (-1: the bin is emitted)."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def packed(parts: list[np.ndarray], node: int, first_bin: int, seen: np.ndarray) -> tuple[pa.RecordBatch, int]:
        lengths = parts[3]
        placed = np.asarray(best_fit(lengths.tolist(), capacity), dtype=np.int64)
        totals = np.bincount(placed[:, 0], weights=lengths).astype(np.int64)
        placed, totals, goes_on = loosened(placed, lengths, capacity - totals > slack, capacity // 8)
        moved = np.flatnonzero(goes_on)
        moved = moved[np.argsort(totals[moved], kind="stable")]
        sizes = totals[moved]
        ranks = np.full(len(totals), -1, dtype=np.int64)
        ranks[moved] = seen[sizes] + np.arange(len(moved)) - np.searchsorted(sizes, sizes)
        seen += np.bincount(sizes, minlength=len(seen))
        own = placed[:, 0]
        columns = [pa.array(parts[0], pa.int64(), from_pandas=True), pa.array(parts[1].astype(np.int32)), *(pa.array(p) for p in parts[2:]),
                   pa.array((node << NODE_BITS) + first_bin + own), pa.array(placed[:, 1]), pa.array(np.full(len(own), node)), pa.array(totals[own]),
                   pa.array(ranks[own])]
        return pa.RecordBatch.from_arrays(columns, names=names), first_bin + len(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, node = encoder(tokenizer_path), TaskContext.get().partitionId()
        next_bin, seen, held = 0, np.zeros(capacity + 1, dtype=np.int64), 0
        parts: list[list[np.ndarray]] = [[] for _ in range(5)]
        for ids, texts in batches_of_texts(batches, BATCH_CHARS):
            text, *columns = cut(*words.encode(texts, end_id), capacity)
            for column, values in zip(parts, (np.array(ids, dtype=object)[text], *columns)):
                column.append(values)
            held += len(text)
            if held >= CHUNK_PIECES:
                out, next_bin = packed([np.concatenate(c) for c in parts], node, next_bin, seen)
                parts, held = [[] for _ in range(5)], 0
                yield out
        if held:
            yield packed([np.concatenate(c) for c in parts], node, next_bin, seen)[0]

    return docs.mapInArrow(run, PIECES)


def best_fit_runs(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], list[tuple[int, int, int]]]:
    """``best_fit`` of items known by their number per length. (length, rank, bin, per_bin, offset, items): so many
    items of this length from this rank on lie in bins from this one on, ``per_bin`` in each, at this offset; and
    (bin, number, free): so many bins from this one on have that much space left, all others none. Equal bins are
    kept as runs, so work and result depend on the capacity and not on the number of items."""
    open_at: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of bins: first, number
    free_sizes: list[int] = []
    plan, bins = [], 0

    def put(free: int, first: int, n: int) -> None:
        if free and n:
            if free not in open_at:
                open_at[free] = []
                bisect.insort(free_sizes, free)
            open_at[free].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(free_sizes, size)
            if at < len(free_sizes):
                free = free_sizes[at]
                first, n = open_at[free].pop()
                if not open_at[free]:
                    del open_at[free], free_sizes[at]
            else:
                free, first, n = capacity, bins, -(-left // (capacity // size))
                bins += n
            per_bin = min(free // size, left)
            used = min(n, left // per_bin)
            plan.append((size, rank, first, per_bin, capacity - free, used * per_bin))
            put(free, first + used, n - used)
            put(free - per_bin * size, first, used)
            rank, left = rank + used * per_bin, left - used * per_bin
    return plan, sorted((first, n, free) for free, runs in open_at.items() for first, n in runs)


def best_fit_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, rank, bin, per_bin, offset) of ``best_fit_runs``."""
    return [row[:5] for row in best_fit_runs(counts, capacity)[0]]


class Plan:
    """Best fit of a group of nodes: for items of a size and rank their bin, their place in it, and, if the bin
    is underfull and ``last`` is false, their rank among the items of their size that go on."""

    def __init__(self, node: np.ndarray, size: np.ndarray, n: np.ndarray, capacity: int, slack: int, last: bool):
        order = np.lexsort((node, size))
        self.node, self.size, n = node[order], size[order], n[order]
        before = np.cumsum(n) - n
        first = np.searchsorted(self.size, self.size)
        self.before = before - before[first]  # items of the size in the nodes before
        sizes, at = np.unique(self.size, return_index=True)
        total = np.add.reduceat(n, at) if len(at) else n
        rows, runs = best_fit_runs(dict(zip(sizes.tolist(), total.tolist())), capacity)
        starts = [f for f, _, _ in runs]
        edges = sorted({e for f, n, _ in runs for e in (f, f + n)})

        def free(bin_: int) -> int:
            at = bisect.bisect_right(starts, bin_) - 1
            return runs[at][2] if at >= 0 and bin_ < runs[at][0] + runs[at][1] else 0

        split = []  # rows whose bins have all the same space left
        for row_size, rank, low, per_bin, offset, items in rows:
            high = low + items // per_bin
            cuts = [low, *edges[bisect.bisect_right(edges, low):bisect.bisect_left(edges, high)], high]
            split += [(row_size, rank + (x - low) * per_bin, x, per_bin, offset, y - x, free(x)) for x, y in zip(cuts, cuts[1:])]
        self.row_size, self.rank, self.bin, self.per_bin, self.offset, bins, left = np.array(sorted(split), dtype=np.int64).reshape(-1, 7).T
        self.open = (left > slack) & (not last)
        going = np.where(self.open, bins * self.per_bin, 0)
        upto = np.cumsum(going) - going
        self.new_rank = upto - upto[np.searchsorted(self.row_size, self.row_size)]

    def place(self, node: np.ndarray, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, place in it, and new rank (-1: the bin is emitted) of items."""
        key = (self.size << RANK_BITS) + self.node
        rank = rank + self.before[np.searchsorted(key, (size << RANK_BITS) + node)]
        row = np.searchsorted((self.row_size << RANK_BITS) + self.rank, (size << RANK_BITS) + rank, side="right") - 1
        nth, slot = np.divmod(rank - self.rank[row], self.per_bin[row])
        return self.bin[row] + nth, self.offset[row] + slot * size, np.where(self.open[row], self.new_rank[row] + rank - self.rank[row], -1)


def merge_round(items: DataFrame, level: int, fan_in: int, last: bool, capacity: int, slack: int, part_rows: int) -> DataFrame:
    """The pieces of the items of a round, placed in bins of their group of nodes; those with a rank of -1 are in
    emitted bins, the others keep their size and place in the item. Ids are carried as text, which keeps nulls."""
    group = F.floor(F.col("node") / fan_in).cast("long")
    counts = items.groupBy("node", "size").agg((F.max("rank") + 1).alias("n"), F.count("*").alias("pieces")).withColumn("group", group)
    counts = materialise(counts, f"round-{level}")
    sizes = counts.groupBy("group").agg(F.sum("pieces").alias("pieces")).withColumn("parts", F.ceil(F.col("pieces") / part_rows).cast("int"))
    # one row a group of ``fan_in`` nodes, so the join side is small; each part of a group gets the group's numbers
    known = counts.join(sizes.select("group", "parts"), "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = (items.withColumn("group", group).join(sizes.select("group", "parts"), "group")
             .withColumn("part", F.pmod(F.xxhash64("rank", "size", "node"), F.col("parts")).cast("int")).drop("parts"))

    def place(pieces: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
        columns = {c: numbers[c].to_numpy(dtype=np.int64) for c in ("node", "size", "n")}
        plan = Plan(columns["node"], columns["size"], columns["n"], capacity, slack, last)
        found, offset, rank = plan.place(*(pieces[c].to_numpy(dtype=np.int64) for c in ("node", "size", "rank")))
        own = pieces["group"].to_numpy(dtype=np.int64)
        open_ = rank >= 0
        return pd.DataFrame({"doc_id": pieces["doc_id"].astype(object), **{c: pieces[c] for c in ("piece", "start", "length", "ids_crc32")},
                             "bin": (level << ROUND_BITS) + (own << NODE_BITS) + found,
                             "offset": pieces["offset"] + np.where(open_, 0, offset), "node": own, "size": pieces["size"], "rank": rank})

    placed = (dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("group", "part")
              .cogroup(known.groupBy("group", "part")).applyInPandas(place, PIECES.replace("doc_id long", "doc_id string")))
    return materialise(placed.withColumn("doc_id", F.col("doc_id").cast("long")), f"placed-{level}")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, slack: int = 16, fan_in: int = 16,
         part_rows: int = 200_000, report: list | None = None) -> DataFrame:
    """Place every piece of every document (doc_id, text): doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. ``slack`` is the free space up to which a bin counts as full, ``fan_in`` the nodes that a group
    of a round merges. ``report`` receives a row for each round, the packing of the partitions being round 0: the sequences
    emitted, their tokens, the least number of sequences that could hold those, and the pieces that go on."""
    rows = materialise(tokenised_pieces(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), tokenizer_path, end_id,
                                        capacity, slack), "pieces")
    nodes = (rows.filter("rank >= 0").agg(F.max("node")).first()[0] or 0) + 1
    out, level = None, 0
    while True:
        emitted = rows.filter("rank < 0").select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
        out = emitted if out is None else out.unionByName(emitted)
        items = rows.filter("rank >= 0")
        if report is not None:
            tokens, sequences = emitted.agg(F.coalesce(F.sum("length"), F.lit(0)), F.countDistinct("sequence_id")).first()
            report.append({"round": level, "sequences": sequences, "tokens": tokens, "least": -(-tokens // capacity), "going_on": items.count()})
        if items.isEmpty():
            return out
        level, last = level + 1, nodes <= fan_in
        rows = merge_round(items, level, fan_in, last, capacity, slack, part_rows)
        nodes = -(-nodes // fan_in)

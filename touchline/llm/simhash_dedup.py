"""SimHash near-dedup: fingerprints of word shingles, linked by a binary trie self-join.

Fingerprint: ASCII letters lower-cased, words split at ASCII white space, four-word shingles joined by one
space (repeats count), XXH64 of each; a bit is 1 if it is set in more than half of the hashes.

Join: two fingerprints within ``distance`` bits differ in at most ``distance // segments`` bits of one of
``segments`` bit segments. Per segment the fingerprints are rotated so that it comes first and form a binary
trie. The top of the trie is dealt out: a node pair whose prefixes differ in at most one bit is a task (a
fingerprint goes to its own prefix, and as a guest to each lower prefix one bit away). Inside a task node
pairs are traversed together, the differing bits add up, and a pair is pruned when it exceeds the segment's
budget while inside the segment, or the whole budget after it. A pair whose leaves already hang together is
pruned as well, so a dense group of near copies yields a spanning forest, not all its pairs.

Links join distinct fingerprints only, so exact copies cost one node. Components come from alternating
large-star and small-star rounds, each written to the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any other; texts of fewer than
four words are one shingle; a component is named by its smallest doc_id (null ids never name one that has
others); repeated rows share a component; an empty table gives an empty table.
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

SHINGLE = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width, from the top
#: Work per step of the traversal, and the node size at which leaves are compared one by one.
FRONTIER, LEAF = 1 << 14, 8
FOLD = 1 << 15  # hashes summed at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n - shingle + 1].tolist()
    stops = ends[shingle - 1:].tolist()
    votes = np.zeros(64, dtype=np.int64)
    total = len(starts)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, FOLD):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + FOLD], stops[at:at + FOLD])], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > total).view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus its fingerprint as a signed long, the same 64 bits."""
    schema = T.StructType(docs.schema.fields + [T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def rotated(fps: np.ndarray, by: int) -> np.ndarray:
    return fps if not by else (fps << np.uint64(by)) | (fps >> np.uint64(64 - by))


class Forest:
    """Union-find over positions 0..n-1, merged in vectors; the smallest position is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def flatten(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.flatten()
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if len(a):
                np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def trie_links(home: np.ndarray, guests: np.ndarray, prefix: int, width: int, distance: int, near: int) -> np.ndarray:
    """Spanning forest of the links that a task finds, as pairs of positions in home + guests.

    ``home`` and ``guests`` are rotated fingerprints, sorted by the bits after the prefix. Home pairs with home (no differing bit so far)
    and with guests (one so far). ``width`` is the segment's width, ``near`` the budget inside it.
    """
    values = np.concatenate([home, guests])
    n_home, n = len(home), len(values)
    forest = Forest(n)
    zeros: dict[int, np.ndarray] = {}

    def split(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if bit not in zeros:
            zeros[bit] = np.concatenate([[0], np.cumsum(((values >> np.uint64(63 - bit)) & np.uint64(1)) == 0)])
        return lo + zeros[bit][hi] - zeros[bit][lo]

    stack = [(prefix, np.array([[0, n_home, 0, n_home, 0]])), (prefix, np.array([[0, n_home, n_home, n, 1]]))]
    while stack:
        bit, pairs = stack.pop()
        pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (pairs[:, 4] <= (near if bit <= width else distance))]
        pairs = pairs[~((pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] - pairs[:, 0] == 1))]
        if not len(pairs):
            continue
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(bit, pairs[:half]), (bit, pairs[half:])]
            continue
        root = forest.flatten()
        change = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        one_a, one_b = change[pairs[:, 0]] == change[pairs[:, 1] - 1], change[pairs[:, 2]] == change[pairs[:, 3] - 1]
        pairs = pairs[~(one_a & one_b & (root[pairs[:, 0]] == root[pairs[:, 2]]))]
        size_a, size_b = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        leaf = ((size_a <= LEAF) & (size_b <= LEAF)) | (bit == 64)
        if leaf.any():
            a0, b0, sa, sb = pairs[leaf, 0], pairs[leaf, 2], size_a[leaf], size_b[leaf]
            count = sa * sb
            which = np.repeat(np.arange(len(count)), count)
            k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            a, b = a0[which] + k // sb[which], b0[which] + k % sb[which]
            hit = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= distance)
            forest.union(a[hit], b[hit])
            pairs = pairs[~leaf]
        if not len(pairs):
            continue
        alo, ahi, blo, bhi, err = pairs.T
        am, bm = split(alo, ahi, bit), split(blo, bhi, bit)
        same = (alo == blo) & (ahi == bhi)
        cross = ~same
        children = [np.stack([alo, am, blo, bm, err], 1), np.stack([am, ahi, bm, bhi, err], 1), np.stack([alo, am, bm, bhi, err + 1], 1),
                    np.stack([am, ahi, blo, bm, err + 1], 1)[cross]]
        stack.append((bit + 1, np.concatenate(children)))
    root = forest.flatten()
    apart = np.flatnonzero(root != np.arange(n))
    return np.stack([apart, root[apart]], 1)


def prefix_bits(n: int, per_task: int = 1000) -> int:
    """Depth at which the trie is dealt out, so that a task has about ``per_task`` fingerprints."""
    return max(4, min(SEGMENTS[-1][1], int(np.ceil(np.log2(max(n, 1) / per_task + 1)))))


def link_fingerprints(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column ``fp``) whose closure joins all that lie within
    ``distance`` bits."""
    near = distance // len(SEGMENTS)
    if near > 1:
        raise ValueError("the top of the trie is dealt out for a segment budget of at most one bit")
    depth = prefix_bits(fps.count())
    rows = []
    for seg, (first, _) in enumerate(SEGMENTS):
        turned = F.col("fp") if not first else F.shiftleft("fp", first).bitwiseOR(F.shiftrightunsigned("fp", 64 - first))
        key = F.shiftrightunsigned(turned, 64 - depth)
        rows.append(F.struct(F.lit(seg).alias("seg"), key.alias("key"), F.lit(True).alias("home")))
        if near:
            rows += [F.when(key.bitwiseAND(F.lit(1 << j)) != 0, F.struct(F.lit(seg).alias("seg"), key.bitwiseXOR(F.lit(1 << j)).alias("key"), F.lit(False).alias("home")))
                     for j in range(depth)]
    dealt = (fps.select("fp", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r"))
             .select("fp", "r.seg", "r.key", "r.home"))

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        first, width = SEGMENTS[int(pdf["seg"].iloc[0])]
        original = pdf["fp"].to_numpy().view(np.uint64)
        turned, home = rotated(original, first), pdf["home"].to_numpy()
        sides = []
        for side in (home, ~home):
            at = np.flatnonzero(side)
            sides.append(at[np.argsort(turned[at] << np.uint64(depth))])  # guests come from several prefixes
        order = np.concatenate(sides)
        links = trie_links(turned[sides[0]], turned[sides[1]], depth, width, distance, near)
        ends = original[order].view(np.int64)
        return pd.DataFrame({"u": ends[links[:, 0]], "v": ends[links[:, 1]]})

    return dealt.groupBy("seg", "key").applyInPandas(task, "u long, v long")


def components(links: DataFrame, limit: int = 64) -> DataFrame:
    """(node, root) for every node that has a link; the root is the component's smallest node.

    Large-star links every larger neighbour to a node's smallest neighbour, small-star every smaller one;
    they alternate until nothing changes, after a number of rounds logarithmic in the size.
    """
    def measure(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = measure(edges)
    for _ in range(limit):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.join(lowest, F.col("u") == F.col("n")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        joined = large.join(small, F.col("u") == F.col("n"))
        edges = materialise(joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                            .select("e.u", "e.v").filter("u <> v").distinct(), "links")
        now = measure(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {limit} rounds")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, root, component_id, text_key) per row of ``docs`` (doc_id, text): the fingerprint, the
    smallest fingerprint and the smallest doc_id that its links reach, and a hash of the text."""
    rows = docs.select(F.col("doc_id"), blank(F.col("text")).alias("text"))
    marked = materialise(with_fingerprint(rows.withColumn("text_key", F.xxhash64("text")), shingle=shingle).drop("text"), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(link_fingerprints(nodes.select("fp"), distance))
    placed = (nodes.join(roots, F.col("fp") == F.col("node"), "left")
              .select(F.col("fp").alias("n_fp"), "least_id", F.coalesce("root", "fp").alias("root")))
    names = placed.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component_id"))
    named = placed.join(names, F.col("root") == F.col("r")).select("n_fp", "root", "component_id")
    return marked.join(named, F.col("fp") == F.col("n_fp")).select("doc_id", "fp", "root", "component_id", "text_key")


def deduplicate(docs: DataFrame, distance: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group stays, with all columns of ``docs``: the one with the smallest doc_id (ties: the
    smallest fingerprint, then text hash)."""
    marked = near_duplicates(docs, distance, shingle)
    sentinel = F.lit(-(1 << 63))
    keep = (marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_key")).alias("w"))
            .select(F.coalesce("w.doc_id", sentinel).alias("_id"), F.col("w.text_key").alias("_text")))
    ident, key = fresh(docs, "_ident", "_key")
    held = docs.withColumn(key, F.xxhash64(blank(F.col("text")))).withColumn(ident, F.coalesce(F.col("doc_id").cast("long"), sentinel))
    kept = held.join(keep, (F.col(ident) == F.col("_id")) & (F.col(key) == F.col("_text")), "left_semi")
    return kept.dropDuplicates([ident, key]).select(*[F.col(f"`{c}`") for c in docs.columns])

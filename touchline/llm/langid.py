"""Language ID by rank-order profiles: a document's most frequent character n-grams against each language's,
by out-of-place distance.

Profile: the ``size`` most frequent n-grams (1 to 3 code points, lower case, everything but letters read as
one space) in order of falling count, ties by code points. The distance of a document to a language sums,
over the document's profile, how far each n-gram is out of place; one that the language lacks counts
``size``. The nearest language wins, ties by name. Score: 1 - distance / largest possible distance.

N-grams are exact integers (21 bits per code point) counted by sorting in numpy. Language counts come from
all training rows: each task sums its own rows first, then the counts are summed by (language, n-gram) and
ranked. Only ``size`` n-grams per language reach the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any learned language
every row is ``und``; rows with null language are not learned from; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import fresh

SIZE = 300
UNKNOWN = "und"
#: Characters of a text that are sorted at once, and distinct n-grams that a task holds before it emits them.
PART, HELD = 1 << 20, 1 << 20
#: The last code point plus one; letters are looked up in a table of this size.
POINTS = 0x110000
_lower: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Table: code point -> lower-case code point if it is a letter, else the space."""
    if not _lower:
        out = np.full(POINTS, 32, dtype=np.int64)
        for point in range(POINTS):
            ch = chr(point)
            if ch.isalpha():
                low = ch.lower()
                out[point] = ord(low) if len(low) == 1 else point
        _lower.append(out)
    return _lower[0]


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal codes added up, codes ascending."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, dtype=np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text, ascending, and their counts; none if it has no letter."""
    points = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    points = np.concatenate([[32], points, [32]])
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    if len(points) < 2:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    found: tuple[np.ndarray, np.ndarray] | None = None
    for at in range(0, len(points), PART):
        one = points[at:at + PART + 2]  # two more, for n-grams that begin here
        own = min(PART, len(points) - at)
        two = (one[:-1] << 21) | one[1:]
        three = (two[:-1] << 21) | one[2:]
        one = one[:own]
        codes = np.concatenate([one[one != 32], two[:own], three[:own]])
        codes.sort()
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        part = codes[first], np.diff(np.append(first, len(codes)))
        found = part if found is None else summed(np.concatenate([found[0], part[0]]), np.concatenate([found[1], part[1]]))
    return found


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return codes[np.argsort(-counts, kind="stable")[:size]]


def profiles(train: DataFrame, size: int = SIZE) -> dict[str, list[int]]:
    """Ranked n-grams by language, from all rows of ``train`` (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        rows = 0

        def out() -> pa.RecordBatch:
            parts = [(lang, *summed(*(np.concatenate(x) for x in zip(*found)))) for lang, found in held.items()]
            return pa.RecordBatch.from_arrays([
                pa.array([lang for lang, codes, _ in parts for _ in range(len(codes))], pa.string()),
                pa.array(np.concatenate([p[1] for p in parts])), pa.array(np.concatenate([p[2] for p in parts]))], names=["lang", "gram", "n"])

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = ngram_counts(text or "")
                if len(codes):
                    held.setdefault(lang, []).append((codes, counts))
                    rows += len(codes)
                    if rows > HELD:
                        held = {k: [summed(*(np.concatenate(x) for x in zip(*found)))] for k, found in held.items()}
                        rows = sum(len(f[0][0]) for f in held.values())
                        if rows > HELD // 2:
                            yield out()
                            held, rows = {}, 0
        if held:
            yield out()

    counts = (train.filter("lang IS NOT NULL").select(F.col("text").cast("string"), F.col("lang").cast("string"))
              .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for row in sorted(ranked.collect(), key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Ranks:
    """All profiles as one sorted array of n-grams with a rank per language."""

    def __init__(self, found: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(found), size
        self.codes = np.unique(np.array([g for grams in found.values() for g in grams] or [-1], dtype=np.int64))
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, np.array(found[lang], dtype=np.int64)), k] = np.arange(len(found[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = ngram_counts(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = top(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        out_of_place = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(out_of_place))
        return self.langs[best], 1.0 - float(out_of_place[best]) / (self.size * len(own))


def with_language(docs: DataFrame, found: dict[str, list[int]], size: int = SIZE, text: str = "text",
                  out: tuple[str, str] = ("lang_pred", "score"), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus predicted language and score."""
    kept = [docs.columns.index(c) for c in (docs.columns if keep is None else keep)]
    schema = T.StructType([docs.schema.fields[i] for i in kept] + [T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(found)  # at most ``size`` n-grams per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(shared.value, size)
        for batch in batches:
            told = [ranks.predict(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            columns = [*(batch.column(i) for i in kept), pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_languages(docs: DataFrame, found: dict[str, list[int]], accepted: list[str] | None = None, least_score: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose text is in an accepted language (default: any learned one) with at least
    ``least_score``; all columns stay as they are."""
    if not found:
        return docs
    names = fresh(docs, "_lang_pred", "_lang_score")
    told = with_language(docs, found, out=tuple(names))
    good = F.col(names[0]).isin(accepted if accepted is not None else sorted(found)) & (F.col(names[1]) >= least_score)
    return told.filter(good).drop(*names)

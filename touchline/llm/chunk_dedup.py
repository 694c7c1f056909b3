"""Exact deduplication by recipes of content-defined chunks, in DataFrame functions only.

1. A text is normalised (A-Z in lower case) and cut into chunks where its own content says so: after a fixed
   pattern of letters or the end of a sentence, at least ``LEAST`` and at most about ``MOST`` characters apart.
   Equal texts have equal chunks, and an edit changes only the chunks around it.
2. The chunks of all texts are deduplicated by (identifier, content): tasks drop their own repeats first, so the
   content of a chunk moves once a task, however many texts hold it. Identifiers are hashes, and they are
   verified: if one stands for two different contents, all is done again with wider ones.
3. A text is from then on its recipe, the ordered list of its identifiers. Recipes are grouped by comparing
   whole lists (repeats are counted before the shuffle); the group's own identifier is verified in the same way,
   so that what joins the rows to their groups is a short key. Long texts are never moved again.

Groups above a bound are joined in parts (``spread_join``), so a text that a third of all rows share is many tasks.

Defined results: null text is empty; empty texts are equal to each other; a null id is less than any other, and
``keep_id`` is null if all ids of a group are; of rows that repeat id and text one stays, any of them; texts of
any length are one row (a chunk is never longer than ``MOST`` and the pattern); an empty table gives an empty
table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import blank, fresh, materialise, spread_join

#: Characters before a cut is looked for, and characters after which a chunk ends without one.
LEAST, MOST = 120, 1000
#: Cuts by content: a rare neighbourhood of letters, or the end of a sentence in texts of scripts without blanks.
ENDS = "。！？؟।"
LETTERS_CHUNK = rf"(?s).{{{LEAST},{MOST}}}?[a-m][aeiou][lnrst][ ,.;:\n][b-h]|.{{1,{MOST}}}"
SENTENCE_CHUNK = rf"(?s).{{{LEAST},{MOST}}}?[{ENDS}]|.{{1,{MOST}}}"
#: Bits of an identifier, from the first try on; a try is repeated with the next if two contents share one.
WIDTHS = (128, 256, 512)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, null as empty. Texts of ASCII alone take the quicker way."""
    text = blank(text)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def chunks(text: Column) -> Column:
    """The chunks of a normalised text, in order; joined they are the text."""
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) for pattern in (SENTENCE_CHUNK, LETTERS_CHUNK)]
    return F.when(reduce(or_, (text.contains(end) for end in ENDS)), found[0]).otherwise(found[1])


def identifier(value: Column, bits: int) -> Column:
    """``bits`` of hash, as an array of 64-bit words; fewer than 64 bits are the low ones of one word."""
    if bits < 64:
        return F.array(F.pmod(F.xxhash64(F.lit(0), value), F.lit(1 << bits)))
    return F.array(*(F.xxhash64(F.lit(word), value) for word in range(bits // 64)))


def chunk_store(docs: DataFrame, bits: int = WIDTHS[0]) -> DataFrame:
    """(id, chunk, n): every distinct chunk of ``docs`` (text) and how often it occurs."""
    rows = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    return rows.select(identifier(F.col("chunk"), bits).alias("id"), "chunk").groupBy("id", "chunk").agg(F.count("*").alias("n"))


def recipes(docs: DataFrame, bits: int = WIDTHS[0]) -> DataFrame:
    """(doc_id, recipe, recipe_id, text_sha256) of every row of ``docs`` (doc_id, text)."""
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.transform(chunks(F.col("text")), lambda c: identifier(c, bits)).alias("recipe"),
                       F.sha2(F.col("text"), 256).alias("text_sha256"))
    return rows.select("doc_id", "recipe", identifier(F.col("recipe"), bits).alias("recipe_id"), "text_sha256")


def ambiguous(values: DataFrame, key: str) -> bool:
    """Whether a value of ``key`` occurs in more than one row of ``values``, which are distinct."""
    return not values.groupBy(key).count().filter("count > 1").isEmpty()


def exact_duplicates(docs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    for bits in widths:
        if ambiguous(chunk_store(docs, bits).select("id"), "id"):
            continue
        rows = materialise(recipes(docs, bits).withColumn("row", F.monotonically_increasing_id()), "recipes")
        last = F.max(F.struct("doc_id", "row"))
        groups = materialise(rows.groupBy("recipe_id", "recipe").agg(last.alias("last"), F.count("*").alias("group_size")).drop("recipe"), "groups")
        if ambiguous(groups, "recipe_id"):
            continue
        found = spread_join(rows.drop("recipe"), groups, "recipe_id", "group_size", "row")
        return found.select("doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256")
    raise ValueError(f"two contents share an identifier of {widths[-1]} bits")


def deduplicate(docs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest id."""
    found = exact_duplicates(docs, widths).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    (key,) = fresh(docs, "text_key")
    one = docs.withColumn(key, F.sha2(normalised(F.col("text")), 256)).dropDuplicates(["doc_id", key])
    return one.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.col(key) == F.col("kept_sha256")), "left_semi").drop(key)


def restore(recipes: DataFrame, store: DataFrame) -> DataFrame:
    """(recipe_id, text) of every distinct recipe, from the chunks of ``store``."""
    distinct = recipes.select("recipe_id", "recipe").dropDuplicates(["recipe_id"])
    parts = distinct.select("recipe_id", F.posexplode("recipe").alias("place", "id")).join(store.select("id", "chunk"), "id")
    ordered = F.array_sort(F.collect_list(F.struct("place", "chunk")))
    texts = parts.groupBy("recipe_id").agg(F.array_join(F.transform(ordered, lambda p: p["chunk"]), "").alias("text"))
    return distinct.select("recipe_id").join(texts, "recipe_id", "left").withColumn("text", blank(F.col("text")))

"""What five document filters take from one another, in every order they can be applied in.

A document's failures are a mask of five bits. Four filters look at the text alone; the fifth, E, fails texts
that a smaller doc_id has too. Exact repeats are found behind a counting Bloom sketch: every text adds one to
`HASHES` cells, the partial counts of all tasks are summed cell by cell, and a text of which any cell counts one
is the only one of its kind. Only the other texts are shuffled, whole, for the least doc_id of each. A text that
shares all its cells with others by chance is shuffled too and found to be unique, so the sketch decides what
moves and never what fails.

The sketch has `CELLS_PER_TEXT` cells a document and `MOST_CELLS` at most; what is sent to the tasks is one bit
a cell, whether it counts two or more: 64 MB at most, whatever the corpus. Beyond `MOST_CELLS / CELLS_PER_TEXT`
(67 million) documents cells fill up, more unique texts are shuffled, and the results stay the same.

The masks are then counted by part of the corpus: 32 counts a part, of which every figure of every order is a
sum. Nothing is computed per document and order.

Defined results: a null text counts as an empty one, so it repeats empty texts; a document without doc_id is
never a repeat and makes none; rows that repeat a doc_id are documents of their own, and the least id's rows
all pass E; a null part is the empty string; a label counts if any row of `labels` for the id has it; an empty
table has no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import written

CELLS_PER_TEXT = 8
HASHES = 3
MOST_CELLS = 1 << 29
# Bits of one bitmap of bitmap_construct_agg.
BITMAP_BITS = 1 << 15

LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
FILTERS = "ABCDE"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `mask`: 1 too few words, 2 too few distinct words, 4 too many capitals, 8 markup characters."""
    words = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    size = F.char_length(text)
    capitals = size - F.char_length(F.translate(text, _CAPITALS, ""))
    fails = [
        n < LEAST_WORDS,
        distinct * 100 < n * LEAST_DISTINCT_PERCENT,
        capitals.cast("long") * 100 > size.cast("long") * MOST_CAPITALS_PERCENT,
        F.col(text).rlike(r"[#$%&*|]"),
    ]
    mask = sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))
    return words.withColumn("mask", mask).drop("_words")


def cells_for(rows: int) -> int:
    """A power of two of at least CELLS_PER_TEXT cells a row, MOST_CELLS at most."""
    return min(MOST_CELLS, 1 << max(15, (rows * CELLS_PER_TEXT - 1).bit_length()))


def _cells(text: str, cells: int) -> list[Column]:
    own = F.xxhash64(text)
    return [F.xxhash64(own, F.lit(i)).bitwiseAND(F.lit(cells - 1)) for i in range(HASHES)]


def counted_twice(docs: DataFrame, cells: int, text: str = "text") -> np.ndarray:
    """The merged sketch, eight cells a byte and the lowest bit first: set where a cell was counted more than once."""
    places = docs.select(F.explode(F.array_distinct(F.array(*_cells(text, cells)))).alias("cell"))
    twice = places.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    maps = twice.groupBy(F.shiftright("cell", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("cell").bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("bits")
    )
    sketch = np.zeros(cells // 8, np.uint8)
    for part, bits in maps.collect():
        sketch[part * BITMAP_BITS // 8 : (part + 1) * BITMAP_BITS // 8] = np.frombuffer(bits, np.uint8)
    return sketch


def possible_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `repeat`: false only for texts that no other row has."""
    cells = cells_for(docs.count())
    sketch = docs.sparkSession.sparkContext.broadcast(counted_twice(docs, cells, text))

    @F.pandas_udf("boolean")
    def repeat(first: pd.Series, second: pd.Series, third: pd.Series) -> pd.Series:
        found = np.ones(len(first), bool)
        for cell in (first.to_numpy(), second.to_numpy(), third.to_numpy()):
            found &= (sketch.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return pd.Series(found)

    return docs.withColumn("repeat", repeat(*_cells(text, cells)))


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every row of `docs` (doc_id, text, lang), 16 in the mask for repeated texts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marked = text_failures(possible_repeats(rows))
    # Texts that cannot repeat are read here for the last time.
    marked = written(marked.select("doc_id", "part", "mask", "repeat", F.when(F.col("repeat"), F.col("text")).alias("text")))
    maybe = marked.filter("repeat")
    # The whole text is the key; combined within tasks first, however many copies there are.
    firsts = maybe.groupBy("text").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL")
    firsts = firsts.select(F.sha2("text", 256).alias("digest"), "doc_id", F.lit(True).alias("first"))
    maybe = maybe.select("part", "mask", "doc_id", F.sha2("text", 256).alias("digest"))
    named = maybe.filter("doc_id IS NOT NULL").join(firsts, ["digest", "doc_id"], "left")
    repeated = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    return (
        marked.filter("NOT repeat").select("doc_id", "part", "mask")
        .union(maybe.filter("doc_id IS NULL").select("doc_id", "part", "mask"))
        .union(named.select("doc_id", "part", (F.col("mask") + repeated).alias("mask")))
    )


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents fail exactly these filters, and how many of them are labelled."""
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(F.when(mark, 1).otherwise(0)).alias(name) for name, mark in marks.items())
    )
    named = failed.filter("doc_id IS NOT NULL").join(known, "doc_id", "left").select("part", "mask", "good", "toxic")
    nameless = failed.filter("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    sums = (F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in marks)
    return named.union(nameless).groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every figure of every step of every order of the filters, per part, from its mask counts."""
    size = len(filters)
    orders = F.array(*(F.lit("".join(order)) for order in permutations(filters)))
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = per_part.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size))))

    def bit(place: str) -> str:
        return f"shiftleft(1, locate(substring(filter_order, {place}, 1), '{filters}') - 1)"

    earlier = f"transform(sequence(1, step), i -> if(i < step, {bit('i')}, 0))"
    steps = steps.withColumns({"own": F.expr(bit("step")), "before": F.expr(f"aggregate({earlier}, 0, (a, b) -> a | b)")})

    def total(condition: str, what: str = "m.n") -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {condition}), 0L, (sum, m) -> sum + {what})")

    removed = "(m.mask & own) <> 0 AND (m.mask & before) = 0"
    return steps.select(
        "part", "filter_order", "step",
        total("(m.mask & (own | before)) = 0").alias("kept"),
        total(removed).alias("removed"),
        total("(m.mask & own) <> 0 AND (m.mask & before) <> 0").alias("redundant"),
        total("m.mask = own").alias("unique_fails"),
        total(removed, "m.good").alias("good_lost"),
        total(removed, "m.toxic").alias("toxic_lost"),
        # Of all orders, a failing filter comes before the document's other ones in one of bit_count(mask).
        total("(m.mask & own) <> 0", f"m.n * {factorial(size)} div bit_count(m.mask)").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and its figures, for every part, order and step."""
    return interactions(mask_counts(failures(docs), labels))

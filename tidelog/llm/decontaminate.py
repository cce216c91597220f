"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by a test item when it holds at least 75 % of the item's distinct five-word
shingles. Resemblance of whole MinHash sketches says nothing here, for a short item is a vanishing share of
a long document; containment is searched from the item's side instead:

* Items are partitioned by size, in classes that double. An item with n shingles keeps its MinHash sketch,
  its m = n - ceil(0.75 n) + 1 shingles of least hash. A document without any of them lacks m shingles and
  holds fewer than 75 %, so the search finds every contaminated document, not just most.
* Of each class, the largest hash of its sketches and the least document that can hold one of its items are
  known. Documents are probed only for the classes they are large enough for, and only with shingles whose
  hash some such sketch may hold.
* A document that has a sketch shingle is a candidate for that item and decided on both full shingle sets.

An item of one to four words is one shingle of so many words, and documents are searched for shingles of that width
as well, if there is such an item: it is found wherever its words stand in a document.

Items of at most `BLOCK_SHINGLES` shingles together (16 MB) are sent to the tasks and the documents are passed
once, without a shuffle of them; only found pairs are shuffled. More items are never gathered: a table of bits tells
the documents which of their shingles no item has (`MOST_BITS` at most, 32 MB), the others meet the items' sketch
shingles by shuffle, and candidates are decided by the same shuffle of full sets.

Defined results: items without words are found nowhere. Null and empty documents hold nothing. Rows that repeat an
id count together: a pair is returned once, with its largest containment. Null ids are ids like others.
Further columns are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.frames import modest_batches, written

SHARE, WHOLE = 75, 100
BLOCK_SHINGLES = 2_000_000
_BITS = 20
# Of the table of bits that items beyond a block are filtered by; each has so many bits a shingle up to that.
MOST_BITS = 1 << 28
BITS_A_SHINGLE = 16


def needed(n: int) -> int:
    """Shingles of an item of n that a document must hold."""
    return -(-n * SHARE // WHOLE)


def _order(shingles: np.ndarray) -> np.ndarray:
    """The hash that MinHash sketches are taken by."""
    return texts.mix(shingles ^ np.uint64(0xA0761D6478BD642F))


class Items:
    """A block of items, ready to be searched for: by size class, and by sketch shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        sizes = np.array([len(s) for s in sets])
        self.classes = np.unique(np.frexp(sizes)[1])
        self.least = np.array([needed(2 ** (c - 1)) for c in self.classes])
        owners, sketches, cutoffs = [], [], np.zeros(len(self.classes), np.uint64)
        for item, own in enumerate(sets):
            order = np.sort(_order(own))[: len(own) - needed(len(own)) + 1]
            place = np.searchsorted(self.classes, np.frexp(len(own))[1])
            cutoffs[place] = max(cutoffs[place], order[-1])
            sketches.append(order)
            owners.append(np.full(len(order), item))
        sketch, owner = np.concatenate(sketches), np.concatenate(owners)
        by_hash = np.argsort(sketch, kind="stable")
        self.owner = owner[by_hash]
        self.keys, self.first = np.unique(sketch[by_hash], return_index=True)
        self.first = np.append(self.first, len(sketch))
        # Largest hash worth a look for a document that is large enough for the classes up to each one.
        self.cutoffs = np.maximum.accumulate(cutoffs)
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[(self.keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True

    def search(self, values: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) for every contaminated text."""
        counts = np.diff(first)
        reach = np.searchsorted(self.least, counts, "right")
        cutoff = np.where(reach > 0, self.cutoffs[np.maximum(reach, 1) - 1], np.uint64(0))
        order = _order(values)
        look = np.flatnonzero(self.bits[(order & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
        owner = np.searchsorted(first, look, "right") - 1
        look, owner = look[order[look] <= cutoff[owner]], owner[order[look] <= cutoff[owner]]
        at = np.minimum(np.searchsorted(self.keys, order[look]), len(self.keys) - 1)
        hit = self.keys[at] == order[look]
        pairs = {
            (int(text), int(item))
            for text, key in set(zip(owner[hit].tolist(), at[hit].tolist(), strict=True))
            for item in self.owner[self.first[key] : self.first[key + 1]]
        }
        text, own = -1, values[:0]
        for place, item in sorted(pairs):
            if place != text:
                text, own = place, np.unique(values[first[place] : first[place + 1]])
            wanted = self.sets[item]
            where = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            shared = int((own[where] == wanted).sum())
            if shared >= needed(len(wanted)):
                yield place, item, shared


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = texts.shingle_sets(batch.column(1))
        width = np.minimum(np.diff(texts.words(batch.column(1))[1]), texts.WIDTH)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(width, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["item_id", "width", "n", "shingles"],
        )


@functools.lru_cache(maxsize=1)
def _block(shipped: bytes, sizes: tuple[int, ...], widths: tuple[int, ...]) -> list[tuple[int, list[int], Items]]:
    """By width: the width, the items' places and the items."""
    sets = np.split(np.frombuffer(shipped, np.uint64), np.cumsum(sizes)[:-1])
    places = {width: [i for i, w in enumerate(widths) if w == width] for width in sorted(set(widths))}
    return [(width, own, Items([sets[i] for i in own])) for width, own in places.items()]


def _searcher(block, ids: list, id_type: pa.DataType):  # noqa: ANN001, ANN202
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width = _block(*block.value)
        for batch in batches:
            for part in texts.pieces(batch, "text"):
                words = texts.words(part.column(1))
                for width, places, items in by_width:
                    found = list(items.search(*texts.windows(*words, width, whole=False)))
                    if not found:
                        continue
                    rows, which, shared = (list(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[places[i]] for i in which], id_type),
                            part.column(0).take(pa.array(rows)),
                            pa.array([len(items.sets[i]) for i in which], pa.int64()),
                            pa.array(shared, pa.int64()),
                        ],
                        names=["item_id", "doc_id", "n_item_shingles", "n_shared"],
                    )

    return search


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, shingle) of the sketches of (item, shingles)."""
    for batch in batches:
        for item, shingles in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = shingles.values.to_numpy().view(np.uint64)
            least = own[np.argsort(_order(own), kind="stable")[: len(own) - needed(len(own)) + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(least), item)), pa.array(least.view(np.int64))], names=["item", "shingle"]
            )


def _bit(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (texts.mix(shingles) & np.uint64(bits - 1)).astype(np.int64)


def _set_bits(bits: int):  # noqa: ANN202
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.unique(_bit(batch.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(own)], names=["bit"])

    return places


def _table_of_bits(wanted: DataFrame, rows: int) -> np.ndarray:
    """A byte for eight bits, set where a shingle of (shingle) falls; a power of two of bits."""
    bits = min(MOST_BITS, 1 << max(15, (rows * BITS_A_SHINGLE).bit_length()))
    places = wanted.mapInArrow(_set_bits(bits), "bit long")
    maps = places.groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    # MOST_BITS / 8 bytes in all at most.
    for part, own in maps.collect():
        out[part << 12 : (part + 1) << 12] = np.frombuffer(own, np.uint8)
    return out


def _doc_shingles(widths: list[int], table):  # noqa: ANN001, ANN202
    """(doc_id, doc, shingle) of the distinct shingles of (doc_id, doc, text) that some item may have."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            for part in texts.pieces(batch, "text"):
                words = texts.words(part.column(2))
                for width in widths:
                    values, first = texts.windows(*words, width, whole=False)
                    place = _bit(values, len(bits) * 8)
                    may = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    owner = np.searchsorted(first, may, "right") - 1
                    owner, own = np.unique(np.stack((owner, values[may].view(np.int64))), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)), pa.array(own)], names=["doc_id", "doc", "shingle"]
                    )

    return held


def _joined(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The found pairs of `docs` (doc_id, text) and `sets` (item_id, width, n, shingles), by shuffle alone."""
    sets = written(sets.withColumn("item", F.monotonically_increasing_id()))
    wanted = sets.select("item", F.explode("shingles").alias("shingle"))
    bits = docs.sparkSession.sparkContext.broadcast(_table_of_bits(wanted.select("shingle"), wanted.count()))
    # Five widths at most.
    widths = sorted(r.width for r in sets.select("width").distinct().collect())
    # Rows of equal id and text hold the same.
    named = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text")
    every = named.mapInArrow(_doc_shingles(widths, bits), "doc_id long, doc long, shingle long")
    held = written(every.join(wanted.select("shingle").distinct(), "shingle", "left_semi").distinct())
    sketches = sets.select("item", "shingles").mapInArrow(_sketches, "item long, shingle long")
    pairs = written(held.join(sketches, "shingle").select("doc_id", "doc", "item").distinct())
    shared = pairs.select("doc", "item").distinct().join(wanted, "item").join(held.select("doc", "shingle").distinct(), ["doc", "shingle"])
    shared = shared.groupBy("doc", "item").agg(F.count("*").alias("n_shared"))
    found = pairs.join(shared, ["doc", "item"]).join(sets.select("item", "item_id", "n"), "item")
    found = found.filter(F.col("n_shared") * WHOLE >= F.col("n") * SHARE)
    return found.select("item_id", "doc_id", F.col("n").alias("n_item_shingles"), "n_shared")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, doc_id, n_item_shingles, n_shared, containment of every pair of `docs` (doc_id, text) and
    `items` (item_id, text) whose containment is at least 0.75."""
    spark = docs.sparkSession
    modest_batches(spark)
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sets = tests.mapInArrow(_item_sets, "item_id long, width long, n long, shingles array<long>").filter("n > 0")
    sets = written(sets)
    texts_only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "item_id long, doc_id long, n_item_shingles long, n_shared long"
    total = sets.agg(F.sum("n")).first()[0] or 0
    if not total:
        found = spark.createDataFrame([], schema)
    elif total <= BLOCK_SHINGLES:
        rows = sets.collect()
        values = np.concatenate([np.array(r.shingles, np.int64).view(np.uint64) for r in rows])
        sent = spark.sparkContext.broadcast((values.tobytes(), tuple(r.n for r in rows), tuple(r.width for r in rows)))
        found = texts_only.mapInArrow(_searcher(sent, [r.item_id for r in rows], pa.int64()), schema)
    else:
        found = _joined(texts_only, sets)
    best = found.groupBy("item_id", "doc_id").agg(F.max(F.struct(
        (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"), "n_item_shingles", "n_shared"
    )).alias("best"))
    return best.select("item_id", "doc_id", "best.n_item_shingles", "best.n_shared", "best.containment")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that no item contaminates, with all their columns."""
    bad = written(contaminated(docs, items).filter("doc_id IS NOT NULL").select("doc_id").distinct())
    return docs.join(bad, docs["doc_id"].cast("long") == bad["doc_id"], "left_anti")

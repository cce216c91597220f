"""Near-duplicate documents by MinHash with tensored banding.

A banded index needs many table keys per document, and as many minhash tuples. Here two small collections
of `COLLECTION` half-keys (each made of `ROWS` minhashes) are computed, and every pair of a half-key of the
first with one of the second is a table key: 16 x 16 = 256 tables of six minhashes each for 96 minhashes
instead of 1,536. A pair of similarity 0.75 meets in at least one table with probability
(1 - (1 - 0.75**3)**16)**2 = 0.9997.

Steps, each a Spark job over rows that are spread by hash:

1. one pass over the texts: set size, set identity, half-keys, parities;
2. equal sets become one class, represented by its least doc_id;
3. a half-key that only one class has cannot be part of a shared table key and is left out, then the
   remaining halves are combined;
4. first round: every class is compared with the most central class of each of its tables, which joins the
   bulk of a large group through few pairs;
5. second round: classes of tables that are not yet all in one component are compared in full across the
   components, in blocks of at most `BLOCK` rows a side. They meet by their shared half-keys of the first
   collection, a superset of the shared tables with far fewer rows, and a pair leaves a block only where it
   meets first and if it may link, so no candidate is lost and none is written twice;
6. a pair may link if its sizes allow it and if the parities of its shingles do: each set keeps, for `BITS`
   buckets, whether it has an odd number of shingles there. Common shingles cancel, so the number of buckets
   that differ is at most the number of shingles that only one side has, and no link is dropped;
7. what remains is decided on the full sets.

Defined results: null and wordless texts have an empty set and link with nothing; equal sets always link;
rows that repeat a doc_id count as one document; rows without a doc_id keep their set size, have no
component and are kept. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.components import components
from tidelog.llm.frames import modest_batches, only, packed, written

COLLECTION = 16
ROWS = 3
HASHES = 2 * COLLECTION * ROWS
BITS = 2048
BLOCK = 1024
# Similarity that links, as a ratio of whole numbers.
SHARED, WHOLE = 75, 100

_rng = np.random.Generator(np.random.PCG64(771))
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SLOT = _rng.integers(0, 2**63, 2 * COLLECTION, dtype=np.uint64)


def minhashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima; `first` holds each non-empty text's first place in `values`."""
    narrow = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), HASHES), np.uint32)
    work = np.empty_like(narrow)
    for k in range(HASHES):
        np.bitwise_xor(narrow, _XOR[k], out=work)
        np.multiply(work, _MUL[k], out=work)
        # The low bits of a product are weak; the high ones decide the order.
        out[:, k] = np.minimum.reduceat(work, first)
    return out


def half_keys(minima: np.ndarray) -> np.ndarray:
    """(texts, 2 * COLLECTION) half-keys, each of ROWS minhashes and its place."""
    parts = minima.reshape(len(minima), 2 * COLLECTION, ROWS).astype(np.uint64)
    keys = np.broadcast_to(_SLOT, parts.shape[:2]).copy()
    for row in range(ROWS):
        keys = texts.mix(keys ^ parts[:, :, row])
    return keys


def parities(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, BITS / 8) bytes: for every bucket of shingles, whether the set has an odd number in it."""
    bucket = (values >> np.uint64(20) & np.uint64(BITS - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)) * BITS, sizes)
    odd = np.bincount(owner + bucket, minlength=len(sizes) * BITS) & 1
    return np.packbits(odd.astype(bool).reshape(len(sizes), BITS), axis=1)


def may_link(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Which pairs of parities (as words of 64 bits) and set sizes allow a link; the arrays broadcast."""
    apart = np.bitwise_count(left ^ right).sum(-1, dtype=np.int64)
    both = n_left + n_right
    # |A & B| / |A | B| >= s with |A| + |B| = t and d shingles on one side only: (t - d) / (t + d) >= s.
    fits = (both - apart) * WHOLE >= (both + apart) * SHARED
    return fits & (np.minimum(n_left, n_right) * WHOLE >= np.maximum(n_left, n_right) * SHARED)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in texts.pieces(batch, "text"):
            sets = texts.shingle_sets(part.column(1))
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            keys = np.zeros((len(sets), 2 * COLLECTION), np.int64)
            parity = np.zeros((len(sets), BITS // 8), np.uint8)
            same = np.zeros((len(sets), 2), np.int64)
            if len(full):
                values = np.concatenate([sets[i] for i in full])
                first = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                minima = minhashes(values, first)
                keys[full] = half_keys(minima).view(np.int64)
                parity[full] = parities(values, sizes[full])
                mixed = texts.mix(values ^ np.uint64(0x5851F42D4C957F2D))
                same[full, 0] = np.add.reduceat(values, first).view(np.int64)
                same[full, 1] = np.add.reduceat(mixed, first).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(same[:, 0]),
                    pa.array(same[:, 1]),
                    pa.ListArray.from_arrays(
                        np.arange(0, keys.size + 1, 2 * COLLECTION, dtype=np.int32), pa.array(keys.ravel())
                    ),
                    pa.array([row.tobytes() for row in parity], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "halves", "parity"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    modest_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _signatures,
        "doc_id long, n_shingles long, set_a long, set_b long, halves array<long>, parity binary",
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in texts.pieces(batch, "text"):
            sets = texts.shingle_sets(part.column(1))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if len(sets) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(ends, pa.array(values))], names=["doc_id", "shingles"]
            )


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITS // 64)


def _fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = (batch.column(i).to_numpy() for i in (4, 5))
        yield batch.filter(pa.array(may_link(_bits(batch.column(2)), _bits(batch.column(3)), *sizes))).select([0, 1])


def _promising(pairs: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """Of `count` classes, distinct pairs (a, b) whose sizes and parities allow a link."""
    pairs = packed(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), count)
    side = nodes.select("doc_id", "n_shingles", "parity")
    both = packed(pairs.join(side.toDF("a", "n_a", "parity_a"), "a"), count)
    both = packed(both.join(side.toDF("b", "n_b", "parity_b"), "b"), count)
    return both.select("a", "b", "parity_a", "parity_b", "n_a", "n_b").mapInArrow(_fitting, "a long, b long")


def shingle_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in `ids`; only their texts are moved."""
    texts_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(only(texts_of, ids, "doc_id").mapInArrow(_sets, "doc_id long, shingles array<long>"))


def verified(pairs: DataFrame, docs: DataFrame, count: int) -> DataFrame:
    """The pairs (a, b) of `count` classes whose full shingle sets are similar enough."""
    pairs = written(packed(pairs, count))
    sets = shingle_rows(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))))
    both = packed(pairs.join(sets.toDF("a", "set_a"), "a"), count)
    both = packed(both.join(sets.toDF("b", "set_b"), "b"), count)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    sizes = F.size("set_a") + F.size("set_b")
    return written(
        both.select("a", "b", shared.alias("shared"), sizes.alias("sizes"))
        .filter(F.col("shared") * WHOLE >= (F.col("sizes") - F.col("shared")) * SHARED)
        .select("a", "b")
    )


def _tables(nodes: DataFrame, count: int) -> DataFrame:
    """Of `count` classes, (key, doc_id, weight) for every table key that at least two classes may share.

    The weight says how many classes share the document's half-keys: in a group of edited copies it is
    largest for the text the others were made from.
    """
    halves = nodes.select("doc_id", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("half").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    kept = halves.join(written(packed(shared.filter("low < high").select("half", "n"), count)), "half")
    first = F.col("slot") < COLLECTION
    by_doc = packed(kept, 4 * count).groupBy("doc_id").agg(
        F.collect_set(F.when(first, F.col("half"))).alias("firsts"),
        F.collect_set(F.when(~first, F.col("half"))).alias("seconds"),
        F.sum("n").alias("weight"),
    )
    combined = by_doc.select("doc_id", "weight", F.explode("firsts").alias("x"), "seconds").select(
        "doc_id", "weight", "x", F.explode("seconds").alias("y")
    )
    return combined.select(F.xxhash64("x", "y").alias("key"), "doc_id", "weight")


def _with_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return nodes.join(found, nodes.doc_id == found.node, "left").select(
        nodes["*"], F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text)."""
    rows = written(signatures(docs))
    count = rows.count()
    classes = (
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("class_id"))
    )
    classes = written(packed(classes, count))
    members = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b"], "left")
    members = written(packed(members, count))
    same_id = members.filter("class_id IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    heads = members.filter("class_id = doc_id").select("doc_id", "set_a", "set_b").distinct()
    nodes = rows.join(heads, ["doc_id", "set_a", "set_b"], "left_semi").select("doc_id", "n_shingles", "halves", "parity")
    nodes = written(packed(nodes, count))
    tables = packed(_tables(nodes, count), 4 * count)
    pivots = (
        tables.groupBy("key")
        .agg(
            F.max(F.struct("weight", -F.col("doc_id"))).alias("top"),
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
        )
        .filter("low < high")
        .select("key", (-F.col("top.col2")).alias("pivot"))
    )
    tables = written(packed(tables.drop("weight").join(written(packed(pivots, count)), "key"), 4 * count))
    stars = tables.filter("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))
    links = verified(_promising(stars, nodes, count), docs, count)
    slim = written(packed(_with_components(nodes, links), count))
    rest = verified(_across(slim, _open_classes(tables, slim, count), count).distinct(), docs, count)
    found = components(links.union(rest).union(same_id.filter("a <> b")))
    out = members.join(found, members.doc_id == found.node, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _open_classes(tables: DataFrame, slim: DataFrame, count: int) -> DataFrame:
    """(doc_id) of the classes in tables that hold classes of several components."""
    placed = tables.select("key", "doc_id").join(slim.select("doc_id", "component_id"), "doc_id")
    placed = written(packed(placed, 4 * count))
    mixed = placed.groupBy("key").agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
    mixed = written(packed(mixed.filter("low < high").select("key"), count))
    return packed(placed.join(mixed, "key", "left_semi"), 4 * count).select("doc_id")


def _across(slim: DataFrame, open_classes: DataFrame, count: int) -> DataFrame:
    """Pairs (a, b) of open classes that share a half-key of the first collection, are in different components
    and may link."""
    firsts = F.slice("halves", 1, COLLECTION).alias("firsts")
    rows = only(slim, open_classes, "doc_id").select("doc_id", "n_shingles", "component_id", "parity", firsts)
    rows = written(packed(rows, count))
    places = rows.select("doc_id", "component_id", F.posexplode("firsts").alias("slot", "half"))
    shared = places.groupBy("half").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high"), F.count("*").alias("rows")
    )
    shared = shared.filter("low < high").select("half", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    shared = written(packed(shared, count))
    own = places.drop("component_id").join(shared, "half").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "half", "slot", "doc_id", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("second"),
    )
    return (
        spread.join(rows, "doc_id")
        .select("half", "low", "high", "slot", "doc_id", "second", "component_id", "n_shingles", "parity", "firsts")
        .repartition("half", "low", "high")
        .sortWithinPartitions("half", "low", "high")
        .mapInArrow(_block_pairs, "a long, b long")
    )


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within every run of equal (half, low, high); a run has at most two blocks of rows."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if waiting and (keys[0] != [waiting[-1].column(i)[-1].as_py() for i in range(3)]).any():
            yield from _run_pairs(waiting)
            waiting = []
        for start, end in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            waiting.append(batch.slice(start, end - start))
            if end < len(batch):
                yield from _run_pairs(waiting)
                waiting = []
    if waiting:
        yield from _run_pairs(waiting)


def _run_pairs(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    if len(run) < 2:
        return
    low, high, slot = (run.column(i)[0].as_py() for i in (1, 2, 3))
    doc, component, size = (run.column(i).to_numpy() for i in (4, 6, 7))
    second = run.column(5).to_numpy(zero_copy_only=False)
    bits = _bits(run.column(8))
    firsts = run.column(9).flatten().to_numpy().reshape(len(run), COLLECTION)
    a, b = [], []
    for i in range(len(run)):
        # Of one block, every pair once; of two, those across.
        others = np.arange(i + 1, len(run)) if low == high else np.flatnonzero(second) if not second[i] else []
        if len(others):
            others = others[component[others] != component[i]]
            others = others[may_link(bits[i], bits[others], size[i], size[others])]
            others = others[(firsts[others] == firsts[i]).argmax(1) == slot]
            a.append(np.full(len(others), doc[i]))
            b.append(doc[others])
    if a and sum(map(len, a)):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

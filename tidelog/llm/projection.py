"""Near-duplicate embeddings by sorted projection passes.

Equal vectors are collapsed first. In a pass, every vector gets `KEY_BITS` random hashes, the sides of random planes
through the centre of its label, concatenated to one key. The vectors are range-sorted by label and key, and each is
compared with its next `window` to 2 * `window` neighbours in that order; where the order goes on in the next
partition, the rows on either side of the cut are compared as well. Verified pairs of all passes are united to
components, and the links of every component are then counted exactly.

A pair at angle a from the centre lies on the same side of a plane with probability p = 1 - a / pi. It is compared in
a pass if the two share the d hashes it takes until a vector's run of equal prefixes fits a window, so with
probability p ** d at least. The first pass measures d, and p for a pair at the threshold, at every vector that it
has found no link for, and sums (1 - p ** d) ** P over them for each P of `PASSES`. A label takes the first P for which
a share of `MISSED` at most is expected to miss. A label for which no P will do (its vectors lie so near one another
that keys don't spread them) is compared as a whole, in blocks; a label within one window needs one pass and misses
nothing.

Defined results: vectors that are null, zero or of non-finite or null components, and rows without a label,
link with nothing, as do vectors of different lengths. Rows that repeat a vec_id count as one vector for
components and as rows of their own otherwise; rows without a vec_id take no part and are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.components import components
from tidelog.llm.frames import written
from tidelog.session import broadcast_if_small, shuffle_width

LEAST = 0.93
MISSED = 0.02
KEY_BITS = 62
WINDOW = 1024
# Blocks of a label that is compared as a whole.
BLOCK = 4096
# How many passes a label may take.
PASSES = (1, 2, 3, 4, 6, 8, 11, 16, 23, 32, 45, 64)
# Passes that are sorted in one go; so many times the vectors lie on disk at once.
TOGETHER = 8


def unit_matrix(values: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; NaN for rows that are zero or hold a non-finite component."""
    values = values.astype(float)
    with np.errstate(all="ignore"):
        # Scaled first, so that the squares of large or tiny components stay finite.
        values = values / np.abs(values).max(1, initial=0, keepdims=True)
        return values / np.sqrt((values * values).sum(1, keepdims=True))


def _units(column: pa.Array, dims: np.ndarray) -> np.ndarray:
    """Unit rows of vectors without nulls, with zeros behind the shorter ones."""
    out = np.zeros((len(dims), dims.max(initial=0)))
    for size in np.unique(dims):
        rows = np.flatnonzero(dims == size)
        out[rows, :size] = unit_matrix(column.take(pa.array(rows)).flatten().to_numpy().reshape(-1, size))
    return out


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (row, label, vector) whose vectors can link, with the number of components."""
    for batch in batches:
        column = batch.column(2)
        dims = np.array(pc.fill_null(pc.list_value_length(column), 0))
        # A place for every component, null or not.
        whole = np.bincount(np.asarray(pc.list_parent_indices(column))[np.asarray(pc.is_null(column.flatten()))], minlength=len(batch)) == 0
        good = np.flatnonzero((dims > 0) & whole)
        kept = batch.take(pa.array(good))
        if len(kept):
            kept = kept.append_column("dims", pa.array(dims[good], pa.int32()))
            finite = np.isfinite(_units(kept.column(2), dims[good])).all(1)
            yield kept.take(pa.array(np.flatnonzero(finite)))


def _centre_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, dims, n, total) of the unit vectors of (row, label, vector, dims)."""
    for batch in batches:
        label, dims = batch["label"].to_numpy(), batch["dims"].to_numpy()
        units = _units(batch["vector"], dims)
        kinds, place = np.unique(np.stack((label, dims), 1), axis=0, return_inverse=True)
        sums = np.zeros((len(kinds), units.shape[1]))
        np.add.at(sums, place.ravel(), units)
        rows = [{"label": l, "dims": d, "n": n, "total": x[:d].tolist()} for (l, d), n, x in zip(kinds.tolist(), np.bincount(place.ravel()).tolist(), sums, strict=True)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("label", pa.int64()), ("dims", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))]))


def centres(vectors: DataFrame) -> DataFrame:
    """(label, dims, centre): the mean unit vector of a label's vectors of one length."""
    parts = vectors.mapInArrow(_centre_sums, "label long, dims int, n long, total array<double>")
    sums = parts.select("label", "dims", "n", F.posexplode("total").alias("place", "x"))
    means = sums.groupBy("label", "dims", "place").agg((F.sum("x") / F.sum("n")).alias("x"))
    listed = means.groupBy("label", "dims").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("centre"))
    return listed.select("label", "dims", F.transform("centre", lambda c: c["x"]).alias("centre"))


def _keys(first: int, last: int, fields: list[str]) -> Callable:
    """Rows of (row, label, vector, dims, passes, centre) for every pass they take part in, with key and distance from the centre."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            far = np.zeros(len(batch))
            dims, passes = batch["dims"].to_numpy(), batch["passes"].to_numpy()
            aside = {}
            for size in np.unique(dims):
                rows = np.flatnonzero(dims == size)
                aside[size] = _units(batch["vector"].take(pa.array(rows)), dims[rows])
                aside[size] -= batch["centre"].take(pa.array(rows)).flatten().to_numpy().reshape(-1, size)
                far[rows] = np.sqrt((aside[size] * aside[size]).sum(1))
            for number in range(first, min(last, passes.max(initial=0))):
                keys = np.zeros(len(batch), np.int64)
                for size, units in aside.items():
                    if (number, size) not in planes:
                        random = np.random.Generator(np.random.PCG64([number, int(size)]))
                        planes[number, size] = random.standard_normal((int(size), KEY_BITS))
                    keys[dims == size] = ((units @ planes[number, size]) > 0) @ (1 << np.arange(KEY_BITS - 1, -1, -1))
                own = pa.array(np.flatnonzero(passes > number))
                columns = [*(batch[c] for c in fields), pa.array(keys), pa.array(far), pa.array(np.full(len(batch), number, np.int32))]
                yield pa.RecordBatch.from_arrays([c.take(own) for c in columns], names=[*fields, "key", "far", "pass"])

    return add


def least_reachable(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the least one it is connected to by the links (left, right)."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[left], least[right])
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        least = np.minimum(least, least[least])
        if (least == before).all():
            return least


def _spanning(row: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links between places as one link of every linked row to the first one it is connected with."""
    left, right = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
    least = least_reachable(len(row), left, right)
    linked = np.flatnonzero(least != np.arange(len(row)))
    return row[linked], row[least[linked]]


class _Rows:
    """Sorted rows with their unit vectors."""

    COLUMNS = ("row", "label", "vector", "dims", "key", "far", "pass")

    def __init__(self, table: pa.Table):
        self.table = table
        self.row, self.label, self.dims, self.key, self.far, self.number = (table[c].to_numpy() for c in ("row", "label", "dims", "key", "far", "pass"))
        self.units = _units(table["vector"].combine_chunks(), self.dims)

    def __len__(self) -> int:
        return len(self.row)

    def near(self, other: _Rows) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked pairs of a row of the one and a row of the other."""
        # Vectors of different lengths have nothing in common.
        size = min(self.units.shape[1], other.units.shape[1])
        found = self.units[:, :size] @ other.units[:, :size].T >= LEAST
        i, j = np.nonzero(found)
        same = (self.label[i] == other.label[j]) & (self.dims[i] == other.dims[j]) & (self.number[i] == other.number[j])
        return i[same], j[same]


def _alike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many leading hashes two keys share."""
    return KEY_BITS - np.frexp((left ^ right).astype(float))[1]


def _misses(rows: _Rows, later: _Rows | None, earlier: _Rows | None, linked: np.ndarray) -> Iterator[dict]:
    """Per label: vectors, and for each number of passes how many of those without a link miss one, as expected."""
    depth = np.zeros(len(rows))
    # With the row that lies a window on (or back, at the end) a row shares a prefix that all in between have.
    start = 0
    for other in (later, earlier):
        end = min(len(rows), len(other)) if other is not None else 0
        part = slice(start, max(start, end))
        if part.stop > start:
            same = (rows.label[part] == other.label[part]) & (rows.dims[part] == other.dims[part])
            depth[part] = np.where(same, _alike(rows.key[part], other.key[part]) + 1, 0)
        start = part.stop
    with np.errstate(all="ignore"):
        turned = np.clip(1 - (1 - LEAST) / np.maximum(rows.far**2, 1e-12), -1, 1)
    seen = np.where(linked, 1.0, (1 - np.arccos(turned) / np.pi) ** depth)
    missed = (1 - seen)[:, None] ** np.array(PASSES)
    kinds, place = np.unique(np.stack((rows.label, rows.dims), 1), axis=0, return_inverse=True)
    sums = np.zeros((len(kinds), len(PASSES)))
    np.add.at(sums, place.ravel(), missed)
    for (label, dims), n, total in zip(kinds.tolist(), np.bincount(place.ravel()).tolist(), sums.tolist(), strict=True):
        yield {"label": label, "dims": dims, "n": n, "missed": total}


_PASS = "kind string, a long, b long, part int, label long, dims int, n long, missed array<double>, row long, vector {}, key long, far double, pass int, place long"


def _windows(window: int, measure: bool, kind: pa.DataType) -> Callable:
    """Over sorted rows: links (kind "link"), the rows at the partition's edges ("head", "tail") and, if asked for, expected misses."""
    schema = pa.schema(
        [("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("label", pa.int64()), ("dims", pa.int32()), ("n", pa.int64()),
         ("missed", pa.list_(pa.float64())), ("row", pa.int64()), ("vector", pa.list_(kind)), ("key", pa.int64()), ("far", pa.float64()), ("pass", pa.int32()), ("place", pa.int64())]
    )

    def made(n: int, name: str, columns: dict) -> pa.RecordBatch:
        columns = {"kind": pa.array([name] * n, pa.string()), **columns}
        return pa.RecordBatch.from_arrays(
            [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def links(pairs: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return made(len(pairs[0]), "link", {"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    def edge(name: str, rows: pa.Table, first: int) -> pa.RecordBatch:
        whole = rows.combine_chunks()
        columns = {c: whole[c].combine_chunks() for c in _Rows.COLUMNS}
        places = {"part": pa.array(np.full(len(rows), TaskContext.get().partitionId())), "place": pa.array(first + np.arange(len(rows)))}
        return made(len(rows), name, {**columns, **places})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier, before, linked, seen = None, None, None, 0
        for table in _blocks(batches, window):
            now = _Rows(table)
            if seen == 0:
                yield edge("head", table, 0)
            i, j = now.near(now)
            apart = i < j
            left, right = [i[apart]], [j[apart]]
            row = now.row
            mine = np.isin(np.arange(len(now)), np.concatenate((*left, *right)))
            if before is not None:
                i, j = before.near(now)
                linked[i], mine[j] = True, True
                if measure:
                    yield pa.RecordBatch.from_pylist([{"kind": "miss", **x} for x in _misses(before, now, earlier, linked)], schema)
                # Places of the block before come after those of this one.
                left.append(j)
                right.append(len(now) + i)
                row = np.concatenate((row, before.row))
            yield links(_spanning(row, left, right))
            held = [*held[-1:], table] if seen else [table]
            earlier, before, linked, seen = before, now, mine, seen + len(now)
        if seen:
            if measure:
                yield pa.RecordBatch.from_pylist([{"kind": "miss", **x} for x in _misses(before, None, earlier, linked)], schema)
            last = pa.concat_tables(held).combine_chunks()
            last = last.slice(max(0, len(last) - window))
            yield edge("tail", last, seen - len(last))

    return compare


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a partition, `size` at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while len(batch):
            take = min(size - sum(map(len, held)), len(batch))
            held.append(batch.slice(0, take))
            batch = batch.slice(take)
            if sum(map(len, held)) == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _edge_links(table: pa.Table) -> pa.Table:
    """Links between the last rows of one partition and the first of the next."""
    tail, head = (_Rows(table.filter(pc.equal(table["kind"], kind)).combine_chunks()) for kind in ("tail", "head"))
    if not len(tail) or not len(head):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    i, j = tail.near(head)
    a, b = _spanning(np.concatenate((tail.row, head.row)), [i], [len(tail) + j])
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def sorted_passes(
    vectors: DataFrame, centre: DataFrame, first: int, last: int, rows: int, window: int, measure: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of the passes from `first` to before `last` over `vectors` (row, label, vector, dims, passes), of
    which each takes part in its own number of passes, and their expected misses by label and passes."""
    fields = ["row", "label", "vector", "dims"]
    kind = vectors.schema["vector"].dataType.simpleString()
    keyed = vectors.select(*fields, "passes").join(broadcast_if_small(centre, written=True), ["label", "dims"]).select(*fields, "passes", "centre")
    keyed = keyed.mapInArrow(_keys(first, last, fields), f"row long, label long, vector {kind}, dims int, key long, far double, pass int")
    # A partition holds several windows, so that an edge lies between two of them.
    width = max(1, min(shuffle_width(vectors.sparkSession), (last - first) * rows // (8 * window)))
    order = ["pass", "label", "dims", "key", "row"]
    ranged = keyed.repartitionByRange(width, *order).sortWithinPartitions(*order)
    element = pa.float32() if kind == "array<float>" else pa.float64()
    out = written(ranged.mapInArrow(_windows(window, measure, element), _PASS.format(kind)))
    edges = out.filter("kind IN ('head', 'tail')")
    # At most a row a partition.
    parts = sorted(r.part for r in edges.select("part").distinct().collect())
    previous = out.sparkSession.createDataFrame([*zip(parts[1:], parts, strict=False)], "part int, before int")
    edge = F.when(F.col("kind") == "tail", F.col("part")).otherwise(F.col("before"))
    cut = edges.join(F.broadcast(previous), "part", "left").withColumn("edge", edge).filter("edge IS NOT NULL")
    over = cut.select("edge", "kind", *_Rows.COLUMNS).groupBy("edge").applyInArrow(_edge_links, "a long, b long")
    return out.filter("kind = 'link'").select("a", "b").union(over), out.filter("kind = 'miss'").select("label", "dims", "n", "missed")


def planned(misses: DataFrame) -> DataFrame:
    """(label, dims, passes): the fewest passes expected to miss MISSED of a label's vectors at most; null if none do."""
    sums = misses.groupBy("label", "dims").agg(F.sum("n").alias("n"), *(F.sum(F.get("missed", F.lit(i))).alias(f"m{i}") for i in range(len(PASSES))))
    passes = F.coalesce(*(F.when(F.col(f"m{i}") <= F.col("n") * MISSED, F.lit(n)) for i, n in enumerate(PASSES)))
    return sums.select("label", "dims", passes.alias("passes"))


def _label_links(table: pa.Table) -> pa.Table:
    """Of (row, vector, dims, own, low, high), rows of the blocks low and high of a label: who links across the two."""
    row, dims, own = (table[c].to_numpy() for c in ("row", "dims", "own"))
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    units = _units(table["vector"].combine_chunks(), dims)
    x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
    left, right = [], []
    for start in range(0, len(x), 512):
        i, j = np.nonzero(units[x[start : start + 512]] @ units[y].T >= LEAST)
        left.append(x[start + i])
        right.append(y[j])
    a, b = _spanning(row, left, right)
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _whole_labels(vectors: DataFrame, block: int) -> DataFrame:
    """Links (a, b) of labels that are compared as a whole, block against block."""
    blocks = vectors.groupBy("label", "dims").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = vectors.join(broadcast_if_small(blocks), ["label", "dims"]).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("label", "row", "vector", "dims", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return pairs.groupBy("label", "dims", "low", "high").applyInArrow(_label_links, "a long, b long")


def _block_counts(table: pa.Table) -> pa.Table:
    """(row, links) of the rows of side 0 with the rows of side 1, and their copies, in a pair of blocks of a component."""
    side = table["side"].to_numpy()
    row, label, dims, copies = (table[c].to_numpy() for c in ("row", "label", "dims", "copies"))
    units = _units(table["vector"].combine_chunks(), dims)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    found = []
    for start in range(0, len(left), 512):
        own = left[start : start + 512]
        near = units[own] @ units[right].T >= LEAST
        near &= (label[own][:, None] == label[right]) & (dims[own][:, None] == dims[right]) & (row[own][:, None] != row[right])
        found.append(near @ copies[right].astype(np.int64))
    return pa.table({"row": pa.array(row[left]), "links": pa.array(np.concatenate([np.zeros(0, np.int64), *found]))})


def _exact_counts(members: DataFrame, size: int) -> DataFrame:
    """(row, n_links) over all pairs within a component; `members` has component, row, label, dims, vector, copies."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    own = members.join(written(sizes), "component").withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["component", "row", "label", "dims", "vector", "copies"]
    left = own.withColumn("other", every).select(*columns, F.lit(0).alias("side"), F.col("own").alias("x"), F.col("other").alias("y"))
    right = own.withColumn("other", every).select(*columns, F.lit(1).alias("side"), F.col("other").alias("x"), F.col("own").alias("y"))
    counted = left.union(right).groupBy("component", "x", "y").applyInArrow(_block_counts, "row long, links long")
    return counted.groupBy("row").agg(F.sum("links").alias("n_links"))


def near_duplicate_vectors(embeddings: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `embeddings` (vec_id, embedding, label)."""
    # Components keep their type: double precision is for the products, not for what is moved.
    single = embeddings.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    kind = "array<float>" if single else "array<double>"
    rows = written(
        embeddings.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast(kind).alias("vector"),
        )
    )
    vectors = written(
        rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .select("row", "label", "vector")
        .mapInArrow(_usable, f"row long, label long, vector {kind}, dims int")
    )
    # Equal vectors are compared as one, that of the first row.
    alike = ["label", "dims", "vector"]
    distinct = written(vectors.groupBy(*alike).agg(F.min("row").alias("row"), F.count("*").alias("copies")))
    distinct = distinct.select("row", "label", "vector", "dims", "copies")
    several = distinct.filter("copies > 1").select(*alike, F.col("row").alias("first"))
    copies = written(vectors.join(broadcast_if_small(several), alike).filter("row <> first").select("row", "first"))
    vectors = distinct.select("row", "label", "vector", "dims")
    count = distinct.count()
    centre = written(centres(vectors))
    links, misses = sorted_passes(vectors.withColumn("passes", F.lit(1)), centre, 0, 1, count, window, measure=True)
    plan = broadcast_if_small(planned(misses))
    placed = written(vectors.join(plan, ["label", "dims"]).filter("passes IS NULL OR passes > 1"))
    most = placed.agg(F.max("passes")).first()[0] or 0
    for first in range(1, most, TOGETHER):
        rest = placed.filter(F.col("passes") > first)
        links = links.union(sorted_passes(rest, centre, first, min(first + TOGETHER, most), count, window)[0])
    links = links.union(_whole_labels(placed.filter("passes IS NULL").drop("passes"), block))
    ids = rows.select("row", "vec_id")
    pairs = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    by_row = components(pairs)
    members = distinct.join(by_row, distinct["row"] == by_row["node"]).select(
        F.col("component_id").alias("component"), "row", "label", "dims", "vector", "copies"
    )
    counts = _exact_counts(written(members), block)
    # What holds for a vector holds for its copies.
    known = distinct.select("row", "copies").join(counts, "row", "left").join(by_row, F.col("row") == by_row["node"], "left")
    known = written(known.select(
        "row", "copies", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "row").alias("group")
    ))
    firsts = broadcast_if_small(known.filter("copies > 1").select(F.col("row").alias("first"), "n_links", "group"))
    known = written(known.select("row", "n_links", "group").union(copies.join(firsts, "first").select("row", "n_links", "group")))
    # Components of rows, named by their least vec_id; rows that repeat a vec_id join their components.
    grouped = written(ids.join(known, "row", "left").select("row", "vec_id", F.coalesce("group", "row").alias("group")))
    named = grouped.groupBy("group").agg(F.min("vec_id").alias("least"))
    joined = written(grouped.filter("vec_id IS NOT NULL").join(written(named), "group").select("vec_id", "least"))
    final = components(joined, "vec_id", "least")
    out = ids.join(known.select("row", "n_links"), "row", "left").join(final, ids["vec_id"] == final["node"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )

"""Byte-level BPE by overlapping chunks.

Texts of more than `chunk` characters are cut into chunks that overlap by `overlap` characters and are dealt
out to tasks. Every chunk is pre-tokenised on its own. A pre-token is decided by what follows its start, so
as soon as two neighbouring chunks have a boundary at the same place in their overlap they agree from there
on: the text is stitched at the first such place and the pieces between the places are encoded. Chunks whose
overlap has no common boundary (a run of one kind of character longer than the overlap) are joined to one
piece. Ids are little-endian unsigned 32-bit integers in a binary column; decoding looks up the bytes of
each id and concatenates them.

Defined results: a null text is an empty text, with no ids; repeated rows and repeated or null doc_ids are
each encoded as they come, a row in, a row out. Further columns are not looked at.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.frames import modest_batches

CHUNK = 1 << 16
OVERLAP = 1 << 10
CACHE_TOKENS = 400_000
# Bytes up to which looking through all neighbours beats a heap.
SHORT = 64
NO_RANK = 1 << 60
ID_BITS = 24


class Ranks(dict):
    """Pre-token -> the bytes of its ids, filled on demand; at most CACHE_TOKENS are kept."""

    def __init__(self, raw: bytes, pattern: str):
        super().__init__()
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        # What two tokens give when they are put together, as far as that is a token.
        self.pairs = {
            a << ID_BITS | b: rank
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None
        }

    def __missing__(self, token: str) -> bytes:
        if len(self) >= CACHE_TOKENS:
            self.clear()
        found = self.merge(token.encode())
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(token) <= 64:
            self[token] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Join the neighbours of least rank, the leftmost first, until no neighbours have a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        return self._merge_short(piece) if len(piece) <= SHORT else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        """Looks through the ranks of all neighbours for the least one each time; a rank is an id."""
        rank_of = self.pairs.get
        ids = [self.bytes[b] for b in piece]
        waiting = [rank_of(a << ID_BITS | b, NO_RANK) for a, b in itertools.pairwise(ids)]
        while waiting and (least := min(waiting)) != NO_RANK:
            i = waiting.index(least)
            ids[i : i + 2] = [least]
            del waiting[i]
            if i < len(waiting):
                waiting[i] = rank_of(least << ID_BITS | ids[i + 1], NO_RANK)
            if i:
                waiting[i - 1] = rank_of(ids[i - 1] << ID_BITS | least, NO_RANK)
        return ids

    def _merge_long(self, piece: bytes) -> list[int]:
        """Keeps the ranked neighbours in a heap; parts that were merged meanwhile are passed over."""
        ranks = self.ranks
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        waiting = [
            (rank, i, parts[i] + parts[i + 1])
            for i in range(len(parts) - 1)
            if (rank := ranks.get(parts[i] + parts[i + 1])) is not None
        ]
        heapq.heapify(waiting)
        while waiting:
            _, i, joined = heapq.heappop(waiting)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j], after[i] = joined, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(parts)
                if right < len(parts) and (rank := ranks.get(parts[left] + parts[right])) is not None:
                    heapq.heappush(waiting, (rank, left, parts[left] + parts[right]))
        return [ranks[part] for part in parts if part is not None]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def _ranks(raw: bytes, pattern: str) -> Ranks:
    return Ranks(raw, pattern)


def _whole(sent):  # noqa: ANN001, ANN202
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(*sent.value)
        for batch in batches:
            for part in texts.pieces(batch, "text"):
                ids = [ranks.encode(text or "") for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return encode


def _cut(chunk: int, overlap: int):  # noqa: ANN202
    """Gives rows of (row, doc_id, chunk, last, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text = batch.column(2)[i].as_py()
                starts = range(0, len(text), chunk)
                for k, start in enumerate(starts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(i, 1),
                            batch.column(1).slice(i, 1),
                            pa.array([k], pa.int64()),
                            pa.array([k == len(starts) - 1]),
                            pa.array([text[start : start + chunk + overlap]]),
                        ],
                        names=["row", "doc_id", "chunk", "last", "text"],
                    )

    return cut


def _boundaries(sent, chunk: int, overlap: int):  # noqa: ANN001, ANN202
    """Adds the boundaries in the overlap with the chunk before (head) and behind (tail), counted alike."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _ranks(*sent.value).pattern
        for batch in batches:
            heads, tails = [], []
            for text, last in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True):
                starts = [m.start() for m in pattern.finditer(text)]
                heads.append([s for s in starts if s < overlap - 1])
                # What follows the chunk may still change a match that ends within its last two characters.
                tails.append([] if last else [s - chunk for s in starts if chunk <= s <= len(text) - 2])
            places = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, places), pa.array(tails, places)], names=[*batch.schema.names, "head", "tail"]
            )

    return find


def _pieces(sent, chunk: int):  # noqa: ANN001, ANN202
    """Encodes runs of (row, doc_id, run, begin, end, chunks): from `begin` in the first chunk to `end` in the
    last one's overlap."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(*sent.value)
        for batch in batches:
            ids = []
            for begin, end, chunks in zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True):
                parts = [c["text"] for c in chunks]
                text = "".join([*(p[:chunk] for p in parts[:-1]), parts[-1]])
                stop = len(text) if end is None else chunk * len(parts) + end
                out = []
                for match in ranks.pattern.finditer(text, begin):
                    if match.start() >= stop:
                        break
                    out.append(ranks[match.group()])
                ids.append(b"".join(out))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary())], names=["row", "doc_id", "run", "ids"])

    return encode


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [b"".join(p["ids"] for p in parts) for parts in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id and ids of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    modest_batches(spark)
    with open(ranks_path, "rb") as file:
        sent = spark.sparkContext.broadcast((file.read(), pattern))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long_text = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.filter(~long_text).mapInArrow(_whole(sent), "doc_id long, ids binary")
    chunks = (
        rows.filter(long_text)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(_cut(chunk, overlap), "row long, doc_id long, chunk long, last boolean, text string")
        .repartition("row", "chunk")
        .mapInArrow(
            _boundaries(sent, chunk, overlap),
            "row long, doc_id long, chunk long, last boolean, text string, head array<long>, tail array<long>",
        )
    )
    in_order = Window.partitionBy("row").orderBy("chunk")
    met = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(in_order))))
    runs = (
        chunks.withColumn("met", met)
        .withColumn("run", F.count("met").over(in_order))
        .groupBy("row", "doc_id", "run")
        .agg(F.max("met").alias("begin"), F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("chunks"))
    )
    ends = F.lead("begin").over(Window.partitionBy("row").orderBy("run"))
    encoded = runs.select("row", "doc_id", "run", "begin", ends.alias("end"), "chunks").mapInArrow(
        _pieces(sent, chunk), "row long, doc_id long, run long, ids binary"
    )
    stitched = (
        encoded.groupBy("row", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("run", "ids"))).alias("pieces"))
        .select("doc_id", "pieces")
        .mapInArrow(_joined, "doc_id long, ids binary")
    )
    return short.union(stitched)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`encoded` (doc_id, ids) with the bytes the ids stand for as `decoded`."""
    with open(ranks_path, "rb") as file:
        sent = encoded.sparkSession.sparkContext.broadcast((file.read(), pattern))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(*sent.value)
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                found = [ranks.decode(ids or b"") for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of rows of (doc_id, ids, decoded)."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def token_digests(
    docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The digests of every row of `docs` (doc_id, text), encoded and decoded again."""
    encoded = encode_documents(docs, ranks_path, pattern, chunk, overlap)
    return digests(decode_documents(encoded, ranks_path, pattern))

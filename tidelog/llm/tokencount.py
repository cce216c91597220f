"""Token counts of a word-level BPE vocabulary by rank-synchronous array merging.

The distinct pre-tokens of a batch that are not yet known are laid out as one ragged numpy array of symbols.
In every round each sequence finds its pair of least rank, and all sequences merge theirs at once, wherever
it occurs and from the left; sequences without a ranked pair are done. What remains is counted.

Defined results: null and empty texts have no tokens; strings of special tokens inside a text are one token
each, as the library's default takes them; every row is counted on its own, repeated or not, and a null
doc_id stays null. Further columns are not looked at.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts
from tidelog.llm.frames import modest_batches

CACHE_TOKENS = 400_000
_NONE = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """The parts of a tokenizer file that counting needs."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        ids = model["vocab"]
        self.size = len(ids)
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols])
        self.last = np.array([ids[s + suffix] for s in symbols])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.known: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def count(self, tokens: list[str]) -> np.ndarray:
        """Symbols left of every pre-token once all merges are done."""
        parts = [t.encode() for t in tokens]
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[data].astype(np.int64)
        symbols[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(parts)), sizes)
        counts = np.ones(len(parts), np.int64)
        while len(symbols):
            ranks = np.where(owner[:-1] == owner[1:], self.rank(symbols[:-1], symbols[1:]), _NONE)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(np.append(ranks, _NONE), starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            counts[owner[starts]] = lengths
            active = np.repeat(least < _NONE, lengths)
            if not active.any():
                break
            hit = (ranks == np.repeat(least, lengths)[:-1]) & (ranks < _NONE)
            # A pair of equal symbols may overlap the next one: of a run of hits every second one counts.
            run = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1])))
            place = np.arange(len(hit))
            began = np.repeat(run, np.diff(np.append(run, len(hit)))) if len(run) else place
            hit[len(hit) - len(began) :] &= (place[len(hit) - len(began) :] - began) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.made[ranks[at]]
            keep = active
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def pretokens(self, text: str) -> list[str]:
        if not text.isascii():
            # Each character is lowered for itself; str.lower() would look at the place of a capital sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def count_texts(self, batch: list[str]) -> list[int]:
        found, specials = [], []
        for text in batch:
            pieces = self.special.split(text) if "<|" in text else [text]
            specials.append(len(pieces) - 1)
            found.append([t for piece in pieces for t in self.pretokens(piece)] if len(pieces) > 1 else self.pretokens(text))
        new = list(set().union(*found).difference(self.known))
        if len(self.known) + len(new) > CACHE_TOKENS:
            self.known.clear()
            new = list(set().union(*found))
        if new:
            self.known.update(zip(new, self.count(new).tolist(), strict=True))
        return [n + sum(map(self.known.__getitem__, tokens)) for n, tokens in zip(specials, found, strict=True)]


@functools.lru_cache(maxsize=1)
def _merges(raw: bytes) -> Merges:
    return Merges(raw)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    modest_batches(spark)
    with open(tokenizer_path, "rb") as file:
        sent = spark.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(sent.value)
        for batch in batches:
            for part in texts.pieces(batch, "text"):
                sizes = np.diff(texts.text_bytes(part.column(1))[1])
                counts = merges.count_texts([text or "" for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

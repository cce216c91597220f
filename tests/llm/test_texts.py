"""Words and shingles against plain Python, and the curve and components against their definitions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD
from tidelog.llm import hilbert, texts
from tidelog.llm.components import components


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain_shingles(text):
    found = plain_words(text)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def column(rows):
    return pa.array([t for _, t in rows], pa.string())


@pytest.mark.parametrize("block", [8, 100, 1 << 20])
def test_words_are_cut_as_in_python(monkeypatch, block):
    monkeypatch.setattr(texts, "BLOCK_BYTES", block)
    monkeypatch.setattr(texts, "_powers", {})
    rows = [r for r in ODD if len(r[1] or "") < 3000]
    hashes, first = texts.words(column(rows))
    seen = {}
    for i, (_, text) in enumerate(rows):
        own = hashes[first[i] : first[i + 1]].tolist()
        assert len(own) == len(plain_words(text))
        for word, value in zip(plain_words(text), own, strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_have_the_right_sizes_and_overlaps():
    rows = [r for r in ODD if len(r[1] or "") < 3000]
    sets = texts.shingle_sets(column(rows))
    plain = [plain_shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(len(rows)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_a_sliced_column_gives_the_same_words():
    whole = column(ODD)
    hashes, first = texts.words(whole)
    part, start = texts.words(whole.slice(4, 5))
    assert part.tolist() == hashes[first[4] : first[9]].tolist() and start[-1] == len(part)


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_components_against_union_find(spark):
    random.seed(5)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 600)] + [(3, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

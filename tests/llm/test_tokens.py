"""Encoding and counting against the libraries, stitching included."""

import base64
import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tidelog.llm import bpe, tokencount

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

_rng = random.Random(4)
HARD = ODD + [
    (100, "\n\n  \n"), (101, "'s're 'LL it's"), (102, "İΣΑΣ Σ ß ﬁ é é"), (103, "<|startoftext|>abc<|endoftext|> <|x|>"),
    (104, "a" * 211), (105, " " * 70_000 + "b"), (106, "0" * 65_536 + " " * 2_000 + "q" * 7_000),
    (107, "".join(_rng.choice("ab  \n\t1!é") for _ in range(150_000))), (108, "a" * 65_530 + "\n\n\n\n\n\n\n\n\nb" * 400), (109, "it's\x85\x1c  z​"),
]


@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 1 << 10), (1000, 20)])
def test_ids_and_bytes_as_the_library(build, chunk, overlap):
    rows = HARD if chunk > 1000 else [(i, (t or "")[:9000]) for i, t in HARD]
    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.token_digests(build(rows), path, P.PATTERN, chunk, overlap).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_counts_as_the_library(build):
    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in HARD]
    got = [tuple(r) for r in tokencount.token_counts(build(HARD), path).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_documents(empty):
    assert bpe.token_digests(empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    assert tokencount.token_counts(empty, P.path("word_bpe_49k.json")).count() == 0


def test_a_full_cache_is_emptied(monkeypatch):
    with open(P.path("word_bpe_49k.json"), "rb") as file:
        merges = tokencount.Merges(file.read())
    once = merges.count_texts(["alpha beta", "gamma delta"])
    monkeypatch.setattr(tokencount, "CACHE_TOKENS", 2)
    assert merges.count_texts(["alpha beta", "gamma delta"]) == once

"""Near duplicates, decontamination and shards against brute force, odd rows included."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, sentence
from tests.llm.test_texts import plain_shingles
from tidelog.llm import decontaminate, hilbert, minhash


def edited(base, share, rng):
    return " ".join(f"e{rng.randrange(10**9)}" if rng.random() < share else w for w in base.split())


def some_copies(seed=3):
    rng = random.Random(seed)
    rows = [(100 + n, sentence(1000 * n, 120)) for n in range(40)]
    for n in range(200):
        rows.append((300 + n, edited(sentence(50_000, 150), 0.001 * (n % 60), rng)))
    for n in range(60):
        rows.append((600 + n, sentence(70_000, 60) + " " + sentence(100_000 + 100 * n, 90)))
    return rows + ODD


def brute_groups(rows):
    sets = [(i, plain_shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


def test_groups_of_near_copies(build):
    rows = some_copies()
    want = brute_groups(rows)
    got = minhash.near_duplicate_groups(build(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(plain_shingles(t))) for i, t in rows)


def test_small_blocks_find_the_same_groups(build, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = some_copies(9)
    want = brute_groups(rows)
    assert all(r.component_id == want.get(r.doc_id) for r in minhash.near_duplicate_groups(build(rows)).collect())


def test_parities_never_drop_a_link():
    import numpy as np

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[: 400 + 200 * (n % 10)], 300)) for n in range(60)]
    sizes = np.array([len(s) for s in sets])
    bits = minhash.parities(np.concatenate(sets), sizes).view(np.uint64).reshape(60, -1)
    for i in range(60):
        fits = minhash.may_link(bits[i], bits, sizes[i], sizes)
        for j in range(60):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 75 * (sizes[i] + sizes[j] - shared):
                assert fits[j]


def test_no_documents(empty):
    assert minhash.near_duplicate_groups(empty).count() == 0
    assert hilbert.shards(empty).count() == 0


def windows(text, width=None):
    """The distinct windows of a text, of its own width or a given one."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    width = min(5, len(words)) if width is None else width
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()


def test_contaminated_documents(spark, build):
    rng = random.Random(8)
    items = [(1, sentence(0, 30)), (2, sentence(40_000, 12)), (2, sentence(41_000, 12)), (3, "one two three"), (4, None), (5, ""), (None, sentence(0, 30)), (6, sentence(90_000, 80)), (7, "aa bb cc dd"), (8, "Z7")]
    rows = [(90, sentence(0, 300) + " aa BB\ncc dd " + sentence(400, 9)), (91, "aa bb cc"), *ODD]
    rows = rows + [(50 + n, edited(sentence(90_000, 80), 0.01 * n, rng) + " " + sentence(0, 30)) for n in range(15)]
    rows += [(80, sentence(40_000, 12)), (81, sentence(41_000, 10)), (82, " ".join(f"z{i}" for i in range(5000)) + " " + sentence(90_000, 80))]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = {}
    for item, text in items:
        own = windows(text)
        for doc, body in rows:
            shared = len(own & windows(body, min(5, len((text or "").split()))))
            if own and shared * 100 >= len(own) * 75:
                want[item, doc] = max(want.get((item, doc), 0), shared / len(own))
    got = {(r.item_id, r.doc_id): r.containment for r in decontaminate.contaminated(build(rows), table).collect()}
    assert got == want
    left = decontaminate.decontaminated(build(rows), table)
    bad = {d for _, d in want if d is not None}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows if i not in bad)
    assert left.columns == build(rows).columns


def test_items_in_several_blocks(spark, build, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 40)
    items = spark.createDataFrame([(n, sentence(1000 * n, 30)) for n in range(6)], "item_id long, text string")
    docs = build([(n, sentence(1000 * n, 200)) for n in range(10)])
    got = {(r.item_id, r.doc_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(n, n) for n in range(6)}


def test_items_beyond_a_block_are_joined_and_never_sent(spark, build, monkeypatch):
    table = spark.createDataFrame([(n % 25 or None, sentence(n * 7, 5 + n)) for n in range(30)] + [(90, "two words"), (91, None)], "item_id long, text string")
    rows = [(n, sentence(n * 5, 60)) for n in range(40)] + [(3, sentence(70, 80)), (None, sentence(0, 90)), (50, "two words"), (51, sentence(9000) + " Two words"), *ODD]
    docs = build([*rows, rows[0]])
    sent = sorted(map(str, decontaminate.contaminated(docs, table).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 40)
    monkeypatch.setattr(decontaminate, "_searcher", None)
    joined = decontaminate.contaminated(docs, table)
    assert sorted(map(str, joined.collect())) == sent and len(sent) > 40


def test_nothing_to_search(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(odd, none).count() == 0
    some = spark.createDataFrame([(1, sentence(0))], "item_id long, text string")
    assert decontaminate.contaminated(empty, some).count() == 0


@pytest.mark.parametrize("share", [0.001, 0.3])
def test_shards_are_even_and_gapless(build, monkeypatch, share):
    monkeypatch.setattr(hilbert, "PART_SHARE", share)
    rows = some_copies()
    got = hilbert.shards(build(rows)).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.cell))
    sizes = [len(slots[s]) for s in range(hilbert.SHARDS)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    along = []
    for s in range(hilbert.SHARDS):
        assert [x for x, _ in sorted(slots[s])] == list(range(sizes[s]))
        along += [c for _, c in sorted(slots[s])]
    assert along == sorted(along)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_written_shards(spark, build, tmp_path):
    """Repeated and null ids, and a column of the name the shards once had: each row lies in a shard whose ranges it is in."""
    docs = build([(n % 50 if n % 9 else None, sentence(n, 5 + n % 30)) for n in range(400)])
    ranges = {r.shard: r for r in hilbert.write_shards(docs, str(tmp_path / "out"), 10).collect()}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    cells = hilbert.quantised(back.withColumn("at", F.monotonically_increasing_id()), "at")
    shard = back.select("hilbert_shard", F.monotonically_increasing_id().alias("row"))
    for r in cells.join(shard, "row").collect():
        own = ranges[r.hilbert_shard]
        for dim in ("by_source", "by_lang", "by_size"):
            assert own[f"{dim}_low"] <= r[dim] <= own[f"{dim}_high"]
    assert {r.hilbert_shard: r["count"] for r in shard.groupBy("hilbert_shard").count().collect()} == {n: r.rows for n, r in ranges.items()}
    assert {r.rows for r in ranges.values()} == {40}
    # A reader that wants one source needs few files.
    assert any(r.by_source_low == r.by_source_high for r in ranges.values())

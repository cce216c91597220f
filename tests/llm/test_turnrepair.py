"""Repairs against a search over all paths, and the damage report against plain loops."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from tidelog.llm import turnrepair as repair

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(turns):
    """Least (cost, audit) over all edits of (initial, fault); paths leave the heap in that order."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(turns) and state in (0, 3):
            return cost, audit
        if (i, state) in seen:
            continue
        seen.add((i, state))
        heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[state]))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, NEXT[state]))
                if (state, initial) in KEPT:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, KEPT[state, initial]))
    raise AssertionError


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        inner = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not inner else "duplicate" if (role, text) in seen else None if inner[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def expected(rows):
    """The digest of one conversation's (turn, role, text), nulls as blanks."""
    rows = sorted(((t, r or (" " if r is None else ""), " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found = faults(rows)
    cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(rows, found, strict=True)])
    kept, left = [], iter(zip(rows, found, strict=True))
    for letter in audit:
        row = None if letter == "I" else next(left)[0]
        if letter == "K":
            kept.append((row[1], row[2]))
        elif letter != "D":
            last = kept[-1][0][:1] if kept else ""
            kept.append(("assistant" if last == "u" else "user", "" if row is None else row[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, cid string, part string, key string, place string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z", "0") for row in rows], SCHEMA)


def grouped(rows):
    out = {}
    for conv_id, *row in rows:
        out.setdefault(conv_id, []).append(tuple(row))
    return out


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \t", "\n.\n", "é?", None, "Yes.", "a\x00b."]
    for conv_id in conversations:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(texts) if rng.random() < 0.4 else f"Said {rng.random()}{rng.choice('.!? ,')}"
            yield conv_id, rng.choice([turn, turn, turn, turn + 2, None]), role, text


def test_paths_against_all_paths():
    rng = random.Random(11)
    names = [None, "blank", "duplicate", "truncated"]
    for _ in range(400):
        made = [[(rng.choice("suuaaax"), rng.choice([None, None, *names])) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 6))]
        flat = [turn for turns in made for turn in turns]
        turns = repair.Turns(np.array(["suax".index(i) for i, _ in flat]), np.array([names.index(f) for _, f in flat]))
        ends = np.cumsum([len(m) for m in made])
        parts = repair.Parts(turns, ends, np.tile(repair.AT_END, (len(made), 1)), np.ones(len(made), bool), rng.choice([1, 2, 3, 5, 100]))
        audits = [""] * len(made)
        for owner, letter, _, _ in parts.edits(np.zeros(len(made), np.int64)):
            for o, kind in zip(owner, letter, strict=True):
                audits[o] += repair.LETTERS[kind]
        assert audits == [cheapest(m)[1] for m in made]


def test_ranks_are_the_order_of_the_audits():
    rng = random.Random(4)
    initial, fault = np.array([rng.randrange(4) for _ in range(40)]), np.array([rng.choice([0, 0, 1, 2, 3]) for _ in range(40)])
    paths = repair.Paths(repair.Turns(initial, fault), np.array([40]), repair.AT_END[None], np.array([True]))
    audits = []
    for node in range(len(paths.rank)):
        audit = ""
        while not paths.stop[node]:
            audit, node = audit + repair.LETTERS[paths.letter[node]], paths.levels[0][node]
        audits.append(audit)
    assert [sorted(set(audits)).index(a) for a in audits] == paths.rank.tolist()


def test_digests_of_conversations_in_one_and_in_many_partitions(spark):
    rows = list(random_rows(5, [*range(60), None], 9)) + list(random_rows(6, [1000], 3000)) + [(7, 1, "user", "Same.")] * 300
    random.Random(1).shuffle(rows)
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair.repair_digests(table(spark, rows)).collect()}
    assert got == {conv_id: expected(turns) for conv_id, turns in grouped(rows).items()}


def test_damage_report_has_every_conversation(spark):
    rows = list(random_rows(8, [*range(200), None, 2**62, -5], 6)) + [(5000, 37, "user", "Gone")]
    left = grouped(damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair.damage_report(table(spark, rows)).collect()}
    assert got == {conv_id: expected(left[conv_id]) if conv_id in left else nothing for conv_id in grouped(rows)}
    assert any(value == nothing for value in got.values())


def test_repaired_turns_alternate(spark):
    rows = list(random_rows(9, range(50), 12))
    got = repair.repaired_turns(table(spark, rows)).collect()
    for conv_id in range(50):
        roles = [r.role[:1] for r in sorted((r for r in got if r.conv_id == conv_id), key=lambda r: r.place)]
        assert re.fullmatch("(s?(ua)+)?", "".join(roles))


@pytest.mark.parametrize("make", [repair.damage_report, repair.repair_digests, repair.repaired_turns])
def test_no_conversations(spark, make):
    assert make(spark.createDataFrame([], SCHEMA)).count() == 0

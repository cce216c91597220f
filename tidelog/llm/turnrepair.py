"""The cheapest repair of a conversation's turns: keep, rerole, delete and insert until its roles alternate.

Role initials must read `(s?(ua)+)?`. Keep costs nothing, a changed role 3, a deleted turn 4, an inserted empty
turn of user or assistant 3, a truncated turn that stays 3 more; blank and duplicate turns must be deleted. The
audit is the string of the edits' initials; of the cheapest ones the least in ASCII order counts.

The rule has four states (nothing yet, after a system, a user, an assistant turn), and a turn is a 4 x 4 matrix of
costs from state to state. Cost DP: products of these matrices (sum for product, least for sum) by prefix doubling give
the cost from every turn and state to the end, and with it the arcs that lie on cheapest paths. Prefix-doubling path
ranking: every node (a turn and a state) is ranked by its least audit of 1, 2, 4, 8, ... letters: the rank for
twice the letters comes from its own rank and the rank of the node that many letters on, whose pointer doubles
as well. By the ranks each node takes its least arc, and the doubled pointers of these arcs list the path.
All of it runs over many conversations at once as numpy arrays, `BLOCK` turns at a time.

Long conversations. Rows are range-partitioned and sorted by conversation and turn, so one that holds a third
of all rows lies in many partitions. At most one conversation goes on over each partition's end. For these, and
only these, three small tables with at most two rows a partition pass through the driver: the edges of the
partitions, the cost matrix of each part, and which state each part leads to. The parts are then repaired
where they lie. Within a partition, parts are cut at `BLOCK` turns and chained in the same way. What a task
holds is bounded by the rows of one conversation in one partition.

Order of turns: by turn, nulls first; of equal turns by the first 100 characters of role and text, then by a
digest of both. Defined results: null roles and texts are one blank; conv_id may be null, its rows are one
conversation; repeated rows are duplicate turns; a conversation without rows has no result here; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import modest_batches, written
from tidelog.session import broadcast_if_small, shuffle_width

BLOCK = 1 << 13
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LETTERS = np.array(["D", "I", "K", "R"])
DELETE, INSERT, KEEP, REROLE = range(4)
FAULTS = pa.array([None, "blank", "duplicate", "truncated"])
ROLES = pa.array([None, "user", "assistant"])
FAR = 1 << 40
# The state after an inserted or changed turn, and after a kept one by its initial (s, u, a, other; -1: not allowed).
NEXT = np.array([2, 2, 3, 2])
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
# What inserted turns cost at the end of a conversation, and between any two states.
AT_END = np.array([0, 6, 3, 0])
INSERTED = np.array([[0, FAR, 3, 6], [FAR, 0, 3, 6], [FAR, FAR, 0, 3], [FAR, FAR, 3, 0]])


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix products with least for sum and sum for product."""
    out = a[..., :, 0, None] + b[..., 0, None, :]
    for k in range(1, 4):
        np.minimum(out, a[..., :, k, None] + b[..., k, None, :], out=out)
    return np.minimum(out, FAR)


class Turns:
    """Initials (0 to 3 for s, u, a, other), faults (places of FAULTS) and what their edits cost."""

    def __init__(self, initial: np.ndarray, fault: np.ndarray):
        self.initial, self.fault = initial, fault
        stays = np.where((fault == 1) | (fault == 2), FAR, np.where(fault == 3, 3, 0))
        self.after = np.empty((len(fault), 4, 4), np.int64)
        self.after[:, DELETE] = np.arange(4)
        self.after[:, INSERT] = self.after[:, REROLE] = NEXT
        kept = KEPT[:, initial].T
        self.after[:, KEEP] = np.maximum(kept, 0)
        self.price = np.empty((len(fault), 4, 4), np.int64)
        self.price[:, DELETE], self.price[:, INSERT] = 4, 3
        self.price[:, KEEP] = np.where(kept < 0, FAR, stays[:, None])
        self.price[:, REROLE] = np.minimum(stays + 3, FAR)[:, None]

    def __len__(self) -> int:
        return len(self.fault)

    def part(self, start: int, end: int) -> Turns:
        return Turns(self.initial[start:end], self.fault[start:end])

    def matrices(self) -> np.ndarray:
        """Costs from the state before a turn to that after it, turns inserted before it included."""
        own = np.full((len(self), 4, 4), FAR)
        rows, states = np.arange(len(self))[:, None], np.arange(4)
        for letter in (DELETE, KEEP, REROLE):
            place = rows, states, self.after[:, letter]
            own[place] = np.minimum(own[place], self.price[:, letter])
        return min_plus(np.broadcast_to(INSERTED, own.shape), own)

    def product(self) -> np.ndarray:
        """The matrix of all turns, by halving."""
        m = self.matrices()
        while len(m) > 1:
            odd = m[len(m) // 2 * 2 :]
            m = np.concatenate((min_plus(m[:-1:2], m[1::2]), odd))
        return m[0]


def _ranked(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].reshape(pairs.shape)


def _doubled(step: np.ndarray) -> Iterator[np.ndarray]:
    """Pointers one, two, four, ... steps on, until all stand still."""
    while True:
        yield step
        further = step[step]
        if (further == step).all():
            return
        step = further


class Paths:
    """Cheapest and least paths through parts of conversations.

    `ends` are the parts' ends among the turns, `behind` what the four states cost behind each part, and `final`
    whether the conversation ends there.
    """

    def __init__(self, turns: Turns, ends: np.ndarray, behind: np.ndarray, final: np.ndarray):
        starts = np.concatenate(([0], ends[:-1]))
        part = np.repeat(np.arange(len(ends)), ends - starts)
        # Every part has one place more than turns: its end.
        place, end = np.arange(len(turns)) + part, ends + np.arange(len(ends))
        self.turn = np.full(len(turns) + len(ends), -1)
        self.turn[place] = np.arange(len(turns))
        self.part = np.insert(part, ends, np.arange(len(ends)))
        cost = self._costs(turns, ends[part], behind[part], behind, place, end)
        price = np.full((len(cost), 4, 4), FAR)
        price[place] = turns.price
        price[end[final], INSERT] = 3
        after = np.broadcast_to(np.where(np.arange(4)[:, None] == INSERT, NEXT, 0), price.shape).copy()
        after[place] = turns.after
        on = np.ones(price.shape[:2], np.int64)
        on[:, INSERT] = 0
        target = np.minimum(np.arange(len(cost))[:, None] + on, len(cost) - 1)[:, :, None] * 4 + after
        best = price + cost.ravel()[target] == cost[:, None, :]
        self.first = (starts + np.arange(len(ends))) * 4
        self._rank(best.transpose(0, 2, 1).reshape(-1, 4), target.transpose(0, 2, 1).reshape(-1, 4))
        self.cost = cost.ravel()[self.first]

    @staticmethod
    def _costs(turns, end, behind_turn, behind, place, end_place) -> np.ndarray:  # noqa: ANN001
        """(places, states): cost to the end; the matrices of 1, 2, 4, ... turns reach the end of the part."""
        m, at, width = turns.matrices(), np.arange(len(turns)), 1
        while len(inner := np.flatnonzero(at + width < end)):
            m[inner] = min_plus(m[inner], m[inner + width])
            width *= 2
        cost = np.empty((len(turns) + len(behind), 4), np.int64)
        cost[place] = (m + behind_turn[:, None, :]).min(2)
        cost[end_place] = behind
        return cost

    def _rank(self, best: np.ndarray, target: np.ndarray) -> None:
        nodes = np.arange(len(best))
        self.stop = ~best.any(1)
        # A letter leads from a state to one other, so the arcs of a node differ in their letters.
        least = np.where(self.stop, nodes, target[nodes, best.argmax(1)])
        rank = np.where(self.stop, 0, best.argmax(1) + 1)
        for ahead in _doubled(least):
            rank = _ranked(rank * (rank.max() + 1) + rank[ahead])
        self.rank = rank
        arcs = np.where(best, np.arange(4) * (rank.max() + 1) + rank[target], FAR)
        self.letter = arcs.argmin(1)
        self.levels = list(_doubled(np.where(self.stop, nodes, target[nodes, self.letter])))

    def left_in(self) -> np.ndarray:
        """(parts, 4): the state at the end of the part, by the state at its start."""
        return self.levels[-1][self.first[:, None] + np.arange(4)] % 4

    def listed(self, entered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(part, letter, turn or -1, state after) of all edits in order, from the states the parts are entered in."""
        path = self.first + entered
        for ahead in reversed(self.levels):
            both = np.stack((path, ahead[path]), 1).ravel()
            path = both[~self.stop[both]]
        letter = self.letter[path]
        turn = np.where(letter == INSERT, -1, self.turn[path // 4])
        return self.part[path // 4], letter, turn, self.levels[0][path] % 4


class Parts:
    """Parts of conversations of any length, repaired in blocks; `entered` has the states they are entered in."""

    def __init__(self, turns: Turns, ends: np.ndarray, behind: np.ndarray, final: np.ndarray, block: int = BLOCK):
        self.turns = turns
        cuts, owner = [], []
        for i, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
            inner = list(range(start + block, end, block))
            cuts += [*inner, end]
            owner += [i] * (len(inner) + 1)
        self.cuts, self.owner = np.array(cuts), np.array(owner)
        last = np.append(self.owner[1:] != self.owner[:-1], True)
        self.behind, self.final = behind[self.owner].copy(), final[self.owner] & last
        for i in np.flatnonzero(~last)[::-1]:
            later = turns.part(self.cuts[i], self.cuts[i + 1]).product()
            self.behind[i] = (later + self.behind[i + 1]).min(1)
        self.block = block

    def solved(self) -> Iterator[tuple[np.ndarray, np.ndarray, Paths]]:
        """(owners, first turn, paths) block by block."""
        start = 0
        while start < len(self.cuts):
            low = self.cuts[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(self.cuts, low + self.block, "right")))
            inner = self.turns.part(low, self.cuts[end - 1])
            yield self.owner[start:end], low, Paths(inner, self.cuts[start:end] - low, self.behind[start:end], self.final[start:end])
            start = end

    def left_in(self, parts: int) -> np.ndarray:
        out = np.broadcast_to(np.arange(4), (parts, 4)).copy()
        for owners, _, paths in self.solved():
            for owner, left in zip(owners, paths.left_in(), strict=True):
                out[owner] = left[out[owner]]
        return out

    def edits(self, entered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, letter, turn or -1, state after) of all edits in order, block by block."""
        now = entered.copy()
        for owners, low, paths in self.solved():
            states = np.empty(len(owners), np.int64)
            for i, (owner, left) in enumerate(zip(owners, paths.left_in(), strict=True)):
                states[i], now[owner] = now[owner], left[now[owner]]
            piece, letter, turn, after = paths.listed(states)
            yield owners[piece], letter, np.where(turn < 0, -1, turn + low), after


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a partition, never cut within a conversation (column cid)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        same = np.asarray(pc.equal(batch["cid"], batch["cid"][len(batch) - 1]))
        cut = int(same.argmax())
        if held and (cut or held[-1]["cid"][len(held[-1]) - 1] != batch["cid"][0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before it; nulls are alike."""
    n = len(column)
    same = pc.equal(column.slice(1), column.slice(0, n - 1))
    nulls = pc.and_(pc.is_null(column.slice(1)), pc.is_null(column.slice(0, n - 1)))
    return ~np.asarray(pc.or_(pc.fill_null(same, False), nulls).combine_chunks()).astype(bool)


def _turns(table: pa.Table, before: dict) -> tuple[Turns, np.ndarray]:
    """The turns of a table and the ends of its parts; `before` has key and turn of what lies before a partition."""
    changed = np.flatnonzero(_changes(table["cid"])) + 1
    again = np.concatenate(([False], ~(_changes(table["key"]) | _changes(table["turn"]))))
    again[0] = before.get(table["part"][0].as_py()) == (table["key"][0].as_py(), table["turn"][0].as_py())
    again |= np.asarray(table["earlier"].combine_chunks())
    blank, cut = (np.asarray(table[c].combine_chunks()) for c in ("blank", "cut"))
    fault = np.where(blank, 1, np.where(again, 2, np.where(cut, 3, 0)))
    return Turns(table["initial"].to_numpy().astype(np.int64), fault), np.append(changed, len(table))


def _names(table: pa.Table, ends: np.ndarray) -> list[tuple[int, str]]:
    """(partition, conversation) of every part."""
    firsts = pa.array(np.concatenate(([0], ends[:-1])))
    return list(zip(table["part"].take(firsts).to_pylist(), table["cid"].take(firsts).to_pylist(), strict=True))


_NARROW = ("part", "cid", "turn", "key", "earlier", "initial", "blank", "cut")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """The turns in order, dealt to partitions by ranges, with what the repair must know of each."""
    cid = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), cid.alias("cid"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        F.monotonically_increasing_id().alias("row"),
    )
    digest = F.unhex(F.sha2(F.concat_ws("\0", "cid", F.length("role"), "role", "text"), 256))
    rows = rows.withColumn("key", digest)
    # Turns that say again what an earlier turn said: the keys of several turns, and their first turn.
    places = rows.groupBy("key").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.max(F.col("turn").isNull()).alias("nameless")
    )
    several = places.filter("least < most OR nameless AND least IS NOT NULL").select("key", "least", "nameless")
    rows = rows.join(broadcast_if_small(several), "key", "left")
    earlier = F.coalesce((F.col("nameless") & F.col("turn").isNotNull()) | (F.col("turn") > F.col("least")), F.lit(False))
    stripped = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = rows.select(
        "cid", "conv_id", "turn", "role", "text", "key", "row", earlier.alias("earlier"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.substring(F.concat_ws("\0", "role", "text"), 1, 100).alias("head"),
    )
    order = [F.col("cid"), F.col("turn").asc_nulls_first(), F.col("head"), F.col("key"), F.col("row")]
    dealt = rows.repartitionByRange(shuffle_width(conversations.sparkSession), *order).sortWithinPartitions(*order)
    return written(dealt.drop("head", "row").withColumn("part", F.spark_partition_id()))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: list[pa.RecordBatch] = []
    for batch in batches:
        if len(batch):
            ends = [*ends[:1], batch.slice(0, 1), batch.slice(len(batch) - 1)]
            ends = [ends[0], ends[-1]]
    yield from ends


class Carry:
    """What the parts of conversations that go on over partitions' ends must know of one another."""

    def __init__(self, ordered: DataFrame):
        self.before: dict = {}
        self.parts: dict[str, list[int]] = {}
        edges = ordered.select("part", "cid", "turn", "key")
        edges = sorted(edges.mapInArrow(_edges, edges.schema).groupBy("part").agg(F.collect_list(F.struct("cid", "key", "turn")).alias("ends")).collect())
        for (low, low_ends), (high, high_ends) in zip(edges, edges[1:], strict=False):
            last, first = low_ends[-1], high_ends[0]
            if last.cid == first.cid:
                self.parts.setdefault(last.cid, [low]).append(high)
                self.before[high] = (bytes(last.key), last.turn)
        # (partition, conversation) -> costs behind the part, the state it is entered in
        self.behind: dict = {}
        self.entered: dict = {}
        if self.parts:
            self._matrices(self.only(ordered))
            self._states(self.only(ordered))

    def only(self, ordered: DataFrame) -> DataFrame:
        """Rows of conversations that lie in several partitions: at most one for each end of a partition."""
        return ordered.filter(F.col("cid").isin(list(self.parts)))

    def rest(self, ordered: DataFrame) -> DataFrame:
        return ordered.filter(~F.col("cid").isin(list(self.parts)))

    def _matrices(self, rows: DataFrame) -> None:
        before = self.before

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _whole_parts(batches):
                turns, ends = _turns(table, before)
                for (part, cid), start, end in zip(_names(table, ends), [0, *ends], ends, strict=False):
                    costs = turns.part(start, end).product().ravel().tolist()
                    yield pa.RecordBatch.from_pylist([{"part": part, "cid": cid, "m": costs}])

        found = {(r.part, r.cid): np.array(r.m).reshape(4, 4) for r in rows.select(*_NARROW).mapInArrow(products, "part long, cid string, m array<long>").collect()}
        for cid, parts in self.parts.items():
            behind = AT_END
            for part in reversed(parts):
                self.behind[part, cid] = behind
                behind = (found[part, cid] + behind).min(1)

    def _states(self, rows: DataFrame) -> None:
        before, behind, last = self.before, self.behind, {cid: parts[-1] for cid, parts in self.parts.items()}

        def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _whole_parts(batches):
                turns, ends = _turns(table, before)
                names = _names(table, ends)
                parts = Parts(turns, ends, np.array([behind[n] for n in names]), np.array([last[c] == p for p, c in names]))
                for (part, cid), left in zip(names, parts.left_in(len(ends)).tolist(), strict=True):
                    yield pa.RecordBatch.from_pylist([{"part": part, "cid": cid, "left": left}])

        found = {(r.part, r.cid): r.left for r in rows.select(*_NARROW).mapInArrow(states, "part long, cid string, left array<long>").collect()}
        for cid, parts in self.parts.items():
            state = 0
            for part in parts:
                self.entered[part, cid] = state
                state = found[part, cid][state]


EDITS = "cid string, conv_id long, part int, place long, edit string, fault string, turn long, role string, new_role string, text string"


def _edits(rows: DataFrame, carry: Carry) -> DataFrame:
    before, behind, entered = carry.before, carry.behind, carry.entered
    last = {cid: parts[-1] for cid, parts in carry.parts.items()}

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_parts(batches):
            turns, ends = _turns(table, before)
            names = _names(table, ends)
            starts = np.concatenate(([0], ends[:-1]))
            costs = np.array([behind.get(name, AT_END) for name in names])
            parts = Parts(turns, ends, costs, np.array([last.get(cid, part) == part for part, cid in names]))
            listed = np.zeros(len(ends), np.int64)
            for owner, letter, turn, after in parts.edits(np.array([entered.get(name, 0) for name in names])):
                n = np.bincount(owner, minlength=len(ends))
                place = np.arange(len(owner)) - np.searchsorted(owner, owner) + listed[owner]
                listed += n
                for low in range(0, len(owner), 1000):
                    some = slice(low, low + 1000)
                    own, kind = pa.array(starts[owner[some]]), letter[some]
                    at, none = np.maximum(turn[some], 0), turn[some] < 0
                    source, deleted = pa.array(at, mask=none), kind == DELETE
                    changed = np.where((kind == INSERT) | (kind == REROLE), after[some] - 1, 0)
                    role = table["role"].take(source).combine_chunks()
                    new = pc.coalesce(ROLES.take(pa.array(changed)), pc.if_else(pa.array(kind == KEEP), role, None))
                    text = pc.if_else(pa.array(none), "", table["text"].take(pa.array(at, mask=none | deleted)).combine_chunks())
                    columns = [
                        table["cid"].take(own).combine_chunks(), table["conv_id"].take(own).combine_chunks(), table["part"].take(own).combine_chunks(),
                        pa.array(place[some]), pa.array(LETTERS[kind]), FAULTS.take(pa.array(np.where(none, 0, turns.fault[at]))),
                        table["turn"].take(source).combine_chunks(), role, new, text,
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in EDITS.split(", ")])

    return rows.mapInArrow(edit, EDITS)


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All edits of all conversations, in the order (part, place) within each: those of conversations that lie in one
    partition, ordered there, and those of conversations that lie in several.

    edit (D, I, K, R), fault, turn, role, and of turns that stay new_role and text. The repaired conversation is what
    has a new_role.
    """
    modest_batches(conversations.sparkSession)
    ordered = ordered_turns(conversations)
    carry = Carry(ordered)
    return _edits(carry.rest(ordered), carry), _edits(carry.only(ordered), carry)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations; places ascend but need not be gapless."""
    whole, split = repair_conversations(conversations)
    place = F.shiftleft(F.col("part").cast("long"), 40) + F.col("place")
    return whole.union(split).filter("new_role IS NOT NULL").select("conv_id", place.alias("place"), F.col("new_role").alias("role"), "text")


class _Digest:
    def __init__(self, cid: str, conv_id: int | None):
        self.cid, self.conv_id = cid, conv_id
        self.audit, self.sha, self.kept = [], hashlib.sha256(), False
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.least = self.most = self.initial = None
        self.turns = 0

    def add(self, edit, fault, turn, role, new_role, text) -> None:  # noqa: ANN001
        self.audit.append(edit)
        self.counts["cost"] += {"K": 0, "D": 4}.get(edit, 3) + 3 * (fault == "truncated" and edit != "D")
        if fault:
            self.counts[fault] += 1
        if edit != "I":
            if turn is not None:
                self.least = turn if self.least is None else self.least
                self.turns += turn != self.most
                self.most = turn
            self.counts["illegal"] += self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au")
            self.initial = role[:1]
        if new_role is not None:
            self.sha.update((("\n" if self.kept else "") + new_role + ":" + text).encode())
            self.kept = True

    def row(self) -> dict:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        out = {"cid": self.cid, "conv_id": self.conv_id, "gaps": gaps, **self.counts}
        return out | {"audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}


_DIGEST = pa.schema([("cid", pa.string()), *((c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, whose edits follow one another."""
    now, done = None, []
    for batch in batches:
        columns = batch.to_pydict()
        for cid, conv_id, *edit in zip(*(columns[c] for c in ("cid", "conv_id", "edit", "fault", "turn", "role", "new_role", "text")), strict=True):
            if now is None or now.cid != cid:
                if now:
                    done.append(now.row())
                now = _Digest(cid, conv_id)
            now.add(*edit)
        if len(done) > 1000:
            yield pa.RecordBatch.from_pylist(done, _DIGEST)
            done = []
    if now:
        yield pa.RecordBatch.from_pylist([*done, now.row()], _DIGEST)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """cid, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    An audit and a digest over a whole conversation are one value each, so the edits of one that lies in several
    partitions are sorted into one task and read there row by row.
    """
    whole, split = repair_conversations(conversations)
    kinds = "cid string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    gathered = split.repartition("cid").sortWithinPartitions("cid", "part", "place")
    return whole.mapInArrow(_digests, kinds).union(gathered.mapInArrow(_digests, kinds))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with damage by crc32(conv_id:turn) % 20: 0 gone, 1 without text, 2 without its marks, 3 twice, 4 said by user."""
    def or_blank(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", or_blank("conv_id"), or_blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", or_blank("role").alias("role"), or_blank("text").alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def damage_report(conversations: DataFrame) -> DataFrame:
    """Digests of the repair of damaged conversations, for every conv_id there was before."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    ids = ids.withColumn("cid", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    found = ids.join(repair_digests(damaged(conversations)).drop("conv_id"), "cid", "left").drop("cid")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna({"audit": "", "repaired_sha256": nothing})

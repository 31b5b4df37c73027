"""Broken conversations repaired at the least cost by an online Viterbi search with coalescing survivors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK_CHARACTERS = " \t\n\x0b\f\r"
SENTENCE_ENDS = (".", "!", "?")
ROLES = ("user", "assistant")

EDITS = ("insert", "keep", "rerole", "delete")
INSERT, KEEP, REROLE, DELETE = range(4)
LETTERS = "IKRD"
COSTS = (5, 0, 1, 2)
TRUNCATED_COST = 5
FAULTS = (None, "blank", "duplicate", "truncated")
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

# where a conversation stands: nothing kept yet, after a system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

# an edit is written as its letter, moved on by the fault of its turn
FAULT_OFFSET = (0, 32, 64, 96)
# settled edits leave the search in pieces of this many
PIECE = 1 << 20


def _moves(initial: str, fault: int) -> list[list[tuple[int, int, str]]]:
    """For each state after a turn: ``(state before, cost, edits)``, the best edits between each two states.

    Edits are up to two inserts and one for the turn. Between the same two states the
    cheapest wins, of equal ones the least in ASCII.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in STATES:
        at, paid, letters = before, 0, ""
        for _ in range(3):
            turns = [(at, COSTS[DELETE], "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED_COST if fault == TRUNCATED else 0
                turns.append((_AFTER[at], COSTS[REROLE] + extra, "R"))
                if initial == "s" and at == START:
                    turns.append((SYSTEM, extra, "K"))
                if (initial, _AFTER[at]) in (("u", USER), ("a", ASSISTANT)):
                    turns.append((_AFTER[at], extra, "K"))
            for after, cost, letter in turns:
                found = (paid + cost, letters + letter)
                best[before, after] = min(best.get((before, after), found), found)
            at, paid, letters = _AFTER[at], paid + COSTS[INSERT], letters + "I"
    return [[(b, *best[b, after]) for b in STATES if (b, after) in best] for after in STATES]


_MOVES = {(initial, fault): _moves(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}
# inserts that bring a state to the end of a sound conversation
_ENDS = {START: (0, ""), SYSTEM: (10, "II"), USER: (5, "I"), ASSISTANT: (0, "")}


class _Branch:
    """A stretch of the backpointer tree without a fork: its edits, and the branches that go on from it."""

    __slots__ = ("edits", "kids", "parent")

    def __init__(self, parent: _Branch | None):
        self.parent, self.kids, self.edits = parent, [], bytearray()
        if parent is not None:
            parent.kids.append(self)


class Search:
    """Cheapest edits of one conversation, turn by turn; of equal cost the least in ASCII.

    Every state keeps one survivor, the best way to it, as a leaf of a tree of
    backpointers. A branch goes when no survivor is left beyond it; a fork with one way
    left is joined to it, so there are seven branches at most. What lies before the
    first fork is common to all survivors: it is settled and can be taken away at any
    time. Memory is that of the edits beyond the fork, a byte for each survivor.

    Ties are decided by the whole unresolved edits. Their order is carried as the rank
    of each survivor: after a turn no survivor's edits begin with those of another (both
    hold as many turns and end in one), so whatever follows leaves the order as it is,
    and two ways from one survivor differ in what they add.
    """

    def __init__(self) -> None:
        self.root = _Branch(None)
        # per state: cost, rank, leaf
        self.survivors: list[tuple[int, int, _Branch] | None] = [(0, 0, self.root), None, None, None]

    def turn(self, initial: str, fault: int) -> None:
        """One turn, with the first letter of its role."""
        before = self.survivors
        ways = []
        for after, moves in enumerate(_MOVES[initial if initial in ("s", "u", "a") else "", fault]):
            found = [(before[b][0] + cost, before[b][1], letters, b) for b, cost, letters in moves if before[b] is not None]
            if found:
                ways.append((*min(found), after))
        ways = _undominated(ways)
        ways.sort(key=lambda w: (w[1], w[2]))
        leaving: dict[int, int] = {}
        for way in ways:
            leaving[way[3]] = leaving.get(way[3], 0) + 1
        tip = FAULT_OFFSET[fault]
        self.survivors = [None] * 4
        for rank, (cost, _, letters, origin, after) in enumerate(ways):
            leaf = before[origin][2]
            if leaving[origin] > 1:
                leaf = _Branch(leaf)
            leaf.edits += letters[:-1].encode() + bytes([ord(letters[-1]) + tip])
            self.survivors[after] = (cost, rank, leaf)
        lost = [old[2] for state, old in enumerate(before) if old is not None and state not in leaving]
        for leaf in lost:
            while not leaf.kids and leaf.parent is not None:
                leaf.parent.kids.remove(leaf)
                leaf = leaf.parent
        if lost:
            self._join()

    def _join(self) -> None:
        """Joins every branch that is the only way on from a fork to what lies before it."""
        for survivor in filter(None, list(self.survivors)):
            branch = survivor[2]
            while (before := branch.parent) is not None:
                if len(before.kids) == 1:
                    before.edits += branch.edits
                    before.kids = branch.kids
                    for kid in branch.kids:
                        kid.parent = before
                    self.survivors = [s and (s[0], s[1], before if s[2] is branch else s[2]) for s in self.survivors]
                branch = before

    def settled(self) -> bytes:
        """The edits that all survivors share, once each."""
        out, self.root.edits = bytes(self.root.edits), bytearray()
        return out

    def unresolved(self) -> int:
        """How many edits are held, over all branches."""
        branches, n = [self.root], 0
        while branches:
            branch = branches.pop()
            n += len(branch.edits)
            branches.extend(branch.kids)
        return n

    def finish(self) -> tuple[int, bytes]:
        """The least cost and the edits that are not taken away yet."""
        found = [(s[0] + _ENDS[i][0], s[1], _ENDS[i][1], i) for i, s in enumerate(self.survivors) if s is not None]
        cost, _, letters, state = min(found)
        parts, branch = [letters.encode()], self.survivors[state][2]
        while branch is not None:
            parts.append(bytes(branch.edits))
            branch = branch.parent
        return cost, b"".join(reversed(parts))


def _undominated(ways: list[tuple]) -> list[tuple]:
    """Without states that can no longer win: another goes on just as well at a surcharge, and is cheaper with it.

    After an assistant turn all that can follow a start is possible, with a system turn
    deleted (2) instead of kept; after a user turn an inserted turn (5) leads there.
    Without this a start, kept alive by deleting everything, would keep all unresolved.
    """
    cost = {way[4]: way[0] for way in ways}
    far = 1 << 62
    user, assistant, start = cost.get(USER, far), cost.get(ASSISTANT, far), cost.get(START, far)
    gone = set()
    if start > min(assistant + 2, user + 7):
        gone.add(START)
    if cost.get(SYSTEM, 0) > min(assistant, user + 5, start):
        gone.add(SYSTEM)
    return [way for way in ways if way[4] not in gone] if gone else ways


_DECODED = {ord(letter) + FAULT_OFFSET[fault]: (edit, fault) for edit, letter in enumerate(LETTERS) for fault in range(4)}


def _searched(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation, in pieces, from its facts in order."""
    search, current, numbers = None, None, 0
    out: list[tuple] = []

    def rows(settled: bytes) -> None:
        nonlocal numbers
        for at in range(0, len(settled), PIECE):
            out.append((current, numbers, settled[at : at + PIECE]))
            numbers += 1

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(*out) if out else ((), (), ())
        batch = [pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.binary()))]
        out.clear()
        return pa.RecordBatch.from_arrays(batch, names=["_conv", "_piece", "_edits"])

    kind = None
    for batch in stream:
        kind = batch.column("_conv").type
        facts = zip(*(batch.column(c).to_pylist() for c in ("_conv", "_initial", "_fault")))
        for conversation, initial, fault in facts:
            if search is None or conversation != current:
                if search is not None:
                    rows(search.finish()[1])
                search, current, numbers = Search(), conversation, 0
            search.turn(initial, fault)
            if len(search.root.edits) >= PIECE:
                rows(search.settled())
        yield flush(kind)
    if search is not None:
        rows(search.finish()[1])
        yield flush(kind)


_COLUMNS = ("place", "edit", "cost", "fault", "turn", "old_role", "role", "text")


def _applied(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with their edits; a conversation's edits come before its turns."""
    current, started, edits, at, expected, place = None, False, bytearray(), 0, 0, 0
    kinds: dict[str, pa.DataType] = {}
    out: dict[str, list] = {c: [] for c in ("_conv", *_COLUMNS)}

    def row(edit, cost, fault, turn, old_role, role, text):
        nonlocal place
        values = (current, place, EDITS[edit], cost, FAULTS[fault], turn, old_role, role, text)
        for column, value in zip(out.values(), values):
            column.append(value)
        place += 1

    def inserts():
        nonlocal at, expected
        while at < len(edits) and edits[at] == ord("I"):
            row(INSERT, COSTS[INSERT], SOUND, None, None, ROLES[expected], "")
            at, expected = at + 1, 1 - expected

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in out.items()], names=["_conv", *_COLUMNS])
        for column in out.values():
            column.clear()
        return batch

    for batch in stream:
        kinds = {
            "_conv": batch.column("_conv").type,
            "place": pa.int64(),
            "cost": pa.int64(),
            "turn": batch.column("_turn").type,
            **{c: pa.string() for c in ("edit", "fault", "old_role", "role", "text")},
        }
        rows = zip(*(batch.column(c).to_pylist() for c in ("_conv", "_edits", "_turn", "_role", "_text")))
        for conversation, settled, turn, role, text in rows:
            if not started or conversation != current:
                inserts()
                current, started, edits, at, expected, place = conversation, True, bytearray(), 0, 0, 0
            if settled is not None:
                edits += settled
                continue
            inserts()
            edit, fault = _DECODED[edits[at]]
            at += 1
            new_role = role if edit == KEEP else None if edit == DELETE else ROLES[expected]
            cost = COSTS[edit] + (TRUNCATED_COST if fault == TRUNCATED and edit != DELETE else 0)
            row(edit, cost, fault, turn, role, new_role, text)
            if new_role is not None and new_role[:1] != "s":
                expected = 1 - expected
        yield flush()
    if started:
        inserts()
        yield flush()


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANK_CHARACTERS))


def repair(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``id, place, edit, cost, fault, turn, old_role, role, text``: the cheapest edits of every conversation.

    The turns of a conversation, in the order of ``turn`` (nulls first, ties by a digest
    of role and text), are kept (0), given the role user or assistant (1) or deleted
    (2), and turns without text are inserted (5), so that the first letters of the roles
    read ``(s?(ua)+)?``. A blank turn and one whose role and text stood earlier must be
    deleted; one that does not end a sentence costs 5 more unless deleted. Of equally
    cheap edits those whose initials (Delete, Insert, Keep, Rerole) come first in ASCII
    win. ``role`` is null for deleted turns, ``old_role`` and ``turn`` for inserted ones.

    Repeats are found by grouping digests, which combines before the shuffle, so a turn
    that stands in a third of all rows is no hot key. The search reads facts without
    texts, sorted, and holds the edits that are unresolved (``Search``); a conversation
    of any length goes through one task as a stream, as each turn's edit depends on all
    before and some after. Texts are shuffled once, to meet the edits, and streamed too:
    beside one batch of rows a task holds the edits of one conversation, a byte a turn.
    Rows come out with each conversation together and in order within its partition.

    Null roles and texts read as one space; rows without an id are one conversation.
    Repeated rows are repeated turns. An empty table gives an empty result. Other
    columns are not read.
    """
    space = F.lit(" ")
    turns = df.select(
        F.col(id).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("_role"),
        F.coalesce(F.col(text).cast("string"), space).alias("_text"),
    )
    known = F.unhex(F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256))
    turns = turns.withColumn("_known", known)
    end = _trimmed(F.col("_text"))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(*SENTENCE_ENDS), SOUND).otherwise(TRUNCATED)
    facts = turns.select("_conv", "_turn", "_known", F.substring("_role", 1, 1).alias("_initial"), fault.alias("_fault"))
    # equal turns, once with their number: the first of each text in a conversation is no repeat
    equal = facts.groupBy(*facts.columns).agg(F.count("*").alias("_n"))
    earliest = facts.groupBy("_conv", "_known").agg(F.min(F.struct("_turn")).alias("_earliest"))
    same = F.col("e._conv").eqNullSafe(F.col("f._conv")) & (F.col("e._known") == F.col("f._known"))
    late = ~F.col("e._earliest._turn").eqNullSafe(F.col("f._turn"))
    equal = equal.alias("f").join(earliest.alias("e"), same).select("f.*", late.alias("_late"))
    copies = F.explode(F.sequence(F.lit(1), "_n")).alias("_copy")
    repeat = (F.col("_fault") != BLANK) & (F.col("_late") | (F.col("_copy") > 1))
    facts = equal.select("*", copies).withColumn("_fault", F.when(repeat, DUPLICATE).otherwise(F.col("_fault")))
    ordered = facts.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_known", "_copy")
    kind = dict(turns.dtypes)["_conv"]
    edits = ordered.select("_conv", "_initial", "_fault").mapInArrow(_searched, f"_conv {kind}, _piece long, _edits binary")

    both = turns.unionByName(edits, allowMissingColumns=True)
    first = F.col("_edits").isNull()
    met = both.repartition("_conv").sortWithinPartitions("_conv", first, "_piece", "_turn", "_known")
    schema = f"_conv {kind}, place long, edit string, cost long, fault string, turn {dict(turns.dtypes)['_turn']}"
    out = met.select("_conv", "_edits", "_turn", "_role", "_text").mapInArrow(
        _applied, f"{schema}, old_role string, role string, text string"
    )
    return out.withColumnRenamed("_conv", id)


def _summed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    current, started, kind = None, False, None
    n, turns, initial, audit, digest, written = {}, [], None, bytearray(), None, False
    out: list[list] = [[] for _ in range(len(counts) + 3)]

    def close():
        n["gaps"] = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        for column, value in zip(out, (current, *(n[c] for c in counts), audit.decode(), digest.hexdigest())):
            column.append(value)

    def flush():
        types = [kind, *[pa.int64()] * len(counts), pa.string(), pa.string()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types)], names=["_conv", *counts, "audit", "repaired_sha256"]
        )
        for column in out:
            column.clear()
        return batch

    names = ("_conv", "edit", "cost", "fault", "turn", "old_role", "role", "text")
    for batch in stream:
        kind = batch.column("_conv").type
        for conversation, edit, cost, fault, turn, old_role, role, text in zip(*(batch.column(c).to_pylist() for c in names)):
            if not started or conversation != current:
                if started:
                    close()
                current, started = conversation, True
                n, turns, initial = dict.fromkeys(counts, 0), [], None
                audit, digest, written = bytearray(), hashlib.sha256(), False
            audit += edit[0].upper().encode()
            n["cost"] += cost
            if edit != EDITS[INSERT]:
                if fault:
                    n[fault] += 1
                if initial is not None and initial + old_role[:1] not in ("su", "ua", "au"):
                    n["illegal"] += 1
                initial = old_role[:1]
                if turn is not None:
                    # turns rise: least, largest, how many different ones
                    turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
            if role is not None:
                digest.update(f"{chr(10) if written else ''}{role}:{text}".encode())
                written = True
        yield flush()
    if started:
        close()
        yield flush()


def summaries(repaired: DataFrame, id: str = "conv_id") -> DataFrame:
    """``id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    Takes the rows as ``repair`` gives them, each conversation together and in order, and
    adds no shuffle: gaps in whole-number turns, turns by fault, neighbours whose roles do
    not follow each other, cost and initials of the edits, and the digest of the repaired
    ``role:text`` lines, which is built as the rows go by.
    """
    kind = dict(repaired.dtypes)[id]
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    rows = repaired.withColumnRenamed(id, "_conv").mapInArrow(_summed, f"_conv {kind}, {counts}, audit string, repaired_sha256 string")
    return rows.withColumnRenamed("_conv", id)


def damage(df: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by the hash of ``conv_id:turn`` modulo 20; nulls read as one space.

    0 drops the turn, 1 empties its text, 2 removes the ends of its sentences, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    dealt = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))) % 20
    text = F.coalesce("text", space)
    rows = df.select(
        "conv_id",
        "turn",
        F.when(dealt == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(dealt == 1, "").when(dealt == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(dealt == 0, 0).when(dealt == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.withColumn("_times", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times")

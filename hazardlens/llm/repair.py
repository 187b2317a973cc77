"""Conversation structure repair by a persistent audit DP.

Each row of a conversation is kept, given another role or deleted, and empty turns may be inserted, so that the roles
become ``(s?(ua)+)?`` at the least cost; of the cheapest audits (the edits' initials in order) the ASCII-least one wins.

The state after a row is the place in that pattern. Each state holds its cost and the last node of its audit: audits are
chains of nodes that share their prefixes, with ancestors at distances 1, 2, 4, ... and a rolling hash of the chain. Of
two audits of equal cost neither is a prefix of the other (edits have their price), so the first difference decides; it
is found by a longest-common-prefix search over hashes of ancestors. Equal chains are one node, so a hit is verified by
identity, and a collision falls back on a search by identity.

A conversation is read as a stream, in order. What all states have in common is decided: it is given out and its nodes
and texts go. So a task holds the open end of one conversation only, however long the conversation is; what grows with
it is its audit, one byte a row, which is one value of the result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import partitions_of

DELETE, INSERT, KEEP, REROLE = "DIKR"           # in ASCII order
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
FAULTS = ("blank", "duplicate", "truncated")
#: Nodes of a conversation before what is decided is given out.
WINDOW_NODES = 4096

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_START, _ASSISTANT)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: The state that a kept role leads to.
_KEPT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER,
         (_USER, "a"): _ASSISTANT}
#: The state that a turn made to fit leads to.
_FITTED = {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER, _USER: _ASSISTANT}
#: What the first state pays at most, compared with the second, for any way to go on.
_BEHIND = {
    (_SYSTEM, _START): 4, (_USER, _START): 5, (_ASSISTANT, _START): 3,
    (_START, _SYSTEM): 0, (_USER, _SYSTEM): 2, (_ASSISTANT, _SYSTEM): 0,
    (_START, _USER): 2, (_SYSTEM, _USER): 2, (_ASSISTANT, _USER): 2,
    (_START, _ASSISTANT): 0, (_SYSTEM, _ASSISTANT): 4, (_USER, _ASSISTANT): 2,
}
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


class Prefixes:
    """Audits as chains of nodes; node 0 is the empty audit."""

    def __init__(self):
        self.letters, self.depths, self.hashes = [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]
        self.children: dict[tuple[int, str], int] = {}

    def __len__(self) -> int:
        return len(self.letters)

    def extend(self, node: int, letter: str) -> int:
        known = self.children.get((node, letter))
        if known is not None:
            return known
        new = len(self.letters)
        self.children[node, letter] = new
        self.letters.append(letter)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append((self.hashes[node] * _BASE + ord(letter)) % _MODULUS)
        jumps, at = [node], node
        while len(self.ancestors[at]) >= len(jumps):
            at = self.ancestors[at][len(jumps) - 1]
            jumps.append(at)
        self.ancestors.append(jumps)
        return new

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        up, k = self.depths[node] - depth, 0
        while up:
            if up & 1:
                node = self.ancestors[node][k]
            up >>= 1
            k += 1
        return node

    def _parted(self, a: int, b: int, names: Callable[[int], int]) -> tuple[int, int]:
        """The first nodes in which two chains of equal length differ, by what ``names`` tells of a node."""
        for k in reversed(range(len(self.ancestors[a]))):
            if k < len(self.ancestors[a]) and names(self.ancestors[a][k]) != names(self.ancestors[b][k]):
                a, b = self.ancestors[a][k], self.ancestors[b][k]
        return a, b

    def parted(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes in which two audits differ; equal ones if one audit begins with the other."""
        depth = min(self.depths[a], self.depths[b])
        a, b = self.lifted(a, depth), self.lifted(b, depth)
        if a == b:
            return a, b
        if self.hashes[a] != self.hashes[b]:
            x, y = self._parted(a, b, self.hashes.__getitem__)
            if self.ancestors[x][0] == self.ancestors[y][0]:
                return x, y
        return self._parted(a, b, lambda node: node)        # a collision

    def less(self, a: int, b: int) -> bool:
        x, y = self.parted(a, b)
        return self.letters[x] < self.letters[y] if x != y else self.depths[a] < self.depths[b]

    def common(self, a: int, b: int) -> int:
        x, y = self.parted(a, b)
        return x if x == y else self.ancestors[x][0]

    def spelled(self, node: int, since: int = 0) -> str:
        """The letters on the way from ``since`` to ``node``."""
        out = []
        while node != since:
            out.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(out))


class Edit(NamedTuple):
    letter: str
    role: str
    text: str


class Audit:
    """The repair of one conversation, row by row."""

    def __init__(self, window: int = WINDOW_NODES):
        self.window = self.limit = window
        self.prefixes = Prefixes()
        self.best: dict[int, tuple[int, int]] = {}      # state: cost, node
        self._offer(self.best, _START, 0, 0)
        self._insert()
        self.rows: deque[tuple[str, str]] = deque()     # not decided yet
        self.state = _START                             # after what was given out
        self.cost = 0

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, node: int, letter: str = "") -> bool:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        new = self.prefixes.extend(node, letter) if letter else node
        if held is not None and held[0] == cost and (held[1] == new or not self.prefixes.less(new, held[1])):
            return False
        best[state] = cost, new
        return True

    def _insert(self) -> None:
        """Insertions until none helps, then states that cannot win any more go."""
        best, moved = self.best, True
        while moved:
            moved = False
            for state, (cost, node) in list(best.items()):
                moved |= self._offer(best, _FITTED[state], cost + COSTS[INSERT], node, INSERT)
        self.best = {q: held for q, held in best.items() if all(
            p == q or cost + _BEHIND[p, q] >= held[0] for p, (cost, _) in best.items())}

    def add(self, role: str, text: str, fault: str | None) -> Iterator[Edit]:
        self.rows.append((role, text))
        cut = TRUNCATED_COST if fault == "truncated" else 0
        best: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(best, state, cost + COSTS[DELETE], node, DELETE)
            if fault in ("blank", "duplicate"):
                continue
            self._offer(best, _FITTED[state], cost + COSTS[REROLE] + cut, node, REROLE)
            kept = _KEPT.get((state, role[:1]))
            if kept is not None:
                self._offer(best, kept, cost + COSTS[KEEP] + cut, node, KEEP)
        self.best = best
        self._insert()
        if len(self.prefixes) > self.limit:
            yield from self._decide()

    def end(self) -> Iterator[Edit]:
        ends = [self.best[s] for s in _ENDS if s in self.best]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or other_cost == cost and self.prefixes.less(other, node):
                cost, node = other_cost, other
        self.cost = cost
        yield from self._give_out(self.prefixes.spelled(node))

    def _decide(self) -> Iterator[Edit]:
        """Give out what all states share and keep only the nodes after it."""
        old, tips = self.prefixes, [node for _, node in self.best.values()]
        shared = tips[0]
        for tip in tips[1:]:
            shared = old.common(shared, tip)
        yield from self._give_out(old.spelled(shared))
        self.prefixes = Prefixes()
        for state, (cost, node) in self.best.items():
            new = 0
            for letter in old.spelled(node, shared):
                new = self.prefixes.extend(new, letter)
            self.best[state] = cost, new
        self.limit = max(self.window, 2 * len(self.prefixes))

    def _give_out(self, letters: str) -> Iterator[Edit]:
        for letter in letters:
            role, text = ("", "") if letter == INSERT else self.rows.popleft()
            if letter == KEEP:
                self.state = _KEPT[self.state, role[:1]]
            elif letter != DELETE:
                self.state = _FITTED[self.state]
                role = _NAMES[self.state]
            yield Edit(letter, role, text)


class Facts:
    """What is counted while a conversation goes by in order of its turns (null first)."""

    def __init__(self):
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None

    def add(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.distinct


def _steps(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[object, Edit | tuple[Audit, Facts]]]:
    """The edits of each conversation in order, and at its end what was found out about it."""
    audit = facts = conv = None
    for batch in batches:
        for at, present, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "present", "turn", "role", "text", "fault"))):
            if audit is None or at != conv:
                if audit is not None:
                    yield from ((conv, edit) for edit in audit.end())
                    yield conv, (audit, facts)
                conv, audit, facts = at, Audit(window), Facts()
            if present:
                facts.add(turn, role, fault)
                yield from ((conv, edit) for edit in audit.add(role, text, fault))
    if audit is not None:
        yield from ((conv, edit) for edit in audit.end())
        yield conv, (audit, facts)


def _full(out: list[list], size: int) -> bool:
    return len(out[0]) >= 10_000 or size > 1 << 22


def _batch(out: list[list], schema: pa.Schema) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)
    for values in out:
        values.clear()
    return batch


_COUNTS = ("gaps", *FAULTS, "illegal", "cost")


def _summaries(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", conv_type), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])
    out: list[list] = [[] for _ in schema]
    letters, digest, turns, size = bytearray(), hashlib.sha256(), 0, 0
    for conv, step in _steps(batches, window):
        if isinstance(step, Edit):
            letters += step.letter.encode()
            if step.letter != DELETE:
                digest.update(("\n" if turns else "").encode() + f"{step.role}:{step.text}".encode())
                turns += 1
            continue
        audit, facts = step
        row = (conv, facts.gaps, *facts.faults.values(), facts.illegal, audit.cost, letters.decode(), digest.hexdigest())
        for values, value in zip(out, row):
            values.append(value)
        size += len(letters)
        letters, digest, turns = bytearray(), hashlib.sha256(), 0
        if _full(out, size):
            yield _batch(out, schema)
            size = 0
    yield _batch(out, schema)


def _logs(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", conv_type), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                        ("text", pa.string())])
    out: list[list] = [[] for _ in schema]
    at = size = 0
    for conv, step in _steps(batches, window):
        if not isinstance(step, Edit):
            at = 0
            continue
        for values, value in zip(out, (conv, at, *step)):
            values.append(value)
        at, size = at + 1, size + len(step.text)
        if _full(out, size):
            yield _batch(out, schema)
            size = 0
    yield _batch(out, schema)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows with faults planted by ``crc32(conv:turn) % 20``: ``conv_id, turn, role, text, present``.

    0 drops the row (it stays with ``present`` false, so that its conversation is known), 1 empties the text, 2 takes
    its full stops, exclamation and question marks away, 3 repeats the row, 4 makes the role ``user``. Null counts as
    one space in role, text and checksum."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"),
        spaced(text_col).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") != 0, text).alias("text"), (F.col("kind") != 0).alias("present"), times.alias("time")).drop("time")


def with_faults(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", present_col: str | None = None) -> DataFrame:
    """``conv_id, turn, role, text, present, fault``, whole conversations in one partition and in order.

    Texts are shuffled once: conversations are dealt out, and rows of one conversation are first sorted by content, to
    tell repetitions, and then by turn."""
    present = F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"),
        F.when(present, spaced(text_col)).alias("text"), present.alias("present"))
    dealt = rows.repartition(partitions_of(turns), "conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("nth") > 1, "duplicate").when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    return dealt.withColumn("nth", F.row_number().over(same)).select(
        "conv_id", "turn", "role", "text", "present", fault.alias("fault")).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _run(turns: DataFrame, each: Callable, columns: str, window: int, **names: str | None) -> DataFrame:
    ordered = with_faults(turns, **names)
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            yield from each(_again(first, batches), first.schema.field("conv_id").type, window)

    return ordered.mapInArrow(run, f"conv_id {kind}, {columns}")


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repair_summary(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", present_col: str | None = None, window: int = WINDOW_NODES) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are in order of turn (null first), then role, then text. The first fault of a row counts: blank, a repetition of
    role and text, no ending. ``gaps`` are turn numbers missing between the smallest and the largest; ``illegal`` counts
    neighbours whose role initials are not su, ua or au. Null role and null text are one space; rows with a null
    conversation form one; repeated rows are duplicates. Rows where ``present_col`` is not true only name their
    conversation; without other rows it has counts of 0, an empty audit and the hash of nothing. An empty table gives no
    rows; other columns are not read, whatever their names."""
    names = dict(conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col, present_col=present_col)
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return _run(turns, _summaries, f"{counts}, audit string, repaired_sha256 string", window, **names)


def repair_log(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text", present_col: str | None = None, window: int = WINDOW_NODES) -> DataFrame:
    """The edits themselves: ``conv_id, step, edit, role, text``, one row each, roles as they are after the edit.

    Without the rows where ``edit`` is D this is the repaired conversation. Rules as in :func:`repair_summary`."""
    names = dict(conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col, present_col=present_col)
    return _run(turns, _logs, "step long, edit string, role string, text string", window, **names)

"""Repair of the order of roles in conversations, by generalised LR parsing (operator 12).

Repaired conversations follow a small role grammar: nothing, or an optional system message and then
pairs of a user and an assistant message. The parser reads the rows of a conversation in order and
follows every edit at once: keep, delete or rerole a row, or insert a message. Its stacks share
their lower parts; stacks with equal tops are merged, and the one of least (cost, audit) stays. This
loses nothing, because what may follow depends on the top alone.

A conversation is read as a stream: rows are dealt by conversation and sorted on Spark, and of every
surviving stack a running digest of its messages is kept, not the messages. So memory does not grow
with a conversation but for its audit, a letter a row, which is part of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import SPACES

#: The role grammar's LR(0) automaton. C -> nothing | s T | T; T -> P | T P; P -> u a.
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 4: {"u": 2}, 6: {"u": 2}}
REDUCE = {3: ("P", 2), 5: ("T", 1), 7: ("T", 2)}
GOTO = {(0, "P"): 5, (0, "T"): 4, (1, "P"): 5, (1, "T"): 6, (4, "P"): 7, (6, "P"): 7}
ACCEPT = (0, 4, 6)
#: Roles that a message can be given.
TARGETS = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Letters of an audit that are held as text; older ones are shared by the stacks that agree on them.
TAIL = 4096

FAULTS = 20
_END_MARKS = ".!?"


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: rows damaged by the CRC-32 of ``conv_id:turn``.

    Modulo 20, 0 drops a row (``present`` is false), 1 empties its text, 2 takes the ``.!?`` out of
    it, 3 repeats it, 4 makes its role user. Null roles and texts count as one space, as null ids
    and turns do in what is hashed; null ids and turns themselves stay null.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % FAULTS
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    return out.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", _END_MARKS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def shifted(stack: tuple, terminal: str) -> tuple | None:
    """The stack after a terminal and all reductions; None where the grammar forbids it.

    A stack is its top state and the stack below, which other stacks may share.
    """
    state = SHIFT[stack[0]].get(terminal)
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        head, size = REDUCE[stack[0]]
        for _ in range(size):
            stack = stack[1]
        stack = (GOTO[stack[0], head], stack)
    return stack


class _Path:
    """The best way to a stack: cost, audit (``older`` and ``tail``), and the digest of its messages.

    ``rank`` orders the older parts of the audits that are alive, which are equally long.
    """

    __slots__ = ("cost", "rank", "tail", "older", "stack", "digest", "messages")

    def __init__(self, cost, rank, tail, older, stack, digest, messages) -> None:
        self.cost, self.rank, self.tail, self.older = cost, rank, tail, older
        self.stack, self.digest, self.messages = stack, digest, messages

    def audit(self) -> str:
        parts, node = [self.tail], self.older
        while node is not None:
            parts.append(node[1])
            node = node[0]
        return "".join(reversed(parts))


class RoleParser:
    """The graph-structured stack of one conversation: a path for each top."""

    def __init__(self) -> None:
        self.tops = self._with_inserts({0: _Path(0, 0, "", None, (0, None), hashlib.sha256(), 0)})

    @staticmethod
    def _step(best: dict, path: _Path, stack: tuple | None, cost: int, letter: str, message: bytes | None) -> None:
        """Offer a way to ``stack``; of equal tops that of least (cost, audit) stays."""
        if stack is None:
            return
        found = best.get(stack[0])
        key = (path.cost + cost, path.rank, path.tail + letter)
        if found is None or key < found[0]:
            best[stack[0]] = (key, path, stack, message)

    @staticmethod
    def _path(key: tuple, parent: _Path, stack: tuple, message: bytes | None) -> _Path:
        digest, count = parent.digest, parent.messages
        if message is not None:
            digest = digest.copy()
            digest.update(b"\n" + message if count else message)
            count += 1
        return _Path(*key, parent.older, stack, digest, count)

    def _with_inserts(self, tops: dict[int, _Path]) -> dict[int, _Path]:
        """The tops, and what inserted messages lead to, until nothing gets better."""
        changed = True
        while changed:
            changed, best = False, {}
            for path in tops.values():
                for terminal, role in TARGETS.items():
                    self._step(best, path, shifted(path.stack, terminal), INSERT, "I", role.encode() + b":")
            for state, (key, path, stack, message) in best.items():
                now = tops.get(state)
                if now is None or key < (now.cost, now.rank, now.tail):
                    tops[state] = self._path(key, path, stack, message)
                    changed = True
        return tops

    def read(self, role: str, text: str, deleted: bool, truncated: bool) -> None:
        """One row: delete it, or, unless it has to go, keep or rerole it."""
        best: dict = {}
        more = TRUNCATED if truncated else 0
        for path in self.tops.values():
            self._step(best, path, path.stack, DELETE, "D", None)
            if deleted:
                continue
            body = b":" + text.encode()
            self._step(best, path, shifted(path.stack, role[:1]), more, "K", role.encode() + body)
            for terminal, target in TARGETS.items():
                self._step(best, path, shifted(path.stack, terminal), REROLE + more, "R", target.encode() + body)
        self.tops = self._with_inserts({state: self._path(*found) for state, found in best.items()})
        if min(len(p.tail) for p in self.tops.values()) >= TAIL:
            self._shorten()

    def _shorten(self) -> None:
        """Move what all tails have in length to the older parts, ranked as audits are ordered."""
        cut = min(len(p.tail) for p in self.tops.values())
        heads = {(p.rank, p.tail[:cut]): p.older for p in self.tops.values()}
        ranks = {head: i for i, head in enumerate(sorted(heads))}
        nodes = {head: (older, head[1]) for head, older in heads.items()}
        for p in self.tops.values():
            head = (p.rank, p.tail[:cut])
            p.rank, p.older, p.tail = ranks[head], nodes[head], p.tail[cut:]

    def result(self) -> _Path:
        return min((p for s, p in self.tops.items() if s in ACCEPT), key=lambda p: (p.cost, p.rank, p.tail))


class _Conversation:
    """Counts and parser of one conversation, fed with its rows in order."""

    LEGAL = ("su", "ua", "au")

    def __init__(self, conv_id) -> None:
        self.conv_id, self.parser = conv_id, RoleParser()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last = None

    def read(self, turn, role: str, text: str, before: bool, end_mark: str) -> None:
        """A row; ``before``: seen at an earlier turn; ``end_mark``: its last solid character or ''."""
        blank = not end_mark
        duplicate = not blank and (before or self.last == (turn, role, text))
        truncated = not blank and not duplicate and end_mark not in _END_MARKS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is not None and self.last[1][:1] + role[:1] not in self.LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.rows += 1
        self.last = (turn, role, text)
        self.parser.read(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        best = self.parser.result()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv_id, self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                best.cost, best.audit(), best.messages, best.digest.hexdigest())


COLUMNS = ("conv_id", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "n_messages", "repaired_sha256")
_ORDER = ("turn", "role", "text")


def _streamed(rows: DataFrame, *keys) -> DataFrame:
    """Rows of a conversation in one partition, in order; nulls come first."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *keys)


def repair_conversations(rows: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: faults of its rows, cost and audit of the cheapest repair, a digest.

    ``rows`` has ``conv_id, turn, role, text``. A conversation's rows go by turn (nulls first), equal
    turns by role and text. The first fault of a row counts: ``blank`` (white space only),
    ``duplicate`` (role and text occur earlier), ``truncated`` (does not end with ``.``, ``!`` or
    ``?``); ``illegal`` counts neighbours whose roles' initials are not su, ua or au; ``gaps`` the
    missing turns. The audit lists the edits (Keep, Rerole, Delete, Insert by their initials) of the
    least cost, of equal costs the least text. Blank and duplicate rows have to be deleted.
    ``repaired_sha256`` is of the repaired messages, ``role:text``, joined by newlines.

    Null roles and texts count as one space; null ids are one conversation. Repeated rows are
    duplicates. Where the column named ``present`` is false, a row only names its conversation,
    which has a result even without rows. Other columns, whatever their names, are not read, and
    texts are read whole. An empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    solid = F.regexp_replace("text", SPACES, "")
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"))
    rows = rows.withColumn("mark", F.when(F.col("present"), F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))
    # Which messages a conversation has at several turns; those of one turn meet in the stream.
    when = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    again = rows.filter("present").groupBy("conv_id", "mark").agg(F.min(when).alias("first"), F.max(when).alias("last"))
    again = again.filter("not first <=> last").select(F.col("conv_id").alias("c"), F.col("mark").alias("m"), "first")
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    rows = rows.select(
        "conv_id", "turn", "role", "text", "present",
        (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(when)).alias("before"),
        F.substring(solid, -1, 1).alias("end_mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, turn, role, text, here, before, mark in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv_id)
                if here:
                    now.read(turn, role, text, before, mark)
            if done:
                yield _batch(done)
                done = []
        if now is not None:
            yield _batch([now.result()])

    def _batch(results: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*results))
        texts = {"conv_id": types.get(kind, pa.string()), "audit": pa.string(), "repaired_sha256": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(c, texts.get(n, pa.int64())) for n, c in zip(COLUMNS, columns)], list(COLUMNS))

    types = {"bigint": pa.int64(), "int": pa.int32()}
    fields = [f"{c} {kind if c == 'conv_id' else 'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in COLUMNS]
    return _streamed(rows, *_ORDER).mapInArrow(run, ", ".join(fields))


def repaired_messages(rows: DataFrame, repaired: DataFrame, present: str | None = None) -> DataFrame:
    """``conv_id, position, role, text, edit``: the messages that the audits in ``repaired`` lead to.

    ``rows`` are those that ``repair_conversations`` was given. An audit goes ahead of the rows of
    its conversation in the same stream, so messages are made one by one.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    types = {"bigint": pa.int64(), "int": pa.int32()}
    given = rows.filter(F.col(present)) if present else rows
    given = given.select(
        "conv_id", F.lit(1).alias("kind"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ahead = repaired.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, audit, at, stack, position = None, "", 0, (0, None), 0

        def message(role: str, text: str, edit: str):
            nonlocal stack, position
            stack = shifted(stack, role[:1])
            position += 1
            return conv_id, position, role, text, edit

        def inserts():
            nonlocal at
            while audit[at : at + 1] == "I":
                at += 1
                yield message(next(r for t, r in TARGETS.items() if t in SHIFT[stack[0]]), "", "I")

        for batch in batches:
            out = []
            for key, row_kind, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if row_kind == 0:
                    conv_id, audit, at, stack, position = key, text, 0, (0, None), 0
                    out.extend(inserts())
                    continue
                edit = audit[at]
                at += 1
                if edit == "K":
                    out.append(message(role, text, "K"))
                elif edit == "R":
                    out.append(message(next(r for t, r in TARGETS.items() if t in SHIFT[stack[0]]), text, "R"))
                out.extend(inserts())
            if out:
                columns = list(zip(*out))
                names = ["conv_id", "position", "role", "text", "edit"]
                kinds = [types.get(kind, pa.string()), pa.int64(), *[pa.string()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    stream = _streamed(given.unionByName(ahead), "kind", *_ORDER)
    return stream.mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")

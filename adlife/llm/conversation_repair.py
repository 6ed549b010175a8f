"""Conversation structure repair: cheapest edits by Four-Russians block tables.

The rows of a conversation, in order, are to become roles that read
``(s?(ua)+)?`` by their initials: an optional system turn, then user and
assistant in turns. Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the
only one for blank and duplicate rows), Insert a user or assistant turn
with an empty text anywhere 3; a truncated row that stays adds 3. Of all cheapest
edit sequences the one whose initials (D, I, K, R) read least in ASCII is taken.

*Tables.* A row is one of nine symbols (must go; or one of four role classes,
truncated or not). The grammar has four states, so what the rest of a
conversation costs from each state is a vector of four numbers; with its least
number taken off, only a few dozen vectors exist. For every block of
``BLOCK`` symbols and every vector behind it a table holds the vector before it
and the number taken off. Blocks are processed from the end by one look-up
each; then, from the start, a block is expanded backward from the vector behind
it and the least letter that stays cheapest is taken at each row, so ties are
decided as if all sequences had been compared. Expansions are remembered.

*Plan.* The rows are dealt by ranges of (conversation, turn, role, text), sorted,
numbered and written once; a hot conversation, or a hot row of it, spreads over
many tasks there. Only numbers, digests and symbols are looked at to mark duplicates
and to solve a conversation (about ten bytes a row). Rows and their edits then meet once
more, in order, to make the repaired rows or what is reported of them.

Order: turn (nulls first), then role, then text. Faults, first one counts:
*blank* (no character but blank, tab, LF, VT, FF, CR), *duplicate* (an earlier
row of the conversation has this role and text), *truncated* (the last such
character is not ``.``, ``!`` or ``?``).

Defined cases: a null role or text counts as one space (so such a text is
blank and such a role has to be changed); rows with a null conversation id are
one conversation; null turns come first and do not count for gaps; a role is
known by its first letter s, u or a; repeated rows are duplicates; further
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from adlife.llm.common import materialized, ship_package

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Symbols of a block.
BLOCK = 4

SPACES = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")
ROLES = "sua"                                    # initials known to the grammar; any other is class 3

# Grammar states: nothing yet, after s, after u, after a. FOLLOW: by a kept initial; TURN: by the one
# turn (user or assistant) that may be inserted or rerolled to.
FOLLOW = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ACCEPTS = (0, 3)
PAD, GONE = 0, 1                                 # symbols: filler before a first block, a row that must go
SYMBOLS = 2 + 2 * (len(ROLES) + 1)
NEVER = 10**6


def symbol(role_class: int, fault: int) -> int:
    return GONE if fault in (BLANK, DUPLICATE) else 2 + 2 * role_class + (fault == TRUNCATED)


def _inserting(v: list[int]) -> tuple[int, ...]:
    """The least cost from each state when turns may be inserted first; more than two never help."""
    for _ in range(2):
        v = [min(v[p], INSERT + v[TURN[p][1]]) for p in range(4)]
    return tuple(v)


def _moves(x: int, p: int) -> list[tuple[str, int, int]]:
    """(token, cost, next state) of the edits of one row with symbol ``x`` in state ``p``, in ASCII order."""
    out = [("D", DELETE, p)]
    if x != GONE:
        role, cut = divmod(x - 2, 2)
        if role < len(ROLES) and ROLES[role] in FOLLOW[p]:
            out.append(("K", KEEP + CUT * cut, FOLLOW[p][ROLES[role]]))
        out.append((TURN[p][0], REROLE + CUT * cut, TURN[p][1]))
    return out


def _before(x: int, v: tuple[int, ...]) -> tuple[int, ...]:
    if x == PAD:
        return v
    return _inserting([min(cost + v[q] for _, cost, q in _moves(x, p)) for p in range(4)])


class BlockTables:
    """Transitions of normalised cost vectors for all blocks of ``BLOCK`` symbols.

    Tokens of an edit: K, D, u / a (reroled to user / assistant), U / A (inserted).
    """

    def __init__(self) -> None:
        end = _inserting([0 if p in ACCEPTS else NEVER for p in range(4)])
        self.vectors, ids, self.end = [end], {end: 0}, 0
        one, taken = [], []                       # by vector, then symbol
        for v in self.vectors:                    # grows while it is walked
            one.append([]), taken.append([])
            for x in range(SYMBOLS):
                w = _before(x, v)
                least = min(w)
                w = tuple(c - least for c in w)
                if w not in ids:
                    ids[w] = len(self.vectors)
                    self.vectors.append(w)
                one[-1].append(ids[w])
                taken[-1].append(least)
        self.one = np.array(one, np.int16).T      # [symbol, vector behind] -> vector before
        self.taken = np.array(taken, np.int64).T
        to, off = self.one, self.taken
        for _ in range(BLOCK - 1):                # put one more symbol in front
            off = (off[None] + self.taken[:, to]).reshape(-1, len(self.vectors))
            to = self.one[:, to].reshape(-1, len(self.vectors))
        self.to, self.off = to.tolist(), off.tolist()
        self.expand = lru_cache(maxsize=1 << 16)(self._expand)

    def _expand(self, block: int, behind: int, state: int) -> tuple[tuple[str, ...], int]:
        """Tokens of each symbol of the block from ``state`` on, and the state after it."""
        symbols = [block // SYMBOLS ** k % SYMBOLS for k in reversed(range(BLOCK))]
        after = [behind]
        for x in reversed(symbols):
            after.append(int(self.one[x, after[-1]]))
        after.reverse()                           # after[i]: vector before symbol i; after[i + 1]: behind it
        out = []
        for i, x in enumerate(symbols):
            tokens = ""
            if x != PAD:
                v, here = self.vectors[after[i + 1]], self.vectors[after[i]]
                off = int(self.taken[x, after[i + 1]])
                while True:
                    goal = here[state] + off
                    moves = _moves(x, state)
                    turn, q = TURN[state]
                    # D before I before K before R
                    token, nxt = next((t, n) for t, cost, n in [moves[0], (turn.upper(), None, q), *moves[1:]]
                                      if goal == (INSERT + here[q] + off if cost is None else cost + v[n]))
                    tokens, state = tokens + token, nxt
                    if token not in "UA":
                        break
            out.append(tokens)
        return tuple(out), state

    def solve(self, symbols: np.ndarray) -> tuple[int, list[str]]:
        """The least cost, and the tokens of each row (inserted turns before the row's own; the last row's
        are followed by what is inserted at the end)."""
        n = len(symbols)
        if not n:
            return 0, []
        padded = np.zeros(-(-n // BLOCK) * BLOCK, np.int64)
        padded[len(padded) - n:] = symbols
        blocks = (padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()
        behind, vector, cost = [0] * len(blocks), self.end, 0
        for i in range(len(blocks) - 1, -1, -1):
            behind[i] = vector
            cost += self.off[blocks[i]][vector]
            vector = self.to[blocks[i]][vector]
        cost += self.vectors[vector][0]
        out, state = [], 0
        for block, v in zip(blocks, behind):
            tokens, state = self.expand(block, v, state)
            out.extend(tokens)
        del out[:len(out) - n]
        while state not in ACCEPTS:
            turn, state = TURN[state]
            out[-1] += turn.upper()
        return cost, out


# -- rows ---------------------------------------------------------------------

def ordered_rows(rows: DataFrame) -> DataFrame:
    """The rows, numbered in order (``at``) and written: conv_id, at, turn, role, text, role_class, fault (duplicates
    not yet told apart), digest (of role and text)."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.left("role", F.lit(1))
    role_class = F.coalesce(*[F.when(initial == c, i) for i, c in enumerate(ROLES)], F.lit(len(ROLES)))
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    # equal rows may stand in any order, so a number of their own splits them over the ranges
    dealt = (rows.select("*", F.left("text", F.lit(64)).alias("start"), F.monotonically_increasing_id().alias("copy"))
             .repartitionByRange("conv_id", "turn", "role", "start", "copy")
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return materialized(dealt.select("conv_id", F.monotonically_increasing_id().alias("at"), "turn", "role", "text",
                                     role_class.alias("role_class"), fault.alias("fault"), digest.alias("digest")), "conversations")


def _kinds(ordered: DataFrame) -> DataFrame:
    """(conv_id, at, kind): role class and fault of each row, 4 * class + fault, duplicates included."""
    narrow = ordered.select("conv_id", "at", "role_class", "fault", "digest")
    seen = (narrow.groupBy(F.col("conv_id").alias("c_"), F.col("digest").alias("d_"))
            .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m")).where(F.col("m") > 1))
    same = F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("digest") == F.col("d_"))
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False)) & (F.col("fault") != BLANK)
    return narrow.join(seen, same, "left").select(
        "conv_id", "at", (F.col("role_class") * 4 + F.when(again, DUPLICATE).otherwise(F.col("fault"))).alias("kind"))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, at, kind) in order -> (conv_id, at, fault, tokens)."""
    tables = BlockTables()
    of_kind = np.array([symbol(k >> 2, k & 3) for k in range(16)], np.uint8)

    def joined(conv, parts: list[tuple]) -> pa.RecordBatch:
        ats, kinds = (np.concatenate(p) for p in zip(*parts))
        tokens = tables.solve(of_kind[kinds])[1]
        return pa.RecordBatch.from_arrays([pa.repeat(conv, len(ats)), pa.array(ats, pa.int64()), pa.array(kinds & 3, pa.int32()),
                                           pa.array(tokens, pa.string())], names=["conv_id", "at", "fault", "tokens"])

    conv, held = None, []
    for batch in batches:
        ids = batch.column(0)
        values = ids.to_pylist()
        ats, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        starts = [0, *[i for i in range(1, len(values)) if values[i] != values[i - 1]], len(values)]
        for a, b in zip(starts, starts[1:]):
            if a == b:
                continue
            if held and values[a] != conv.as_py():
                yield joined(conv, held)
                held = []
            conv = ids[a]
            held.append((ats[a:b], kinds[a:b].astype(np.uint8)))
    if held:
        yield joined(conv, held)


def _chunked(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Edit(NamedTuple):
    conv_id: object
    at: int
    step: int
    edit: str                 # K, R, D or I
    fault: str | None         # of the row edited; null for I, as are turn and old_role
    turn: int | None
    old_role: str | None
    role: str | None          # of the repaired row, as is text; null for D
    text: str | None


def _edits_of(conv_id, at, turn, role, text, fault, tokens) -> Iterator[Edit]:
    for step, token in enumerate(tokens):
        new = {"u": "user", "a": "assistant"}.get(token.lower())
        if token in "UA":
            yield Edit(conv_id, at, step, "I", None, None, None, new, "")
        elif token == "D":
            yield Edit(conv_id, at, step, "D", FAULTS[fault], turn, role, None, None)
        else:
            yield Edit(conv_id, at, step, "K" if token == "K" else "R", FAULTS[fault], turn, role, new or role, text)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[Edit | tuple]:
    """Rows of :func:`_rows_and_tokens` -> edits in order; (conv_id,) for a mark."""
    fault = tokens = None
    for batch in batches:
        for conv_id, at, kind, turn, role, text, f, t in zip(*[c.to_pylist() for c in batch.columns]):
            if kind == MARK:
                yield (conv_id,)
            elif kind == TOKENS:
                fault, tokens = f, t
            else:
                yield from _edits_of(conv_id, at, turn, role, text, fault, tokens)


MARK, TOKENS, ROW = range(3)


def _rows_and_tokens(rows: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """conv_id, at, kind, turn, role, text, fault, tokens: each row behind its tokens, conversations whole and in order.

    One shuffle of the texts. ``marks`` (conv_id) puts a row of kind MARK before each of its conversations.
    """
    ship_package(rows.sparkSession)
    ordered = ordered_rows(rows)
    narrow = _kinds(ordered).repartition("conv_id").sortWithinPartitions("conv_id", "at")
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("at", T.LongType()),
                           T.StructField("fault", T.IntegerType()), T.StructField("tokens", T.StringType())])
    tokens = narrow.mapInArrow(lambda it: _chunked(_solved(it)), schema).withColumn("kind", F.lit(TOKENS))
    both = tokens.unionByName(ordered.select("conv_id", "at", "turn", "role", "text").withColumn("kind", F.lit(ROW)),
                              allowMissingColumns=True)
    if marks is not None:
        both = both.unionByName(marks.select("conv_id").withColumn("kind", F.lit(MARK)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind").select(
        "conv_id", "at", "kind", "turn", "role", "text", "fault", "tokens")


def _tables(rows: Iterator[tuple], schema: pa.Schema, size: int = 5_000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per edit of the conversations ``rows`` (conv_id, turn, role, text), with the columns of :class:`Edit`.

    ``at`` and ``step`` give the order within a conversation.
    """
    own = [rows.schema[c].dataType for c in ("conv_id", "turn")]
    kinds = {"conv_id": own[0], "turn": own[1], "at": T.LongType(), "step": T.IntegerType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in Edit._fields])
    arrow = to_arrow_schema(schema)
    return _rows_and_tokens(rows).mapInArrow(lambda it: _tables(_edits(it), arrow), schema)


# -- query ----------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage, by crc32 of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops a row,
    1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its role user."""
    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                       (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("h")).where(F.col("h") != 0)
    h = F.col("h")
    return rows.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(h == 3, 2).otherwise(1))).alias("copy")).drop("copy")


class _Digest:
    """What the query reports of one conversation, from its edits in order; texts are not kept."""

    def __init__(self, conv_id):
        self.conv_id, self.first, self.last, self.turns = conv_id, None, None, 0
        self.faults, self.illegal, self.cost = dict.fromkeys(FAULTS, 0), 0, 0
        self.before, self.letters, self.sha, self.lines = None, [], hashlib.sha256(), 0

    def add(self, edit, fault, turn, old_role, role, text) -> None:
        self.letters.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            self.faults[fault] += 1
            if fault == "truncated" and edit != "D":
                self.cost += CUT
            if self.before is not None and self.before[:1] + old_role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = old_role
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
        if edit != "D":
            self.sha.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"],
                self.illegal, self.cost, "".join(self.letters), self.sha.hexdigest())


def _digests(edits: Iterator[Edit | tuple]) -> Iterator[tuple]:
    """A row per conversation; each has a mark in front."""
    now = None
    for edit in edits:
        if len(edit) == 1:
            if now is not None:
                yield now.row()
            now = _Digest(edit[0])
        else:
            now.add(*edit[3:])
    if now is not None:
        yield now.row()


def conversation_repair_query(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and hash of the repaired turns.

    The audit and the hash are one value over a whole conversation, so its edits pass through one task, in
    order; the task keeps the audit's letters and no texts.
    """
    rows = _rows_and_tokens(damaged(conversations), conversations.select("conv_id").distinct())
    schema = T.StructType([T.StructField("conv_id", conversations.schema["conv_id"].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda it: _tables(_digests(_edits(it)), arrow), schema)

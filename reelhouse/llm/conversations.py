"""Repair of conversations by the cheapest edits, decided by big-integer weights.

Method. A conversation's rows, in order of turn, are edited so that the initials of its roles read
`(s?(ua)+)?`: Keep (K) costs nothing, Rerole to user or assistant (R) 2, Delete (D) 3, Insert (I)
of an empty row 2; blank and repeated rows must be deleted, and a truncated row that stays adds 1.
The edits are a path in an acyclic graph over (row, state of the pattern). The weight of a path is
one whole number: its high digits are the cost, its low digits, of fixed width and place, are the
letters of its edits in order, with zeros behind them. So the least number is the cheapest path,
and of several the one whose letters come first in ASCII; a path is made longer at the front by
moving the letters one place down. Taking minima of whole numbers from the last row to the first
decides everything, and the least number's own digits are the edits.

The numbers are as long as a block of `BLOCK` rows needs. A block hands to the one before it the
costs of its four states and, as a last digit, the order of their letters; as all paths through a
block end with a row's letter, that digit decides exactly as the letters themselves would. So the
work grows linearly with the rows of a conversation.

Scale. Two passes over rows sorted by conversation and turn, both streams. The first reads a few
bytes a row and decides the edits; it keeps one byte a row of the conversation at hand, less than
the letters that it returns in one value. The second brings these to the texts and digests what is
left row by row. No conversation is ever collected: an SHA-256 of its text reads it in order, so a
conversation that holds a third of all rows is one long stream, in bounded memory. Which rows
repeat earlier ones is an aggregate over all rows, for which no conversation is a hot key.

Cases: a null conv_id is a conversation of its own. Null turns come first. Rows of one turn are
taken by role, then by a digest of role and text; equal rows may swap. A null role or text is one
space, in the key of the damage too. A role is judged by its first character; an empty role has
none and cannot be kept. Empty texts are blank. Conversations of which nothing is left, or all is
deleted, have the digest of the empty string. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.components import stored
from reelhouse.llm.rows import chosen
from reelhouse.operators.joins import join_unique
from reelhouse.session import scratch_dir

#: What edits cost, the letters in the order of their digits, white space.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = " DIKR"
WHITE = r"\x20\x09-\x0D"
BLOCK = 256
WIDTH = 3
#: Repairs that are kept for conversations with the same kinds of rows.
KNOWN = 50_000

_D, _I, _K, _R = 1, 2, 3, 4
#: States of the pattern: nothing yet, after s, after u, after a.
_START, _S, _U, _A = range(4)
#: The state after an inserted row, and after a kept one by its initial.
_INSERTED = {_START: _U, _S: _U, _U: _A, _A: _U}
_KEPT = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
#: Behind the last row: costs of the states and the order of their letters ("", "II", "I", "").
_END = ((0, 2 * INSERT, INSERT, 0), (1, 3, 2, 1))

# Kinds of rows, one byte each: the place of the initial in "sua" (3: another), 4 for a truncated
# row, 8 for one that must go.
_TRUNCATED, _GONE = 4, 8


def kind(role: str, truncated: bool, must_go: bool) -> int:
    return (("sua".find(role[:1]) if role else -1) & 3) | truncated * _TRUNCATED | must_go * _GONE


def _moves(row: int, state: int) -> list[tuple[int, int, int]]:
    """(letter, cost, next state) for a row in a state."""
    moves = [(_D, DELETE, state)]
    if not row & _GONE:
        extra = TRUNCATED if row & _TRUNCATED else 0
        kept = _KEPT.get((state, "sua?"[row & 3]))
        if kept is not None:
            moves.append((_K, extra, kept))
        moves.append((_R, REROLE + extra, _INSERTED[state]))
    return moves


_MOVES = {(row, state): _moves(row, state) for row in range(16) for state in range(4)}


def weights(rows: bytes, behind=_END) -> tuple[list[int], int]:
    """The least weight from each state before `rows`, and the bits of its letters.

    `behind`: (costs, order of letters) of the states behind the rows.
    """
    bits = WIDTH * (3 * len(rows) + 6)
    top, mask = bits - WIDTH, (1 << bits) - 1

    def put(letter: int, cost: int, weight: int) -> int:
        return (((weight >> bits) + cost) << bits) | (letter << top) | ((weight & mask) >> WIDTH)

    costs, order = behind
    at = [(c << bits) | (o << top) for c, o in zip(costs, order, strict=True)]
    for row in reversed(rows):
        own = [min(put(x, c, at[to]) for x, c, to in _MOVES[row, state]) for state in range(4)]
        # inserted rows stand before it; two of them lead back to where they began
        once = [min(w, put(_I, INSERT, own[_INSERTED[s]])) for s, w in enumerate(own)]
        at = [min(w, put(_I, INSERT, once[_INSERTED[s]])) for s, w in enumerate(own)]
    return at, bits


def _handed(at: list[int], bits: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Costs, less the least of them, and the order of the letters."""
    costs, letters = [w >> bits for w in at], [w & ((1 << bits) - 1) for w in at]
    ranks = {x: i + 1 for i, x in enumerate(sorted(set(letters)))}
    return tuple(c - min(costs) for c in costs), tuple(ranks[x] for x in letters)


def steps(letters: str, rows: bytes, state: int = _START):
    """(letter, row number or None, state after it) of each edit."""
    i = 0
    for x in letters:
        if x == "I":
            state = _INSERTED[state]
            yield x, None, state
            continue
        if x == "K":
            state = _KEPT[state, "sua?"[rows[i] & 3]]
        elif x == "R":
            state = _INSERTED[state]
        yield x, i, state
        i += 1


def repair(rows: bytes, block: int = BLOCK) -> tuple[int, str]:
    """The cost and the letters of the cheapest edits of a conversation's rows."""
    starts = list(range(0, len(rows), block))
    behind = [_END]
    for a in reversed(starts[1:]):
        behind.append(_handed(*weights(rows[a : a + block], behind[-1])))
    state, cost, out = _START, 0, []
    for a in starts:
        own = rows[a : a + block]
        at, bits = weights(own, behind.pop())
        digits = at[state] & ((1 << bits) - 1)
        letters, left = [], len(own)
        for shift in range(bits - WIDTH, -1, -WIDTH):
            digit = (digits >> shift) & ((1 << WIDTH) - 1)
            letters.append(LETTERS[digit])
            left -= digit != _I
            if not left:
                break
        out.append("".join(letters))
        for x, i, state in steps(out[-1], own, state):
            extra = TRUNCATED if i is not None and own[i] & _TRUNCATED else 0
            cost += {"I": INSERT, "D": DELETE, "K": extra, "R": REROLE + extra}[x]
    last = {_START: 0, _A: 0, _U: 1, _S: 2}[state]
    return cost + last * INSERT, "".join(out) + "I" * last


def damaged(rows: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id, turn, role, text, copy and gone: the rows after the damage of the contract.

    A dropped row stays as a mark of its conversation, with `gone`. A repeated row comes twice.
    """
    named = chosen(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    named = named.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    harm = F.crc32(F.concat_ws(":", *spelled).cast("binary")) % 20
    return (
        named.withColumn("harm", harm)
        .withColumn("copy", F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("harm") == 1, "")
            .when(F.col("harm") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            "copy",
            (F.col("harm") == 0).alias("gone"),
        )
    )


def _order() -> list[Column]:
    return [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "same", "copy", "number")]


def judged(rows: DataFrame, folder: str) -> DataFrame:
    """Stored rows with their first fault: blank, duplicate, truncated or none."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    same = F.sha2(F.concat_ws(":", conv, F.octet_length("role").cast("string"), "role", "text"), 256)
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    rows = rows.withColumns({"same": same, "number": F.monotonically_increasing_id()})
    rows = stored(rows, f"{folder}/rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "copy", "number")
    repeated = (
        rows.filter(~F.col("gone") & ~blank)
        .groupBy("same")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select("same", "first")
    )
    rows = join_unique(rows, repeated, "same", "left")
    ends = F.col("text").rlike(rf"[.!?][{WHITE}]*\z")
    fault = (
        F.when(F.col("gone"), None)
        .when(blank, "blank")
        .when(F.coalesce(place > F.col("first"), F.lit(False)), "duplicate")
        .when(~ends, "truncated")
    )
    return rows.select("conv_id", "turn", "role", "same", "copy", "number", "gone", fault.alias("fault"))


class _Tally:
    """What is known of the conversation at hand, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.kinds, self.last = conv_id, bytearray(), None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.least, self.most = 0, 0, None, None

    def add(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self.kinds.append(kind(role, fault == "truncated", fault in ("blank", "duplicate")))

    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns


PLAN_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of `PLAN_DDL` for each conversation of judged rows."""
    struct = T.StructType.fromDDL(PLAN_DDL)
    columns = ["conv_id", "turn", "role", "gone", "fault"]
    ordered = rows.select(*columns, "same", "copy", "number").repartition("conv_id").sortWithinPartitions(*_order())

    def run(batches):
        known: dict[bytes, tuple[int, str]] = {}

        def finished(t: _Tally) -> dict:
            kinds = bytes(t.kinds)
            if kinds not in known:
                if len(known) >= KNOWN or len(kinds) > block:
                    known.clear()
                known[kinds] = repair(kinds, block)
            cost, audit = known[kinds]
            return {"conv_id": t.conv_id, "gaps": t.gaps(), **t.faults, "illegal": t.illegal, "cost": cost, "audit": audit}

        tally = None
        for batch in batches:
            done = []
            for conv_id, turn, role, gone, fault in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                if tally is None or conv_id != tally.conv_id:
                    if tally is not None:
                        done.append(finished(tally))
                    tally = _Tally(conv_id)
                if not gone:
                    tally.add(turn, role, fault)
            yield pa.RecordBatch.from_pylist(done, schema=_schema(struct))
        if tally is not None:
            yield pa.RecordBatch.from_pylist([finished(tally)], schema=_schema(struct))

    return ordered.mapInArrow(run, struct)


def _schema(struct: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in struct])


class _Repaired:
    """The repaired rows of a conversation, as they come by."""

    def __init__(self, plan: dict):
        self.plan, self.at, self.state = plan, 0, _START

    def _insert(self):
        self.state = _INSERTED[self.state]
        return ("user", "assistant")[self.state == _A], ""

    def next(self, role: str, text: str):
        """The rows that stand in the place of the next one, with those inserted before it."""
        audit = self.plan["audit"]
        while audit[self.at] == "I":
            self.at += 1
            yield self._insert()
        x, self.at = audit[self.at], self.at + 1
        if x == "K":
            self.state = _KEPT[self.state, role[0]]
            yield role, text
        elif x == "R":
            yield self._insert()[0], text

    def rest(self):
        for _ in self.plan["audit"][self.at :]:
            yield self._insert()


class _Digest:
    def __init__(self):
        self.sha, self.first = hashlib.sha256(), True

    def add(self, rows) -> None:
        for role, text in rows:
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False


RESULT = f"{PLAN_DDL}, repaired_sha256 string"


def _in_order(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans, each with the rows of its conversation behind it, in order."""
    texts = rows.filter(~F.col("gone"))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    planned = planned.select(*names, F.lit(False).alias("is_row"))
    texts = texts.select("conv_id", "role", "text", "turn", "same", "copy", "number", F.lit(True).alias("is_row"))
    both = planned.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    order = [F.asc_nulls_first(c) for c in ("conv_id", "is_row", "turn", "role", "same", "copy", "number")]
    return both.sortWithinPartitions(*order).select(*names, "is_row", "role", "text")


def repaired_rows(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, place, role and text of every repaired row."""
    ordered = _in_order(rows, planned)

    def run(batches):
        one, place = None, 0
        for batch in batches:
            out = []

            def put(made):
                nonlocal place
                for role, text in made:
                    out.append({"conv_id": one.plan["conv_id"], "place": place, "role": role, "text": text})
                    place += 1

            for row in batch.to_pylist():
                if row["is_row"]:
                    put(one.next(row["role"], row["text"]))
                else:
                    if one is not None:
                        put(one.rest())
                    one, place = _Repaired(row), 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if one is not None:
            left = [
                {"conv_id": one.plan["conv_id"], "place": place + i, "role": role, "text": text}
                for i, (role, text) in enumerate(one.rest())
            ]
            yield pa.RecordBatch.from_pylist(left, schema=schema)

    struct = T.StructType.fromDDL("conv_id long, place long, role string, text string")
    schema = _schema(struct)
    return ordered.mapInArrow(run, struct)


def digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans with the digest of the repaired conversation."""
    struct = T.StructType.fromDDL(RESULT)
    ordered = _in_order(rows, planned)

    def run(batches):
        schema, one, digest = _schema(struct), None, None

        def finished() -> dict:
            digest.add(one.rest())
            return {**one.plan, "repaired_sha256": digest.sha.hexdigest()}

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["is_row"]:
                    digest.add(one.next(row["role"], row["text"]))
                else:
                    if one is not None:
                        done.append(finished())
                    one, digest = _Repaired(row), _Digest()
            yield pa.RecordBatch.from_pylist([{n: d[n] for n in schema.names} for d in done], schema=schema)
        if one is not None:
            last = finished()
            yield pa.RecordBatch.from_pylist([{n: last[n] for n in schema.names}], schema=schema)

    return ordered.mapInArrow(run, struct)


def repair_digests(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of `RESULT` for each conversation, of rows as `damaged` returns them."""
    folder = scratch_dir(rows.sparkSession)
    faults = judged(rows, folder)
    planned = stored(plans(faults, block), f"{folder}/plans")
    return digests(rows.sparkSession.read.parquet(f"{folder}/rows"), planned)

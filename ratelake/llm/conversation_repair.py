"""Conversation structure repair: the cheapest edits that make roles alternate, by a checkpointed DP.

States are what a repaired conversation may have said last: nothing, system, user, assistant.  The cost
of the rest of a conversation from each state is computed from its end; only the vectors at every
sqrt(m)-th of m rows are kept.  Walking forward, each stretch between two of them is computed again and
of the tight edits (those that lead on at the least cost) the one with the ASCII-least letter is taken.
Letters differ for all edits of a place, so this gives the ASCII-least audit of all cheapest ones.

Rows are dealt by ranges of (conversation, turn, role, head of the text), so a long conversation lies in many
partitions.  A conversation that is surely whole in one partition and within one block is repaired there
and then.  All others, that is the first and the last of a partition and those longer than a block, go
on as blocks of bounded size:

1. rows that repeat one of an earlier block are found by digest,
2. each block gives the matrix of least costs between the states before and behind it; the vectors at
   the ends of blocks follow from these, one small row a block, from the last to the first,
3. each block is walked from every state, in parallel; chaining the ends tells which walk is the one,
4. blocks give their repaired text.  Only the digest of a conversation, which is one value over all its
   bytes, is taken in sequence, streaming over the pieces.

Definitions beyond the contract: rows of one turn are ordered by role, then text; wholly equal rows are one row
with a count, and a row that the damage drops is one with the count zero, so that its conversation is still
reported.  Null roles and texts are one space; a null turn or conv_id is one space in the hash; rows
with a null conv_id are one conversation.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import SPACES, small_batches, stored, tidy

#: Blocks of long conversations: so many rows or characters.
BLOCK_ROWS = 4096
BLOCK_CHARS = 1_000_000
#: Characters of a text that rows are dealt by.
HEAD = 64

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind an inserted or re-roled row, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 60
#: Costs behind the last row: only nothing and assistant may end a conversation.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
#: A row as the DP sees it: 0-3 the initial (s, u, a, other), plus 4 if truncated; or it has to go.
GONE = 8
KEPT = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}


def before(code: int, ahead: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from the states before a row, from those behind it."""
    if code == GONE:
        first = [DELETE + v for v in ahead]
    else:
        more, kept = (TRUNCATED if code & 4 else 0), KEPT[code & 3]
        first = [min(DELETE + ahead[s], REROLE + more + ahead[NEXT[s]], more + ahead[kept[s]] if s in kept else FAR) for s in range(4)]
    once = [min(first[s], INSERT + first[NEXT[s]]) for s in range(4)]
    return tuple(min(once[s], INSERT + once[NEXT[s]]) for s in range(4))


def checkpoints(codes: bytes, end: tuple[int, ...]) -> tuple[int, list[tuple[int, ...]]]:
    """(stride, cost vectors before the rows 0, stride, 2 * stride, ... and behind the last)."""
    stride = isqrt(max(len(codes) - 1, 0)) + 1
    kept, vector = [end], end
    for i in range(len(codes) - 1, -1, -1):
        vector = before(codes[i], vector)
        if i % stride == 0:
            kept.append(vector)
    return stride, kept[::-1]


def walk(codes: bytes, end: tuple[int, ...], state: int, marks=None) -> tuple[str, int]:
    """(edits, state behind them): the ASCII-least of the cheapest edits of the rows from ``state``."""
    stride, kept = marks or checkpoints(codes, end)
    edits = []
    for block, low in enumerate(range(0, len(codes), stride)):
        part = codes[low : low + stride]
        vectors = [kept[block + 1]]
        for code in reversed(part):
            vectors.append(before(code, vectors[-1]))
        vectors.reverse()
        for code, here, ahead in zip(part, vectors, vectors[1:]):
            while DELETE + ahead[state] != here[state] and INSERT + here[NEXT[state]] == here[state]:
                edits.append("I")
                state = NEXT[state]
            if DELETE + ahead[state] == here[state]:
                edits.append("D")
                continue
            more, to = (TRUNCATED if code & 4 else 0), KEPT[code & 3].get(state)
            if to is not None and more + ahead[to] == here[state]:
                edits.append("K")
                state = to
            else:
                edits.append("R")
                state = NEXT[state]
    return "".join(edits), state


def closing(state: int) -> str:
    """Insertions behind the last row."""
    return "I" * (END[state] // INSERT)


def matrix(codes: bytes) -> list[int]:
    """Least costs [end * 4 + start] between the states before and behind the rows."""
    out = []
    for end in range(4):
        vector = tuple(0 if s == end else FAR for s in range(4))
        for code in reversed(codes):
            vector = before(code, vector)
        out += vector
    return out


def over(costs: list[int], end: tuple[int, ...]) -> tuple[int, ...]:
    """The cost vector before a block from its matrix and the vector behind it."""
    return tuple(min(costs[e * 4 + s] + end[e] for e in range(4)) for s in range(4))


@dataclass
class Block:
    """Rows of one conversation in order; ``counts`` says how often each stands there."""

    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    counts: list = field(default_factory=list)
    chars: int = 0

    def add(self, turn, role: str, text: str, count: int) -> None:
        if self.counts and (turn, role, text) == (self.turns[-1], self.roles[-1], self.texts[-1]):
            self.counts[-1] += count
            return
        for column, value in zip((self.turns, self.roles, self.texts, self.counts), (turn, role, text, count)):
            column.append(value)
        self.chars += len(text)


@dataclass
class Facts:
    """What a block, or a conversation so far, counts; blocks are added in order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, later: Facts) -> None:
        if self.last is not None and later.first is not None:
            self.illegal += self.last + later.first not in LEGAL
        self.turns += later.turns - (later.turns > 0 and self.last_turn == later.first_turn)
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(later, name))
        for name in ("first_turn", "first"):
            setattr(self, name, getattr(later, name) if getattr(self, name) is None else getattr(self, name))
        for name in ("last_turn", "last"):
            setattr(self, name, getattr(self, name) if getattr(later, name) is None else getattr(later, name))

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def blank(text: str) -> bool:
    return not text.strip(SPACES)


def inspect(block: Block, repeated: set[int] = frozenset()) -> tuple[bytes, Facts]:
    """(codes, facts): ``repeated`` are rows that repeat one of an earlier block; a code per row, counts expanded."""
    codes, facts, seen = bytearray(), Facts(), set()
    for i, (turn, role, text, count) in enumerate(zip(block.turns, block.roles, block.texts, block.counts)):
        if not count:
            continue
        here = Facts(first=role[:1], last=role[:1], illegal=count - 1)
        if turn is not None:
            here.turns, here.first_turn, here.last_turn = 1, turn, turn
        if blank(text):
            here.blank = count
            codes += bytes([GONE]) * count
        elif i in repeated or (role, text) in seen:
            here.duplicate = count
            codes += bytes([GONE]) * count
        else:
            here.duplicate = count - 1
            here.truncated = int(text.rstrip(SPACES)[-1] not in ".!?")
            codes.append("sua".find(role[:1] or "-") % 4 + 4 * here.truncated)
            codes += bytes([GONE]) * (count - 1)
        seen.add((role, text))
        facts.add(here)
    return bytes(codes), facts


def repaired(block: Block, edits: str, state: int) -> list[str]:
    """The lines that the edits leave of the block, begun in ``state``."""
    rows = ((r, t) for r, t, n in zip(block.roles, block.texts, block.counts) for _ in range(n))
    lines = []
    for edit in edits:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        else:
            state = NEXT[state]
            role = ROLE[state]
        lines.append(f"{role}:{text}")
    return lines


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows as the contract damages them; n is 0 for those dropped."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", None, "turn")))
    kind = F.pmod(F.crc32(key), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.expr("CASE kind WHEN 4 THEN 'user' WHEN 0 THEN '' ELSE role END").alias("role"),
        F.expr("CASE WHEN kind IN (0, 1) THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END").alias("text"),
        F.expr("CASE kind WHEN 0 THEN 0L WHEN 3 THEN 2L ELSE 1L END").alias("n"),
    )


def fold_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one with their count, so that no mass of equal rows is ever dealt to one task."""
    for batch in batches:
        folded = pa.Table.from_batches([batch]).group_by(["conv_id", "turn", "role", "text"], use_threads=False).aggregate([("n", "sum")])
        yield from folded.rename_columns(["conv_id", "turn", "role", "text", "n"]).to_batches()


_COUNTS = [pa.field(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_COUNT_KINDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SPLIT = pa.schema(
    [pa.field("conv_id", pa.int64()), *_COUNTS, pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())]
    + [pa.field("part", pa.int32()), pa.field("block", pa.int64()), pa.field("turns", pa.list_(pa.int64())), pa.field("roles", pa.list_(pa.string()))]
    + [pa.field("texts", pa.list_(pa.string())), pa.field("counts", pa.list_(pa.int64()))]
)
_SPLIT_KINDS = f"conv_id long, {_COUNT_KINDS}, repaired_sha256 string, part int, block long, turns array<long>, roles array<string>, texts array<string>, counts array<long>"


def whole(conv_id, block: Block) -> tuple:
    """The result of a conversation that is one block."""
    codes, facts = inspect(block)
    marks = checkpoints(codes, END)
    edits, state = walk(codes, END, START, marks)
    audit = edits + closing(state)
    digest = hashlib.sha256("\n".join(repaired(block, audit, START)).encode()).hexdigest()
    return (conv_id, facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal, marks[1][0][START], audit, digest, *[None] * 6)


def split(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Results of conversations that are surely whole, blocks of all others.  Rows come in order."""
    part, number, out, size = TaskContext.get().partitionId(), 0, [], 0
    at, block, open_ = None, Block(), True

    def leave() -> None:
        nonlocal number
        out.append((at, *[None] * 8, part, number, block.turns, block.roles, block.texts, block.counts))
        number += 1

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SPLIT)], schema=_SPLIT)
        out.clear()
        return made

    for rows in batches:
        for conv_id, *row in zip(*(rows.column(i).to_pylist() for i in range(5))):
            ended = block.counts and conv_id != at
            if ended or len(block.counts) >= block_rows or block.chars >= BLOCK_CHARS:
                size += block.chars
                leave() if open_ or not ended else out.append(whole(at, block))
                block, open_ = Block(), not ended
            at = conv_id
            block.add(*row)
        if len(out) >= BLOCK_ROWS or size >= BLOCK_CHARS:
            size = 0
            if out:
                yield batch()
    if block.counts:
        leave()
    if out:
        yield batch()


def _block(row: dict) -> Block:
    return Block(row["turns"], row["roles"], row["texts"], row["counts"])


def _map(df: DataFrame, function, kinds: str, schema: list[pa.DataType]) -> DataFrame:
    """``function`` turns an iterator of rows (dicts) into an iterator of tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [k.split()[0] for k in kinds.split(", ")]
        held = []

        def give() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema)], names=names)
            held.clear()
            return made

        for values in function(row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
            held.append(values)
            if len(held) >= 64:
                yield give()
        if held:
            yield give()

    return df.mapInArrow(tidy(run), kinds)


def repeats(blocks: DataFrame) -> DataFrame:
    """(part, block, repeated): the rows of each block that repeat one of an earlier block."""

    def digests(rows):
        for row in rows:
            seen = set()
            for i, (role, text, n) in enumerate(zip(row["roles"], row["texts"], row["counts"])):
                if n and not blank(text):
                    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
                    if digest not in seen:
                        seen.add(digest)
                        yield row["conv_id"], row["part"], row["block"], i, digest

    firsts = _map(blocks, digests, "conv_id long, part int, block long, i int, digest binary", [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()])
    # A digest occurs once a block here, so a common row is no hot key: the least place comes from partial sums.
    least = firsts.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "block")).alias("least"), F.count("*").alias("n")).where("n > 1")
    least = least.select(F.col("conv_id").alias("__conv"), "digest", "least")
    later = firsts.join(least, "digest").where(F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.struct("part", "block") > F.col("least")))
    return later.groupBy("part", "block").agg(F.collect_list("i").alias("repeated"))


def _in_order(df: DataFrame, descending: bool = False) -> DataFrame:
    order = [F.col(c).desc() if descending else F.col(c) for c in ("conv_id", "part", "block")]
    return df.repartition("conv_id").sortWithinPartitions(*order)


_FACTS = list(Facts.__dataclass_fields__)


def repair_blocks(blocks: DataFrame) -> DataFrame:
    """Results of the conversations that were left as blocks."""
    blocks = stored(blocks.join(repeats(blocks), ["part", "block"], "left"), "conversation-blocks")

    def summarise(rows):
        for row in rows:
            codes, facts = inspect(_block(row), set(row["repeated"] or ()))
            yield (row["conv_id"], row["part"], row["block"], codes, matrix(codes), *(getattr(facts, n) for n in _FACTS))

    facts_kinds = ", ".join(f"{n} {'string' if n in ('first', 'last') else 'long'}" for n in _FACTS)
    facts_types = [pa.string() if n in ("first", "last") else pa.int64() for n in _FACTS]
    keys, key_types = "conv_id long, part int, block long", [pa.int64(), pa.int32(), pa.int64()]
    summary = _map(blocks, summarise, f"{keys}, codes binary, costs array<long>, {facts_kinds}", [*key_types, pa.binary(), pa.list_(pa.int64()), *facts_types])
    summary = stored(summary, "conversation-codes")

    def backward(rows):
        at, vector = (), END
        for row in rows:
            if at != (row["conv_id"],):
                at, vector = (row["conv_id"],), END
            yield row["part"], row["block"], list(vector)
            vector = over(row["costs"], vector)

    ends = _map(_in_order(summary.select("conv_id", "part", "block", "costs"), descending=True), backward, "part int, block long, ends array<long>", [pa.int32(), pa.int64(), pa.list_(pa.int64())])

    def walks(rows):
        for row in rows:
            end = tuple(row["ends"])
            marks = checkpoints(row["codes"], end)
            found = [walk(row["codes"], end, s, marks) for s in range(4)]
            yield (row["conv_id"], row["part"], row["block"], [e for e, _ in found], [s for _, s in found], marks[1][0][START], *(row[n] for n in _FACTS))

    ways = _map(
        summary.join(ends, ["part", "block"]), walks, f"{keys}, edits array<string>, states array<int>, cost long, {facts_kinds}",
        [*key_types, pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64(), *facts_types],
    )

    def chain(rows):
        """A row per block with its edits and the state it begins in, then one with the totals."""
        at, state, cost, audit, facts = (), START, 0, [], Facts()

        def total():
            closed = closing(state)
            counts = (facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost)
            return (at[0], None, None, closed, state, *counts, "".join([*audit, closed]))

        for row in rows:
            if at != (row["conv_id"],):
                if at:
                    yield total()
                at, state, cost, audit, facts = (row["conv_id"],), START, row["cost"], [], Facts()
            edits = row["edits"][state]
            audit.append(edits)
            facts.add(Facts(*(row[n] for n in _FACTS)))
            yield (at[0], row["part"], row["block"], edits, state, *[None] * 7)
            state = row["states"][state]
        if at:
            yield total()

    chained = _map(_in_order(ways), chain, f"{keys}, edits string, state int, {_COUNT_KINDS}", [*key_types, pa.string(), pa.int32(), *[f.type for f in _COUNTS], pa.string()])
    chained = stored(chained, "conversation-edits")

    def pieces(rows):
        for row in rows:
            lines = repaired(_block(row), row["edits"], row["state"])
            if lines:
                yield row["conv_id"], row["part"], row["block"], "\n".join(lines)

    texts = _map(blocks.join(chained.select("part", "block", "edits", "state"), ["part", "block"]), pieces, f"{keys}, piece string", [*key_types, pa.string()])
    last = chained.where("part IS NULL").select("conv_id", F.lit(2147483647).alias("part"), F.lit(0).cast("long").alias("block"), "edits", "state", *_COUNT_KINDS.replace(" long", "").replace(" string", "").split(", "))
    every = last.unionByName(texts, allowMissingColumns=True)

    def digest(rows):
        at, sha = (), None
        for row in rows:
            if at != (row["conv_id"],):
                at, sha = (row["conv_id"],), None
            final = row["piece"] is None
            piece = "\n".join(repaired(Block(), row["edits"], row["state"])) if final else row["piece"]
            if piece:
                if sha is None:
                    sha = hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(piece.encode())
            if final:
                yield (row["conv_id"], *(row[f.name] for f in _COUNTS), row["audit"], (sha or hashlib.sha256()).hexdigest())

    return _map(_in_order(every), digest, f"conv_id long, {_COUNT_KINDS}, repaired_sha256 string", [pa.int64(), *[f.type for f in _COUNTS], pa.string(), pa.string()])


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``rows`` (conv_id, turn, role, text, n), see ``damaged``; n is how often a row stands there.
    """
    small_batches(rows)
    folded = rows.select("conv_id", "turn", "role", "text", "n").mapInArrow(tidy(fold_equal), "conv_id long, turn long, role string, text string, n long")
    dealt = folded.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, HEAD)).sortWithinPartitions("conv_id", "turn", "role", "text")
    found = stored(dealt.mapInArrow(tidy(lambda batches: split(batches, block_rows)), _SPLIT_KINDS), "conversations")
    done = found.where("part IS NULL").select("conv_id", *_COUNT_KINDS.replace(" long", "").replace(" string", "").split(", "), "repaired_sha256")
    blocks = found.where("part IS NOT NULL").select("conv_id", "part", "block", "turns", "roles", "texts", "counts")
    return done.unionByName(repair_blocks(blocks))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the conversations as the contract damages them."""
    return repair(damaged(conversations))

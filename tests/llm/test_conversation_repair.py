import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import cache

import pytest

from ratelake.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, state string, n string, part int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_key, turn_key = (" " if v is None else v for v in (conv, turn))
        kind = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    """(gaps, blank, duplicate, truncated, illegal, [(initial, truncated) or None if it must go])."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    counts, codes, seen = [0, 0, 0], [], set()
    for _, _, role, text in rows:
        short = text.strip(SPACE)[-1:] not in (".", "!", "?")
        fault = 0 if not text.strip(SPACE) else 1 if (role, text) in seen else 2 if short else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        codes.append(None if fault in (0, 1) else (role[:1], short))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return rows, codes, (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal)


def least(rows, codes):
    """(cost, audit, lines) of the cheapest edits over whole strings, without tight edits or checkpoints."""

    @cache
    def rest(i, said, inserted):
        found = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", {"": "", "s": "s", "u": "u", "a": "ua"}[said]):
            found.append((0, "", ()))
        for role in ("user", "assistant") if inserted < 3 else ():
            if follows(said, role[0]):
                c, e, t = rest(i, role[0], inserted + 1)
                found.append((c + 2, "I" + e, (f"{role}:", *t)))
        if i < len(rows):
            c, e, t = rest(i + 1, said, 0)
            found.append((c + 3, "D" + e, t))
            if codes[i]:
                initial, short = codes[i]
                for role, cost, edit in [(rows[i][2], 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")]:
                    if follows(said, role[:1]):
                        c, e, t = rest(i + 1, role[0], 0)
                        found.append((c + cost + short, edit + e, (f"{role}:{rows[i][3]}", *t)))
        return min(found, default=(10**9, "", ()))

    def follows(said, initial):
        return initial in {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}[said]

    return rest(0, "", 0)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine, codes, counts = faults(damage([r for r in rows if r[0] == conv]))
        cost, audit, lines = least(tuple(mine), codes)
        out[conv] = (*counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(draw, count, most=14):
    texts = ["Yes.", "No", "", " \n", "Why?", "Well, .", "a!", "end. \t", "é"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    for conv in range(count):
        for turn in range(draw.randint(0, most)):
            when = draw.choice([turn, turn, turn, turn * 2, turn // 2, None])
            yield conv, when, draw.choice(roles[: draw.choice([2, 5, 9])]), draw.choice([*texts, f"t{turn}.", f"u{turn}", f"v{turn}.", None])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)


def result(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


@pytest.mark.parametrize("block_rows", [4096, 1, 3])
def test_against_all_edits(spark, block_rows):
    """Small blocks send long conversations, and repeats of an earlier block, through the steps by block."""
    rows = list(conversations(random.Random(block_rows), 120))
    assert result(cr.repair(cr.damaged(frame(spark, rows)), block_rows)) == brute(rows)


def test_every_edit_sequence_of_short_conversations():
    """The DP's cost and audit are the least of all sequences that the pattern accepts."""

    def sequences(codes):
        gap = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
        rows = [[("D", "", 3)] + ([] if c == cr.GONE else [("K", "sua-"[c & 3], c >> 2), ("R", "u", 2 + (c >> 2)), ("R", "a", 2 + (c >> 2))]) for c in codes]
        for places in itertools.product(gap, repeat=len(codes) + 1):
            for edits in itertools.product(*rows):
                said, audit, cost = "", "", 0
                for i, inserted in enumerate(places):
                    said, audit, cost = said + "".join(inserted), audit + "I" * len(inserted), cost + 2 * len(inserted)
                    if i < len(codes):
                        said, audit, cost = said + edits[i][1], audit + edits[i][0], cost + edits[i][2]
                if re.fullmatch("(s?(ua)+)?", said):
                    yield cost, audit

    for codes in itertools.chain.from_iterable(itertools.product([0, 1, 2, 3, 5, 6, cr.GONE], repeat=n) for n in range(3)):
        data = bytes(codes)
        edits, state = cr.walk(data, cr.END, cr.START)
        assert (cr.checkpoints(data, cr.END)[1][0][cr.START], edits + cr.closing(state)) == min(sequences(codes))


def test_blocks_and_checkpoints_give_the_same_walk():
    draw = random.Random(5)
    for _ in range(200):
        codes = bytes(draw.choice([0, 1, 2, 3, 4, 5, 6, cr.GONE]) for _ in range(draw.randint(0, 60)))
        edits, state = cr.walk(codes, cr.END, cr.START)
        cut = draw.randint(0, len(codes))
        between = cr.over(cr.matrix(codes[cut:]), cr.END)
        head, at = cr.walk(codes[:cut], between, cr.START)
        tail, end = cr.walk(codes[cut:], cr.END, at)
        assert (head + tail, end) == (edits, state)
        stride, kept = cr.checkpoints(codes, cr.END)
        assert len(kept) <= stride + 2 and stride**2 >= len(codes)


def test_one_conversation_holds_most_rows(spark):
    """It is cut into blocks, its equal rows come as one, and no result of another conversation changes."""
    draw = random.Random(8)
    few = list(conversations(draw, 30))
    hot = [(77, draw.choice([None, i % 900]), draw.choice(["user", "assistant", "tool"]), draw.choice(["same", "Yes.", f"t{i}.", f"u{i}"])) for i in range(400)]
    hot += [(77, 5, "user", "same row.")] * 300
    rows = few + hot
    draw.shuffle(rows)
    got = result(cr.repair(cr.damaged(frame(spark, rows).repartition(7)), 50))
    sys.setrecursionlimit(20_000)
    assert got == brute(rows)


def test_odd_rows_and_empty_table(spark):
    drop = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (drop, 0, "user", "Hi."), (5000, None, "user", "x" * 300_000)]
    got = result(cr.repair_damaged(frame(spark, rows)))
    assert got == brute(rows)
    assert got[drop] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert cr.repair_damaged(frame(spark, []).limit(0)).count() == 0

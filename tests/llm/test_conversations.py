"""Conversation repair against plain Python: whole strings of letters are compared."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from heliocat.llm import conversations

FOLDER = "/root/testdata/sf0.001"
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def order(rows):
    """(turn, role, text) in the order that the operator defines."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))


def damaged(rows):
    """conv_id -> rows after damage."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: order(r) for c, r in out.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        if not shown:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def repaired(rows):
    """cost, letters, lines: every sequence of edits with at most two inserts in a row, the least of them."""
    marks = faults(rows)

    @cache
    def best(i, state, inserts):
        found = []
        if inserts < 2:
            c, s, lines = best(i, NEXT[state], inserts + 1)
            found.append((c + 3, "I" + s, (f"{ROLE[NEXT[state]]}:", *lines)))
        if i == len(rows):
            if state in "0a":
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, s, lines = best(i + 1, state, 0)
            found.append((c + 4, "D" + s, lines))
            if marks[i] not in ("blank", "duplicate"):
                extra = 3 if marks[i] == "truncated" else 0
                first = role[:1]
                if first and state + first in ("0s", "0u", "su", "ua", "au"):
                    c, s, lines = best(i + 1, first, 0)
                    found.append((c + extra, "K" + s, (f"{role}:{text}", *lines)))
                c, s, lines = best(i + 1, NEXT[state], 0)
                found.append((c + extra + 3, "R" + s, (f"{ROLE[NEXT[state]]}:{text}", *lines)))
        return min(found, key=lambda x: x[:2], default=(10**9, "", ()))

    cost, letters, lines = best(0, "0", 0)
    best.cache_clear()
    return cost, letters, lines


def expected(conv, rows):
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, letters, lines = repaired(rows)
    return (
        conv,
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(marks.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        letters,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def key(row):
    return row[0] is not None, row[0] or 0


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No", "  ", "", None, "What?", "A\nB", "é!\x0b", "x " * 200 + ".", "x " * 200 + "?"]
    rows = [
        (900 + i, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts))
        for i in range(40)
        for _ in range(rng.randrange(1, 14))
    ]
    rows += [(None, 1, "user", "Who?"), (None, 2, "assistant", "I."), (None, None, "tool", "x")]
    rows += [(5000, t, ["user", "assistant"][t % 2], f"turn {t % 37}{'.' * (t % 5 > 0)}") for t in range(300)]
    rows += [(5001, t, "tool", f"call {t}.") for t in range(121)]
    rows += [(5002, 7, "user", "the same.")] * 60
    rows += [(5003, t, "user", "") for t in range(50)]
    rows += [(6000 + t, 0, "user", "gone?") for t in range(60)]  # some of them are dropped whole
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    edges = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    both = given.unionByName(edges)
    clashes = "k n part seq gone kind copy place late behind given front codes void conv head hash row digest first times".split()
    return both.withColumns({c: F.lit(False) if c == "gone" else F.lit(1) for c in clashes}).repartition(3)


@pytest.mark.parametrize("bounds", [(conversations.CHUNK_ROWS, conversations.CHUNK_TEXT), (4, 1 << 16), (100, 90)])
def test_audit(table, bounds):
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    exp = sorted((expected(c, r) for c, r in damaged(rows).items()), key=key)
    found = conversations.audit(conversations.damage(table), *bounds)
    assert sorted(map(tuple, found.collect()), key=key) == exp
    assert ("", 0) in {(e[7], e[6]) for e in exp}  # a conversation without rows


@pytest.mark.parametrize("bounds", [(conversations.CHUNK_ROWS, conversations.CHUNK_TEXT), (4, 1 << 16)])
def test_repaired_rows(table, bounds):
    clean = table.select("conv_id", "turn", "role", "text")
    rows = [tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)) for r in clean.collect()]
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r[1:])
    exp = {}
    for c, r in by_conv.items():
        _, letters, lines = repaired(order(r))
        exp[c] = letters, list(lines)
    found = {}
    for r in sorted(conversations.repair(clean, *bounds).collect(), key=lambda r: r["place"]):
        letters, lines = found.setdefault(r["conv_id"], ["", []])
        found[r["conv_id"]][0] += r["edit"]
        if r["edit"] != "D":
            lines.append(f"{r['role']}:{r['text']}")
    assert {c: tuple(x) for c, x in found.items()} == exp


def test_vectors_converge_to_a_constant_difference():
    """A chunk from a speculative vector, fixed up from another, gives the vector of the whole run."""
    rng = random.Random(1)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randrange(40)))
        real = conversations.back(conversations.END, rng.randrange(9))
        front = conversations.backward(codes, conversations.END)[0]
        assert conversations.rerun(codes, conversations.END, real, front) == conversations.backward(codes, real)[0]


def test_empty_table(table):
    assert conversations.audit(table.limit(0)).count() == 0
    assert conversations.repair(table.limit(0)).count() == 0

"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from callmart.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder has the sign of the id.
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = own.get(base, [])[:h] + mine[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
        ends[tuple(paths[c])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        cost = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += cost
    out = []
    for node, held in members.items():
        listed = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out.append((held[0], len(node), parent, len(held), children[node], leaves[node], saved[node], listed))
    return sorted(out, key=str)


def found(rows, spark, conf=None):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as a", "3 as t1", "4 as level", "5 as holder").repartition(5)
    return sorted((tuple(r) for r in conversations.prefix_trie(table).collect()), key=str)


def some(seed, convs=120, few=4):
    """Short texts from few, so that conversations share much, with missing values, ties and repeated rows."""
    rnd = random.Random(seed)
    rows = []
    for c in range(-10, convs):
        if rnd.random() < 0.1:
            continue
        for t in range(rnd.choice([1, 2, 3, 8, 9, 16, 17, 20])):
            role = rnd.choice(["user", "assistant", None]) if rnd.random() < 0.2 else "user"
            text = rnd.choice(["", None, "é", "hello", "long text " * 3][:few]) if rnd.random() < 0.5 else f"turn {t}"
            rows.append((c, None if rnd.random() < 0.05 else t, role, text))
    rows += rows[:20]
    rows += [(None, 0, "user", "no conversation"), (7, 3, "user", "tie"), (7, 3, "user", "another"), (7, None, None, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed):
    rows = some(seed)
    assert found(rows, spark) == plain(rows)


def test_long_and_common(spark):
    """A conversation of many blocks and copies of it, a large group of copies, and a first turn that most have."""
    rnd = random.Random(3)
    long = [f"{i % 50}" for i in range(700)]
    rows = [(c, t, "user", x) for c in (1000, 1005, 1012) for t, x in enumerate(long)]
    rows += [(1020, t, "user", x) for t, x in enumerate([*long[:650], "other"])]
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2400) for t in range(3)]
    rows += [(c, t, "user", "same 0" if t == 0 else str(rnd.randrange(9))) for c in range(3000, 3200) for t in range(5)]
    rows += [(1 << 40, 0, "user", "same 0"), (-(1 << 40), 0, "user", "same 0")]
    assert found(rows, spark) == plain(rows)


def test_only_turnless(spark):
    """Conversations of which nothing is left are members of a root without children."""
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:8]
    rows = [(c, 0, "user", "x") for c in ids]
    want = plain(rows)
    assert len(want) == 1 and want[0][4] == 0
    assert found(rows, spark) == want


def test_empty(spark):
    assert found([], spark) == []
    assert found([(None, 1, "user", "x")], spark) == []

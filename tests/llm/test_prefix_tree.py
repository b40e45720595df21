"""The trie of shared beginnings beside a plain one, in memory."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from millrace.llm import prefix_tree

COLUMNS = "conv_id long, turn long, role string, text string, depth string, n string, pc string"


def plain_tree(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), role, tie, text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in turns.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + x[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        gain = (len(members[node]) - 1) * len(re.findall(prefix_tree.WORD, node[-1][1])) if node else 0
        below = [out[x] for x in children[node]]
        ends = ",".join(str(c) for c in members[node] if built[c] == node)
        out[node] = (
            members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(below),
            sum(b[5] for b in below) or 1, gain + sum(b[6] for b in below), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def tree_of(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], COLUMNS).repartition(3)
    return sorted((tuple(r) for r in prefix_tree.conversation_tree(df, **kw).collect()), key=str)


def made(seed, convs, longest, alphabet="ab"):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-30, 200), convs):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, draw.choice([None, turn, turn, turn]), draw.choice(["user", "user", None, ""]), draw.choice(alphabet) * draw.randint(0, 1) + " w"))
    return rows + rows[:5]


@pytest.mark.parametrize("fanout, span, held", [(8, 4, 2)])
def test_tree_equals_a_plain_one(spark, fanout, span, held):
    rows = [*made(1, 60, 6), *[(300 + i, t, "user", "same") for i in range(25) for t in range(3)],
            (None, 1, "user", "nobody's"), (900, 0, "user", None), (901, 0, None, ""), (902, None, "a", "\x00b \x0b c")]
    assert tree_of(spark, rows, fanout=fanout, span=span, held=held) == plain_tree(rows)


def test_one_long_conversation_is_cut_in_bands(spark):
    rows = [(7, t, "user", "go on") for t in range(150)] + [(8, t, "user", "go on") for t in range(70)] + [(9, 0, "user", "end")]
    assert tree_of(spark, rows, fanout=4, span=6, held=3) == plain_tree(rows)


def test_only_turnless_and_no_conversations(spark):
    turnless = next(c for c in range(21, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(turnless, 0, "user", "gone"), (turnless, 1, "user", "gone too")]
    assert tree_of(spark, rows) == plain_tree(rows)
    assert tree_of(spark, []) == [] == tree_of(spark, [(None, 1, "a", "b")])


def test_the_queue_spills_and_keeps_order():
    draw = random.Random(3)
    queue, out, expected = prefix_tree.SpillingQueue(8), [], []
    waiting = []
    for _ in range(500):
        if waiting and draw.random() < 0.4:
            out.append(queue.pop())
            expected.append(min(waiting))
            waiting.remove(expected[-1])
        else:
            waiting.append(tuple(draw.randint(-5, 5) for _ in range(4)))
            queue.push(waiting[-1])
            assert queue.head() == min(waiting)
    while waiting:
        out.append(queue.pop())
        expected.append(min(waiting))
        waiting.remove(expected[-1])
    assert out == expected and queue.head() is None and queue.files > 10

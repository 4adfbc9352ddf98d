from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ebbline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, depth long"


def slow(rows):
    """The rows by their definition: every prefix of every rebuilt conversation."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t for *_, t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in below if n}
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(n) == len(node) + 1 for n in below),
            sum(n not in inner for n in below), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if made[c] == node).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def run(spark, rows, *most):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in trie.trie(trie.rebuilt(df), *most).collect()), key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 90):
        start = [rng.choice(["a", "b"]) for _ in range(rng.choice([0, 6, 12]))]
        for k, text in enumerate(start + [rng.choice("xyz") for _ in range(rng.randrange(1, 4))]):
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(["u", "u", None]), text if rng.random() < 0.9 else None, "h", 1))
    rows += [(c, k, "u", "same é" * 3, "h", 1) for c in range(1000, 1060) for k in range(c % 3 + 1)]
    rows += [(2000, k, "u", f"long {k}", "h", 1) for k in range(500)] + [(2001, k, "u", f"long {k}", "h", 1) for k in range(450)]
    return rows + [(None, 1, "u", "lost", "h", 1), rows[0], rows[0]]


@pytest.mark.parametrize("most", [(), (1, 1), (3, 40), (10, 10**6)])
def test_nodes_equal_those_of_the_definition(spark, most):
    rows = random_rows(len(most) + sum(most))
    assert run(spark, rows, *most) == slow(rows)


def test_no_conversations(spark):
    assert run(spark, []) == [] == run(spark, [(None, 1, "a", "b", "", 0)])


def test_a_conversation_may_lose_all_its_turns(spark):
    """With h turns or fewer and no conversation to take others from, it is a member of the root only."""
    c = next(i for i in range(1, 99) if i % 5 and zlib.crc32(str(i).encode()) % 9 > 1)
    assert run(spark, [(c, 0, "u", "gone", "", 0)]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]

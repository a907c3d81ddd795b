"""The prefix trie against dictionaries of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from clicksieve.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, shard string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += 0 if children[node] else 1
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(node))
        yield (m[0], len(node), members[node[:-1]][0] if node else None, len(m), children[node], leaves[node], saved[node],
               hashlib.sha256(ends.encode()).hexdigest())


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in trie.prefix_trie(trie.share_heads(trie.conversation_turns(df)), **options).collect()), key=repr)


def talks(rng, n, longest, words):
    for c in rng.sample(range(n * 3), n):
        for t in range(rng.randint(1, longest)):
            yield c, t, rng.choice(["user", "bot"]), rng.choice(words)


@pytest.mark.parametrize("weight, factor, queue", [(4, 2, 1), (30, 4, 3), (100_000, 2, 100)])
def test_bands_and_spills(spark, monkeypatch, weight, factor, queue):
    """Shards of a few nodes, many bands, and queues that spill all the time."""
    monkeypatch.setattr(trie, "SHARD_WEIGHT", weight)
    monkeypatch.setattr(trie, "BAND_FACTOR", factor)
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "PIECE_CHARS", 50)
    rng = random.Random(weight)
    rows = list(talks(rng, 250, 9, ["a", "bb", ""]))
    rows += [(5000 + i, t, "user", f"copy {t}") for i in range(40) for t in range(12)]  # a group of copies
    rows += [(7000, t, "user", "long") for t in range(60)] + [(7001, t, "user", "long") for t in range(55)]
    rng.shuffle(rows)
    assert result(spark, rows, queue_rows=queue) == sorted(expected(rows), key=repr)


def test_trie_awkward(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""),
            (0, 0, "user", "é\U0001f600"), (0, 1, None, "x"), (0, 1, None, "x"), (205, 0, "user", "no base"), (-3, 5, "user", "minus"),
            (-3, 6, "user", "one " * 50_000), (250, 1, "a", "b"), (251, 1, "ab", "")]
    assert result(spark, rows) == sorted(expected(rows), key=repr)
    assert result(spark, []) == []
    assert result(spark, [(None, 0, "user", "x")]) == []


def test_queue_sums_what_it_spills():
    rng = random.Random(1)
    queue, want = trie.SpillingQueue(5), defaultdict(lambda: [0, 0])
    for _ in range(500):
        key, n, s = (rng.randint(0, 9), rng.randint(-3, 3), 0), rng.randint(0, 5), rng.randint(0, 5)
        queue.push(*key, n, s)
        want[key][0] += n
        want[key][1] += s
    assert len(queue.runs) > 50
    for d in range(9, -1, -1):
        for a in range(-3, 4):
            assert queue.take(d, a, 0) == tuple(want[(d, a, 0)])
    assert not queue.heap and not queue.heads

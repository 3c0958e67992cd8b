"""The prefix trie against one built turn by turn."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

from cabrank.llm import conversation_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            md5 = hashlib.md5((text or "").encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, role or "", md5), (role or "", text or "")))
    turns = {c: [t[1] for t in sorted(own)] for c, own in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        spent = (len(own) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += spent
    return sorted(
        (min(own), len(path), min(members[path[:-1]]) if path else -1, len(own), children.get(path, 0), leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, own in members.items()
    )


def built(spark, rows):
    schema = "conv_id long, turn long, role string, text string, path int, n string, node double"
    frame = conversation_trie.trie(spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], schema).repartition(3))
    assert frame.columns == COLUMNS
    return sorted(tuple(-1 if x is None else x for x in r) for r in frame.collect())


def test_random_conversations(spark):
    rnd = random.Random(8)
    rows = []
    for conv in range(220):
        if conv in (40, 60):
            continue  # families without a head
        copied = rnd.random() < 0.3
        for turn in range(3 if copied else rnd.randrange(1, 7)):
            text = "the same" if copied else rnd.choice(["a", "a b", "c\x0bd  e", None, "", "x y z"])
            rows.append((conv, None if rnd.random() < 0.05 else turn * 2, rnd.choice(["user", None]) if not copied else "user", text))
    rows += [(None, 0, "user", "no conversation"), (2**40, 0, "user", "a"), (-7, 0, "user", "b"), (41, 1, "u", "one turn")]
    assert built(spark, rows) == slow_trie(rows)


def test_long_conversations_that_part_late(spark):
    long = [("user", f"turn {i}") for i in range(300)]
    rows = [(c, i, role, text) for c, cut in ((0, 300), (20, 300), (40, 299), (60, 150)) for i, (role, text) in enumerate(long[:cut])]
    rows += [(40, 299, "user", "another end"), (80, 0, "user", "turn 0"), (100, 0, "user", "turn 0")]
    assert built(spark, rows) == slow_trie(rows)


def test_members_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_BITS", 2)
    rows = [(c * 20, t, "user", "same") for c in range(200) for t in range(2)]
    assert built(spark, rows) == slow_trie(rows)


def test_small_cases(spark):
    assert built(spark, []) == []
    # The family of conversation 1 has no head, so a conversation with fewer turns than it borrows has none.
    for rows in ([(c, 0, "u", "x") for c in range(1, 12)], [(0, 0, None, None), (0, 0, None, None)], [(5, None, "u", None)]):
        assert built(spark, rows) == slow_trie(rows)

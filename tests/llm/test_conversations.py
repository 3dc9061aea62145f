"""The prefix trie against every prefix of every conversation."""

import math
import random
import zlib
from hashlib import sha256

import pytest

from weir.llm import prefix_trie

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, own_members in members.items():
        cost = (len(own_members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(built[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(own_members), len(p), up, len(own_members), children[p], leaves[p], saved[p], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shuffled(spark, rows):
    rows = list(rows)
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def conversations(r, n, words, longest):
    return [(c, t, r.choice(["user", "assistant"]), r.choice(words)) for c in range(n) for t in range(r.randint(1, longest))]


def test_random_conversations(spark):
    r = random.Random(4)
    rows = conversations(r, 120, ["a", "b", "é", ""], 6)
    assert found(prefix_trie.prefix_nodes(shuffled(spark, rows))) == plain_nodes(rows)


def test_copies_prefixes_and_a_common_first_turn(spark):
    r = random.Random(5)
    rows = [(c, t, "user", "same" if t < 3 else f"x{t}") for c in range(60) for t in range(3 + c % 4)]
    rows += [(c, t, "system" if t == 0 else "user", "hello" if t == 0 else f"{c if t > 9 else 0}-{t}") for c in range(100, 130) for t in range(r.randint(1, 25))]
    assert found(prefix_trie.prefix_nodes(shuffled(spark, rows))) == plain_nodes(rows)


def test_very_long_conversations(spark):
    """More depths than a chunk holds, leaving each other inside chunks and at their ends."""
    size = prefix_trie.CHUNK
    rows = []
    for c, (n, apart) in enumerate([(2 * size + 40, None), (2 * size + 40, 2 * size + 7), (2 * size, None), (size, None), (size + 1, size), (3 * size, 60)]):
        rows += [(5 * c, t, "user", f"t{t}" if apart is None or t < apart else f"{c}t{t}") for t in range(n)]
    rows += [(3, t, "user", f"t{t}") for t in range(size + 20)]
    assert found(prefix_trie.prefix_nodes(shuffled(spark, rows))) == plain_nodes(rows)


def test_edges_of_the_input(spark):
    """NULL in any column, repeated rows, equal turns, turnless conversations, negative ids."""
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 2, "user", "z"), (0, 2, "user", "z"), (None, 1, "user", "lost")]
    rows += [(7, 0, "user", "x"), (12, 0, "a", "b"), (12, 0, "a", "b")]
    assert sum(1 for c in range(0, 40) if zlib.crc32(str(c).encode()) % 9 > 1) > 10
    rows += [(c, 0, "user", "only") for c in range(21, 40) if c % 5]  # some lose their only turn and get none
    got = found(prefix_trie.prefix_nodes(shuffled(spark, rows)))
    want = plain_nodes(rows)
    assert got == want
    negative = [(-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, 1, "user", "c")]
    assert found(prefix_trie.prefix_nodes(shuffled(spark, negative))) == plain_nodes(negative)


def test_empty_table_and_more_columns(spark):
    assert found(prefix_trie.prefix_nodes(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, 0, "u", "a"), (2, 0, "u", "a")]
    wide = spark.createDataFrame([(*r, 9, "k", 1.0) for r in rows], SCHEMA + ", depth BIGINT, key STRING, c DOUBLE")
    assert found(prefix_trie.prefix_nodes(wide)) == plain_nodes(rows)


@pytest.mark.parametrize("low,high,want", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (5, 6, 6), (6, 7, 7), (255, 512, 512), (256, 511, 384)])
def test_two_fattest(spark, low, high, want):
    assert spark.sql(f"SELECT {prefix_trie.two_fattest(f'{low}L', f'{high}L')}").first()[0] == want


def test_batches_grow_slowly(spark):
    """A caterpillar: every conversation leaves the one before it a turn later."""
    rows = [(5 * c, t, "user", f"t{t}" if t < c else f"{c}") for c in range(80) for t in range(c + 1)]
    assert found(prefix_trie.prefix_nodes(shuffled(spark, rows))) == plain_nodes(rows)

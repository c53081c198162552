"""The trie of conversations against a plain version that holds every prefix."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest

from tidemill.llm import joined, prefix_trie
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, depth LONG, name STRING, `a.b` INT, node LONG"


def regrown(rows):
    """{conv: its turns} of (conv_id, turn, role, text), each begun by those of another conversation."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = (*own.get(c - int(math.fmod(c, 20)), [])[:h], *own[c][h:])
    return out


def nodes(sequences):
    """{(conv_id, depth): the other columns}."""
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        cost = (len(m) - 1) * len(brute.words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += cost
    ends = lambda p, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if sequences[c] == p).encode()).hexdigest()
    return {
        (min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], ends(p, m))
        for p, m in members.items()
    }


def found(df):
    rows = df.collect()
    out = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in rows
    }
    assert len(out) == len(rows)
    return out


def given(spark, rows, place):
    full = [(*r, 1, "n", 2, 3) for r in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{place}/conversations.parquet")
    return place


def test_trie_of_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    assert found(QUERIES["op11_prefix_trie"](spark, FOLDER)) == nodes(regrown(rows))


def test_odd_conversations(spark, place):
    rng = random.Random(4)
    rows = [(c, t, "u", f"same start {t}") for c in range(60) for t in range(rng.randrange(1, 5))]
    rows += [(c, t, rng.choice(["u", "a", None]), rng.choice(["x", "x y", "", None])) for c in range(100, 160) for t in range(4)]
    rows += [(-c, None, "u", "x y z") for c in range(1, 30)]  # no number; negative ids
    rows += [(7, 0, "u", "same start 0")] * 3  # repeated rows
    rows += [(300, t, "u", f"t{t}") for t in range(70)] + [(301, t, "u", f"t{t}") for t in range(64)]  # deep, on and off a power of two
    rows += [(302, 1, "b", "tie"), (302, 1, "a", "tie"), (302, 1, "a", None), (302, None, "z", "first")]
    rows += [(None, 1, "u", "nobody's"), (777, 1, "u", "only one"), (778, 1, "u", "w " * 200_000)]
    expected = nodes(regrown(rows))
    assert found(QUERIES["op11_prefix_trie"](spark, given(spark, rows, place))) == expected
    assert any(not s for s in regrown(rows).values())  # turnless ones were among them


def test_one_long_conversation_and_many_equal_ones(spark, place):
    rows = [(20 * c, t, "u", f"equal {t}") for c in range(200) for t in range(2)]
    rows += [(40_000, t, "u", f"equal {t}") for t in range(300)]
    assert found(QUERIES["op11_prefix_trie"](spark, given(spark, rows, place))) == nodes(regrown(rows))


def test_only_turnless_conversations(spark):
    steps = spark.createDataFrame([], "conv LONG, place LONG, name BINARY, words LONG")
    lengths = spark.createDataFrame([(5, 0), (3, 0)], "conv LONG, length LONG")
    assert found(prefix_trie.prefix_trie(steps, lengths)) == nodes({5: (), 3: ()})


@pytest.mark.parametrize("kind, size", [("LONG", 1), ("LONG", 7), ("STRING", 7)])
def test_digests_of_members_in_pieces(spark, kind, size):
    ids = {b"a": list(range(-5, 60)), b"b": [12], b"c": [10**12, 9, -1]}
    if kind == "STRING":
        ids = {k: [str(x) for x in v] for k, v in ids.items()}
    rows = spark.createDataFrame([(k, c) for k, v in ids.items() for c in v], f"whole BINARY, member {kind}")
    got = {bytes(r.whole): r.sha for r in joined.joined_digests(rows.repartition(4), size).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in ids.items()}


def test_no_conversations(spark, place):
    assert QUERIES["op11_prefix_trie"](spark, given(spark, [], place)).count() == 0

"""The prefix trie of conversations against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecraft.llm import trie
from pricecraft.llm.common import crc_mod, save

SCHEMA = "conv_id long, turn long, role string, text string, depth string, w string"


def brute(paths):
    """{(conv_id, depth): row} of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    out = {}
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        key = (min(who), len(node))
        assert key not in out
        out[key] = (min(members[node[:-1]]) if node else None, len(who), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
    return out


def nodes(df):
    rows = df.collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def table(spark, turns):
    return spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA)


def build(df, **kw):
    numbered = trie.number_turns(df)
    return trie.prefix_trie(numbered, numbered.select("conv_id").distinct(), **kw)


@pytest.mark.parametrize("cells", [trie.MAX_CELLS, 64])
def test_shared_prefixes_copies_and_long_conversations(spark, cells):
    """Also with a sketch so small that nearly every prefix counts as possibly shared."""
    rng = np.random.default_rng(4)
    paths = {}
    for c in range(60):
        paths[c * 3] = [("user", f"w{rng.integers(2)} a b"[: rng.integers(1, 9)]) for _ in range(rng.integers(1, 7))]
    paths[500] = [("user", f"t {i % 5}") for i in range(300)]               # over many segments of turns
    paths[501] = paths[500][:200]
    paths[400] = list(paths[500])
    paths[-7] = [("", "")]
    turns = [(c, i, r, t) for c, p in paths.items() for i, (r, t) in enumerate(p)]
    got = nodes(build(table(spark, [turns[i] for i in rng.permutation(len(turns))]), max_cells=cells))
    assert got == brute(paths)


def test_order_nulls_ties_and_repeated_rows(spark):
    turns = [(1, 5, "user", "b"), (1, None, None, "first"), (1, 2, "user", None), (2, None, "", "first"), (2, 2, "user", ""), (2, 2, "user", ""),
             (None, 0, "user", "lost"), (3, 1, "u", "ab"), (4, 1, "ua", "b"), (5, -3, "u", "x"), (5, None, "u", "y")]
    got = nodes(build(table(spark, turns)))
    assert got == brute({1: [("", "first"), ("user", ""), ("user", "b")], 2: [("", "first"), ("user", ""), ("user", "")], 3: [("u", "ab")], 4: [("ua", "b")],
                         5: [("u", "y"), ("u", "x")]})
    # turns of one number: the order is the same whatever the order of rows
    tied = [(1, 0, "u", "a"), (1, 0, "u", "b"), (2, 0, "u", "b"), (2, 0, "u", "a")]
    assert {k: v[1] for k, v in nodes(build(table(spark, tied))).items()} == {(1, 0): 2, (1, 1): 2, (1, 2): 2}


def test_empty_table(spark):
    assert build(table(spark, []).limit(0)).count() == 0


def test_rebuilt_conversations(spark):
    rng = np.random.default_rng(8)
    own = {c: [("u", f"{c} {i} {rng.integers(3)}") for i in range(rng.integers(1, 6))] for c in [*range(0, 45), 100, 105, 107, 131]}
    own[20] = own[20][:1]                                                   # fewer turns than wanted; the one of 120 is absent
    turns = [(c, i, r, t) for c, p in own.items() for i, (r, t) in enumerate(p)]
    paths = {}
    for c, p in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + p[h:]
    c = F.col("conv_id")
    numbered = save(trie.number_turns(table(spark, turns)), "t")
    rebuilt, members = trie.share_heads(numbered, c - c % 20, crc_mod(c, 4), 3)
    assert nodes(trie.prefix_trie(rebuilt, members)) == brute(paths)


def test_turnless_conversations_end_in_the_root(spark):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(121, 140)}
    own = {c: [("u", "x")] * h[c] for c in h if h[c]}                       # 120 is absent: every one loses all its turns
    turns = [(c, i, r, t) for c, p in own.items() for i, (r, t) in enumerate(p)]
    c = F.col("conv_id")
    numbered = save(trie.number_turns(table(spark, turns)), "t")
    rebuilt, members = trie.share_heads(numbered, c - c % 20, crc_mod(c, 4), 3)
    assert nodes(trie.prefix_trie(rebuilt, members)) == brute({c: [] for c in own})


def test_sketch_never_hides_a_repeated_name(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-2**62, 2**62, 4000)
    a[2000:2500] = a[:500]
    second = dict(zip(a.tolist(), (a * np.int64(0x5851F42D4C957F2D)).tolist()))
    df = spark.createDataFrame([(x, second[x]) for x in a.tolist()], "p1 long, p2 long").repartition(7)
    for cells in (64, 1 << 12, trie.MAX_CELLS):
        flag = {(r.p1, r.p2): r.shared for r in trie.screen(df, cells).collect()}
        assert all(flag[int(x), second[int(x)]] for x in a[:500])
    alone = [flag[int(x), second[int(x)]] for x in a[500:2000]]
    assert sum(alone) < 0.1 * len(alone)

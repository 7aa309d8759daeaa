"""The Jaccard join and the embedding near-duplicates against all pairs."""

import math
import random

import numpy as np
import pytest

from pricecraft.llm import common, jaccard, neardup

SCHEMA = "doc_id long, text string, n_shingles string, component_id string, region int"


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(rows, percent=80):
    """{doc_id: (sizes, smallest reachable id)} by an inverted index."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    where = {}
    for j, (i, s) in enumerate(sets):
        near = {}
        for x in s:
            for o in where.get(x, ()):
                near[o] = near.get(o, 0) + 1
            where.setdefault(x, []).append(j)
        for o, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[o][1]) - n):
                a, b = find(i), find(sets[o][0])
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def components(df, **kw):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, **kw).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "junk", "junk", 1) for i, t in rows], SCHEMA)


def test_edges(spark):
    base = [f"w{i}" for i in range(104)]                       # 100 shingles
    edit = lambda n: " ".join([*base[:104 - n], *(f"x{n}_{i}" for i in range(n))])
    rows = [(10, " ".join(base)), (11, " ".join(base).upper()), (12, "\t".join(base) + "\n"), (13, edit(11)), (14, edit(12)),
            (20, "one two three"), (21, "One  two three"), (22, "one two"), (30, None), (31, ""), (32, " \n\t"),
            (40, "a b c d e"), (41, "a b c d e f"), (42, "a b c d e a b c d e"), (5, "z " * 30_000), (6, "Z " * 29_000)]
    got = components(frame(spark, rows))
    assert got == brute_components(rows)
    assert dict((i, c) for i, _, c in got)[13] == 10 and dict((i, c) for i, _, c in got)[14] == 14
    assert jaccard.jaccard_components(frame(spark, rows).limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    t = " ".join(f"v{i}" for i in range(60))
    got = jaccard.jaccard_components(frame(spark, [(3, t), (3, t), (1, t), (None, t), (7, None)])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == \
        sorted([(3, 56, 1), (3, 56, 1), (1, 56, 1), (None, 56, 1), (7, 0, 7)], key=str)


def test_ids_with_blank_rows(spark):
    """Rows without a word do not stand for another row of their id."""
    t = " ".join(f"v{i}" for i in range(60))
    rows = [(3, None), (3, ""), (3, t), (3, " \n"), (8, t + " end"), (8, None), (9, None)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows)).collect()]
    assert sorted(got) == [(3, 0, 3)] * 3 + [(3, 56, 3), (8, 0, 8), (8, 57, 3), (9, 0, 9)]


def test_ids_too_many_to_broadcast(spark, monkeypatch):
    """Beyond the bound texts are joined by shuffles, with the same result."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    rng = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(80)]
        for c in range(8):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(80)] = f"x{g}_{c}_{rng.random()}"
            rows.append((100 * g + c, " ".join(words)))
    assert components(frame(spark, rows)) == brute_components(rows)
    assert components(frame(spark, rows), solve=200) == brute_components(rows)


def test_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert components(d) == brute_components([tuple(r) for r in d.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_rings_and_crowds(spark, seed):
    """Texts at every distance: chains of small edits, copies of one base that
    are not linked with each other, and strangers with a common passage."""
    rnd = random.Random(seed)
    new = lambda n: [f"{rnd.randrange(10 ** 9)}" for _ in range(n)]
    rows, passage, base = [], new(30), new(150)
    chain = new(120)
    for _ in range(25):
        rows.append(" ".join(chain))
        p = rnd.randrange(len(chain) - 3)
        chain = chain[:p] + new(2) + chain[p + 2:]
    for _ in range(60):
        w, p = list(base), rnd.randrange(130)
        n = rnd.randrange(1, 14)
        w[p:p + n] = new(n)
        rows.append(" ".join(w))
    for n in range(60):
        rows.append(" ".join(passage + new(rnd.randrange(1, 40))))
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    want = brute_components(rows)
    assert components(frame(spark, rows)) == want
    if seed == 1:                                               # no region fits a task: pivots split them all
        assert components(frame(spark, rows), solve=400) == want


def test_forests_span_the_components_of_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
        sets = []
        for _ in range(rng.integers(2, 40)):
            keep = base[rng.random(40) > rng.choice([0.05, 0.1, 0.4])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, rng.integers(0, 4), dtype=np.uint64)])))
        sets = [s for s in sets if len(s)]
        labels = rng.integers(0, len(sets), len(sets)) if rng.random() < 0.5 else np.arange(len(sets))

        def parts(links):
            root = list(range(len(sets)))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a, b in links:
                root[max(find(a), find(b))] = min(find(a), find(b))
            return [find(x) for x in range(len(sets))]
        same = [(i, j) for i in range(len(sets)) for j in range(i) if labels[i] == labels[j]]
        linked = {(i, j) for i in range(len(sets)) for j in range(i)
                  if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
        found = jaccard.forest(labels, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
        assert all((max(p), min(p)) in linked for p in found) and len(found) < len(sets)
        assert parts(same + found) == parts(same + list(linked))


def test_rows_that_share_an_id_with_other_texts(spark):
    a, b = ([f"{x}{i}" for i in range(120)] for x in "ab")
    near = lambda w: " ".join([*w[:115], "q", "r", "s", "t", "u"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near(a)), (8, near(b)), (9, " ".join(b)), (3, "other words that link with nothing at all"), (9, "a b c d e f g")]
    got = components(frame(spark, rows))
    assert [(i, c) for i, _, c in got] == [(3, 3), (5, 5), (5, 5), (7, 5), (8, 5), (9, 5), (9, 5)]


def test_texts_longer_than_a_slice(spark):
    words = [f"w{i}" for i in range(300_000)]                   # 2 MB, two slices
    rows = [(1, " ".join(words)), (2, " ".join(words[:250_000])), (3, " ".join(words[:200_100])), (4, " ".join(words[100_000:]))]
    assert [c for _, _, c in components(frame(spark, rows))] == [1, 1, 1, 4]


# ---------------------------------------------------------------- embeddings

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, grp int"


def brute_links(rows, least=0.98):
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if y is not None and i is not None and ok(v)]
    for a in range(len(good)):
        for b in range(a):
            (i, v, y), (j, w, z) = good[a], good[b]
            if y == z and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= least:
                n[i] += 1
                n[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted(((i, n[i], find(i), find(i) == i) for i, _, _ in rows), key=str)


def links(df, **more):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df, **more).collect()), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "junk", 1) for i, v, y in rows], VECTOR_SCHEMA)


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, [1.0, 0.0, 0.0], None), (5, [0.0, 0.0, 0.0], 1),
            (6, None, 1), (7, [], 1), (8, [1.0, nan, 0.0], 1), (9, [1.0, inf, 0.0], 1), (10, [1.0, None, 0.0], 1), (11, [1.0, 0.0], 1),
            (12, [1.0, 0.1, 0.0], 1), (13, [1.0, 0.4, 0.0], 1), (14, [1.0, 0.0, 0.0], 1), (15, [1e30, 0.0, 0.0], 1), (16, [-1.0, 0.0, 0.0], 1), (17, [3.0], 1)]
    assert links(vectors(spark, rows)) == brute_links(rows)
    assert neardup.near_duplicates(vectors(spark, rows).limit(0)).count() == 0


def test_vector_crowds(spark):
    """Groups of near copies larger than a block, copies, and strangers."""
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for size, noise in ((1500, 0.01), (40, 0.02), (40, 0.025), (300, 0.5)):
        c = rng.normal(size=64)
        for _ in range(size):
            rows.append((i, (c + noise * rng.normal(size=64) * np.linalg.norm(c)).astype(float).tolist(), 1))
            i += 1
    rows += [(i + j, rows[0][1], 1) for j in range(30)]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.98).sum(1) - 1
    got = {r[0]: r[1] for r in links(vectors(spark, rows))}
    assert sum(got.values()) >= 0.99 * want.sum() and all(got[k] <= want[j] for j, k in enumerate(r[0] for r in rows))


def test_vector_recall_on_the_table(spark):
    """The table's vectors, every tenth with copies at cosines around 0.98."""
    rng = np.random.default_rng(2)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    for i, v, y in rows[::10]:
        for k in range(3):
            w = np.array(v) + rng.normal(size=len(v)) * np.linalg.norm(v) * 0.024
            rows.append((1_000_000 + 10 * i + k, w.tolist(), y))
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    y = np.array([r[2] for r in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (((u @ u.T) >= 0.98) & (y[:, None] == y)).sum(1) - 1
    got = {r[0]: r[1] for r in links(vectors(spark, rows))}
    assert want.sum() > 500 and 0.97 * want.sum() <= sum(got.values())
    assert all(got[r[0]] <= n for r, n in zip(rows, want))


def test_hadamard_keeps_angles():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = neardup.hadamard(x) / 4
    assert np.allclose(x @ x.T, y @ y.T)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_any_graph(spark, seed):
    from pricecraft.llm.common import connected_components
    rnd = random.Random(seed)
    edges = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)] + [(7, 7)]
    root = list(range(300))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.id: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}

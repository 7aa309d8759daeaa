"""Runs of words against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from pricecraft.llm import periodic, queries

SMALL = "/root/testdata/sf0.001"


def brute_runs(s, exponent, length):
    n, out = len(s), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            size = j + q - i
            if size >= max(length, exponent * q) and not any(q % d == 0 and all(s[x] == s[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.add((i, size, q))
            i = j if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_row(w):
    runs = brute_runs(w, 4, 6)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_words(rng, n, k):
    s = [rng.randint(1, k) for _ in range(n)]
    for _ in range(rng.randint(0, 2)):
        if n > 4:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            b = rng.randint(a, n)
            s = [x if not a <= i < b else s[a + (i - a) % p] for i, x in enumerate(s)]
    return s


def test_all_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(600):
        s = periodic_words(rng, rng.randint(0, 45), rng.choice([1, 2, 3, 5]))
        for e, m in ((2, 2), (3, 5), (4, 6)):
            assert list(map(tuple, periodic.runs_of(s, e, m).tolist())) == brute_runs(s, e, m)


def test_extensions_are_common_prefixes():
    rng = random.Random(6)
    s = [*periodic_words(rng, 200, 2), 0]
    x = periodic.CommonExtensions(*periodic.SuffixTree(s).tour())
    i, j = (np.array([rng.randrange(201) for _ in range(500)]) for _ in range(2))
    i, j = i[i != j], j[i != j]
    for a, b, n in zip(i.tolist(), j.tolist(), x.lce(i, j).tolist()):
        assert s[a:a + n] == s[b:b + n] and s[a + n] != s[b + n]


@pytest.mark.parametrize("exponent,length", [(4, 6), (3, 3), (2, 2), (5, 12)])
def test_cutting_texts_loses_no_run(exponent, length):
    rng = random.Random(exponent)
    texts = [" ".join(f"w{x}" for x in periodic_words(rng, rng.randint(0, 120), rng.choice([1, 2, 4, 30]))) for _ in range(250)] + ["", None, "a " * 50, "é"]
    data, off, ptr, found = periodic.slice_runs(pa.array(texts), exponent, length)
    for t, text in enumerate(texts):
        got = found.get(t)
        assert ([] if got is None else list(map(tuple, got.tolist()))) == brute_runs(words_of(text), exponent, length)


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SMALL).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert len(got) == len(rows) and sum(v[0] > 0 for v in got.values()) >= len(rows) // 20
    for r in rows:
        if len(words_of(r.text)) < 2500:
            assert got[r.doc_id] == brute_row(planted(r.doc_id, r.text)), r.doc_id


def test_edges(spark):
    long = " ".join(f"x{i % 3000}" for i in range(400_000))                # longer than a slice: 3 MB
    rows = [(1, "a b " * 5, 7, "z"), (1, "a b " * 5, 7, "z"), (2, None, None, None), (3, "", 1, ""), (None, "q q " * 6, 1, "x"), (4, "\x0b\x0c one\x1ftwo \t" * 3, 1, "x"),
            (5, "b a a a a a a c c c c c c c c", 2, "t"), (6, long, 3, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs long, _c0 string")
    got = sorted(((r.doc_id, r.runs, r._c0, r.n, [tuple(x) for x in r.found], r.kept) for r in periodic.periodic_runs(
        df, carry=("doc_id", "runs", "_c0"), names=("n", "found", "kept")).collect()), key=str)
    assert len(got) == len(rows)
    by = {g[0]: g for g in got}
    assert by[1][3:] == (10, [(0, 10, 2)], "a b") and by[1][1:3] == (7, "z")
    assert by[2][3:] == (0, [], "") and by[3][3:] == (0, [], "")
    assert by[None][3:] == (6, [(0, 6, 1)], "q q") and by[4][3:] == (3, [], " ".join(["one\x1ftwo"] * 3))
    assert by[5][4] == [(1, 6, 1), (7, 8, 1)] and by[5][5] == "b a c"
    assert by[6][4] == [(0, 400_000, 3000)] and by[6][5] == " ".join(f"x{i}" for i in range(3000))
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, carry=("doc_id", "runs"))

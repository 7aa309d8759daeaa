"""Language identification and language-model scores against plain Python."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricecraft.llm import langid, ppm

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, held_out string, score string, n_tokens int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "junk", "junk", 1) for r in rows], SCHEMA)


def rows_of(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_languages_of_the_table(spark):
    got = {r.doc_id: r for r in langid.identify_held_out(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    rows = rows_of(spark)
    assert len(got) == len(rows)
    held = [r for r in rows if crc(r.doc_id, 4) == 2]
    assert all(got[r.doc_id].held_out == (crc(r.doc_id, 4) == 2) and 0 <= got[r.doc_id].score <= 1 for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)


def brute_bundle(text, dim):
    v = np.zeros(dim, np.int64)
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        cs = [0, *map(ord, word), 0]
        for a, b, c in zip(cs, cs[1:], cs[2:]):
            x, y, z = (langid.letter_vector(i, dim).astype(np.int64) for i in (a, b, c))
            v += np.roll(x, 2) * np.roll(y, 1) * z
    return v


def test_bundles_are_the_definition():
    texts = ["Ab, cé ab!", None, "", "你好 x", "aaaa" * 50, "1 2 3"]
    b = langid.Bundler(64)
    tris, index, ptr = b.trigrams(texts)
    got = b.bundles(tris, index, np.repeat(np.arange(len(texts)), np.diff(ptr)), len(texts))
    for t, v in zip(texts, got):
        assert (brute_bundle(t or "", 64) == v).all()


def test_language_edges(spark):
    train = [(i, "the cat sat on the mat and then", "en") for i in range(40)] + [(100 + i, "der hund und die katze nicht", "de") for i in range(40)] \
        + [(200, "ohne sprache", None), (201, None, "en"), (202, "123 !!", "en")]
    probe = [(500, "the mat", None), (500, "the mat", None), (501, "die katze", None), (502, None, None), (503, "", None), (504, "12 ? 3", None),
             (None, "und die", None), (505, "the cat " * 20000, None)]
    got = langid.identify_held_out(frame(spark, train + probe)).collect()
    assert len(got) == len(train) + len(probe)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.lang_pred for r in by[500]] == ["en", "en"] and by[501][0].lang_pred == "de"
    assert [(by[i][0].lang_pred, by[i][0].score) for i in (502, 503, 504, 201, 202)] == [("und", 0.0)] * 5
    assert by[None][0].held_out is False and by[505][0].lang_pred == "en"
    empty = frame(spark, train).limit(0)
    assert langid.identify_held_out(empty).count() == 0
    assert [r.lang_pred for r in langid.identify(frame(spark, [(1, "abc", None)]), {}).collect()] == ["und"]


def words(text):
    return (text or "").encode().lower().split() + [None]


def brute_base(rows, held):
    c = Counter(w for r in rows if not held(r) for w in words(r[1]))
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        w = words(r[1])
        out.append((r[0], held(r), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def brute_model(rows, held):
    """The trie as nested dicts, and the probability by recursion."""
    counts = [Counter() for _ in range(4)]
    for r in rows:
        if not held(r):
            s = b"\xfe\xfe\xfe" + (r[1] or "").encode() + b"\xff"
            for i in range(3, len(s)):
                for k in range(4):
                    counts[k][s[i - k:i], s[i]] += 1
    seen = [{} for _ in range(4)]
    for k in range(4):
        for (ctx, sym), n in counts[k].items():
            seen[k].setdefault(ctx, {})[sym] = n
    memo = {}

    def p(ctx, sym, k):
        if (ctx, sym, k) not in memo:
            memo[ctx, sym, k] = _p(ctx, sym, k)
        return memo[ctx, sym, k]

    def _p(ctx, sym, k):
        if k < 0:
            return 1 / 256
        at = seen[k].get(ctx)
        if not at:
            return p(ctx[1:], sym, k - 1)
        total, distinct = sum(at.values()), len(at)
        left = sum(p(ctx[1:], s, k - 1) for s in range(256) if s not in at)
        if left <= 0:
            return at.get(sym, 0) / total
        if sym in at:
            return at[sym] / (total + distinct)
        return distinct / (total + distinct) * p(ctx[1:], sym, k - 1) / left

    def score(text):
        s = b"\xfe\xfe\xfe" + (text or "").encode() + b"\xff"
        return sum(math.log10(p(s[i - 3:i], s[i], 3)) for i in range(3, len(s)))
    return score


EDGE = [(1, "the cat sat on the mat", "x"), (2, "The  CAT\tsat.", "x"), (2, "The  CAT\tsat.", "x"), (3, None, "x"), (4, "", "x"), (5, "émile É 你", "x"),
        (6, "the " * 3000, "x"), (None, "the dog", "x"), (7, "zzz unknown", "x")]


def test_scores_match_brute_force(spark):
    rows = EDGE + [tuple(r) for r in rows_of(spark)[:60]]
    held = lambda r: r[0] is not None and crc(r[0], 10) == 0
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ppm.held_out_scores(frame(spark, rows)).collect()), key=str)
    score = brute_model(rows, held)
    want = sorted(((*b, score(r[1])) for b, r in zip(brute_base(rows, held), rows)), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-5)


def test_scores_of_an_empty_table(spark):
    assert ppm.held_out_scores(frame(spark, EDGE).limit(0)).count() == 0
    got = ppm.base_and_model_scores(frame(spark, EDGE), ppm.F.lit(True)).collect()
    assert len(got) == len(EDGE) and all(r.train_tokens == 0 and r.n_known == 0 for r in got)
    assert all(math.isclose(r.score, -len(((t or "") + "x").encode()) * math.log10(256), rel_tol=1e-5) for r, (_, t, _) in
               zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(EDGE, key=lambda e: (str(e[0]), len(words(e[1]))))))


def test_probabilities_add_up():
    trie = []
    codes = ppm.text_symbols(pa.array(["abracadabra", "abc", None]))[0]
    for k in range(4):
        c, n = np.unique(codes & np.uint32((1 << 8 * (k + 1)) - 1), return_counts=True)
        trie.append((c, n))
    rows, log = ppm.log_table(trie)
    assert np.allclose((10.0 ** log.astype(float)).sum(1), 1, atol=1e-5)


@pytest.mark.parametrize("keep", [1, 3])
def test_bounded_trie_backs_off(spark, keep):
    rows = [tuple(r) for r in rows_of(spark)[:30]]
    trie = ppm.learn_trie(frame(spark, rows), max_contexts=keep)
    assert len(np.unique(trie[3][0] >> 8)) == keep
    got = ppm.score_texts(frame(spark, rows), trie).collect()
    assert len(got) == 30 and all(r.score < 0 for r in got)


def test_contexts_outside_the_trie_count(spark):
    rows = frame(spark, EDGE + [tuple(r) for r in rows_of(spark)[:40]])
    whole, small = ([x for _, x in sorted((str(r.doc_id), r.score) for r in ppm.held_out_scores(rows, max_contexts=k).collect())] for k in (1 << 24, 40))
    assert np.allclose(whole, small, rtol=1e-6)


def test_carried_columns_may_have_the_names_used_inside(spark):
    df = spark.createDataFrame([("the cat and the mat", "a", "b", 1), (None, None, "d", 2)], "text string, _text string, _score string, _c0 int")
    known = langid.learn_prototypes(spark.createDataFrame([("the cat sat on the mat", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    got = langid.identify(df, known, carry=tuple(df.columns), names=("l", "s")).orderBy("_c0").collect()
    assert [(r._text, r._score, r._c0, r.l) for r in got] == [("a", "b", 1, "en"), (None, "d", 2, langid.UND)]
    with pytest.raises(ValueError):
        langid.identify(df, known, carry=("_text",), names=("_text", "s"))

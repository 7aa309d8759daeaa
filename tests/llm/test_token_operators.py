"""BPE, packing and token files against the tokenizer libraries and brute force."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricecraft.llm import bpe, packing, pfor, tokens

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens int, sequence_id string, offset string, length string"
EDGE = [(1, None), (2, ""), (3, " "), (4, "  two  spaces \n and\ttabs "), (4, "  two  spaces \n and\ttabs "), (5, "x" * 3000),
        (6, "The the the.\nThe the"), (7, "naïve café — 你好 😀 <|endoftext|>"), (8, "word " * 5000), (None, "no id"), (9, "\x1c a \x85b")]


@pytest.fixture(scope="module")
def enc():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})


@pytest.fixture(scope="module")
def hf():
    t = Tokenizer.from_file(JSON)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "junk", 1, "junk", "junk", "junk") for i, t in EDGE], SCHEMA)


def test_added_tokens_are_those_of_the_library(hf):
    """The library as its contract says, called without any setting."""
    with open(JSON, encoding="utf-8") as f:
        text = f.read()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "no <|endoftext|", None, "", "x<|endoftext|>y  <|endoftext|>\n", "<|ENDOFTEXT|>"]
    for by_ranks in (False, True):
        assert tokens.encoder(text, by_ranks).encode(texts) == [u32(hf(t)) for t in texts]
    assert hf("a <|endoftext|> b") == [64, 220, 50256, 275]
    with pytest.raises(ValueError):
        tokens.WithAdded(None, [{"content": "x", "id": 1, "lstrip": True}])


def test_long_texts_without_a_space_are_not_remembered():
    with open(JSON, encoding="utf-8") as f:
        enc = tokens.Encoder(f.read())
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefgh") for _ in range(5000)) for _ in range(20)]
    first = enc.encode(texts)
    assert all(len(k) <= 64 for k in enc.memo) and enc.encode(texts) == first
    assert first[0] == u32(Tokenizer.from_file(JSON).encode(texts[0], add_special_tokens=False).ids)
    with open(RANKS, "rb") as f:
        words = bpe.WordIds(bpe.load_ranks(f.read()))
    bpe.ChunkIds(words, _pattern())[texts[0]]
    assert all(len(k) <= 64 for k in words)


def test_words_of_letters_go_to_the_model_by_themselves():
    """Only what the pattern must cut runs through it; ids are the library's."""
    with open(JSON, encoding="utf-8") as f:
        enc = tokens.Encoder(f.read())
    hf = Tokenizer.from_file(JSON)
    rnd = random.Random(11)
    texts = [" ".join("".join(rnd.choice("abcxyzéßñЖж") for _ in range(rnd.randint(1, 12))) + rnd.choice(["", "", ",", ".", "!", "7", "'s", ".\nQ", "\u4e2d", "\u0301"])
                      for _ in range(40)) for _ in range(50)]
    assert enc.encode(texts) == [u32(hf.encode(t, add_special_tokens=False).ids) for t in texts]
    given, real = [], enc._ids
    enc._ids = lambda text: given.append(text) or real(text)
    enc.encode(["erste qwortß qwörter, qend"])
    assert [g.strip() for g in given] == ["erste"]


def test_marks_and_next_lines_do_not_run_through_the_pattern():
    """Letters with marks after them, also over a line's end, are cut by rule."""
    with open(JSON, encoding="utf-8") as f:
        enc = tokens.Encoder(f.read())
    hf = Tokenizer.from_file(JSON)
    rnd = random.Random(12)
    marks = ["", ",", ".", "***", ".!!", "&&&", "'s", "'", "-", "_", "\u00bd", "\u2026", ".\n", "\n", "\n\n", ".\nQu", "\n\u00c9t\u00e9!", ".\nA1", "\r\nb", "\n.b", "7", "\u0531"]
    texts = [rnd.choice(["", " ", "\n"]) + " ".join("".join(rnd.choice("abcxyz\u00e9\u00df\u0416") for _ in range(rnd.randint(0, 9))) + rnd.choice(marks)
                                                  for _ in range(40)) for _ in range(200)]
    for _ in range(2):
        assert enc.encode(texts) == [u32(hf.encode(t, add_special_tokens=False).ids) for t in texts]
    given, real = [], enc._ids
    enc._ids = lambda text: given.append(text) or real(text)
    assert enc.encode(["erste qwort*** qw\u00f6rter.!!\nQ\u00fcnd, qa.\nqb qa qc"]) == [u32(hf.encode("erste qwort*** qw\u00f6rter.!!\nQ\u00fcnd, qa.\nqb qa qc", add_special_tokens=False).ids)]
    assert [g.strip() for g in given] == ["erste"]


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def key(rows):
    return sorted(map(tuple, rows), key=str)


def test_bpe_edges(docs, enc):
    got = bpe.round_trip_digests(docs, RANKS, P.PATTERN).collect()
    want = [(i, len(x := enc.encode_ordinary(t or "")), hashlib.sha256(u32(x)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in EDGE]
    assert key(got) == key(want)
    assert bpe.round_trip_digests(docs.limit(0), RANKS, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\x0b\x1c\x85\xa0ab'sTlre1 .,!?é你😀")))
def test_cuts_keep_ids(text):
    with open(RANKS, "rb") as f:
        enc = _cached(f)
    words = _words()
    assert b"".join(bpe.ChunkIds(words, _pattern())[c] for c in bpe.chunk_keys(text)) == u32(enc.encode_ordinary(text))
    assert tokens_encoder().encode([text])[0] == u32(enc.encode_ordinary(text))
    assert u32(tokens_encoder().tok.encode(text, add_special_tokens=False).ids) == u32(enc.encode_ordinary(text)) == rank_encoder().encode([text])[0]


_CACHE = {}


def _cached(f):
    if "enc" not in _CACHE:
        _CACHE["ranks"] = bpe.load_ranks(f.read())
        _CACHE["enc"] = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=_CACHE["ranks"], special_tokens={})
        _CACHE["words"] = bpe.WordIds(_CACHE["ranks"])
    return _CACHE["enc"]


def _words():
    return _CACHE["words"]


def _pattern():
    import regex
    return regex.compile(P.PATTERN)


def tokens_encoder():
    if "hf" not in _CACHE:
        with open(JSON, encoding="utf-8") as f:
            _CACHE["hf"] = tokens.Encoder(f.read())
    return _CACHE["hf"]


def rank_encoder():
    if "ranks-json" not in _CACHE:
        with open(JSON, encoding="utf-8") as f:
            _CACHE["ranks-json"] = tokens.RankEncoder(tokens.merge_ranks(f.read()))
    return _CACHE["ranks-json"]


def test_only_plain_files_give_ranks():
    with open(JSON, encoding="utf-8") as f:
        plain = f.read()
    assert len(tokens.merge_ranks(plain)) == 50_256
    j = json.loads(plain)
    j["model"]["merges"][5], j["model"]["merges"][9] = j["model"]["merges"][9], j["model"]["merges"][5]
    assert tokens.merge_ranks(json.dumps(j)) is None
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert tokens.merge_ranks(f.read()) is None


def test_both_encoders_on_the_table(spark, hf):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = [u32(hf(t)) for t in texts]
    assert rank_encoder().encode(texts) == want and tokens_encoder().encode(texts) == want


def test_long_words_fold_alike(enc):
    with open(RANKS, "rb") as f:
        ranks = bpe.load_ranks(f.read())
    rnd = random.Random(3)
    for n in (127, 128, 129, 2000):
        w = "".join(rnd.choice("abcdethsin") for _ in range(n))
        assert bpe.fold_merges(w.encode(), ranks) == enc.encode_ordinary(w)


def pieces_of(ids, capacity):
    ids = [*ids, 0]
    a, b, k = 0, (len(ids) - 1) % capacity + 1, 0
    while a < len(ids):
        yield k, a, b - a, ids[a:b]
        a, b, k = b, b + capacity, k + 1


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing_edges(docs, hf, capacity):
    got = packing.pack_documents(docs, JSON, capacity, with_ids=False).collect()
    want = [(i, k, a, n, zlib.crc32(u32(x))) for i, t in EDGE for k, a, n, x in pieces_of(hf(t), capacity)]
    assert key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == key(want)
    check_gapless(got, capacity)
    assert packing.pack_documents(docs.limit(0), JSON, capacity).count() == 0


def check_gapless(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query_whole_table(spark, hf):
    from pricecraft.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = QUERIES["op6_best_fit_packing"](spark, d).collect()
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, k, a, n, zlib.crc32(u32(x))) for r in docs for k, a, n, x in pieces_of(hf(r.text), 2048)]
    assert key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == key(want)
    n = check_gapless(got, 2048)
    bound = -(-sum(w[3] for w in want) // 2048)
    assert bound <= n <= bound * 1.05 + 1


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
def test_plan_uses_every_piece(counts):
    plan = packing.plan_patterns(counts, 64)
    used = Counter()
    for members, times in plan:
        assert times > 0 and sum(n * k for n, k in members) <= 64
        for n, k in members:
            used[n] += k * times
    assert used == Counter(counts)


def test_exact_fills_come_first():
    assert sum(t for _, t in packing.plan_patterns({60: 2, 4: 1, 3: 1, 1: 1, 30: 2, 34: 2}, 64)) == 4


def test_files_edges(docs, hf):
    files = pfor.write_token_files(docs, JSON)
    got = pfor.read_token_files(files).collect()
    order = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, []
    for i, t in order:
        x = [*hf(t), 0]
        want.append((i, at, len(x), bytes(u32(x))))
        at += len(x)
    assert key((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got) == key(want)
    assert pfor.read_token_files(pfor.write_token_files(docs.limit(0), JSON)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 7), st.integers(0, 2 ** 32 - 1)), max_size=700))
def test_segments_round_trip(values):
    raw = pfor.pack_segment(np.array(values, "<u4"))
    assert pfor.unpack_segment(raw).tolist() == values
    for i in range(-(-len(values) // pfor.BLOCK)):
        assert pfor.read_block(raw, i).tolist() == values[i * pfor.BLOCK:(i + 1) * pfor.BLOCK]


def test_bits_of_a_block_are_in_ascending_order():
    """The layout of packed bits, by a plain loop, for every width."""
    rng = np.random.default_rng(5)
    for w in range(1, 33):
        v = rng.integers(0, 1 << w, 256, dtype=np.uint64).astype("<u4")
        v[:2] = 0, (1 << w) - 1
        raw = pfor.pack_segment(v, percentile=1.0)
        width = max(int(x).bit_length() for x in v)
        whole = sum(int(x) << (i * width) for i, x in enumerate(v.tolist()))
        assert whole.to_bytes(256 * width // 8, "little") in raw and (pfor.unpack_segment(raw) == v).all()


def test_outliers_do_not_widen_a_block():
    v = np.arange(256, dtype=np.uint32) % 8
    narrow = len(pfor.pack_segment(v))
    v[17] = 40_000
    assert len(pfor.pack_segment(v)) == narrow + 5


def test_file_query_whole_table(spark, hf):
    from pricecraft.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op8_pfor_token_files"](spark, d).collect()}
    at = 0
    for r in sorted(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()):
        x = [*hf(r.text), 0]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (at, len(x), zlib.crc32(u32(x)))
        at += len(x)


def test_bpe_query_whole_table(spark, enc):
    from pricecraft.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = QUERIES["op2_byte_bpe"](spark, d).collect()
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, len(x := enc.encode_ordinary(r.text)), hashlib.sha256(u32(x)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in docs]
    assert key(got) == key(want)
